"""JDBC changelog sink (append every update as a row).

The rows go through Spark's distributed JDBC writer (one connection per
partition).  That writer commits per partition, so a retried micro-batch could
append some rows twice; with ``audit=True`` each row carries ``batch_id`` and
the batch's earlier rows are deleted before it is appended again, which makes
the sink idempotent by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERY_TIMEOUT_SECONDS = 30


class JdbcChangelogSink:
    def __init__(self, url: str, table: str, properties: dict | None = None,
                 query_timeout: int = QUERY_TIMEOUT_SECONDS, audit: bool = True,
                 batch_column: str = "batch_id", quote: str = '"', max_connections: int | None = None,
                 batch_size: int = 1000) -> None:
        self.url = url
        # Spark's writer opens one connection per partition; ``numPartitions``
        # caps that (it coalesces, no shuffle) and ``batchsize`` groups inserts
        self.max_connections = max_connections
        self.batch_size = batch_size
        # Spark's writer creates quoted column names; quote the same way here
        self.quote = quote
        self.table = table
        self.properties = dict(properties or {})
        self.query_timeout = query_timeout
        self.audit = audit
        self.batch_column = batch_column

    def _delete_batch(self, spark: SparkSession, batch_id: int) -> None:
        """Remove rows an earlier attempt of this batch may have left."""
        jvm = spark.sparkContext._jvm
        driver = self.properties.get("driver")
        if driver:
            jvm.java.lang.Class.forName(driver)
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            meta = conn.getMetaData()
            schema, _, name = self.table.rpartition(".")
            schemas = {schema, schema.upper(), schema.lower()} if schema else {None}
            names = {name, name.upper(), name.lower()}
            if not any(meta.getTables(None, sp, n, None).next() for sp in schemas for n in names):
                return
            column = f"{self.quote}{self.batch_column}{self.quote}"
            stmt = conn.prepareStatement(f"DELETE FROM {self.table} WHERE {column} = ?")
            stmt.setLong(1, int(batch_id))
            stmt.setQueryTimeout(self.query_timeout)
            stmt.executeUpdate()
            stmt.close()
        finally:
            conn.close()

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        out = df
        if self.audit:
            out = df.withColumn(self.batch_column, F.lit(batch_id).cast("bigint"))
            self._delete_batch(df.sparkSession, batch_id)
        writer = out.write.option("queryTimeout", self.query_timeout).option("batchsize", self.batch_size)
        if self.max_connections:
            writer = writer.option("numPartitions", self.max_connections)
        writer.jdbc(self.url, self.table, mode="append", properties=self.properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))
