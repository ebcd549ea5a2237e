"""Sinks: per-batch table partitions, rolling text files, JDBC changelog, keyed upsert store."""

from cascata.sinks.files import (ROLL_BYTES, BatchPartitionSink, RollingTextWriter, delimited_records,
                                 mean_record_bytes, records_per_file, start_rolling_text, with_file_number,
                                 write_rolled_text, write_rolling_text)
from cascata.sinks.jdbc import JdbcChangelogSink, read_jdbc
from cascata.sinks.keyed_store import KeyedStore, ParquetKeyedStore

__all__ = ["ROLL_BYTES", "BatchPartitionSink", "JdbcChangelogSink", "KeyedStore", "ParquetKeyedStore", "RollingTextWriter",
           "delimited_records", "mean_record_bytes", "read_jdbc", "records_per_file", "start_rolling_text",
           "with_file_number", "write_rolled_text", "write_rolling_text"]
