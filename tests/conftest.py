import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    spark = (SparkSession.builder.master("local[*]").appName("cascata-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.checkpoint.dir", ckpt)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cascata.session import checkpoint_root
    checkpoint_root(spark)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")
