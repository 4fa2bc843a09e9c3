import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("foldwise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foldwise-test-ckpt-"))
    yield s
    s.stop()


def table(spark, rows, schema, folds=None):
    """Hand table with an id, a split and (optionally) a fold column."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, schema)
    if "split" not in df.columns:
        df = df.withColumn("split", F.lit("train"))
    if folds is not None and "fold" not in df.columns:
        df = df.withColumn("fold", F.lit(folds).cast("int"))
    return df
