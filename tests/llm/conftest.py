import os
import time

import pytest

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def stored(spark, rows, schema, folder):
    """The rows as a table on disk, in a few files."""
    path = f"{folder}/table"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def shuffled(spark):
    """Names of the shuffle files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_on_disk(spark, before, seconds=10):
    """Shuffle files that were not there ``before`` and do not go within some seconds."""
    end = time.time() + seconds
    while (left := shuffled(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left
