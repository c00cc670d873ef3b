"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
TIME_ZONE = "spark.sql.session.timeZone"

# Batch, stream and lookup must agree on the day a tick belongs to, so every
# session that runs these operators uses UTC.
DEFAULTS = {
    TIME_ZONE: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    spark.conf.set(TIME_ZONE, "UTC")
    return spark


def local_session(app: str = "pricelake", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the session comes from spark-submit; call ``configure`` on it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A local master has one machine only, so there (and nowhere else) a folder
    of that machine is good enough when the cluster setting is absent.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir(spark.sparkContext.applicationId)
    raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"pricelake-{application}-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used.

    All paths of an application lie in one folder, which can be expired as a whole.
    """
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
