"""Folders of micro-batches, one set for each checkpoint."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pricelake.files import children
from pricelake.plans.build import read_or_none


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; made when it first starts.

    Batch numbers restart with a new checkpoint, so folders carry this name too. It lies in
    a folder of its own inside the checkpoint and goes with it.
    """
    path = f"{checkpoint}/run_name"
    found = read_or_none(lambda: spark.read.text(path))
    row = found.first() if found is not None else None
    if row is None:
        line = spark.sql("SELECT 1").select(F.lit(uuid.uuid4().hex).alias("value"))
        line.coalesce(1).write.mode("overwrite").text(path)
        row = spark.read.text(path).first()
    return row["value"]


class BatchFolders:
    """Names the folder of each micro-batch of one checkpoint."""

    def __init__(self, checkpoint: str, run: str | None = None):
        self.checkpoint = checkpoint
        self.run = run

    def name(self, spark: SparkSession, batch: int) -> str:
        if self.run is None:
            self.run = run_name(spark, self.checkpoint)
        return f"run={self.run}/batch={batch}"

    def only(self, spark: SparkSession, path: str, batch: int) -> str:
        """The same, where ``path`` belongs to one checkpoint; another one's folders are an error."""
        folder = self.name(spark, batch)
        own = folder.split("/")[0]
        if any(name.startswith("run=") and name != own for name, _ in children(spark, path)):
            raise ValueError(f"{path} holds the boards of another checkpoint")
        return folder
