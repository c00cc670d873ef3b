"""The list of known pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import stem_from_path
from pricelake.sources.bars import CSV_GLOB


def pairs(df: DataFrame) -> DataFrame:
    return df.select("pair").distinct().orderBy("pair")


def pairs_from_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the bar files of a folder; the files are listed, not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(path).select("path")
    )
    # This source gives plain paths, so protect the decoder's escape character.
    encoded = F.replace("path", F.lit("%"), F.lit("%25"))
    return pairs(files.select(stem_from_path(encoded).alias("pair")))
