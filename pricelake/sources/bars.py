"""Readers for bar files and for the combined file."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricelake.schemas import COMBINED, CORRUPT, LAKE, RAW_BAR
from pricelake.session import scratch_dir

CSV_GLOB = "*.csv"  # case-sensitive: x.CSV is not read


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def _bar_reader(spark: SparkSession, layout: StructType):
    return (
        spark.read.schema(_with_corrupt(layout))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # Compare each file's header with the layout instead of trusting it:
        # columns are assigned by position, so another order must not pass.
        .option("enforceSchema", False)
        .option("pathGlobFilter", CSV_GLOB)
    )


def _fields(line: str) -> Column:
    """The fields of a line of a bar file: numbers and names, which hold no commas."""
    return F.transform(
        F.split(line, ","), lambda field: F.trim(F.replace(field, F.lit('"'), F.lit("")))
    )


def header_names(
    spark: SparkSession, path: str | list[str], schema: StructType = RAW_BAR
) -> DataFrame:
    """(path, names): the column names of each bar file, in a table of their own.

    A header line is one that holds every required column name. Files without one,
    or with two that differ, are refused; only counts reach the driver.
    """
    lines = spark.read.option("pathGlobFilter", CSV_GLOB).text(path)
    origin = F.col("_metadata.file_path").alias("path")
    required = F.array(*[F.lit(field.name) for field in schema.fields])
    # Cheap test first: a line of numbers fails it at the first name.
    holds_names = reduce(and_, [F.col("value").contains(field.name) for field in schema.fields])
    found = (
        lines.where(holds_names)
        .select(origin, _fields("value").alias("names"))
        .where(F.size(F.array_except(required, F.col("names"))) == 0)
        .distinct()
    )
    # Written, so that its size is known when it is joined.
    stored = scratch_dir(spark, "headers")
    found.write.parquet(stored)
    found = spark.read.schema(found.schema).parquet(stored)
    if found.groupBy("path").count().where("count > 1").head(1):
        raise ValueError("a bar file holds two different header lines")
    files = lines.select(origin).distinct()
    headless = files.join(found, "path", "left_anti").count()
    if headless or not found.head(1):
        raise ValueError(
            f"{headless} of {files.count()} bar files have no header "
            f"with the columns {schema.fieldNames()}"
        )
    return found


def read_bar_files(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RAW_BAR,
    by_name: bool = False,
) -> DataFrame:
    """Bar files (one per instrument) with their ``path``.

    One pass over the data; a file whose header is not ``schema`` in order
    stops the job. With ``by_name`` the headers are looked up first (a second,
    text-only pass) and joined to the lines by file, each of which picks its
    fields by their names. Spark's size check decides how to join.
    """
    origin = F.col("_metadata.file_path").alias("path")
    if not by_name:
        columns = schema.fieldNames()
        return _bar_reader(spark, schema).csv(path).select(*columns, CORRUPT, origin)

    lines = spark.read.option("pathGlobFilter", CSV_GLOB).text(path).select("value", origin)
    fields = (
        lines.where("value <> ''")
        .withColumn("fields", _fields("value"))
        .join(header_names(spark, path, schema), "path")
        .where("fields <> names")
    )
    text = {
        field.name: F.get("fields", F.array_position("names", field.name).cast("int") - 1)
        for field in schema.fields
    }
    values = {field.name: text[field.name].try_cast(field.dataType) for field in schema.fields}
    unreadable = [(text[name] != "") & values[name].isNull() for name in values]
    corrupt = reduce(or_, unreadable, F.size("fields") != F.size("names"))
    return fields.select(
        *[value.alias(name) for name, value in values.items()],
        F.when(corrupt, F.col("value")).alias(CORRUPT),
        "path",
    )


def read_combined(
    spark: SparkSession, path: str | list[str], quoted: bool = False, header: bool = True
) -> DataFrame:
    """The combined seven-column text file; bad numbers become null.

    ``quoted`` reads fields in double quotes with backslash escapes; without it
    a quote is an ordinary character, as in a plain delimited table. ``header``
    checks and skips the first line of every file. Read files that may or may
    not start with one with ``header=False`` and use ``drop_header_rows``.
    """
    reader = (
        spark.read.schema(COMBINED)
        .option("sep", ",")
        .option("mode", "PERMISSIVE")
        .option("header", header)
        .option("enforceSchema", False)
    )
    if quoted:
        reader = reader.option("quote", '"').option("escape", "\\")
    else:
        reader = reader.option("quote", "")
    return reader.csv(path)


def read_combined_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The combined text file with each line as it stands (``raw``).

    A line with a bad number, or with more or fewer fields than there are columns, is
    also in the corrupt-record column. Header lines are read as data; blank lines are
    none. Each line is parsed once.
    """
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _with_corrupt(COMBINED))
    options = {"sep": ",", "mode": "PERMISSIVE", "quote": "", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.inline(F.array(F.from_csv("value", layout, options)))
    return lines.select(F.col("value").alias("raw"), parsed)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet lake; ``pair`` comes from the partition folder, as text."""
    return spark.read.schema(LAKE).parquet(path)
