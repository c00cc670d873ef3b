"""JSON messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_fields(value: str, schema: StructType, corrupt: str | None = None) -> Column:
    """The fields of a JSON text as columns; all null where it is no object.

    Selected through ``inline``: a plain ``from_json`` column would be copied
    into every filter and projection above it and parsed again in each.
    ``corrupt`` names a text column of the schema that gets what is no object.
    """
    options = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    return F.inline(F.array(F.from_json(value, schema, options)))
