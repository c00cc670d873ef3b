"""Instrument names from file paths and feed product ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _file_name(path: Column) -> Column:
    """Last path segment, decoded: Spark hands out paths URI-encoded.

    A literal ``+`` is protected first, because URL decoding reads it as a space.
    """
    name = F.substring_index(path, "/", -1)
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def pair_from_path(path: Column) -> Column:
    """File name up to its first dot: ``/x/a.b.csv`` gives ``a``."""
    return F.substring_index(_file_name(path), ".", 1)


def stem_from_path(path: Column) -> Column:
    """File name without its last extension: ``/x/a.b.csv`` gives ``a.b``.

    Dots a name starts with do not begin an extension.
    """
    return F.regexp_replace(_file_name(path), r"^(\.*[^.].*)\.[^.]*$", "$1")


def pair_from_product(product: Column) -> Column:
    """Drop the first hyphen and lower-case: ``BTC-USD-X`` gives ``btcusd-x``."""
    return F.lower(F.regexp_replace(product, "^([^-]*)-", "$1"))
