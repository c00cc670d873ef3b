"""Column expressions: built-in functions only, no Python in the data path."""

from pricelake.functions.keys import day_key, minute_key, shard_of
from pricelake.functions.messages import json_fields
from pricelake.functions.names import pair_from_path, pair_from_product, stem_from_path
from pricelake.functions.times import display_time, epoch_millis, epoch_seconds, parse_time

__all__ = [
    "day_key",
    "display_time",
    "epoch_millis",
    "epoch_seconds",
    "json_fields",
    "minute_key",
    "pair_from_path",
    "pair_from_product",
    "parse_time",
    "shard_of",
    "stem_from_path",
]
