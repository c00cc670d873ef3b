"""URL filter: blocked Bloom filter, then an exact hash join (operator 2).

The listed canonical URLs are rules (host, path, verdict). A rule fits its host and all
subdomains, where the URL's path starts with the rule's; of several the longest wins.

* A URL's candidate keys are its host suffixes with as many labels as some rule has,
  joined with its path prefixes as long as some rule's path.
* The blocked Bloom filter keeps one 64-bit block for each address and sets
  ``PROBES`` bits of one block for a key, so a key is tested with one look-up. It is
  built by a grouped OR and has ``FILTER_BLOCKS`` blocks at most, whatever the list
  holds; that bound is why it may be broadcast.
* Keys that pass are joined with the rules by host and path, which removes the false
  positives. Spark picks the join; the rules are never forced into a broadcast.
* URLs are judged once for each distinct host and path.

Defined results: a URL that is NULL or has no ``://`` has empty host and path. Where no
rule fits, the verdict is ``default``. Every row of ``pages`` gives one row. Rules with
NULL host, path or verdict are ignored; of rules with the same key the least verdict
counts. Repeated rows are judged alike, URLs of any length whole. Other columns are
ignored, whatever their names; an empty table gives no rows, and without rules every
verdict is ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BLOCKS = 1 << 17  # 64-bit blocks: 1 MB of bits, 2 MB as rows
PROBES = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _address(host: str, path: str) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(FILTER_BLOCKS))


def _mask(host: str, path: str) -> Column:
    """PROBES bits of a 64-bit block, from another hash than the address."""
    seed = F.xxhash64(F.lit("bits"), host, path)
    bits = []
    for k in range(PROBES):
        place = F.shiftrightunsigned(seed, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_blocks(rules: DataFrame) -> DataFrame:
    """(block, bits) of the blocks that hold a key: FILTER_BLOCKS rows at most."""
    return (
        rules.select(_address("rule_host", "rule_path").alias("block"), _mask("rule_host", "rule_path").alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("bits"))
    )


def _candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule_host, rule_path) for every key that a rule for the URL could have."""
    # how long rules are: as many numbers as the longest host has labels, the longest path characters
    labels = [r[0] for r in rules.select(F.size(F.split("rule_host", r"\."))).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]
    count = F.size(F.split("host", r"\."))
    hosts = [
        F.when(count >= n, F.substring_index("host", ".", -n)) for n in sorted(labels)
    ]
    paths = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]
    none = F.array().cast("array<string>")
    return urls.withColumn("rule_host", F.explode(F.array_compact(F.array(*hosts)) if hosts else none)).withColumn(
        "rule_path", F.explode(F.array_compact(F.array(*paths)) if paths else none)
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages`` (page_id, url)."""
    rules = (
        rules.select(
            lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
        )
        .dropna()
        .groupBy("rule_host", "rule_path")
        .agg(F.min("verdict").alias("verdict"))
    )
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = parsed.select("host", "path").distinct()
    possible = (
        _candidates(urls, rules)
        .withColumn("block", _address("rule_host", "rule_path"))
        .join(F.broadcast(bloom_blocks(rules)), "block")
        .where(F.col("bits").bitwiseAND(_mask("rule_host", "rule_path")) == _mask("rule_host", "rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(F.length(rule), F.length("rule_host"))
    judged = (
        possible.join(rules, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(rule.alias("rule"), "verdict"), order).alias("best"))
    )
    return parsed.join(judged, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

ORACLE = (
    r"""
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, verdict) AS (VALUES
"""
    + ",\n".join(f"  ('{h}', '{p}', '{v}')" for h, p, v in RULES)
    + r"""
), fitting AS (
  SELECT host, path,
         max_by({'rule': rule_host || rule_path, 'verdict': verdict},
                length(rule_host || rule_path)) AS best
  FROM (SELECT DISTINCT host, path FROM parsed), rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parsed LEFT JOIN fitting USING (host, path)
"""
)
