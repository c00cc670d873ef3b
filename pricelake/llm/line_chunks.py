"""Line dedup by content-defined chunks (operator 5).

* A text is split into units that join to it byte by byte: lines, each with the blank ones
  that follow; of a line of more than ``LONG`` characters its sentences, and of a sentence
  that long its clauses. Units are compared without white space around them.
* Units are hashed, and a rolling hash over two neighbouring unit hashes decides where a
  chunk begins: where it is divisible by ``MEAN``. A chunk ends with the unit at which the
  next one begins, so it has two units at least, and chunks overlap by one. What begins a
  chunk depends on its own first two units only, so a passage that several texts hold is
  cut alike in all of them, whatever stands around it.
* With ``MEAN`` = 1 every unit but a text's last begins a chunk. Larger values make fewer
  chunks, but miss passages that hold fewer than two beginnings (figures in the README).
* Chunks are counted by hash over all texts, on the map side first. Texts of chunks whose
  hash repeats are compared byte by byte: they are grouped by their whole text. The first
  occurrence, by doc_id and then place, stays; the units of all others are removed.

The first text with a unit keeps it: whatever is removed is still there earlier. Two short
sentences of one line are no passage: a chunk whose first unit does not end its line has
``LEAST`` characters or more in its first and last unit. A chunk that a third of all texts hold costs one row a task in the
counts and in the search for the first one; its occurrences are joined, and adaptive
execution splits that.

With ``spare`` a text is left whole if that share of its chunks repeats in one other text:
a copy of a document is for an operator that compares documents, which a cut copy would
pass.

Only DataFrame functions run here. Defined results: NULL text stays NULL, empty text
stays empty; a text may become empty. A text of one unit stays. Rows are told apart by
place, so of rows that repeat one keeps its chunks; rows without doc_id come last. Texts of
any length are split whole. Where what is removed ended a line, its end stays if the line
had other units. All rows and columns stay, whatever their names, and n_chars,
where there, follows the text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import saved

MEAN = 1
LONG = 240
LEAST = 50

# Places to split at: before a line that is not blank, after a sentence, after a clause.
_LINES = r"(?<=\n)(?=[^\S\n]*\S)"
_SENTENCES = r"(?<=[.!?]\s)(?=\S)"
_CLAUSES = r"(?<=[,;:]\s)(?=\S)"
_WHITE = " \t\n\r\x0b\x0c"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _split_long(texts: Column, *patterns: str) -> Column:
    """Texts of more than LONG characters split by the first pattern, what is still long by the next."""
    if not patterns:
        return texts

    def parts(text: Column) -> Column:
        return F.when(
            F.length(text) > LONG, _split_long(F.split(text, patterns[0]), *patterns[1:])
        ).otherwise(F.array(text))

    return F.flatten(F.transform(texts, parts))


def units_of(text: Column) -> Column:
    return _split_long(F.split(text, _LINES), _SENTENCES, _CLAUSES)


def _bare(unit: Column) -> Column:
    return F.trim(unit, F.lit(_WHITE))


def chunks_of(docs: DataFrame, mean: int) -> DataFrame:
    """(row, from, to, hash) of every chunk: its first and last unit and its hash."""

    def of_units(units: Column) -> Column:
        hashes = F.transform(units, lambda u: F.xxhash64(_bare(u)))
        return let(hashes, lambda h: of_hashes(units, h))

    def of_hashes(units: Column, hashes: Column) -> Column:
        last = F.size(units) - 1
        rolling = lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1))
        begins = F.sequence(F.lit(0), last - 1)
        if mean > 1:
            begins = F.filter(begins, lambda i: F.pmod(rolling(i), F.lit(mean)) == 0)
        begins = F.when(last > 0, begins).otherwise(F.array().cast("array<int>"))
        return let(begins, lambda b: of_begins(units, hashes, last, b))

    def of_begins(units: Column, hashes: Column, last: Column, begins: Column) -> Column:
        def end(begin: Column, k: Column) -> Column:
            return begin + 1 if mean == 1 else F.coalesce(F.get(begins, k + 1), last)

        def chunk(begin: Column, k: Column) -> Column:
            to = end(begin, k)
            if mean == 1:
                hash_ = F.xxhash64(F.get(hashes, begin), F.get(hashes, to))
            else:
                hash_ = F.xxhash64(F.slice(hashes, begin + 1, to - begin + 1))
            first = F.get(units, begin)
            long = F.length(first) + F.length(F.get(units, to)) >= LEAST
            counts = (F.get(hashes, begin) != F.xxhash64(F.lit(""))) & (first.endswith("\n") | long)
            return F.struct(begin.alias("from"), to.alias("to"), hash_.alias("hash"), counts.alias("counts"))

        return F.filter(F.transform(begins, chunk), lambda c: c["counts"])

    return docs.select("row", F.explode(let(units_of(F.col("text")), of_units)).alias("c")).select(
        "row", "c.from", "c.to", "c.hash"
    )


def repeated_chunks(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """(row, from, to, source): the chunks of (row, doc_id, text) that an earlier row, ``source``, holds."""
    often = chunks.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    places = saved(
        chunks.join(often, "hash", "left_semi")
        .groupBy("row")
        .agg(F.collect_list(F.struct("from", "to", "hash")).alias("places")),
        "places",
    )

    def texts(units: Column) -> Column:
        return F.transform(
            "places",
            lambda p: F.struct(
                p["from"].alias("from"),
                p["to"].alias("to"),
                p["hash"].alias("hash"),
                F.array_join(
                    F.transform(F.slice(units, p["from"] + 1, p["to"] - p["from"] + 1), _bare), "\n"
                ).alias("chunk"),
            ),
        )

    again = saved(
        docs.join(places, "row")
        .select("row", "doc_id", F.explode(let(units_of(F.col("text")), texts)).alias("c"))
        .select("row", "doc_id", "c.*"),
        "repeated",
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row", "from")
    # the whole text is part of the key: equal hashes alone remove nothing
    first = again.groupBy("hash", "chunk").agg(F.min(order).alias("first"))
    return (
        again.join(first, ["hash", "chunk"])
        .where((F.col("row") != F.col("first.row")) | (F.col("from") != F.col("first.from")))
        .select("row", "from", "to", F.col("first.row").alias("source"))
    )


def _copies(later: DataFrame, chunks: DataFrame, share: float) -> DataFrame:
    """(row) of which ``share`` of the chunks repeats in one other row."""
    most = (
        later.where("source <> row")
        .groupBy("row", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("row")
        .agg(F.max("n").alias("n"))
    )
    sizes = chunks.groupBy("row").agg(F.count(F.lit(1)).alias("all"))
    return most.join(sizes, "row").where(F.col("n") >= F.lit(share) * F.col("all")).select("row")


def _without(units: Column, gone: Column) -> Column:
    """The text of units without those at the places ``gone``."""

    def joined(kept: Column) -> Column:
        def unit(at: Column, k: Column) -> Column:
            here, then = F.get(units, at), F.get(kept, k + 1)
            ended = F.exists(F.slice(units, at + 2, then - at - 1), lambda u: u.endswith("\n"))
            return F.when(~here.endswith("\n") & ended, F.concat(here, F.lit("\n"))).otherwise(here)

        return F.array_join(F.transform(kept, unit), "")

    return let(F.array_except(F.sequence(F.lit(0), F.size(units) - 1), gone), joined)


def dedup_lines(docs: DataFrame, mean: int = MEAN, spare: float | None = None) -> DataFrame:
    """``docs`` without chunks that an earlier text holds. Must be a table on disk."""
    row = "_".join(["row", *docs.columns])  # clashes with none of them
    gone = f"{row}_gone"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    keyed = numbered.where("text is not null").select(
        F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    chunks = saved(chunks_of(keyed, mean), "chunks")
    later = repeated_chunks(keyed, chunks)
    if spare is not None:
        later = saved(later, "later")
        later = later.join(_copies(later, chunks, spare), "row", "left_anti")
    units = saved(
        later.select("row", F.explode(F.sequence("from", "to")).alias("unit"))
        .groupBy("row")
        .agg(F.collect_set("unit").alias("units"))
        .toDF(row, gone),
        "units",
    )
    same = F.col(gone).isNull()
    kept = let(units_of(F.col("text")), lambda u: _without(u, F.col(gone)))
    changed = numbered.join(units, row, "left").withColumn(
        "text", F.when(same, F.col("text")).otherwise(kept)
    )
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(length))
    return changed.select(*docs.columns)
