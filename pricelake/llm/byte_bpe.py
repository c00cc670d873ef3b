"""Byte-level BPE encoding and decoding by overlapping chunks (operator 8).

A text is encoded as the vocabulary's own library would encode it whole, however long
it is. Pre-tokens are found from left to right, each depending on the text from its
start on only, so two scans that share one boundary agree from there on. That allows
long texts to be cut:

1. A text beyond ``chunk`` characters becomes overlapping chunks, dealt over the
   cluster and pre-tokenised in parallel, each from its own first character.
2. Neighbouring chunks are stitched at the first boundary that both found inside their
   overlap. Boundaries of the left chunk that its end could have caused do not count.
   Where no boundary is shared (a run of one class longer than the overlap), the rest
   of that text stays one piece, so the result is exact for any input.
3. Pieces between stitches are encoded in parallel and put together by place.

Texts of one chunk are encoded where they are read, without an exchange. Decoding
concatenates the raw bytes of the ids.

Defined results: NULL text is encoded as empty, which gives no ids. Every row gives one
row, also repeated ones and those without doc_id. Texts of any length are encoded whole.
Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import saved, text_of

CHUNK = 32_768
OVERLAP = 1_024
MARGIN = 8  # characters before a chunk's end in which a boundary may be due to that end
TEXT_AT_ONCE = 4_000_000  # characters a task encodes before it passes the ids on


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "ranks",
        pat_str=pattern,
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
        special_tokens={},
    )


def encode(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    return np.asarray(bpe.encode_ordinary(text), np.int32)


def portions(texts: list[str]) -> Iterator[slice]:
    """Slices of a batch with a bounded number of characters (one text at least)."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > TEXT_AT_ONCE:
            yield slice(begin, i)
            begin, total = i, 0
        total += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _encoder(ranks, pattern: str, decode: bool) -> Callable:
    """Batches of (keys..., text) as (keys..., ids[, decoded])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            keys, names = batch.columns[:-1], batch.schema.names[:-1]
            for part in portions(texts):
                ids = [encode(bpe, text) for text in texts[part]]
                columns = [k.slice(part.start, part.stop - part.start) for k in keys]
                columns.append(lists(ids, pa.int32()))
                if decode:
                    raw = [bpe.decode_bytes(x.tolist()) for x in ids]
                    columns.append(pa.array(raw, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "decoded"][: len(columns)])

    return run


def _decoder(ranks, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks.value, pattern)
        for batch in batches:
            raw = [bpe.decode_bytes(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(raw, pa.binary())],
                names=[*batch.schema.names[:-1], "decoded"],
            )

    return run


def _chunker(chunk: int, overlap: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begins = range(0, max(1, len(text) - overlap), chunk - overlap)
                for at in range(0, len(begins), 64):
                    some = begins[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(some), pa.int64()),
                            pa.array([doc_id] * len(some), pa.int64()),
                            pa.array(range(at, at + len(some)), pa.int64()),
                            pa.array(some, pa.int64()),
                            pa.array([text[b : b + chunk] for b in some], pa.string()),
                        ],
                        names=["row", "doc_id", "k", "begin", "text"],
                    )

    return run


def _boundaries(pattern: str, chunk: int, overlap: int) -> Callable:
    """Adds the places of the boundaries found in the first and the last overlap of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            head, tail = [], []
            for begin, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                starts = np.fromiter((m.start() for m in compiled.finditer(text)), np.int64)
                head.append(begin + starts[starts < overlap])
                sure = (starts >= chunk - overlap) & (starts < len(text) - MARGIN)
                tail.append(begin + starts[sure])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists(head, pa.int64()), lists(tail, pa.int64())],
                names=[*batch.schema.names, "head", "tail"],
            )

    return run


def long_pieces(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, place, text): each text of ``docs`` cut where chunks resynchronise."""
    chunks = docs.mapInArrow(
        _chunker(chunk, overlap), "row long, doc_id long, k long, begin long, text string"
    ).repartition("row", "k")
    found = saved(
        chunks.mapInArrow(
            _boundaries(pattern, chunk, overlap),
            "row long, doc_id long, k long, begin long, text string, head array<long>, tail array<long>",
        ),
        "chunks",
    )
    by_place = Window.partitionBy("row").orderBy("k")
    so_far = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    shared = F.array_min(F.array_intersect("tail", F.lead("head").over(by_place)))
    # a cut counts only if all cuts before it were found: else its chunk never resynchronised
    places = (
        found.select("row", "k", "head", "tail")
        .withColumn("shared", shared)
        .withColumn("cut", F.when(F.min(F.col("shared").isNotNull()).over(so_far), F.col("shared")))
        .withColumn("place", F.count("cut").over(before))
        .withColumn("from", F.coalesce(F.max("cut").over(before), F.lit(0)))
        .select("row", "k", "place", "from", "cut")
    )
    chunks_of = F.sort_array(F.collect_list(F.struct("k", "begin", "text")))
    joined = F.aggregate(
        F.slice("chunks", 2, F.greatest(F.size("chunks") - 1, F.lit(0))),
        F.col("chunks")[0]["text"],
        lambda whole, c: F.concat(whole, F.substring(c["text"], F.lit(overlap + 1), F.length(c["text"]))),
    )
    first = F.col("chunks")[0]["begin"]
    length = F.when(F.col("cut").isNull(), F.length("whole")).otherwise(F.col("cut") - F.col("from"))
    return (
        found.select("row", "doc_id", "k", "begin", "text")
        .join(places, ["row", "k"])
        .groupBy("row", "place")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("from").alias("from"),
            F.max("cut").alias("cut"),
            chunks_of.alias("chunks"),
        )
        .withColumn("whole", joined)
        .select(
            "row",
            "doc_id",
            "place",
            F.substring(
                "whole", (F.col("from") - first + 1).cast("int"), length.cast("int")
            ).alias("text"),
        )
    )


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decode: bool = False,
) -> DataFrame:
    """(doc_id, ids array<int>[, decoded binary]) of each row of ``docs`` (doc_id, text).

    ``decoded`` is what the ids decode to. ``docs`` must be a table on disk.
    """
    if overlap <= MARGIN or chunk < 2 * overlap:
        raise ValueError(f"an overlap of {overlap} in chunks of {chunk} characters can't be stitched")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    run = _encoder(ranks, pattern, decode)
    ids = "ids array<int>" + ", decoded binary" * decode
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    )
    short = rows.where(F.length("text") <= chunk).select("doc_id", "text")
    pieces = long_pieces(rows.where(F.length("text") > chunk), pattern, chunk, overlap)
    encoded = pieces.mapInArrow(run, f"row long, doc_id long, place long, {ids}")
    in_order = F.sort_array(F.collect_list(F.struct("place", "ids", *["decoded"] * decode)))
    whole = encoded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), in_order.alias("p"))
    columns = ["doc_id", F.flatten("p.ids").alias("ids")]
    if decode:
        columns.append(F.unhex(F.array_join(F.transform("p.decoded", F.hex), "")).alias("decoded"))
    return short.mapInArrow(run, f"doc_id long, {ids}").union(whole.select(*columns))


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of rows (doc_id, ids); NULL ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _decoder(ranks, pattern), "doc_id long, decoded binary"
    )


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows (doc_id, ids, decoded)."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
