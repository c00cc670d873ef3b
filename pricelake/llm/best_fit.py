"""Bounded-space online best-fit packing into training sequences (operator 12).

Each document becomes its token ids and an end id. Documents of more than a window of
2,048 tokens are cut into whole windows and a rest; no other document is cut.

* Whole windows are sequences of their own. Tokens are counted and checksummed where the
  text is read; only a few numbers for each piece travel on.
* All other pieces are dealt to tasks by a hash of their place. A task holds at most
  ``OPEN_BINS`` open bins, in a bitset keyed by free space: a piece goes to the open bin
  with the least room that holds it, which is the lowest bit from its size on. If none
  has room it opens a new bin, and if that is one too many the fullest bin closes.
* The order in which pieces arrive is the packer's own choice: in random blocks of
  ``BLOCK``, each from long to short. Long pieces then open bins that shorter ones of the
  same and of later blocks fill. Memory depends on ``OPEN_BINS`` only; pieces stream
  through, and Spark sorts them on disk.

A retried task deals, sorts and packs alike, as the order is total.

Defined results: NULL text is empty and packs its end id only. Every row is packed, also
repeated ones, each by itself, and those without doc_id; equal pieces go by their place
in the table. A text of any length is encoded whole, in portions cut at white space,
where this vocabulary parts words anyway. Other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.byte_bpe import TEXT_AT_ONCE, portions
from pricelake.llm.common import saved, text_of
from pricelake.llm.pretokens import WordBpe, read_vocabulary

WINDOW = 2048
END_ID = 0
OPEN_BINS = 4096
BLOCK = 4096
PIECES_A_TASK = 16_384

TOKENS = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES = f"{TOKENS}, sequence_id long, offset long"
_BREAK = re.compile(r"(?<=\S)[\t-\r ]")


def cut_at_space(text: str, size: int) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut before white space."""
    cuts, at = [0], size
    while at < len(text):
        found = _BREAK.search(text, at)
        if not found:
            break
        cuts.append(found.start())
        at = found.start() + size
    return [text[a:z] for a, z in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def document_ids(encode: WordBpe, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text and its end id."""
    parts = [cut_at_space(text, TEXT_AT_ONCE) for text in texts]
    if len(texts) == 1:  # a very long one, part by part
        ids = [x for part in parts[0] for x in encode(pa.array([part]))]
    else:
        ids = encode(pa.array([part for some in parts for part in some], pa.string()))
    ends = np.cumsum([len(some) for some in parts])
    last = np.array([END_ID], np.uint32)
    return [
        np.concatenate([*ids[end - len(some) : end], last]) for end, some in zip(ends, parts, strict=True)
    ]


def _tokenize(vocabulary, window: int) -> Callable:
    """The pieces of each document: place in its ids, length and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordBpe(vocabulary.value)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in portions(texts):
                ids = document_ids(encode, texts[part])
                counts = np.array([-(-len(x) // window) for x in ids])
                starts = [a for x in ids for a in range(0, len(x), window)]
                pieces = [x[a : a + window] for x in ids for a in range(0, len(x), window)]
                owner = np.repeat(np.arange(part.start, part.stop), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(owner)),
                        pa.array([a // window for a in starts], pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) for x in pieces], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4")) for x in pieces], pa.int64()),
                    ],
                    names=[x.split()[0] for x in TOKENS.split(", ")],
                )

    return run


class Bins:
    """Open bins of one task by their free space; at most ``most`` of them."""

    def __init__(self, window: int, most: int) -> None:
        self.window, self.most = window, most
        self.levels: list[list[int]] = [[] for _ in range(window + 1)]
        self.bits = 0  # of the levels that hold a bin
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        bin_ = self.levels[free].pop()
        if not self.levels[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return bin_

    def _lowest(self, least: int) -> int:
        """The least free space of an open bin that is ``least`` or more; -1 if there is none."""
        rest = self.bits >> least
        return least + (rest & -rest).bit_length() - 1 if rest else -1

    def put(self, size: int) -> tuple[int, int]:
        """The bin of a piece, and its offset there."""
        free = self._lowest(size)
        if free >= 0:
            bin_ = self._take(free)
        else:
            if self.open == self.most:
                self._take(self._lowest(0))  # the fullest closes
            bin_, free = self.opened, self.window
            self.opened += 1
        left = free - size
        if left:
            self.levels[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.window - free


def _pack(window: int, most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(window, most)
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            put = [bins.put(size) for size in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([first + bin_ for bin_, _ in put], pa.int64()),
                    pa.array([offset for _, offset in put], pa.int64()),
                ],
                names=[x.split()[0] for x in PIECES.split(", ")],
            )

    return run


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    window: int = WINDOW,
    open_bins: int = OPEN_BINS,
    pieces_a_task: int = PIECES_A_TASK,
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text), with their sequences: see PIECES.

    ``ids_crc32`` is the CRC-32 of the piece's ids as little-endian 32-bit numbers,
    ``start`` its first id's place in the document, ``offset`` that in the sequence.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    tokens = saved(
        rows.mapInArrow(_tokenize(vocabulary, window), TOKENS).withColumn(
            "place", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    names = [x.split()[0] for x in TOKENS.split(", ")]
    whole = tokens.where(F.col("length") == window).select(
        *names, (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = tokens.where(F.col("length") < window)
    tasks = max(1, -(-short.count() // pieces_a_task))
    blocks = max(1, -(-pieces_a_task // BLOCK))
    packed = (
        short.repartition(tasks, F.xxhash64("place"))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(1), "place"), F.lit(blocks)))
        .sortWithinPartitions("block", F.desc("length"), "place")
        .select(*names)
        .mapInArrow(_pack(window, open_bins), PIECES)
    )
    return whole.union(packed)
