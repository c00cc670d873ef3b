"""Alignment of two tokenizers over the same bytes, as an associative monoid (operator 13).

A text is encoded by a byte-level BPE (A) and by a piece vocabulary with byte fallback (B).
Byte offsets where tokens of both end cut their tokens into groups. Each token pair whose
bytes overlap is a link; a pair's count is the number of documents that hold it linked.

* A fragment is what is known of a byte range: the open prefix (tokens up to the first
  common end, as what lies before may belong to the same group), the closed groups, and
  the open suffix (tokens after the last common end). Two neighbouring fragments compose:
  the left suffix and the right prefix join to one group, or stay open where a side has no
  common end. This is associative, so fragments may be composed in any tree.
* A text of at most ``CHUNK`` characters is one range and is aligned where it is read.
* Longer texts are cut where neither tokenizer can tell (before a space after a
  character that is no white space) and the parts encoded in parallel. Their tokens are
  dealt to ranges of ``RANGE`` bytes by where they end, each range becomes a fragment in
  a task of its own, and the fragments of a text are composed ``ARITY`` at a time, level
  by level, by Spark. A text without such a space is encoded in one part.
* Closed groups keep their number, their text and their links as counted pairs, not tokens.
* Documents are counted by pair in each task first, and the counts summed. The table of
  pairs is sent to all tasks if it has at most ``MOST_SENT`` rows; beyond that the
  documents' pairs are joined to it.

Defined results: texts that are NULL, empty, or whose tokens of A or B join to other bytes
than a space and the text have no tokens: all numbers are 0 and the digest is ''. Every row
gives one row and counts as one document, also repeated ones and those without doc_id;
counts that tie for an A id's highest are all the highest. A text of any length is aligned
whole. Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.byte_bpe import portions
from pricelake.llm.common import partitions, received, saved, sent, text_of
from pricelake.llm.pretokens import ByteLevelBpe, read_vocabulary

CHUNK = 32_768
RANGE = 16_384
ARITY = 8
RANGES_A_TASK = 512
MOST_SENT = 2_000_000
COUNTED_AT_ONCE = 4_000_000  # pairs a task counts before it passes the counts on

TOTALS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = f"row long, doc_id long, {TOTALS}, pairs binary, times binary"
_NAMES = ("a", "a_from", "b", "b_from")
_HEAD, _TAIL = ([f"{side}_{name}" for name in _NAMES] for side in ("head", "tail"))
OPEN = "a binary, a_from long, b binary, b_from long"
FRAGMENT = (
    "row long, at long, cut boolean, "
    + ", ".join(f"{side}_{x}" for side in ("head", "tail") for x in OPEN.split(", "))
    + ", n_a long, n_b long, n_groups long, groups binary, pairs binary, times binary"
)
_BREAK = re.compile(r"(?<=\S)\x20")


class Tokens(NamedTuple):
    """Neighbouring tokens of both tokenizers: ids, and byte offsets where they end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray


class Groups(NamedTuple):
    """Closed groups: numbers of tokens and groups, their text, distinct pairs and their links."""

    n_a: int
    n_b: int
    n_groups: int
    text: bytes
    pairs: np.ndarray
    times: np.ndarray


class Fragment(NamedTuple):
    """A byte range; without a common end (not ``cut``) all its tokens are in ``head``."""

    cut: bool
    head: Tokens
    groups: Groups
    tail: Tokens


def joined(parts: list[Tokens]) -> Tokens:
    return Tokens(*map(np.concatenate, zip(*parts, strict=True)))


def _ends(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Offsets where a token ends, in order; 1 where it is one of A, 2 of B, 3 of both."""
    every = [e for e in (tokens.a_ends, tokens.b_ends) if len(e)]
    if not every:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    low = min(e[0] for e in every)
    marks = np.zeros(max(e[-1] for e in every) - low + 1, np.uint8)
    marks[tokens.a_ends - low] = 1
    marks[tokens.b_ends - low] += 2
    at = np.flatnonzero(marks)
    return at + low, marks[at]


class Lengths(NamedTuple):
    """The number of bytes of each token of A and of B, by id."""

    a: np.ndarray
    b: np.ndarray

    @property
    def sizes(self) -> tuple[int, int]:
        return len(self.a), len(self.b)


def pair_kind(a_size: int, b_size: int) -> type:
    """A pair is a_id * b_size + b_id."""
    return np.uint32 if a_size * b_size <= 1 << 32 else np.uint64


class Aligner:
    """Groups and fragments of tokens of two tokenizers."""

    def __init__(self, lengths: Lengths) -> None:
        self.lengths = lengths
        a_size, b_size = lengths.sizes
        self.b_size, self.kind = b_size, pair_kind(a_size, b_size)
        width = len(str(max(a_size, b_size) - 1))
        decimals = np.array([b"%d" % i for i in range(max(a_size, b_size))], f"S{width}")
        self.decimals = decimals.view(np.uint8).reshape(-1, width)
        nothing = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.no_tokens = Tokens(*nothing, *nothing)
        self.no_groups = Groups(0, 0, 0, b"", np.zeros(0, self.kind), np.zeros(0, np.uint32))

    def tokens(self, a: np.ndarray, b: np.ndarray, a_from: int = 0, b_from: int = 0) -> Tokens:
        """Neighbouring tokens; the first of each side begins at a byte offset."""
        a_ends = np.cumsum(self.lengths.a[a], dtype=np.int64) + a_from
        return Tokens(a, a_ends, b, np.cumsum(self.lengths.b[b], dtype=np.int64) + b_from)

    def raw(self, t: Tokens) -> tuple[bytes, int, bytes, int]:
        """The ids of neighbouring tokens as bytes, and where the first of each side begins."""
        a_from = int(t.a_ends[0] - self.lengths.a[t.a[0]]) if len(t.a) else 0
        b_from = int(t.b_ends[0] - self.lengths.b[t.b[0]]) if len(t.b) else 0
        return t.a.tobytes(), a_from, t.b.tobytes(), b_from

    def read(self, a: bytes, a_from: int, b: bytes, b_from: int) -> Tokens:
        return self.tokens(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), a_from, b_from)

    def _text(self, tokens: Tokens, kinds: np.ndarray, group: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of the ids in order."""
        of_a, of_b, last = (kinds & 1) > 0, kinds > 1, kinds == 3
        group_a, group_b, n = group[of_a], group[of_b], int(last.sum())
        count_b = np.bincount(group_b, minlength=n)
        place_a = np.arange(len(group_a)) + (np.cumsum(count_b) - count_b)[group_a]
        place_b = np.arange(len(group_b)) + np.cumsum(np.bincount(group_a, minlength=n))[group_b]
        width = self.decimals.shape[1]
        out = np.empty((len(place_a) + len(place_b), width + 1), np.uint8)
        out[place_a, :width] = self.decimals[tokens.a]
        out[place_b, :width] = self.decimals[tokens.b]
        out[place_a, width] = np.where(last[of_a], ord("|"), ord(","))
        out[place_b, width] = np.where(last[of_b], ord(";"), ord(","))
        flat = out.ravel()
        return flat[flat != 0].tobytes()[:-1]

    def closed(self, tokens: Tokens) -> Groups:
        """The groups of tokens that begin and end at common offsets."""
        at, kinds = _ends(tokens)
        if not len(at):
            return self.no_groups
        both = kinds == 3
        group = np.cumsum(both) - both
        # between two neighbouring ends lies one link
        a = tokens.a[np.cumsum(kinds & 1) - (kinds & 1)].astype(self.kind)
        b = tokens.b[np.cumsum(kinds >> 1) - (kinds >> 1)].astype(self.kind)
        pairs, times = np.unique(a * self.kind(self.b_size) + b, return_counts=True)
        text = self._text(tokens, kinds, group)
        return Groups(
            len(tokens.a), len(tokens.b), int(both.sum()), text, pairs, times.astype(np.uint32)
        )

    def fragment(self, tokens: Tokens) -> Fragment:
        at, kinds = _ends(tokens)
        common = at[kinds == 3]
        if not len(common):
            return Fragment(False, tokens, self.no_groups, self.no_tokens)
        bounds = [
            (0, *np.searchsorted(ends, [common[0], common[-1]], "right"), len(ends))
            for ends in (tokens.a_ends, tokens.b_ends)
        ]
        head, middle, tail = (
            Tokens(
                *(x[bounds[0][i] : bounds[0][i + 1]] for x in tokens[:2]),
                *(x[bounds[1][i] : bounds[1][i + 1]] for x in tokens[2:]),
            )
            for i in range(3)
        )
        return Fragment(True, head, self.closed(middle), tail)

    def merged(self, parts: list[Groups]) -> Groups:
        parts = [p for p in parts if p.n_groups]
        if len(parts) < 2:
            return parts[0] if parts else self.no_groups
        pairs, at = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
        times = np.bincount(at, np.concatenate([p.times for p in parts])).astype(np.uint32)
        numbers = (sum(p[i] for p in parts) for i in range(3))
        return Groups(*numbers, b";".join(p.text for p in parts), pairs, times)

    def composed(self, fragments: list[Fragment]) -> Fragment:
        """Neighbouring fragments as one."""
        head, parts, still = None, [], []
        for f in fragments:
            still.append(f.head)
            if f.cut:
                if head is None:
                    head = joined(still)
                else:
                    parts.append(self.closed(joined(still)))
                parts.append(f.groups)
                still = [f.tail]
        rest = joined(still) if still else self.no_tokens
        if head is None:
            return Fragment(False, rest, self.no_groups, self.no_tokens)
        return Fragment(True, head, self.merged(parts), rest)

    def whole(self, f: Fragment) -> Groups:
        """The groups of a fragment that is a whole text."""
        return self.merged([self.closed(f.head), f.groups])


class Encoders:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, vocabulary: str, pattern: str, model: bytes) -> None:
        self.encode_a = ByteLevelBpe(vocabulary, pattern, plain=True)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = max(self.encode_a.tokens.values()) + 1
        self.bytes_a = [b""] * size
        for raw, rank in self.encode_a.tokens.items():
            self.bytes_a[rank] = raw
        self.bytes_b = [self._piece(i) for i in range(self.model.get_piece_size())]
        lengths = (np.array([len(x) for x in raw], np.int32) for raw in (self.bytes_a, self.bytes_b))
        self.lengths = Lengths(*lengths)
        self.space = self.model.piece_to_id("▁")

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of a text that begins with a space; None if they join to other bytes."""
        a = self.encode_a.ids(text)
        b = self.model.encode(text[1:]) if len(text) > 1 else [self.space]
        raw = text.encode()
        if raw != b"".join([self.bytes_a[i] for i in a]) or raw != b"".join([self.bytes_b[i] for i in b]):
            return None
        return np.array(a, np.uint32), np.array(b, np.uint32)


def parts_of(text: str, chunk: int) -> list[str]:
    """``text``, which begins with a space, cut where neither tokenizer can tell."""
    cuts, at = [0], chunk
    while at < len(text):
        found = _BREAK.search(text, at)
        if not found:
            break
        cuts.append(found.start())
        at = found.start() + chunk
    return [text[a:z] for a, z in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _totals(groups: Groups) -> tuple:
    links = int(groups.times.sum())
    digest = hashlib.sha256(groups.text).hexdigest() if groups.n_groups else ""
    gaps = np.diff(groups.pairs, prepend=groups.pairs.dtype.type(0))
    return groups.n_a, groups.n_b, groups.n_groups, links, digest, gaps.tobytes(), groups.times.tobytes()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _align_short(tools) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoders(*received(tools))
        aligner = Aligner(encode.lengths)
        for batch in batches:
            rows, docs, texts = (c.to_pylist() for c in batch.columns)
            for part in portions(texts):
                out = []
                for row, doc, text in zip(rows[part], docs[part], texts[part], strict=True):
                    ids = encode(" " + text) if text else None
                    groups = aligner.closed(aligner.tokens(*ids)) if ids else aligner.no_groups
                    out.append((row, doc, *_totals(groups)))
                yield _batch(out, ALIGNED)

    return run


PARTS = "row long, doc_id long, place long, text string"


def _part(chunk: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = parts_of(" " + text, chunk)
                for at in range(0, len(parts), 64):
                    some = parts[at : at + 64]
                    yield _batch([(row, doc, at + i, x) for i, x in enumerate(some)], PARTS)

    return run


ENCODED = "row long, doc_id long, place long, same boolean, size long, a binary, b binary"


def _encode_parts(tools) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoders(*received(tools))
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for part in portions(columns[3]):
                out = []
                for row, doc, place, text in zip(*(c[part] for c in columns), strict=True):
                    ids = encode(text)
                    raw = [x.tobytes() for x in ids] if ids else [b"", b""]
                    out.append((row, doc, place, ids is not None, len(text.encode()), *raw))
                yield _batch(out, ENCODED)

    return run


DEALT = f"row long, at long, place long, {OPEN}"


def _deal(lengths, size: int) -> Callable:
    """Tokens of (row, place, base, a, b) by the byte range in which they end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(received(lengths))
        for batch in batches:
            out = []
            for row, place, base, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = aligner.read(a, base, b, base)
                ranges = range(base // size, int(t.a_ends[-1] - 1) // size + 1)
                edges = [k * size for k in ranges] + [(ranges[-1] + 1) * size]
                x, y = (np.searchsorted(ends, edges, "right") for ends in (t.a_ends, t.b_ends))
                for i, k in enumerate(ranges):
                    of_a, of_b = slice(x[i], x[i + 1]), slice(y[i], y[i + 1])
                    some = Tokens(t.a[of_a], t.a_ends[of_a], t.b[of_b], t.b_ends[of_b])
                    out.append((row, k, place, *aligner.raw(some)))
                if len(out) > 256:
                    yield _batch(out, DEALT)
                    out = []
            if out:
                yield _batch(out, DEALT)

    return run


def _row(aligner: Aligner, row: int, at: int, f: Fragment) -> pd.DataFrame:
    g = f.groups
    sides = *aligner.raw(f.head), *aligner.raw(f.tail)
    made = row, at, f.cut, *sides, *g[:4], g.pairs.tobytes(), g.times.tobytes()
    return pd.DataFrame([made], columns=[x.split()[0] for x in FRAGMENT.split(", ")])


def _read(r, aligner: Aligner) -> Fragment:
    head, tail = (aligner.read(*(getattr(r, n) for n in names)) for names in (_HEAD, _TAIL))
    pairs, times = np.frombuffer(r.pairs, aligner.kind), np.frombuffer(r.times, np.uint32)
    return Fragment(r.cut, head, Groups(r.n_a, r.n_b, r.n_groups, r.groups, pairs, times), tail)


def _once(lengths) -> Callable[[], Aligner]:
    """The task's aligner, made when first asked for."""
    made: list[Aligner] = []

    def aligner() -> Aligner:
        if not made:
            made.append(Aligner(received(lengths)))
        return made[0]

    return aligner


def _fragments(lengths) -> Callable:
    aligner = _once(lengths)

    def run(key: tuple, dealt: pd.DataFrame) -> pd.DataFrame:
        dealt = dealt.sort_values("place")
        tokens = joined([aligner().read(*raw) for raw in zip(*(dealt[n] for n in _NAMES), strict=True)])
        return _row(aligner(), *key, aligner().fragment(tokens))

    return run


def _compose(lengths) -> Callable:
    aligner = _once(lengths)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fragments = [_read(r, aligner()) for r in rows.sort_values("at").itertuples()]
        return _row(aligner(), *key, aligner().composed(fragments))

    return run


WHOLE = f"row long, {TOTALS}, pairs binary, times binary"


def _finish(lengths) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(received(lengths))
        for batch in batches:
            for r in batch.itertuples():
                found = (r.row, *_totals(aligner.whole(_read(r, aligner))))
                yield _batch([found], WHOLE).to_pandas()

    return run


def _align_long(texts: DataFrame, tools, lengths, chunk: int, size: int, arity: int) -> DataFrame:
    """ALIGNED of texts of more than ``chunk`` characters."""
    parts = texts.mapInArrow(_part(chunk), PARTS)
    encoded = saved(
        parts.repartition("row", "place").mapInArrow(_encode_parts(tools), ENCODED), "encoded"
    )
    of_row = Window.partitionBy("row")
    before = of_row.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # a window over a few numbers for each part; their tokens are joined to it
    bases = encoded.select("row", "place", "same", "size").select(
        "row",
        "place",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
        F.min("same").over(of_row).alias("same"),
    )
    dealt = (
        encoded.select("row", "place", "a", "b")
        .join(bases.where("same").drop("same"), ["row", "place"])
        .select("row", "place", "base", "a", "b")
        .mapInArrow(_deal(lengths, size), DEALT)
    )
    sizes = encoded.groupBy("row").agg(F.sum("size").alias("n"))
    sums = sizes.agg(F.max("n").alias("most"), F.sum(F.ceil(F.col("n") / size)).alias("ranges")).first()
    tasks = partitions(texts.sparkSession, int(sums["ranges"] or 0), RANGES_A_TASK)
    found = (
        dealt.repartition(tasks, "row", "at")
        .groupBy("row", "at")
        .applyInPandas(_fragments(lengths), FRAGMENT)
    )
    ranges = -(-int(sums["most"] or 0) // size)
    while ranges > 1:
        # the fragments that are composed hold as much text as before
        found = (
            found.withColumn("to", F.floor(F.col("at") / arity))
            .repartition(tasks, "row", "to")
            .groupBy("row", "to")
            .applyInPandas(_compose(lengths), FRAGMENT)
        )
        ranges = -(-ranges // arity)
    whole = found.mapInPandas(_finish(lengths), WHOLE)
    numbers = [F.coalesce(n, F.lit(0)).alias(n) for n in ("n_a", "n_b", "n_groups", "n_links")]
    rest = [F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    rest += [F.coalesce(n, F.lit(b"")).alias(n) for n in ("pairs", "times")]
    rows = encoded.where("place = 0").select("row", "doc_id")
    return rows.join(whole, "row", "left").select("row", "doc_id", *numbers, *rest)


def _distinct(gaps: bytes, kind: type) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, kind), dtype=kind)


def _count(kind: type) -> Callable:
    """How many documents of this task hold each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            at = np.concatenate(held) if held else np.zeros(0, kind)
            pairs, n = np.unique(at, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"]
            )

        held, total = [], 0
        for batch in batches:
            for gaps in batch.column(0).to_pylist():
                held.append(_distinct(gaps, kind))
                total += len(held[-1])
                if total > COUNTED_AT_ONCE:
                    yield counted()
                    held, total = [], 0
        yield counted()

    return run


def pair_counts(aligned: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """(pair, n, best): documents that hold a pair; best if no pair of its A id has more."""
    kind = pair_kind(*sizes)
    counts = (
        aligned.select("pairs")
        .mapInArrow(_count(kind), "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    # an A id has at most as many pairs as B has pieces
    of_a = Window.partitionBy(F.floor(F.col("pair") / sizes[1]))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _judge(counts, kind: type) -> Callable:
    """Adds n_best and count_sum to rows whose last columns are pairs and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = received(counts)
        for batch in batches:
            bests, sums = [], []
            for gaps, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = np.searchsorted(pair, _distinct(gaps, kind))
                times = np.frombuffer(raw, np.uint32).astype(np.int64)
                bests.append(int(times[best[at]].sum()))
                sums.append(int((times * n[at]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(bests, pa.int64()), pa.array(sums, pa.int64())],
                names=[*batch.schema.names[2:], "n_best", "count_sum"],
            )

    return run


def _one_by_one(kind: type) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, gaps, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs = _distinct(gaps, kind).astype(np.int64)
                times = np.frombuffer(raw, np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), row)), pa.array(pairs), pa.array(times)],
                    names=["row", "pair", "times"],
                )

    return run


def align(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    model_path: str,
    chunk: int = CHUNK,
    size: int = RANGE,
    arity: int = ARITY,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    ``docs`` (doc_id, text) must be a table on disk. ``n_best`` counts the links whose pair
    has the highest count of its A id, ``count_sum`` is the sum of the counts of all links.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as file:
        tools = read_vocabulary(vocabulary_path), pattern, file.read()
    encoders = Encoders(*tools)
    lengths = sent(spark, encoders.lengths)
    sizes = encoders.lengths.sizes
    kind = pair_kind(*sizes)
    if any(re.search("[^▁]▁", encoders.model.id_to_piece(i)) for i in range(sizes[1])):
        raise ValueError("pieces that hold a space after another character can't be cut at spaces")
    tools = sent(spark, tools)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    )
    short = rows.where(F.length("text") <= chunk).mapInArrow(_align_short(tools), ALIGNED)
    long = _align_long(rows.where(F.length("text") > chunk), tools, lengths, chunk, size, arity)
    aligned = saved(short.union(long), "aligned")
    counts = saved(pair_counts(aligned, sizes), "counts")
    totals = [x.split()[0] for x in TOTALS.split(", ")]
    columns = ["doc_id", *totals[:-1], "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= most_sent:
        table = counts.orderBy("pair").toPandas()
        pair, n, best = (table[c].to_numpy() for c in ("pair", "n", "best"))
        counted = sent(spark, (pair.astype(kind), n.astype(np.int64), best.astype(bool)))
        judged = aligned.select("pairs", "times", "doc_id", *totals).mapInArrow(
            _judge(counted, kind), f"doc_id long, {TOTALS}, n_best long, count_sum long"
        )
        return judged.select(*columns)
    pairs = aligned.select("row", "pairs", "times").mapInArrow(
        _one_by_one(kind), "row long, pair long, times long"
    )
    sums = (
        pairs.join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    judged = aligned.drop("pairs", "times").join(sums, "row", "left")
    return judged.fillna(0, ["n_best", "count_sum"]).select(*columns)
