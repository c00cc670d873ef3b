"""Lexical retrieval packing into training sequences (operator 6).

Each document becomes its token ids and an end id. Ids fill windows of 1,024 tokens:

* A document's full windows are sequences of their own; what is left, less than a
  window, is its tail. The terms of a document are its different ids, those of its full
  windows too, with their frequencies.
* Documents are dealt by content into shards of at most ``SHARD_DOCS`` documents.
  ``ROUNDS`` times each document draws one of its terms, the rarer the likelier and alike
  for all (a weighted minimum hash), so documents that share much draw the same term.
  Those that drew a term in the same round form a bucket; the bucket of a term that very
  many drew is parted by what its documents drew in the next rounds. A document goes where
  the other one is that shares most of its ``SKETCH`` rarest terms, of all it met.
* A shard is an inverted index over the terms of its documents, weighted by BM25 with
  document frequencies and lengths counted over the corpus.
* The document with the longest tail that is not used up is a seed. All its terms retrieve unused
  neighbours, best first (equal scores by place), which greedily fill its window; the last
  one is cut at the window's end and what is left of it stays in the index. Where retrieval
  finds too few, unused tails follow by length (equal lengths by place).
* What remains of a shard after its last full window is cut into sequences whose
  lengths are powers of two, so no sequence needs padding.

A task holds one shard, or one bucket of documents that drew the same term. Only numbers
for each id of the vocabulary are broadcast. Whether two documents that share little meet
is left to chance; those of one shard are found.

Ids are those of the vocabulary's own library, see ``pretokens``.

Defined results: NULL text is empty and packs its end id only. Every row is packed,
also repeated ones and those without doc_id. Texts of any length are encoded whole, and all
their terms are indexed. Other columns are ignored, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.byte_bpe import portions
from pricelake.llm.common import partitions, saved, text_of
from pricelake.llm.pretokens import ByteLevelBpe, read_vocabulary

WINDOW = 1024
END_ID = 0
SHARD_DOCS = 512
ROUNDS = 6  # draws of a term by which documents meet
SKETCH = 24  # rarest terms by which a document chooses among those it met
BUCKET = 128  # documents of a bucket that are compared with each other
AT_ONCE = 4096  # documents of buckets that a task compares at once
K1, B = 1.2, 0.75
DENSE = 8  # terms that one in so many documents of a shard holds are kept as whole rows

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_TOKENS = "doc_id long, doc_tokens long, sums array<long>, tail binary, terms binary, times binary"


def id_kind(size: int) -> type:
    """What ids of a vocabulary are kept as."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a document, whose end id is none, and how often each occurs."""
    terms, times = counted_each([ids])
    return terms[0], times[0]


def counted_each(docs: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The terms of each document, and how often each of them occurs in it."""
    if not docs:
        return [], []
    terms = [np.sort(x[:-1], kind="stable") for x in docs]  # 16-bit numbers are sorted by radix
    ends = np.cumsum([len(x) for x in terms])
    terms = np.concatenate(terms)
    begin = np.concatenate([[0], ends[:-1]])
    new = np.ones(len(terms), bool)
    np.not_equal(terms[1:], terms[:-1], out=new[1:])
    new[begin[begin < ends]] = True
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(terms)))
    terms, cuts = terms[first], np.searchsorted(first, np.append(begin, len(new))).tolist()
    own = [slice(a, z) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
    return [terms[x] for x in own], [times[x] for x in own]


def kept_times(times: np.ndarray) -> bytes:
    return times.astype(np.uint16 if times.max(initial=0) < 1 << 16 else np.uint32).tobytes()


def read_times(raw: bytes, terms: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * terms else np.uint32)


def _tokenize(vocabulary, pattern: str, window: int) -> Callable:
    """Each document's length, the checksums of its full windows, its tail's ids, its terms.

    A document without full windows has its terms in its tail, so only their ids are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteLevelBpe(vocabulary.value, pattern)
        kind, end = id_kind(encode.size), np.array([END_ID], np.uint32)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in portions(texts):
                ids = [np.concatenate([encode(text), end]) for text in texts[part]]
                full = [len(x) // window * window for x in ids]
                sums = [
                    [zlib.crc32(x[a : a + window]) for a in range(0, n, window)]
                    for x, n in zip(ids, full, strict=True)
                ]
                kept = [x.astype(kind) for x in ids]
                terms, times = counted_each(kept)
                times = [kept_times(t) if n else b"" for t, n in zip(times, full, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(part.start, part.stop - part.start),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array(sums, pa.list_(pa.int64())),
                        pa.array([x[n:].tobytes() for x, n in zip(kept, full, strict=True)], pa.binary()),
                        pa.array([t.tobytes() for t in terms], pa.binary()),
                        pa.array(times, pa.binary()),
                    ],
                    names=[x.split()[0] for x in _TOKENS.split(", ")],
                )

    return run


def _frequencies(kind: type) -> Callable:
    """In how many documents of this task each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(found) > len(counts):
                counts = np.pad(counts, (0, len(found) - len(counts)))
            counts[: len(found)] += found
        terms = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int64()), pa.array(counts[terms], pa.int64())], names=["term", "docs"]
        )

    return run


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint32)


def _draws(idf: np.ndarray, df: np.ndarray) -> np.ndarray:
    """For each round and term a number, least for the one that is drawn; infinite if one document holds it."""
    u = np.random.default_rng(0).random((ROUNDS, len(idf)))
    return np.where(df >= 2, -np.log(u) / np.maximum(idf, 1e-9) ** 2, np.inf).astype(np.float32)


_ROUTES = "place long, drawn binary, sketch binary"


def _routes(idf, draws, kind: type) -> Callable:
    """Of each document the terms it draws, and its rarest terms among those that others hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = draws.value
        shared = np.isfinite(order[0])
        rarest = np.argsort(-idf.value, kind="stable").astype(np.uint32)
        rank = np.empty_like(rarest)
        rank[rarest] = np.arange(len(rarest), dtype=np.uint32)
        for batch in batches:
            out = []
            for place, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = np.frombuffer(raw, kind).astype(np.uint32)
                terms = terms[shared[terms]]
                if len(terms):
                    drawn = terms[order.take(terms, axis=1).argmin(axis=1)]
                    rare = rank[terms]
                    if len(rare) > SKETCH:
                        rare = np.partition(rare, SKETCH)[:SKETCH]
                    out.append((place, drawn.tobytes(), np.sort(rarest[rare]).tobytes()))
            columns = zip(*out, strict=True) if out else [[], [], []]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["place", "drawn", "sketch"],
            )

    return run


def _drawn_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(round * 2**32 + term, n): how many documents of this task drew a term in a round."""
    keys = [np.zeros(0, np.int64)]
    for batch in batches:
        drawn = [_ids(x) for x in batch.column(0).to_pylist()]
        if drawn:
            every = np.concatenate(drawn).astype(np.int64).reshape(-1, ROUNDS)
            keys.append((every + (np.arange(ROUNDS) << 32)).ravel())
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])


def _mixed(*parts: np.ndarray) -> np.ndarray:
    x = np.full(len(parts[0]), 7, np.uint64)
    for part in parts:
        x = (x ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x


def _buckets(often) -> Callable:
    """(bucket, place, sketch) of each document for each round.

    A term that more than a bucket's documents drew is parted by the next round's draw, one
    that very many drew by two more, and so that the documents of one bucket fit a task
    whatever they drew, by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = often.value
        for batch in batches:
            place = batch.column(0).to_numpy()
            if not len(place):
                continue
            drawn = np.stack([_ids(x) for x in batch.column(1).to_pylist()]).astype(np.int64)
            for k in range(ROUNDS):
                key = drawn[:, k] + (k << 32)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                n = np.where(keys[at] == key, counts[at], 0) if len(keys) else np.zeros(len(key), np.int64)
                parts = [np.full(len(key), k), drawn[:, k]]
                for more, least in ((1, BUCKET), (2, 16 * BUCKET)):
                    parts.append(np.where(n > least, drawn[:, (k + more) % ROUNDS] + 1, 0))
                room = np.maximum(1, n // (64 * BUCKET))
                parts.append((_mixed(place) % room.astype(np.uint64)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mixed(*parts).view(np.int64)), batch.column(0), batch.column(2)],
                    names=["bucket", "place", "sketch"],
                )

    return run


def best_shares(chunk: np.ndarray, sketches: list[bytes], idf: np.ndarray) -> np.ndarray:
    """How much of its terms' weight each document shares with the best other one of its chunk.

    Chunks, of at most ``BUCKET`` documents each, follow one another.
    """
    n = len(chunk)
    terms = _ids(b"".join(sketches)).astype(np.int64)
    owner = np.repeat(np.arange(n), [len(x) // 4 for x in sketches])
    number = np.cumsum(np.concatenate([[0], chunk[1:] != chunk[:-1]]))
    start = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))[number]
    key = number[owner] * len(idf) + terms
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    # of each term's documents in a chunk each one with all
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    begin, width = np.repeat(first, size), np.repeat(size, size)
    last = np.cumsum(width)
    total = int(last[-1]) if len(last) else 0
    right = owner[np.arange(total) + np.repeat(begin - (last - width), width)]
    left = np.repeat(owner, width)
    weight = np.repeat(idf[terms[order]], width)
    place = np.arange(n) - start
    shared = np.bincount(left * BUCKET + place[right], weight, n * BUCKET).reshape(n, BUCKET)
    own = np.sqrt(shared[np.arange(n), place])
    shared[np.arange(n), place] = 0
    others = own[np.minimum(start[:, None] + np.arange(BUCKET), n - 1)]
    return (shared / np.maximum(own[:, None] * others, 1e-30)).max(axis=1)


def _links(idf) -> Callable:
    """Each document of a bucket with the share of the one of that bucket that it shares most with."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        place, sketch, bucket = (rows[c].to_numpy() for c in ("place", "sketch", "bucket"))
        n = len(rows)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        begin = np.flatnonzero(first)
        inside = np.arange(n) - begin[np.cumsum(first) - 1]
        # of a bucket that is larger those compared are neighbours by their rarest terms
        for a, size in zip(begin, np.diff(np.append(begin, n)), strict=True):
            if size > BUCKET:
                order[a : a + size] = sorted(order[a : a + size], key=lambda x: (sketch[x], place[x]))
        place, sketch = place[order], sketch[order]
        part = inside // BUCKET
        chunk = np.cumsum(inside % BUCKET == 0)
        share = np.zeros(n)
        at = 0
        while at < n:  # whole chunks, a bounded number of them at a time
            end = n if n - at <= AT_ONCE else int(np.searchsorted(chunk, chunk[at + AT_ONCE]))
            some = slice(at, end)
            share[some] = best_shares(chunk[some], sketch[some].tolist(), idf.value)
            at = end
        near = share > 0
        home = _mixed(bucket[near].view(np.uint64), part[near]).view(np.int64)
        return pd.DataFrame({"place": place[near], "share": share[near], "home": home})

    return run


def _shards(tokens: DataFrame, idf, draws, docs: int, shard_docs: int, kind: type) -> DataFrame:
    """(place, shard): documents go where they share most, and shards are filled by size."""
    spark = tokens.sparkSession
    routes = saved(tokens.select("place", "terms").mapInArrow(_routes(idf, draws, kind), _ROUTES), "routes")
    # a row for each term and round, of which the vocabulary bounds the number
    drawn = (
        routes.select("drawn")
        .mapInArrow(_drawn_by, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > BUCKET)
        .orderBy("key")
        .toPandas()
    )
    often = spark.sparkContext.broadcast((drawn.key.to_numpy(np.int64), drawn.n.to_numpy(np.int64)))
    tasks = partitions(spark, docs * ROUNDS, 256 * BUCKET)
    links = (
        routes.mapInArrow(_buckets(often), "bucket long, place long, sketch binary")
        .withColumn("task", F.pmod("bucket", F.lit(tasks)))
        .repartition(tasks, "task")
        .groupBy("task")
        .applyInPandas(_links(idf), "place long, share double, home long")
    )
    # equal shares meet in the same buckets: both documents choose the same of them
    best = links.groupBy("place").agg(F.max(F.struct("share", "home"))["home"].alias("home"))
    homes = tokens.select("place").join(best, "place", "left")
    return _filled(saved(homes, "homes"), docs, shard_docs)


def _filled(homes: DataFrame, docs: int, shard_docs: int) -> DataFrame:
    """(place, shard) of (place, home), a home being NULL where nothing was met.

    Homes are filled into shards of at most ``shard_docs`` documents one after the other. A
    home of more than a quarter of a shard gets shards of its own, in parts.
    """
    large = max(1, shard_docs // 4)
    homes = homes.withColumn("home", F.coalesce("home", F.xxhash64("place")))
    sizes = homes.groupBy("home").agg(F.count(F.lit(1)).alias("size"))
    lots = -(-docs // (32 * shard_docs))
    before = Window.partitionBy("lot").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    small = (
        sizes.where(F.col("size") <= large)
        .withColumn("lot", F.pmod(F.xxhash64("home"), F.lit(lots)))
        .withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        # what begins in a shard ends in it
        .withColumn("shard", F.xxhash64("lot", F.floor(F.col("before") / (shard_docs - large + 1))))
        .select("home", "shard", F.lit(1).cast("long").alias("parts"))
    )
    big = sizes.where(F.col("size") > large).select(
        "home",
        F.xxhash64(F.lit("own"), "home").alias("shard"),
        F.ceil(F.col("size") / (0.75 * shard_docs)).cast("long").alias("parts"),
    )
    part = F.pmod(F.xxhash64("place"), F.col("parts"))
    return homes.join(small.union(big), "home").select(
        "place",
        F.when(F.col("parts") == 1, F.col("shard")).otherwise(F.xxhash64("shard", part)).alias("shard"),
    )


class Index:
    """BM25 inverted index over the terms of the documents of one shard."""

    def __init__(
        self, terms: list[np.ndarray], times: list[np.ndarray], idf: np.ndarray, mean: float
    ) -> None:
        self.n = n = len(terms)
        owner = np.repeat(np.arange(n), [len(t) for t in terms])
        flat = np.concatenate(terms)
        tf = np.concatenate(times).astype(np.float64)
        lengths = np.array([int(t.sum()) for t in times], np.float64)
        order = np.argsort(flat, kind="stable")
        term, self.doc = flat[order], owner[order]
        tf, norm = tf[order], K1 * (1 - B + B * lengths / mean)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        change = np.concatenate([np.ones(min(len(term), 1), bool), term[1:] != term[:-1]])
        self.first = np.flatnonzero(change)
        size = np.diff(np.append(self.first, len(term)))
        # a term of one document retrieves nothing but itself
        self.size = np.where(size > 1, size, 0)
        # common terms as whole rows, which are added up faster
        dense = np.flatnonzero(size * DENSE > n)
        self.row = np.full(len(size), -1)
        self.row[dense] = np.arange(len(dense))
        self.rows = np.zeros((len(dense), n))
        number = np.cumsum(change) - 1  # of each posting's term
        posting = self.row[number]
        common = posting >= 0
        self.rows[posting[common], self.doc[common]] = self.weight[common]
        self.size[dense] = 0
        cuts = np.cumsum([len(t) for t in terms])
        place = np.empty(len(flat), np.int64)
        place[order] = number
        self.terms = np.split(place, cuts[:-1])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of the seed that two documents hold."""
        terms = self.terms[seed]
        size = self.size[terms]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[terms] - (ends - size), size)
        sparse = np.bincount(self.doc[at], self.weight[at], self.n)
        row = self.row[terms]
        return sparse + self.rows[row[row >= 0]].sum(axis=0)

    def neighbours(self, seed: int, among: np.ndarray | bool = True) -> np.ndarray:
        """Those documents that share a term with the seed, best first, ties by place; the seed too."""
        score = self.scores(seed)
        found = np.flatnonzero((score > 0) & among)
        return found[np.argsort(-score[found], kind="stable")]


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack_tails(sizes: np.ndarray, index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (tail, start in the tail, length)."""
    used = np.zeros(len(sizes), np.int64)
    longest = np.argsort(-sizes, kind="stable")
    at = 0
    last: list[tuple[int, int, int]] = []
    while True:
        while at < len(longest) and used[longest[at]] == sizes[longest[at]]:
            at += 1
        if at == len(longest):
            break
        seed = longest[at]
        sequence, room = [], window
        found = index.neighbours(seed, used < sizes)
        found = found[found != seed]
        # of the best ones as many as fill the window
        enough = np.searchsorted(np.cumsum((sizes - used)[found]), window - sizes[seed] + used[seed]) + 1
        turn = iter((seed, *found[:enough].tolist()))
        follow = at
        while room:
            doc = next(turn, None)
            if doc is None:
                while follow < len(longest) and used[longest[follow]] == sizes[longest[follow]]:
                    follow += 1
                if follow == len(longest):
                    break
                doc = longest[follow]
            take = int(min(room, sizes[doc] - used[doc]))
            if take:
                sequence.append((int(doc), int(used[doc]), take))
                used[doc] += take
                room -= take
        if room:
            last = sequence
            break
        yield sequence
    # the rest, in sequences whose lengths are powers of two
    for size in powers_of_two(sum(x[2] for x in last)):
        part = []
        while size:
            doc, start, length = last.pop(0)
            take = min(size, length)
            part.append((doc, start, take))
            size -= take
            if take < length:
                last.insert(0, (doc, start + take, length - take))
        yield part


def _pack_shard(idf, mean: float, window: int, kind: type) -> Callable:
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("place")
        doc_ids, tokens, places = (
            shard.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "place")
        )
        tails = [np.frombuffer(x, kind).astype("<u4") for x in shard.column("tail").to_pylist()]
        raws, often = (shard.column(c).to_pylist() for c in ("terms", "times"))
        terms, times = counted_each([np.frombuffer(x, kind) for x in shard.column("tail").to_pylist()])
        for doc, n in enumerate(tokens):
            if n >= window:
                terms[doc] = np.frombuffer(raws[doc], kind)
                times[doc] = read_times(often[doc], len(terms[doc]))
        sizes = np.array([len(t) for t in tails])
        index = Index(terms, times, idf.value, mean)
        out: list[list] = [[] for _ in range(7)]
        for parts in pack_tails(sizes, index, window):
            # a sequence is told apart by what it begins with
            doc, start, _ = parts[0]
            sequence, offset = sequence_of(places[doc], start, window), 0
            for doc, start, length in parts:
                crc = zlib.crc32(tails[doc][start : start + length])
                before = tokens[doc] - len(tails[doc]) + start
                values = doc_ids[doc], before, length, crc, tokens[doc], sequence, offset
                for column, value in zip(out, values, strict=True):
                    column.append(value)
                offset += length
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, out, strict=True)})

    return run


ROWS_BITS, PLACE_BITS = 33, 22  # bits of a row's number in its partition: Spark's, and what is enough


def sequence_of(place: int, start: int, window: int) -> int:
    """A number of its own for the sequence that begins at ``start`` of the tail at ``place``."""
    partition, row = place >> ROWS_BITS, place & ((1 << ROWS_BITS) - 1)
    if row >> PLACE_BITS:
        raise ValueError(f"more than {1 << PLACE_BITS} documents in a partition")
    return ((partition << PLACE_BITS) + row) * window + start


def _full_windows(tokens: DataFrame, window: int) -> DataFrame:
    """Pieces of the full windows: sequences of their own, numbered downwards from -1."""
    rows = F.lit(1 << ROWS_BITS)
    compact = F.floor(F.col("place") / rows) * (1 << PLACE_BITS) + F.col("place") % rows
    return tokens.select(
        "doc_id", "doc_tokens", compact.alias("place"), F.posexplode("sums").alias("k", "crc")
    ).select(
        "doc_id",
        (F.col("k").cast("long") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        (-1 - F.col("place") * (1 << 19) - F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): see PIECES.

    ``ids_crc32`` is the CRC-32 of the piece's ids as little-endian 32-bit numbers,
    ``start`` its first id's place in the document, ``offset`` that in the sequence.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    tokens = saved(
        rows.mapInArrow(_tokenize(vocabulary, pattern, window), _TOKENS).withColumn(
            "place", F.monotonically_increasing_id()
        ),
        "tokens",
    )
    kind = id_kind(ByteLevelBpe(vocabulary.value, pattern).size)
    total = tokens.agg(F.count("*").alias("docs"), F.avg("doc_tokens").alias("mean")).first()
    counts = (
        tokens.select("terms")
        .mapInArrow(_frequencies(kind), "term long, docs long")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"))
        .toPandas()
    )
    df = np.zeros(int(counts.term.max()) + 1 if len(counts) else 1)
    df[counts.term.to_numpy(np.int64)] = counts.docs
    weights = np.log1p((total["docs"] - df + 0.5) / (df + 0.5))
    idf = spark.sparkContext.broadcast(weights)
    # of a document without full windows only the tail is needed again
    terms = F.when(F.col("doc_tokens") >= window, F.col("terms")).otherwise(F.lit(b"")).alias("terms")
    tails = tokens.where(F.length("tail") > 0).select("doc_id", "doc_tokens", "place", "tail", terms, "times")
    if total["docs"] <= shard_docs:
        dealt = tails.withColumn("shard", F.lit(0).cast("long"))
    else:
        draws = spark.sparkContext.broadcast(_draws(weights, df))
        dealt = tails.join(_shards(tokens, idf, draws, total["docs"], shard_docs, kind), "place")
    packed = (
        dealt.repartition(partitions(spark, total["docs"], 4 * shard_docs), "shard")
        .groupBy("shard")
        .applyInArrow(_pack_shard(idf, total["mean"] or 1.0, window, kind), PIECES)
    )
    return _full_windows(tokens, window).union(packed)
