"""N-gram Jaccard join by parity sketches (operator 9).

Two texts link when the Jaccard similarity of their sets of 5-word shingles is at
least 0.8. The join finds every such pair:

* Texts with the same set form a class; only classes are compared.
* For linked sets of sizes a <= b the symmetric difference is at most (a + b) / 9 and
  b <= 1.25 a. Sizes are cut into bands a quarter wide, so partners lie in the same
  or in neighbouring bands, and a set is sketched for its own and for the next band.
* A sketch deals the shingle hashes to the band's m parts and XORs each part into one
  word. A shingle in one set alone changes one word, so of the m words of a linked
  pair at most d = largest symmetric difference of the band differ. Since m > d, the
  pair agrees on a word (pigeonhole), and equality joins on words find it.
* Two facts keep words selective. Dropping the same shingles from all sets can only
  lower the difference, so shingles found in many texts (passages, boilerplate) are
  left out of the words. And m - d words agree, so words of empty parts are needed
  only for a set that has m - d or more of them; such a set also sends the words of
  its unreduced shingles, and those of empty parts only if these too leave m - d empty.
* Candidates pass a size test and a 512-bit parity sketch, whose Hamming distance is a
  lower bound of the symmetric difference, and are verified on the whole sets.
* The sets of one word are first compared with the least of them. That settles a group
  of near copies without forming its pairs. Words whose sets are not all linked to
  that one are opened afterwards: their pairs between different components are taken
  block by block, filtered by the same two tests and verified.

Words travel packed: a task sends one row for each of P key ranges, so that one join
task sorts a bounded number of words with numpy. Word collisions cost a needless
verification, never a result. Sets are told apart by 128 bits of hash, shingles by 64.

Defined results: NULL or blank text has no shingles, links with nothing and is its own
component. Rows of equal text link, also under one doc_id. A NULL doc_id takes part; a
component's id is its least doc_id that is not NULL. Texts of any length are read whole.
Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import components, partitions, saved
from pricelake.llm.shingles import Shingler, binary, mix

SKETCH_WORDS = 8  # 64-bit words of the parity sketch that filters candidates
COMMON_SHARE = 0.0001  # a shingle seen in more texts than this share is left out of the words ...
COMMON_LEAST = 12  # ... if it is in so many at least
COMMON_MOST = 1_000_000  # the most frequent ones that are left out; bounds what is broadcast
WORDS_PER_TASK = 1_000_000
CHUNK = 500_000  # shingles a task handles at a time
COUNTED = 3_000_000  # shingles among which a task looks for frequent ones
FILTER_WORDS = 1 << 17  # 64-bit words of the filter that picks the sets to verify (1 MB)
BLOCK = 1024
WORDS_TOGETHER = 64  # opened words of one group that a task takes together

_U = np.uint64


def bands(largest: int) -> np.ndarray:
    """First sizes of the bands: each at least a quarter above the one before."""
    starts = [1]
    while starts[-1] <= largest * 1.25 + 1:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 5 // 4)))
    starts.append(max(starts[-1] + 1, -(-starts[-1] * 5 // 4)))
    return np.array(starts)


def parts_of_bands(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest symmetric difference d of a linked pair of each band, and its m parts."""
    d = 2 * (starts[1:] - 1) // 9
    m = np.where(d > 0, d + 1 + (d + 4) // 4, 0)  # d = 0 asks for equal sets: one class
    return d, m


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    bits = np.bincount((shingles & _U(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def xor_by(slot: np.ndarray, values: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """XOR and number of the values of each slot."""
    count = np.bincount(slot, minlength=slots)
    order = np.argsort(slot, kind="stable")
    words = np.zeros(slots, _U)
    full = np.flatnonzero(count)
    if len(full):
        first = np.cumsum(count[full]) - count[full]
        words[full] = np.bitwise_xor.reduceat(values[order], first)
    return words, count


def sketch_words(
    sets: list[np.ndarray], common: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(key, index of the set) of every word that the sets send."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, _U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    if len(common):
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        rare = common[at] != flat
    else:
        rare = np.ones(len(flat), bool)
    d_of, m_of = parts_of_bands(starts)
    band = np.searchsorted(starts, sizes, side="right") - 1
    keys, owners = [], []
    for step in (0, 1):
        d, m = d_of[band + step], m_of[band + step]
        wanted = m > 0
        for universe, inside in ((0, rare), (1, None)):
            here = wanted[owner] if inside is None else inside & wanted[owner]
            if not wanted.any():
                break
            base = np.cumsum(np.where(wanted, m, 0)) - np.where(wanted, m, 0)
            slots = int(np.where(wanted, m, 0).sum())
            own, value = owner[here], flat[here]
            part = ((value >> _U(20)) % m[own].astype(_U)).astype(np.int64)
            words, count = xor_by(base[own] + part, value, slots)
            slot_owner = np.repeat(np.arange(len(sets)), np.where(wanted, m, 0))
            slot_part = np.arange(slots) - base[slot_owner]
            empty = np.bincount(slot_owner[count == 0], minlength=len(sets))
            sparse = wanted & (empty >= m - d)
            send = count > 0
            if universe:
                send |= sparse[slot_owner]
            tag = (
                slot_part.astype(_U)
                | ((band[slot_owner] + step).astype(_U) << _U(44))
                | _U(universe << 60)
            )
            keys.append(mix(words ^ mix(tag + _U(1)))[send])
            owners.append(slot_owner[send])
            wanted = sparse
    return np.concatenate(keys or [np.zeros(0, _U)]), np.concatenate(owners or [np.zeros(0, np.int64)])


def _chunks(batches, columns: int):
    """Rows' other values and their sets, so many at a time that memory stays bounded."""
    rest, sets, total, seen = [], [], 0, set()
    shingler = Shingler()
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        ids = zip(*(batch.column(k).to_pylist() for k in range(columns - 1)), strict=True)
        ids = list(ids) or [()] * batch.num_rows
        for own, shingles in zip(
            ids, shingler.sets(binary(batch.column(columns - 1))), strict=True
        ):
            key = set_key(shingles)
            rest.append((own, key, key not in seen))
            seen.add(key)
            sets.append(shingles)
            total += len(shingles)
            if total >= CHUNK:
                yield rest, sets
                rest, sets, total = [], [], 0
    if rest:
        yield rest, sets


def ref_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and one for each shingle that several texts of a task hold."""
    schema = pa.schema(PROFILE_ARROW)
    fresh: list[np.ndarray] = []

    def often() -> pa.RecordBatch:
        flat = np.sort(np.concatenate(fresh))
        fresh.clear()
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        counts = np.diff(np.r_[first, len(flat)])
        several = counts > 1
        k = int(several.sum())
        columns = [pa.nulls(k, field.type) for field in schema][:-2]
        columns += [pa.array(flat[first[several]].view(np.int64)), pa.array(counts[several])]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for rest, sets in _chunks(batches, 3):
        n = len(rest)
        sketches = np.concatenate([parity_sketch(x) for x in sets])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0][0] for r in rest], pa.int64()),
                pa.array([r[0][1] for r in rest], pa.int64()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([r[1] for r in rest], pa.binary()),
                pa.array([ref_of(r[1]) for r in rest], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(0, SKETCH_WORDS * n + 1, SKETCH_WORDS), pa.int32()), pa.array(sketches)
                ),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()),
            ],
            schema=schema,
        )
        fresh += [x for r, x in zip(rest, sets, strict=True) if r[2] and len(x)]
        if sum(map(len, fresh)) >= COUNTED:
            yield often()
    if fresh:
        yield often()


PROFILE = "row long, doc_id long, n long, key binary, ref long, sketch array<long>, shingle long, texts long"
PROFILE_ARROW = [
    ("row", pa.int64()),
    ("doc_id", pa.int64()),
    ("n", pa.int64()),
    ("key", pa.binary()),
    ("ref", pa.int64()),
    ("sketch", pa.list_(pa.int64())),
    ("shingle", pa.int64()),
    ("texts", pa.int64()),
]


def _sender(common, starts: np.ndarray, ranges: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out = common.value
        for rest, sets in _chunks(batches, 1):
            chosen = [(r[1], s) for r, s in zip(rest, sets, strict=True) if r[2] and len(s)]
            if not chosen:
                continue
            keys, owner = sketch_words([s for _, s in chosen], left_out, starts)
            refs = np.array([ref_of(k) for k, _ in chosen], np.int64)
            to = ((keys >> _U(40)) % _U(ranges)).astype(np.int64)
            order = np.lexsort((owner, to))
            keys, owner, to = keys[order], owner[order], to[order]
            packed = np.ascontiguousarray(keys[:, None].view(np.uint8)[:, :5])
            cuts = np.flatnonzero(np.diff(to)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(to)], strict=True):
                if b > a:
                    who, times = np.unique(owner[a:b], return_counts=True)
                    out.append((to[a], packed[a:b].tobytes(), refs[who].tobytes(), times.astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                names=["range", "words", "refs", "times"],
            )

    return send


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sets that share a word: each with the least of them; words of three sets and more whole."""
    words = np.frombuffer(b"".join(pdf.words), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(words), 8), np.uint8)
    wide[:, :5] = words
    key = wide.view(_U)[:, 0]
    ref = np.repeat(np.frombuffer(b"".join(pdf.refs), np.int64), np.frombuffer(b"".join(pdf.times), np.uint32))
    order = np.lexsort((ref, key))
    key, ref = key[order], ref[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1])
    key, ref = key[new], ref[new]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(key)])
    many = size > 1
    least = np.repeat(ref[first], size)
    others = np.repeat(many, size)
    others[first] = False
    stars = np.unique(np.stack([least[others], ref[others]], 1), axis=0)
    groups = {ref[a : a + s].tobytes() for a, s in zip(first[size > 2], size[size > 2], strict=True)}
    blocks = [
        (g[:8], g[i : i + 8 * BLOCK], xxhash.xxh3_64_intdigest(g) - 2**63)
        for g in groups
        for i in range(0, len(g), 8 * BLOCK)
    ]
    return pd.DataFrame(
        {
            "a": np.r_[stars[:, 0], np.array([np.frombuffer(x[0], np.int64)[0] for x in blocks], np.int64)],
            "b": pd.array([*stars[:, 1], *[None] * len(blocks)], "Int64"),
            "refs": [None] * len(stars) + [x[1] for x in blocks],
            "word": pd.array([None] * len(stars) + [x[2] for x in blocks], "Int64"),
        }
    )


def _set_rows(filter_words):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = filter_words.value
        for rest, sets in _chunks(batches, 1):
            refs = np.array([ref_of(k) for _, k, _ in rest], np.int64)
            hit = _in_filter(wanted, refs)
            keep = [i for i in np.flatnonzero(hit) if rest[i][2] and len(sets[i])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rest[i][1] for i in keep], pa.binary()),
                    pa.array(refs[keep], pa.int64()),
                    pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                ],
                names=["key", "ref", "shingles"],
            )

    return rows


def _in_filter(words: np.ndarray, refs: np.ndarray) -> np.ndarray:
    unsigned = refs.view(_U)
    return (words[(unsigned & _U(FILTER_WORDS - 1)).astype(np.int64)] >> ((unsigned >> _U(32)) & _U(63))) & _U(1) > 0


def _filter_of(refs: DataFrame) -> np.ndarray:
    """A bit map of the refs: FILTER_WORDS words, however many refs there are."""
    bit = F.expr("shiftleft(1L, cast(shiftright(ref, 32) & 63 as int))")
    got = (
        refs.groupBy(F.expr(f"ref & {FILTER_WORDS - 1}").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()
    )
    words = np.zeros(FILTER_WORDS, np.int64)
    words[got.word.to_numpy(np.int64)] = got.bits.to_numpy(np.int64)
    return words.view(_U)


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes and parity sketches allow a link."""
    side = lambda x: classes.select(
        F.col("ref").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")
    )
    apart = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda p, q: F.bit_count(p.bitwiseXOR(q))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where("4 * greatest(n_a, n_b) <= 5 * least(n_a, n_b)")
        .where(9 * apart <= F.col("n_a") + F.col("n_b"))
        .select("a", "b")
        .distinct()
    )


def _sets_of(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, ref, shingles) of the classes with these refs, read from the texts."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_of(refs))
    return saved(
        docs.select("text")
        .mapInArrow(_set_rows(wanted), "key binary, ref long, shingles array<long>")
        .join(refs, "ref", "left_semi")
        .dropDuplicates(["key"]),
        "sets",
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, key_a, key_b) of the pairs of refs that link, from the whole sets."""
    side = lambda x: sets.select(
        F.col("ref").alias(x), F.col("key").alias(f"key_{x}"), F.col("shingles").alias(f"set_{x}")
    )
    both = F.size(F.array_intersect("set_a", "set_b"))
    return saved(
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("both", both)
        .where(100 * F.col("both") >= 80 * (F.size("set_a") + F.size("set_b") - F.col("both")))
        .select("a", "b", "key_a", "key_b"),
        "verified",
    )


def _cross_pairs(table: pa.Table) -> pa.Table:
    """Pairs that may link, of the opened words of one range, in different components."""
    word, i, j, side, ref, n = (
        table.column(c).to_numpy() for c in ("word", "i", "j", "side", "ref", "n")
    )
    root = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    sketch = table.column("sketch").combine_chunks().flatten().to_numpy().view(_U)
    sketch = sketch.reshape(-1, SKETCH_WORDS)
    order = np.lexsort((side, j, i, word))
    word, i, j, side, ref, n, root, sketch = (
        x[order] for x in (word, i, j, side, ref, n, root, sketch)
    )
    change = (word[1:] != word[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    first = np.flatnonzero(np.r_[True, change]) if len(word) else np.zeros(0, np.int64)
    found = [np.zeros((0, 2), np.int64)]
    for a, b in zip(first, [*first[1:], len(word)], strict=True):
        if i[a] == j[a]:
            left = right = slice(a, b)
        else:
            cut = a + int(np.searchsorted(side[a:b], 1))
            left, right = slice(a, cut), slice(cut, b)
        p, q = n[left][:, None], n[right][None]
        may = root[left][:, None] != root[right][None]
        may &= 4 * np.maximum(p, q) <= 5 * np.minimum(p, q)
        x, y = np.nonzero(may)
        if left == right:
            x, y = x[x < y], y[x < y]
        apart = np.bitwise_count(sketch[left][x] ^ sketch[right][y]).sum(axis=1, dtype=np.int64)
        near = 9 * apart <= n[left][x] + n[right][y]
        u, v = ref[left][x[near]], ref[right][y[near]]
        if len(u):
            found.append(np.stack([np.minimum(u, v), np.maximum(u, v)], 1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _dealt(groups: DataFrame, rooted: DataFrame) -> DataFrame:
    """(word, a, part, i, j, side, ref, n, sketch, root): the sets of mixed words by pairs of blocks.

    Only pairs of different components are looked for. So the sets of a word's largest
    component are dealt to the blocks of its other sets, and those to all blocks: a few
    outsiders of a large group cost rows in proportion to the group. ``side`` tells rows of
    the first block of a pair from those of the second.
    """
    rows = groups.select("word", F.explode(_longs("refs")).alias("ref")).join(
        rooted.select("ref", "root"), "ref"
    )
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = saved(
        rows.groupBy("word", "root")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("word")
        .agg(
            F.sum("size").alias("all"),
            F.max(F.struct("size", "root")).alias("main"),
            F.count(F.lit(1)).alias("roots"),
        )
        .where("roots > 1")
        .select(
            "word",
            F.col("main.root").alias("main"),
            blocks(F.col("all") - F.col("main.size")).alias("outer"),
            blocks(F.col("main.size")).alias("inner"),
        ),
        "mixed",
    )
    opened = groups.join(mixed, "word")
    parts = (
        opened.select("a", "word")
        .distinct()
        .groupBy("a")
        .agg(F.ceil(F.count("*") / WORDS_TOGETHER).alias("parts"))
    )
    return (
        opened.join(parts, "a")
        .withColumn("part", F.expr("pmod(xxhash64(word), parts)"))
        .select("word", "a", "part", "main", "outer", "inner", F.explode(_longs("refs")).alias("ref"))
        .join(rooted.drop("key"), "ref")
        # blocks of outsiders come first
        .withColumn("inside", F.col("root") == F.col("main"))
        .withColumn(
            "own",
            F.expr("cast(if(inside, outer + pmod(xxhash64(ref), inner), pmod(xxhash64(ref), outer)) as int)"),
        )
        .withColumn("other", F.explode(F.expr("sequence(0, outer + if(inside, 0, inner) - 1)")))
        .select(
            "word",
            "a",
            "part",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "ref",
            "n",
            "sketch",
            "root",
        )
    )


def _opened(groups: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs still to verify: of words whose sets lie in several components."""
    rooted = (
        classes.select("ref", "key", "n", "sketch")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    pairs = saved(_dealt(groups, rooted), "dealt")
    ranges = partitions(groups.sparkSession, pairs.count(), 100_000)
    return (
        # Words of one group of near copies share their least set, so the pairs that they
        # repeat meet in one task, a bounded number of words at a time.
        pairs.withColumn("range", F.pmod(F.xxhash64("a", "part", "i", "j"), F.lit(ranges)))
        .groupBy("range")
        .applyInArrow(_cross_pairs, "a long, b long")
        .distinct()
    )


def _longs(column: str):
    """The 8-byte little-endian integers of a binary."""
    hexed = f"hex(substring({column}, 8 * k + 1, 8))"
    swapped = "concat(" + ", ".join(f"substring(h, {15 - 2 * b}, 2)" for b in range(8)) + ")"
    return F.expr(
        f"transform(transform(sequence(0, cast(length({column}) / 8 as int) - 1), k -> {hexed}), "
        f"h -> cast(conv({swapped}, 16, -10) as bigint))"
    )


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, row, root) of each row of ``docs`` (doc_id, text).

    ``root`` tells components apart (NULL: no words); ``row`` is the row's
    monotonically_increasing_id in ``docs``, which must be a table on disk, since it
    is read three to four times.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    profile = saved(docs.mapInArrow(_profile, PROFILE), "profile")
    texts = profile.where("key is not null").select("row", "doc_id", "n", "key")
    classes = saved(
        profile.where("n > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n").alias("n"),
            F.first("ref").alias("ref"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    total = classes.agg(
        F.count("*").alias("classes"), F.sum("n").alias("shingles"), F.max("n").alias("largest")
    ).first()
    if total["classes"]:
        roots = _links(spark, docs, profile, classes, total)
    else:
        roots = spark.createDataFrame([], "node binary, root binary")
    named = (
        classes.select("key", "least")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(ids, "root").select("key", "component_id", "root")
    n = F.col("n").alias("n_shingles")
    worded = texts.where("n > 0").join(of_class, "key")
    blank = texts.where("n = 0").withColumns(
        {"component_id": F.col("doc_id"), "root": F.lit(None).cast("binary")}
    )
    columns = ["doc_id", n, "component_id", "row", "root"]
    return worded.select(*columns).union(blank.select(*columns))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (NULL last), ties by place.

    Rows without words link with nothing and stay. All columns pass unchanged.
    """
    row = "_".join(["row", *docs.columns])  # clashes with none of them
    named = saved(jaccard_components(docs), "components").where("root is not null")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = named.groupBy("root").agg(F.min(order).alias("first"))
    repeats = (
        named.join(first, "root")
        .where("row <> first.row")
        .select(F.col("row").alias(row))
    )
    return (
        docs.withColumn(row, F.monotonically_increasing_id())
        .join(repeats, row, "left_anti")
        .drop(row)
    )


def _links(spark, docs: DataFrame, profile: DataFrame, classes: DataFrame, total) -> DataFrame:
    """(node, root) of classes that link with another class."""
    least = max(COMMON_LEAST, int(COMMON_SHARE * total["classes"]))
    common = (
        profile.where("shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("texts").alias("texts"))
        .where(F.col("texts") >= least)
        .orderBy(F.desc("texts"), "shingle")
        .limit(COMMON_MOST)
        .select("shingle")
        .toPandas()
        .shingle.to_numpy(np.int64)
    )
    common = spark.sparkContext.broadcast(np.sort(common.view(_U)))
    starts = bands(int(total["largest"]))
    ranges = partitions(spark, 0.6 * total["shingles"], WORDS_PER_TASK)
    sent = docs.select("text").mapInArrow(
        _sender(common, starts, ranges), "range long, words binary, refs binary, times binary"
    )
    met = saved(
        sent.repartition(ranges, "range")
        .groupBy("range")
        .applyInPandas(_meet, "a long, b long, refs binary, word long"),
        "met",
    )
    stars = saved(_plausible(met.where("b is not null").select("a", "b").distinct(), classes), "stars")
    groups = met.where("b is null").select("word", "a", "refs")
    refs = (
        stars.select(F.col("a").alias("ref"))
        .union(stars.select("b"))
        .union(groups.select(F.explode(_longs("refs"))))
        .distinct()
    )
    sets = _sets_of(refs, docs)
    linked = _verified(stars, sets)
    roots = saved(components(linked, "key_a", "key_b"), "roots")
    more = saved(_opened(groups, classes, roots), "opened")
    if more.isEmpty():
        return roots
    again = _verified(more, sets)
    if again.isEmpty():
        return roots
    return components(linked.union(again), "key_a", "key_b")
