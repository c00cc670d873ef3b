"""Phrase collocations by prefix-free parsing (operator 11).

Texts, with A-Z lower-cased, fall into pieces at punctuation and line ends and into words
at spaces and tabs. Phrases are 2 to 5 neighbouring words of a piece, counted by language.

* Parse: a chunk begins at each text's first word and wherever the hash of the next four
  words says so, about every ``MEAN`` words. It overlaps the next chunk by up to four words,
  as far as the piece goes, so every phrase lies whole in the chunk where it begins.
* Dictionary: equal chunks are one row with their number of occurrences. Copies and passages
  that texts share are cut alike, whatever surrounds them, and are counted once.
* Count: phrases are counted inside distinct chunks, times the chunk's occurrences, and only
  where they begin in a chunk's own words, so what chunks overlap by counts once.

A phrase is no more frequent than its parts, so three passes over the dictionary suffice:
words; hashes of two neighbouring frequent words; and the texts of all phrases each of whose
neighbouring words were frequent together. Words and pairs that are frequent travel as a
bitset of ``FILTER_BITS`` bits; hashes that meet there cost time only, as the last pass counts
texts and drops what is rare. Counts are summed in each task before they are exchanged.

Scores, the words that longer phrases contain, and each language's best phrases are joins,
a grouped minimum and a limited window.

Defined results: NULL text is empty, NULL lang is ``und``. Texts without words give nothing.
Every row counts, also repeated ones; doc_id and all other columns are ignored, whatever
their names. Equal scores are told apart by frequency, then by the phrase's bytes. A text of
any length is counted whole; its parts are cut at piece ends only. An empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.byte_bpe import portions
from pricelake.llm.common import received, saved, sent, text_of

LONGEST = 5
LEAST = 100
TOP = 2000
TASKS_A_CORE = 4
MEAN = 32  # words between two triggers
TRIGGER = LONGEST - 1  # words a trigger looks at, and the most that chunks overlap by
FILTER_BITS = 1 << 26
TEXT_AT_ONCE = 4_000_000
HELD_AT_ONCE = 3_000_000  # counts a task holds
UNKNOWN = "und"

CHUNKS = "lang string, own int, chunk string"
_ENDS = re.compile(r"[.,;:!?\n-\r]")
_ONE_END = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)  # a piece's end is the word "."
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def hashes(words: pa.StringArray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words.to_pylist()), np.uint64, len(words))


def cut_at_ends(text: str, size: int) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut at piece ends."""
    cuts, at = [0], size
    while at < len(text):
        found = _ENDS.search(text, at)
        if not found:
            break
        cuts.append(found.start())
        at = found.start() + size
    return [text[a:z] for a, z in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def words_of(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts, "." between pieces, and the text of each."""
    plain = [t.encode().lower().translate(_ONE_END).replace(b".", b" . ") for t in texts]
    split = pc.ascii_split_whitespace(pa.array(plain, pa.binary()).cast(pa.string()))
    words, owner = split.flatten(), pc.list_parent_indices(split).to_numpy()
    end = pc.equal(words, ".").to_numpy(zero_copy_only=False)
    again = np.zeros(len(end), bool)
    again[1:] = end[1:] & end[:-1] & (owner[1:] == owner[:-1])
    keep = ~again & pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    return words.filter(pa.array(keep)), owner[keep]


def parse(words: pa.StringArray, owner: np.ndarray, mean: int) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """(text, number of own words, whole chunk) of the chunks that ``words`` are cut into."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), pa.array([], pa.string())
    coded = words.dictionary_encode()
    at = coded.indices.to_numpy()
    word = hashes(coded.dictionary)[at]
    end = pc.equal(words, ".").to_numpy(zero_copy_only=False)
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    begin = first.copy()
    if n >= TRIGGER:
        window = word[: n - TRIGGER + 1].copy()
        for k in range(1, TRIGGER):
            window = mixed(window) + word[k : n - TRIGGER + 1 + k]
        same = owner[: n - TRIGGER + 1] == owner[TRIGGER - 1 :]
        begin[: n - TRIGGER + 1] |= same & (mixed(window) % np.uint64(mean) == 0)
    starts = np.flatnonzero(begin)
    stops = np.append(starts[1:], n)
    # the next chunk's words up to the piece's end
    ends = np.append(np.flatnonzero(end | first), n)
    reach = ends[np.searchsorted(ends, stops)]
    over = np.minimum(reach - stops, TRIGGER)
    over[end[stops - 1]] = 0
    sizes = stops - starts + over
    last = np.cumsum(sizes)
    place = np.arange(last[-1]) + np.repeat(starts - (last - sizes), sizes)
    offsets = pa.array(np.concatenate([[0], last]).astype(np.int32))
    chunks = pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(place))), " ")
    return owner[starts], (stops - starts).astype(np.int32), chunks


def _chunks(mean: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1).to_pylist()
            for part in portions(texts):
                cut = [cut_at_ends(t, TEXT_AT_ONCE) for t in texts[part]]
                text = np.repeat(np.arange(part.start, part.stop), [len(x) for x in cut])
                owner, own, chunks = parse(*words_of([x for some in cut for x in some]), mean)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(text[owner])), pa.array(own, pa.int32()), chunks],
                    names=["lang", "own", "chunk"],
                )

    return run


class Block:
    """The words of some distinct chunks, by place."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        whole = pa.Table.from_batches(batches).combine_chunks()
        lang, own, times, chunk = (whole.column(i).combine_chunks() for i in range(4))
        split = pc.split_pattern(chunk, " ")
        self.words = split.flatten()
        owner = pc.list_parent_indices(split).to_numpy()
        coded = self.words.dictionary_encode()
        self.distinct, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[owner]
        self.times = times.to_numpy()[owner]
        n = len(self.word)
        begins = split.offsets.to_numpy()[:-1] - split.offsets.to_numpy()[0]
        self.own = np.arange(n) - begins[owner] < own.to_numpy()[owner]
        self.real = ~pc.equal(self.words, ".").to_numpy(zero_copy_only=False)
        #: places whose word has a next one in its piece
        self.next = np.zeros(n, bool)
        self.next[:-1] = (owner[1:] == owner[:-1]) & self.real[1:] & self.real[:-1]

    def hashes(self) -> np.ndarray:
        """Hashes of the language and word at each place."""
        return mixed(hashes(self.distinct)[self.word] + mixed(hashes(self.langs))[self.lang])


def counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, their summed times, and the key of each place."""
    keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
    # sums of whole numbers below 2**53 are exact
    return keys, first, np.bincount(at, times, len(keys)).astype(np.int64), at


def in_set(filter_: np.ndarray, hash_: np.ndarray) -> np.ndarray:
    bit = hash_ % np.uint64(len(filter_) * 64)
    return (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > TEXT_AT_ONCE:
            yield Block(held)
            held, size = [], 0
    if held:
        yield Block(held)


def _summed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches of a task with ``n`` summed by ``keys``; what is held is bounded."""
    held, rows = [], 0

    def total() -> pa.Table:
        table = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return table.rename_columns([*keys, "n"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > HELD_AT_ONCE:
            held = total().to_batches()
            rows = sum(x.num_rows for x in held)
            if rows > HELD_AT_ONCE // 2:
                yield from held
                held, rows = [], 0
    if held:
        yield from total().to_batches(max_chunksize=100_000)


def _bit(hash_: np.ndarray, bits: int) -> pa.Array:
    return pa.array((hash_ % np.uint64(bits)).astype(np.int64))


def _words(bits: int) -> Callable:
    """(lang, bit, phrase, n) of single words."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            at = np.flatnonzero(block.own & block.real)
            _, first, n, _ = counted(block.lang[at] * np.int64(len(block.distinct)) + block.word[at], block.times[at])
            at = at[first]
            yield pa.RecordBatch.from_arrays(
                [
                    block.langs.take(pa.array(block.lang[at])),
                    _bit(block.hashes()[at], bits),
                    block.distinct.take(pa.array(block.word[at])),
                    pa.array(n),
                ],
                names=["lang", "bit", "phrase", "n"],
            )

    return lambda batches: _summed(counts(batches), ["lang", "bit", "phrase"])


def _pair_hashes(block: Block, words) -> tuple[np.ndarray, np.ndarray]:
    """Places of two neighbouring frequent words, and their hashes."""
    word = block.hashes()
    often = block.real & in_set(words, word)
    at = np.flatnonzero(block.next[:-1] & often[:-1] & often[1:]) if len(word) else np.zeros(0, np.int64)
    return at, mixed(mixed(word[at]) + word[at + 1])


def _pairs(words) -> Callable:
    """(hash, n) of two neighbouring frequent words."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ = received(words)
        for block in _blocks(batches):
            at, pair = _pair_hashes(block, words_)
            own = block.own[at]
            keys, _, n, _ = counted(pair[own], block.times[at[own]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return lambda batches: _summed(counts(batches), ["hash"])


def _phrases(words, pairs, longest: int) -> Callable:
    """(lang, words, phrase, n) of phrases whose neighbouring words are frequent together."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, pairs_ = received(words), received(pairs)
        for block in _blocks(batches):
            n = len(block.word)
            often = np.zeros(n, bool)
            at, pair = _pair_hashes(block, words_)
            often[at[in_set(pairs_, pair)]] = True
            # a phrase's number, and so on for the phrases that are one word longer
            width = np.int64(len(block.distinct))
            number = block.lang * width + block.word
            at = np.flatnonzero(block.own)
            for k in range(2, longest + 1):
                at = at[often[np.minimum(at + k - 2, n - 1)]]
                _, first, total, same = counted(number[at] * width + block.word[at + k - 1], block.times[at])
                number[at] = same
                where = at[first]
                texts = block.words.take(pa.array((where[:, None] + np.arange(k)).ravel()))
                offsets = pa.array(np.arange(0, len(where) * k + 1, k, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.langs.take(pa.array(block.lang[where])),
                        pa.array(np.full(len(where), k, np.int32)),
                        pc.binary_join(pa.ListArray.from_arrays(offsets, texts), " "),
                        pa.array(total),
                    ],
                    names=["lang", "words", "phrase", "n"],
                )

    return lambda batches: _summed(counts(batches), ["lang", "words", "phrase"])


def bitset(bits: DataFrame, size: int) -> np.ndarray:
    """A bitset of ``size`` bits, of which those of (bit) are set."""
    rows = (
        bits.groupBy(F.shiftrightunsigned("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set"))
        .toPandas()
    )
    out = np.zeros(size // 64, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["set"].to_numpy(np.int64)
    return out.view(np.uint64)


def frequencies(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, mean: int = MEAN, bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of frequent phrases of 1 to ``longest`` words; (lang, n) of all words."""
    if longest > TRIGGER + 1 or bits < 64 or bits & (bits - 1):
        raise ValueError(f"chunks overlap by {TRIGGER} words; the filter's bits are a power of two")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of().alias("text"))
    chunks = saved(
        rows.mapInArrow(_chunks(mean), CHUNKS)
        .groupBy("lang", "own", "chunk")
        .agg(F.count(F.lit(1)).alias("times")),
        "chunks",
    ).select("lang", "own", "times", "chunk")
    # the fewer tasks there are, the more counts meet before they are exchanged
    chunks = chunks.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    words = saved(
        chunks.mapInArrow(_words(bits), "lang string, bit long, phrase string, n long")
        .groupBy("lang", "bit", "phrase")
        .agg(F.sum("n").alias("f")),
        "words",
    )
    often = words.where(F.col("f") >= least)
    word_set = sent(spark, bitset(often.select("bit"), bits))
    pairs = (
        chunks.mapInArrow(_pairs(word_set), "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("f"))
        .where(F.col("f") >= least)
    )
    pair_set = sent(spark, bitset(pairs.select(F.expr(f"hash & {bits - 1}L").alias("bit")), bits))
    phrases = (
        chunks.mapInArrow(_phrases(word_set, pair_set, longest), "lang string, words int, phrase string, n long")
        .groupBy("lang", "words", "phrase")
        .agg(F.sum("n").alias("f"))
        .where(F.col("f") >= least)
    )
    one = often.select("lang", "phrase", F.lit(1).alias("words"), "f")
    every = saved(one.union(phrases.select("lang", "phrase", "words", "f")), "phrases")
    return every, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def ranked(every: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of what ``frequencies`` returns."""
    longer = every.where("words >= 2").withColumnRenamed("f", "a")
    cuts = longer.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang",
        "phrase",
        "a",
        "cut",
        _part(F.lit(1), F.col("cut")).alias("left"),
        _part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right"),
    )
    left = every.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = every.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = (wide("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * wide("n")
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(totals, "lang")
        .withColumn("above", product)
        .withColumn("below", wide("l") * wide("r"))
        .withColumn("score", F.expr("cast(above div below as long)"))
    )
    weakest = (
        scored.groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("w"))
        .select("lang", "phrase", "w.*")
    )
    inside = (
        longer.where("words >= 3")
        .withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("from", F.explode(F.expr("sequence(1, words - size + 1)")))
        .select("lang", _part(F.col("from"), F.col("size")).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = weakest.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        kept.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    mean: int = MEAN,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of ``docs`` (lang, text)."""
    return ranked(*frequencies(docs, least, longest, mean, bits), top)


ORACLE = """
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
    FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs)
), totals AS (
    SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang
), places AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces
), phrases AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
    WHERE i + k - 1 <= len(ws)
    GROUP BY ALL HAVING count(*) >= 100
), longer AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM phrases WHERE k >= 2
), cuts AS (
    SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM longer
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n,
           ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
    JOIN totals t ON t.lang = c.lang
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(a) AS longer
    FROM (
        SELECT lang, ws, k, a, size, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS size FROM longer WHERE k >= 3)
    )
    GROUP BY ALL
), ranked AS (
    SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
           w.phrase, a, l, r, n, score
    FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
    WHERE i.longer IS NULL OR i.longer < a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
