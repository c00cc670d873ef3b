import random
import re

import numpy as np

from pyspark.sql import functions as F

from pricelake.llm import ngram_join
from pricelake.llm.common import saved
from pricelake.llm.queries import op9_ngram_jaccard
from pricelake.llm.shingles import Shingler
from tests.llm.conftest import left_on_disk, shuffled, stored

SCHEMA = "doc_id long, text string, row string, key int, ref string"


def shingle_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in holders.get(g, ()):
                shared[j] = shared.get(j, 0) + 1
            holders.setdefault(g, []).append(i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus():
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 400))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \t\n\x0b", "one", "One", "one two", "one  two", "a b c d e", "A b c d\x0be", "a b c d e f"]
    texts += ["été\x85x y z u v", "été x y z u v", "q " * 3000, "q " * 500, "日本 " * 7]
    for _ in range(40):
        words = [word() for _ in range(rng.choice([4, 6, 9, 12, 20, 60, 150, 700]))]
        if rng.random() < 0.5:
            words[len(words) // 2 : len(words) // 2] = passage
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4, 12])):
            new = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(words) // 25])):
                at = rng.randrange(len(new))
                new[at : at + rng.choice([0, 1])] = [word()]
            texts.append(" ".join(new))
    return texts


def test_components_are_those_of_brute_force(spark, folder, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON_LEAST", 3)  # so that passages count as common
    rows = [(i if i % 17 else None, t) for i, t in enumerate(corpus())]
    rows += [rows[60]] * 30 + [(7, "seven comes again with other words")]
    docs = stored(spark, [(*r, "x", 1, None) for r in rows], SCHEMA, folder)
    for block in (1024, 3):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "WORDS_TOGETHER", block)
        got = ngram_join.jaccard_components(docs).collect()
        have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)
        assert have == sorted(brute(rows), key=str)


def test_one_of_each_group_stays(spark, folder):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(corpus())]
    rows += [rows[60]] * 5
    docs = stored(spark, [(*r, "x", 1, None) for r in rows], SCHEMA, folder)
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    blank = [r for r in rows if not shingle_set(r[1])]
    assert sorted(filter(lambda r: not shingle_set(r[1]), kept), key=str) == sorted(blank, key=str)
    groups = ngram_join.jaccard_components(docs).where("root is not null")
    assert len(kept) - len(blank) == groups.select("root").distinct().count()
    assert {d for d, t in kept if shingle_set(t) and d is not None} == {
        c for (_, _, c), (_, t) in zip(brute(rows), rows, strict=True) if shingle_set(t) and c is not None
    }


def test_shuffles_of_a_saved_table_leave_the_disk(spark):
    """The join saves a table after each of its many shuffles."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(spark), spark.conf.get(setting)
    pairs = spark.range(5000).select((F.col("id") % 999).alias("a"), "id").groupBy("a").agg(F.max("id").alias("b"))
    table = saved(pairs, "pairs")
    assert not left_on_disk(spark, before)
    assert table.count() == 999 and saved(table.union(pairs), "both").count() == 1998
    assert spark.conf.get(setting) == was


def test_empty_table(spark, folder):
    docs = stored(spark, [], SCHEMA, folder)
    assert ngram_join.jaccard_components(docs).count() == 0
    assert ngram_join.one_of_each_group(docs).count() == 0


def test_sets_have_the_size_of_the_definition():
    texts = [(t or "").encode() for t in corpus()]
    for at_once in (1 << 20, 64, 7):
        shingler = Shingler(at_once=at_once)
        sets = list(shingler.sets(texts))
        assert [len(s) for s in sets] == [len(shingle_set(t.decode())) for t in texts]
        assert all((a == b).all() for a, b in zip(sets, Shingler().sets(texts), strict=True))


def test_linked_sets_agree_on_a_word():
    """The pigeonhole bound, for pairs right at the threshold, with and without common shingles."""
    rng = np.random.default_rng(3)
    starts = ngram_join.bands(5000)
    for _ in range(300):
        n = int(rng.choice([5, 6, 8, 9, 10, 18, 40, 100, 400, 1000]))
        pool = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
        drop = int(rng.integers(0, n // 9 + 1))
        add = 0
        while 100 * (n - drop) >= 80 * (n + add + 1):
            add += 1
        a, b = np.unique(pool[:n]), np.unique(pool[drop : n + add])
        common = np.unique(rng.choice(pool, int(rng.integers(0, 2 * n))))
        keys, owner = ngram_join.sketch_words([a, b], common, starts)
        if not np.array_equal(a, b):
            assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_outsiders_of_a_large_group_cost_in_proportion(spark, monkeypatch):
    """A word of 4,000 sets of one component and 20 others: no block pair inside the component."""
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    near, far = range(4000), range(4000, 4020)
    refs = np.array([*near, *far], "<i8").tobytes()
    groups = spark.createDataFrame([(7, 0, refs), (8, 1, np.array([0, 5, 9], "<i8").tobytes())], "word long, a long, refs binary")
    rows = [(r, str(r).encode(), 9, [0] * 8, b"0" if r < 4000 else str(r).encode()) for r in [*near, *far]]
    rooted = spark.createDataFrame(rows, "ref long, key binary, n long, sketch array<long>, root binary")
    dealt = ngram_join._dealt(groups, rooted).collect()
    assert {r["word"] for r in dealt} == {7}
    # 4,000 sets to the one block of outsiders, 20 outsiders to 1 + 63 blocks
    assert len(dealt) == 4000 + 20 * 64
    met = set()
    by_pair = {}
    for r in dealt:
        by_pair.setdefault((r["i"], r["j"]), ([], []))[r["side"]].append(r["ref"])
    for (i, j), (left, right) in by_pair.items():
        met |= {frozenset((a, b)) for a in left for b in (left if i == j else right) if a != b}
    want = {frozenset((a, b)) for a in far for b in [*near, *far] if a != b}
    assert want <= met


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in op9_ngram_jaccard(spark, sf_dir).collect()}
    assert got == set(brute(rows))
