import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelake.llm import kmeans_tree, pivot_dedup
from pricelake.llm.queries import op1_embedding_near_dedup, op7_nearest
from tests.llm.conftest import stored

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, leaf int"
ODD = [None, [], [0.0, 0.0], [1.0, None], [math.nan, 1.0], [math.inf, 1.0], [1.0, 2.0, 3.0]]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def clustered(rng, n, dim=16):
    centres = rng.normal(size=(n // 8, dim))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * rng.choice([0.02, 0.12], (n, 1))).astype(np.float32)


def rows_of(rng):
    vectors = clustered(rng, 400)
    rows = [(i, v.tolist(), int(rng.integers(0, 3)), "x", 1) for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, 1, None, None) for i, v in enumerate(ODD)]
    rows += [(2000 + i, vectors[0].tolist(), 1, None, None) for i in range(60)]  # one vector again and again
    return [*rows, rows[3], rows[3], (None, vectors[5].tolist(), rows[5][2], "", 0), (3000, vectors[7].tolist(), None, "", 0)]


def brute_links(rows, threshold=pivot_dedup.THRESHOLD):
    links = {i: set() for i in range(len(rows))}
    for i, (_, v, label, *_) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if label is not None and label == rows[j][2] and usable(v) and usable(w) and len(v) == len(w):
                if cosine(v, w) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    return links


def brute_components(rows, links):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, others in links.items():
        for j in others:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return [least.get(find(i)) for i in range(len(rows))]


def test_near_duplicates_link_as_brute_force_finds(spark, folder):
    rows = rows_of(np.random.default_rng(1))
    links = brute_links(rows)
    component = brute_components(rows, links)
    docs = stored(spark, rows, SCHEMA, folder)
    for block in (512, 16):
        got = pivot_dedup.near_duplicates(docs, block=block).collect()
        want = sorted(((r[0], len(links[i]), component[i]) for i, r in enumerate(rows)), key=str)
        have = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)
        assert len(have) == len(want)
        assert sum(h[1] for h in have) <= sum(w[1] for w in want)
        assert sum(h[1] for h in have) >= 0.97 * sum(w[1] for w in want)
        assert sum(a == b for a, b in zip(have, want, strict=True)) >= 0.95 * len(want)
        assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_links_at_the_threshold(spark, folder):
    """Pairs around the threshold in many dimensions: none below it, nine of ten above it."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    c = rng.uniform(0.9, 0.97, (600, 1))
    both = np.concatenate([base, c * base + np.sqrt(1 - c * c) * noise]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2, "", 0) for i, v in enumerate(both)]
    links = brute_links(rows)
    got = pivot_dedup.near_duplicates(stored(spark, rows, SCHEMA, folder)).collect()
    have = {r["vec_id"]: r["n_links"] for r in got}
    true = sum(map(len, links.values()))
    assert all(have[i] <= len(others) for i, others in links.items())
    assert sum(have.values()) >= 0.9 * true > 0


def test_pairs_within_rounding_of_the_threshold(spark, folder):
    """Cosines that differ from 0.93 in the last digits only link alike in blocks of any shape."""
    rng = np.random.default_rng(12)
    rows = []
    for pair in range(60):
        v, u = rng.normal(size=(2, 24))
        v /= np.linalg.norm(v)
        u -= (u @ v) * v
        w = 0.93 * v + math.sqrt(1 - 0.93**2) * u / np.linalg.norm(u)
        scale = 10.0 ** rng.integers(-3, 4, 2)
        rows += [(2 * pair, (v * scale[0]).tolist(), pair), (2 * pair + 1, (w * scale[1]).tolist(), pair)]
    docs = stored(spark, rows, "vec_id long, embedding array<double>, label int", folder)
    want = {}
    for (a, v, _), (b, w, _) in zip(rows[::2], rows[1::2], strict=True):
        want[a] = want[b] = int(cosine(v, w) >= 0.93)
    assert 10 < sum(want.values()) < 110
    for block in (512, 3):
        got = pivot_dedup.near_duplicates(docs, block=block).collect()
        assert {r["vec_id"]: r["n_links"] for r in got} == want


def test_a_dense_group_of_a_third_of_all_rows(spark, folder):
    """Near, not equal, vectors: nine of ten links are found however the group's noise is."""
    rng = np.random.default_rng(6)
    for noise in (0.1, 0.3):
        group = rng.normal(size=64) + noise * rng.normal(size=(1500, 64))
        vectors = np.concatenate([group, rng.normal(size=(3000, 64))]).astype(np.float32)
        rows = [(i, v.tolist(), 1, "", 0) for i, v in enumerate(vectors)]
        x = vectors.astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        true = (x @ x.T >= pivot_dedup.THRESHOLD).sum(axis=1) - 1
        docs = stored(spark, rows, SCHEMA, f"{folder}/{noise}")
        got = {r["vec_id"]: r["n_links"] for r in pivot_dedup.near_duplicates(docs).collect()}
        assert all(got[i] <= n for i, n in enumerate(true.tolist()))
        found = sum(got.values()) / true.sum()
        print(f"noise {noise}: {true.sum()} links, recall {found:.4f}")
        assert found >= 0.9


def test_near_vectors_of_a_rare_length(spark, folder):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist(), 1, "", 0) for i, v in enumerate(rng.normal(size=(3000, 8)))]
    for n, length in enumerate((3, 5, 6, 40)):
        near = rng.normal(size=length) + [[0], [1e-4]]
        rows += [(9000 + 2 * n + k, v.tolist(), 1, "", 0) for k, v in enumerate(near)]
    table = stored(spark, rows, SCHEMA, folder)
    got = {r["vec_id"]: r for r in pivot_dedup.near_duplicates(table).collect()}
    for i in range(9000, 9008):
        assert (got[i]["n_links"], got[i]["component_id"]) == (1, i - i % 2)


@pytest.mark.parametrize("schema", [SCHEMA])
def test_empty_tables(spark, folder, schema):
    empty = stored(spark, [], schema, folder)
    assert pivot_dedup.near_duplicates(empty).count() == 0
    assert kmeans_tree.nearest(empty, "vec_id % 50 = 0").count() == 0


def test_only_unusable_vectors(spark, folder):
    rows = [(i, v, 1, "", 0) for i, v in enumerate(ODD[:-1])]
    table = stored(spark, rows, SCHEMA, folder)
    assert {(r[0], r[1], r[2], r[3]) for r in pivot_dedup.near_duplicates(table).collect()} == {
        (i, 0, i, True) for i in range(len(rows))
    }
    assert kmeans_tree.nearest(table, "vec_id % 50 = 0").count() == 0


def brute_nearest(rows, i, k=5):
    own = rows[i][1]
    found = [
        (-cosine(own, r[1]), math.inf if r[0] is None else r[0])
        for j, r in enumerate(rows)
        if j != i and usable(r[1]) and len(r[1]) == len(own)
    ]
    return sorted(found)[:k]


def recall(got, want):
    """Share of true neighbours whose score was reached, place by place."""
    hit = total = 0
    for query, best in want.items():
        have = got.get(query, [])
        assert len(have) == len(best)
        for (score, _), (true, _) in zip(have, best, strict=True):
            assert score >= true - 1e-12
        total += len(best)
        floor = best[-1][0] if best else 0
        hit += sum(score <= floor + 1e-12 for score, _ in have)
    return hit / total


def by_query(collected):
    out = {}
    for r in sorted(collected, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-r["score"], math.inf if r["vec_id"] is None else r["vec_id"]))
    return out


def test_nearest_finds_what_brute_force_finds(spark, folder):
    rows = rows_of(np.random.default_rng(4))
    table = stored(spark, rows, SCHEMA, folder)
    got = by_query(kmeans_tree.nearest(table, "vec_id % 50 = 0", sample=200).collect())
    asked = [i for i, r in enumerate(rows) if r[0] is not None and r[0] % 50 == 0 and usable(r[1])]
    want = {rows[i][0]: brute_nearest(rows, i) for i in asked}
    assert set(got) == {q for q, best in want.items() if best}
    assert recall(got, {q: b for q, b in want.items() if b}) >= 0.9
    # copies tie exactly, and ties go to the smaller vec_id
    assert got[0] == want[0] and got[2000] == want[2000]


def test_fewer_rows_than_asked_for(spark, folder):
    rows = [(0, [1.0, 0.0], 1, "", 0), (50, [0.0, 1.0], 1, "", 0), (3, [1.0, 1.0], None, "", 0)]
    got = by_query(kmeans_tree.nearest(stored(spark, rows, SCHEMA, folder), "vec_id % 50 = 0").collect())
    assert {q: [i for _, i in best] for q, best in got.items()} == {0: [3, 50], 50: [3, 0]}
    assert got[0][0][0] == -cosine([1, 0], [1, 1])


def test_the_sample_reaches_the_driver_once_not_once_a_task(spark, folder):
    """With 12 files of 600 vectors each, the first 500 of every file would be 3 MB."""
    rng = np.random.default_rng(13)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(7200, 64)))]
    path = f"{folder}/table"
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(12).write.parquet(path)
    settings = {"spark.sql.files.openCostInBytes": "128m", "spark.sql.autoBroadcastJoinThreshold": "256k"}  # a task a file
    live, limit = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        live.set(limit, "1500k")
        got = by_query(kmeans_tree.nearest(spark.read.parquet(path), "vec_id < 40", sample=500).collect())
    finally:
        live.remove(limit)
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {i: brute_nearest(rows, i) for i in range(40)}
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9


def test_first_by_hash_takes_the_same_rows_as_a_sort(spark):
    numbers = spark.range(5000).select(F.col("id").alias("row")).repartition(7)
    for n in (1, 30, 4990, 5000, 9000):
        want = [r["row"] for r in numbers.orderBy(F.xxhash64("row"), "row").limit(n).collect()]
        assert kmeans_tree.first_by_hash(numbers, n).row.tolist() == want
    # row numbers that repeat, all of them above any cut: it goes up until enough are there
    last = numbers.orderBy(F.xxhash64("row").desc()).limit(1).first()["row"]
    same = spark.range(900).select(F.lit(last).alias("row"))
    assert kmeans_tree.first_by_hash(same, 30).row.tolist() == [last] * 30
    assert kmeans_tree.first_by_hash(same.where("row is null"), 30).empty


def tree_of(rng, n, dim):
    points = rng.normal(size=(n, dim))
    return kmeans_tree.fit(pd.DataFrame({"embedding": points.tolist()}))[dim]


def test_visited_leaves_are_the_first_of_the_walk():
    rng = np.random.default_rng(14)
    for n, dim in ((3000, 8), (400, 3), (30, 5)):
        tree = tree_of(rng, n, dim)
        leaves = tree.leaves()
        centres, ways = tree.paths()
        x = kmeans_tree.unit(rng.normal(size=(40, dim)))
        near = np.concatenate([x @ centres.T, np.full((40, 1), np.inf)], axis=1)[:, ways]
        for least in {1, 2, 7, len(leaves) // 2, len(leaves) - 1, len(leaves), len(leaves) + 3} - {0}:
            for q, visited in zip(x, kmeans_tree.first_in_walk(near, least), strict=True):
                assert set(leaves[visited]) == set([*tree.walk(q)][:least])


def test_every_visited_row_is_compared_and_nothing_else():
    """Copies, near copies, the query itself, scales from 1e-30 to 1e30, bins of any size and none."""
    rng = np.random.default_rng(15)
    for dtype, dim in ((np.float32, 6), (np.float64, 3)):
        x = rng.normal(size=(2500, dim)) * 10.0 ** rng.integers(-30, 30, (2500, 1))
        x[300:900] = x[300]
        x[900:1500] = x[300] * (1 + 1e-7 * rng.normal(size=(600, dim)))
        x = x.astype(dtype)
        bins = rng.choice([0, 1, 1, 1, 1, 1, 3, 4], 2500)
        bins[np.flatnonzero(bins == 4)[3:]] = 1
        vec_id, row = rng.integers(0, 2000, 2500), rng.permutation(2500)
        block = kmeans_tree.Block([tuple(c[at] for c in (x, bins, vec_id, row)) for at in (slice(900), slice(900, None))], 5)
        asking = rng.choice(2500, 200, replace=False)
        visited = rng.random((200, 8)) < 0.5  # the bits of a byte
        i, j, score = block.best(x[asking], row[asking], visited)
        got = [list(zip(score[i == q], block.vec_id[j[i == q]], block.row[j[i == q]], strict=True)) for q in range(200)]
        for q, at in enumerate(asking.tolist()):
            there = np.flatnonzero(visited[q, bins] & (row != row[at]))
            near = kmeans_tree.cosines(np.repeat(x[at : at + 1], len(there), 0).astype(float), x[there].astype(float))
            order = np.lexsort((row[there], vec_id[there], -near))[:5]
            assert got[q] == list(zip(near[order], vec_id[there][order], row[there][order], strict=True))


def test_a_part_smaller_than_a_bin_changes_nothing(spark, folder, monkeypatch):
    """Bins over several parts, a vector again and again, lengths that the sample holds and not."""
    rows = rows_of(np.random.default_rng(16))
    rows += [(50 * i, rng.tolist(), 1, "", 0) for i, rng in enumerate(np.random.default_rng(17).normal(size=(80, 5)), 100)]
    table = stored(spark, rows, SCHEMA, folder)
    columns = ["query_id", "rank", "vec_id", "score"]
    found = []
    for part in (kmeans_tree.PART, 64 * 37):
        monkeypatch.setattr(kmeans_tree, "PART", part)
        monkeypatch.setattr(kmeans_tree, "ROW_BLOCK", 256)
        got = kmeans_tree.nearest(table, "vec_id % 50 = 0", sample=200).select(*columns)
        found.append(sorted(map(tuple, got.collect()), key=str))
    assert found[0] == found[1] and found[0]
    asked = [i for i, r in enumerate(rows) if r[0] is not None and r[0] % 50 == 0 and usable(r[1])]
    want = {}
    for i in asked:
        want.setdefault(rows[i][0], brute_nearest(rows, i))
    assert {q for q, *_ in found[0]} == {q for q, best in want.items() if best}


def test_rows_and_queries_are_shuffled_a_few_times_only(spark, folder):
    """Each row goes to one part, and queries do not outweigh rows much."""
    x = np.random.default_rng(18).normal(size=(20_000, 16))
    path = f"{folder}/table"
    spark.createDataFrame(pd.DataFrame({"vec_id": range(20_000), "embedding": x.tolist()})).repartition(4).write.parquet(path)
    got = kmeans_tree.nearest(spark.read.parquet(path), "vec_id % 2 = 0")
    placed = []
    todo = [got._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "MapInArrow":
            placed.append(node)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    sent = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, placed[-1])
    assert 20_000 < sent.where("kind = 0").count() + sent.where("kind = 1").count() <= 20_000 + 10_000 * 14
    assert sent.where("kind = 0").count() == 20_000


def test_op1_query_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    links = brute_links(rows)
    component = brute_components(rows, links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op1_embedding_near_dedup(spark, sf_dir).collect()}
    want = {r[0]: (len(links[i]), component[i]) for i, r in enumerate(rows)}
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_op7_query_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = by_query(op7_nearest(spark, sf_dir).collect())
    want = {r[0]: brute_nearest(rows, i) for i, r in enumerate(rows) if r[0] % 50 == 0}
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
