import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pricelake.llm import packing
from pricelake.llm.pretokens import ByteLevelBpe, read_vocabulary
from pricelake.llm.queries import op6_packing
from tests.llm.conftest import stored

PATH = tokenizers.path("byte_bpe_50k.json")


def library(texts):
    own = Tokenizer.from_file(PATH)
    return [np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], np.uint32) for t in texts]


def check(pieces, rows, window):
    """Every id in one piece with the right checksum; sequences gapless; no padding."""
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    want = defaultdict(list)
    for (doc_id, _), ids in zip(rows, library([t for _, t in rows]), strict=True):
        want[doc_id].append(ids)
    for doc_id, copies in want.items():
        own = sorted(by_doc.pop(doc_id), key=lambda p: p["start"])
        spans = defaultdict(int)
        for p in own:
            assert any(
                len(ids) == p["doc_tokens"]
                and zlib.crc32(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"]
                for ids in copies
            )
            for at in range(p["start"], p["start"] + p["length"]):
                spans[at] += 1
        for at, n in spans.items():
            assert n == sum(at < len(ids) for ids in copies)
        assert sum(p["length"] for p in own) == sum(map(len, copies))
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window and at & (at - 1) == 0


def test_copies_beyond_a_shard(spark, folder):
    """A third of all documents alike: they part into shards, and none is lost."""
    rows = [(i, "the same words in every copy of this text") for i in range(400)]
    rows += [(1000 + i, f"words of text number {i} and no other {i * i}") for i in range(800)]
    docs = stored(spark, rows, "doc_id long, text string", folder)
    check(packing.pack(docs, PATH, tokenizers.PATTERN, 64, 50).collect(), rows, 64)


def test_pieces_of_odd_texts(spark, folder):
    texts = [None, "", " ", "short", "<|endoftext|> in a text", "日本語 🙂", "naïve", "word " * 3000, "x" * 5000]
    rows = list(enumerate(texts)) + [(7, "word " * 3000), (None, "no id"), (None, None)] + [(99, "again and again")] * 40
    docs = stored(spark, [(d, t, 5) for d, t in rows], "doc_id long, text string, shard int", folder)
    for window, shard in ((1024, 512), (16, 7)):
        got = packing.pack(docs, PATH, tokenizers.PATTERN, window, shard).collect()
        check(got, rows, window)


def test_empty_table(spark, folder):
    docs = stored(spark, [], "doc_id long, text string", folder)
    assert packing.pack(docs, PATH, tokenizers.PATTERN).count() == 0


def test_ids_are_the_librarys(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encode = ByteLevelBpe(read_vocabulary(PATH), tokenizers.PATTERN)
    odd = ["\x85\xa0 \x1c\x1f", "a\x0bb", "²³¹ ¼", "ª º µ", "ǅ ǆ", "tab\t\tx", "'S 'LL can't"]
    for text, ids in zip([*texts, *odd], library([*texts, *odd]), strict=True):
        assert [*encode(text or "").tolist(), 0] == ids.tolist()


def test_tokenising_makes_no_python_numbers_and_no_pattern_it_does_not_need(monkeypatch):
    encode = ByteLevelBpe(read_vocabulary(PATH), tokenizers.PATTERN)
    monkeypatch.setattr(encode, "ids", None)
    plain = ["", " ", "plain text, it's 2 lines\nand naïve ", "x" * 3000]
    for text, ids in zip(plain, library(plain), strict=True):
        assert [*encode(text).tolist(), 0] == ids.tolist()
    assert "merges" not in vars(encode) and "library" not in vars(encode.own)
    odd = ["runs  of \t spaces \n\n", "a NUL \0 inside", "<|endoftext|> in a text", "\0", "日本語 🙂"]
    for text, ids in zip(odd, library(odd), strict=True):
        assert [*encode(text).tolist(), 0] == ids.tolist()


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_terms_of_many_documents_at_once(kind):
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 9, n).tolist() for n in (0, 5, 0, 0, 40, 1, 1, 0)] + [[3], [3, 3], [4]]
    terms, times = packing.counted_each([np.array([*d, 0], kind) for d in docs] + [np.zeros(0, kind)])
    for doc, own, often in zip([*docs, []], terms, times, strict=True):
        assert own.dtype == kind and dict(zip(own.tolist(), often.tolist(), strict=True)) == Counter(doc)
        assert own.tolist() == sorted(set(doc))
    assert packing.counted_each([]) == ([], [])


def test_routes_against_sorting_each_document():
    """Drawn: the least number of each round; sketch: the rarest terms, equal ones by id."""
    rng = np.random.default_rng(6)
    df = rng.integers(1, 6, 300)  # many equally rare
    idf = np.log1p(50 / df)
    draws = packing._draws(idf, df)
    docs = [np.sort(rng.choice(300, n, replace=False)) for n in (0, 1, 20, 24, 25, 26, 200, 300)]
    batch = pa.record_batch(
        [pa.array(range(len(docs)), pa.int64()), pa.array([d.astype(np.uint16).tobytes() for d in docs])],
        names=["place", "terms"],
    )
    run = packing._routes(SimpleNamespace(value=idf), SimpleNamespace(value=draws), np.uint16)
    got = {r["place"]: r for out in run(iter([batch])) for r in out.to_pylist()}
    for place, doc in enumerate(docs):
        shared = [t for t in doc.tolist() if df[t] > 1]
        assert (place in got) == bool(shared)
        if shared:
            rarest = sorted(shared, key=lambda t: (-idf[t], t))[: packing.SKETCH]
            assert packing._ids(got[place]["sketch"]).tolist() == sorted(rarest)
            drawn = [min(shared, key=lambda t: draws[k, t]) for k in range(packing.ROUNDS)]
            assert packing._ids(got[place]["drawn"]).tolist() == drawn


def plain_bm25(docs, idf, mean):
    """Scores of each document for all terms of each other one that two documents hold."""
    holders = Counter(t for d in docs for t in set(d))
    out = np.zeros((len(docs), len(docs)))
    for i, seed in enumerate(docs):
        for j, doc in enumerate(docs):
            for t in set(seed):
                tf = doc.count(t)
                if tf and holders[t] > 1:
                    norm = packing.K1 * (1 - packing.B + packing.B * len(doc) / mean)
                    out[i, j] += idf[t] * tf * (packing.K1 + 1) / (tf + norm)
    return out


@pytest.mark.parametrize("vocabulary", [6, 40, 400])
def test_index_against_plain_bm25(vocabulary):
    rng = np.random.default_rng(vocabulary)
    docs = [rng.integers(0, vocabulary, rng.integers(0, 60)).tolist() for _ in range(45)] + [[]]
    idf = rng.random(vocabulary) + 0.1
    mean = float(np.mean([len(d) for d in docs]))
    own = [packing.counted(np.array([*d, 0], np.uint32)) for d in docs]
    index = packing.Index([t for t, _ in own], [n for _, n in own], idf, mean)
    want = plain_bm25(docs, idf, mean)
    for i in range(len(docs)):
        assert np.allclose(index.scores(i), want[i])
        found = index.neighbours(i).tolist()
        assert set(found) == set(np.flatnonzero(want[i] > 0).tolist())
        assert all(want[i][a] >= want[i][b] - 1e-9 for a, b in zip(found, found[1:], strict=False))


def test_windows_take_the_best_unused_neighbours():
    """Against a search among all documents for every seed."""
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 300, rng.integers(1, 16)).tolist() for _ in range(120)]
    own = [packing.counted(np.array([*d, 0], np.uint32)) for d in docs]
    idf = rng.random(300) + 0.1
    index = packing.Index([t for t, _ in own], [n for _, n in own], idf, 8.0)
    scores = plain_bm25(docs, idf, 8.0)
    sizes = np.array([len(d) for d in docs])
    left = sizes.copy()
    for parts in packing.pack_tails(sizes, index, 32):
        if sum(n for *_, n in parts) < 32:
            break
        seed = parts[0][0]
        assert seed == min(np.flatnonzero(left), key=lambda d: (-sizes[d], d)) and parts[0][2] == left[seed]
        others = [d for d in range(len(docs)) if d != seed and left[d] and scores[seed][d] > 0]
        others.sort(key=lambda d: (-round(scores[seed][d], 9), d))
        taken = [d for d, *_ in parts[1:]]
        assert taken[: len(others)] == others[: len(taken)]
        for d, _, n in parts:
            left[d] -= n
    else:
        raise AssertionError("there is a rest")


def test_a_shard_of_empty_documents_only():
    nothing = packing.counted(np.zeros(1, np.uint32))
    index = packing.Index([nothing[0]] * 2, [nothing[1]] * 2, np.ones(5), 1.0)
    assert index.neighbours(0).tolist() == []
    assert list(packing.pack_tails(np.array([0, 0]), index, 16)) == []
    assert list(packing.pack_tails(np.array([1, 1]), index, 16)) == [[(0, 0, 1), (1, 0, 1)]]


@pytest.mark.parametrize("at_once", [4096, 128])
def test_links_against_comparing_each_two(monkeypatch, at_once):
    monkeypatch.setattr(packing, "AT_ONCE", at_once)
    rng = np.random.default_rng(at_once)
    idf = rng.random(60) + 0.1
    buckets = np.repeat([5, 9, 11, 12], [1, 40, 300, 3])
    sketches = [np.unique(rng.integers(0, 60, rng.integers(1, 9))).astype(np.uint32) for _ in buckets]
    rows = pd.DataFrame({"bucket": buckets, "place": np.arange(len(buckets)), "sketch": [x.tobytes() for x in sketches]})
    got = packing._links(SimpleNamespace(value=idf))(rows.sample(frac=1, random_state=1)).set_index("place")
    met = {}
    for bucket, some in rows.sort_values(["bucket", "sketch", "place"]).groupby("bucket"):
        for at in range(0, len(some), packing.BUCKET):
            chunk = some.place.iloc[at : at + packing.BUCKET].tolist()
            for u in chunk:
                weight = lambda x: idf[list(x)].sum()
                best = max(
                    (weight(set(sketches[u]) & set(sketches[v])) / np.sqrt(weight(sketches[u]) * weight(sketches[v]))
                     for v in chunk if v != u), default=0,
                )
                assert got.share.get(u, 0.0) == pytest.approx(best)
                met.setdefault((bucket, at), set()).update([got.home.get(u)] if best else [])
    homes = [x for some in met.values() for x in some]
    assert all(len(some) <= 1 for some in met.values()) and len(homes) == len(set(homes))


def test_counts_of_long_documents_survive():
    for times in ([1, 2, 3], [70_000, 1], []):
        raw = packing.kept_times(np.array(times, np.int64))
        assert packing.read_times(raw, len(times)).tolist() == times


@pytest.mark.parametrize("sizes", [[1] * 500, [7] * 90, [400, 3, 3], [40, 41, 39, 1000, 10, 9]])
def test_shards_are_filled_and_bounded(spark, sizes):
    rows = [(place, home) for home, n in enumerate(sizes) for place in range(home * 10_000, home * 10_000 + n)]
    homes = spark.createDataFrame([(p, None if len(sizes) == 500 else h) for p, h in rows], "place long, home long")
    got = packing._filled(homes, len(rows), 40).collect()
    filled = Counter(r["shard"] for r in got)
    assert sorted(r["place"] for r in got) == [p for p, _ in rows]
    assert max(filled.values()) <= 1.1 * 40
    assert len(filled) <= 2 * -(-len(rows) // 40) + len(sizes) // 4 + 1
    whole = {}
    for r in got:
        if sizes[r["place"] // 10_000] <= 10:
            assert whole.setdefault(r["place"] // 10_000, r["shard"]) == r["shard"]


def test_planted_neighbours_meet_in_a_corpus_of_many_shards(spark, folder):
    """Pairs that share half of their words meet nearly as often in 24 shards as in one."""
    rng = np.random.default_rng(3)
    vocabulary = Tokenizer.from_file(PATH).get_vocab()
    words = sorted(w[1:] for w in vocabulary if w[0] == "Ġ" and w[1:].isascii() and w[1:].isalpha() and len(w) > 5)
    rows = []
    for pair in range(600):
        common = rng.choice(words, 220)
        for k in range(2):
            text = rng.permutation([*common, *rng.choice(words, 220)])
            rows.append((pair * 2 + k, " ".join(text)))
    docs = stored(spark, rows, "doc_id long, text string", folder)
    met = {}
    for shard_docs in (50, 2048):
        got = packing.pack(docs, PATH, tokenizers.PATTERN, 1024, shard_docs).collect()
        check(got, rows, 1024)
        windows = defaultdict(set)
        for p in got:
            windows[p["doc_id"]].add(p["sequence_id"])
        met[shard_docs] = sum(bool(windows[2 * i] & windows[2 * i + 1]) for i in range(600)) / 600
    print(f"planted pairs in one window: {met}")
    assert met[50] >= 0.85 * met[2048] > 0.6


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(op6_packing(spark, sf_dir).collect(), [tuple(d) for d in docs], 1024)
