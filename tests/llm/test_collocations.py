import random
import re
from collections import Counter

import duckdb
import pytest

from pricelake.llm import collocations
from pricelake.llm.queries import ORACLE, op11_collocations
from tests.llm.conftest import stored

SCHEMA = "doc_id long, lang string, text string, words int, chunk string, n double, phrase string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def twin(rows, least, top, longest=5):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    f = Counter({key: count for key, count in f.items() if count >= least})
    inside = Counter()
    for (lang, words), count in f.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                inside[key] = max(inside[key], count)
    found = {}
    for (lang, words), a in f.items():
        if len(words) > 1 and inside[lang, words] < a:
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, some in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(rng):
    words = ["the", "of", "The", "É", "é", "x", "new", "york", "san", "A", "b.c", "it's", "日本", "\x00", "-"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!? ", "\r\n", " ... "]
    made = []
    for _ in range(120):
        made.append("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 150))))
    passage = "new york san the of x b x new york of the x the the é é é " * 3
    made += [passage + t[:40] for t in made[:30]]
    return [*made, *made[:25], None, "", " ", ".", "x", "x " * 5000, "a b\n" * 700, "one\x1ftwo one\x1ftwo " * 30]


@pytest.mark.parametrize(("mean", "bits"), [(4, 1 << 26), (1, 64), (1000, 256)])
def test_against_counting_all(spark, folder, mean, bits):
    rng = random.Random(mean)
    langs = ["en", "de", None, "und", ""]
    rows = [(i, rng.choice(langs), t, i, "x", 0.5, "y") for i, t in enumerate(texts(rng))]
    docs = stored(spark, rows, SCHEMA, folder)
    got = collocations.collocations(docs, 7, 5, 90, mean, bits)
    assert sorted(tuple(r) for r in got.collect()) == twin([r[1:3] for r in rows], 7, 90)


def test_parts_of_a_long_text(spark, folder, monkeypatch):
    monkeypatch.setattr(collocations, "TEXT_AT_ONCE", 50)
    text = "a b, c d a b, c d e a b c " * 40
    words, owner = collocations.words_of(collocations.cut_at_ends(text, 50))
    assert owner[-1] > 10
    docs = stored(spark, [(1, None, text, 0, "", 0.0, "")] * 3, SCHEMA, folder)
    got = collocations.collocations(docs, 5, 5, 50)
    assert sorted(tuple(r) for r in got.collect()) == twin([(None, text)] * 3, 5, 50)


def test_copies_share_their_chunks():
    rng = random.Random(1)
    body = [f"w{rng.randint(0, 400)}" for _ in range(3000)]
    chunks = []
    for before in ("", "other words stand here . "):
        words, owner = collocations.words_of([before + " ".join(body)])
        chunks.append(set(collocations.parse(words, owner, 32)[2].to_pylist()))
    assert len(chunks[0] & chunks[1]) >= 0.95 * len(chunks[0]) and len(chunks[0]) > 50


def test_products_beyond_64_bits(spark):
    f = {"a": 7 * 10**15 + 1, "b": 5 * 10**15 + 3, "c": 10**15, "a b": 10**15 + 7, "b c": 10**15 - 1, "a b c": 10**15 - 5}
    n = 9 * 10**17 + 11
    every = [("en", phrase, phrase.count(" ") + 1, count) for phrase, count in f.items()]
    got = collocations.ranked(
        spark.createDataFrame(every, "lang string, phrase string, words int, f long"),
        spark.createDataFrame([("en", n)], "lang string, n long"),
        10,
    )
    want = {}
    for phrase in ("a b", "b c", "a b c"):
        words = phrase.split()
        cuts = []
        for k in range(1, len(words)):
            left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
            cuts.append((1000 * f[phrase] * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        want[phrase] = (f[phrase], left, right, n, score)
    assert {r.phrase: tuple(r)[3:] for r in got.collect()} == want


def test_empty_table(spark, folder):
    docs = stored(spark, [], SCHEMA, folder)
    assert collocations.collocations(docs).collect() == []


def test_query_against_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
    want = sorted(duck.sql(ORACLE["op11_collocations"]).fetchall())
    got = op11_collocations(spark, sf_dir)
    assert got.columns == "lang rank phrase a l r n score".split()
    assert sorted(tuple(r) for r in got.collect()) == want and want
