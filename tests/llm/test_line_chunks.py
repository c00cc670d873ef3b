import random
import re
import struct

import pytest
import xxhash

from pricelake.llm import line_chunks
from pricelake.llm.queries import op5_line_dedup
from tests.conftest import plan
from tests.llm.conftest import left_on_disk, shuffled, stored

SCHEMA = "doc_id long, text string, n_chars int, row long, places array<int>"
WHITE = " \t\n\r\x0b\x0c"


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def split(pattern, texts):
    out = []
    for t in texts:
        cuts = [m.start() for m in re.finditer(pattern, t) if m.start()]
        out += [t[a:z] for a, z in zip([0, *cuts], [*cuts, len(t)], strict=True)]
    return out


def units(text):
    """Units of a text, from the definition."""
    white, other = r"[ \t\n\x0b\f\r]", r"[^ \t\n\x0b\f\r]"
    out = []
    for line in split(rf"(?<=\n)(?=[ \t\x0b\f\r]*{other})", [text]):
        if len(line) <= line_chunks.LONG:
            out.append(line)
            continue
        for part in split(rf"(?<=[.!?]{white})(?={other})", [line]):
            clauses = rf"(?<=[,;:]{white})(?={other})"
            out += split(clauses, [part]) if len(part) > line_chunks.LONG else [part]
    return out


def chunks(text, mean=line_chunks.MEAN):
    """(first unit, last unit, text) of the chunks that count."""
    parts = units(text)
    bare = [u.strip(WHITE) for u in parts]
    begins = []
    for i in range(len(parts) - 1):
        seed = 42
        for u in bare[i : i + 2]:
            seed = h64(struct.pack("<Q", h64(u.encode())), seed)
        signed = seed - (1 << 64) if seed >> 63 else seed
        if signed % mean == 0:
            begins.append(i)
    out = []
    for begin, end in zip(begins, [*begins[1:], len(parts) - 1][: len(begins)], strict=True):
        some = bare[begin : end + 1]
        long = len(parts[begin]) + len(parts[end]) >= line_chunks.LEAST
        if some[0] and (parts[begin].endswith("\n") or long):
            out.append((begin, end, "\n".join(some)))
    return out


def brute(rows, mean=line_chunks.MEAN, spare=None):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    first = {}
    out = [t for _, t, *_ in rows]
    for i in order:
        if rows[i][1] is None:
            continue
        found = chunks(rows[i][1], mean)
        gone, sources = set(), {}
        for begin, end, text in found:
            source = first.setdefault(text, (i, begin))
            if source != (i, begin):
                gone.update(range(begin, end + 1))
                if source[0] != i:
                    sources[source[0]] = sources.get(source[0], 0) + 1
        if spare is not None and sources and max(sources.values()) >= spare * len(found):
            continue
        text, ended = "", False
        for k, u in enumerate(units(rows[i][1])):
            if k in gone:
                ended |= u.endswith("\n")
            else:
                text += ("\n" if ended and text and not text.endswith("\n") else "") + u
                ended = False
        out[i] = text
    return out


def sentence(rng, words=14):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words)) + "."


def texts():
    rng = random.Random(5)
    passage = [f"a passage of many words, line {i}" for i in range(9)]
    prose = " ".join(sentence(rng) for _ in range(6))
    long = ", ".join(sentence(rng, 9)[:-1] for _ in range(12)) + "."
    out = [None, "", "\n", "\n\n\n", " \n x", "one line", "x\ny", "x\ny", "é\n日本\n", prose, long]
    for i in range(60):
        own = [f"own {i} {k} {rng.random()}" for k in range(rng.randint(0, 6))]
        gap = rng.choice(["\n", "\n\n", "\r\n", "\n  \n"])
        out.append(gap.join(own[:2] + (passage[i % 3 :] if i % 4 else [prose]) + own[2:]))
        out.append(sentence(rng) + " " + (prose if i % 2 else long) + " " + sentence(rng))
    return out + ["\n".join(passage * 3)] * 5


@pytest.mark.parametrize(("mean", "spare"), [(1, None), (3, None), (1, 0.5)])
def test_removes_what_the_definition_removes(spark, folder, mean, spare):
    rows = [(i if i % 11 else None, t, -1, i, [1]) for i, t in enumerate(texts())]
    rows += [rows[20]] * 3
    docs = stored(spark, rows, SCHEMA, folder)
    got = line_chunks.dedup_lines(docs, mean, spare)
    assert got.columns == docs.columns
    # rows without doc_id and rows that repeat are told apart by place, which the table decides
    ordered = [tuple(r) for r in docs.collect()]
    want = brute(ordered, mean, spare)
    have = [r["text"] for r in got.collect()]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert sum(len(w or "") for w in want) < (0.9 if spare is None else 0.99) * sum(len(r[1] or "") for r in ordered)
    for r in got.collect():
        assert r["n_chars"] == -1 or r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("lines", [2, 3, 4, 6, 10, 0])
def test_planted_passages_go(spark, folder, lines):
    """``lines`` lines of 27 words, or one line of 60 words in sentences, in three texts each."""
    rng = random.Random(lines)
    rows, planted = [], []
    for k in range(40):
        if lines:
            passage = "\n".join(sentence(rng, 27) for _ in range(lines))
        else:
            passage = " ".join(sentence(rng, 15) for _ in range(4))
        for copy in range(3):
            around = ["\n".join(sentence(rng, rng.randint(5, 30)) for _ in range(4)) for _ in range(2)]
            rows.append((len(rows), f"{around[0]}\n{passage}\n{around[1]}", 0, 0, []))
            planted.append((copy, passage, around))
    docs = stored(spark, rows, SCHEMA, folder)
    got = {r["doc_id"]: r["text"] for r in line_chunks.dedup_lines(docs).collect()}
    left = 0
    for (doc_id, *_), (copy, passage, around) in zip(rows, planted, strict=True):
        parts = [u.strip() for u in units(passage)]
        if copy:
            left += sum(u in got[doc_id] for u in parts) / len(parts)
        else:
            assert passage in got[doc_id]  # the first one stays
        assert all(line in got[doc_id] for text in around for line in text.split("\n"))
    assert left <= 0.1 * 80


def test_no_unit_is_lost(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    before = {u.strip(WHITE) for r in docs.collect() for u in units(r.text or "")}
    after = "\0".join(r.text or "" for r in line_chunks.dedup_lines(docs).collect())
    assert all(u in after for u in before)


def test_beginnings_resist_shifts():
    passage = [f"line {i} of a passage" for i in range(30)]
    plain = {c for *_, c in chunks("\n".join(passage), 3)}
    shifted = {c for *_, c in chunks("\n".join(["new line", "another", *passage]), 3)}
    assert len(plain - shifted) <= 1 < len(plain)


def test_empty_table_and_no_python(spark, folder):
    docs = stored(spark, [], SCHEMA, folder)
    got = line_chunks.dedup_lines(docs)
    assert got.count() == 0 and "Python" not in plan(got) and "Arrow" not in plan(got)


def test_only_the_last_join_shuffles_when_the_result_is_read(spark, folder):
    """What is shuffled on the way leaves the disk before the texts are shuffled again."""
    docs = stored(spark, [(i, t, 0, 0, []) for i, t in enumerate(texts())], SCHEMA, folder)
    before = shuffled(spark)
    got = line_chunks.dedup_lines(docs)
    assert not left_on_disk(spark, before)
    assert plan(got).count("Exchange") <= 2
    assert got.count() == docs.count()


def test_query(spark, sf_dir):
    docs = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: t for (d, _), t in zip(docs, brute(docs), strict=True)}
    got = {r["doc_id"]: r["text"] for r in op5_line_dedup(spark, sf_dir).collect()}
    assert got == want
