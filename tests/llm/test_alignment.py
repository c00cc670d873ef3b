import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricelake.llm import alignment
from pricelake.llm.alignment import Aligner, Lengths, Tokens
from pricelake.llm.queries import op13_alignment
from tests.llm.conftest import stored

A = tokenizers.path("byte_bpe_50k.json")
B = tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, pairs double, at binary, place int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def alphabet():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def twin(rows, libraries):
    """The query's result for (doc_id, text), token by token."""
    a, b = libraries
    to_byte = alphabet()
    found = []
    for doc_id, text in rows:
        tokens = []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            raw_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
            ids_b = b.encode(text)
            raw_b = [
                bytes([int(b.id_to_piece(i)[3:5], 16)])
                if b.is_byte(i)
                else b.id_to_piece(i).replace("▁", " ").encode()
                for i in ids_b
            ]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                for ids, raw in ((ids_a, raw_a), (ids_b, raw_b)):
                    ends = np.cumsum([len(x) for x in raw]).tolist()
                    tokens.append(list(zip(ids, [0, *ends[:-1]], ends, strict=True)))
        found.append((doc_id, tokens))
    held = Counter()
    linked = []
    for _, tokens in found:
        links = []
        if tokens:
            j = 0
            for i, s, e in tokens[0]:
                while tokens[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(tokens[1]) and tokens[1][k][1] < e:
                    links.append((i, tokens[1][k][0]))
                    k += 1
        linked.append(links)
        held.update(set(links))
    highest = Counter()
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    out = []
    for (doc_id, tokens), links in zip(found, linked, strict=True):
        if not tokens:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({e for *_, e in tokens[0]} & {e for *_, e in tokens[1]})
        groups, low = [], 0
        for high in common:
            sides = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in tokens]
            groups.append("|".join(sides))
            low = high
        out.append(
            (
                doc_id,
                len(tokens[0]),
                len(tokens[1]),
                len(groups),
                len(links),
                sum(held[x] == highest[x[0]] for x in links),
                sum(held[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest(),
            )
        )
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def odd_texts():
    rng = random.Random(11)
    kinds = ["it's ", "Then, ", "\n\n", "  \t x", "äöü ß ", "日本語", "12345 6,7 ", "!!?...", "🙂 ", "▁", "<s> ", "\x00", "ing", "tion "]
    made = ["".join(rng.choice(kinds) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    clean = [x.replace("▁", "_") for x in made]
    return [None, "", " ", "  ", "\n", "a", "▁", "<|endoftext|> </s>", "x" * 900, " " * 300, "日本" * 300, *made, *clean]


def test_any_tree_of_ranges_gives_the_same():
    rng = np.random.default_rng(2)
    aligner = Aligner(Lengths(np.ones(50, np.int32), np.ones(40, np.int32)))
    for _ in range(60):
        n = int(rng.integers(1, 120))
        ends = [np.union1d(np.flatnonzero(rng.random(n) < p) + 1, [n]) for p in rng.choice([0.05, 0.3, 0.9], 2)]
        tokens = Tokens(
            rng.integers(0, 50, len(ends[0])).astype(np.uint32),
            ends[0],
            rng.integers(0, 40, len(ends[1])).astype(np.uint32),
            ends[1],
        )
        want = aligner.closed(tokens)
        edges = np.union1d(rng.integers(0, n, 6), [0, n])
        parts = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            a, b = ((e > low) & (e <= high) for e in ends)
            parts.append(aligner.fragment(Tokens(tokens.a[a], ends[0][a], tokens.b[b], ends[1][b])))
        while len(parts) > 1:
            at = int(rng.integers(0, len(parts) - 1))
            many = int(rng.integers(2, 4))
            parts[at : at + many] = [aligner.composed(parts[at : at + many])]
        got = aligner.whole(parts[0])
        assert not len(parts[0].tail.a) and not len(parts[0].tail.b)
        assert got[:4] == want[:4]
        assert (got.pairs == want.pairs).all() and (got.times == want.times).all()


@pytest.mark.parametrize(("chunk", "size", "arity"), [(16, 24, 2), (64, 7, 3), (100_000, 1000, 8)])
def test_against_token_by_token(spark, folder, libraries, chunk, size, arity):
    rows = [(i if i % 7 else None, t, "x", 0.5, b"z", i) for i, t in enumerate(odd_texts())]
    rows += [rows[-1], rows[-1], rows[20]]
    docs = stored(spark, rows, SCHEMA, folder)
    want = plain(twin([r[:2] for r in rows], libraries))
    for most in {alignment.MOST_SENT, 0 if chunk == 16 else alignment.MOST_SENT}:  # sent, joined
        got = alignment.align(docs, A, tokenizers.PATTERN, B, chunk, size, arity, most)
        assert plain(got.collect()) == want


def test_empty_table(spark, folder):
    docs = stored(spark, [], SCHEMA, folder)
    assert alignment.align(docs, A, tokenizers.PATTERN, B).collect() == []


def test_query(spark, sf_dir, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op13_alignment(spark, sf_dir)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert plain(got.collect()) == plain(twin(docs, libraries))
