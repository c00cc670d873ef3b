import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pricelake.llm import best_fit
from pricelake.llm.pretokens import ByteLevelBpe, WordBpe, read_vocabulary
from pricelake.llm.queries import op12_best_fit
from tests.llm.conftest import stored

PATH = tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, place double, length binary"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(5)
    letters = "abcdeABC  \n\t'sltmvred.,;:!?0123²½éÉßÿĀȺ€—’\x00\x1c\x1d\x7f<|endoftext|>_-@#+İ日́"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    return [*made, "", " ", "\n", "a", "<|endoftext|> <|startoftext|>", "don't 's 'tis we'll", "x" * 3000]


@pytest.mark.parametrize("plain", [False, True])
def test_words_give_what_the_library_gives(plain):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = plain
    texts = odd_texts()
    got = WordBpe(read_vocabulary(PATH), plain)(pa.array(texts))
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("plain", [False, True])
def test_bytes_give_what_the_library_gives(plain):
    path = tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = plain
    encode = ByteLevelBpe(read_vocabulary(path), tokenizers.PATTERN, plain)
    rng = random.Random(8)
    parts = ["12", " 7", "a", " b", "\n", "  ", ".", ",", "'s", "²", "é", " ", "\t", "!?", "...", "0"]
    texts = odd_texts() + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_parts_of_a_long_text(library):
    encode = WordBpe(read_vocabulary(PATH))
    text = "It's one, two\n\n  three! " * 50 + "z" * 90 + " end"
    for size in (1, 7, 64):
        parts = best_fit.cut_at_space(text, size)
        assert "".join(parts) == text and len(parts) > 5
        ids = np.concatenate(encode(pa.array(parts))).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def plain_best_fit(sizes, window, most):
    """(bin, offset) of each size by trying all open bins."""
    used, open_bins, out = [], [], []
    for size in sizes:
        fits = [b for b in open_bins if window - used[b] >= size]
        if fits:
            least = min(window - used[b] for b in fits)
            out.append((least, None))
            found = [b for b in fits if window - used[b] == least][-1]
        else:
            out.append((None, None))
            if len(open_bins) == most:
                open_bins.remove(max(open_bins, key=lambda b: used[b]))
            used.append(0)
            found = len(used) - 1
            open_bins.append(found)
        out[-1] = (found, used[found])
        used[found] += size
        open_bins.remove(found)
        if used[found] < window:
            open_bins.append(found)
    return out, used


@pytest.mark.parametrize(("window", "most"), [(32, 1), (32, 4), (64, 1000)])
def test_bins_against_trying_all(window, most):
    rng = random.Random(window + most)
    sizes = [rng.randint(1, window) for _ in range(700)]
    bins = best_fit.Bins(window, most)
    got = []
    for size in sizes:
        got.append(bins.put(size))
        assert bins.open <= most
    want, used = plain_best_fit(sizes, window, most)
    # bins of equal free space are interchangeable: the same room is left at every step
    assert [offset for _, offset in got] == [offset for _, offset in want]
    assert bins.opened == len(used)


def check_pieces(rows, docs, library, window):
    """Every id of every row in one piece, and sequences without gaps; the number of sequences."""
    want = defaultdict(int)
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), window)):
            x = ids[a : a + window]
            want[doc_id, k, a, len(x), zlib.crc32(x)] += 1
    sequences = defaultdict(list)
    for r in rows:
        want[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] -= 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


def test_odd_rows(spark, folder, library):
    texts = [None, "", " ", "one two", "a <|endoftext|> b", "wörld " * 900, "a b c d e " * 200, "日本 語"]
    rows = [(i if i % 3 else None, t, "x", 1.5, b"y") for i, t in enumerate(texts * 6)]
    docs = stored(spark, [*rows, rows[4], rows[4]], SCHEMA, folder)
    got = best_fit.pack(docs, PATH, 64, 8, 10).collect()
    check_pieces(got, [r[:2] for r in [*rows, rows[4], rows[4]]], library, 64)


def test_empty_table(spark, folder):
    docs = stored(spark, [], SCHEMA, folder)
    assert best_fit.pack(docs, PATH).collect() == []


def test_query_wastes_little(spark, sf_dir, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op12_best_fit(spark, sf_dir).collect()
    n = check_pieces(rows, docs, library, 2048)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1
    assert {(r.doc_id, r.piece, r.sequence_id, r.offset) for r in rows} == {
        (r.doc_id, r.piece, r.sequence_id, r.offset) for r in op12_best_fit(spark, sf_dir).collect()
    }
