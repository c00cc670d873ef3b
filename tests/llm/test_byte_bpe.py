import base64
import hashlib
import random

import public_tokenizers as tokenizers
import pytest
import tiktoken

from pricelake.llm import byte_bpe
from pricelake.llm.queries import op8_byte_bpe
from tests.llm.conftest import stored

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    kinds = ["it's we'll they've ", "  \n\n \t x  ", "äöü ß 日本語 ", "12345 6,7 ", "!!??...", "🙂👩‍👩‍👧 "]
    long = ["".join(rng.choice(kinds) for _ in range(rng.randint(30, 400))) for _ in range(25)]
    runs = ["a" * 700, " " * 500 + "b" * 300 + " " * 40 + "c", "ab'" * 200, "x" + "\n" * 333 + "y " * 90]
    return [None, "", " ", "\n", "'", "hi", "<|endoftext|>", *runs, *long]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (200, 32), (32_768, 1_024)])
def test_chunks_give_what_the_library_gives(spark, folder, library, chunk, overlap):
    rows = [(i if i % 5 else None, t, i) for i, t in enumerate(texts())]
    docs = stored(spark, [*rows, rows[-1], rows[-1]], "doc_id long, text string, ids int", folder)
    got = byte_bpe.encode_texts(docs, PATH, tokenizers.PATTERN, chunk, overlap, decode=True)
    want = [(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in [*rows, rows[-1], rows[-1]]]
    assert sorted((str(r[0]), r[1], bytes(r[2])) for r in got.collect()) == sorted((str(d), i, b) for d, i, b in want)


def test_decoding_alone(spark, library):
    rows = [(1, library.encode_ordinary("naïve 日本")), (2, []), (None, None)]
    got = byte_bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH, tokenizers.PATTERN)
    assert {(r[0], bytes(r[1])) for r in got.collect()} == {(1, "naïve 日本".encode()), (2, b""), (None, b"")}


def test_empty_table_and_bad_overlap(spark, folder):
    docs = stored(spark, [], "doc_id long, text string", folder)
    assert byte_bpe.encode_texts(docs, PATH, tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="stitched"):
        byte_bpe.encode_texts(docs, PATH, tokenizers.PATTERN, 64, 60)


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = set()
    for doc in docs:
        ids = library.encode_ordinary(doc["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.add((doc["doc_id"], len(ids), digest, hashlib.sha256((doc["text"] or "").encode()).hexdigest()))
    assert {tuple(r) for r in op8_byte_bpe(spark, sf_dir).collect()} == want
