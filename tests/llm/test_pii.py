import hashlib
import random
import re
import time

from pricelake.llm import pii
from pricelake.llm.queries import op4_pii
from tests.llm.conftest import stored

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def right(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(n) <= 255 for n in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in pattern.finditer(text)
        if right(kind, m[0])
    ]


def base(text):
    return [s for s in pii.find_spans(text, pii.automaton()) if s[0] in pii.BASE]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(11)
    parts = [
        "a@b.co", "@", "x.y+z@", "b-c.d", ".", "..", "1.2.3.4", "256.1.1.1", "1.1.1.1.1.1.1.1", "0001.2.3.004",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "49927398716", " ", "-", "+", "+1",
        "+1 (238) 555-6608", "+49 30 1234567", "(", ")", "7", "12", "é", "日", "🙂", "://", "u:p@h.org", "iban ",
    ]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert base(text) == brute(text), text


def runs(n):
    return ("1" * n, "1." * n, "a" * n + "@", "@" * n, "+1" + "(" * n, "+" * n, "1 " * n, "a@b." * n)


def test_long_runs_are_read_once():
    for text in runs(1_000):
        assert base(text) == brute(text)
    begin = time.process_time()
    for text in runs(200_000):
        base(text)
    assert time.process_time() - begin < 20


def test_very_long_digit_runs(spark, folder):
    for place in range(4):
        for digits in ("0" * 5000, "0" * 5000 + "7", "9" * 5000, "1" + "0" * 5000):
            parts = ["1", "2", "3", "4"]
            parts[place] = digits
            text = f"x {'.'.join(parts)} y +{digits} z {digits}"
            want = [("ip", 2, 2 + len(".".join(parts)))] if digits.lstrip("0") in ("", "7") else []
            assert [s for s in base(text) if s[0] == "ip"] == want
    rows = [(i, f"1.2.3.{d * 5000} a@{d * 5000}.{d} +{d * 5000}", 0) for i, d in enumerate("019")]
    docs = stored(spark, rows, "doc_id long, text string, n_chars long", folder)
    texts = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert texts[0].startswith("<IP> <EMAIL>") and texts[1].startswith("1.2.3.1")
    assert pii.detect(docs).count() == 3


def test_added_kinds():
    text = "IBAN: DE89 3704 0044 0532 0130 00, ssn 078-05-1120, account no. 12345678, https://joe:pw@host.org/x"
    found = {(k, text[a:b]) for k, a, b in pii.find_spans(text, pii.automaton())}
    assert found >= {
        ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "078-05-1120"), ("account", "12345678"), ("login", "joe:pw"),
    }
    wrong = "IBAN: DE89 3704 0044 0532 0130 01"
    assert not [s for s in pii.find_spans(wrong, pii.automaton()) if s[0] == "iban"]


def test_text_in_capitals_after_an_iban():
    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for number in (plain, spaced, "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"):
        for rest in (" BIC COBADEFF", " 12 345", " AND MORE WORDS IN CAPITALS, 7", " A", ".", ""):
            text = f"IBAN {number}{rest}"
            spans = [s for s in pii.find_spans(text, pii.automaton()) if s[0] == "iban"]
            assert [text[a:b] for _, a, b in spans] == [number], text
    assert not [s for s in pii.find_spans("IBAN DE89 3704 0044 0532 0130 01 BIC", pii.automaton()) if s[0] == "iban"]


def test_mask_keeps_rows_and_columns(spark, folder):
    rows = [(1, "mail a@b.co now", 15, "x"), (None, None, None, "y"), (2, "", 0, None), (1, "+1 (238) 555-6608!", 18, "x")]
    docs = stored(spark, rows, "doc_id long, text string, n_chars long, spans string", folder)
    got = sorted(map(tuple, pii.mask(docs).collect()), key=str)
    assert got == sorted(
        [(1, "mail <EMAIL> now", 16, "x"), (None, None, None, "y"), (2, "", 0, None), (1, "<PHONE>!", 8, "x")], key=str
    )
    assert pii.mask(docs.limit(0)).count() == 0 and pii.detect(docs.limit(0)).count() == 0
    assert {(r["doc_id"], len(r["spans"])) for r in pii.detect(docs).collect()} == {(1, 1), (None, 0), (2, 0)}


def test_overlapping_spans_are_masked_once():
    text = "call +4111111111111111 or 4111111111111111"
    assert pii.masked(text, [("card", 6, 22), ("phone", 5, 22), ("card", 26, 42)]) == "call <PHONE> or <CARD>"


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in op4_pii(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    found = 0
    for doc in docs:
        spans, row = brute(doc["text"] or ""), got[doc["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert row["spans"].startswith(joined)
        found += len(spans)
    assert found
