"""Personal data by anchor expansion (operator 4).

One Aho-Corasick automaton finds anchors in the whole text: at-signs, URL schemes, plus
signs, digits and cue words of identifiers. From an anchor a deterministic parser
expands to the boundaries of its kind and validates what it found; text without anchors
is passed over once. Each kind is read from left to right, without overlaps:

* ``email``: from an at-sign, left over the characters of a local part, right over a
  domain of two labels or more.
* ``ip``: from a digit, four numbers joined by dots, each at most 255.
* ``card``: from a digit, digits with single blanks or hyphens between them, 13 to 19 of
  them, with a right Luhn sum.
* ``phone``: from a plus sign, an international number of 9 to 15 digits.
* ``iban``, ``ssn``, ``account``: identifiers that follow their cue word; an IBAN needs a
  right check number. Its end is sought among the blanks and the end of the capitals and
  digits that follow: the length of its country first, then the longest.
* ``login``: the user part of a URL, from its scheme.

The first four are the base kinds. A base match that fails its check is dropped and not
read again from a later start. Spans are places of code points, end exclusive.

Defined results: NULL text is empty and holds nothing. Every row gives one row, also
repeated ones and those without doc_id. Texts are searched whole, and runs of digits or
other characters of any length are read once. Spans that overlap are masked as one, by
the kind that comes first in KINDS where they begin together. Finding ignores other
columns, masking passes them unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "account", "login")
SPANS = "array<struct<kind:string,start:long,end:long>>"
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "passport", "konto", "compte", "cuenta"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LINK = re.compile(r"(?:[\x20:#.=]|[Nn](?:o|umber|r|um)\b|is\b)*")
_IDENTIFIER = {
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "ssn": re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"),
    "account": re.compile(r"[A-Z]{0,3}[0-9][0-9-]{4,16}[0-9](?![A-Za-z0-9])"),
}
_IBAN_LENGTHS = dict(
    re.findall(
        r"([A-Z]{2})([0-9]{2})",
        "AD24AE23AL28AT20AZ28BA20BE16BG22BH22BR29BY28CH21CR22CY28CZ24DE22DK18DO28EE20EG29ES24"
        "FI18FO18FR27GB22GE22GI23GL18GR27GT28HR21HU28IE22IL23IQ23IS26IT27JO30KW30KZ20LB28LC32"
        "LI21LT20LU20LV21MC27MD24ME22MK19MR27MT31MU30NL18NO15PK24PL28PS29PT25QA29RO24RS22SA24"
        "SC31SE24SI19SK24SM27ST25SV28TL23TN24TR26UA29VA22VG24XK20",
    )
)
_LEAST_IBAN = 15
_USER = re.compile(r"[^\s/?#@]+(?=@)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban_end(text: str) -> int:
    """Where the IBAN that ``text`` begins with ends; 0 if no end has a right check number."""
    ends = [m.start() for m in re.finditer(r" |$", text)][::-1]
    length = {end: end - text.count(" ", 0, end) for end in ends}
    own = int(_IBAN_LENGTHS.get(text[:2], 0))
    ends.sort(key=lambda end: length[end] != own)
    return next((end for end in ends if length[end] >= _LEAST_IBAN and iban(text[:end])), 0)


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")  # of which there may be thousands
    return len(digits) <= 3 and int(digits or "0") <= 255


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, "digit")
    for anchor in "@+":
        found.add_word(anchor, anchor)
    found.add_word("://", "login")
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                found.add_word(form, kind)
    found.make_automaton()
    return found


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a whole text, by kind as in KINDS, then by start."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    after = dict.fromkeys(KINDS, 0)  # where each kind may start again
    for at, anchor in anchors.iter(text):
        if anchor == "digit":
            if at >= after["ip"]:
                match = _IP.match(text, at)
                if match:
                    after["ip"] = match.end()
                    if all(_octet(n) for n in match[0].split(".")):
                        spans["ip"].append(match.span())
                else:
                    after["ip"] = _DIGITS.match(text, at).end()
            if at >= after["card"]:
                match = _CARD.match(text, at)
                after["card"] = match.end() if match else at + 1
                if match:
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(match.span())
        elif anchor == "@":
            start = at
            while start > after["email"] and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match:
                spans["email"].append((start, match.end()))
                after["email"] = match.end()
        elif anchor == "+":
            match = _PHONE.match(text, at) if at >= after["phone"] else None
            if match:
                after["phone"] = match.end()
                if 9 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
                    spans["phone"].append(match.span())
        elif anchor == "login":
            match = _USER.match(text, at + 1)
            if match:
                spans["login"].append(match.span())
        elif at >= after[anchor]:
            match = _IDENTIFIER[anchor].match(text, _LINK.match(text, at + 1).end())
            size = len(match[0]) if match else 0
            if match and anchor == "iban":
                size = iban_end(match[0])
            if size:
                spans[anchor].append((match.start(), match.start() + size))
                after[anchor] = match.start() + size
    return [(kind, *span) for kind in KINDS for span in spans[kind]]


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, and spans that overlap as one, replaced by <KIND>."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, KINDS.index(k)) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _span_array(found: list[list[tuple[str, int, int]]]) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in found]
    return pa.array(rows, pa.list_(kind))


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        found = [find_spans(text, anchors) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), _span_array(found)], names=["doc_id", "spans"])


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row of ``docs`` (doc_id, text); other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_detect, f"doc_id long, spans {SPANS}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(detected: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return detected.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _masker(column: int, chars: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            texts = [
                None if t is None else masked(t, find_spans(t, anchors))
                for t in batch.column(column).to_pylist()
            ]
            new = pa.array(texts, batch.schema.field(column).type)
            columns = list(batch.columns)
            columns[column] = new
            if chars is not None:
                length = pc.utf8_length(new)
                columns[chars] = length.cast(batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with its personal data replaced by <KIND>; n_chars, if there, follows.

    Every row and column stays; NULL text stays NULL.
    """
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return docs.mapInArrow(_masker(docs.columns.index("text"), chars), docs.schema)
