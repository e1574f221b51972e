"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches, text_of

#: Kinds in their order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "shortcard", "localphone")
BASE = KINDS[:4]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCALPHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

#: Score of a proposal by kind, what a passed checksum adds, and the words that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "shortcard": 0.1, "localphone": 0.3}
CHECKED = {"card": 0.5, "iban": 0.5, "shortcard": 0.3}
CONTEXT = {
    "email": ("mail", "email", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "kreditkarte", "carte", "tarjeta"),
    "phone": ("phone", "telephone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "tax id"),
    "shortcard": ("card", "amex", "credit", "payment"),
    "localphone": ("phone", "telephone", "tel", "call", "mobile", "fax"),
}
#: Words that lower the score of any kind.
AGAINST = ("example", "sample", "version", "isbn", "order no", "part no", "test data")


def _whole_words(words: tuple[str, ...]) -> re.Pattern:
    """Any of ``words`` as a whole word, an s after it too; never a part of a longer word."""
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})s?(?!\w)", re.IGNORECASE)


NEAR = {kind: _whole_words(words) for kind, words in CONTEXT.items()}
NEVER = _whole_words(AGAINST)
WINDOW = 48
LEAST = 0.5


@dataclass(frozen=True)
class Span:
    kind: int
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans with a right checksum, leftmost and apart; of the ends at a space or the run's, the longest.

    A run takes in capital words and numbers that follow, so shorter ends are tried, and a run
    without one is searched again after its first letter.
    """
    at = 0
    while m := IBAN.search(text, at):
        start, end, at = m.start(), m.end(), m.start() + 1
        while end - start >= 15:
            if mod97(text[start:end]):
                yield start, end
                at = end
                break
            end = text.rfind(" ", start, end)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@`` and a dotted domain, in time linear in the text.

    No at sign is in the local part, so each sign has one candidate: the run before it.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, leftmost and apart within a kind, failing ones dropped."""
    out = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        # a part of very many digits is over 255 unless they are zeros
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def more_proposals(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, checksum passed) of the further kinds."""
    for start, end in ibans(text):
        yield 4, start, end, True
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield 5, m.start(), m.end(), False
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 15 and luhn(digits):
            yield 6, m.start(), m.end(), True
    for m in LOCALPHONE.finditer(text):
        yield 7, m.start(), m.end(), False


def score(text: str, kind: int, start: int, end: int, checked: bool) -> float:
    """The kind's prior, its checksum, and the whole words within WINDOW characters on either side."""
    name = KINDS[kind]
    low, high = max(0, start - WINDOW), min(len(text), end + WINDOW)
    value = PRIOR[name] + (CHECKED.get(name, 0) if checked else 0)
    # the window ends with a word, of at most WINDOW more characters
    while high < min(len(text), end + 2 * WINDOW) and text[high].isalnum():
        high += 1

    def near(words: re.Pattern) -> bool:
        # bounds, not slices: a word that begins before the window is seen as longer
        return words.search(text, low, start) is not None or words.search(text, end, high) is not None

    value += 0.3 * near(NEAR[name]) - 0.2 * near(NEVER)
    return min(1.0, max(0.0, value))


def find(text: str, least: float = LEAST) -> list[Span]:
    """All spans by kind, then start: base ones always, further ones scoring ``least`` or more.

    A further span is left out where it overlaps a base span. An empty text has none; the time is
    linear in a long one.
    """
    base = [Span(k, s, e, score(text, k, s, e, True)) for k, s, e in base_spans(text)]
    taken: list[list[int]] = []  # base spans of all kinds, merged and apart
    for s, e in sorted((b.start, b.end) for b in base):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    more, at = [], 0
    for k, s, e, checked in sorted(more_proposals(text), key=lambda x: x[1]):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        clear = at == len(taken) or taken[at][0] >= e
        if clear and (v := score(text, k, s, e, checked)) >= least:
            more.append(Span(k, s, e, v))
    return sorted(base + more, key=lambda x: (x.kind, x.start))


SCHEMA = "array<struct<kind:int,start:bigint,end:bigint,score:double>>"


def find_personal_data(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id and spans (kind as a position in KINDS, code points, end exclusive) for every row.

    Null text is empty text and has no spans; repeated rows give repeated rows; an empty table
    gives an empty result; further columns are ignored.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            spans = [[vars(s) for s in find(t, least)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SCHEMA}")
