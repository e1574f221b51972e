"""Quality rules, lines first: clean the lines, then reject documents that lose too much text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

SYMBOLS = "#*$%&|<>"
#: Lines are boilerplate if they hold one of these and are short.
BOILERPLATE = re.compile(r"\b(?:javascript|lorem ipsum|cookies?|terms of (?:use|service)|privacy policy|all rights reserved|sign (?:in|up)|log ?in|subscribe|read more|click here|copyright)\b", re.IGNORECASE | re.ASCII)
ENDS = tuple(".!?:;,\"'”’»)]…。！？")


@dataclass(frozen=True)
class Rules:
    """Thresholds: base rules on the document, then rules on lines, then the loss allowed."""

    least_words: int = 50
    most_repeated: float = 0.5
    #: a line of at least this many words needs no end mark; a shorter one does
    open_line_words: int = 5
    #: symbols for each word above which a line is markup or junk
    line_symbols: float = 0.5
    #: separators for each word above which a line is a menu or table
    line_separators: float = 0.3
    #: share of capitals among letters above which a line with exclamation marks shouts
    line_capitals: float = 0.8
    boilerplate_words: int = 25
    #: share of the words that may be lost
    most_lost: float = 0.5


def line_fails(line: str, words: list[str], rules: Rules) -> str:
    """The name of the first rule that the line breaks, or an empty string."""
    n = len(words)
    if line.count("|") + line.count(" > ") + line.count(" » ") >= max(2, rules.line_separators * n):
        return "navigation"
    if sum(map(line.count, SYMBOLS)) > rules.line_symbols * n:
        return "symbols"
    if n <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    if line.count("!") >= 0.5 * n and n > 2:
        letters = sum(map(str.isalpha, line))
        if letters and sum(map(str.isupper, line)) >= rules.line_capitals * letters:
            return "shouting"
    if n < rules.open_line_words and not line.rstrip().endswith(ENDS):
        return "punctuation"
    return ""


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, each word once."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    k = len(number)
    pairs = ids[:-1] * k + ids[1:]
    if k < 1 << 20:
        windows = pairs[:-1] * k + ids[2:]
    else:
        windows = np.unique(pairs[:-1], return_inverse=True)[1] * k + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return int(covered.sum())


def measure(text: str, rules: Rules = Rules()) -> tuple[int, int, int, int, int, bool, bool, str]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    spaces = sum(map(text.count, "\x20\t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(words)
    seen: set[str] = set()
    dups = lost = 0
    clean: list[str] = []
    for line in text.split("\n"):
        # cut at ASCII white space only, as for words
        parts = line.split() if line.isascii() and not any(c in line for c in "\x1c\x1d\x1e\x1f") else [w for w in re.split("[\x20\x09-\x0d]+", line) if w]
        if not parts:
            clean.append(line)
            continue
        if line in seen:
            dups += 1
        seen.add(line)
        if line_fails(line, parts, rules):
            lost += len(parts)
        else:
            clean.append(line)
    base_failed = n < rules.least_words or 100 * repeats > 100 * rules.most_repeated * n
    kept = not base_failed and lost <= rules.most_lost * n
    return n, len(text) - spaces, symbols, dups, repeats, base_failed, kept, "\n".join(clean)


def apply_rules(docs: DataFrame, rules: Rules = Rules(), clean_text: bool = True) -> DataFrame:
    """Measures and verdict for every row of ``docs`` (doc_id, text): see ``measure``.

    With ``clean_text`` the text without its failing lines comes as a column.

    Null text is empty text, which fails; repeated rows give repeated rows, an empty table an empty
    result; further columns are ignored.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"][: 8 if clean_text else 7]
    kinds = ([pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()])[: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = [measure(t, rules)[: len(names)] for t in batch.column(1).to_pylist()]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean" + ", clean_text string" * clean_text)


def keep_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are (texts are not cut).

    Null text is empty text and goes; repeated rows stay or go alike; an empty table stays empty.
    """
    columns = docs.columns

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in small_batches(batches):
            kept = [measure(t or "", rules)[6] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(verdict, docs.schema)
