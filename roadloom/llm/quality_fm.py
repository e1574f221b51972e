"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Pairwise interactions have low rank, so a row is scored in time linear in its features: the sum
over pairs of <v_i, v_j> x_i x_j is half of (sum of v x) squared less the sum of (v x) squared.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

#: Slots for hashed words and for hashed endings; structure and metadata follow.
WORD_SLOTS = 512
MARK_SLOTS = 64
STRUCTURE = 26
SIZE = WORD_SLOTS + MARK_SLOTS + STRUCTURE
#: Rows that the model is fitted on at most: the training rows with the smallest hashes of doc_id.
FIT_ROWS = 12_000

_CLASS = np.zeros(256, dtype=np.int64)
for _name, _bytes in enumerate([b"", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".?:;,'\"()-", b"!", b"|", b"#*$%&<>", b"@/\\=+_[]{}~^`"]):
    _CLASS[list(_bytes)] = _name
_SIGN = bytes(b"-aA0   .!|#@"[c] for c in _CLASS)
RUN = re.compile(rb"(.)\1+")
#: Longer words are hashed each time, so that the memo stays small.
MEMO_BYTES = 64
_MEMO: dict[bytes, tuple[int, int]] = {}


def _slots(word: bytes) -> tuple[int, int]:
    """The hashed slots of a word and of the pattern of its characters."""
    if (found := _MEMO.get(word)) is None:
        pattern = RUN.sub(rb"\1", word.translate(_SIGN))
        found = (zlib.crc32(word.lower()) % WORD_SLOTS, WORD_SLOTS + zlib.crc32(pattern) % MARK_SLOTS)
        if len(word) > MEMO_BYTES:
            return found
        if len(_MEMO) >= 300_000:
            _MEMO.clear()
        _MEMO[word] = found
    return found


def features(text: str) -> np.ndarray:
    """The features of a whole text as float32: hashed words and patterns, then structure."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    x = np.zeros(SIZE, dtype=np.float32)
    counts = Counter(words)
    if n:
        distinct = np.fromiter((s for w in counts for s in _slots(w)), dtype=np.int64, count=2 * len(counts)).reshape(-1, 2)
        often = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        x[: WORD_SLOTS + MARK_SLOTS] += np.bincount(distinct[:, 0], np.log1p(often), SIZE)[: WORD_SLOTS + MARK_SLOTS]
        x[:WORD_SLOTS] /= max(1e-9, float(np.linalg.norm(x[:WORD_SLOTS])))
        x[WORD_SLOTS : WORD_SLOTS + MARK_SLOTS] = np.sqrt(np.bincount(distinct[:, 1], often, SIZE)[WORD_SLOTS : WORD_SLOTS + MARK_SLOTS] / n)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=11) if data else np.zeros(11)
    size = max(1, len(data))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    rows = Counter(lines)
    length = max(1, n)
    starts = sum(1 for line in lines if line[0].islower())
    ends = sum(1 for line in lines if line.rstrip()[-1] in ".!?:;\"')")
    top = counts.most_common(2)
    doubles = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    letters = max(1, int(kinds[1] + kinds[2]))
    x[WORD_SLOTS + MARK_SLOTS :] = [
        *(kinds / size),
        math.log1p(n) / 10,
        math.log1p(len(data)) / 12,
        n < 50,
        n < 15,
        (len(counts) / length) ** 0.5,
        kinds[2] / letters,
        (kinds[7] / length) ** 0.5 if n else 0,
        (kinds[8] / length) ** 0.5 if n else 0,
        min(2.0, kinds[9] / length),
        len(rows) / max(1, len(lines)),
        starts / max(1, len(lines)),
        ends / max(1, len(lines)),
        (top[0][1] / length) if top else 0,
        (doubles / length) ** 0.5,
        math.log1p(len(lines)) / 8,
    ]
    return x


@dataclass
class FactorisationMachine:
    """Bias, weights and factors over scaled features; ``score`` is the chance of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -4, 4)
        return self.bias + z @ self.weights + 0.5 * ((z @ self.factors) ** 2 - (z**2) @ (self.factors**2)).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rank: int = 8, epochs: int = 30, rate: float = 0.02, decay: float = 1e-3, batch: int = 256, seed: int = 7) -> FactorisationMachine:
        """Logistic loss by Adam over shuffled batches; without rows of both labels a constant."""
        size = x.shape[1]
        mean = x.mean(axis=0) if len(x) else np.zeros(size, np.float32)
        scale = 1 / np.maximum(x.std(axis=0), 0.02) if len(x) else np.ones(size, np.float32)
        rng = np.random.default_rng(seed)
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        model = cls(mean.astype(np.float32), scale.astype(np.float32), math.log(share / (1 - share)), np.zeros(size, np.float32), (rng.standard_normal((size, rank)) * 0.01).astype(np.float32))
        if len(y) == 0 or y.min() == y.max():
            model.factors[:] = 0
            return model
        # hashed words carry little each, so they are held down more
        hold = np.full(size, decay, np.float32)
        hold[:WORD_SLOTS] *= 10
        state = [np.zeros(1, np.float32), model.weights, model.factors]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in state]
        z = np.clip((x - model.mean) * model.scale, -4, 4)
        step, base = 0, model.bias
        for epoch in range(epochs):
            now = rate * (1 - epoch / epochs)
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                b = z[rows]
                xv = b @ model.factors
                raw = model.bias + b @ model.weights + 0.5 * (xv**2 - (b**2) @ (model.factors**2)).sum(axis=1)
                miss = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) / len(rows)
                grads = [np.array([miss.sum()], np.float32), b.T @ miss + hold * model.weights, b.T @ (miss[:, None] * xv) - ((b**2).T @ miss)[:, None] * model.factors + hold[:, None] * model.factors]
                step += 1
                for p, g, (m, v) in zip(state, grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
                model.bias = base + float(state[0][0])
        return model


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id's text modulo 5; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features as float32 bytes, for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["doc_id", "x"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x binary")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> FactorisationMachine:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out fold.

    They are the ones with the smallest hashes of doc_id, so the sample is the same at every run.
    Of several texts under one doc_id the one with the smallest features counts, of several labels
    the largest. Rows without a label or with a null doc_id, and labels other than 0 and 1, are left
    out; null text is empty text; without rows the score is a constant; further columns are ignored.
    """
    marked = labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)").groupBy("label_id").agg(F.max("y").alias("y"))
    chosen = marked.where(remainder("label_id") != 0).orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # repeated rows of a document would weigh more, and the bound counts rows
    keyed = feature_rows(rows.select(F.struct("doc_id", "y").alias("doc_id"), "text"))
    got = keyed.groupBy("doc_id.doc_id", "doc_id.y").agg(F.min("x").alias("x")).orderBy("doc_id").limit(fit_rows).toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, SIZE)
    return FactorisationMachine.fit(x, np.array(got.column("y").to_pylist(), dtype=np.float32))


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """doc_id and score for every row of ``docs`` (doc_id, text).

    Null text is empty text and has a score too; repeated rows give repeated rows; an empty table
    gives an empty result; further columns are never read.
    """
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            values = model.score(np.stack([features(t) for t in texts])) if texts else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
