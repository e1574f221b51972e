"""Hard negatives against all products in plain integers, Strassen's recursion, heaps, odd tables."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadloom.llm import hard_negatives
from roadloom.llm.hard_negatives import Heaps, strassen

from .conftest import key

TYPES = "vec_id long, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 9), st.integers(1, 4), st.integers(0, 2**32 - 1))
def test_strassen_is_exact(m, k, n, leaf, seed):
    """Odd sides, and values whose intermediate sums leave 64 bits."""
    r = np.random.default_rng(seed)
    a, b = r.integers(-(2**63), 2**63 - 1, (m, k)), r.integers(-(2**63), 2**63 - 1, (n, k))
    assert (strassen(a, b, leaf) == a @ b.T).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-3, 3), st.integers(0, 5), st.booleans(), st.integers(0, 99)), max_size=40), st.integers(1, 4))
def test_heaps_merge(entries, parts):
    """Whatever order entries come in, the first of each slot are left."""
    heaps = Heaps(3, 2)
    for p in range(parts):
        own = entries[p::parts]
        heaps.merge(**{f: np.array([e[i] for e in own], bool if f == "none" else np.int64) for i, f in enumerate(Heaps.FIELDS)})
    got = list(zip(*(heaps.entries[f].tolist() for f in Heaps.FIELDS), strict=True))
    want = []
    for slot in range(3):
        want += sorted((e for e in entries if e[0] == slot), key=lambda e: (-e[1], e[3], e[2], e[4]))[:2]
    assert got == want


def brute(rows, most=5):
    """The contract over a list of (vec_id, embedding, label), by plain integers."""
    whole = [(n, i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v, label) in enumerate(rows) if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in whole:
        if a[1] is None or a[1] % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[3], c[3], strict=False)), c[1] is None, c[1] or 0, c[0], c[1], c[2]) for c in whole if c[0] != a[0]))
        for positive in [c for c in scored if c[5] == a[2]][:most]:
            p = -positive[0]
            fits = [c for c in scored if c[5] != a[2] and 80 * p <= -100 * c[0] <= 100 * p][:most]
            out += [(a[1], positive[4], k, c[4], p, -c[0]) for k, c in enumerate(fits, 1)]
    return out


def mined(df, **kw):
    return key(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **kw).collect())


def test_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute([tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()])
    assert mined(vectors) == key(want) and want


@pytest.mark.parametrize("tile, block, wave", [(7, 3, 1 << 20), (64, 2, 200), (5, 1, 24)])
def test_tiles_blocks_and_waves(spark, monkeypatch, tile, block, wave):
    """Ties, few distinct scores, several waves: the same rows."""
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    r = np.random.default_rng(3)
    rows = [(i * 25, [float(x) for x in r.integers(-2, 4, 3) / 4], int(r.integers(0, 3))) for i in range(60)]
    df = spark.createDataFrame(rows, TYPES).repartition(3)
    assert mined(df, wave_bytes=wave) == key(brute(rows))


def test_odd_rows(spark):
    """Nulls, values that aren't finite, repeated rows, short and empty vectors, no id, clashing columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.5, 0.5], 2), (None, [1.0, 0.4], 2), (3, [1.0, 0.45], 2), (4, [0.9, 0.5], 1), (5, [1.0], 1), (6, [], 3), (7, [0.95, 0.5], 2)]
    rows += [(200, None, 1), (300, [1.0, None], 1), (400, [nan, 1.0], 2), (500, [inf, 1.0], 2), (600, [1.0, 1.0], None)]
    df = spark.createDataFrame(rows, TYPES)
    for name in ("id", "row", "anchor", "parts", "tile", "slot", "score", "rank", "wave", "n"):
        df = df.withColumn(name, F.lit("clash"))
    want = brute(rows)
    assert mined(df) == key(want) and any(r[3] is None for r in want)


def test_empty(spark):
    none = spark.createDataFrame([], TYPES)
    assert hard_negatives.mine(none, F.col("vec_id") == 0).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], TYPES), F.col("vec_id") == 0).collect() == []
