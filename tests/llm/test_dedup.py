"""Exact and near dedup against brute force, and what they keep."""

import random

import pytest
from pyspark.sql import functions as F

from roadloom.llm import components, exact_dedup, queries, simhash
from roadloom.llm.components import connected_components

from . import brute
from .conftest import key, rows_of


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_exact_equals_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = rows_of(exact_dedup.resolve(df, keep="largest"), "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("sha"))
    assert key(got) == key(brute.exact(rows_of(df, "doc_id", "text")))


def test_exact_smallest_and_batches(spark, odd):
    index = exact_dedup.DigestIndex(spark, "smallest", fan_out=2)
    for part in range(3):
        index.add(odd.where(F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == part))
    got = index.resolve()
    assert got.count() == odd.count()
    one = {r.doc_id: r.keep_id for r in got.collect()}
    assert one[100] == 9 and one[3] == 3


def test_bytes_decide_under_one_digest(spark, odd):
    index = exact_dedup.DigestIndex(spark, "largest", digest=lambda t: F.substring(F.sha2(t, 256), 1, 1).cast("binary"))
    index.add(odd)
    got = rows_of(index.resolve(), "doc_id", "keep_id", "group_size", "kept")
    assert key(got) == key([r[:4] for r in brute.exact(rows_of(odd, "doc_id", "text"))])


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_exact_keeps_one_row_of_each_text(which, request):
    df = request.getfixturevalue(which)
    stay = exact_dedup.deduplicate(df, keep="largest")
    assert stay.columns == df.columns
    got = rows_of(stay, "doc_id", "text")
    best = {}
    for i, t in rows_of(df, "doc_id", "text"):
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert sorted((t or "", -1 if i is None else i) for i, t in got) == sorted(best.items())


def test_fingerprints_follow_the_contract(docs, odd):
    for df in (docs, odd):
        for text in {t for (t,) in rows_of(df, "text")}:
            assert simhash.fingerprint(text or "") % 2**64 == brute.fingerprint(text or "")


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_components_equal_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = [(i, fp % 2**64, c) for i, fp, c in rows_of(simhash.near_duplicates(df), "doc_id", "fp", "component_id")]
    assert key(got) == key(brute.components(rows_of(df, "doc_id", "text")))


@pytest.mark.parametrize("hot", [64, 4, 1])
def test_links_lose_no_pair_in_crowded_blocks(spark, hot):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(fps)[:6]:
        for _ in range(25):
            fps.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3) * (1 << rng.randrange(64)))
    signed = sorted(f - 2**64 if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = {r.vertex: r.component for r in connected_components(simhash.links(df, hot=hot)).collect()}
    want = {i: c for i, _, c in brute.components_of([(f, f % 2**64) for f in signed])}
    assert {f: got.get(f, f) for f in signed} == want


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_near_dedup_keeps_one_row_of_each_component(which, request):
    df = request.getfixturevalue(which)
    stay = simhash.deduplicate(df)
    assert stay.columns == df.columns
    fps = brute.components_of([(n, brute.fingerprint(t or "")) for n, (_, t) in enumerate(rows_of(df, "doc_id", "text"))])
    assert stay.count() == len({c for _, _, c in fps})
    ids = [r.doc_id for r in stay.collect()]
    if which == "docs":
        assert sorted(ids) == sorted({c for _, _, c in brute.components(rows_of(df, "doc_id", "text"))})


@pytest.mark.parametrize("few", [0, 300_000])
def test_chain_component(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_EDGES", few)
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "u bigint, v bigint")
    got = connected_components(edges)
    assert got.count() == n + 1 and got.where("component != 0").isEmpty()


@pytest.mark.parametrize("few", [0, 300_000])
def test_components_of_bytes(spark, monkeypatch, few):
    """The smallest vertex as Spark orders bytes; separate edges, loops and repeats; no edges."""
    monkeypatch.setattr(components, "FEW_EDGES", few)
    pairs = [(b"\xff", b"a"), (b"a", b"\x00b"), (b"z", b"zz"), (b"z", b"z"), (b"zz", b"z"), (b"q", b"q")]
    got = {bytes(r.vertex): bytes(r.component) for r in connected_components(spark.createDataFrame(pairs, "u binary, v binary")).collect()}
    assert got == {b"\xff": b"\x00b", b"a": b"\x00b", b"\x00b": b"\x00b", b"z": b"z", b"zz": b"z"}
    assert connected_components(spark.createDataFrame([], "u binary, v binary")).collect() == []


def test_query_columns(spark, sf_dir):
    assert queries.op3_simhash(spark, sf_dir).columns == ["doc_id", "fingerprint", "component_id"]


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_fingerprints_of_texts_in_parts(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    for text in ("", "  ", "one", "one two", " one  two ", "one two three", "a b c d e f g h i j k l m n o p " * 5, "é ü\n\nwide\tone", "x" * 100 + " y z", "end "):
        assert simhash.fingerprint(text) % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("fan_out", [2, 3, 9])
def test_batches_and_compactions_give_the_same_groups(spark, odd, keep, fan_out):
    """However rows are batched and runs compacted, the groups are those of all rows at once."""
    whole = exact_dedup.resolve(odd, keep)
    columns = ("doc_id", "digest", "keep_id", "group_size", "kept")
    index = exact_dedup.DigestIndex(spark, keep, fan_out)
    part = F.pmod(F.hash("doc_id", "text"), F.lit(5))
    for number in range(5):
        index.add(odd.where(part == number))
    assert key(rows_of(index.resolve(), *columns)) == key(rows_of(whole, *columns))
    assert all(run.rows.groupBy("digest").count().where("count > 1").isEmpty() for run in index.runs)


@pytest.mark.parametrize("small", [True, False])
def test_a_later_batch_is_probed_against_the_filters(spark, monkeypatch, small):
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 16_384 if small else 0)
    index = exact_dedup.DigestIndex(spark, "largest", fan_out=3)
    rows = [(i, f"text {i % 40}") for i in range(100)]
    for at in range(0, 100, 25):
        index.add(spark.createDataFrame(rows[at : at + 25], "doc_id bigint, text string"))
    assert len(index.runs) == 2
    asked = spark.createDataFrame([(1000 + i, f"text {i}") for i in range(80)] + [(None, None), (1000, "text 0")], "doc_id bigint, text string")
    want = {f"text {k}": max(i for i, t in rows if t == f"text {k}") for k in range(40)}
    got = {(r.doc_id, r.keep_id) for r in index.known(asked).collect()}
    assert got == {(1000 + i, want.get(f"text {i}")) for i in range(80)} | {(None, None)}
    assert index.known(asked).count() == 82 and index.known(asked.limit(0)).count() == 0
    if small:
        passed = index.runs[0].filter.probe(spark.createDataFrame([(bytes([i % 256, i // 256]) * 16,) for i in range(5000)], "digest binary")).where("__may").count()
        assert passed < 500


def test_filters_hold_all_their_digests(spark):
    df = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    held = exact_dedup.Filter(df)
    assert held.bitmaps_wanted == 20 and held.probe(df).where("not __may").isEmpty()
    other = spark.range(20_000, 60_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    assert held.probe(other).where("__may").count() < 0.05 * 40_000
    assert exact_dedup.Filter(df.limit(0)).probe(df).where("__may").isEmpty()


@pytest.mark.parametrize("rows", [0, 1, 4])
def test_a_filter_of_any_size_lets_single_texts_lie(spark, monkeypatch, rows):
    """Texts whose digest is in one row alone are ruled out before a shuffle, in slices of the filter."""
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", rows)
    text = F.concat(F.lit("text "), F.when(F.col("id") < 10_000, F.col("id") % 5_000).otherwise(F.col("id")))
    docs = spark.range(14_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    index = exact_dedup.DigestIndex(spark, "largest")
    index.add(docs)
    groups, hits, split = index.keepers()
    assert groups.count() == 5_000 and split is None and hits.bitmaps_wanted == max(2, rows)
    slices = [p.select("doc_id").collect() for p in hits.passing(index.batches[0])]
    assert len(slices) == (1 if rows == 4 else 2)
    passed = [r.doc_id for part in slices for r in part]
    assert set(range(10_000)) <= set(passed) and len(passed) == len(set(passed)) < 10_800
    assert index.resolve().where("kept").count() == 9_000


@pytest.mark.parametrize("rows", [0, 16_384])
def test_losers_beyond_a_broadcast(spark, odd, monkeypatch, rows):
    want = key(rows_of(exact_dedup.deduplicate(odd), *odd.columns))
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", rows)
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    got = exact_dedup.deduplicate(odd)
    assert got.columns == odd.columns and key(rows_of(got, *odd.columns)) == want


def test_clashes_in_slices(spark, odd, monkeypatch):
    """One byte as a digest: nearly all digests have several texts; slices find the same groups."""
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 0)
    columns = ("doc_id", "keep_id", "group_size", "kept")
    index = exact_dedup.DigestIndex(spark, "largest", digest=lambda t: F.substring(F.sha2(t, 256), 1, 1).cast("binary"))
    index.add(odd)
    assert key(rows_of(index.resolve(), *columns)) == key(rows_of(exact_dedup.resolve(odd, "largest"), *columns))
