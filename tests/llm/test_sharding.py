"""Shards against a plain differencing over lists of sets, and odd tables."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadloom.llm import sharding

from .conftest import rows_of


def plain_sums(sizes, shards):
    """Sums of the bins by differencing, the partial partitions kept as lists of lists and searched anew each time; the older one at ties."""
    parts = [[[s]] + [[] for _ in range(shards - 1)] for s in sorted(sizes)]
    spread = lambda p: max(map(sum, p)) - min(map(sum, p))
    while len(parts) > 1:
        a, b = (sorted(parts.pop(max(range(len(parts)), key=lambda i: (spread(parts[i]), -i))), key=sum) for _ in range(2))
        parts.append([x + y for x, y in zip(a, b[::-1], strict=True)])
    return sorted(map(sum, parts[0])) if parts else [0] * shards


@pytest.mark.parametrize("sizes", [[], [5], [8, 7, 6, 5, 4], [1] * 17, [1000, 1, 1, 1, 1, 1], [3, 3, 3, 3], list(range(1, 60)), [2**k for k in range(12)]])
@pytest.mark.parametrize("shards", [1, 2, 3, 8])
def test_differencing(sizes, shards):
    placed = sharding.difference(sizes, shards)
    sums = [0] * shards
    for size, shard in zip(sizes, placed, strict=True):
        sums[shard] += size
    assert len(placed) == len(sizes)
    assert sorted(sums) == plain_sums(sizes, shards)


def test_classic_case():
    sizes = [8, 7, 6, 5, 4]
    placed = sharding.difference(sizes, 2)
    assert {sum(s for s, p in zip(sizes, placed, strict=True) if p == k) for k in (0, 1)} == {16, 14}


def check(rows, placed, shards=8):
    """Sizes, checksums, whole groups and gapless slots."""
    assert Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows) == Counter((r.doc_id, r.size, r.text_crc32) for r in placed)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in placed:
        by_text[bytes(r.digest)].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_documents(docs):
    placed = sharding.place(docs).collect()
    check(rows_of(docs, "doc_id", "text"), placed)
    sums = Counter()
    for r in placed:
        sums[r.shard] += r.size
    largest = max(Counter(r.digest for r in placed for _ in range(r.size)).values())
    assert max(sums.values()) - min(sums.values()) <= max(largest, 0.02 * sum(sums.values()))


def test_bundles_keep_the_law(docs, monkeypatch):
    """With few items small groups are bundled, and buckets are many."""
    monkeypatch.setattr(sharding, "ITEMS", 64)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    placed = sharding.place(docs).collect()
    check(rows_of(docs, "doc_id", "text"), placed)
    sums = Counter()
    for r in placed:
        sums[r.shard] += r.size
    assert max(sums.values()) <= 1.3 * sum(sums.values()) / 8


def test_a_group_over_a_shard_stays_whole(spark):
    rows = [(i, "copy " * 20) for i in range(300)] + [(1000 + i, f"text {i} " * (1 + i % 7)) for i in range(400)]
    placed = sharding.place(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, placed)
    sums = Counter()
    for r in placed:
        sums[r.shard] += r.size
    others = [sums[k] for k in range(1, 8)]
    assert sums[0] == 300 * 101 and max(others) - min(others) <= 0.01 * max(others)


def test_odd_texts_and_empty_tables(odd, none):
    check(rows_of(odd, "doc_id", "text"), sharding.place(odd).collect())
    assert sharding.place(none).collect() == [] and sharding.place(odd).columns == ["doc_id", "size", "text_crc32", "digest", "shard", "slot"]


def test_same_shards_whatever_the_partitions(docs):
    one = {(r.doc_id, r.shard) for r in sharding.place(docs.coalesce(1)).collect()}
    assert one == {(r.doc_id, r.shard) for r in sharding.place(docs.repartition(7)).collect()}


def test_written_shards_hold_all_rows(docs, spark, tmp_path):
    sharding.write_shards(docs.withColumn("shard", F.lit("old")), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*docs.columns, "shard"])
    assert sorted(rows_of(back, *docs.columns), key=repr) == sorted(rows_of(docs, *docs.columns), key=repr)
    assert {(r.doc_id, r.shard) for r in back.select("doc_id", "shard").collect()} == {(r.doc_id, r.shard) for r in sharding.place(docs).collect()}
