"""Shards of nearly equal bytes, rows with equal texts never parted, by Karmarkar-Karp differencing.

A partial partition is one sum for each shard. Differencing takes the two partial partitions with
the largest spread (largest sum less smallest) and adds them in opposite order, until one is left.

Spark brings the corpus down to *items* first. A group of equal texts with at least 1/ITEMS of all
bytes is an item of its own, so there are at most twice ITEMS of these. Smaller groups are dealt to
buckets by their digest and cut, in the digest's order, into bundles of about 1/ITEMS of all bytes.
All items, at most four times ITEMS whatever the corpus, are differenced in one task; the rest is
joins. A group larger than a shard's even share stays whole: its shard is then the largest, and the
others share the remainder evenly.

Defined results: a null text is an empty one (size 1); equal texts, the empty ones among them, share
a shard; rows with equal or null ids are rows of their own, each with a slot; an empty table gives
no rows; columns besides doc_id and text aren't read by ``place``. Ties go by digest, so shards
depend on the set of rows alone. Slots number a shard's rows in no particular order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checked_broadcast, materialise, text_of

#: A group with this share of all bytes is an item; smaller ones are bundled to about it.
ITEMS = 1 << 15
#: Groups or rows to a bucket of the windows, as long as there are at most ITEMS buckets of groups.
BUCKET_ROWS = 100_000


def difference(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of each size, by differencing; shard 0 has the largest sum."""
    after = [-1] * len(sizes)  # the item behind an item in its bin

    def joined(a: tuple, b: tuple) -> tuple:
        """Two bins (sum, first item, last item) as one."""
        if a[1] < 0 or b[1] < 0:
            return a if b[1] < 0 else b
        after[a[2]] = b[1]
        return a[0] + b[0], a[1], b[2]

    nothing = [(0, -1, -1)] * (shards - 1)
    heap = [(-size, place, [(size, i, i), *nothing]) for place, (size, i) in enumerate(sorted((s, i) for i, s in enumerate(sizes)))]
    heapq.heapify(heap)
    fresh = len(heap)
    while len(heap) > 1:
        (_, _, high), (_, _, low) = heapq.heappop(heap), heapq.heappop(heap)
        bins = sorted(map(joined, high, reversed(low)), key=lambda b: -b[0])
        heapq.heappush(heap, (bins[-1][0] - bins[0][0], fresh, bins))
        fresh += 1
    shard_of = [0] * len(sizes)
    for shard, (_, item, _) in enumerate(heap[0][2] if heap else ()):
        while item >= 0:
            shard_of[item] = shard
            item = after[item]
    return shard_of


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one), text_crc32 and digest of each row."""
    text = text_of()
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"))


def shards_of_groups(rows: DataFrame, shards: int) -> DataFrame:
    """(digest, shard, heavy) of each distinct digest of ``rows`` (digest, size); heavy groups are few."""
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    total, count = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    least = max(1, (total or 0) // ITEMS)
    buckets = min(ITEMS, -(-count // BUCKET_ROWS)) or 1
    heavy = groups.where(F.col("bytes") >= least).withColumns({"item": F.hex("digest"), "heavy": F.lit(True)})
    before = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    small = groups.where(F.col("bytes") < least).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    bundled = small.withColumns({"item": F.concat_ws(":", "bucket", F.floor(before / least)), "heavy": F.lit(False)}).drop("bucket")
    named = materialise(heavy.unionByName(bundled), "items")

    def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sorted((size, name) for b in batches for name, size in zip(b["item"].to_pylist(), b["bytes"].to_pylist(), strict=True))
        placed = difference([size for size, _ in items], shards)
        yield pa.record_batch({"item": pa.array([name for _, name in items], pa.string()), "shard": pa.array(placed, pa.int32())})

    items = named.groupBy("item").agg(F.sum("bytes").alias("bytes"))
    placed = materialise(items.coalesce(1).mapInArrow(differenced, "item string, shard int"), "placed")
    return named.join(checked_broadcast(placed), "item").select("digest", "shard", "heavy")


def with_shard(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the shard of their digest.

    Heavy groups (at most twice ITEMS) meet their rows by broadcast, so no task gets the rows of
    one; of the others each has less than 1/ITEMS of all bytes, and so of all rows.
    """
    heavy = groups.where("heavy").select("digest", "shard")
    light = groups.where("not heavy").select("digest", "shard")
    found = rows.join(F.broadcast(heavy), "digest", "left")
    return found.where("shard is not null").unionByName(found.where("shard is null").drop("shard").join(light, "digest"))


def place(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard and slot of each row; slots are gapless from 0 in each shard."""
    rows = materialise(measured(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    placed = materialise(with_shard(rows, shards_of_groups(rows, shards)), "sharded")
    buckets = -(-placed.count() // BUCKET_ROWS) or 1
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    offsets = materialise(counts.select("shard", "bucket", (upto - F.col("n")).alias("first")), "offsets")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row")) - 1
    numbered = dealt.withColumn("within", within).join(checked_broadcast(offsets), ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "digest", "shard", (F.col("first") + F.col("within")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """The rows of ``docs`` as Parquet, a folder ``shard=k`` for each shard; a column shard of theirs is replaced."""
    groups = materialise(shards_of_groups(measured(docs), shards), "shards")
    kept = [c for c in docs.columns if c != "shard"]
    rows = docs.select(F.struct(*kept).alias("doc"), F.unhex(F.sha2(text_of(), 256)).alias("digest"))
    with_shard(rows, groups).select("doc.*", "shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
