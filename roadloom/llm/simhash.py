"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, Hamming check, components.

Two fingerprints that differ in at most k bits agree on at least m - k of m blocks. Each set of
m - k blocks is a table; fingerprints that share a table's bits are compared. A bucket of more than
``hot`` distinct fingerprints isn't compared pair by pair: its fingerprints are joined through
their one-bit neighbours (any two within two bits have a neighbour in common, and at most 65
fingerprints share one), which is exact and grows linearly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, materialise, small_batches, text_of
from .components import connected_components

BITS = 64
SEED = 42
#: Bytes of a text whose shingles are hashed at once.
CHUNK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]+")


def hashed_shingles(text: str, width: int) -> Iterator[np.ndarray]:
    """The 64-bit hashes of a text's shingles, repeated ones too, in parts; nothing without words.

    Words are cut at ASCII white space and lower-cased in A-Z; fewer words than ``width`` make one
    shingle.
    """
    data = text.encode("utf-8", "surrogatepass")
    some, carry, digest = False, [], xxhash.xxh64_intdigest
    at = 0
    while at < len(data):
        # parts end at white space, so no word is cut
        end = space.end() if (space := SPACE.search(data, at + CHUNK)) else len(data)
        words = carry + data[at:end].lower().split()
        at = end
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        elif at == len(data) and words and not some:
            shingles = iter([b" ".join(words)])
        else:
            carry = words
            continue
        some = True
        yield np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
        carry = words[len(words) - width + 1 :]


def voted(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashed shingles as a signed 64-bit integer; of none zero.

    A bit is set if more than half of the hashes have it.
    """
    counts, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in parts:
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        return 0
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: str, width: int = 3) -> int:
    """The fingerprint of one text; of a text without words zero."""
    return voted(hashed_shingles(text, width))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) for every row of ``docs`` (doc_id, text); null text is empty text."""
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fp = pa.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def block_masks(blocks: int, distance: int) -> list[int]:
    """The bits of each table: every choice of ``blocks - distance`` blocks, as signed integers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, distance: int = 2, blocks: int = 4, hot: int = 64) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints (column fp) of ``distinct``.

    They connect exactly the fingerprints that are connected by pairs within ``distance`` bits;
    every edge is such a pair. In hot buckets only a spanning part of the pairs is returned.
    """
    if not 0 < distance < blocks:
        raise ValueError("blocks must exceed distance, and distance be positive")
    if distance > 2:
        raise ValueError("hot buckets are handled for at most 2 bits")
    masks = F.array(*[F.lit(m) for m in block_masks(blocks, distance)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = materialise(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    few = keyed.join(sizes.where(F.col("n") <= hot).select("t", "key"), ["t", "key"])
    a, b = few.alias("a"), few.alias("b")
    near = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (_apart(F.col("a.fp"), F.col("b.fp")) <= distance)
    edges = a.join(b, near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    full = sizes.where(F.col("n") > hot).select("t", "key")
    if full.isEmpty():
        return edges.distinct()
    crowd = keyed.join(full, ["t", "key"], "left_semi").select("fp").distinct()
    flips = [1 << i if i < BITS - 1 else -(1 << (BITS - 1)) for i in range(BITS)]
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])
    # at most 65 fingerprints have a neighbour in common, so the set is bounded
    shared = crowd.select("fp", F.explode(around).alias("near")).groupBy("near").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    star = shared.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where((F.col("u") != F.col("v")) & (_apart(F.col("u"), F.col("v")) <= distance))
    if distance == 1:  # a common neighbour may be two bits away from both
        star = crowd.alias("a").join(crowd.select(F.col("fp").alias("v"), F.explode(around).alias("near")), F.col("a.fp") == F.col("near")).where("fp < v").select(F.col("fp").alias("u"), "v")
    return edges.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, blocks: int = 4, hot: int = 64) -> DataFrame:
    """doc_id, fp and component_id for every row of ``docs`` (doc_id, text).

    The component_id is the smallest doc_id that links lead to, the row's own included; rows with a
    null doc_id take part and are null only where the whole component is. Null text is empty text
    (fingerprint zero), repeated rows give repeated rows, an empty table an empty result, and
    further columns are ignored.
    """
    rows = materialise(fingerprints(docs, width), "fps")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    parts = materialise(connected_components(links(distinct.select("fp"), distance, blocks, hot)), "parts")
    linked = materialise(distinct.join(parts, F.col("fp") == F.col("vertex")).select("fp", "first_id", "component"), "linked")
    # the smallest ids come from files: a component of very many fingerprints can then be split in the join
    least = materialise(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    found = linked.join(least, "component").select("fp", "component_id")
    named = distinct.join(found, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(materialise(named, "named"), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, find: Callable[..., DataFrame] = near_duplicates, **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component of ``find``.

    The row with the smallest doc_id stays (ties: the smallest digest of the text; of rows that
    repeat both, one). Losers are found as (doc_id, digest) pairs and dropped by an anti join.
    """
    columns = docs.columns
    key = F.struct(F.col("doc_id").alias("i"), F.sha2(text_of(), 256).alias("d"))
    found = materialise(find(docs.select(key.alias("doc_id"), "text"), **options), "members")
    each = found.groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("n"))
    odd = materialise(each.select(F.col("doc_id").alias("__key"), (F.col("doc_id") != F.col("component_id")).alias("__loses"), "n").where("__loses or n > 1"), "losers")
    rows = docs.withColumn("__own", key)
    # null-safe, as a struct with a null doc_id never equals another
    same = F.col("__own.i").eqNullSafe(F.col("__key.i")) & (F.col("__own.d") == F.col("__key.d"))
    stay = rows.join(checked_broadcast(odd.where("__loses").select("__key")), same, "left_anti")
    doubles = odd.where("not __loses").select("__key")
    if not doubles.isEmpty():
        doubles = checked_broadcast(doubles)
        once = stay.join(doubles, same, "left_semi").dropDuplicates(["__own"])
        stay = stay.join(doubles, same, "left_anti").unionByName(once)
    return stay.select(*columns)
