"""Near copies: SimHash of five-word shingles, MinHash bands, exact Jaccard similarity of 0.8 or more, components.

Fingerprints come first: those within two bits are classes, found by the blocks, the Hamming check
and the hot buckets of ``simhash``, and each class's sets are verified against one of them. Two
bits reach few copies at a similarity of 0.8, where some ten differ, so bands find the others.

A pair of similarity s shares at least one of 20 bands of four minima with chance 1 - (1 - s^4)^20:
0.99997 at 0.8, more above. Each band's bucket has a hub, its most central set; all others in it
are verified against the hub on the whole shingle sets. Within a bucket that this leaves in several
components, a small one is compared pair by pair between components, and a crowd by what its sets
differ from their hub in: if x isn't a near copy of the hub, then a near copy y of x must have
differences in common with it, so many that prefixes of both, rarest first, share one. Neither
loses a pair, pairs within a component are left out, and a crowd costs as much as it has rows and
differences.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import checked_broadcast, materialise, small_batches, text_of
from .components import connected_components

WIDTH = 5
BANDS = 20
ROWS = 4
#: Shingles in this many sets of a crowd are ordered by their number of sets, after all others.
FREQUENT = 16
_RANDOM = np.random.default_rng(42)
_FLIPS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def sketch(text: str) -> tuple[np.ndarray, int]:
    """The distinct hashes of a text's five-word shingles, sorted, and their fingerprint, repeats included."""
    parts: list[np.ndarray] = []

    def noted() -> Iterator[np.ndarray]:
        for hashes in simhash.hashed_shingles(text, WIDTH):
            parts.append(np.unique(hashes))
            yield hashes

    fp = simhash.voted(noted())
    return (np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype="<u8")), fp


def shingle_set(text: str) -> np.ndarray:
    """The distinct hashes of a text's five-word shingles, sorted."""
    parts = [np.unique(h) for h in simhash.hashed_shingles(text, WIDTH)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype="<u8")


def bands(hashes: np.ndarray) -> list[int]:
    """The band keys of a set as signed integers; all sets without shingles have the same."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype="<u8")
    for at in range(0, len(hashes), 1024):
        np.minimum(least, ((hashes[at : at + 1024] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    keys = np.array([xxhash.xxh64_intdigest(b.tobytes(), 0) for b in least.reshape(BANDS, ROWS)], dtype="<u8")
    return keys.view("<i8").tolist()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), own (digest of the set), fp (fingerprint) and the set's band keys for every row."""
    rows = docs.select("doc_id", F.sha2(text_of(), 256).alias("digest"), text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets, fps = zip(*map(sketch, batch.column(2).to_pylist()), strict=True)
            own = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own, pa.array(fps, pa.int64()), keys], names=["doc_id", "digest", "own", "fp", "bands"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest string, own binary, fp bigint, bands array<bigint>")


def fingerprint_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs (u, v) of each fingerprint class's first set and every other one of ``distinct`` (own, fp).

    A class is all that links at two or fewer differing bits lead to. Further pairs of a class, whose
    sets aren't near copies of the first, are left to the bands.
    """
    fps = materialise(distinct.select("fp").distinct(), "fps")
    classes = connected_components(simhash.links(fps))
    placed = materialise(distinct.join(classes, F.col("fp") == F.col("vertex"), "left").select("own", F.coalesce("component", "fp").alias("class")), "classes")
    # from files, so that Spark can split the join of a class of very many sets
    heads = materialise(placed.groupBy("class").agg(F.min("own").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("class", "head"), "heads")
    return placed.join(heads, "class").where("own != head").select(F.col("head").alias("u"), F.col("own").alias("v"))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """own, n and shingles of the texts whose digest is in ``wanted`` (own, digest), each set once."""
    texts = docs.select(F.sha2(text_of(), 256).alias("digest"), text_of().alias("text"))
    rows = texts.join(checked_broadcast(wanted), "digest").select("own", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t).view("<i8") for t in batch.column(1).to_pylist()]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(sets, pa.list_(pa.int64()))], names=["own", "n", "shingles"])

    return rows.mapInArrow(run, "own binary, n bigint, shingles array<bigint>").dropDuplicates(["own"])


def _similar(both: Column, a: Column, b: Column) -> Column:
    """Whether sets of a and b shingles, ``both`` of them common, have a similarity of 0.8 or more."""
    return 9 * both >= 4 * (a + b)


def _judged(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (u, v) and near: whether they are near copies by their whole sets."""
    a = sets.select(F.col("own").alias("u"), F.col("n").alias("a"), F.col("shingles").alias("left"))
    b = sets.select(F.col("own").alias("v"), F.col("n").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", _similar(both, F.col("a"), F.col("b")).alias("near"))


def _within_small(left: DataFrame) -> DataFrame:
    """Pairs (u, v) of small buckets' sets in different components; the largest meets the others alone."""
    x = left.where(F.col("component") != F.col("top")).select("t", "key", F.col("own").alias("x"), F.col("component").alias("c"))
    met = x.join(left, ["t", "key"]).where(F.col("c") != F.col("component"))
    return met.select(F.least("x", "own").alias("u"), F.greatest("x", "own").alias("v")).distinct()


def _within_crowds(crowd: DataFrame, judged: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of each hub's sets (hub, own, component) in different components that may be near copies.

    With d differences from the hub and n shingles, x and y are near copies if and only if at least
    (9 d_x - n_x + 9 d_y - n_y) / 18 differences are common to them. One of the two isn't a near
    copy of the hub: for it 9 d - n is more than the hub's size, and for none less than minus that
    size. So bounds, and with them prefixes, follow from each set and its hub alone.
    """
    a = sets.select("own", "n", "shingles")
    h = sets.select(F.col("own").alias("hub"), F.col("n").alias("hub_n"), F.col("shingles").alias("base"))
    known = judged.select(F.col("u").alias("hub"), F.col("v").alias("own"), "near")
    apart = F.array_union(F.array_except("shingles", "base"), F.array_except("base", "shingles"))
    each = crowd.join(known, ["hub", "own"]).join(a, "own").join(h, "hub").select("hub", "own", "component", "near", "n", "hub_n", apart.alias("apart"))
    each = materialise(each.withColumn("d", F.size("apart").cast("long")), "apart")
    single = each.select("hub", "own", F.explode("apart").alias("shingle"))
    often = materialise(single.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") >= FREQUENT), "often")
    rank = F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle")
    ranked = single.join(checked_broadcast(often), ["hub", "shingle"], "left").groupBy("hub", "own").agg(F.sort_array(F.collect_list(rank))["shingle"].alias("rare"))
    placed = materialise(each.drop("apart").join(ranked, ["hub", "own"]).withColumn("e", 9 * F.col("d") - F.col("n")), "placed")

    def prefix(rows: DataFrame, least: Column) -> DataFrame:
        """The rarest differences of each set, of which at least ``least`` eighteenths are common to any partner."""
        common = F.greatest(F.lit(1), F.floor((least + 17) / 18)).cast("long")
        first = F.slice("rare", F.lit(1), F.greatest(F.lit(0), F.col("d") - common + 1).cast("int"))
        return rows.select("hub", "own", "component", "n", "d", "e", F.posexplode(first).alias("i", "shingle"))

    x = prefix(placed.where("not near"), F.col("e") - F.col("hub_n"))
    x = materialise(x.select("hub", "shingle", *[F.col(c).alias(f"x_{c}") for c in ("own", "component", "n", "d", "e", "i")]), "outer")
    y = materialise(prefix(placed, F.col("e") + F.col("hub_n") + 1), "members")
    sizes = 5 * F.least("x_n", "n") >= 4 * F.greatest("x_n", "n")
    # of the first difference that both have, all further ones come after it
    reach = 18 * F.least(F.col("x_d") - F.col("x_i"), F.col("d") - F.col("i")) >= F.col("x_e") + F.col("e")
    met = x.join(y, ["hub", "shingle"]).where((F.col("x_component") != F.col("component")) & sizes & reach)
    return met.select(F.least("x_own", "own").alias("u"), F.greatest("x_own", "own").alias("v")).distinct()


def near_duplicates(docs: DataFrame, hot: int = 16) -> DataFrame:
    """doc_id and component_id for every row of ``docs`` (doc_id, text).

    The component_id is the smallest doc_id that near copies lead to, the row's own included; rows
    with a null doc_id take part and are null only where the whole component is. Null text is empty
    text, and texts without words are copies of each other; texts of fewer than five words are one
    shingle. Repeated rows give repeated rows, an empty table an empty result, and further columns
    are ignored. Buckets of more than ``hot`` sets are crowds; the result doesn't depend on it.
    """
    rows = materialise(sketches(docs.select("doc_id", "text")), "sketches")
    distinct = materialise(rows.groupBy("own").agg(F.min("doc_id").alias("first_id"), F.min("digest").alias("digest"), F.min("fp").alias("fp"), F.any_value("bands").alias("bands")), "distinct")
    classed = materialise(fingerprint_pairs(distinct.select("own", "fp")), "classed")
    keyed = materialise(distinct.select("own", F.posexplode("bands").alias("t", "key")), "keyed")
    sizes = materialise(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    met = materialise(keyed.join(sizes, ["t", "key"]), "met")
    # a set whose minima many others have is central, and near to most of them
    central = materialise(met.groupBy("own").agg(F.sum("size").alias("central")), "central")
    hubs = materialise(met.join(central, "own").groupBy("t", "key").agg(F.max(F.struct("central", "own"))["own"].alias("hub")), "hubs")
    met = materialise(met.join(hubs, ["t", "key"]), "met")
    pairs = materialise(met.where("own != hub").select(F.col("hub").alias("u"), F.col("own").alias("v")).unionByName(classed).distinct(), "pairs")
    paired = reduce(DataFrame.union, [central.select("own"), classed.select("u"), classed.select("v")])
    wanted = materialise(distinct.join(paired, "own", "left_semi").select("own", "digest"), "wanted")
    sets = materialise(shingle_sets(docs, wanted), "sets")
    judged = materialise(_judged(pairs, sets), "judged")
    links = judged.where("near").select("u", "v")
    parts = materialise(connected_components(links), "parts")
    there = materialise(met.join(parts, F.col("own") == F.col("vertex"), "left").select("t", "key", "size", "hub", "own", F.coalesce("component", "own").alias("component")), "there")
    shares = there.groupBy("t", "key", "component").agg(F.count(F.lit(1)).alias("m"))
    mixed = materialise(shares.groupBy("t", "key").agg(F.max(F.struct("m", "component"))["component"].alias("top"), F.count(F.lit(1)).alias("c")).where("c > 1").select("t", "key", "top"), "mixed")
    if not mixed.isEmpty():
        left = materialise(there.join(mixed, ["t", "key"]), "left")
        crowd = materialise(left.where((F.col("size") > hot) & (F.col("own") != F.col("hub"))).select("hub", "own", "component").distinct(), "crowd")
        more = _within_small(left.where(F.col("size") <= hot))
        if not crowd.isEmpty():
            more = more.unionByName(_within_crowds(crowd, judged, sets)).distinct()
        found = _judged(materialise(more, "pairs"), sets).where("near").select("u", "v")
        parts = materialise(connected_components(links.unionByName(materialise(found, "links"))), "parts")
    linked = materialise(distinct.join(parts, F.col("own") == F.col("vertex")).select("own", "first_id", "component"), "linked")
    # from files, so that Spark can split the join of a component of very many sets
    least = materialise(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    found = linked.join(least, "component").select("own", "component_id")
    named = distinct.join(found, "own", "left").select("own", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(materialise(named, "named"), "own").select("doc_id", "component_id")


def deduplicate(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component, the smallest doc_id.

    Null texts are empty ones, and of all rows without words one stays; a null doc_id is smaller
    than any other; of rows that repeat the keeper's doc_id and text one stays.
    Texts are taken whole, however long. An empty table stays empty; further columns, whatever
    their names, are kept as they are.
    """
    return simhash.deduplicate(docs, find=near_duplicates, **options)
