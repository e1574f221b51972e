"""Exact dedup over a log-structured index of text digests, DataFrame functions only.

A batch of documents is a memtable: each task sorts its (digest, doc_id) rows and flushes them as
part of a sorted run, without a shuffle. Compaction merges runs and keeps the extreme doc_id and
the number of rows of each digest. Filters say which digests a run cannot hold: a later batch is
probed against them before a run is read, and the texts of a batch are probed against the filter of
the digests with more than one row, so that only hits are read, moved and verified by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, checked_broadcast, materialise, text_of

#: Bits of a filter for each digest in it: about one digest in 32 passes without being there.
FILTER_BITS = 32
#: The same in a filter of more than FILTER_ROWS bitmaps: about one in 9 passes.
LARGE_FILTER_BITS = 8
#: Rows of a filter (bitmaps of 4 KB) that are broadcast at once: 64 MB, 16 million digests. A
#: larger filter is probed in slices of as many rows.
FILTER_ROWS = 16_384
#: Bits of one bitmap, fixed by Spark's bitmap functions.
BITMAP = 32_768


def sha256_digest(text: Column) -> Column:
    """32 bytes of SHA-256 over the text's UTF-8."""
    return F.unhex(F.sha2(text, 256))


class Filter:
    """The digests that may be in a set: one hashed bit for each, in bitmaps of 4 KB."""

    def __init__(self, digests: DataFrame):
        n = digests.count()
        self.bitmaps_wanted = max(1, -(-n * FILTER_BITS // BITMAP))
        if not self.small:
            self.bitmaps_wanted = max(FILTER_ROWS, 1, -(-n * LARGE_FILTER_BITS // BITMAP))
        slot = self._slot(F.col("digest"))
        grouped = digests.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bits"))
        self.bitmaps = materialise(grouped, "filter")

    def _slot(self, digest: Column) -> Column:
        # positive, as the bitmap functions count from 1
        return F.pmod(F.xxhash64(digest), F.lit(self.bitmaps_wanted * BITMAP)) + 1

    @property
    def small(self) -> bool:
        return self.bitmaps_wanted <= FILTER_ROWS

    def _met(self, rows: DataFrame, bitmaps: DataFrame, digest: str = "digest") -> DataFrame:
        slot = self._slot(F.col(digest))
        met = rows.withColumns({"__at": F.bitmap_bit_position(slot), "__of": F.bitmap_bucket_number(slot)}).join(F.broadcast(bitmaps), F.col("__of") == F.col("__bucket"), "left")
        byte = F.conv(F.hex(F.substring("__bits", (F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.expr("cast(__at % 8 as int)")
        hit = F.coalesce(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
        return met.withColumn("__may", hit).drop("__at", "__of", "__bucket", "__bits")

    def probe(self, rows: DataFrame, digest: str = "digest") -> DataFrame:
        """``rows`` and __may: false where the digest surely isn't in the set.

        A filter too large to broadcast lets everything pass: reading it would move as much as
        the rows themselves.
        """
        return self._met(rows, self.bitmaps, digest) if self.small else rows.withColumn("__may", F.lit(True))

    def passing(self, rows: DataFrame) -> Iterator[DataFrame]:
        """The wide ``rows`` that may be in the set, in slices by digest; finish with one before the next.

        Each slice scans ``rows`` and holds one part of the filter in memory; rows that it rules
        out are never moved, whatever the filter's size.
        """
        if self.small:
            yield self._met(rows, self.bitmaps).where("__may").drop("__may")
            return
        step = max(1, FILTER_ROWS)
        bucket = F.bitmap_bucket_number(self._slot(F.col("digest")))
        for low in range(1, self.bitmaps_wanted + 1, step):
            part = self.bitmaps.where(F.col("__bucket").between(low, low + step - 1))
            yield self._met(rows.where(bucket.between(low, low + step - 1)), part).where("__may").drop("__may")


class Run:
    """A sorted run: a row for each digest (and, before compaction, for each document of it)."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    @cached_property
    def filter(self) -> Filter:
        """The run's filter, built when a batch first asks for it."""
        return Filter(self.rows.select("digest"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class DigestIndex:
    """The index: level-0 runs as flushed, and one compacted run of all before them.

    ``keep`` is ``"smallest"`` or ``"largest"``: whose doc_id stays. ``fan_out`` runs are compacted
    as soon as they are there. ``digest`` may be any function of the text; equality is decided by
    bytes in the end.
    """

    def __init__(self, spark: SparkSession, keep: str = "smallest", fan_out: int = 8, digest: Callable[[Column], Column] = sha256_digest):
        if keep not in ("smallest", "largest"):
            raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
        self.spark, self.keep, self.fan_out, self.digest = spark, keep, fan_out, digest
        self.batches: list[DataFrame] = []
        self.memtables: list[DataFrame] = []
        self.runs: list[Run] = []

    def _batch(self, docs: DataFrame) -> DataFrame:
        batch = docs.select(F.col("doc_id"), text_of().alias("text"))
        return batch.withColumn("digest", self.digest(F.col("text")))

    def add(self, docs: DataFrame) -> DataFrame:
        """Flush a batch (doc_id, text; further columns are ignored) as a level-0 run; returns its rows."""
        batch = self._batch(docs)
        rows = materialise(batch.select("doc_id", "digest").sortWithinPartitions("digest"), "run0")
        self.batches.append(batch)
        self.memtables.append(rows)
        self.runs.append(Run(rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))))
        if len(self.runs) >= self.fan_out:
            self.compact()
        return rows

    def _best(self, column: str) -> Column:
        return (F.max if self.keep == "largest" else F.min)(column)

    def compact(self) -> Run:
        """Merge all runs into one: a row for each digest, with its extreme doc_id and number of rows, sorted."""
        merged = _union([run.rows for run in self.runs]).groupBy("digest").agg(self._best("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        self.runs = [Run(materialise(merged.sortWithinPartitions("digest"), "run1"))]
        return self.runs[0]

    def known(self, docs: DataFrame) -> DataFrame:
        """doc_id, digest and keep_id (null: new) of the rows of a batch that isn't added.

        Each run's filter is probed first: rows that it rules out never meet the run, and a run
        meets the few that pass without a shuffle of its own where they are few. Equal digests
        count as equal here; bytes decide once the batch is added.
        """
        rows = materialise(self._batch(docs).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "digest"), "asked")
        hits = []
        for run in self.runs:
            passed = materialise(run.filter.probe(rows).where("__may").select("row_id", "digest"), "passed")
            hits.append(run.rows.join(checked_broadcast(passed), "digest").select("row_id", "keep_id"))
        if not hits:
            return rows.select("doc_id", "digest", F.lit(None).cast(rows.schema["doc_id"].dataType).alias("keep_id"))
        best = _union(hits).groupBy("row_id").agg(self._best("keep_id").alias("keep_id"))
        return rows.join(best, "row_id", "left").select("doc_id", "digest", "keep_id")

    @cached_property
    def _groups(self) -> tuple[DataFrame, Filter, DataFrame | None]:
        merged = self.compact()
        groups = materialise(merged.rows.where("n > 1").select("digest", "keep_id", F.col("n").alias("group_size")), "groups")
        hits = Filter(groups.select("digest"))
        splits = []
        for texts in hits.passing(_union(self.batches)):
            # a text that passes without being a hit is a group of its own
            verified = texts.groupBy("digest", "text").agg(self._best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            # the text goes no further than this unless two share a digest
            clash = materialise(verified.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1").select("digest"), "clash")
            if not clash.isEmpty():
                splits.append(materialise(verified.join(clash, "digest", "left_semi"), "split"))
        if not splits:
            return groups, hits, None
        split = _union(splits)
        return groups.join(split.select("digest").distinct(), "digest", "left_anti"), hits, split

    def keepers(self) -> tuple[DataFrame, Filter, DataFrame | None]:
        """Digests of several rows with their keeper, the filter of these, and clashing digests by text.

        All batches have to be added before. The last is None when byte verification finds no
        digest with two texts, as it does for SHA-256.
        """
        return self._groups

    def resolve(self) -> DataFrame:
        """A row for each row added: doc_id, digest, keep_id, group_size, kept.

        Rows that repeat the keeper's doc_id and text are all marked kept (``deduplicate`` leaves
        one of them). A null doc_id never wins against another one.
        """
        groups, hits, split = self.keepers()
        rows = hits.probe(_union(self.memtables))
        alone = rows.where("not __may").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
        asked = rows.where("__may").drop("__may")
        if split is not None:
            asked = asked.join(split.select("digest").distinct(), "digest", "left_anti")
        found = asked.join(checked_broadcast(groups), "digest", "left").select("doc_id", "digest", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
        found = alone.unionByName(found)
        if split is not None:
            found = found.unionByName(_union(self.batches).join(split, ["digest", "text"]).select("doc_id", "digest", "keep_id", "group_size"))
        return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def resolve(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Group documents of equal text: see ``DigestIndex.resolve``.

    Null text is empty text; an empty table gives an empty result; further columns are ignored.
    """
    index = DigestIndex(docs.sparkSession, keep)
    index.add(docs)
    return index.resolve()


def deduplicate(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each distinct text.

    Where rows repeat the keeper's doc_id and text, one of them stays; null text is empty text; an
    empty table stays empty. The rows are kept by an anti join against the losers. Where their list
    is too long to broadcast, a filter of it is probed first: rows that it rules out stay where they
    are, and only the texts that pass meet the list (up to 67 million digests; beyond, all do).
    """
    columns = docs.columns
    index = DigestIndex(docs.sparkSession, keep)
    index.add(docs)
    groups, hits, split = index.keepers()
    rows = docs.withColumn("__digest", sha256_digest(text_of()))
    held = hits.probe(_union(index.memtables)).where("__may").join(checked_broadcast(groups), "digest")
    each = held.groupBy("digest", "doc_id", "keep_id").agg(F.count(F.lit(1)).alias("n"))
    each = materialise(each.select(F.col("digest").alias("__d"), F.col("doc_id").alias("__i"), "n", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("wins")), "members")
    same = (F.col("__digest") == F.col("__d")) & F.col("doc_id").eqNullSafe(F.col("__i"))
    losers = each.where("not wins").select("__d", "__i")
    if losers.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        stay = rows.join(F.broadcast(losers), same, "left_anti")
    else:
        met = Filter(losers.select(F.col("__d").alias("digest")).distinct()).probe(rows, "__digest")
        asked = met.where("__may").join(losers, same, "left_anti")
        stay = met.where("not __may").unionByName(asked).drop("__may")
    parts = []
    doubles = each.where("wins and n > 1").select("__d", "__i")
    if not doubles.isEmpty():
        doubles = checked_broadcast(doubles)
        parts.append(stay.join(doubles, same, "left_semi").dropDuplicates(["__digest"]))
        stay = stay.join(doubles, same, "left_anti")
    if split is not None:
        # texts that share a digest: their keepers by bytes, and none of them by digest
        apart = split.select(F.col("digest").alias("__d"), F.col("text").alias("__t"), F.col("keep_id").alias("__i"))
        here = rows.join(apart, same & (text_of() == F.col("__t"))).dropDuplicates(["__d", "__t"])
        parts = [part.join(split.select(F.col("digest").alias("__d")), F.col("__digest") == F.col("__d"), "left_anti") for part in parts] + [here]
        stay = stay.join(split.select(F.col("digest").alias("__d")), F.col("__digest") == F.col("__d"), "left_anti")
    stay = stay.select(*columns)
    for part in parts:
        stay = stay.unionByName(part.select(*columns))
    return stay
