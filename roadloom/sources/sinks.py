"""Writers and table maintenance: partitions, slices, upserts, exports, the run log.

Changes of a table on disk are made in three steps: what is to be written is written beside the
table, once; the change is announced in a small file of the table's folder; the announced change is
carried out. A run that is broken off before the announcement leaves the table as it was, one that is broken off
later is finished by ``finish`` (which every change calls first), whatever became of the tables
that the new rows were made from. Readers that come in between may see a part of a change, as
plain folders of files have no snapshots.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import materialise, scratch_path

#: The file that announces a change, hidden from Spark's readers.
PENDING = "_pending"


def write_partitioned(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """Parquet by partition columns; ``mode='overwrite'`` replaces the partitions in ``df`` only.

    Rows are rebalanced by the keys: small partitions share a task, and one that outgrows the
    advisory partition size is dealt over several, so no day has to fit one task.
    """
    df.hint("rebalance", *keys).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, *order: str) -> DataFrame:
    """``df`` as an external table below ``path``, in ``buckets`` by the hash of ``key`` and sorted by it, then by ``order``; returns the table.

    Joins and groups by the key, alone or with further columns, read it without a shuffle. A task
    writes one bucket, so take enough of them for a bucket to fit a task; the key is to be spread
    evenly, as segments are in readings.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _folder(spark: SparkSession, keys: dict[str, object]) -> str:
    """The relative folder of a partition, named as Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(k)}={'__HIVE_DEFAULT_PARTITION__' if v is None or v == '' else escape(str(v))}" for k, v in keys.items())


def _path(spark: SparkSession, name: str, uri: bool = False):
    """A path and its file system; ``uri`` for names as Spark's metadata columns give them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name) if uri else name)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    folder, store = _path(spark, name)
    return store.exists(folder)


def _announce(spark: SparkSession, path: str, change: dict) -> None:
    """Write the announcement whole or not at all."""
    draft, store = _path(spark, f"{path.rstrip('/')}/{PENDING}-{uuid.uuid4().hex}")
    out = store.create(draft)
    out.write(bytearray(json.dumps(change).encode()))
    out.close()
    if not store.rename(draft, _path(spark, f"{path.rstrip('/')}/{PENDING}")[0]):
        raise RuntimeError(f"another change of {path} is pending")


def finish(spark: SparkSession, path: str) -> bool:
    """Carry out the announced change of the table at ``path``, if there is one; it may be repeated."""
    note, store = _path(spark, f"{path.rstrip('/')}/{PENDING}")
    if not store.exists(note):
        return False
    stream = store.open(note)
    change = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    {"slices": _swap_slices, "files": _swap_files}[change["kind"]](spark, path.rstrip("/"), change)
    store.delete(note, False)
    return True


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the keys that its partition folders give back: empty text is null there."""
    return df.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in keys if dict(df.dtypes)[k] == "string"})


def overwrite_slices(new: DataFrame, path: str, slices: DataFrame, by: list[str] | None = None) -> None:
    """Replace the slices (rows of key columns) of the table at ``path``, partitioned by ``by``: these keys or some of them.

    Only the folders of ``slices`` are touched: those with rows are rewritten, those without are
    removed. Where slices are many and small, as corridor days are, let several share a folder: the
    folder's other slices are written again with it, and the number of folders doesn't grow with the
    slices. ``new`` may be made from the same table, but may not hold rows of other slices; it is
    evaluated once. Null keys are a slice like others. Names of touched folders alone come to the
    driver.
    """
    spark, keys = new.sparkSession, slices.columns
    by = by or keys
    finish(spark, path)
    staged, marks = scratch_path(spark, "staged"), materialise(_named(slices, by).distinct(), "slices")
    write_partitioned(new, staged, *by)
    rows = spark.read.schema(new.schema).parquet(staged)
    if not rows.join(marks, _same(keys, rows, marks), "left_anti").isEmpty():
        raise ValueError("rows outside the slices that are to be replaced")
    touched = marks.select(*by).distinct()
    if set(by) != set(keys):
        names = [f"{path.rstrip('/')}/{_folder(spark, r.asDict())}" for r in touched.toLocalIterator()]
        there = [n for n in names if _exists(spark, n)]
        if there:
            old = spark.read.schema(new.schema).option("basePath", path).parquet(*there)
            write_partitioned(old.join(marks, _same(keys, old, marks), "left_anti"), staged, *by, mode="append")
            rows = spark.read.schema(new.schema).parquet(staged)
    emptied = materialise(touched.join(rows, _same(by, touched, rows), "left_anti"), "emptied")
    _announce(spark, path, {"kind": "slices", "staged": staged, "schema": new.schema.json(), "keys": by, "emptied": emptied.inputFiles(), "emptied_schema": emptied.schema.json()})
    finish(spark, path)


def _swap_slices(spark: SparkSession, path: str, change: dict) -> None:
    rows = spark.read.schema(StructType.fromJson(json.loads(change["schema"]))).parquet(change["staged"])
    write_partitioned(rows, path, *change["keys"])
    if change["emptied"]:
        emptied = spark.read.schema(StructType.fromJson(json.loads(change["emptied_schema"]))).parquet(*change["emptied"])
        for row in emptied.toLocalIterator():
            folder, store = _path(spark, f"{path}/{_folder(spark, row.asDict())}")
            store.delete(folder, True)


def merge_files(new: DataFrame, path: str, keys: list[str]) -> int:
    """Put the rows of ``new`` into the table at ``path`` in place of those with the same keys.

    ``path`` is a folder of Parquet files without partitions. Its keys alone are read to find the
    files that hold a key of ``new`` (null keys are equal); only these are rewritten, the others stay
    as they are. Returns the number of rewritten files. Their names come to the driver, like a
    listing's.
    """
    spark = new.sparkSession
    finish(spark, path)
    rows = materialise(new, "merge")
    found = rows.select(*keys).distinct()
    old = spark.read.schema(new.schema).parquet(path)
    keyed = old.select(*keys, F.col("_metadata.file_path").alias("__file"))
    names = [r[0] for r in keyed.join(found, _same(keys, keyed, found), "left_semi").select("__file").distinct().toLocalIterator()]
    touched = [_path(spark, n, uri=True)[0].toString() for n in names]
    fresh = f"{path.rstrip('/')}/_merge-{uuid.uuid4().hex}"
    (upsert(spark.read.schema(new.schema).parquet(*touched), rows, keys) if touched else rows).write.parquet(fresh)
    _announce(spark, path, {"kind": "files", "fresh": fresh, "touched": touched})
    finish(spark, path)
    return len(touched)


def _swap_files(spark: SparkSession, path: str, change: dict) -> None:
    """The new files first, then the old ones' removal; what is done already is passed over."""
    folder, store = _path(spark, change["fresh"])
    for status in store.listStatus(folder) if store.exists(folder) else []:
        file = status.getPath()
        if not file.getName().startswith(("_", ".")) and not store.rename(file, _path(spark, f"{path}/{file.getName()}")[0]):
            raise RuntimeError(f"could not move {file}")
    for name in change["touched"]:
        store.delete(_path(spark, name)[0], False)
    store.delete(folder, True)


def append_states(states: DataFrame, path: str, key: str) -> None:
    """Add states to the table at ``path``, partitioned by ``key``: files of the keys at hand, and no other is touched."""
    finish(states.sparkSession, path)
    write_partitioned(states, path, key, mode="append")


def compact_states(path: str, keys: DataFrame, merge: Callable[[DataFrame], DataFrame], schema: StructType) -> None:
    """Rewrite the slices ``keys`` of a table of states with ``merge`` of their rows, so that reads stay short."""
    spark, names = keys.sparkSession, keys.columns
    table = spark.read.schema(schema).parquet(path)
    overwrite_slices(merge(table.join(keys, _same(names, table, keys), "left_semi")), path, keys)


def _same(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def replace_slices(old: DataFrame, new: DataFrame, slices: DataFrame) -> DataFrame:
    """``old`` without the slices (rows of key columns), then ``new``: for tables without partitions.

    A slice without new rows is cleared all the same.
    """
    keys = slices.columns
    marks = slices.distinct()
    return old.join(marks, _same(keys, old, marks), "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key ``new`` hasn't."""
    return old.join(new, _same(keys, old, new), "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old``, and those of ``new`` whose key ``old`` hasn't."""
    return old.unionByName(new.join(old, _same(keys, new, old), "left_anti"))


def drop_orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``child`` that have a parent: what a cascading delete leaves."""
    return child.join(parent, _same(keys, child, parent), "left_semi")


def export(tables: dict[str, DataFrame], base: str) -> None:
    """Each named table as Parquet below ``base``, any path that Spark can write."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")


LOG = "stage string, corridor_id int, rows_written bigint, started_at timestamp, finished_at timestamp, status string, detail string"


def run_logged(spark: SparkSession, log: str, stage: str, work: Callable[[], DataFrame], corridor: str = "corridor_id") -> DataFrame | None:
    """The table that ``work`` writes and returns, with the run appended to the log at ``log``.

    A row for each corridor of the table where it succeeds (status success); one row with the
    error's text where it fails (status error), and None is returned, so that later stages go on.
    """
    began = dt.datetime.now(dt.timezone.utc)

    def rows(counted: DataFrame, status: str, detail: str) -> DataFrame:
        times = {"stage": F.lit(stage), "started_at": F.lit(began).cast("timestamp"), "finished_at": F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp"), "status": F.lit(status), "detail": F.lit(detail[:2000])}
        names = [x.split()[0] for x in LOG.split(", ")]
        return counted.withColumns(times).select(*names)

    try:
        table = work()
        counted = table.groupBy(F.col(corridor).cast("int").alias("corridor_id")).agg(F.count(F.lit(1)).alias("rows_written"))
        rows(counted, "success", "").write.mode("append").parquet(log)
        return table
    except Exception as error:  # noqa: BLE001
        failed = spark.range(1).select(F.lit(None).cast("int").alias("corridor_id"), F.lit(0).cast("long").alias("rows_written"))
        rows(failed, "error", f"{type(error).__name__}: {error}").write.mode("append").parquet(log)
        return None


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(log)
