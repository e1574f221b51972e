"""One large GeoJSON document read by many tasks.

Spark's text reader cuts the file at closing braces, so a task gets the pieces of its byte range in order. Where a
range begins, a brace may stand inside a string and at any depth. A first pass gives each range's quotes and its
change of depth for both cases; prefix sums over the ranges, one row each, settle how every range begins, and a second
pass cuts features out. Only those that cross a range's edge are put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import materialise
from .tables import FEATURE, vertices

ESCAPED = re.compile(r"\\.", re.S)
#: A whole string or one that the piece doesn't end, a list under the key "features", other brackets and braces.
TOKEN = re.compile(r'"features"\s*:\s*\[|"(?:[^"\\]|\\.)*("?)|[{\[\]]', re.S)
REST = re.compile(r'(?:[^"\\]|\\.)*("?)', re.S)
CUT = "path string, at bigint, n int, head boolean, tail boolean, mark string, text string"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """path, at (where the range begins) and value: text up to a closing brace, in the file's order within a range."""
    rows = spark.read.text(path, lineSep="}")
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, Iterator[str]]]:
    """Runs of pieces of one range: its columns but the piece, whether it is the range's first run, the pieces."""
    last = None
    for batch in batches:
        keys = list(zip(*(c.to_pylist() for c in batch.columns[:-1]), strict=True))
        values, start = batch.columns[-1].to_pylist(), 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                yield keys[start], keys[start] != last, iter(values[start:i])
                last, start = keys[start], i


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run of pieces: the quotes, and the change of depth if it begins outside of a string, or inside."""
    for (path, at), _, values in _by_range(batches):
        quotes, change = 0, [0, 0]
        for value in values:
            parts = ESCAPED.sub("", value).split('"')
            for i, part in enumerate(parts):
                # outside of strings for a range that begins so, if the quotes before are even
                change[(quotes + i) % 2] += part.count("{")
            quotes += len(parts) - 1
            change[quotes % 2] -= 1
        yield pa.RecordBatch.from_pylist([{"path": path, "at": at, "quotes": quotes, "outside": change[0], "inside": change[1]}])


def _ranges(pieces: DataFrame) -> DataFrame:
    """path, at, quoted and depth of each range as it begins: a row for each range of bytes."""
    runs = pieces.mapInArrow(_changes, "path string, at bigint, quotes bigint, outside bigint, inside bigint")
    runs = materialise(runs.withColumn("run", F.monotonically_increasing_id()), "runs")
    before = Window.partitionBy("path").orderBy("at", "run").rowsBetween(Window.unboundedPreceding, -1)
    known = runs.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    known = known.withColumn("depth", F.coalesce(F.sum(F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    first = known.groupBy("path", "at").agg(F.min_by("quoted", "run").alias("quoted"), F.min_by("depth", "run").alias("depth"))
    return materialise(first, "ranges")


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the objects two braces deep, and for each range a last row (n = -1) with the root's last bracket.

    mark is the last bracket of the root before the object: ``<`` opened the features, ``[`` another list, ``]`` closed
    one; null if it lies in an earlier range.
    """
    state: dict = {}

    def rows(key: tuple, values: Iterator[str]) -> Iterator[dict]:
        path, at = key[:2]
        for value in values:
            pos = begun = 0
            if state["quoted"]:
                rest = REST.match(value)
                pos, state["quoted"] = rest.end(), not rest[1]
            while token := TOKEN.search(value, pos):
                pos, what = token.end(), token[0]
                if what == "{":
                    state["depth"] += 1
                    if state["depth"] == 2:
                        begun, state["text"], state["head"] = token.start(), [], True
                elif token[1] is None:
                    if state["depth"] == 1:
                        state["mark"] = what if len(what) == 1 else "<"
                elif not token[1]:
                    state["quoted"] = True
            if state["depth"] >= 2:
                state["text"] += [value[begun:], "}"]
            if not state["quoted"]:
                state["depth"] -= 1
                if state["depth"] == 1:
                    yield from ended(path, at, True)
                state["depth"] = max(state["depth"], 0)

    def ended(path: str, at: int, tail: bool) -> Iterator[dict]:
        if state["head"] and state["mark"] not in (None, "<"):
            return
        yield {"path": path, "at": at, "n": state["n"], "head": state["head"], "tail": tail, "mark": state["mark"], "text": "".join(state["text"])}
        state["n"] += state["head"]

    def closed() -> Iterator[dict]:
        path, at = state["key"][:2]
        if state["depth"] >= 2 and state["text"]:
            yield from ended(path, at, False)
        yield {"path": path, "at": at, "n": -1, "head": False, "tail": False, "mark": state["mark"], "text": ""}

    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("n", pa.int32()), ("head", pa.bool_()), ("tail", pa.bool_()), ("mark", pa.string()), ("text", pa.string())])
    for key, first, values in _by_range(batches):
        out = []
        if first:
            if state:
                out += closed()
            state = {"key": key, "quoted": key[2], "depth": key[3], "mark": None, "n": 0, "head": False, "text": []}
        out += rows(key, values)
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if state:
        yield pa.RecordBatch.from_pylist(list(closed()), schema=schema)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """path, file_order, properties and geometry of every feature of the FeatureCollections at ``path``.

    The same features in the same order as of the document read whole, from ranges of
    ``spark.sql.files.maxPartitionBytes`` bytes. Other members of the document may stand before and
    after ``features``. A document without features gives no row; a feature that is broken off or
    malformed fails the job. A single feature has to fit a task.
    """
    pieces = _pieces(spark, path)
    # a row for each range: at 128 MB a range, a thousand of them are 128 GB
    started = pieces.join(F.broadcast(_ranges(pieces)), ["path", "at"]).select("path", "at", "quoted", "depth", "value")
    cuts = materialise(started.mapInArrow(_cuts, CUT), "cuts")
    counts = cuts.groupBy("path", "at").agg(
        F.max(F.when(F.col("n") == -1, F.col("mark"))).alias("last"),
        F.count_if(F.col("head") & F.col("mark").isNull()).alias("unknown"),
        F.count_if(F.col("head") & F.col("mark").isNotNull()).alias("known"),
    )
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("carried", F.coalesce(F.last("last", ignorenulls=True).over(before) == "<", F.lit(False)))
    counts = counts.withColumn("others", F.when(F.col("carried"), F.lit(0)).otherwise(F.col("unknown")))
    counts = counts.withColumn("base", F.coalesce(F.sum(F.col("known") + F.col("unknown") - F.col("others")).over(before), F.lit(0)))
    bases = materialise(counts.select("path", "at", "carried", "others", "base"), "bases")
    # a part without a head goes on with the last feature before its range
    order = F.when(F.col("head"), F.col("base") + F.col("n") - F.col("others")).otherwise(F.col("base") - 1).cast("int")
    mine = F.when(F.col("head") & F.col("mark").isNotNull(), F.lit(True)).otherwise(F.col("carried"))
    parts = cuts.where("n >= 0").join(F.broadcast(bases), ["path", "at"]).where(mine).select("path", order.alias("file_order"), "at", F.col("head") & F.col("tail"), "text").toDF("path", "file_order", "at", "whole", "text")
    crossing = parts.where("not whole").groupBy("path", "file_order").agg(F.array_sort(F.collect_list(F.struct("at", "text")))["text"].alias("texts"))
    whole = parts.where("whole").select("path", "file_order", "text").unionByName(crossing.select("path", "file_order", F.array_join("texts", "").alias("text")))
    return whole.select("path", "file_order", F.from_json("text", FEATURE, {"mode": "FAILFAST"}).alias("f")).select("path", "file_order", "f.*")


def read_polygon_ranges(spark: SparkSession, path: str, name: str = "name", exterior_only: bool = False) -> DataFrame:
    """``tables.read_polygons`` for one large document."""
    return vertices(read_features(spark, path).drop("path"), name, exterior_only)
