"""The network's lines as one topology document: numbered arcs, a transform, and objects that name arcs.

The document is a folder of text parts which make one JSON text when they are put together in
order. Many tasks write it, an arc or an object on each line, and many read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import DEFAULT, Params

HEAD = '{"type":"Topology","transform":{"scale":[%s,%s],"translate":[%s,%s]},"arcs":['
MIDDLE = '],"objects":{"roads":{"type":"GeometryCollection","geometries":['
TAIL = "]}}}"


def numbered(arcs: DataFrame) -> DataFrame:
    """(tmc, n, arc): equal arcs have one number, from 0 by the first segment that has them."""
    first = arcs.groupBy("arc").agg(F.min("tmc").alias("__first"))
    # as long as the network
    named = first.withColumn("n", F.row_number().over(Window.orderBy("__first")) - 1)
    return arcs.join(named.drop("__first"), "arc").select("tmc", "n", "arc")


def write_topology(arcs: DataFrame, path: str, params: Params = DEFAULT) -> None:
    """The arcs (tmc, arc of integer steps, the first from 0) as a document below ``path``.

    The transform moves the least first place to 0, so that arcs begin with small numbers.
    """
    known = numbered(arcs)
    spark = arcs.sparkSession
    least = known.agg(F.min(F.col("arc")[0][0]).alias("x"), F.min(F.col("arc")[0][1]).alias("y"), F.max("n").alias("n"), F.count(F.lit(1)).alias("lines")).first()
    x, y = least.x or 0, least.y or 0
    moved = F.transform("arc", lambda p, i: F.when(i == 0, F.array(p[0] - x, p[1] - y)).otherwise(p))
    unique = known.groupBy("n").agg(F.any_value(moved).alias("arc"))
    bodies = unique.select(F.lit(1).alias("section"), "n", F.concat(F.to_json("arc"), F.when(F.col("n") < least.n, ",").otherwise("")).alias("value"))
    place = (F.row_number().over(Window.orderBy("tmc"))).cast("int")  # as long as the network
    shape = F.struct(F.lit("LineString").alias("type"), F.array("n").alias("arcs"), F.struct("tmc").alias("properties"))
    objects = known.select(F.lit(3).alias("section"), place.alias("n"), F.to_json(shape).alias("value")).withColumn("value", F.concat("value", F.when(F.col("n") < least.lines, ",").otherwise("")))
    scale = 1.0 / params.quantum
    frame = spark.createDataFrame([(0, 0, HEAD % (scale, scale, x / params.quantum, y / params.quantum)), (2, 0, MIDDLE), (4, 0, TAIL)], "section int, n int, value string")
    frame.unionByName(bodies).unionByName(objects).orderBy("section", "n").select("value").write.text(path)


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """(tmc, arc, i, lon, lat) of the objects' lines, by way of the numbers of their arcs.

    An arc's number is its place in the document: lines are counted by part and split first, then
    within each split.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    head = lines.where(F.col("value").startswith('{"type":"Topology"')).select(F.from_json(F.concat("value", F.lit("]}")), "transform struct<scale:array<double>,translate:array<double>>").alias("t")).first().t.transform
    arcs = lines.where(F.col("value").startswith("[["))
    split = arcs.groupBy("file", "start").agg(F.count(F.lit(1)).alias("size"))
    before = split.select("file", "start", (F.sum("size").over(Window.orderBy("file", "start")) - F.col("size")).alias("before"))  # a row for each split
    place = F.row_number().over(Window.partitionBy("file", "start").orderBy("line")) - 1
    numbers = arcs.withColumn("place", place).join(before, ["file", "start"]).select((F.col("before") + F.col("place")).alias("n"), F.from_json(F.rtrim(F.col("value"), F.lit(",")), "array<array<bigint>>").alias("arc"))
    objects = lines.where(F.col("value").startswith('{"type":"LineString"')).select(F.from_json(F.rtrim(F.col("value"), F.lit(",")), "arcs array<bigint>, properties struct<tmc:string>").alias("o"))
    named = objects.select(F.col("o.properties.tmc").alias("tmc"), F.posexplode("o.arcs").alias("k", "n")).join(numbers, "n")
    steps = named.select("tmc", "k", F.col("n").alias("arc"), F.posexplode("arc").alias("i", "d"))
    along = Window.partitionBy("tmc", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    (sx, sy), (tx, ty) = head.scale, head.translate
    return steps.select("tmc", "arc", "i", (F.sum(F.col("d")[0]).over(along) * sx + tx).alias("lon"), (F.sum(F.col("d")[1]).over(along) * sy + ty).alias("lat"))
