"""Places of segments: districts, polylines, their encoding, sideways offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import DEFAULT, Params


def midpoints(ordered: DataFrame, watched: DataFrame, segments: DataFrame) -> DataFrame:
    """(tmc, lat, lon) of every segment in use, each once."""
    used = ordered.select("tmc").union(watched.select("tmc")).distinct()
    return segments.join(used, "tmc", "left_semi").select("tmc", ((F.col("start_latitude") + F.col("end_latitude")) / 2.0).alias("lat"), ((F.col("start_longitude") + F.col("end_longitude")) / 2.0).alias("lon"))


def ring_edges(polygons: DataFrame) -> DataFrame:
    """Edges (file_order, name, x1, y1, x2, y2) of closed rings of vertices."""
    along = Window.partitionBy("file_order", "ring").orderBy("i")
    nxt = polygons.withColumns({"x2": F.lead("x").over(along), "y2": F.lead("y").over(along)})
    return nxt.where("x2 IS NOT NULL").select("file_order", "name", F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2")


#: Edges of a polygon to a band of latitude, about, and copies of an edge in bands, on average, at most.
BAND_EDGES, COPIES = 8, 4


def banded(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bands, edges): each polygon's box with its number of bands, and its edges in each band they touch.

    Bands are as many as the edges allow, so that a point meets few of them whatever a polygon's
    size, but no more than keeps long edges from being copied without bound.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    box = edges.groupBy("file_order").agg(
        F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x9"), F.min(low).alias("y0"), F.max(high).alias("y9"), F.count(F.lit(1)).alias("n"), F.sum(high - low).alias("rise")
    )
    tall = F.col("y9") - F.col("y0")
    most = F.least(F.col("n") / BAND_EDGES, COPIES * F.col("n") * tall / F.nullif("rise", F.lit(0.0)))
    bands = box.withColumns({"bands": F.greatest(F.lit(1), F.floor(F.coalesce(most, F.lit(1.0)))), "tall": tall})
    of = bands.select("file_order", "bands", "tall", "y0")
    first, last = (_band(y) for y in (low, high))
    return bands, edges.join(of, "file_order").select("file_order", "name", "x1", "y1", "x2", "y2", F.explode(F.sequence(first, last)).alias("band"))


def _band(y: Column) -> Column:
    """The band of a latitude; it only grows with it, so a point's band is between those of an edge's ends at its height."""
    at = F.floor((y - F.col("y0")) / F.nullif("tall", F.lit(0.0)) * F.col("bands"))
    return F.least(F.coalesce(at, F.lit(0)), F.col("bands") - 1)


def districts_of(points: DataFrame, polygons: DataFrame, cell: float = 0.25) -> DataFrame:
    """(tmc, cid_name): the first polygon in file order that holds the point, or null.

    Even-odd over all rings, so holes are outside. Points and polygon boxes meet on grid cells, and
    a ray to the east counts the edges of those polygons in the point's band of latitude alone.
    """
    box, edges = banded(ring_edges(polygons))

    def cells(low: str, high: str):
        return F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))

    tiles = box.withColumn("cx", cells("x0", "x9")).withColumn("cy", cells("y0", "y9"))
    p = points.withColumns({"cx": F.floor(F.col("lon") / cell), "cy": F.floor(F.col("lat") / cell)})
    near = p.join(tiles, ["cx", "cy"]).where(F.col("lon").between(F.col("x0"), F.col("x9")) & F.col("lat").between(F.col("y0"), F.col("y9"))).select("tmc", "lat", "lon", "file_order", _band(F.col("lat")).alias("band"))
    rows = near.join(edges, ["file_order", "band"])
    crosses = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) + F.col("x1"))
    inside = rows.groupBy("tmc", "file_order", "name").agg(F.count_if(crosses).alias("n")).where("n % 2 = 1")
    first = inside.groupBy("tmc").agg(F.min_by("name", "file_order").alias("cid_name"))
    return points.select("tmc").join(first, "tmc", "left")


def polylines(segments: DataFrame, vertices: DataFrame) -> DataFrame:
    """(tmc, points): the vertices in order where there are some, else a straight line."""
    own = vertices.groupBy("tmc").agg(F.array_sort(F.collect_list(F.struct("i", "lat", "lon"))).alias("v"))
    points = F.transform("v", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))
    straight = F.array(F.struct(F.col("start_latitude").alias("lat"), F.col("start_longitude").alias("lon")), F.struct(F.col("end_latitude").alias("lat"), F.col("end_longitude").alias("lon")))
    return segments.join(own, "tmc", "left").select("tmc", F.coalesce(points, straight).alias("points"))


def offset(lines: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Each line moved to the right of its travel by a fixed distance; single points stay."""
    a, b = F.element_at("points", 1), F.element_at("points", -1)
    across = F.atan2(b["lon"] - a["lon"], b["lat"] - a["lat"]) + F.pi() / 2
    shrink = F.greatest(F.lit(0.1), F.cos(F.radians((a["lat"] + b["lat"]) / 2.0)))
    moved = lines.withColumns({"up": params.offset_metres * F.cos(across) / params.metres_per_degree, "east": params.offset_metres * F.sin(across) / (params.metres_per_degree * shrink)})
    points = F.transform("points", lambda p: F.struct((p["lat"] + F.col("up")).alias("lat"), (p["lon"] + F.col("east")).alias("lon")))
    return moved.select("tmc", F.when(F.size("points") < 2, F.col("points")).otherwise(points).alias("points"))


def exploded(lines: DataFrame, places: int = 9) -> DataFrame:
    """(tmc, i, lat, lon) of lines, rounded."""
    return lines.select("tmc", F.posexplode("points").alias("i", "p")).select("tmc", "i", F.round("p.lat", places).alias("lat"), F.round("p.lon", places).alias("lon"))


def encode(vertices: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Quantised deltas (tmc, i, dx, dy): each vertex against the one before, the first against 0."""
    along = Window.partitionBy("tmc").orderBy("i")
    q = vertices.withColumns({"x": F.bround(F.col("lon") * params.quantum, 0).cast("long"), "y": F.bround(F.col("lat") * params.quantum, 0).cast("long")})
    return q.select("tmc", "i", (F.col("x") - F.coalesce(F.lag("x").over(along), F.lit(0))).alias("dx"), (F.col("y") - F.coalesce(F.lag("y").over(along), F.lit(0))).alias("dy"))


def arcs(deltas: DataFrame) -> DataFrame:
    """(tmc, arc): each line's deltas as one array of pairs, the stored form."""
    return deltas.groupBy("tmc").agg(F.array_sort(F.collect_list(F.struct("i", "dx", "dy"))).alias("v")).select("tmc", F.transform("v", lambda p: F.array(p["dx"], p["dy"])).alias("arc"))


def decode(stored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(tmc, i, lon, lat) from arcs: running sums over the scale."""
    along = Window.partitionBy("tmc").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored.select("tmc", F.posexplode("arc").alias("i", "d"))
    return rows.select("tmc", "i", (F.sum(F.col("d")[0]).over(along) / params.quantum).alias("lon"), (F.sum(F.col("d")[1]).over(along) / params.quantum).alias("lat"))


def ring_table(polygons: DataFrame) -> DataFrame:
    """(name, ring, n_points, points): exterior rings as arrays of [lat, lon] for a boundary layer."""
    outer = polygons.where("ring = 0")
    found = outer.groupBy("file_order", "name").agg(F.array_sort(F.collect_list(F.struct("i", "y", "x"))).alias("v"))
    return found.select("name", "file_order", F.size("v").alias("n_points"), F.to_json(F.transform("v", lambda p: F.array(p["y"], p["x"]))).alias("ring"))
