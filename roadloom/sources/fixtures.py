"""Road segments and probe readings as views over the star-schema tables of the data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One road segment for each supplier: roads of 20 segments, five classes in turn."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = _table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.withColumns({"k": F.col("s_suppkey").cast("long"), "rd": F.expr("cast(s_suppkey div 20 as long)"), "pos": F.expr("cast(s_suppkey % 20 as long)")}).withColumn("cls", F.col("rd") % 5)
    return rows.selectExpr(
        "concat('T', lpad(cast(k as string), 6, '0')) AS tmc",
        "CASE cls WHEN 0 THEN concat('I-', 20 + rd) WHEN 1 THEN concat('GA-', 400 + rd) WHEN 2 THEN concat('US-', 20 + rd) WHEN 3 THEN concat('SR-', 20 + rd) ELSE concat('LOCAL RD ', rd) END AS road",
        "CASE WHEN rd % 2 = 0 THEN 'NORTHBOUND' ELSE 'SOUTHBOUND' END AS direction",
        "concat('X', pos div 2) AS intersection",
        "n_name AS county",
        "cast(33.5 as double) + cast(0.01 as double) * pos AS start_latitude",
        "cast(-84.5 as double) + cast(0.02 as double) * rd AS start_longitude",
        "cast(33.5 as double) + cast(0.01 as double) * pos + cast(0.01 as double) AS end_latitude",
        "cast(-84.5 as double) + cast(0.02 as double) * rd AS end_longitude",
        "cast(0.2 as double) + cast(0.05 as double) * ((k * 7) % 10) AS miles",
        "cast(pos + 1 as double) AS road_order",
        "cast(k div 4 as string) AS tmclinear",
        "cast(CASE cls WHEN 0 THEN 1 WHEN 1 THEN (CASE WHEN pos < 12 THEN 2 ELSE 3 END) WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE (CASE WHEN k % 2 = 0 THEN 5 ELSE 7 END) END as int) AS f_system",
        "CASE WHEN cls = 3 AND pos >= 18 THEN NULL ELSE 1 END AS urban_code",
        "CASE WHEN s_acctbal < 0 THEN NULL ELSE cast(floor(cast(s_acctbal as double) * 20) as int) END AS aadt",
    )


def reading_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One probe reading for each line item: 40 weekdays, an evening peak and some nights."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as long) AS s", "cast(l_orderkey as long) % 40 AS k", "cast(l_partkey as long) AS p", "cast(l_linenumber as long) AS l", "cast(l_quantity as double) AS q", "l_returnflag"
    )
    slotted = lines.selectExpr("*", "s % 20 AS pos", "p % 4 = 0 AS night").selectExpr("*", "CASE WHEN night THEN (p div 4 + l) % 12 ELSE 192 + (p + l * 5) % 24 END AS slot")
    return slotted.selectExpr(
        "concat('T', lpad(cast(s as string), 6, '0')) AS tmc_code",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(7 * (k div 5) + k % 5 as int), 0, cast(5 * slot as int), 0) AS measurement_tstamp",
        "CASE WHEN p % 97 = 0 THEN NULL ELSE q + 4 * least(abs(pos - 6), abs(pos - 14)) + (CASE WHEN night THEN 30 ELSE 0 END) END AS speed",
        "CASE WHEN p % 89 = 0 THEN cast(0 as double) ELSE cast(60 as double) END AS reference_speed",
        "(CASE WHEN p % 89 = 0 THEN cast(0 as double) ELSE cast(60 as double) END) * cast(0.9 as double) AS historical_average_speed",
        "cast(NULL as double) AS travel_time_minutes",
        "l_returnflag AS data_density",
    )


def staged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as staged text, null as empty text."""
    rows = reading_table(spark, sf_dir)
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])


def polygon_table(segments: DataFrame) -> DataFrame:
    """Districts as polygon vertices (name, file_order, ring, i, x, y), derived from the segments.

    One square around each road's first ten segments, with a hole in every other one, and one
    large square over all of them that comes last.
    """
    roads = segments.groupBy("road").agg(F.min("start_longitude").alias("lon"), F.min("start_latitude").alias("lat"))
    numbered = roads.selectExpr("road", "lon", "lat", "cast(round((lon + 84.5) / 0.02) as int) AS file_order")
    box = "array(named_struct('ring', 0, 'i', 0, 'x', lon - 0.015, 'y', lat - 0.005), named_struct('ring', 0, 'i', 1, 'x', lon + 0.015, 'y', lat - 0.005), named_struct('ring', 0, 'i', 2, 'x', lon + 0.015, 'y', lat + 0.1), named_struct('ring', 0, 'i', 3, 'x', lon - 0.015, 'y', lat + 0.1), named_struct('ring', 0, 'i', 4, 'x', lon - 0.015, 'y', lat - 0.005))"
    hole = box.replace("'ring', 0", "'ring', 1").replace("lon - 0.015", "lon - 0.002").replace("lon + 0.015", "lon + 0.002").replace("lat - 0.005", "lat + 0.02").replace("lat + 0.1", "lat + 0.04")
    boxes = numbered.selectExpr("concat('District ', road) AS name", "file_order", f"inline(CASE WHEN file_order % 2 = 0 THEN concat({box}, {hole}) ELSE {box} END)")
    whole = segments.agg(F.min("start_longitude").alias("a"), F.max("start_longitude").alias("b"), F.min("start_latitude").alias("c")).where("a is not null")
    outer = "array(named_struct('ring', 0, 'i', 0, 'x', a - 0.1, 'y', c - 0.1), named_struct('ring', 0, 'i', 1, 'x', b + 0.1, 'y', c - 0.1), named_struct('ring', 0, 'i', 2, 'x', b + 0.1, 'y', c + 0.155), named_struct('ring', 0, 'i', 3, 'x', a - 0.1, 'y', c + 0.155), named_struct('ring', 0, 'i', 4, 'x', a - 0.1, 'y', c - 0.1))"
    region = whole.selectExpr("'Region' AS name", "1000000 AS file_order", f"inline({outer})")
    cast = ["name", "cast(file_order as int) AS file_order", "cast(ring as int) AS ring", "cast(i as int) AS i", "cast(x as double) AS x", "cast(y as double) AS y"]
    return boxes.selectExpr(*cast).unionByName(region.selectExpr(*cast))


def vertex_table(segments: DataFrame) -> DataFrame:
    """Polyline vertices (tmc, i, lon, lat) of three segments in four, with a bend in the middle."""
    some = segments.where("cast(substring(tmc, 2) as int) % 4 != 3")
    points = "array(named_struct('i', 0, 'lon', start_longitude, 'lat', start_latitude), named_struct('i', 1, 'lon', start_longitude + cast(0.001234567 as double), 'lat', start_latitude + cast(0.004 as double)), named_struct('i', 2, 'lon', end_longitude, 'lat', end_latitude))"
    return some.selectExpr("tmc", f"inline({points})")


def named_road_table(segments: DataFrame) -> DataFrame:
    """Named roads (name, roads, counties or null): one name for two roads, one bound to counties."""
    roads = segments.where("f_system in (3, 4)").select("road").distinct()
    pairs = roads.selectExpr("concat('Main Road ', substring(road, 1, 2), ' ', cast(substring_index(road, '-', -1) as int) div 20) AS name", "road")
    grouped = pairs.groupBy("name").agg(F.array_sort(F.collect_set("road")).alias("roads"))
    counties = segments.agg(F.array_sort(F.collect_set("county")).alias("all")).select(F.expr("filter(all, (x, i) -> i % 2 = 0)").alias("some"))
    return grouped.join(counties, F.col("name").like("Main Road SR%"), "left").select("name", "roads", F.col("some").alias("counties"))
