"""The registered queries of the traffic analysis, each with its SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import columns as c
from ..operators import bottlenecks, characterise, classify, events, geo, intersections, network, observations, profile, ranking, region
from ..sources import database, features, fixtures, sinks, tables, topology
from ..sources.scratch import scratch_path
from . import oracle as o
from .oracle import HOT, RATIO, clock, r, sql, weekday
from .runs import EventRun
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, query: Callable[[Warehouse], DataFrame], select: str | None = None) -> None:
    """A query over a warehouse, and the final select of its SQL."""
    QUERIES[name] = lambda spark, sf_dir: query(Warehouse.of(spark, sf_dir))
    if select is not None:
        ORACLE_SQL[name] = sql(select)


def register_raw(name: str, query: Query, select: str | None = None) -> None:
    QUERIES[name] = query
    if select is not None:
        ORACLE_SQL[name] = sql(select)


# --- sources and sinks -------------------------------------------------------------------------

READINGS = "tmc_code, measurement_tstamp, speed, historical_average_speed, reference_speed, travel_time_minutes, data_density"


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as staged text files, read and typed."""
    path = scratch_path(spark, "staged")
    fixtures.staged_table(spark, sf_dir).select(*READINGS.split(", ")).write.csv(path, header=True)
    return tables.typed_readings(tables.read_staged(spark, path))


register_raw("s1_staged_load", _staged, f"SELECT {READINGS} FROM probe")


def _partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "readings")
    rows = fixtures.reading_table(spark, sf_dir).withColumn("analysis_date", F.to_date("measurement_tstamp"))
    sinks.write_partitioned(rows, path, "analysis_date")
    return spark.read.parquet(path).groupBy("analysis_date").agg(F.count(F.lit(1)).alias("readings"), F.count("speed").alias("speeds"), c.rounded(F.sum("speed"), 2).alias("speed_sum"))


register_raw("s2_partitioned_readings", _partitioned, f"SELECT {o.DAY} AS analysis_date, count(*) AS readings, count(speed) AS speeds, {r('sum(speed)', 2)} AS speed_sum FROM probe GROUP BY ALL")
register("s3_segment_metadata", lambda w: w.segments.select(*[F.round(x, 6).alias(x) if t == "double" else F.col(x) for x, t in w.segments.dtypes]), "SELECT * REPLACE (round(start_latitude, 6) AS start_latitude, round(start_longitude, 6) AS start_longitude, round(end_latitude, 6) AS end_latitude, round(end_longitude, 6) AS end_longitude, round(miles, 6) AS miles) FROM tmc")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings in a relational store, its slow ones read back in eight even ranges of time."""
    url = database.embedded(spark)
    database.load(fixtures.reading_table(spark, sf_dir), url, "readings", "tmc_code VARCHAR(16), data_density VARCHAR(8)")
    rows = database.read_even(spark, url, "readings", "measurement_tstamp", 8)
    return rows.where("reference_speed > 0 AND speed < 30").select(*READINGS.split(", "))


register_raw("s4_database_readings", _stored, f"SELECT {READINGS} FROM probe WHERE reference_speed > 0 AND speed < 30")
DAILY = "corridor_id, analysis_date, segment_order, congested_minutes"


def _replaced(w: Warehouse) -> DataFrame:
    """The daily table on disk by day; each corridor's last day comes anew, the even ones' without rows."""
    rows = w.stage("daily").select(*DAILY.split(", "))
    path = scratch_path(rows.sparkSession, "slices")
    sinks.write_partitioned(rows, path, "analysis_date")
    last = rows.groupBy("corridor_id").agg(F.max("analysis_date").alias("analysis_date"))
    new = rows.join(last, ["corridor_id", "analysis_date"], "left_semi").where("corridor_id % 2 = 1").withColumn("congested_minutes", F.col("congested_minutes") + 1)
    sinks.overwrite_slices(new, path, last, by=["analysis_date"])
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*DAILY.split(", "))


register(
    "s5_replace_slice", _replaced,
    """SELECT corridor_id, analysis_date, segment_order, CASE WHEN analysis_date = last_day THEN congested_minutes + 1 ELSE congested_minutes END AS congested_minutes FROM (SELECT *, max(analysis_date) OVER (PARTITION BY corridor_id) AS last_day FROM daily) WHERE analysis_date < last_day OR corridor_id % 2 = 1""",
)


def _cascaded(w: Warehouse) -> DataFrame:
    """Bottlenecks on disk by corridor group; those of all but Arterial corridors come back empty, and their members go."""
    parents = w.stage("bottlenecks")
    path = scratch_path(parents.sparkSession, "parents")
    sinks.write_partitioned(parents, path, "corridor_group")
    sinks.overwrite_slices(parents.limit(0), path, parents.where("corridor_group <> 'Arterial'").select("corridor_group", "corridor_id").distinct(), by=["corridor_group"])
    return sinks.drop_orphans(w.members, parents.sparkSession.read.schema(parents.schema).parquet(path), ["bottleneck_id"])


register("s6_cascade_children", _cascaded, "SELECT bottleneck_id, segment_order FROM members WHERE bottleneck_id IN (SELECT bottleneck_id FROM bottlenecks WHERE corridor_group = 'Arterial')")


def _pairs(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    keep = ("road", "direction", "corridor_group", "peak_aadt")
    return network.arterials(w.segments).select(*keep), network.expressways(w.segments).select(*keep)


ART, EXP = "SELECT road, direction, 'Arterial' AS corridor_group, peak_aadt FROM cand_a", "SELECT road, direction, 'Expressway' AS corridor_group, peak_aadt FROM cand_e"


def _merged(w: Warehouse) -> DataFrame:
    """Arterials on disk in several files; the expressways are merged into those that hold their keys."""
    old, new = _pairs(w)
    path = scratch_path(old.sparkSession, "merged")
    old.repartitionByRange(4, "road", "direction").write.parquet(path)
    sinks.merge_files(new, path, ["road", "direction"])
    return old.sparkSession.read.schema(new.schema).parquet(path)


register("s7_upsert", _merged, f"{EXP} UNION ALL SELECT * FROM ({ART}) AS a WHERE (road, direction) NOT IN (SELECT (road, direction) FROM cand_e)")
register("s8_insert_absent", lambda w: sinks.insert_absent(*_pairs(w), ["road", "direction"]), f"SELECT * FROM ({ART}) UNION ALL SELECT * FROM ({EXP}) AS a WHERE (road, direction) NOT IN (SELECT (road, direction) FROM cand_a)")
#: Exported name, the SQL's part, what names a row, and a measure of it.
EXPORTED = (
    ("corridor_definitions", "registry", "corridor_id", "0"), ("corridor_segments", "segs", "corridor_id, segment_order", "miles"), ("segment_profile", "profile", "corridor_id, segment_order", "weekday_occurrence_pct"),
    ("bottlenecks", "bottlenecks", "bottleneck_id", "peak_occurrence_pct"), ("watch_segments", "watch", "tmc", "aadt"), ("tmc_metadata", "tmc", "tmc", "miles"),
)


def _exported(w: Warehouse) -> DataFrame:
    """All rows of the exported tables as they are read back: their keys and one measure."""
    spark = w.segments.sparkSession
    base = scratch_path(spark, "export")
    sinks.export(dict(zip([x[0] for x in EXPORTED], (w.stage("definitions"), w.stage("ordered"), w.stage("profile"), w.stage("bottlenecks"), w.watched, w.segments), strict=True)), base)
    back = [spark.read.parquet(f"{base}/{n}").selectExpr(f"'{n}' AS name", f"concat_ws(':', {key}) AS key", f"round(cast({value} as double), 6) AS value") for n, _, key, value in EXPORTED]
    return reduce(DataFrame.unionByName, back)


register("s9_export", _exported, " UNION ALL ".join(f"SELECT '{n}' AS name, concat_ws(':', {key}) AS key, round(CAST({value} AS DOUBLE), 6) AS value FROM {t}" for n, t, key, value in EXPORTED))


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_order and value: each polygon of the fixture as a GeoJSON feature."""
    rings = fixtures.polygon_table(fixtures.segment_table(spark, sf_dir)).groupBy("file_order", "name", "ring").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("v"))
    shapes = rings.select("file_order", "name", F.struct("ring", F.transform("v", lambda p: F.array(p["x"], p["y"])).alias("p")).alias("r")).groupBy("file_order", "name").agg(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["p"]).alias("c"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("name", "file_order").alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.col("c").alias("coordinates")).alias("geometry"))
    return shapes.select("file_order", F.to_json(feature).alias("value"))


def _geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons written as GeoJSON, a feature on each line, and read again."""
    path = scratch_path(spark, "geojson")
    _shapes(spark, sf_dir).select("value").write.text(path)
    rows = tables.read_polygon_lines(spark, path)
    return rows.select("name", "ring", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons written as one GeoJSON document (one file, so one task) and read again by ranges of bytes."""
    path = scratch_path(spark, "document")
    shapes = _shapes(spark, sf_dir).select("file_order", F.concat(F.when(F.col("file_order") == F.min("file_order").over(Window.partitionBy()), F.lit("")).otherwise(F.lit(",")), "value").alias("value"))
    edges = spark.createDataFrame([(-1, '{"type":"FeatureCollection","features":['), (2**31 - 1, "]}")], "file_order int, value string")
    shapes.unionByName(edges).coalesce(1).sortWithinPartitions("file_order").select("value").write.text(path)
    rows = features.read_polygon_ranges(spark, path)
    return rows.select("name", "file_order", "ring", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


register_raw("s10_geojson_polygons", _geojson, "SELECT name, ring, i, round(x, 6) AS x, round(y, 6) AS y FROM polygons")
register_raw("s10_geojson_document", _document, "SELECT name, CAST(dense_rank() OVER (ORDER BY file_order) - 1 AS INTEGER) AS file_order, ring, i, round(x, 6) AS x, round(y, 6) AS y FROM polygons")
register("s11_arc_store", lambda w: geo.arcs(geo.encode(fixtures.vertex_table(w.segments))).select("tmc", F.to_json("arc").alias("arc")), "SELECT tmc, '[' || string_agg('[' || dx || ',' || dy || ']', ',' ORDER BY i) || ']' AS arc FROM deltas GROUP BY tmc")


def _topology(w: Warehouse) -> DataFrame:
    """The network's lines by way of a topology document: each vertex as read back, with the number of its arc."""
    path = scratch_path(w.segments.sparkSession, "topology")
    topology.write_topology(geo.arcs(geo.encode(fixtures.vertex_table(w.segments))), path, w.params)
    return topology.read_topology(w.segments.sparkSession, path).select("tmc", "arc", "i", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


register(
    "s11_topology_document", _topology,
    """SELECT v.tmc, n.arc, v.i, round(round_even(lon * 1e6, 0) / 1e6, 6) AS lon, round(round_even(lat * 1e6, 0) / 1e6, 6) AS lat FROM vertices AS v JOIN
    (SELECT tmc, dense_rank() OVER (ORDER BY first) - 1 AS arc FROM (SELECT tmc, min(tmc) OVER (PARTITION BY steps) AS first FROM (SELECT tmc, string_agg(dx || ' ' || dy, ',' ORDER BY i) AS steps FROM deltas GROUP BY tmc))) AS n ON n.tmc = v.tmc""",
)


def _logged(w: Warehouse) -> DataFrame:
    """The log of two stages of all corridors, appended and read back; its times are only looked at for being there."""
    spark = w.segments.sparkSession
    log = scratch_path(spark, "runs")
    for stage, name in (("segment_daily", "daily"), ("segment_profile", "profile")):
        sinks.run_logged(spark, log, stage, lambda n=name: w.stage(n))
    return sinks.read_log(spark, log).select("stage", "corridor_id", "rows_written", "status", "detail", (F.col("finished_at") >= F.col("started_at")).alias("finished"))


register("s12_run_log", _logged, " UNION ALL ".join(f"SELECT '{s}' AS stage, corridor_id, count(*) AS rows_written, 'success' AS status, '' AS detail, true AS finished FROM {t} GROUP BY corridor_id" for s, t in (("segment_daily", "daily"), ("segment_profile", "profile"))))

# --- network -----------------------------------------------------------------------------------

PAIR = "road, direction, corridor_name, segment_count, peak_aadt"
for name, function, part in (("n1_interstates", network.interstates, "cand_i"), ("n2_arterials", network.arterials, "cand_a"), ("n3_expressways", network.expressways, "cand_e")):
    register(name, lambda w, f=function: f(w.segments).drop("corridor_group"), f"SELECT {PAIR} FROM {part}")
REGISTRY = "corridor_id, road, direction, corridor_name, corridor_group, is_active, ranking_eligible"
register(
    "n4_deactivate_stale", lambda w: network.deactivate_stale(network.deactivate_stale(w.definitions, w.segments.where("aadt IS NOT NULL"), "Arterial"), w.segments.where("aadt IS NOT NULL"), "Expressway").select("corridor_id", "road", "direction", "is_active"),
    """SELECT corridor_id, road, direction, corridor_group NOT IN ('Arterial', 'Expressway') OR (SELECT count(*) FROM tmc AS t WHERE t.road = d.road AND t.direction = d.direction AND t.aadt IS NOT NULL AND (t.f_system = 2 AND d.corridor_group = 'Expressway' OR t.f_system IN (3, 4) AND d.corridor_group = 'Arterial')) >= 3 AS is_active FROM registry AS d""",
)
register("n5_registry", lambda w: w.definitions.select(*REGISTRY.split(", ")), f"SELECT {REGISTRY} FROM registry")
SEG = "corridor_id, corridor_name, segment_order, tmc, road, direction, intersection, round(miles, 6) AS miles, road_order"
register("n6_corridor_segments", lambda w: w.ordered.selectExpr(*SEG.split(", ")[:7], "round(miles, 6) AS miles", "road_order"), f"SELECT {SEG} FROM segs")
PLAN = "corridor_id, road, direction, run_number, bucket, start_order, end_order, segment_count, from_intersection, to_intersection"
register("n7_split_plan", lambda w: network.split_plan(w.definitions, w.segments), f"SELECT {PLAN} FROM split_plan")


def _split(w: Warehouse) -> DataFrame:
    return network.apply_split(w.definitions, network.split_plan(w.definitions, w.segments))


register("n8_split_registry", lambda w: _split(w).select(*REGISTRY.split(", ")[:6], "source_road", "segment_order_start", "segment_order_end"), "SELECT corridor_id, road, direction, corridor_name, corridor_group, is_active, source_road, segment_order_start, segment_order_end FROM split_registry")
register(
    "n8_split_segments", lambda w: network.corridor_segments(_split(w), w.segments).select("corridor_id", "segment_order", "tmc"),
    """SELECT corridor_id, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY road_order, tmc) AS INTEGER) AS segment_order, tmc FROM split_registry AS d JOIN tmc AS m ON m.road = d.source_road AND m.direction = d.direction
    AND (segment_order_start IS NULL OR road_order >= segment_order_start) AND (segment_order_end IS NULL OR road_order <= segment_order_end) WHERE d.is_active""",
)
register("n9_ranking_eligibility", lambda w: w.definitions.select("corridor_id", "ranking_eligible"), "SELECT corridor_id, ranking_eligible FROM registry")
WATCH = "tmc, road, direction, intersection, county, f_system, road_class, aadt, round(miles, 6) AS miles, rank_in_class"
register("n10_watch_segments", lambda w: w.watched.withColumn("miles", F.round("miles", 6)), f"SELECT {WATCH} FROM watch")
register(
    "n11_watch_next", lambda w: network.next_intersections(w.watched, w.segments).select("tmc", "from_intersection", "to_intersection", "road_class", "rank_in_class"),
    """SELECT w.tmc, w.intersection AS from_intersection, (SELECT arg_min(n.intersection, n.road_order) FROM tmc AS n WHERE n.road = w.road AND n.direction = w.direction AND n.road_order > t.road_order) AS to_intersection, w.road_class, w.rank_in_class FROM watch AS w JOIN tmc AS t ON t.tmc = w.tmc""",
)
register("n12_active_corridors", lambda w: network.active_corridors(w.definitions), "SELECT corridor_id, road, direction, corridor_name, corridor_group, lower(replace(road, '/', '-')) || '-' || lower(left(direction, 2)) AS slug FROM registry WHERE is_active")
register("n13_corridor_extent", lambda w: network.corridor_extent(w.ordered), "SELECT corridor_id, arg_min(intersection, segment_order) AS from_intersection, arg_max(intersection, segment_order) AS to_intersection FROM segs GROUP BY corridor_id")
register(
    "n14_corridor_summary", lambda w: network.corridor_summary(w.definitions, w.ordered, w.daily, w.stage("events")),
    f"""SELECT corridor_id, corridor_name, (SELECT count(DISTINCT tmc) FROM segs AS s WHERE s.corridor_id = d.corridor_id) AS tmcs, (SELECT {r("sum(miles)", 2)} FROM segs AS s WHERE s.corridor_id = d.corridor_id) AS miles,
    (SELECT count(DISTINCT analysis_date) FROM daily AS x WHERE x.corridor_id = d.corridor_id) AS analyzed_days, (SELECT count(*) FROM events AS e WHERE e.corridor_id = d.corridor_id) AS events FROM registry AS d WHERE is_active""",
)
register(
    "n15_inventory", lambda w: network.inventory(w.definitions, w.ordered, w.watched),
    f"""SELECT 'corridor' AS kind, d.corridor_name AS name, count(s.tmc) AS n, {r("sum(miles)", 2)} AS miles FROM registry AS d LEFT JOIN segs AS s ON s.corridor_id = d.corridor_id GROUP BY d.corridor_id, d.corridor_name
    UNION ALL SELECT 'group', corridor_group, count(*), NULL FROM registry WHERE is_active GROUP BY corridor_group UNION ALL SELECT 'watch', road_class, count(*), {r("sum(miles)", 2)} FROM watch GROUP BY road_class""",
)
register(
    "n16_scope_counts", lambda w: observations.scope_counts(w.readings, w.segments, w.ordered, w.watched, w.definitions, w.stage("events"), w.stage("bottlenecks"), w.stage("metrics")),
    """SELECT (SELECT count(*) FROM probe) AS probe_total, (SELECT min(measurement_tstamp) FROM probe) AS probe_min, (SELECT max(measurement_tstamp) FROM probe) AS probe_max, (SELECT count(*) FROM probe JOIN segs ON tmc = tmc_code) + (SELECT count(*) FROM probe JOIN watch ON tmc = tmc_code) AS probe_analyzed,
    (SELECT count(*) FROM events) AS events_total, (SELECT min(analysis_date) FROM events) AS date_min, (SELECT max(analysis_date) FROM events) AS date_max, (SELECT count(DISTINCT analysis_date) FROM events) AS date_count, (SELECT count(*) FROM tmc) AS tmc_total, (SELECT count(*) FROM segs) AS segments_total,
    (SELECT count(*) FROM watch) AS watch_total, (SELECT count(*) FROM registry WHERE is_active) AS corridors_total, (SELECT count(*) FROM bottlenecks) AS bottlenecks_total, (SELECT count(*) FROM metrics) AS daily_metrics_total""",
)

# --- observations ------------------------------------------------------------------------------

OBS = f"SELECT tmc_code, measurement_tstamp, road, direction, intersection, county, round(miles, 6) AS miles, speed, reference_speed, round({RATIO}, 9) AS speed_ratio, {HOT} AS is_congested, greatest(reference_speed - speed, 0.0) AS speed_drop FROM probe JOIN tmc ON tmc = tmc_code"
register("d1_observations", lambda w: observations.observations(w.readings, w.segments).withColumns({"miles": F.round("miles", 6), "speed_ratio": F.round("speed_ratio", 9)}), OBS)
ROLLUP = f"""SELECT tmc_code, CAST(measurement_tstamp AS DATE) AS analysis_date, count(*) AS readings, count(*) FILTER (is_congested) AS congested_readings, count(*) FILTER (is_congested) * 5 AS congested_minutes, {r("avg(speed)", 3)} AS avg_speed, {r("avg(speed_drop)", 3)} AS avg_speed_drop, {r("max(speed_drop)", 3)} AS max_speed_drop
    FROM (SELECT p.*, {HOT} AS is_congested, greatest(reference_speed - speed, 0.0) AS speed_drop FROM probe AS p JOIN tmc ON tmc = tmc_code) GROUP BY ALL"""


def _rollup(w: Warehouse) -> DataFrame:
    return observations.daily_rollup(observations.observations(w.readings, w.segments))


def _materialised(w: Warehouse) -> DataFrame:
    path = scratch_path(w.segments.sparkSession, "daily")
    _rollup(w).write.parquet(path)
    return w.segments.sparkSession.read.parquet(path)


register("d2_daily_rollup", _rollup, ROLLUP)
register("s13_materialised_daily", _materialised, ROLLUP)


def _refreshed(w: Warehouse) -> DataFrame:
    """The rollup from states by day: those of most readings first, then those of the ones of density R, which come late."""
    spark, late = w.segments.sparkSession, F.col("data_density") == "R"
    path = scratch_path(spark, "states")
    for part in (w.readings.where(~late), w.readings.where(late)):
        states = observations.rollup_states(observations.observations(part, w.segments))
        sinks.append_states(states, path, "analysis_date")
    return observations.merged_rollup(spark.read.schema(states.schema).parquet(path))


register("s13_refreshed_daily", _refreshed, ROLLUP)


def _bucketed(w: Warehouse) -> DataFrame:
    """The rollup from readings in buckets of segments: their one shuffle is that of the writing."""
    path = scratch_path(w.segments.sparkSession, "buckets")
    readings = sinks.write_bucketed(w.readings.select(*READINGS.split(", ")), path, "tmc_code", 8, "measurement_tstamp")
    return observations.daily_rollup(observations.observations(readings, w.segments))


register("s2_bucketed_readings", _bucketed, ROLLUP)
register("d3_available_days", lambda w: observations.available_days(w.joined), "SELECT DISTINCT corridor_id, analysis_date FROM joined")
# the ledger of this query: days on which the corridor had an event of 8 mile-hours or more
register(
    "d4_remaining_days", lambda w: observations.remaining_days(observations.available_days(w.joined), w.events.where("event_area_mile_hours >= 8")),
    "SELECT corridor_id, analysis_date FROM (SELECT DISTINCT corridor_id, analysis_date FROM joined) AS a WHERE NOT EXISTS (SELECT 1 FROM events AS e WHERE e.corridor_id = a.corridor_id AND e.analysis_date = a.analysis_date AND event_area_mile_hours >= 8)",
)


def _days(w: Warehouse) -> DataFrame:
    days = observations.available_days(w.joined)
    return observations.corridor_day(w.joined, days).select("corridor_id", "analysis_date", "segment_order", "tmc", "measurement_tstamp", "speed", "reference_speed")


register("d5_corridor_day", _days, "SELECT corridor_id, analysis_date, segment_order, tmc, measurement_tstamp, speed, reference_speed FROM joined")
register("d6_hourly_curve", lambda w: observations.hourly_curve(w.readings), f"SELECT CAST(hour(measurement_tstamp) AS INTEGER) AS hour, {r('avg(speed)', 2)} AS avg_speed FROM probe WHERE speed > 0 GROUP BY ALL")
register("d7_hourly_by_class", lambda w: observations.hourly_curve_by_class(w.readings, w.segments), "SELECT road_class, hour, avg_speed FROM class_curve")
register("d8_extreme_hours", lambda w: w.extremes, "SELECT kind, hour FROM extremes")
register("d9_overnight_share", lambda w: w.eligibility, "SELECT bottleneck_id, overnight_congested_pct, ranking_eligible FROM overnight")
register("d10_reference_speed", lambda w: observations.extent_reference_speed(w.stage("bottlenecks"), w.ordered, w.readings), f"SELECT bottleneck_id, {r('avg(reference_speed)', 3)} AS avg_reference_speed FROM probe JOIN within_extent ON tmc = tmc_code GROUP BY bottleneck_id")

# --- events ------------------------------------------------------------------------------------

CELL = "corridor_id, analysis_date, slot, segment_order"
register("e1_grid", lambda w: w.cells.select(*CELL.split(", "), "speed", "reference_speed", "width", "observed", F.round("ratio", 9).alias("ratio")), f"SELECT {CELL}, speed, reference_speed, width, observed, round(ratio, 9) AS ratio FROM cells")
register("e2_raw_mask", lambda w: events.raw_mask(w.cells), f"SELECT {CELL}, width FROM raw")
register("e3_closed_mask", lambda w: events.closed_mask(events.raw_mask(w.cells)), f"SELECT {CELL}, width FROM closed")
register("e4_cores", lambda w: w.marked.where("is_core").drop("is_core"), f"SELECT {CELL} FROM cores")
register(
    "e5_components", lambda w: events.labelled_cells(w.marked.withColumn("is_core", F.lit(False))),
    f"SELECT {CELL}, CAST(dense_rank() OVER (PARTITION BY corridor_id, analysis_date ORDER BY whole) AS INTEGER) AS label FROM comp",
)
register("e6_event_labels", lambda w: events.event_cells(w.stage("cells"), w.params, values=False).select(*CELL.split(", "), "label"), f"SELECT {CELL}, label FROM labels")
register("e7_mileposts", lambda w: events.mileposts(w.cells).select("corridor_id", "analysis_date", "segment_order", "tmc", c.rounded(F.col("start_mile"), 6).alias("start_mile"), c.rounded(F.col("end_mile"), 6).alias("end_mile")), f"SELECT corridor_id, analysis_date, segment_order, tmc, {r('start_mile', 6)} AS start_mile, {r('end_mile', 6)} AS end_mile FROM posts")
SLICE = ("run_miles", "total_miles", "upstream_mile")
register("e8_slices", lambda w: events.slices(w.labels).select("corridor_id", "analysis_date", "label", "slot", "first_order", *[c.rounded(F.col(x), 6).alias(x) for x in SLICE]), f"SELECT corridor_id, analysis_date, label, slot, first_order, {', '.join(f'{r(x, 6)} AS {x}' for x in SLICE)} FROM slices")
EVENT = "corridor_id, analysis_date, event_id, start_time, end_time, duration_minutes, cell_count, segment_count, first_segment_order, last_segment_order, first_tmc, last_tmc, first_intersection, last_intersection, maximum_contiguous_extent_miles, maximum_total_active_miles, event_area_mile_hours, average_speed_mph, minimum_speed_ratio, average_speed_ratio, average_speed_drop_mph, maximum_speed_drop_mph, corridor_start_mile, corridor_end_mile"
register("e9_events", lambda w: w.events.select(*EVENT.split(", ")), f"SELECT {EVENT} FROM events")


def _resumed(w: Warehouse) -> DataFrame:
    """Events of all days by two runs: one up to the end of January, one for what is missing then."""
    spark = w.segments.sparkSession
    readings, out = scratch_path(spark, "days"), scratch_path(spark, "run")
    sinks.write_partitioned(w.readings.select(*READINGS.split(", ")).withColumn("analysis_date", F.to_date("measurement_tstamp")), readings, "analysis_date")
    run = EventRun(spark, readings, out, w.stage("ordered"), w.stage("definitions"), w.params)
    run.run(until="2024-01-31")
    run.run()
    return run.events(w.events.schema).select(*EVENT.split(", "))


register("d4_resumed_events", _resumed, f"SELECT {EVENT} FROM events")
RETAINED = "corridor_id, analysis_date, event_id, cell_count, duration_minutes, segment_count, maximum_contiguous_extent_miles"
register("e10_retained_events", lambda w: w.events.select(*RETAINED.split(", ")), f"SELECT {RETAINED} FROM events")
register("e11_boundary_speed", lambda w: w.events.select("corridor_id", "analysis_date", "event_id", "estimated_upstream_boundary_speed_mph"), "SELECT corridor_id, analysis_date, event_id, estimated_upstream_boundary_speed_mph FROM events")
register("e12_event_order", lambda w: events.event_order(w.events), """SELECT corridor_id, analysis_date, event_id, CAST(row_number() OVER (PARTITION BY corridor_id, analysis_date ORDER BY event_area_mile_hours DESC, duration_minutes DESC, maximum_contiguous_extent_miles DESC, event_id) AS INTEGER) AS place, event_area_mile_hours, duration_minutes, maximum_contiguous_extent_miles FROM events""")

# --- profile, bottlenecks, characterisation ------------------------------------------------------

DAILY_ALL = "corridor_id, analysis_date, segment_order, tmc, intersection, round(miles, 6) AS miles, observed_intervals, congested_intervals, congested_minutes, round(average_speed_ratio, 6) AS average_speed_ratio, round(congested_average_speed_ratio, 6) AS congested_average_speed_ratio"
register("p1_segment_daily", lambda w: w.daily.withColumns({x: F.round(x, 6) for x in ("miles", "average_speed_ratio", "congested_average_speed_ratio")}), f"SELECT {DAILY_ALL} FROM daily")
register("p2_segment_profile", lambda w: w.profile.withColumn("miles", F.round("miles", 6)), "SELECT * REPLACE (round(miles, 6) AS miles) FROM profile")
register("p3_occurrence_profile", lambda w: profile.occurrence_profile(w.profile), "SELECT corridor_id, segment_order, intersection, weekday_occurrence_pct FROM profile")
register("b1_smoothed_profile", lambda w: bottlenecks.smoothed_profile(w.profile).select("corridor_id", "segment_order", "position", "occurrence", F.round("smoothed", 6).alias("smoothed")), "SELECT corridor_id, segment_order, position, occurrence, round(smoothed, 6) AS smoothed FROM smooth")
register("b2_peaks", lambda w: w.extents.select("corridor_id", "peak_position", c.rounded(F.col("peak_smoothed"), 6).alias("peak_smoothed")), f"SELECT corridor_id, p AS peak_position, {r('v', 6)} AS peak_smoothed FROM peaks")
EXTENT = "corridor_id, peak_position, start_position, end_position"
register("b3_extents", lambda w: w.extents.select(*EXTENT.split(", ")), f"SELECT {EXTENT} FROM extents")


def _cuts(w: Warehouse) -> DataFrame:
    """Each extent between its neighbours' ends."""
    along = Window.partitionBy("corridor_id").orderBy("start_position", "peak_position")
    return w.extents.select("corridor_id", "peak_position", F.lag("end_position").over(along).alias("end_before"), "start_position", "end_position", F.lead("start_position").over(along).alias("start_after"))


register(
    "b4_valley_cuts", _cuts,
    "SELECT corridor_id, peak_position, lag(end_position) OVER w AS end_before, start_position, end_position, lead(start_position) OVER w AS start_after FROM extents WINDOW w AS (PARTITION BY corridor_id ORDER BY start_position, peak_position)",
)
register("b5_bottlenecks", lambda w: w.bottlenecks, "SELECT * FROM bottlenecks")
register("b6_membership", lambda w: w.members, "SELECT bottleneck_id, segment_order FROM members")
register("c1_queue_series", lambda w: w.queues.withColumns({x: F.round(x, 6) for x in ("average_congested_speed_ratio", "minimum_speed_ratio")}), "SELECT * REPLACE (round(average_congested_speed_ratio, 6) AS average_congested_speed_ratio, round(minimum_speed_ratio, 6) AS minimum_speed_ratio) FROM queues")
register("c2_daily_metrics", lambda w: w.metrics.drop("queue_growth_rate_mph", "queue_dissipation_rate_mph"), "SELECT * EXCLUDE (queue_growth_rate_mph, queue_dissipation_rate_mph) FROM metrics")
register("c3_queue_rates", lambda w: w.metrics.where("occurrence").select("bottleneck_id", "analysis_date", "queue_growth_rate_mph", "queue_dissipation_rate_mph"), "SELECT bottleneck_id, analysis_date, queue_growth_rate_mph, queue_dissipation_rate_mph FROM metrics WHERE occurrence")
register("c4_occurrence_details", lambda w: characterise.occurrence_details(w.metrics, w.stage("bottlenecks")), "SELECT b.corridor_id, m.bottleneck_id, b.representative_intersection, analysis_date, onset_time, peak_time, clearance_time, active_congestion_minutes, maximum_queue_miles, queue_mile_hours, m.average_congested_speed_ratio FROM metrics AS m JOIN bottlenecks AS b ON b.bottleneck_id = m.bottleneck_id WHERE occurrence")

# --- rankings ------------------------------------------------------------------------------------

register("k1_annual_dashboard", lambda w: w.annual, "SELECT * FROM annual")
register("k2_ranked_dashboard", lambda w: w.ranked, "SELECT * FROM ranked")
PERIOD = f"""{o.SHARES}, {r("avg(active_congestion_minutes) FILTER (occurrence)", 1)} AS avg_active_minutes, {r("avg(maximum_queue_miles) FILTER (occurrence)", 2)} AS avg_max_queue_miles, {r("sum(queue_mile_hours)", 2)} AS queue_mile_hours"""
JOINED = "FROM metrics AS m JOIN bottlenecks AS b ON b.bottleneck_id = m.bottleneck_id"
OWN = "m.bottleneck_id, corridor, direction, representative_intersection"
register("k3_monthly_dashboard", lambda w: ranking.monthly_dashboard(w.stage("bottlenecks"), w.metrics), f"SELECT {OWN}, CAST(date_trunc('month', analysis_date) AS DATE) AS month, {PERIOD}, {r('max(maximum_queue_miles)', 2)} AS max_queue_miles, {r('avg(m.average_congested_speed_ratio) FILTER (occurrence)', 3)} AS avg_congested_speed_ratio {JOINED} GROUP BY {OWN}, date_trunc('month', analysis_date)")
register("k4_weekday_dashboard", lambda w: ranking.weekday_dashboard(w.stage("bottlenecks"), w.metrics), f"SELECT {OWN}, CAST(isodow(analysis_date) AS INTEGER) AS weekday_number, strftime(analysis_date, '%a') AS weekday_name, {PERIOD} {JOINED} GROUP BY {OWN}, isodow(analysis_date), strftime(analysis_date, '%a')")
register("k5_region_monthly", lambda w: region.by_month(w.events), "SELECT * FROM months")
register("k5_region_weekday", lambda w: region.by_weekday(w.events), "SELECT * FROM weekdays")
register("k6_region_hourly", lambda w: region.by_hour(w.events), "SELECT * FROM hours")
register("k7_region_county", lambda w: region.by_county(w.events, w.segments), "SELECT * FROM counties")
register("k7_top_counties", lambda w: region.top_counties(region.by_county(w.events, w.segments)), "SELECT * FROM counties WHERE county <> 'UNKNOWN' ORDER BY total_mile_hours DESC, county LIMIT 15")
register(
    "k8_worst_day", lambda w: region.worst_day_summary(region.worst_day(w.events), w.stage("metrics"), w.ranked, w.segments, w.districts),
    """SELECT w.analysis_date, w.total_mile_hours, b.bottleneck_id, b.queue_mile_hours AS day_queue_mile_hours, b.active_congestion_minutes, b.corridor_name, b.direction, b.representative_intersection, b.peak_segment_aadt, b.aadt_weighted_severity_index, t.county, c.cid_name FROM worst AS w
    LEFT JOIN (SELECT m.queue_mile_hours, m.active_congestion_minutes, k.* FROM metrics AS m JOIN ranked AS k ON k.bottleneck_id = m.bottleneck_id WHERE m.occurrence AND k.ranking_eligible AND m.analysis_date = (SELECT analysis_date FROM worst) ORDER BY m.queue_mile_hours DESC, k.bottleneck_id LIMIT 1) AS b ON true
    LEFT JOIN tmc AS t ON t.tmc = b.peak_tmc LEFT JOIN districts AS c ON c.tmc = b.peak_tmc""",
)
register("k9_worst_day_bottlenecks", lambda w: region.worst_day_bottlenecks(region.worst_day(w.events), w.stage("metrics"), w.ranked), "SELECT DISTINCT m.bottleneck_id FROM metrics AS m JOIN ranked AS k ON k.bottleneck_id = m.bottleneck_id WHERE m.occurrence AND k.ranking_eligible AND m.analysis_date = (SELECT analysis_date FROM worst)")
register("k10_worst_day_hours", lambda w: region.worst_day_hours(region.worst_day(w.stage("events")), w.stage("events")), f"SELECT CAST(hour(hour_start) AS INTEGER) AS hour_of_day, {r('sum(event_area_mile_hours * overlap_minutes / nullif(duration_minutes, 0))', 2)} AS total_mile_hours FROM hour_parts WHERE overlap_minutes > 0 AND analysis_date = (SELECT analysis_date FROM worst) GROUP BY ALL")
register(
    "k11_peak_labels", lambda w: region.peaks_of(region.by_month(w.stage("events")), region.by_weekday(w.stage("events")), region.by_hour(w.stage("events"))),
    """(SELECT 'month' AS kpi, strftime(month, '%B') AS label, total_mile_hours AS value FROM months ORDER BY total_mile_hours DESC, month LIMIT 1) UNION ALL (SELECT 'weekday', weekday_name, total_mile_hours FROM weekdays ORDER BY total_mile_hours DESC, weekday_number LIMIT 1)
    UNION ALL (SELECT 'hour', CAST(hour_of_day AS VARCHAR), total_mile_hours FROM hours ORDER BY total_mile_hours DESC, hour_of_day LIMIT 1)""",
)
PEAK_HOT = f"(SELECT bottleneck_id, {o.HOUR_DOW} FROM probe JOIN (SELECT bottleneck_id, peak_tmc FROM ranked WHERE ranking_eligible) ON peak_tmc = tmc_code WHERE {HOT})"
SPAN_HOT = f"(SELECT bottleneck_id, {o.HOUR_DOW} FROM probe JOIN within_extent ON tmc = tmc_code WHERE {HOT})"
LABELS = f"{clock('p.peak_hour')} AS peak_hour_label, {weekday('p.peak_dow')} AS peak_weekday_name"
register(
    "k12_regional_ranking", lambda w: ranking.regional_ranking(w.stage("ranked"), w.segments, w.districts, w.readings),
    f"""SELECT network_severity_rank, k.bottleneck_id, corridor_name, corridor_group, corridor AS road, k.direction, representative_intersection, occurrence_pct, annual_queue_mile_hours, avg_congested_speed_ratio, severity_index, aadt_weighted_severity_index, analyzed_days, t.county, c.cid_name, peak_segment_aadt AS aadt, peak_tmc AS tmc, {LABELS}
    FROM ranked AS k LEFT JOIN tmc AS t ON t.tmc = peak_tmc LEFT JOIN districts AS c ON c.tmc = peak_tmc LEFT JOIN ({o._picks(PEAK_HOT, "bottleneck_id")}) AS p ON p.bottleneck_id = k.bottleneck_id WHERE k.ranking_eligible""",
)
register(
    "k13_corridor_ranking", lambda w: ranking.corridor_ranking(w.stage("ranked"), w.segments, w.ordered, w.readings),
    f"""SELECT k.corridor_id, corridor_severity_rank AS severity_rank, k.bottleneck_id, representative_intersection, occurrence_pct, annual_queue_mile_hours, avg_congested_speed_ratio, severity_index, t.county, peak_segment_aadt AS aadt, {LABELS}
    FROM ranked AS k LEFT JOIN tmc AS t ON t.tmc = peak_tmc LEFT JOIN ({o._picks(SPAN_HOT, "bottleneck_id")}) AS p ON p.bottleneck_id = k.bottleneck_id""",
)
register(
    "k14_report_ranking", lambda w: ranking.report_ranking(w.ranked, observations.extent_reference_speed(w.stage("bottlenecks"), w.ordered, w.readings)),
    f"""SELECT corridor_id, corridor_severity_rank, k.bottleneck_id, representative_intersection, analyzed_days, occurrence_days, occurrence_pct, avg_active_minutes, median_active_minutes, p95_active_minutes, avg_max_queue_miles, annual_max_queue_miles, annual_queue_mile_hours, avg_congested_speed_ratio, severity_index,
    {r("avg_congested_speed_ratio * f.speed", 1)} AS approximate_speed_mph FROM ranked AS k LEFT JOIN (SELECT bottleneck_id, {r("avg(reference_speed)", 3)} AS speed FROM probe JOIN within_extent ON tmc = tmc_code GROUP BY bottleneck_id) AS f ON f.bottleneck_id = k.bottleneck_id""",
)
ELIGIBLE = "corridor_group = 'Arterial' AND ranking_eligible AND representative_intersection IS NOT NULL"
register(
    "k15_intersection_index", lambda w: ranking.intersection_index(w.stage("ranked"), w.ordered, w.segments, w.districts),
    f"""SELECT g.*, t.county, c.cid_name, round((t.start_latitude + t.end_latitude) / 2.0, 6) AS latitude, round((t.start_longitude + t.end_longitude) / 2.0, 6) AS longitude, CAST(rank() OVER (ORDER BY aadt_weighted_intersection_severity_index DESC NULLS FIRST) AS INTEGER) AS intersection_severity_rank FROM
    (SELECT representative_intersection, count(*) AS contributing_bottlenecks, string_agg(DISTINCT corridor || ' ' || {o.title("direction")}, ', ' ORDER BY corridor || ' ' || {o.title("direction")}) AS corridors, {r("sum(severity_index)", 2)} AS intersection_severity_index, {r("sum(aadt_weighted_severity_index)", 2)} AS aadt_weighted_intersection_severity_index,
    {r("avg(occurrence_pct)", 1)} AS avg_occurrence_pct, {r("sum(annual_queue_mile_hours)", 2)} AS total_annual_queue_mile_hours, {r("avg(avg_congested_speed_ratio)", 3)} AS avg_congested_speed_ratio, max(peak_segment_aadt) AS max_contributing_aadt FROM ranked WHERE {ELIGIBLE} GROUP BY representative_intersection) AS g
    JOIN (SELECT representative_intersection, peak_tmc FROM ranked WHERE {ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY representative_intersection ORDER BY aadt_weighted_severity_index DESC NULLS FIRST, bottleneck_id) = 1) AS f ON f.representative_intersection = g.representative_intersection
    JOIN tmc AS t ON t.tmc = f.peak_tmc LEFT JOIN districts AS c ON c.tmc = f.peak_tmc""",
)
register("k16_watch_metrics", lambda w: w.watch, "SELECT * FROM watch_metrics")
register("k17_severity_bins", lambda w: w.profile.select("corridor_id", "segment_order", c.severity_bin(F.col("weekday_occurrence_pct")).alias("severity_bin")), "SELECT corridor_id, segment_order, CAST(CASE WHEN weekday_occurrence_pct IS NULL THEN -1 WHEN weekday_occurrence_pct < 0 OR weekday_occurrence_pct >= 80 THEN 4 ELSE floor(weekday_occurrence_pct / 20) END AS INTEGER) AS severity_bin FROM profile")
register(
    "k18_severity_classes", lambda w: classify.severity_classes(w.ranked.where("ranking_eligible").select("bottleneck_id", "aadt_weighted_severity_index"), "aadt_weighted_severity_index"),
    "SELECT e.bottleneck_id, e.aadt_weighted_severity_index, c.class_rank, c.class_label FROM eligible AS e JOIN bottleneck_classes AS c ON c.u = round(aadt_weighted_severity_index * 1000)",
)


def _mapped(w: Warehouse) -> DataFrame:
    """A row for each segment of each ranked bottleneck, with its worst day."""
    return ranking.map_segments(w.stage("bottlenecks"), w.members, w.ranked, w.stage("ordered"), w.stage("metrics"))


def _map_records(w: Warehouse) -> DataFrame:
    found = classify.map_records(_mapped(w), w.segments, fixtures.vertex_table(w.segments))
    lines = F.transform("points", lambda p: F.struct(F.round(p["lat"], 6).alias("lat"), F.round(p["lon"], 6).alias("lon")))
    return found.withColumn("points", F.to_json(lines))


register(
    "k19_map_records", _map_records,
    "SELECT m.bottleneck_id, m.corridor_id, m.segment_order, m.tmc, m.name, m.severity, c.class_rank, c.class_label, m.width, m.worst_date_label, m.worst_time_label, l.points FROM mapped AS m JOIN map_classes AS c ON c.u = round(severity * 1000) JOIN shifted AS l ON l.tmc = m.tmc",
)
register(
    "k19_map_segments",
    lambda w: _mapped(w).select("bottleneck_id", "corridor_id", "corridor_group", "corridor_name", "segment_order", "tmc", "severity", "worst_date", "worst_time", "width", c.display_name("road", "direction").alias("name"), c.long_date_label(F.col("worst_date")).alias("worst_date_label"), c.short_clock_label(F.col("worst_time")).alias("worst_time_label")),
    "SELECT * FROM mapped",
)
BIN = "CAST(CASE WHEN severity_pct IS NULL THEN -1 WHEN severity_pct < 0 OR severity_pct >= 80 THEN 4 ELSE floor(severity_pct / 20) END AS INTEGER) AS severity_bin"
register(
    "k20_network_map", lambda w: ranking.network_map(w.definitions, w.ordered, w.profile, w.watched, w.watch, w.segments).select("layer", "road_class", "name", "tmc", "severity_pct", "severity_bin"),
    f"""SELECT *, {BIN} FROM (SELECT 'corridor' AS layer, d.corridor_group AS road_class, d.corridor_name AS name, s.tmc, p.weekday_occurrence_pct AS severity_pct FROM segs AS s JOIN registry AS d ON d.corridor_id = s.corridor_id LEFT JOIN profile AS p ON p.corridor_id = s.corridor_id AND p.segment_order = s.segment_order WHERE d.is_active
    UNION ALL SELECT 'watch', w.road_class, w.road || ' ' || w.direction, w.tmc, m.occurrence_pct FROM watch AS w LEFT JOIN watch_metrics AS m ON m.tmc = w.tmc)""",
)

# --- intersections -------------------------------------------------------------------------------

FILLED = "tmc, road, direction, county, intersection, road_order, aadt_filled, f_system_filled"
register("i1_backfill", lambda w: w.filled.select(*FILLED.split(", ")), f"SELECT {FILLED} FROM filled")
register("i2_named_roads", lambda w: intersections.named_segments(w.filled, fixtures.named_road_table(w.segments)).select("tmc", "arterial_name"), "SELECT tmc, arterial_name FROM named")
register("i3_corridor_arterials", lambda w: intersections.corridor_arterials(w.filled, w.definitions, w.ordered).select("tmc", "arterial_name"), "SELECT tmc, arterial_name FROM existing")
register("i4_combined", lambda w: w.chosen.select("tmc", "arterial_name"), "SELECT tmc, arterial_name FROM chosen")
register("i5_hourly_speeds", lambda w: w.hourly.select("tmc_code", "day", "hour", "dow", F.round("avg_speed", 6).alias("avg_speed")), "SELECT tmc_code, day, hour, dow, round(avg_speed, 6) AS avg_speed FROM hourly")
register("i6_occurrence", lambda w: intersections.occurrence(w.day_speeds), "SELECT * FROM occurrences")
register("i7_queue_hours", lambda w: intersections.queue_hours(w.flagged), "SELECT * FROM queue_hours")
register("i8_picks", lambda w: intersections.picks(w.stage("flagged")), "SELECT * FROM picks")
register("i9_characterization", lambda w: intersections.characterisation(w.day_speeds, w.stage("flagged")), "SELECT * FROM character")
CAND = "tmc, arterial_name, speed_drop_ratio, occurrence_pct, annual_queue_mile_hours, max_queue_mile_hours, analyzed_days, aadt_filled, f_system_filled"
register("i10_candidates", lambda w: w.candidates.select(*CAND.split(", ")), f"SELECT {CAND} FROM candidates")
GROUP = "arterial_name, direction, intersection, speed_drop_ratio, occurrence_pct, aadt, county, tmc, analyzed_days, annual_queue_mile_hours, max_queue_mile_hours, peak_hour, onset_hour, busiest_dow, busiest_date, busiest_hour, min_speed"
register("i11_grouped", lambda w: intersections.grouped(w.candidates).select(*GROUP.split(", ")), f"SELECT {GROUP} FROM grouped")
register("i12_severity", lambda w: w.severity.select("arterial_name", "direction", "intersection", "severity_index"), "SELECT arterial_name, direction, intersection, severity_index FROM severity")
CLASSED = "arterial_name, direction, intersection, severity_index, class_score, class_rank, tier"


def _tiers(w: Warehouse) -> DataFrame:
    return classify.multi_feature_classes(w.severity)


def _shown(classed: DataFrame) -> DataFrame:
    return classed.select(*CLASSED.split(", ")).withColumn("class_score", F.round("class_score", 6))


SHOWN = CLASSED.replace("class_score", "round(class_score, 6) AS class_score")
register("i13_severity_tiers", lambda w: _shown(_tiers(w)), f"SELECT {SHOWN} FROM tiers")
register("i14_top_intersections", lambda w: _shown(classify.top_intersections(_tiers(w))), f"SELECT {SHOWN} FROM top_tiers")
register("i15_display_tiers", lambda w: _shown(classify.reclassified(classify.top_intersections(_tiers(w)))), f"SELECT {SHOWN} FROM display_tiers")

# --- places --------------------------------------------------------------------------------------

register("g1_midpoints", lambda w: geo.midpoints(w.ordered, w.watched, w.segments).select("tmc", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")), "SELECT tmc, round(lat, 6) AS lat, round(lon, 6) AS lon FROM points")
register("g2_districts", lambda w: w.districts, "SELECT tmc, cid_name FROM districts")
register("g3_offset_lines", lambda w: geo.exploded(geo.offset(geo.polylines(w.segments, fixtures.vertex_table(w.segments)))), "SELECT l.tmc, i, round(lat + up, 9) AS lat, round(lon + east, 9) AS lon FROM lines AS l JOIN shifts AS s ON s.tmc = l.tmc")
register("g4_polylines", lambda w: geo.exploded(geo.polylines(w.segments, fixtures.vertex_table(w.segments))), "SELECT tmc, i, round(lat, 9) AS lat, round(lon, 9) AS lon FROM lines")
register("g5_encoded", lambda w: geo.encode(fixtures.vertex_table(w.segments)), "SELECT tmc, i, dx, dy FROM deltas")
register("g6_decoded", lambda w: geo.decode(geo.arcs(geo.encode(fixtures.vertex_table(w.segments)))).select("tmc", "i", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")), "SELECT tmc, i, round(round_even(lon * 1e6, 0) / 1e6, 6) AS lon, round(round_even(lat * 1e6, 0) / 1e6, 6) AS lat FROM vertices")


def _rings(w: Warehouse) -> DataFrame:
    """The rings' vertices as read back from their stored text."""
    rows = geo.ring_table(w.polygons).select("name", "n_points", F.posexplode(F.from_json("ring", "array<array<double>>")).alias("i", "p"))
    return rows.select("name", "n_points", "i", F.round(F.col("p")[0], 6).alias("lat"), F.round(F.col("p")[1], 6).alias("lon"))


register("g7_rings", _rings, "SELECT name, CAST(count(*) OVER (PARTITION BY file_order, name) AS INTEGER) AS n_points, i, round(y, 6) AS lat, round(x, 6) AS lon FROM polygons WHERE ring = 0")
