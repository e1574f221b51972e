"""The road network: corridor registry, ordered segments, splits, watch list, inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import slug, title
from ..params import DEFAULT, Params

INTERSTATE = r"^I-[0-9]+(/I-[0-9]+)?$"
#: Roads with a display name of their own.
ROAD_NAMES = {"I-75/I-85": "Downtown Connector"}


def _pairs(segments: DataFrame, which: Column, group: str, params: Params) -> DataFrame:
    named = segments.where(which & F.col("direction").isNotNull() & (F.trim("direction") != ""))
    found = named.groupBy("road", "direction").agg(F.count(F.lit(1)).cast("int").alias("segment_count"), F.max("aadt").alias("peak_aadt"))
    shown = F.col("road")
    for road, name in ROAD_NAMES.items():
        shown = F.when(F.col("road") == road, F.lit(name)).otherwise(shown)
    return found.where(F.col("segment_count") >= params.corridor_segments).select(
        "road", "direction", F.concat_ws(" ", shown if group == "Interstate" else F.col("road"), title(F.col("direction"))).alias("corridor_name"), F.lit(group).alias("corridor_group"), "segment_count", "peak_aadt"
    )


def interstates(segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Road and direction pairs whose road is an Interstate by name, with at least three segments."""
    return _pairs(segments, F.col("road").rlike(INTERSTATE), "Interstate", params)


def arterials(segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The pairs of classes 3 and 4 with the most traffic; ties by road, then direction."""
    found = _pairs(segments, F.col("f_system").isin(3, 4), "Arterial", params)
    return found.orderBy(F.col("peak_aadt").desc_nulls_last(), "road", "direction").limit(params.arterial_corridors)


def expressways(segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """All pairs of class 2."""
    return _pairs(segments, F.col("f_system") == 2, "Expressway", params)


def registry(segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Corridor definitions: of pairs in several groups the later group's row wins.

    The groups come in the order Interstate, Arterial, Expressway; ids follow group, road and
    direction.
    """
    groups = [f(segments, params).withColumn("priority", F.lit(n)) for n, f in enumerate((interstates, arterials, expressways))]
    every = groups[0].unionByName(groups[1]).unionByName(groups[2])
    last = every.groupBy("road", "direction").agg(F.max_by(F.struct("corridor_name", "corridor_group", "priority"), "priority").alias("d")).select("road", "direction", "d.*")
    numbered = last.withColumn("corridor_id", F.row_number().over(Window.orderBy("priority", "road", "direction")))
    rural = segments.where("urban_code IS NULL").select("road", "direction").distinct()
    marked = numbered.join(rural.withColumn("rural", F.lit(True)), ["road", "direction"], "left")
    return marked.select(
        "corridor_id", "road", "direction", "corridor_name", "corridor_group", F.lit(True).alias("is_active"),
        (~((F.col("corridor_group") == "Arterial") & F.coalesce("rural", F.lit(False)))).alias("ranking_eligible"),
        F.col("road").alias("source_road"), F.lit(None).cast("double").alias("segment_order_start"), F.lit(None).cast("double").alias("segment_order_end"),
    )


def deactivate_stale(definitions: DataFrame, segments: DataFrame, group: str, params: Params = DEFAULT) -> DataFrame:
    """``definitions`` with the group's pairs inactive that have too few segments of its classes left."""
    classes = {"Arterial": (3, 4), "Expressway": (2,)}[group]
    alive = segments.where(F.col("f_system").isin(*classes)).groupBy("road", "direction").count().where(F.col("count") >= params.corridor_segments).select("road", "direction", F.lit(True).alias("alive"))
    marked = definitions.join(alive, ["road", "direction"], "left")
    return marked.withColumn("is_active", F.col("is_active") & ((F.col("corridor_group") != group) | F.coalesce("alive", F.lit(False)))).select(*definitions.columns)


def corridor_segments(definitions: DataFrame, segments: DataFrame) -> DataFrame:
    """Active corridors' segments in road order, numbered from 1; bounds on road order are optional."""
    d = definitions.where("is_active").select("corridor_id", "corridor_name", "source_road", F.col("direction").alias("d"), "segment_order_start", "segment_order_end")
    bounded = (
        (F.col("road") == F.col("source_road")) & (F.col("direction") == F.col("d"))
        & (F.col("segment_order_start").isNull() | (F.col("road_order") >= F.col("segment_order_start")))
        & (F.col("segment_order_end").isNull() | (F.col("road_order") <= F.col("segment_order_end")))
    )
    order = Window.partitionBy("corridor_id").orderBy("road_order", "tmc")
    return segments.join(d, bounded).select(
        "corridor_id", "corridor_name", F.row_number().over(order).alias("segment_order"), "tmc", "road", "direction", "intersection", "miles", "road_order",
        "start_latitude", "start_longitude", "end_latitude", "end_longitude",
    )


def split_plan(definitions: DataFrame, segments: DataFrame, least: int = 3) -> DataFrame:
    """Runs of one class bucket along active Expressway corridors that mix buckets.

    Classes 1 and 2 are Expressway, 3 and 4 Arterial; other classes break runs and have none. Runs
    shorter than ``least`` go; a corridor with at most one run left is not split.
    """
    own = definitions.where("is_active AND corridor_group = 'Expressway'").select("corridor_id", "road", "direction")
    bucket = F.when(F.col("f_system").isin(1, 2), "Expressway").when(F.col("f_system").isin(3, 4), "Arterial")
    along = Window.partitionBy("corridor_id").orderBy("road_order", "tmc")
    rows = segments.join(own, ["road", "direction"]).withColumn("bucket", bucket).withColumn("n", F.row_number().over(along))
    fresh = (~F.lag("bucket").over(along).eqNullSafe(F.col("bucket")) | (F.col("n") == 1)).cast("int")
    runs = rows.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    kept = (
        runs.groupBy("corridor_id", "road", "direction", "run", "bucket")
        .agg(
            F.min_by("road_order", "n").alias("start_order"), F.max_by("road_order", "n").alias("end_order"), F.count(F.lit(1)).cast("int").alias("segment_count"),
            F.min_by("intersection", "n").alias("from_intersection"), F.max_by("intersection", "n").alias("to_intersection"),
        ).where(F.col("bucket").isNotNull() & (F.col("segment_count") >= least))
    )
    per = Window.partitionBy("corridor_id")
    mixed = kept.withColumn("runs", F.count(F.lit(1)).over(per)).where("runs > 1")
    return mixed.withColumn("run_number", F.row_number().over(per.orderBy("run"))).select("corridor_id", "road", "direction", "run_number", "bucket", "start_order", "end_order", "segment_count", "from_intersection", "to_intersection")


def apply_split(definitions: DataFrame, plan: DataFrame) -> DataFrame:
    """``definitions`` with split corridors inactive and a child for each run, ids following on."""
    gone = plan.select(F.col("corridor_id").alias("split_id")).distinct()
    old = definitions.join(gone, F.col("corridor_id") == F.col("split_id"), "left").withColumn("is_active", F.col("is_active") & F.col("split_id").isNull()).select(*definitions.columns)
    top = definitions.agg(F.max("corridor_id").alias("top"))
    number = F.row_number().over(Window.orderBy("road", "direction", "run_number"))
    children = plan.withColumn("number", number).crossJoin(top).select(
        (F.col("top") + F.col("number")).cast("int").alias("corridor_id"), F.concat_ws("-", "road", F.col("run_number").cast("string")).alias("child"), "direction",
        F.concat(F.col("road"), F.lit(" "), title(F.col("direction")), F.lit(" ("), F.coalesce("from_intersection", F.lit("")), F.lit(" to "), F.coalesce("to_intersection", F.lit("")), F.lit(")")).alias("corridor_name"),
        F.col("bucket").alias("corridor_group"), F.lit(True).alias("is_active"), F.lit(True).alias("ranking_eligible"), F.col("road").alias("source_road"),
        F.col("start_order").alias("segment_order_start"), F.col("end_order").alias("segment_order_end"),
    ).withColumnRenamed("child", "road")
    return old.unionByName(children.select(*definitions.columns))


def watch_list(segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The collector and local segments with the most traffic, ranked in their class; ties by tmc."""
    road_class = F.when(F.col("f_system").isin(5, 6), "Collector").when(F.col("f_system") == 7, "Local")
    rank = F.row_number().over(Window.partitionBy("road_class").orderBy(F.col("aadt").desc(), "tmc"))
    limit = F.when(F.col("road_class") == "Collector", params.watch_collector).otherwise(params.watch_local)
    rows = segments.withColumn("road_class", road_class).where("road_class IS NOT NULL AND aadt IS NOT NULL").withColumn("rank_in_class", rank)
    return rows.where(F.col("rank_in_class") <= limit).select("tmc", "road", "direction", "intersection", "county", "f_system", "road_class", "aadt", "miles", "rank_in_class")


def next_intersections(watched: DataFrame, segments: DataFrame) -> DataFrame:
    """``watched`` with to_intersection: that of the next segment further along the same road.

    Segments at the same road order are not further along; of several next ones the smallest tmc.
    """
    place = segments.select("tmc", "road_order")
    after = segments.select(F.col("road").alias("r"), F.col("direction").alias("d"), F.col("road_order").alias("o"), F.col("tmc").alias("t"), F.col("intersection").alias("to_intersection"))
    here = watched.join(place, "tmc")
    further = here.join(after, (F.col("road") == F.col("r")) & (F.col("direction") == F.col("d")) & (F.col("o") > F.col("road_order")))
    nearest = further.groupBy("tmc").agg(F.min_by("to_intersection", F.struct("o", "t")).alias("to_intersection"))
    return watched.withColumnRenamed("intersection", "from_intersection").join(nearest, "tmc", "left")


def active_corridors(definitions: DataFrame, only: tuple[str, str] | None = None, group: str | None = None) -> DataFrame:
    """Active corridors with their slug: all of them, one (road, direction) pair, or one group."""
    found = definitions.where("is_active")
    if only:
        found = found.where((F.col("road") == only[0]) & (F.col("direction") == only[1]))
    if group:
        found = found.where(F.col("corridor_group") == group)
    return found.select("corridor_id", "road", "direction", "corridor_name", "corridor_group", slug("road", "direction").alias("slug"))


def corridor(definitions: DataFrame, road: str, direction: str) -> Row:
    """The one corridor of a (road, direction) pair, active or not; raises LookupError without one."""
    rows = definitions.where((F.col("road") == road) & (F.col("direction") == direction))
    found = rows.select("corridor_id", "road", "direction", "corridor_name", "corridor_group", slug("road", "direction").alias("slug")).orderBy("corridor_id").first()
    if found is None:
        raise LookupError(f"no corridor on {road} {direction}")
    return found


def corridor_extent(ordered: DataFrame) -> DataFrame:
    """First and last intersection of each corridor."""
    return ordered.groupBy("corridor_id").agg(F.min_by("intersection", "segment_order").alias("from_intersection"), F.max_by("intersection", "segment_order").alias("to_intersection"))


def corridor_summary(definitions: DataFrame, ordered: DataFrame, daily: DataFrame, events: DataFrame) -> DataFrame:
    """Segments, miles, analysed days and events of each active corridor."""
    length = ordered.groupBy("corridor_id").agg(F.countDistinct("tmc").alias("tmcs"), F.round(F.sum("miles") + 1e-9, 2).alias("miles"))
    days = daily.groupBy("corridor_id").agg(F.countDistinct("analysis_date").alias("analyzed_days"))
    found = events.groupBy("corridor_id").agg(F.count(F.lit(1)).alias("events"))
    zero = F.lit(0).cast("long")
    return (
        definitions.where("is_active").select("corridor_id", "corridor_name").join(length, "corridor_id", "left").join(days, "corridor_id", "left").join(found, "corridor_id", "left")
        .select("corridor_id", "corridor_name", F.coalesce("tmcs", zero).alias("tmcs"), "miles", F.coalesce("analyzed_days", zero).alias("analyzed_days"), F.coalesce("events", zero).alias("events"))
    )


def inventory(definitions: DataFrame, ordered: DataFrame, watched: DataFrame) -> DataFrame:
    """Checks after a rebuild: kind, name, n and miles of corridors, groups and watch classes."""
    rows = definitions.select("corridor_id", "corridor_name").join(ordered.select(F.col("corridor_id").alias("c"), "miles"), F.col("corridor_id") == F.col("c"), "left")
    corridors = rows.groupBy("corridor_id", "corridor_name").agg(F.count("c").alias("n"), F.round(F.sum("miles") + 1e-9, 2).alias("miles")).select(F.lit("corridor").alias("kind"), F.col("corridor_name").alias("name"), "n", "miles")
    groups = definitions.where("is_active").groupBy("corridor_group").count().select(F.lit("group").alias("kind"), F.col("corridor_group").alias("name"), F.col("count").alias("n"), F.lit(None).cast("double").alias("miles"))
    classes = watched.groupBy("road_class").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("miles") + 1e-9, 2).alias("miles")).select(F.lit("watch").alias("kind"), F.col("road_class").alias("name"), "n", "miles")
    return corridors.unionByName(groups).unionByName(classes)
