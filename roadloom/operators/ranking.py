"""Bottleneck dashboards and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import clock_label, congested, iso_weekday, ratio, rounded, title, weekday_name
from ..params import DEFAULT, Params
from .observations import bottleneck_segments


def _on(x: str) -> Column:
    return F.when(F.col("occurrence"), F.col(x))


def _shares() -> list[Column]:
    return [F.count(F.lit(1)).alias("analyzed_days"), F.count_if("occurrence").alias("occurrence_days"), rounded(100.0 * F.count_if("occurrence") / F.count(F.lit(1)), 1).alias("occurrence_pct")]


def annual_dashboard(bottlenecks: DataFrame, metrics: DataFrame) -> DataFrame:
    """Each bottleneck over all its days; averages and exact percentiles over occurrence days."""
    b = bottlenecks.select("bottleneck_id", "corridor_id", "corridor", "direction", "peak_segment_order", "start_segment_order", "end_segment_order", "representative_intersection")
    return metrics.join(b, "bottleneck_id").groupBy(*b.columns).agg(
        *_shares(), rounded(F.avg(_on("active_congestion_minutes")), 1).alias("avg_active_minutes"),
        rounded(F.percentile(_on("active_congestion_minutes"), 0.5), 1).alias("median_active_minutes"), rounded(F.percentile(_on("active_congestion_minutes"), 0.95), 1).alias("p95_active_minutes"),
        rounded(F.avg(_on("maximum_queue_miles")), 2).alias("avg_max_queue_miles"), rounded(F.percentile(_on("maximum_queue_miles"), 0.95), 2).alias("p95_max_queue_miles"),
        rounded(F.max("maximum_queue_miles"), 2).alias("annual_max_queue_miles"), rounded(F.sum("queue_mile_hours"), 2).alias("annual_queue_mile_hours"),
        rounded(F.avg(_on("average_congested_speed_ratio")), 3).alias("avg_congested_speed_ratio"),
        rounded(F.avg(_on("queue_growth_rate_mph")), 2).alias("avg_queue_growth_rate_mph"), rounded(F.avg(_on("queue_dissipation_rate_mph")), 2).alias("avg_queue_dissipation_rate_mph"),
    )


def ranked_dashboard(annual: DataFrame, definitions: DataFrame, eligibility: DataFrame, ordered: DataFrame, segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The annual rows of active corridors with severity, plain and by traffic, and ranks.

    Severity comes from the rounded annual columns. A null severity ranks first. The network rank
    is among eligible rows alone and null for others; a bottleneck that the overnight test hasn't
    seen is eligible as far as its corridor is.
    """
    d = definitions.where("is_active").select("corridor_id", "corridor_group", "corridor_name", F.col("ranking_eligible").alias("corridor_ranking_eligible"))
    e = eligibility.select("bottleneck_id", F.col("ranking_eligible").alias("own"), "overnight_congested_pct")
    peak = ordered.select("corridor_id", F.col("segment_order").alias("peak_segment_order"), F.col("tmc").alias("peak_tmc")).join(segments.select(F.col("tmc").alias("peak_tmc"), F.col("aadt").alias("peak_segment_aadt")), "peak_tmc")
    rows = annual.join(d, "corridor_id").join(e, "bottleneck_id", "left").join(peak, ["corridor_id", "peak_segment_order"], "left")
    plain = F.col("annual_queue_mile_hours") * F.col("occurrence_pct") / 100.0 * (1.0 - F.col("avg_congested_speed_ratio"))
    rows = rows.withColumns({"bottleneck_ranking_eligible": F.coalesce("own", F.lit(True)), "plain": plain})
    # ranks compare what is equal for either order of the arithmetic
    rows = rows.withColumns({"ranking_eligible": F.col("corridor_ranking_eligible") & F.col("bottleneck_ranking_eligible"), "plain": F.round("plain", 9), "weighted": F.round(F.col("plain") * F.coalesce("peak_segment_aadt", F.lit(params.aadt_norm)) / params.aadt_norm, 9)})
    network = F.rank().over(Window.partitionBy("ranking_eligible").orderBy(F.desc_nulls_first("weighted")))
    return rows.select(
        *annual.columns, "corridor_name", "corridor_group", "peak_tmc", "corridor_ranking_eligible", "bottleneck_ranking_eligible", "ranking_eligible", "overnight_congested_pct", "peak_segment_aadt",
        rounded(F.col("plain"), 2).alias("severity_index"), rounded(F.col("weighted"), 2).alias("aadt_weighted_severity_index"),
        F.rank().over(Window.partitionBy("corridor", "direction").orderBy(F.desc_nulls_first("plain"))).alias("corridor_severity_rank"),
        F.when(F.col("ranking_eligible"), network).alias("network_severity_rank"),
    )


def _by_period(bottlenecks: DataFrame, metrics: DataFrame, *period: Column) -> DataFrame:
    b = bottlenecks.select("bottleneck_id", "corridor", "direction", "representative_intersection")
    rows = metrics.join(b, "bottleneck_id").groupBy(*b.columns, *period)
    return rows.agg(
        *_shares(), rounded(F.avg(_on("active_congestion_minutes")), 1).alias("avg_active_minutes"), rounded(F.avg(_on("maximum_queue_miles")), 2).alias("avg_max_queue_miles"),
        rounded(F.max("maximum_queue_miles"), 2).alias("max_queue_miles"), rounded(F.sum("queue_mile_hours"), 2).alias("queue_mile_hours"),
        rounded(F.avg(_on("average_congested_speed_ratio")), 3).alias("avg_congested_speed_ratio"),
    )


def monthly_dashboard(bottlenecks: DataFrame, metrics: DataFrame) -> DataFrame:
    return _by_period(bottlenecks, metrics, F.trunc("analysis_date", "month").alias("month"))


def weekday_dashboard(bottlenecks: DataFrame, metrics: DataFrame) -> DataFrame:
    day = F.col("analysis_date")
    found = _by_period(bottlenecks, metrics, iso_weekday(day).alias("weekday_number"), F.date_format(day, "E").alias("weekday_name"))
    return found.drop("max_queue_miles", "avg_congested_speed_ratio")


def _picks(hot: DataFrame, key: str) -> DataFrame:
    """(key, peak_hour, peak_dow): most frequent hour and weekday; ties go to the earlier one.

    One pass counts both: an hour and weekday cell is small, so the picks aggregate cells.
    """
    cells = hot.groupBy(key, F.hour("measurement_tstamp").alias("hour"), iso_weekday(F.to_date("measurement_tstamp")).alias("dow")).agg(F.count(F.lit(1)).alias("n"))
    def pick(part: str, name: str) -> DataFrame:
        counted = cells.groupBy(key, part).agg(F.sum("n").alias("n"))
        return counted.groupBy(key).agg(F.min_by(part, F.struct(-F.col("n"), part)).alias(name))

    return pick("hour", "peak_hour").join(pick("dow", "peak_dow"), key)


def _hot(readings: DataFrame, owners: DataFrame, key: str, params: Params) -> DataFrame:
    return readings.where(congested(params)).select("tmc_code", "measurement_tstamp").join(owners.select(key, F.col("tmc").alias("tmc_code")), "tmc_code")


def _labels() -> list[Column]:
    return [clock_label(F.col("peak_hour")).alias("peak_hour_label"), weekday_name(F.col("peak_dow")).alias("peak_weekday_name")]


def regional_ranking(ranked: DataFrame, segments: DataFrame, districts: DataFrame, readings: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Eligible bottlenecks of the region with county, district and the peak segment's busiest times."""
    rows = ranked.where("ranking_eligible")
    picks = _picks(_hot(readings, rows.select("bottleneck_id", F.col("peak_tmc").alias("tmc")), "bottleneck_id", params), "bottleneck_id")
    s = segments.select(F.col("tmc").alias("peak_tmc"), "county")
    c = districts.select(F.col("tmc").alias("peak_tmc"), "cid_name")
    return rows.join(s, "peak_tmc", "left").join(c, "peak_tmc", "left").join(picks, "bottleneck_id", "left").select(
        "network_severity_rank", "bottleneck_id", "corridor_name", "corridor_group", F.col("corridor").alias("road"), "direction", "representative_intersection", "occurrence_pct", "annual_queue_mile_hours",
        "avg_congested_speed_ratio", "severity_index", "aadt_weighted_severity_index", "analyzed_days", "county", "cid_name", F.col("peak_segment_aadt").alias("aadt"), F.col("peak_tmc").alias("tmc"), *_labels(),
    )


def corridor_ranking(ranked: DataFrame, segments: DataFrame, ordered: DataFrame, readings: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """All bottlenecks by their rank in the corridor, busiest times over the whole extent."""
    own = bottleneck_segments(ranked, ordered)
    picks = _picks(_hot(readings, own, "bottleneck_id", params), "bottleneck_id")
    s = segments.select(F.col("tmc").alias("peak_tmc"), "county")
    return ranked.join(s, "peak_tmc", "left").join(picks, "bottleneck_id", "left").select(
        "corridor_id", F.col("corridor_severity_rank").alias("severity_rank"), "bottleneck_id", "representative_intersection", "occurrence_pct", "annual_queue_mile_hours", "avg_congested_speed_ratio", "severity_index",
        "county", F.col("peak_segment_aadt").alias("aadt"), *_labels(),
    )


def report_ranking(ranked: DataFrame, reference: DataFrame) -> DataFrame:
    """The corridor report's columns with an approximate speed: ratio times mean reference speed."""
    rows = ranked.join(reference, "bottleneck_id", "left")
    return rows.select(
        "corridor_id", "corridor_severity_rank", "bottleneck_id", "representative_intersection", "analyzed_days", "occurrence_days", "occurrence_pct", "avg_active_minutes", "median_active_minutes", "p95_active_minutes",
        "avg_max_queue_miles", "annual_max_queue_miles", "annual_queue_mile_hours", "avg_congested_speed_ratio", "severity_index",
        rounded(F.col("avg_congested_speed_ratio") * F.col("avg_reference_speed"), 1).alias("approximate_speed_mph"),
    )


def intersection_index(ranked: DataFrame, ordered: DataFrame, segments: DataFrame, districts: DataFrame) -> DataFrame:
    """Eligible Arterial bottlenecks summed by intersection, located at the most severe one."""
    rows = ranked.where("corridor_group = 'Arterial' AND ranking_eligible AND representative_intersection IS NOT NULL").withColumn("label", F.concat_ws(" ", "corridor", title(F.col("direction"))))
    # a null severity is the most severe; ties by bottleneck
    first = F.struct(F.col("aadt_weighted_severity_index").isNotNull(), -F.col("aadt_weighted_severity_index"), "bottleneck_id")
    found = rows.groupBy("representative_intersection").agg(
        F.count(F.lit(1)).alias("contributing_bottlenecks"), F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("corridors"),
        rounded(F.sum("severity_index"), 2).alias("intersection_severity_index"), rounded(F.sum("aadt_weighted_severity_index"), 2).alias("aadt_weighted_intersection_severity_index"),
        rounded(F.avg("occurrence_pct"), 1).alias("avg_occurrence_pct"), rounded(F.sum("annual_queue_mile_hours"), 2).alias("total_annual_queue_mile_hours"),
        rounded(F.avg("avg_congested_speed_ratio"), 3).alias("avg_congested_speed_ratio"), F.max("peak_segment_aadt").alias("max_contributing_aadt"),
        F.min_by(F.struct("corridor_id", "peak_segment_order"), first).alias("at"),
    ).withColumn("intersection_severity_rank", F.rank().over(Window.orderBy(F.desc_nulls_first("aadt_weighted_intersection_severity_index"))))
    place = ordered.select("corridor_id", "segment_order", "tmc", ((F.col("start_latitude") + F.col("end_latitude")) / 2.0).alias("lat"), ((F.col("start_longitude") + F.col("end_longitude")) / 2.0).alias("lon"))
    located = found.join(place, (F.col("at.corridor_id") == F.col("corridor_id")) & (F.col("at.peak_segment_order") == F.col("segment_order")))
    located = located.join(segments.select("tmc", "county"), "tmc").join(districts.select("tmc", "cid_name"), "tmc", "left")
    return located.select(
        "representative_intersection", "contributing_bottlenecks", "corridors", "intersection_severity_index", "aadt_weighted_intersection_severity_index", "avg_occurrence_pct", "total_annual_queue_mile_hours",
        "avg_congested_speed_ratio", "max_contributing_aadt", "county", "cid_name", F.round("lat", 6).alias("latitude"), F.round("lon", 6).alias("longitude"), "intersection_severity_rank",
    )


def watch_metrics(watched: DataFrame, readings: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Yearly measures and busiest times of the watched segments."""
    own = watched.select("tmc", "miles")
    rows = readings.join(own, F.col("tmc_code") == F.col("tmc")).withColumns({"hot": congested(params), "ratio": ratio(), "day": F.to_date("measurement_tstamp")})
    daily = rows.groupBy("tmc", "miles", "day").agg(F.count_if("hot").alias("n"), rounded(F.avg(F.when(F.col("hot"), F.col("ratio"))), 9).alias("ratio")).withColumn("minutes", F.col("n") * params.slot_minutes)
    occurs = F.col("minutes") >= params.occurrence_minutes
    annual = daily.groupBy("tmc").agg(
        F.count(F.lit(1)).alias("analyzed_days"), F.count_if(occurs).alias("occurrence_days"), rounded(100.0 * F.count_if(occurs) / F.count(F.lit(1)), 2).alias("occurrence_pct"),
        rounded(F.avg(F.when(occurs, F.col("minutes"))), 1).alias("avg_congested_minutes_occurrence_day"), rounded(F.sum("n") * F.max("miles") * params.slot_minutes / 60.0, 3).alias("annual_segment_mile_hours"),
        rounded(F.avg(F.when(F.col("n") > 0, F.col("ratio"))), 3).alias("average_congested_speed_ratio"),
    )
    picks = _picks(_hot(readings, own, "tmc", params), "tmc")
    return annual.join(picks, "tmc", "left").select(*annual.columns, "peak_hour", *_labels())


def map_segments(bottlenecks: DataFrame, members: DataFrame, ranked: DataFrame, ordered: DataFrame, metrics: DataFrame) -> DataFrame:
    """Segments of eligible bottlenecks with severity and the day and time of the longest delay."""
    worst = metrics.where("occurrence").groupBy("bottleneck_id").agg(F.min_by(F.struct("analysis_date", "peak_time"), F.struct(-F.col("queue_mile_hours"), "analysis_date")).alias("w"))
    rows = ranked.where("ranking_eligible").join(members, "bottleneck_id")
    place = ordered.select("corridor_id", "segment_order", "tmc", "start_latitude", "start_longitude", "end_latitude", "end_longitude").where("start_latitude IS NOT NULL AND start_longitude IS NOT NULL AND end_latitude IS NOT NULL AND end_longitude IS NOT NULL")
    width = F.when(F.col("corridor_group") == "Interstate", 5.0).when(F.col("corridor_group") == "Expressway", 4.0).otherwise(3.0)
    return rows.join(place, ["corridor_id", "segment_order"]).join(worst, "bottleneck_id", "left").select(
        "bottleneck_id", "corridor_id", F.col("corridor").alias("road"), "direction", "corridor_group", "corridor_name", "segment_order", "tmc", "start_latitude", "start_longitude", "end_latitude", "end_longitude",
        F.col("aadt_weighted_severity_index").alias("severity"), F.col("w.analysis_date").alias("worst_date"), F.col("w.peak_time").alias("worst_time"), width.alias("width"),
    )


def network_map(definitions: DataFrame, ordered: DataFrame, profile: DataFrame, watched: DataFrame, watch: DataFrame, segments: DataFrame) -> DataFrame:
    """All corridor and watched segments with their occurrence and its bin."""
    from ..functions.columns import severity_bin

    d = definitions.where("is_active").select("corridor_id", "corridor_group", "corridor_name")
    p = profile.select("corridor_id", "segment_order", F.col("weekday_occurrence_pct").alias("severity_pct"))
    place = ["tmc", "start_latitude", "start_longitude", "end_latitude", "end_longitude"]
    corridor = ordered.select("corridor_id", "segment_order", *place).join(d, "corridor_id").join(p, ["corridor_id", "segment_order"], "left").select(F.lit("corridor").alias("layer"), F.col("corridor_group").alias("road_class"), F.col("corridor_name").alias("name"), *place, "severity_pct")
    seen = watched.select("tmc", "road_class", F.concat_ws(" ", "road", "direction").alias("name")).join(segments.select(*place), "tmc").join(watch.select("tmc", F.col("occurrence_pct").alias("severity_pct")), "tmc", "left")
    rows = corridor.unionByName(seen.select(F.lit("watch").alias("layer"), "road_class", "name", *place, "severity_pct"))
    return rows.where("start_latitude IS NOT NULL AND start_longitude IS NOT NULL AND end_latitude IS NOT NULL AND end_longitude IS NOT NULL").withColumn("severity_bin", severity_bin(F.col("severity_pct")))
