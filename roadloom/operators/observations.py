"""Readings joined to segments, daily rollups, hourly curves, overnight shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import congested, observed, ratio, road_class, rounded
from ..params import DEFAULT, Params


def observations(readings: DataFrame, segments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Each reading of a known segment with its speed ratio, congestion flag and speed drop."""
    s = segments.select("tmc", "road", "direction", "intersection", "county", "miles")
    return readings.join(s, F.col("tmc_code") == F.col("tmc")).select(
        "tmc_code", "measurement_tstamp", "road", "direction", "intersection", "county", "miles", "speed", "reference_speed",
        ratio().alias("speed_ratio"), congested(params).alias("is_congested"), F.greatest(F.col("reference_speed") - F.col("speed"), F.lit(0.0)).alias("speed_drop"),
    )


def daily_rollup(observed_rows: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Counts, congested minutes, mean speed and speed drops of each segment and day."""
    day = F.to_date("measurement_tstamp").alias("analysis_date")
    hot = F.count_if("is_congested")
    return observed_rows.groupBy("tmc_code", day).agg(
        F.count(F.lit(1)).alias("readings"), hot.alias("congested_readings"), (hot * params.slot_minutes).alias("congested_minutes"),
        rounded(F.avg("speed"), 3).alias("avg_speed"), rounded(F.avg("speed_drop"), 3).alias("avg_speed_drop"), rounded(F.max("speed_drop"), 3).alias("max_speed_drop"),
    )


def rollup_states(observed_rows: DataFrame) -> DataFrame:
    """Sums and counts of each segment and day from which ``merged_rollup`` makes the daily rollup.

    States of parts of a day's readings add up, so readings that come late are aggregated alone.
    """
    day = F.to_date("measurement_tstamp").alias("analysis_date")
    sums = [x for v in ("speed", "speed_drop") for x in (F.sum(v).alias(f"{v}_sum"), F.count(v).alias(f"{v}_n"))]
    return observed_rows.groupBy("tmc_code", day).agg(F.count(F.lit(1)).alias("readings"), F.count_if("is_congested").alias("congested_readings"), *sums, F.max("speed_drop").alias("speed_drop_max"))


def merged_rollup(states: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The rows of ``daily_rollup`` from states, however many there are of a segment and day."""

    def mean(v: str) -> Column:
        return rounded(F.sum(f"{v}_sum") / F.nullif(F.sum(f"{v}_n"), F.lit(0)), 3)

    hot = F.sum("congested_readings")
    return states.groupBy("tmc_code", "analysis_date").agg(
        F.sum("readings").alias("readings"), hot.alias("congested_readings"), (hot * params.slot_minutes).alias("congested_minutes"),
        mean("speed").alias("avg_speed"), mean("speed_drop").alias("avg_speed_drop"), rounded(F.max("speed_drop_max"), 3).alias("max_speed_drop"),
    )


def corridor_readings(readings: DataFrame, ordered: DataFrame) -> DataFrame:
    """Every reading of every corridor's segments with its corridor, order and day."""
    s = ordered.select("corridor_id", "segment_order", "tmc", "intersection", "miles")
    return readings.select("tmc_code", "measurement_tstamp", "speed", "reference_speed").join(s, F.col("tmc_code") == F.col("tmc")).select(
        "corridor_id", F.to_date("measurement_tstamp").alias("analysis_date"), "segment_order", "tmc", "intersection", "miles", "measurement_tstamp", "speed", "reference_speed"
    )


def available_days(joined: DataFrame) -> DataFrame:
    return joined.select("corridor_id", "analysis_date").distinct()


def remaining_days(available: DataFrame, completed: DataFrame, day_limit: int | None = None) -> DataFrame:
    """Available corridor days that are not completed, the earliest ``day_limit`` of each corridor."""
    left = available.join(completed.select("corridor_id", "analysis_date").distinct(), ["corridor_id", "analysis_date"], "left_anti")
    if day_limit is None:
        return left
    first = F.row_number().over(Window.partitionBy("corridor_id").orderBy("analysis_date"))
    return left.withColumn("n", first).where(F.col("n") <= day_limit).drop("n")


def corridor_day(joined: DataFrame, days: DataFrame) -> DataFrame:
    """The readings of the given corridor days; days without readings are absent."""
    return joined.join(days, ["corridor_id", "analysis_date"], "left_semi")


def hourly_curve(readings: DataFrame) -> DataFrame:
    """Mean speed above zero by hour of day over the whole network."""
    return readings.where("speed > 0").groupBy(F.hour("measurement_tstamp").alias("hour")).agg(rounded(F.avg("speed"), 2).alias("avg_speed"))


def hourly_curve_by_class(readings: DataFrame, segments: DataFrame) -> DataFrame:
    """The same for each road class, by the segments' own class alone."""
    s = segments.select("tmc", road_class(F.col("f_system")).alias("road_class")).where("road_class IS NOT NULL")
    rows = readings.where("speed > 0").join(s, F.col("tmc_code") == F.col("tmc"))
    return rows.groupBy("road_class", F.hour("measurement_tstamp").alias("hour")).agg(rounded(F.avg("speed"), 2).alias("avg_speed"))


def extreme_hours(by_class: DataFrame, of: str = "Arterial") -> DataFrame:
    """(kind, hour): all hours tied for the highest (free_flow) and lowest (peak) rounded mean."""
    curve = by_class.where(F.col("road_class") == of)
    ends = curve.agg(F.max("avg_speed").alias("high"), F.min("avg_speed").alias("low"))
    rows = curve.crossJoin(F.broadcast(ends))  # one row of 24
    free = rows.where("avg_speed = high").select(F.lit("free_flow").alias("kind"), "hour")
    return free.unionByName(rows.where("avg_speed = low").select(F.lit("peak").alias("kind"), "hour"))


def bottleneck_segments(bottlenecks: DataFrame, ordered: DataFrame) -> DataFrame:
    """(bottleneck_id, tmc, miles): the segments within each extent, resolved on the small tables."""
    b = bottlenecks.select("bottleneck_id", F.col("corridor_id").alias("c"), "start_segment_order", "end_segment_order")
    within = (F.col("corridor_id") == F.col("c")) & F.col("segment_order").between(F.col("start_segment_order"), F.col("end_segment_order"))
    return ordered.join(b, within).select("bottleneck_id", "tmc", "segment_order", "miles")


def overnight_share(bottlenecks: DataFrame, ordered: DataFrame, readings: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Share of overnight readings below the congestion ratio for each Arterial bottleneck.

    A null speed counts as not congested; bottlenecks without overnight readings are absent.
    """
    night = readings.where(F.hour("measurement_tstamp").isin(*params.overnight_hours) & (F.col("reference_speed") > 0))
    own = bottleneck_segments(bottlenecks.where("corridor_group = 'Arterial'"), ordered)
    rows = night.join(own, F.col("tmc_code") == F.col("tmc"))
    share = 100.0 * F.avg(F.when(F.col("speed") < F.lit(params.congestion_ratio) * F.col("reference_speed"), 1.0).otherwise(0.0))
    found = rows.groupBy("bottleneck_id").agg(share.alias("p"))
    return found.select("bottleneck_id", rounded(F.col("p"), 3).alias("overnight_congested_pct"), (F.col("p") < params.overnight_pct).alias("ranking_eligible"))


def extent_reference_speed(bottlenecks: DataFrame, ordered: DataFrame, readings: DataFrame) -> DataFrame:
    """Mean reference speed over each bottleneck's extent."""
    rows = readings.select("tmc_code", "reference_speed").join(bottleneck_segments(bottlenecks, ordered), F.col("tmc_code") == F.col("tmc"))
    return rows.groupBy("bottleneck_id").agg(rounded(F.avg("reference_speed"), 3).alias("avg_reference_speed"))


def scope_counts(readings: DataFrame, segments: DataFrame, ordered: DataFrame, watched: DataFrame, definitions: DataFrame, events: DataFrame, bottlenecks: DataFrame, daily_metrics: DataFrame) -> DataFrame:
    """One row of what was read and what was analysed."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    # one pass over the readings: how many corridors and watch rows hold each segment
    uses = ordered.select("tmc").unionByName(watched.select("tmc")).groupBy("tmc").agg(F.count(F.lit(1)).alias("uses"))
    probe = readings.select("tmc_code", "measurement_tstamp").join(uses, F.col("tmc_code") == F.col("tmc"), "left").agg(
        F.count(F.lit(1)).alias("probe_total"), F.min("measurement_tstamp").alias("probe_min"), F.max("measurement_tstamp").alias("probe_max"), F.coalesce(F.sum("uses"), F.lit(0)).alias("probe_analyzed")
    )
    dates = events.agg(F.count(F.lit(1)).alias("events_total"), F.min("analysis_date").alias("date_min"), F.max("analysis_date").alias("date_max"), F.countDistinct("analysis_date").alias("date_count"))
    parts = [probe, dates, count(segments, "tmc_total"), count(ordered, "segments_total"), count(watched, "watch_total"), count(definitions.where("is_active"), "corridors_total"), count(bottlenecks, "bottlenecks_total"), count(daily_metrics, "daily_metrics_total")]
    row = parts[0]
    for part in parts[1:]:
        row = row.crossJoin(part)  # each side is one row of totals
    return row
