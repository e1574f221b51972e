"""Events rolled up over the region: months, weekdays, hours, counties, the worst day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_weekday, rounded


def active_events(events: DataFrame, definitions: DataFrame) -> DataFrame:
    return events.join(definitions.where("is_active").select("corridor_id"), "corridor_id", "left_semi")


def _totals() -> list:
    return [F.count(F.lit(1)).alias("event_count"), rounded(F.sum("duration_minutes").cast("double"), 0).alias("total_duration_minutes"), rounded(F.sum("event_area_mile_hours"), 2).alias("total_mile_hours")]


def by_month(events: DataFrame) -> DataFrame:
    return events.groupBy(F.trunc("analysis_date", "month").alias("month")).agg(*_totals())


def by_weekday(events: DataFrame) -> DataFrame:
    return events.groupBy(iso_weekday(F.col("analysis_date")).alias("weekday_number"), F.date_format("analysis_date", "E").alias("weekday_name")).agg(*_totals())


def by_county(events: DataFrame, segments: DataFrame) -> DataFrame:
    """By the county of the first segment; segments that aren't known are UNKNOWN."""
    rows = events.join(segments.select(F.col("tmc").alias("first_tmc"), "county"), "first_tmc", "left")
    return rows.groupBy(F.coalesce("county", F.lit("UNKNOWN")).alias("county")).agg(*_totals())


def top_counties(counties: DataFrame, most: int = 15) -> DataFrame:
    """The known counties with the most delay; ties by name."""
    return counties.where("county <> 'UNKNOWN'").orderBy(F.desc("total_mile_hours"), "county").limit(most)


def hour_slices(events: DataFrame) -> DataFrame:
    """One row for each calendar hour that an event overlaps, with the minutes of overlap."""
    def hour(ts: str):
        return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")

    step = F.expr("interval 1 hour")
    rows = events.withColumn("hour_start", F.explode(F.sequence(hour("start_time"), hour("end_time"), step)))
    overlap = F.timestamp_diff("SECOND", F.greatest("start_time", "hour_start"), F.least(F.col("end_time"), F.col("hour_start") + step)) / 60.0
    return rows.withColumn("overlap_minutes", overlap).where("overlap_minutes > 0")


def by_hour(events: DataFrame) -> DataFrame:
    """By hour of day, each event's totals dealt by its overlap with each hour.

    event_count counts distinct event ids, which start anew each corridor day; events counts events.
    """
    rows = hour_slices(events)
    share = F.col("event_area_mile_hours") * F.col("overlap_minutes") / F.nullif(F.col("duration_minutes"), F.lit(0))
    return rows.groupBy(F.hour("hour_start").alias("hour_of_day")).agg(
        F.countDistinct("event_id").alias("event_count"), F.countDistinct("corridor_id", "analysis_date", "event_id").alias("events"),
        rounded(F.sum("overlap_minutes"), 0).alias("total_duration_minutes"), rounded(F.sum(share), 2).alias("total_mile_hours"),
    )


def worst_day(events: DataFrame) -> DataFrame:
    """The day with the most delay and its total: one row, or none without events. Ties: earlier."""
    daily = events.groupBy("analysis_date").agg(rounded(F.sum("event_area_mile_hours"), 3).alias("total_mile_hours"))
    return daily.orderBy(F.desc("total_mile_hours"), "analysis_date").limit(1)


def worst_day_bottlenecks(worst: DataFrame, metrics: DataFrame, ranked: DataFrame) -> DataFrame:
    """Eligible bottlenecks that occurred on the worst day."""
    day = metrics.where("occurrence").join(worst.select("analysis_date"), "analysis_date", "left_semi")
    return day.join(ranked.where("ranking_eligible").select("bottleneck_id"), "bottleneck_id", "left_semi").select("bottleneck_id").distinct()


def worst_day_summary(worst: DataFrame, metrics: DataFrame, ranked: DataFrame, segments: DataFrame, districts: DataFrame) -> DataFrame:
    """The worst day with its worst eligible bottleneck, if any; ties by bottleneck."""
    r = ranked.where("ranking_eligible").select("bottleneck_id", "corridor_name", "direction", "representative_intersection", "peak_segment_aadt", "aadt_weighted_severity_index", F.col("peak_tmc").alias("tmc"))
    day = metrics.where("occurrence").select("bottleneck_id", F.col("analysis_date").alias("day"), F.col("queue_mile_hours").alias("day_queue_mile_hours"), "active_congestion_minutes")
    found = worst.join(day, F.col("analysis_date") == F.col("day"), "left_outer").join(r, "bottleneck_id", "left")
    mine = found.where("corridor_name IS NOT NULL").orderBy(F.desc("day_queue_mile_hours"), "bottleneck_id").limit(1).drop("total_mile_hours", "day")
    rows = worst.join(mine, "analysis_date", "left").join(segments.select("tmc", "county"), "tmc", "left").join(districts.select("tmc", "cid_name"), "tmc", "left")
    return rows.select("analysis_date", "total_mile_hours", "bottleneck_id", "day_queue_mile_hours", "active_congestion_minutes", "corridor_name", "direction", "representative_intersection", "peak_segment_aadt", "aadt_weighted_severity_index", "county", "cid_name")


def worst_day_hours(worst: DataFrame, events: DataFrame) -> DataFrame:
    """Delay by hour on the worst day."""
    return by_hour(events.join(worst.select("analysis_date"), "analysis_date", "left_semi")).select("hour_of_day", "total_mile_hours")


def peaks_of(months: DataFrame, weekdays: DataFrame, hours: DataFrame) -> DataFrame:
    """(kpi, label, value) of the month, weekday and hour with the most delay; ties: the earlier."""
    def top(df: DataFrame, kpi: str, label, order: str) -> DataFrame:
        best = F.min_by(F.struct(label.alias("label"), F.col("total_mile_hours").alias("value")), F.struct(-F.col("total_mile_hours"), order))
        return df.agg(best.alias("b")).where("b IS NOT NULL").select(F.lit(kpi).alias("kpi"), "b.label", "b.value")

    month = top(months, "month", F.date_format("month", "MMMM"), "month")
    return month.unionByName(top(weekdays, "weekday", F.col("weekday_name"), "weekday_number")).unionByName(top(hours, "hour", F.col("hour_of_day").cast("string"), "hour_of_day"))
