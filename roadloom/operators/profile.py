"""Daily and yearly congestion profile of corridor segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import congested, observed, ratio, rounded
from ..params import DEFAULT, Params


def segment_daily(joined: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Intervals, congested minutes and mean ratios of each corridor segment and day."""
    rows = joined.withColumns({"seen": observed(), "hot": congested(params), "ratio": ratio()})
    return rows.groupBy("corridor_id", "analysis_date", "segment_order", "tmc", "intersection", "miles").agg(
        F.count_if("seen").alias("observed_intervals"), F.count_if("hot").alias("congested_intervals"), (F.count_if("hot") * params.slot_minutes).alias("congested_minutes"),
        rounded(F.avg(F.when(F.col("seen"), F.col("ratio"))), 9).alias("average_speed_ratio"), rounded(F.avg(F.when(F.col("hot"), F.col("ratio"))), 9).alias("congested_average_speed_ratio"),
    )


def segment_profile(daily: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """A row for each corridor segment over all days; minutes and percentiles over occurrence days.

    The denominator counts every day with a joined reading; ratios are unweighted means of days.
    """
    occurs = F.col("congested_minutes") >= params.occurrence_minutes
    minutes = F.when(occurs, F.col("congested_minutes"))
    return daily.groupBy("corridor_id", "segment_order").agg(
        F.max("tmc").alias("tmc"), F.max("intersection").alias("intersection"), F.max("miles").alias("miles"),
        F.count(F.lit(1)).alias("analyzed_days"), F.count_if(occurs).alias("occurrence_days"),
        rounded(100.0 * F.count_if(occurs) / F.count(F.lit(1)), 2).alias("weekday_occurrence_pct"),
        rounded(F.avg(minutes), 1).alias("avg_congested_minutes_occurrence_day"),
        rounded(F.percentile(minutes, 0.5), 1).alias("median_congested_minutes"), rounded(F.percentile(minutes, 0.95), 1).alias("p95_congested_minutes"),
        rounded(F.sum("congested_intervals") * F.max("miles") * params.slot_minutes / 60.0, 3).alias("annual_segment_mile_hours"),
        rounded(F.avg(F.when(F.col("congested_intervals") > 0, F.col("congested_average_speed_ratio"))), 3).alias("average_congested_speed_ratio"),
    )


def occurrence_profile(profile: DataFrame) -> DataFrame:
    """The occurrence curve along each corridor."""
    return profile.select("corridor_id", "segment_order", "intersection", "weekday_occurrence_pct")
