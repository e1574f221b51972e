"""What each bottleneck did on each day: queue series, metrics, growth and dissipation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import congested, observed, ratio, rounded
from ..params import DEFAULT, Params
from .observations import bottleneck_segments


def queue_series(bottlenecks: DataFrame, ordered: DataFrame, readings: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Congested segments, queue miles and ratios of each bottleneck at each time.

    The extents are resolved to segments on the small tables, so readings meet an equi-join.
    """
    own = bottleneck_segments(bottlenecks, ordered)
    r = readings.select("tmc_code", "measurement_tstamp", "speed", "reference_speed")
    rows = r.join(own, F.col("tmc_code") == F.col("tmc")).withColumns({"seen": observed(), "hot": congested(params), "ratio": ratio()})
    return rows.groupBy("bottleneck_id", "measurement_tstamp").agg(
        F.count_if("hot").cast("int").alias("congested_segments"), rounded(F.coalesce(F.sum(F.when(F.col("hot"), F.col("miles"))), F.lit(0.0)), 6).alias("queue_miles"),
        rounded(F.avg(F.when(F.col("hot"), F.col("ratio"))), 9).alias("average_congested_speed_ratio"), rounded(F.min(F.when(F.col("seen"), F.col("ratio"))), 9).alias("minimum_speed_ratio"),
    )


def _slope(y: str, x: str, which: Column) -> Column:
    """Least-squares slope over the rows of ``which``: null below three of them or at one time."""
    xs, ys = F.when(which, F.col(x)), F.when(which, F.col(y))
    return F.when((F.count(xs) >= 3) & (F.max(xs) > F.min(xs)), F.regr_slope(ys, xs))


def daily_metrics(series: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """A row for each bottleneck and day with readings.

    Times with a queue are active; a day of 30 active minutes or more is an occurrence. Other days
    keep their active minutes; their measures are zero or null. The peak is the first time with
    the longest queue; rates are slopes of queue miles over hours up to and from the peak.
    """
    rows = series.withColumns({"analysis_date": F.to_date("measurement_tstamp"), "active": F.col("queue_miles") > 0})
    day = Window.partitionBy("bottleneck_id", "analysis_date")
    peak = F.min_by("measurement_tstamp", F.when(F.col("active"), F.struct(-F.col("queue_miles"), F.col("measurement_tstamp"))))
    midnight = F.to_timestamp_ntz(F.col("analysis_date").cast("string"))
    timed = rows.withColumns({"peak": peak.over(day), "hours": F.timestamp_diff("SECOND", midnight, F.col("measurement_tstamp")) / 3600.0})
    on = F.col("active")
    got = timed.groupBy("bottleneck_id", "analysis_date").agg(
        (F.count_if(on) * params.slot_minutes).alias("minutes"), F.min(F.when(on, F.col("measurement_tstamp"))).alias("onset"), F.min("peak").alias("peak"), F.max(F.when(on, F.col("measurement_tstamp"))).alias("last"),
        F.max(F.when(on, F.col("queue_miles"))).alias("longest"), F.avg(F.when(on, F.col("queue_miles"))).alias("mean"), F.sum(F.when(on, F.col("queue_miles"))).alias("total"),
        F.max(F.when(on, F.col("congested_segments"))).alias("segments"), F.avg(F.when(on, F.col("average_congested_speed_ratio"))).alias("ratio"), F.min(F.when(on, F.col("minimum_speed_ratio"))).alias("lowest"),
        _slope("queue_miles", "hours", on & (F.col("measurement_tstamp") <= F.col("peak"))).alias("growth"), _slope("queue_miles", "hours", on & (F.col("measurement_tstamp") >= F.col("peak"))).alias("decay"),
    ).withColumn("occurrence", F.col("minutes") >= params.occurrence_minutes)

    def masked(x: Column, otherwise: object = None) -> Column:
        return F.when(F.col("occurrence"), x).otherwise(F.lit(otherwise))

    clear = F.col("last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(params.slot_minutes), F.lit(0))
    return got.select(
        "bottleneck_id", "analysis_date", "occurrence", masked(F.col("onset")).alias("onset_time"), masked(F.col("peak")).alias("peak_time"), masked(clear).alias("clearance_time"),
        F.col("minutes").alias("active_congestion_minutes"), masked(F.timestamp_diff("MINUTE", F.col("onset"), clear).cast("long"), 0).alias("episode_duration_minutes"),
        masked(rounded(F.col("longest"), 3), 0.0).alias("maximum_queue_miles"), masked(rounded(F.col("mean"), 3), 0.0).alias("average_queue_miles"),
        masked(rounded(F.col("total") * params.slot_minutes / 60.0, 3), 0.0).alias("queue_mile_hours"), masked(F.col("segments"), 0).alias("maximum_congested_segments"),
        masked(rounded(F.col("ratio"), 3)).alias("average_congested_speed_ratio"), masked(rounded(F.col("lowest"), 3)).alias("minimum_speed_ratio"),
        masked(rounded(F.col("growth"), 3)).alias("queue_growth_rate_mph"), masked(rounded(F.col("decay"), 3)).alias("queue_dissipation_rate_mph"),
    )


def occurrence_details(metrics: DataFrame, bottlenecks: DataFrame) -> DataFrame:
    """Each corridor's occurrence days with onset, peak and clearance."""
    b = bottlenecks.select("bottleneck_id", "corridor_id", "representative_intersection")
    return metrics.where("occurrence").join(b, "bottleneck_id").select(
        "corridor_id", "bottleneck_id", "representative_intersection", "analysis_date", "onset_time", "peak_time", "clearance_time", "active_congestion_minutes", "maximum_queue_miles", "queue_mile_hours", "average_congested_speed_ratio"
    )
