"""Recurring bottlenecks: peaks of the smoothed occurrence curve and their extents."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import rounded
from ..params import DEFAULT, Params


def smoothed_profile(profile: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Segments with enough days, numbered from 0 along the corridor, with a mean over three.

    Beyond either end the curve is zero; a null occurrence is zero.
    """
    along = Window.partitionBy("corridor_id").orderBy("segment_order")
    rows = profile.where(F.col("analyzed_days") >= params.profile_days).withColumns({"occurrence": F.coalesce("weekday_occurrence_pct", F.lit(0.0)), "length": F.coalesce("miles", F.lit(0.0))})
    mean = (F.coalesce(F.lag("occurrence").over(along), F.lit(0.0)) + F.col("occurrence") + F.coalesce(F.lead("occurrence").over(along), F.lit(0.0))) / 3.0
    return rows.withColumns({"position": F.row_number().over(along) - 1, "smoothed": mean})


def find_peaks(curve: np.ndarray, params: Params = DEFAULT) -> list[int]:
    """Positions of peaks: strict maxima (middles of plateaus), high, apart and prominent enough.

    Of two peaks too close the higher stays, of equal ones the later. The ends are never peaks.
    """
    # runs of equal values: a peak is a run with lower runs on both sides
    starts = np.flatnonzero(np.r_[True, curve[1:] != curve[:-1]])
    ends = np.r_[starts[1:] - 1, len(curve) - 1]
    level = curve[starts]
    top = [(int(s) + int(e)) // 2 for i, (s, e) in enumerate(zip(starts, ends, strict=True)) if 0 < i < len(starts) - 1 and level[i] > level[i - 1] and level[i] > level[i + 1]]
    high = [p for p in top if curve[p] >= params.peak_height]
    apart: list[int] = []
    for p in sorted(high, key=lambda p: (curve[p], p), reverse=True):
        if all(abs(p - q) >= params.peak_distance for q in apart):
            apart.append(p)
    found = []
    for p in sorted(apart):
        higher = np.flatnonzero(curve > curve[p])
        left = higher[higher < p].max(initial=-1) + 1
        right = higher[higher > p].min(initial=len(curve))
        if curve[p] - max(curve[left : p + 1].min(), curve[p:right].min()) >= params.peak_prominence:
            found.append(p)
    return found


def grow(curve: np.ndarray, miles: np.ndarray, peak: int, params: Params = DEFAULT) -> tuple[int, int]:
    """First and last position around a peak: neighbours at half its height or more, within 5 miles.

    One budget of miles serves both sides; the left side spends first.
    """
    least, spent, edge = curve[peak] * params.boundary_share, float(miles[peak]), {}
    for step in (-1, 1):
        at = peak
        while 0 <= at + step < len(curve) and curve[at + step] >= least and spent + float(miles[at + step]) <= params.bottleneck_miles:
            at += step
            spent += float(miles[at])
        edge[step] = at
    return edge[-1], edge[1]


def cut_at_valleys(curve: np.ndarray, peaks: list[int], extents: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(peak, start, end) with neighbours that overlap cut at the lowest point between their peaks.

    Neighbours are taken once in the order of their starts; a cut never widens an extent.
    """
    order = sorted(range(len(peaks)), key=lambda i: (extents[i][0], peaks[i]))
    start, end = [e[0] for e in extents], [e[1] for e in extents]
    for a, b in zip(order, order[1:], strict=False):
        if end[a] < start[b]:
            continue
        left, right = (a, b) if peaks[a] <= peaks[b] else (b, a)
        valley = peaks[left] + int(np.argmin(curve[peaks[left] : peaks[right] + 1]))
        end[left] = min(valley, extents[left][1])
        start[right] = max(valley + 1, extents[right][0])
    return [(peaks[i], start[i], end[i]) for i in order]


def extents(profile: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """corridor_id, peak_position, start_position, end_position, peak_smoothed of each bottleneck.

    One corridor's smoothed profile (a row for each of its segments) is one group.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        curve, miles = rows["smoothed"].to_numpy(float), rows["length"].to_numpy(float)
        peaks = find_peaks(curve, params) if len(curve) >= 3 else []
        found = cut_at_valleys(curve, peaks, [grow(curve, miles, p, params) for p in peaks])
        out = pd.DataFrame(found, columns=["peak_position", "start_position", "end_position"])
        out.insert(0, "corridor_id", key[0])
        return out.assign(peak_smoothed=[curve[p] for p in out["peak_position"]])

    curve = smoothed_profile(profile, params).select("corridor_id", "position", "smoothed", "length")
    return curve.groupBy("corridor_id").applyInPandas(run, "corridor_id int, peak_position int, start_position int, end_position int, peak_smoothed double")


def _numbered(found: DataFrame, definitions: DataFrame) -> DataFrame:
    """Bottlenecks with ids by road, direction, start and peak."""
    d = definitions.select("corridor_id", "road", "direction", "corridor_group")
    number = F.row_number().over(Window.orderBy("road", "direction", "start_position", "peak_position"))
    return found.join(d, "corridor_id").withColumn("bottleneck_id", number)


def bottlenecks(found: DataFrame, profile: DataFrame, definitions: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """A row for each bottleneck with its extent in segment orders and what its segments sum to."""
    numbered = _numbered(found, definitions)
    p = smoothed_profile(profile, params).withColumnRenamed("corridor_id", "c")
    rows = numbered.join(p, (F.col("corridor_id") == F.col("c")) & F.col("position").between(F.col("start_position"), F.col("end_position")))
    at_peak = F.col("position") == F.col("peak_position")
    return rows.groupBy("bottleneck_id", "corridor_id", "road", "direction", "corridor_group", "peak_smoothed").agg(
        F.max(F.when(at_peak, F.col("segment_order"))).alias("peak_segment_order"), F.min("segment_order").alias("start_segment_order"), F.max("segment_order").alias("end_segment_order"),
        F.count(F.lit(1)).cast("int").alias("segment_count"), F.max(F.when(at_peak, F.col("intersection"))).alias("representative_intersection"),
        F.max("occurrence").alias("maximum_raw_occurrence_pct"), rounded(F.sum("annual_segment_mile_hours"), 3).alias("annual_mile_hours"),
        rounded(F.coalesce(F.avg("average_congested_speed_ratio"), F.lit(0.0)), 3).alias("average_congested_speed_ratio"),
    ).select(
        "bottleneck_id", "corridor_id", F.col("road").alias("corridor"), "direction", "corridor_group", "peak_segment_order", "start_segment_order", "end_segment_order", "segment_count", "representative_intersection",
        rounded(F.col("peak_smoothed"), 3).alias("peak_occurrence_pct"), "maximum_raw_occurrence_pct", "annual_mile_hours", "average_congested_speed_ratio",
    )


def membership(found: DataFrame, profile: DataFrame, definitions: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(bottleneck_id, segment_order) of the profiled segments within each extent."""
    p = smoothed_profile(profile, params).select(F.col("corridor_id").alias("c"), "position", "segment_order")
    numbered = _numbered(found, definitions)
    return numbered.join(p, (F.col("corridor_id") == F.col("c")) & F.col("position").between(F.col("start_position"), F.col("end_position"))).select("bottleneck_id", "segment_order")
