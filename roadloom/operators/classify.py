"""Severity classes: exact least-squares classes of one value, K-means tiers of several.

Neither draws random numbers. Classes of one value are the optimal partition of its sorted distinct
values. Tiers start from fixed seedings, all refined at once, and the one of the least cost counts;
centres are rounded, so that the order of summation doesn't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import display_name, long_date_label, short_clock_label
from ..params import DEFAULT, Params
from ..sources.scratch import materialise
from . import geo

TIERS = ("Least Severe", "Low", "Moderate", "High", "Most Severe")
#: Name and whether a higher value is worse.
FEATURES = (("speed_drop_ratio", False), ("occurrence_pct", True), ("aadt", True), ("annual_queue_mile_hours", True))
#: Values of one class are told apart to this part of one.
UNIT = 1000
#: Decimals of standardised features and centres, and refining steps at most.
PLACES, STEPS = 9, 100
#: Rows up to which the many short steps work on one partition.
ONE_PARTITION = 50_000


def runs(values: Sequence[int], counts: Sequence[int], k: int) -> list[int]:
    """The end (exclusive index) of each of ``k`` runs of ascending values with the least sum of squares.

    Level by level, the best last run of each prefix; its start only grows with the prefix, so the
    middle prefix bounds the search of both halves. Ties go to the smallest start.
    """
    n, s, q = [0], [0], [0]
    for v, c in zip(values, counts, strict=True):
        n.append(n[-1] + c)
        s.append(s[-1] + c * v)
        q.append(q[-1] + c * v * v)

    def spread(i: int, j: int) -> float:
        """Sum of squares about the mean of values i to j - 1, from exact sums."""
        total = s[j] - s[i]
        return float((n[j] - n[i]) * (q[j] - q[i]) - total * total) / (n[j] - n[i])

    size = len(values)
    cost, starts = [0.0, *(spread(0, j) for j in range(1, size + 1))], [[0] * (size + 1)]
    for level in range(1, k):
        after, start = [0.0] * (size + 1), [0] * (size + 1)
        todo = [(level + 1, size, level, size - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            after[j], start[j] = min((cost[i] + spread(i, j), i) for i in range(first, min(last, j - 1) + 1))
            todo += [(low, j - 1, first, start[j]), (j + 1, high, start[j], last)]
        cost = after
        starts.append(start)
    ends = [size]
    for start in reversed(starts[1:]):
        ends.append(start[ends[-1]])
    return ends[::-1]


def severity_classes(rows: DataFrame, value: str, params: Params = DEFAULT) -> DataFrame:
    """``rows`` with a value, their class_rank and its label: the range of the class's values.

    The classes have the least sum of squares of all partitions. Equal values have one class; where
    there are fewer distinct values than classes, each is one. The distinct values of a network-sized
    table and their counts are one task; what comes back is one row of class borders.
    """
    points = materialise(rows.where(F.col(value).isNotNull()).withColumn("__unit", F.round(F.col(value) * UNIT).cast("long")), "points")
    counted = points.groupBy("__unit").agg(F.count(F.lit(1)).alias("n"))

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(pair for b in batches for pair in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True))
        values = [v for v, _ in found]
        ends = runs(values, [c for _, c in found], min(params.classes, len(found))) if found else []
        yield pa.record_batch({"tops": pa.array([[values[e - 1] for e in ends]], pa.list_(pa.int64()))})

    tops = counted.coalesce(1).mapInArrow(borders, "tops array<long>")
    classed = points.crossJoin(F.broadcast(tops)).withColumn("class_rank", F.size(F.filter("tops", lambda t: t < F.col("__unit")))).drop("tops", "__unit")  # one row of borders
    ranges = classed.groupBy("class_rank").agg(F.min(value).alias("class_low"), F.max(value).alias("class_high"))
    label = F.concat(F.format_number("class_low", 0), F.lit("–"), F.format_number("class_high", 0))
    return classed.join(F.broadcast(ranges), "class_rank").withColumn("class_label", label).drop("class_low", "class_high")  # a row for each class


def _apart(names: list[str], centre: Column) -> Column:
    """Squared distance of a row from a centre."""
    each = [(F.col(c) - centre[i]) * (F.col(c) - centre[i]) for i, c in enumerate(names)]
    return sum(each[1:], each[0])


def _with(points: DataFrame, centres: list[list[list[float]]]) -> DataFrame:
    """``points`` with the centres of all seedings as one constant."""
    text = "array(%s)"
    constant = text % ", ".join(text % ", ".join(text % ", ".join(f"{x!r}D" for x in centre) for centre in seeding) for seeding in centres)
    return points.withColumn("centres", F.expr(constant))


def _nearest(names: list[str]) -> Column:
    """For each seeding the distance and number of the nearest centre; the first at ties."""
    return F.transform("centres", lambda seeding: F.array_min(F.transform(seeding, lambda centre, i: F.struct(_apart(names, centre).alias("d"), i.alias("c")))))


def _seedings(points: DataFrame, names: list[str], k: int) -> list[list[list[float]]]:
    """The starts: the farthest points from the least score's and from the middle, and means of k equal parts by score and by each feature.

    Ties go by the features from the first on. The windows have no key: points are as many as intersections.
    """
    place = F.struct(*names)
    middle = _apart(names, F.array(*[F.lit(0.0) for _ in names]))
    first = points.agg(F.min_by(place, F.struct("class_score", place)).alias("low"), F.min_by(place, F.struct(middle, place)).alias("mid")).first()
    far = [[list(first.low)], [list(first.mid)]]
    for _ in range(k - 1):
        near = F.transform(_nearest(names), lambda x: x["d"])
        at = _with(points, far).select(*names, near.alias("near"))
        found = at.agg(*[F.min_by(place, F.struct(-F.col("near")[i], place)).alias(f"f{i}") for i in range(2)]).first()
        for i in range(2):
            far[i].append(list(found[i]))
    orders = ["class_score", *names]
    part = [F.floor((F.row_number().over(Window.orderBy(o, *names)) - 1) * k / F.count(F.lit(1)).over(Window.partitionBy())).cast("int") for o in orders]
    parts = points.select(*names, F.array(*part).alias("parts")).select(*names, F.posexplode("parts").alias("seeding", "c"))
    means = parts.groupBy("seeding", "c").agg(*[F.round(F.avg(c), PLACES).alias(c) for c in names]).orderBy("seeding", "c").collect()  # k rows for each seeding
    return far + [[[m[c] for c in names] for m in means if m.seeding == i] for i in range(len(orders))]


def _centres(points: DataFrame, names: list[str], k: int) -> list[list[float]]:
    """The ``k`` centres from the seeding of the least cost after refining; the first at ties."""
    centres = _seedings(points, names, k)
    step = F.posexplode(_nearest(names)).alias("seeding", "near")
    for _ in range(STEPS):
        near = _with(points, centres).select(*names, step)
        means = near.groupBy("seeding", "near.c").agg(*[F.round(F.avg(c), PLACES).alias(c) for c in names]).collect()  # k rows for each seeding
        after = [[list(c) for c in seeding] for seeding in centres]
        for m in means:
            after[m.seeding][m.c] = [m[c] for c in names]
        if after == centres:
            break
        centres = after
    costs = {r.seeding: r.cost for r in _with(points, centres).select(step).groupBy("seeding").agg(F.round(F.sum("near.d"), 6).alias("cost")).collect()}
    return centres[min(costs, key=lambda i: (costs[i], i))]


def multi_feature_classes(rows: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """``rows`` with class_score, class_rank and tier over standardised features, worst high.

    A feature without variance keeps its scale; one without a value counts as average.
    """
    rows = materialise(rows, "points")
    stats = rows.agg(*[F.avg(c).alias(f"__m_{c}") for c, _ in FEATURES], *[F.stddev_pop(c).alias(f"__s_{c}") for c, _ in FEATURES])
    wide = rows.crossJoin(F.broadcast(stats))  # one row of totals
    names = []
    for c, worse in FEATURES:
        scale = F.round(f"__s_{c}", PLACES)
        z = F.round((F.col(c) - F.col(f"__m_{c}")) / F.when(scale == 0, 1.0).otherwise(scale), PLACES)
        wide = wide.withColumn(f"__z_{c}", F.coalesce(z if worse else -z, F.lit(0.0)))
        names.append(f"__z_{c}")
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    scored = materialise(wide.withColumn("class_score", F.round(total / len(names), PLACES)).select(*rows.columns, *names, "class_score"), "scored")
    points = scored.select(*names, "class_score")
    few = points.limit(ONE_PARTITION + 1).count() <= ONE_PARTITION
    # in memory for steps that read them again and again; lost parts come from their files
    held = (points.coalesce(1) if few else points).persist()
    try:
        k = held.select(*names).distinct().limit(params.classes).count()
        centres = _centres(held, names, k) if k else [[0.0] * len(names)]
    finally:
        held.unpersist()
    clustered = _with(scored, [centres]).withColumn("cluster", _nearest(names)[0]["c"]).drop("centres")
    means = clustered.groupBy("cluster").agg(F.round(F.avg("class_score"), 6).alias("mean"), F.min("class_score").alias("low"))
    order = means.select("cluster", (F.row_number().over(Window.orderBy("mean", "low")) - 1).alias("class_rank"))  # a row for each cluster
    tiers = F.array(*[F.lit(t) for t in TIERS])
    fitted = clustered.join(F.broadcast(order), "cluster").withColumn("tier", F.element_at(tiers, F.col("class_rank") + 1))
    return fitted.select(*rows.columns, "class_score", "class_rank", "tier")


def top_intersections(classed: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The most severe rows: by class, then severity; ties by tmc."""
    return classed.orderBy(F.desc("class_rank"), F.desc("severity_index"), "tmc").limit(params.top_intersections)


def reclassified(top: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Classes fitted anew on the chosen rows alone."""
    return multi_feature_classes(top.drop("class_score", "class_rank", "tier"), params)


def map_records(mapped: DataFrame, segments: DataFrame, vertices: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The map's segments as a renderer takes them: offset points, one region-wide class, labels.

    ``mapped`` is the table of map segments. The classes are fitted once over all its rows, so a
    class means the same severity in every part of it; rows without a severity are left out.
    """
    lines = geo.offset(geo.polylines(segments, vertices), params)
    classed = severity_classes(mapped, "severity", params)
    return classed.join(lines, "tmc").select(
        "bottleneck_id", "corridor_id", "segment_order", "tmc", display_name("road", "direction").alias("name"), "severity", "class_rank", "class_label", "width",
        long_date_label(F.col("worst_date")).alias("worst_date_label"), short_clock_label(F.col("worst_time")).alias("worst_time_label"), "points",
    )
