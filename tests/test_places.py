"""Districts in bands of latitude, the topology document, states of a rollup, and readings in buckets."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from roadloom.operators import geo, observations, profile
from roadloom.plans.warehouse import Warehouse
from roadloom.sources import fixtures, sinks, topology

RING = "name string, file_order int, ring int, i int, x double, y double"


def ring(points, name="p", order=0, number=0):
    return [(name, order, number, i, float(x), float(y)) for i, (x, y) in enumerate([*points, points[0]])]


def inside(x, y, rings):
    """Even-odd over all edges, without bands."""
    n = 0
    for points in rings:
        for (x1, y1), (x2, y2) in zip(points, [*points[1:], points[0]], strict=True):
            n += ((y1 > y) != (y2 > y)) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n % 2 == 1


def star(n, r, seed, at=(0.0, 0.0)):
    rng = random.Random(seed)
    return [(at[0] + (k := r * rng.uniform(0.4, 1.0)) * math.cos(2 * math.pi * i / n), at[1] + k * math.sin(2 * math.pi * i / n)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_districts_equal_all_edges(spark, seed):
    """Odd outlines, a hole, overlapping polygons, level edges, points on heights of vertices."""
    rng = random.Random(seed)
    a, hole, b, box = star(300, 1.0, seed), star(40, 0.2, seed + 1), star(150, 0.8, seed + 2, (0.5, 0.3)), [(-2, -1), (2, -1), (2, 0.25), (-2, 0.25)]
    comb = [(x / 50, (-1) ** x * 1.5) for x in range(-100, 101)] + [(2, 2), (-2, 2)]
    shapes = [("a", [a, hole]), ("b", [b]), ("box", [box]), ("comb", [comb])]
    rows = [r for order, (name, rings) in enumerate(shapes) for k, points in enumerate(rings) for r in ring(points, name, order, k)]
    points = [(f"T{i}", rng.uniform(-2.1, 2.1), rng.uniform(-2.1, 2.1)) for i in range(300)] + [(f"V{i}", rng.uniform(-1, 1), y) for i, (_, y) in enumerate(a[:60] + box)]
    got = {r.tmc: r.cid_name for r in geo.districts_of(spark.createDataFrame([(t, float(y), float(x)) for t, x, y in points], "tmc string, lat double, lon double"), spark.createDataFrame(rows, RING)).collect()}
    want = {t: next((name for name, rings in shapes if inside(float(x), float(y), [[(float(p), float(q)) for p, q in r] for r in rings])), None) for t, x, y in points}
    assert got == want and len({*want.values()}) >= 4


def test_a_point_meets_few_edges_of_a_large_polygon(spark):
    """100,000 edges: the bands hold a few dozen each, and copies are few."""
    n = 100_000
    rows = spark.range(n + 1).select(F.lit("p").alias("name"), F.lit(0).alias("file_order"), F.lit(0).alias("ring"), F.col("id").cast("int").alias("i"), F.cos(2 * math.pi * F.col("id") / n).alias("x"), F.sin(2 * math.pi * F.col("id") / n).alias("y"))
    bands, edges = geo.banded(geo.ring_edges(rows))
    assert bands.first().bands == n // geo.BAND_EDGES
    sizes = [r["count"] for r in edges.groupBy("band").count().collect()]
    assert sum(sizes) <= (geo.COPIES + 1) * n and sorted(sizes)[len(sizes) // 2] < 50
    points = spark.createDataFrame([(f"T{i}", i / 1000, (i * 7 % 100) / 80) for i in range(100)], "tmc string, lat double, lon double")
    got = {r.tmc for r in geo.districts_of(points, rows).where("cid_name = 'p'").collect()}
    assert got == {f"T{i}" for i in range(100) if math.hypot(i / 1000, (i * 7 % 100) / 80) < 1}


def test_a_topology_document_is_one_json_text(spark, tmp_path):
    """Written by several tasks; equal lines share an arc; numbers lead back to each line."""
    lines = {f"T{i:03}": [(1000 + i % 20, 50), (3, -4), (0, i % 20)] for i in range(60)}
    arcs = spark.createDataFrame([(t, [list(p) for p in a]) for t, a in lines.items()], "tmc string, arc array<array<bigint>>").repartition(5)
    path = tmp_path / "document"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        topology.write_topology(arcs, str(path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = sorted(path.glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert len([p for p in parts if p.stat().st_size]) > 1 and document["type"] == "Topology" and len(document["arcs"]) == 20
    (sx, sy), (tx, ty) = document["transform"]["scale"], document["transform"]["translate"]
    want = set()
    for shape in document["objects"]["roads"]["geometries"]:
        x = y = 0
        for i, (dx, dy) in enumerate(document["arcs"][shape["arcs"][0]]):
            x, y = x + dx, y + dy
            want.add((shape["properties"]["tmc"], shape["arcs"][0], i, round(x * sx + tx, 9), round(y * sy + ty, 9)))
    got = {(r.tmc, r.arc, r.i, round(r.lon, 9), round(r.lat, 9)) for r in topology.read_topology(spark, str(path)).collect()}
    assert got == want and len(got) == 180
    for tmc, a in lines.items():
        assert [(lon, lat) for t, _, i, lon, lat in sorted(got) if t == tmc] == [(round(sum(p[0] for p in a[: k + 1]) / 1e6, 9), round(sum(p[1] for p in a[: k + 1]) / 1e6, 9)) for k in range(3)]


def test_late_readings_touch_their_day_alone(spark, sf_dir, tmp_path):
    w, path = Warehouse.of(spark, sf_dir), str(tmp_path / "states")
    readings = fixtures.reading_table(spark, sf_dir)
    day = F.to_date("measurement_tstamp") == F.lit(dt.date(2024, 1, 3))
    late = day & (F.col("data_density") == "R")
    states = lambda rows: observations.rollup_states(observations.observations(rows, w.segments))
    sinks.append_states(states(readings.where(~late)), path, "analysis_date")
    others = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    sinks.append_states(states(readings.where(late)), path, "analysis_date")
    fresh = {p for p in (tmp_path / "states").rglob("*.parquet")} - set(others)
    assert fresh and {p.parent.name for p in fresh} == {"analysis_date=2024-01-03"} and all(p.stat().st_mtime_ns == t for p, t in others.items())
    schema = states(readings).schema
    whole = sorted(map(tuple, observations.daily_rollup(observations.observations(readings, w.segments)).collect()), key=repr)
    table = lambda: sorted(map(tuple, observations.merged_rollup(spark.read.schema(schema).parquet(path)).collect()), key=repr)
    assert table() == whole
    sums = {"speed_sum", "speed_n", "speed_drop_sum", "speed_drop_n", "readings", "congested_readings"}

    def merge(df):
        return df.groupBy("tmc_code", "analysis_date").agg(*[(F.sum if c in sums else F.max)(c).alias(c) for c in schema.names[2:]])

    sinks.compact_states(path, spark.createDataFrame([(dt.date(2024, 1, 3),)], "analysis_date date"), merge, schema)
    assert table() == whole and all(p.stat().st_mtime_ns == t for p, t in others.items() if "2024-01-03" not in str(p))


def shuffled(df, scan):
    """Whether a shuffle of the plan lies above a scan whose line holds ``scan``."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            if any(scan in x for x in lines[i:below]):
                return True
    return False


def test_bucketed_readings_are_not_shuffled(spark, sf_dir, tmp_path):
    """Neither for the rollup nor for the days of corridors' segments, joins without broadcasts: only the network's tables move."""
    w = Warehouse.of(spark, sf_dir)
    plain = fixtures.reading_table(spark, sf_dir)
    readings = sinks.write_bucketed(plain, str(tmp_path / "buckets"), "tmc_code", 4, "measurement_tstamp")
    made = [
        lambda rows: observations.daily_rollup(observations.observations(rows, w.segments)),
        lambda rows: profile.segment_daily(observations.corridor_readings(rows, w.stage("ordered")), w.params),
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make in made:
            df = make(readings)
            assert not shuffled(df, "bucketed_") and shuffled(make(plain), "lineitem")
            assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, make(plain).select(*df.columns).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
