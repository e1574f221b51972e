"""Tables on disk, the run log, lookups, map records, and the classes' invariants."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.functions import columns as c
from roadloom.operators import classify, network
from roadloom.plans.queries import QUERIES
from roadloom.sources import sinks, tables


def test_slices_are_rewritten_or_cleared_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(k, d, v) for k in (1, 2, 3) for d in ("a b", "c/d", None) for v in (0, 1)], "k int, d string, v int")
    sinks.write_partitioned(old, path, "k", "d")
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "k=3").rglob("*.parquet")}
    slices = spark.createDataFrame([(1, "a b"), (1, "c/d"), (2, None)], "k int, d string")
    new = spark.createDataFrame([(1, "a b", 9)], "k int, d string, v int")
    for _ in range(2):  # again, with the same result
        sinks.overwrite_slices(new, path, slices)
        got = sorted(((r.k, r.d, r.v) for r in spark.read.parquet(path).collect()), key=repr)
        want = [(1, "a b", 9)] + [(k, d, v) for k in (1, 2, 3) for d in ("a b", "c/d", None) for v in (0, 1) if (k, d) not in ((1, "a b"), (1, "c/d"), (2, None))]
        assert got == sorted(want, key=repr)
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "k=3").rglob("*.parquet")}
    with pytest.raises(ValueError):
        sinks.overwrite_slices(old, path, slices)


def test_slices_share_a_folder(spark, tmp_path):
    """Slices by two keys in folders by one: the folder's other slices stay, null and empty keys too."""
    path = str(tmp_path / "t")
    types = "k int, s string, d string, v int"
    old = spark.createDataFrame([(k, s, d, v) for k in (1, 2, None) for s in ("", None) for d in ("a b", "c", None, "e") for v in (0, 1)], types)
    sinks.write_partitioned(old, path, "d")
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=e").rglob("*.parquet")}
    gone = [(1, "", "a b"), (None, None, "a b"), (2, None, ""), (7, "x", "new"), *[(k, s, "c") for k in (1, 2, None) for s in ("", None)]]
    new = spark.createDataFrame([(1, "", "a b", 9), (7, "x", "new", 5)], types)
    want = [(1, "", "a b", 9), (7, "x", "new", 5)] + [r for r in map(tuple, old.collect()) if r[:3] not in [(k, s, d or None) for k, s, d in gone]]
    for _ in range(2):  # again, with the same result
        sinks.overwrite_slices(new, path, spark.createDataFrame(gone, "k int, s string, d string"), by=["d"])
        got = [tuple(r) for r in spark.read.schema(types).parquet(path).select("k", "s", "d", "v").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert not (tmp_path / "t" / "d=c").exists() and untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=e").rglob("*.parquet")}
    with pytest.raises(ValueError):
        sinks.overwrite_slices(new.withColumn("k", F.lit(5)), path, spark.createDataFrame(gone, "k int, s string, d string"), by=["d"])
    empty = str(tmp_path / "none")  # a table that isn't there yet
    sinks.overwrite_slices(new, empty, new.select("k", "s", "d"), by=["d"])
    assert spark.read.parquet(empty).count() == 2


@pytest.mark.parametrize("name", ["s5_replace_slice", "s6_cascade_children"])
def test_folders_dont_grow_with_corridors(spark, tmp_path, monkeypatch, name):
    """At sf0.01 four corridors of 40 days: 160 folders by corridor day."""
    paths = []
    write = sinks.write_partitioned

    def noted(df, path, *keys, **options):
        write(df, path, *keys, **options)
        paths.append((path, keys))

    monkeypatch.setattr(sinks, "write_partitioned", noted)
    QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert paths and not any("corridor_id" in keys for _, keys in paths)


def test_slices_may_be_made_from_their_own_table(spark, tmp_path):
    """Also where the new rows leave some slices empty; null and empty text are the same slice."""
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(d, v) for d in ("a", "b", "c", None) for v in (1, 2)], "d string, v int")
    sinks.write_partitioned(old, path, "d")
    table = spark.read.schema("v int, d string").parquet(path)
    slices = spark.createDataFrame([("a",), ("b",), ("",)], "d string")
    sinks.overwrite_slices(table.where("d = 'a' or d is null").withColumn("v", F.col("v") * 10), path, slices)
    got = sorted(((r.d, r.v) for r in spark.read.schema("v int, d string").parquet(path).collect()), key=repr)
    assert got == sorted([("a", 10), ("a", 20), ("c", 1), ("c", 2), (None, 10), (None, 20)], key=repr)


def test_a_broken_change_is_finished_later(spark, tmp_path, monkeypatch):
    """Broken off before, while and after rows are swapped: the next call ends with the announced rows, whatever its own are made from."""
    slices = spark.createDataFrame([("a",), ("b",)], "d string")
    for step in ("write", "delete"):
        path = str(tmp_path / step)
        sinks.write_partitioned(spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "d string, v int"), path, "d")
        new = spark.read.schema("v int, d string").parquet(path).where("d = 'a'").withColumn("v", F.col("v") + 1)
        with monkeypatch.context() as m:
            if step == "write":
                original, calls = sinks.write_partitioned, []

                def once(df, to, *keys, **kw):
                    calls.append(to)
                    if to == path:
                        raise OSError("lost")
                    original(df, to, *keys, **kw)

                m.setattr(sinks, "write_partitioned", once)
            else:
                m.setattr(sinks, "_folder", lambda *a: 1 / 0)
            with pytest.raises((OSError, ZeroDivisionError)):
                sinks.overwrite_slices(new, path, slices)
        assert sinks.finish(spark, path) and not sinks.finish(spark, path)
        assert sorted(map(tuple, spark.read.schema("v int, d string").parquet(path).select("d", "v").collect())) == [("a", 2), ("c", 1)]


def test_merging_rewrites_the_touched_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(k, f"k{k}", k) for k in range(800)] + [(None, None, -1)], "k int, s string, v int")
    old.repartitionByRange(8, "k").write.parquet(path)
    before = {p.name for p in (tmp_path / "t").glob("*.parquet")}
    assert len(before) == 8
    new = spark.createDataFrame([(5, "k5", 1), (6, "other", 1), (7, "k7", 2), (7, "k7", 3), (None, None, 9), (9000, "new", 4)], "k int, s string, v int")
    assert sinks.merge_files(new, path, ["k", "s"]) == 1
    want = sorted([tuple(r) for r in old.collect() if (r.k, r.s) not in ((5, "k5"), (7, "k7"), (None, None))] + [tuple(r) for r in new.collect()], key=repr)
    got = lambda: sorted((tuple(r) for r in spark.read.schema("k int, s string, v int").parquet(path).collect()), key=repr)
    assert got() == want
    assert len(before & {p.name for p in (tmp_path / "t").glob("*.parquet")}) == 7
    assert sinks.merge_files(new, path, ["k", "s"]) >= 1 and got() == want  # again
    assert sinks.merge_files(new.limit(0), path, ["k", "s"]) == 0 and got() == want
    own = spark.read.schema("k int, s string, v int").parquet(path).where("k < 3").withColumn("v", F.lit(7))
    sinks.merge_files(own, path, ["k", "s"])  # made from the table itself
    assert got() == sorted([(*r[:2], 7) if r[0] in (0, 1, 2) else r for r in want], key=repr)


def test_a_broken_merge_is_finished_later(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(k, 0) for k in range(100)], "k int, v int").repartitionByRange(4, "k").write.parquet(path)
    new = spark.createDataFrame([(3, 1), (99, 1), (200, 1)], "k int, v int")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_swap_files", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.merge_files(new, path, ["k"])
    assert spark.read.parquet(path).count() == 100  # as it was
    assert sinks.finish(spark, path)
    assert sorted(map(tuple, spark.read.schema("k int, v int").parquet(path).collect())) == [(k, int(k in (3, 99))) for k in range(100)] + [(200, 1)]


def test_a_large_day_is_no_single_task(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") < 100, "small").otherwise("large").alias("day"))
        sinks.write_partitioned(rows, str(tmp_path / "t"), "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "day=large").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_the_log_has_failures_too(spark, tmp_path):
    log = str(tmp_path / "log")
    table = spark.createDataFrame([(1,), (1,), (2,)], "corridor_id int")

    def broken():
        raise ValueError("no readings " + "x" * 5000)

    assert sinks.run_logged(spark, log, "one", lambda: table) is table
    assert sinks.run_logged(spark, log, "two", broken) is None
    rows = sorted(sinks.read_log(spark, log).collect(), key=lambda r: (r.stage, r.corridor_id or 0))
    assert [(r.stage, r.corridor_id, r.rows_written, r.status) for r in rows] == [("one", 1, 2, "success"), ("one", 2, 1, "success"), ("two", None, 0, "error")]
    assert rows[2].detail.startswith("ValueError: no readings") and len(rows[2].detail) == 2000 and all(r.finished_at >= r.started_at for r in rows)


def test_corridors_by_name(spark):
    rows = spark.createDataFrame([(1, "I-75/I-85", "NORTHBOUND", "Downtown Connector", "Interstate", True), (2, "SR-9", "EASTBOUND", "SR-9", "Arterial", False)], "corridor_id int, road string, direction string, corridor_name string, corridor_group string, is_active boolean")
    assert [(r.corridor_id, r.slug) for r in network.active_corridors(rows).collect()] == [(1, "i-75-i-85-no")]
    assert network.active_corridors(rows, group="Arterial").isEmpty() and network.active_corridors(rows, only=("I-75/I-85", "NORTHBOUND")).count() == 1
    assert network.corridor(rows, "SR-9", "EASTBOUND").slug == "sr-9-ea"
    with pytest.raises(LookupError):
        network.corridor(rows, "SR-9", "WESTBOUND")


def test_new_columns_have_their_default(spark):
    rows = spark.createDataFrame([(1, None), (2, 5)], "k int, a int")
    assert sorted(map(tuple, tables.with_new_columns(rows, a=7, b="x").collect())) == [(1, 7, "x"), (2, 5, "x")]


def features(spark, n, seed=1, **fixed):
    rng = random.Random(seed)
    rows = [(f"T{i}", *(fixed.get(name, rng.gauss(5.0 * (i % 5), 0.3)) for name, _ in classify.FEATURES), float(rng.randrange(100))) for i in range(n)]
    return spark.createDataFrame(rows, "tmc string, speed_drop_ratio double, occurrence_pct double, aadt double, annual_queue_mile_hours double, severity_index double")


def classes(df):
    return {r.tmc: (r.class_rank, r.tier, round(r.class_score, 9)) for r in classify.multi_feature_classes(df).collect()}


def test_classes_follow_the_rows_and_their_scores(spark):
    df = features(spark, 60, speed_drop_ratio=0.5)  # one feature without variance
    got = classes(df)
    assert len(got) == 60 and {k for k, _, _ in got.values()} == set(range(5))
    assert got == classes(df.orderBy(F.desc("tmc")).repartition(3))
    means = [sum(s for k, _, s in got.values() if k == n) / sum(k == n for k, _, _ in got.values()) for n in range(5)]
    assert means == sorted(means) and all(t == classify.TIERS[k] for k, t, _ in got.values())


def test_classes_of_few_and_of_no_rows(spark):
    assert {k for k, _, _ in classes(features(spark, 3)).values()} == {0, 1, 2}
    assert [k for k, _, _ in classes(features(spark, 1)).values()] == [0]
    assert classes(features(spark, 0)) == {}


def test_top_rows_are_classed_anew(spark):
    classed = classify.multi_feature_classes(features(spark, 80))
    top = classify.top_intersections(classed)
    rows = top.collect()
    assert len(rows) == 50 and min(r.class_rank for r in rows) >= sorted(r.class_rank for r in classed.collect())[-50]
    again = classify.reclassified(top).collect()
    assert {r.tmc for r in again} == {r.tmc for r in rows} and {r.class_rank for r in again} == set(range(5))


def best_cost(values, k):
    """The least sum of squares over all partitions of sorted values into k runs."""
    values = sorted(values)
    n = len(values)

    def cost(a, b):
        part = values[a:b]
        mean = sum(part) / len(part)
        return sum((v - mean) ** 2 for v in part)

    least = [cost(0, b) if b else 0.0 for b in range(n + 1)]
    for _ in range(k - 1):
        least = [0.0] + [min(least[a] + (cost(a, b) if a < b else 0.0) for a in range(b)) for b in range(1, n + 1)]
    return least[n]


@pytest.mark.parametrize("seed, n, places", [(1, 60, 2), (2, 60, 2), (3, 40, 0), (4, 9, -1), (5, 5, 2), (6, 3, 2)])
def test_severity_classes_are_the_best_partition(spark, seed, n, places):
    """With ties and with fewer distinct values than classes."""
    rng = random.Random(seed)
    values = [round(rng.lognormvariate(3, 1.5), places) for _ in range(n)] + [7.5] * 3
    rows = classify.severity_classes(spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, v double"), "v").collect()
    groups = [[r.v for r in rows if r.class_rank == k] for k in range(5)]
    groups = [g for g in groups if g]
    assert len(rows) == len(values) and len(groups) == min(5, len(set(values))) and {r.class_label for r in rows} == {f"{min(g):,.0f}–{max(g):,.0f}" for g in groups}
    assert all(max(a) < min(b) for a, b in zip(groups, groups[1:], strict=False))
    got = sum(sum((v - sum(g) / len(g)) ** 2 for v in g) for g in groups)
    assert got == pytest.approx(best_cost(values, len(groups)), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("seed", range(20))
def test_runs_equal_a_full_search(seed):
    rng = random.Random(seed)
    values = sorted(rng.sample(range(200), rng.randrange(1, 25)))
    counts = [rng.choice([1, 1, 2, 50]) for _ in values]
    k = rng.randrange(1, min(6, len(values)) + 1)
    ends = classify.runs(values, counts, k)
    assert ends[-1] == len(values) and all(a < b for a, b in zip([0, *ends], ends, strict=False)) and len(ends) == k
    flat = lambda a, b: [v for v, c in zip(values[a:b], counts[a:b], strict=True) for _ in range(c)]
    spread = lambda part: sum((v - sum(part) / len(part)) ** 2 for v in part)
    assert sum(spread(flat(a, b)) for a, b in zip([0, *ends], ends, strict=False)) == pytest.approx(best_cost(flat(0, len(values)), k), rel=1e-9, abs=1e-9)


def test_tiers_cost_little_more_than_many_random_starts(spark):
    """Lloyd steps from 200 random starts on the same standardised features."""
    df = features(spark, 90, seed=4)
    rows = classify.multi_feature_classes(df).toPandas()
    x = rows[[n for n, _ in classify.FEATURES]].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    cost = sum(((x[rows.class_rank == k] - x[rows.class_rank == k].mean(0)) ** 2).sum() for k in range(5))
    rng, best = np.random.default_rng(0), np.inf
    for _ in range(200):
        centres = x[rng.choice(len(x), 5, replace=False)]
        for _ in range(60):
            near = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
            centres = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(5)])
        best = min(best, ((x[:, None] - centres) ** 2).sum(2).min(1).sum())
    assert cost <= 1.02 * best


def test_map_records(spark):
    mapped = spark.createDataFrame([(b, 1, s, f"T{s}", "I-285", "CLOCKWISE", v, None, None, 5.0) for b, s, v in ((1, 1, 10.0), (1, 2, 10.0), (2, 3, 900.0), (3, 4, None))], "bottleneck_id int, corridor_id int, segment_order int, tmc string, road string, direction string, severity double, worst_date date, worst_time timestamp_ntz, width double")
    segments = spark.createDataFrame([(f"T{s}", 33.0, -84.0 + s, 33.1, -84.0 + s) for s in range(1, 5)], "tmc string, start_latitude double, start_longitude double, end_latitude double, end_longitude double")
    vertices = spark.createDataFrame([("T1", i, -83.0, 33.0 + i / 30) for i in range(4)], "tmc string, i int, lon double, lat double")
    got = {r.tmc: r for r in classify.map_records(mapped, segments, vertices).collect()}
    assert {t: r.class_rank for t, r in got.items()} == {"T1": 0, "T2": 0, "T3": 1}
    assert (got["T1"].name, got["T1"].worst_date_label, got["T1"].worst_time_label) == ("I-285 CW", "N/A", "N/A")
    assert len(got["T1"].points) == 4 and len(got["T2"].points) == 2 and got["T2"].points[0].lon > -82.0


def test_names_for_maps(spark):
    row = spark.createDataFrame([("I-75/I-85", "NORTHBOUND")], "r string, d string").select(c.display_name("r", "d").alias("n"), c.slug("r", "d").alias("s")).first()
    assert (row.n, row.s) == ("I-75/I-85 NB", "i-75-i-85-no")
