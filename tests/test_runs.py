"""Runs that go on where others ended, and the relational source."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadloom.plans.runs import EventRun
from roadloom.plans.warehouse import Warehouse
from roadloom.sources import database, fixtures, sinks
from roadloom.sources.scratch import materialise


def scan_metric(df, name):
    """A metric of the scans of an executed plan."""
    df.collect()

    def leaves(plan):
        kind = plan.getClass().getSimpleName()
        if "AdaptiveSparkPlan" in kind:
            return leaves(plan.executedPlan())
        if "QueryStage" in kind:
            return leaves(plan.plan())
        found = plan.collectLeaves()
        each = [found.apply(i) for i in range(found.size())]
        return [x for leaf in each for x in (leaves(leaf) if "QueryStage" in leaf.getClass().getSimpleName() else [leaf])]

    return [leaf.metrics().apply(name).value() for leaf in leaves(df._jdf.queryExecution().executedPlan()) if leaf.metrics().contains(name)]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    w = Warehouse.of(spark, sf_dir)
    path = str(tmp_path_factory.mktemp("readings") / "days")
    sinks.write_partitioned(w.readings.withColumn("analysis_date", F.to_date("measurement_tstamp")), path, "analysis_date")
    return w, path


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_a_second_run_makes_and_reads_the_missing_days_alone(spark, stored, tmp_path):
    w, path = stored
    run = EventRun(spark, path, str(tmp_path / "out"), w.stage("ordered"), w.stage("definitions"))
    days = sorted(r[0] for r in w.readings.select(F.to_date("measurement_tstamp")).distinct().collect())
    corridors = w.stage("ordered").select("corridor_id").distinct().count()
    assert run.run(until=str(days[9])) == 10 * corridors
    pending = materialise(run.pending(), "pending")
    assert pending.where("status = 'done'").count() == 10 * corridors
    assert scan_metric(run.wanted(pending).select("speed"), "numPartitions") == [len(days) - 10]
    assert run.run() == (len(days) - 10) * corridors and run.run() == 0
    schema = w.events.schema
    assert rows(run.events(schema)) == rows(w.events)
    assert run.done().count() == len(days) * corridors and run.done().agg(F.sum("events")).first()[0] == w.events.count()


def test_events_lie_in_a_folder_for_each_day(spark, sf_dir, stored, tmp_path):
    """Not for each corridor day; corridors that come later share it with those that are done."""
    w, path = stored
    ordered = w.stage("ordered")
    twice = materialise(ordered.unionByName(ordered.withColumn("corridor_id", F.col("corridor_id") + 1000)), "twice")
    definitions = w.stage("definitions").unionByName(w.stage("definitions").withColumn("corridor_id", F.col("corridor_id") + 1000))
    days = sorted(r[0] for r in w.readings.select(F.to_date("measurement_tstamp")).distinct().collect())
    for corridors in (ordered, twice):
        run = EventRun(spark, path, str(tmp_path / "out"), corridors, definitions)
        assert run.run(until=str(days[4])) > 0
    got = run.events(w.events.schema)
    first = rows(got.where("corridor_id < 1000"))
    assert first == rows(w.events.where(F.col("analysis_date") <= days[4]))
    assert first and got.count() == 2 * len(first)
    assert all(p.name.startswith("analysis_date=") for p in (tmp_path / "out" / "events").iterdir() if p.is_dir())


def test_a_run_that_is_broken_off_makes_its_days_again(spark, stored, tmp_path, monkeypatch):
    w, path = stored
    run = EventRun(spark, path, str(tmp_path / "out"), w.stage("ordered"), w.stage("definitions"))
    day = str(min(r[0] for r in w.readings.select(F.to_date("measurement_tstamp")).distinct().collect()))
    with monkeypatch.context() as m:
        m.setattr(sinks, "_swap_slices", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run.run(until=day)
    assert run.done().isEmpty()
    assert run.run(until=day) > 0
    first = w.events.where(F.col("analysis_date") == day)
    assert rows(run.events(w.events.schema)) == rows(first)


def test_late_readings_make_their_day_anew(spark, stored, tmp_path):
    w, path = stored
    run = EventRun(spark, path, str(tmp_path / "out"), w.stage("ordered"), w.stage("definitions"))
    days = sorted(r[0] for r in w.readings.select(F.to_date("measurement_tstamp")).distinct().collect())
    run.run(until=str(days[2]))
    run.again(spark.createDataFrame([(days[1],)], "analysis_date date"))
    assert {r.analysis_date for r in run.pending(str(days[2])).where("status = 'todo'").collect()} == {days[1]}


@pytest.fixture(scope="module")
def url(spark):
    return database.embedded(spark)


def test_filters_and_columns_reach_the_store(spark, sf_dir, url):
    source = fixtures.reading_table(spark, sf_dir)
    database.load(source, url, "readings", "tmc_code VARCHAR(16), data_density VARCHAR(8)")
    back = database.read_even(spark, url, "readings", "measurement_tstamp", 5)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, source.select(*back.columns).collect()), key=repr)
    slow = back.where("speed < 30 AND tmc_code = 'T000003'").select("tmc_code", "speed")
    plan = slow._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(speed,30.0)" in plan and "EqualTo(tmc_code" in plan and "data_density" not in plan and "Filter" not in plan.replace("PushedFilters", "")
    assert slow.count() == source.where("speed < 30 AND tmc_code = 'T000003'").count()


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp_ntz"])
def test_skewed_keys_are_read_in_even_shares(spark, url, kind):
    """Most keys at one end, null keys: equal ranges would leave one read nearly all rows."""
    number = F.when(F.col("id") % 50 == 0, F.col("id") * 1000).otherwise(F.col("id") % 700)
    key = {"int": number.cast("int"), "double": number.cast("double"), "date": F.date_add(F.lit(dt.date(2000, 1, 1)), (number % 30_000).cast("int")), "timestamp_ntz": F.timestamp_seconds(number + 1_000_000_000).cast("timestamp_ntz")}[kind]
    df = spark.range(4000).select("id", F.when(F.col("id") % 97 != 0, key).alias("k"))
    database.load(df, url, f"skewed_{kind}")
    back = database.read_even(spark, url, f"skewed_{kind}", "k", 4)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1300


def test_one_key_and_no_rows(spark, url):
    for name, df in (("t_same", spark.range(20).select(F.lit(5).alias("k"))), ("t_none", spark.range(0).select(F.col("id").alias("k"))), ("t_nulls", spark.range(3).select(F.lit(None).cast("int").alias("k")))):
        database.load(df, url, name)
        assert sorted(map(tuple, database.read_even(spark, url, name, "k", 4).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
