"""Event runs that go on where earlier ones ended.

Readings lie in folders by day. A table of completed corridor days is kept with the events: a run
makes the days that are missing there, reads their folders alone (the days reach the scan as a
partition filter at run time), writes their events as slices and then appends the days. A run that
is broken off in between makes its days again; days without events are done too. Events lie in
folders by day: a folder for each corridor day would be as many small files as there are of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators import events, observations, region
from ..params import DEFAULT, Params
from ..sources import sinks
from ..sources.scratch import materialise
from ..sources.tables import READINGS

DAY = ["corridor_id", "analysis_date"]
DONE = "corridor_id int, analysis_date date, events bigint, finished_at timestamp"
DATED = StructType([*READINGS, StructField("analysis_date", DateType())])


class EventRun:
    """Events below ``out`` of the readings at ``readings`` (Parquet by analysis_date) on the corridors of ``ordered``."""

    def __init__(self, spark: SparkSession, readings: str, out: str, ordered: DataFrame, definitions: DataFrame, params: Params = DEFAULT):
        self.spark, self.readings, self.out = spark, readings, out.rstrip("/")
        self.ordered, self.definitions, self.params = ordered, definitions, params

    def done(self) -> DataFrame:
        """The corridor days that earlier runs have completed."""
        return self._table("completed", StructType.fromDDL(DONE))

    def _table(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.out}/{name}") if sinks._exists(self.spark, f"{self.out}/{name}") else self.spark.createDataFrame([], schema)

    def pending(self, until: str | None = None) -> DataFrame:
        """(corridor_id, analysis_date, status) of all corridor days, up to a last day where one is given; status is todo or done.

        Days are the folders of the readings, so no reading is looked at.
        """
        days = self.spark.read.schema(DATED).parquet(self.readings).select("analysis_date").distinct()
        days = days.where(F.col("analysis_date") <= F.lit(until).cast("date")) if until else days
        corridors = self.ordered.agg(F.collect_set("corridor_id").alias("c"))  # one row, as long as the network
        pairs = days.crossJoin(F.broadcast(corridors)).select(F.explode("c").alias("corridor_id"), "analysis_date")
        known = self.done().select(*DAY).distinct().withColumn("known", F.lit(True))
        return pairs.join(known, DAY, "left").select(*DAY, F.when(F.col("known"), "done").otherwise("todo").alias("status"))

    def wanted(self, pending: DataFrame) -> DataFrame:
        """The readings of days with something to do: other folders aren't read."""
        days = pending.where("status = 'todo'").select("analysis_date").distinct()
        return self.spark.read.schema(DATED).parquet(self.readings).join(F.broadcast(days), "analysis_date", "left_semi")  # a row for each day

    def run(self, until: str | None = None) -> int:
        """Make what is missing; returns the number of corridor days made."""
        pending = materialise(self.pending(until), "pending")
        todo = materialise(pending.where("status = 'todo'").select(*DAY), "todo")
        count = todo.count()
        if not count:
            return 0
        joined = observations.corridor_readings(self.wanted(pending).drop("analysis_date"), self.ordered).join(todo, DAY, "left_semi")
        cells = materialise(events.grid(joined, self.params), "cells")
        made = materialise(region.active_events(events.summarised(events.event_cells(cells, self.params), cells, self.params), self.definitions), "events")
        sinks.overwrite_slices(made, f"{self.out}/events", todo, by=["analysis_date"])
        counts = made.groupBy(*DAY).agg(F.count(F.lit(1)).alias("events"))
        rows = todo.join(counts, DAY, "left").select("corridor_id", "analysis_date", F.coalesce("events", F.lit(0)).cast("long").alias("events"), F.current_timestamp().alias("finished_at"))
        rows.write.mode("append").parquet(f"{self.out}/completed")
        return count

    def again(self, days: DataFrame) -> None:
        """Forget that ``days`` (analysis_date) are done, because readings came late: the next run makes them anew."""
        kept = materialise(self.done().join(days, "analysis_date", "left_anti"), "completed")
        kept.write.mode("overwrite").parquet(f"{self.out}/completed")

    def events(self, schema: StructType) -> DataFrame:
        return self._table("events", schema)
