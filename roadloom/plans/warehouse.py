"""All stages over one pair of inputs, each a lazy DataFrame built on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import bottlenecks, characterise, events, geo, intersections, network, observations, profile, ranking, region
from ..params import DEFAULT, Params
from ..sources import fixtures
from ..sources.scratch import materialise


class Warehouse:
    """Tables of the analysis for all corridors and days.

    Build one from any segment and reading tables, or with ``of`` from a data folder. What several
    later stages read is written once to the shared scratch folder (``stage``), as the stages'
    tables would be; the rest stays lazy.
    """

    def __init__(self, segments: DataFrame, readings: DataFrame, polygons: DataFrame | None = None, params: Params = DEFAULT):
        self.segments, self.readings, self.params = segments, readings, params
        self._stages: dict[str, DataFrame] = {}
        self.polygons = fixtures.polygon_table(segments) if polygons is None else polygons

    def stage(self, name: str) -> DataFrame:
        """The table ``name`` from scratch files, written at the first call."""
        if name not in self._stages:
            self._stages[name] = materialise(getattr(self, name), name)
        return self._stages[name]

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        return cls(fixtures.segment_table(spark, sf_dir), fixtures.reading_table(spark, sf_dir))

    @cached_property
    def definitions(self) -> DataFrame:
        return network.registry(self.segments, self.params)

    @cached_property
    def ordered(self) -> DataFrame:
        return network.corridor_segments(self.stage("definitions"), self.segments)

    @cached_property
    def watched(self) -> DataFrame:
        return network.watch_list(self.segments, self.params)

    @cached_property
    def joined(self) -> DataFrame:
        return observations.corridor_readings(self.readings, self.stage("ordered"))

    @cached_property
    def daily(self) -> DataFrame:
        return profile.segment_daily(self.joined, self.params)

    @cached_property
    def profile(self) -> DataFrame:
        return profile.segment_profile(self.daily, self.params)

    @cached_property
    def extents(self) -> DataFrame:
        return bottlenecks.extents(self.stage("profile"), self.params)

    @cached_property
    def bottlenecks(self) -> DataFrame:
        return bottlenecks.bottlenecks(self.stage("extents"), self.stage("profile"), self.stage("definitions"), self.params)

    @cached_property
    def members(self) -> DataFrame:
        return bottlenecks.membership(self.stage("extents"), self.stage("profile"), self.stage("definitions"), self.params)

    @cached_property
    def queues(self) -> DataFrame:
        return characterise.queue_series(self.stage("bottlenecks"), self.stage("ordered"), self.readings, self.params)

    @cached_property
    def metrics(self) -> DataFrame:
        return characterise.daily_metrics(self.queues, self.params)

    @cached_property
    def annual(self) -> DataFrame:
        return ranking.annual_dashboard(self.stage("bottlenecks"), self.stage("metrics"))

    @cached_property
    def eligibility(self) -> DataFrame:
        return observations.overnight_share(self.stage("bottlenecks"), self.stage("ordered"), self.readings, self.params)

    @cached_property
    def ranked(self) -> DataFrame:
        return ranking.ranked_dashboard(self.annual, self.stage("definitions"), self.eligibility, self.stage("ordered"), self.segments, self.params)

    @cached_property
    def districts(self) -> DataFrame:
        return geo.districts_of(geo.midpoints(self.stage("ordered"), self.watched, self.segments), self.polygons)

    @cached_property
    def cells(self) -> DataFrame:
        return events.grid(self.joined, self.params)

    @cached_property
    def marked(self) -> DataFrame:
        return events.closed_and_cores(events.raw_mask(self.stage("cells"), self.params), self.params)

    @cached_property
    def labels(self) -> DataFrame:
        return events.event_cells(self.stage("cells"), self.params)

    @cached_property
    def events(self) -> DataFrame:
        return region.active_events(events.summarised(self.labels, self.stage("cells"), self.params), self.stage("definitions"))

    @cached_property
    def watch(self) -> DataFrame:
        return ranking.watch_metrics(self.watched, self.readings, self.params)

    @cached_property
    def extremes(self) -> DataFrame:
        return observations.extreme_hours(observations.hourly_curve_by_class(self.readings, self.segments))

    @cached_property
    def filled(self) -> DataFrame:
        return intersections.backfilled(self.segments)

    @cached_property
    def chosen(self) -> DataFrame:
        named = intersections.named_segments(self.filled, fixtures.named_road_table(self.segments))
        return intersections.combined(named, intersections.corridor_arterials(self.filled, self.stage("definitions"), self.stage("ordered")))

    @cached_property
    def hourly(self) -> DataFrame:
        return intersections.hourly_speeds(self.readings, self.stage("chosen"))

    @cached_property
    def day_speeds(self) -> DataFrame:
        return intersections.day_speeds(self.stage("hourly"), self.stage("extremes"), self.params)

    @cached_property
    def flagged(self) -> DataFrame:
        return intersections.flagged_hours(self.stage("hourly"), self.stage("extremes"), self.params)

    @cached_property
    def candidates(self) -> DataFrame:
        return intersections.candidates(self.stage("chosen"), intersections.characterisation(self.day_speeds, self.stage("flagged"), self.params), self.params)

    @cached_property
    def severity(self) -> DataFrame:
        return intersections.severity(intersections.grouped(self.candidates), self.params)
