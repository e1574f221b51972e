"""Thresholds of the analysis, one object for all stages."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    #: a reading is congested below this share of its reference speed
    congestion_ratio: float = 0.70
    slot_minutes: int = 5
    slots: int = 288
    #: events: least cells, minutes, segments, contiguous miles; a slice counts at most so many miles
    event_cells: int = 6
    event_minutes: int = 10
    event_segments: int = 2
    event_miles: float = 0.25
    slice_miles: float = 5.0
    #: a day with so many congested minutes is an occurrence
    occurrence_minutes: int = 30
    #: recurring bottlenecks
    peak_height: float = 20.0
    peak_prominence: float = 10.0
    peak_distance: int = 3
    boundary_share: float = 0.5
    profile_days: int = 30
    bottleneck_miles: float = 5.0
    #: overnight test of arterial bottlenecks
    overnight_hours: tuple[int, ...] = (0, 1, 2, 3, 4)
    overnight_pct: float = 15.0
    corridor_segments: int = 3
    arterial_corridors: int = 25
    watch_collector: int = 25
    watch_local: int = 10
    aadt_norm: float = 100_000.0
    #: intersections
    top_intersections: int = 50
    intersection_miles: float = 1.5
    intersection_days: int = 30
    onset_share: float = 0.3
    classes: int = 5
    #: geometry
    offset_metres: float = 12.0
    metres_per_degree: float = 111_320.0
    quantum: float = 1e6


DEFAULT = Params()
