"""Golden grids for closing, cores and labels; events and hours."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadloom.operators import events, region

DAY = dt.date(2024, 1, 1)


def mask(spark, cells, width=8):
    return spark.createDataFrame([(1, DAY, s, o, width) for s, o in cells], "corridor_id int, analysis_date date, slot int, segment_order int, width int")


def cells_of(df, *more):
    return sorted((r.slot, r.segment_order, *[r[m] for m in more]) for r in df.collect())


def block(slots, orders):
    return [(s, o) for s in slots for o in orders]


def test_closing_fills_a_hole_and_keeps_a_block(spark):
    ring = [c for c in block(range(10, 15), range(2, 7)) if c != (12, 4)]
    assert cells_of(events.closed_mask(mask(spark, ring))) == block(range(10, 15), range(2, 7))


def test_border_cells_go(spark):
    # at the first segment and the first slot closing finds nothing outside
    assert cells_of(events.closed_mask(mask(spark, block(range(0, 4), range(1, 4))))) == block(range(1, 4), range(2, 4))
    assert cells_of(events.closed_mask(mask(spark, block(range(100, 105), [1, 2]), width=2))) == []
    assert cells_of(events.closed_mask(mask(spark, block([286, 287], range(2, 6))))) == block([286], range(2, 6))


def test_cores_and_bridge(spark):
    # two blocks joined by a bridge: one component, two cores, dealt to the nearer one
    shape = block(range(10, 13), range(2, 5)) + block(range(13, 18), [3]) + block(range(18, 21), range(2, 5))
    marked = events.closed_and_cores(mask(spark, shape))
    assert cells_of(marked.where("is_core")) == [(11, 3), (12, 3), (18, 3), (19, 3)]
    labels = {(s, o): n for s, o, n in cells_of(events.labelled_cells(marked), "label")}
    assert set(labels) == set(shape) and set(labels.values()) == {1, 2}
    assert [labels[(s, 3)] for s in range(10, 21)] == [1] * 6 + [2] * 5  # slot 15 is as far from both: the earlier core has it
    assert {n for _, _, n in cells_of(events.labelled_cells(marked.withColumn("is_core", F.lit(False))), "label")} == {1}


def test_diagonal_touch_is_one_component():
    slots, orders = np.array([5, 6, 9]), np.array([3, 4, 9])
    assert events.event_labels(slots, orders, np.zeros(3, bool)).tolist() == [1, 1, 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 7)), min_size=1, max_size=50, unique=True))
def test_components_against_a_walk(cells):
    grid = np.zeros((10, 8), bool)
    for s, o in cells:
        grid[s, o] = True
    got = events.components(grid)
    left, want = set(cells), {}
    while left:
        first = min(left)
        stack = [first]
        left.discard(first)
        while stack:
            s, o = stack.pop()
            want[(s, o)] = first[0] * 8 + first[1]
            for near in [(s + a, o + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]:
                if near in left:
                    left.discard(near)
                    stack.append(near)
    assert {c: got[c] for c in want} == want and (got[~grid] == -1).all()


def readings(spark, rows):
    schema = "corridor_id int, analysis_date date, segment_order int, tmc string, intersection string, miles double, measurement_tstamp timestamp_ntz, speed double, reference_speed double"
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(1, DAY, o, f"T{o}", f"X{o}", 0.5, start + dt.timedelta(minutes=m), v, r) for o, m, v, r in rows], schema)


def test_grid_takes_the_lowest_speed_on_the_slot(spark):
    rows = [(1, 5, 30.0, 60.0), (1, 5, 20.0, 60.0), (1, 5, None, 60.0), (1, 7, 1.0, 60.0), (2, 5, 10.0, 0.0), (9, 6, 1.0, 60.0)]
    got = {(r.slot, r.segment_order): (r.speed, r.observed, r.width) for r in events.grid(readings(spark, rows)).collect()}
    assert got == {(1, 1): (20.0, True, 9), (1, 2): (10.0, False, 9)}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(o, 5 * s, 20.0 if 100 <= s < 130 and 3 <= o <= 5 else 60.0, 60.0) for o in range(1, 9) for s in range(90, 140)]
    cells = events.grid(readings(spark, rows))
    marked = events.closed_and_cores(events.raw_mask(cells))
    return events.events(cells, events.labelled_cells(marked)).cache()


def test_one_event(found):
    (e,) = found.collect()
    assert (e.cell_count, e.segment_count, e.duration_minutes) == (90, 3, 150)
    assert (e.start_time, e.end_time) == (dt.datetime(2024, 1, 1, 8, 20), dt.datetime(2024, 1, 1, 10, 45))
    assert (e.first_tmc, e.last_tmc, e.corridor_start_mile, e.corridor_end_mile) == ("T3", "T5", 1.0, 2.5)
    assert e.maximum_contiguous_extent_miles == 1.5 and e.event_area_mile_hours == 3.75
    assert e.estimated_upstream_boundary_speed_mph == 0.0 and e.minimum_speed_ratio == 0.333


def test_hours_share_the_event(found):
    hours = {r.hour_of_day: r for r in region.by_hour(found).collect()}
    assert {h: r.total_duration_minutes for h, r in hours.items()} == {8: 40.0, 9: 60.0, 10: 45.0}
    # the end is the start of the last slot, so five minutes are in no hour
    assert sum(r.total_duration_minutes for r in hours.values()) == 145
    assert region.worst_day(found.limit(0)).count() == 0
