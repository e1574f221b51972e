"""Congestion events on each corridor day's grid of 5-minute slots and segments.

Cells are sparse rows. Masks, cores and labels of a corridor day are made in one group function on
its dense grid (at most 288 slots by the corridor's segments), so the stored grid is shuffled once
for them; the events then need one more shuffle by corridor day, of the closed cells alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ratio, rounded
from ..params import DEFAULT, Params

DAY = ["corridor_id", "analysis_date"]
CELL = [*DAY, "slot", "segment_order"]
CELL_TYPES = "corridor_id int, analysis_date date, slot int, segment_order int"


def grid(joined: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One row for each cell: readings exactly on a slot, of several the one with the lowest speed.

    width is the largest segment order seen on that corridor day, by whatever reading.
    """
    minute = F.hour("measurement_tstamp") * 60 + F.minute("measurement_tstamp")
    slot = F.when(minute % params.slot_minutes == 0, minute / params.slot_minutes).cast("int")
    first = F.struct(F.col("speed").isNull(), "speed", F.col("reference_speed").isNull(), -F.col("reference_speed"))
    # dealt by corridor day, which serves the aggregation and the window; readings off the slots have a cell of their own, for the width
    rows = joined.withColumn("slot", slot).repartition(*DAY)
    cells = rows.groupBy(*CELL).agg(
        F.min_by("speed", first).alias("speed"), F.min_by("reference_speed", first).alias("reference_speed"),
        F.max("tmc").alias("tmc"), F.max("intersection").alias("intersection"), F.max(F.coalesce("miles", F.lit(0.0))).alias("miles"),
    )
    width = F.max("segment_order").over(Window.partitionBy(*DAY))
    seen = F.col("speed").isNotNull() & F.coalesce(F.col("reference_speed") > 0, F.lit(False))
    named = cells.withColumn("width", width).where("slot is not null").select(*CELL, "speed", "reference_speed", "width", "tmc", "intersection", "miles")
    return named.withColumns({"observed": seen, "ratio": F.when(seen, ratio())})


def _hot(params: Params) -> Column:
    return F.col("observed") & (F.col("ratio") < params.congestion_ratio)


def raw_mask(cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The observed cells below the congestion ratio."""
    return cells.where(_hot(params)).select(*CELL, "width")


def _cross(mask: np.ndarray) -> list[np.ndarray]:
    """The mask and its moves by one cell along each side; beyond the grid nothing is set."""
    edge = np.pad(mask, 1)
    return [mask, edge[:-2, 1:-1], edge[2:, 1:-1], edge[1:-1, :-2], edge[1:-1, 2:]]


def dilated(mask: np.ndarray) -> np.ndarray:
    return np.logical_or.reduce(_cross(mask))


def eroded(mask: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce(_cross(mask))


def closed(mask: np.ndarray) -> np.ndarray:
    """Closing by a cross: dilate within the grid, then erode. The border cells always go."""
    return eroded(dilated(mask))


def _dense(rows: pd.DataFrame, width: int, params: Params) -> np.ndarray:
    """The cells ``rows`` as a boolean grid of slots by segments."""
    mask = np.zeros((params.slots, width), bool)
    slots, orders = rows["slot"].to_numpy(), rows["segment_order"].to_numpy()
    within = (slots >= 0) & (slots < params.slots) & (orders >= 1) & (orders <= width)
    mask[slots[within], orders[within] - 1] = True
    return mask


def _cells(rows: pd.DataFrame, mask: np.ndarray) -> pd.DataFrame:
    """The set cells of a corridor day's grid, by slot, then segment."""
    slots, columns = np.nonzero(mask)
    day = rows[DAY].iloc[[0] * len(slots)].reset_index(drop=True)
    return day.assign(slot=slots.astype("int32"), segment_order=(columns + 1).astype("int32"))


def closed_mask(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The closed cells of each corridor day, with its width."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        width = int(rows["width"].max())
        return _cells(rows, closed(_dense(rows, width, params))).assign(width=np.int32(width))

    return raw.groupBy(*DAY).applyInPandas(run, f"{CELL_TYPES}, width int")


def closed_and_cores(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The closed cells with a flag for the cores, which a further erosion leaves."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = closed(_dense(rows, int(rows["width"].max()), params))
        return _cells(rows, whole).assign(is_core=eroded(whole)[whole])

    return raw.groupBy(*DAY).applyInPandas(run, f"{CELL_TYPES}, is_core boolean")


def components(mask: np.ndarray) -> np.ndarray:
    """For each cell of a boolean grid the smallest flat index of its 8-neighbour component, or -1."""
    height, width = mask.shape
    label = np.where(mask, np.arange(height * width).reshape(mask.shape), height * width)
    while True:
        padded = np.pad(label, 1, constant_values=height * width)
        low = np.min([padded[1 + a : 1 + a + height, 1 + b : 1 + b + width] for a in (-1, 0, 1) for b in (-1, 0, 1)], axis=0)
        low = np.where(mask, low, height * width)
        # jump: a label names a cell, whose own label may be lower still
        flat = np.append(low.ravel(), height * width)
        low = flat[low]
        if (low == label).all():
            return np.where(mask, label, -1)
        label = low


def event_labels(slots: np.ndarray, orders: np.ndarray, cores: np.ndarray) -> np.ndarray:
    """Labels from 1 for the closed cells of one corridor day.

    A component with several cores is dealt to its nearest core by straight distance; ties go to
    the core cell first by slot, then segment. Labels follow the components' first cells, then the
    cores' first cells.
    """
    top, left = slots.min(), orders.min()
    shape = (int(slots.max() - top) + 1, int(orders.max() - left) + 1)
    mask, core = np.zeros(shape, bool), np.zeros(shape, bool)
    s, o = (slots - top).astype(int), (orders - left).astype(int)
    mask[s, o] = True
    core[s[cores], o[cores]] = True
    whole, inner = components(mask)[s, o], components(core)
    owner = np.full(len(s), -1)
    by_component = np.argsort(whole, kind="stable")
    for cells in np.split(by_component, np.flatnonzero(np.diff(whole[by_component])) + 1):
        kernel = cells[cores[cells]]
        kernel = kernel[np.lexsort((o[kernel], s[kernel]))]
        names = inner[s[kernel], o[kernel]]
        if len(np.unique(names)) < 2:
            continue
        for part in np.array_split(cells, max(1, len(cells) * len(kernel) // 2_000_000)):
            apart = (s[part, None] - s[None, kernel]) ** 2 + (o[part, None] - o[None, kernel]) ** 2
            owner[part] = names[apart.argmin(axis=1)]
    _, label = np.unique(np.stack([whole, owner], axis=1), axis=0, return_inverse=True)
    return label.ravel() + 1


def labelled_cells(marked: DataFrame) -> DataFrame:
    """The closed cells with their event label; one corridor day's cells are one group."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        label = event_labels(rows["slot"].to_numpy(), rows["segment_order"].to_numpy(), rows["is_core"].to_numpy())
        return rows[CELL].assign(label=label.astype("int32"))

    return marked.groupBy(*DAY).applyInPandas(run, f"{CELL_TYPES}, label int")


#: What an event's cell carries besides its place and label; null where nothing was read.
VALUES = ["speed", "reference_speed", "ratio", "miles", "start_mile", "end_mile"]
#: Cells of an output batch, about.
BATCH_ROWS = 20_000


def _corridor_days(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each corridor day in turn, from rows sorted by it; one that goes on in the next batch is held back."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        table = {n: (c.cast(pa.int32()) if pa.types.is_date(c.type) else c).to_numpy(zero_copy_only=False) for n, c in zip(names, batch.columns, strict=True)}
        if held is not None:
            table = {n: np.concatenate([held[n], table[n]]) for n in names}
        if not batch.num_rows:
            continue
        ids, days = table[DAY[0]], table[DAY[1]]
        starts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (days[1:] != days[:-1])))
        for start, stop in zip(starts, starts[1:], strict=False):
            yield {n: v[start:stop] for n, v in table.items()}
        held = {n: v[starts[-1] :] for n, v in table.items()}
    if held is not None:
        yield held


def _day_values(day: dict[str, np.ndarray], slots: np.ndarray, orders: np.ndarray, shape: tuple[int, int]) -> list[np.ndarray]:
    """VALUES of the cells (slots, orders) of a corridor day; NaN where nothing was read."""
    at = day["slot"], day["segment_order"] - 1
    found = []
    for name in VALUES[:3]:
        grid = np.full(shape, np.nan)
        grid[at] = day[name]
        found.append(grid[slots, orders - 1])
    length = np.full(shape[1], -np.inf)
    np.maximum.at(length, at[1], day["miles"])
    seen = np.isfinite(length)
    end = np.cumsum(np.where(seen, length, 0.0))
    length, end = np.where(seen, length, np.nan), np.where(seen, end, np.nan)
    return [*found, *(x[orders - 1] for x in (length, end - length, end))]


def event_cells(cells: DataFrame, params: Params = DEFAULT, values: bool = True) -> DataFrame:
    """The closed cells with their label and, where wanted, VALUES, from a corridor day's cells in one step.

    Raw mask, closing, cores, labels and mileposts all need the corridor day whole and nothing
    else, so the grid is shuffled by it once; days follow each other in a sorted partition, many to
    a batch.
    """
    wanted = VALUES if values else []
    names = [*CELL, "width", "hot", *([*VALUES[:3], "miles"] if values else [])]
    kinds = [pa.int32(), pa.date32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * len(wanted)]
    schema = pa.schema(list(zip([*CELL, "label", *wanted], kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        rows = 0

        def record() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            # NaN is what isn't there
            return pa.RecordBatch.from_arrays([pa.array(c, k if k != pa.date32() else pa.int32(), from_pandas=True).cast(k) for c, k in zip(columns, kinds, strict=True)], schema=schema)

        for day in _corridor_days(batches, names):
            shape = params.slots, int(day["width"][0])
            hot = day["hot"].astype(bool)
            mask = np.zeros(shape, bool)
            mask[day["slot"][hot], day["segment_order"][hot] - 1] = True
            whole = closed(mask)
            if not whole.any():
                continue
            slots, columns = np.nonzero(whole)
            orders = columns + 1
            place = [np.full(len(slots), day[k][0], "int32") for k in DAY] + [slots.astype("int32"), orders.astype("int32")]
            parts.append([*place, event_labels(slots, orders, eroded(whole)[whole]).astype("int32"), *(_day_values(day, slots, orders, shape) if values else [])])
            rows += len(slots)
            if rows >= BATCH_ROWS:
                yield record()
                parts, rows = [], 0
        if parts:
            yield record()

    narrow = cells.withColumn("hot", _hot(params)).select(*names)
    dealt = narrow.repartition(*DAY).sortWithinPartitions(*DAY)
    return dealt.mapInArrow(run, f"{CELL_TYPES}, label int{''.join(f', {v} double' for v in wanted)}")


def mileposts(cells: DataFrame) -> DataFrame:
    """Start and end mile of each segment seen on a corridor day, from the lowest order up."""
    seen = cells.groupBy(*DAY, "segment_order").agg(F.max("miles").alias("miles"), F.max("tmc").alias("tmc"), F.max("intersection").alias("intersection"))
    end = F.sum("miles").over(Window.partitionBy(*DAY).orderBy("segment_order").rowsBetween(Window.unboundedPreceding, 0))
    return seen.withColumn("end_mile", end).withColumn("start_mile", F.col("end_mile") - F.col("miles"))


def with_values(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled cells with VALUES, joined from the grid and its mileposts."""
    posts = mileposts(cells).select(*DAY, "segment_order", "miles", "start_mile", "end_mile")
    return labels.join(cells.select(*CELL, "speed", "reference_speed", "ratio"), CELL, "left").join(posts, [*DAY, "segment_order"], "left").select(*CELL, "label", *VALUES)


def _runs(rows: DataFrame) -> DataFrame:
    """Unbroken rows of segments of each event and slot, with sums of what their cells carry.

    All keys begin with the corridor day, so one shuffle by it serves every window and aggregate
    from here to the event.
    """
    dealt = rows.repartition(*DAY).withColumn("drop", F.col("reference_speed") - F.col("speed"))
    island = F.col("segment_order") - F.row_number().over(Window.partitionBy(*DAY, "label", "slot").orderBy("segment_order"))
    fresh = F.row_number().over(Window.partitionBy(*DAY, "label", "segment_order").orderBy("slot")) == 1
    return dealt.withColumns({"run": island, "fresh": fresh}).groupBy(*DAY, "label", "slot", "run").agg(
        F.sum(F.coalesce("miles", F.lit(0.0))).alias("length"), F.min(F.struct("segment_order", "start_mile")).alias("low"), F.max(F.struct("segment_order", "end_mile")).alias("high"),
        F.count(F.lit(1)).alias("cells"), F.count_if("fresh").alias("segments"), F.min("ratio").alias("lowest"), F.max("drop").alias("most"),
        *[x for v in ("speed", "ratio", "drop") for x in (F.sum(v).alias(f"{v}_sum"), F.count(v).alias(f"{v}_n"))],
    )


SUMS = ["cells", "segments", *[f"{v}_{x}" for v in ("speed", "ratio", "drop") for x in ("sum", "n")]]


def _slices(rows: DataFrame) -> DataFrame:
    """Each event's slots: longest run, total miles, both ends and the sums of the runs."""
    return _runs(rows).groupBy(*DAY, "label", "slot").agg(
        F.max("length").alias("run_miles"), F.sum("length").alias("total_miles"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("lowest").alias("lowest"), F.max("most").alias("most"), *[F.sum(x).alias(x) for x in SUMS],
    )


def slices(rows: DataFrame) -> DataFrame:
    """Each event's slots: total miles, longest contiguous run, first segment and its start mile."""
    return _slices(rows).select(*DAY, "label", "slot", "run_miles", "total_miles", F.col("low.segment_order").alias("first_order"), F.col("low.start_mile").alias("upstream_mile"))


def events(cells: DataFrame, labels: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The retained events of each corridor day: see ``summarised``; labels are joined to the grid."""
    return summarised(with_values(cells, labels), cells, params)


def summarised(rows: DataFrame, cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The retained events of labelled cells with VALUES, numbered by label on each corridor day.

    Closing adds cells that nothing was observed in: they count as cells, but not in averages. The
    end time is the start of the last slot. Names of segments come from ``cells``.
    """
    hours = F.col("slot") * params.slot_minutes / 60.0
    upstream = F.col("low.start_mile")
    slope = F.when((F.count(F.lit(1)) >= 3) & (F.count(upstream) == F.count(F.lit(1))), F.regr_slope(upstream, hours))

    def mean(of: str) -> Column:
        return F.sum(f"{of}_sum") / F.nullif(F.sum(f"{of}_n"), F.lit(0))

    found = _slices(rows).groupBy(*DAY, "label").agg(
        F.sum("cells").alias("cell_count"), F.count(F.lit(1)).alias("slots"), F.sum("segments").alias("segment_count"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("run_miles").alias("run_miles"), F.max("total_miles").alias("total_miles"),
        F.sum(F.least("total_miles", F.lit(params.slice_miles))).alias("sliced"), slope.alias("slope"),
        mean("speed").alias("speed"), F.min("lowest").alias("lowest"), mean("ratio").alias("ratio"), mean("drop").alias("drop"), F.max("most").alias("most"),
    )
    minutes = F.col("slots") * params.slot_minutes
    kept = found.where(
        (F.col("cell_count") >= params.event_cells) & (minutes >= params.event_minutes) & (F.col("segment_count") >= params.event_segments) & (F.least("run_miles", F.lit(params.slice_miles)) >= params.event_miles)
    ).withColumn("event_id", F.row_number().over(Window.partitionBy(*DAY).orderBy("label")))
    kept = kept.withColumns({"first_segment_order": F.col("low.segment_order"), "last_segment_order": F.col("high.segment_order")})
    # as large as the network
    names = cells.groupBy("corridor_id", "segment_order").agg(F.max("tmc").alias("tmc"), F.max("intersection").alias("intersection"))
    first = names.select("corridor_id", F.col("segment_order").alias("first_segment_order"), F.col("tmc").alias("first_tmc"), F.col("intersection").alias("first_intersection"))
    last = names.select("corridor_id", F.col("segment_order").alias("last_segment_order"), F.col("tmc").alias("last_tmc"), F.col("intersection").alias("last_intersection"))
    placed = kept.join(first, ["corridor_id", "first_segment_order"], "left").join(last, ["corridor_id", "last_segment_order"], "left")
    midnight = F.to_timestamp_ntz(F.col("analysis_date").cast("string"))

    def time(slot: str) -> Column:
        return midnight + F.make_dt_interval(F.lit(0), F.lit(0), (F.col(slot) * params.slot_minutes).cast("int"), F.lit(0))

    return placed.select(
        *DAY, "event_id", time("first_slot").alias("start_time"), time("last_slot").alias("end_time"), minutes.alias("duration_minutes"), "cell_count", "segment_count",
        "first_segment_order", "last_segment_order", "first_tmc", "last_tmc", "first_intersection", "last_intersection",
        rounded(F.least("run_miles", F.lit(params.slice_miles)), 3).alias("maximum_contiguous_extent_miles"), rounded(F.least("total_miles", F.lit(params.slice_miles)), 3).alias("maximum_total_active_miles"),
        rounded(F.col("sliced") * params.slot_minutes / 60.0, 3).alias("event_area_mile_hours"), rounded(F.col("speed"), 2).alias("average_speed_mph"), rounded(F.col("lowest"), 3).alias("minimum_speed_ratio"),
        rounded(F.col("ratio"), 3).alias("average_speed_ratio"), rounded(F.col("drop"), 2).alias("average_speed_drop_mph"), rounded(F.col("most"), 2).alias("maximum_speed_drop_mph"),
        rounded(F.col("slope"), 3).alias("estimated_upstream_boundary_speed_mph"), rounded(F.coalesce("low.start_mile", F.lit(0.0)), 3).alias("corridor_start_mile"), rounded(F.coalesce("high.end_mile", F.lit(0.0)), 3).alias("corridor_end_mile"),
    )


def event_order(found: DataFrame) -> DataFrame:
    """Place of each event on its corridor day: by area, duration and extent, largest first."""
    order = Window.partitionBy(*DAY).orderBy(F.desc("event_area_mile_hours"), F.desc("duration_minutes"), F.desc("maximum_contiguous_extent_miles"), "event_id")
    return found.select(*DAY, "event_id", F.row_number().over(order).alias("place"), "event_area_mile_hours", "duration_minutes", "maximum_contiguous_extent_miles")
