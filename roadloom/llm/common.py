"""What the operators share: reading tables, scratch tables, size-checked broadcasts, small batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise

__all__ = ["bound_batches", "checked_broadcast", "materialise", "small_batches", "table", "text_of"]

#: Rows of a narrow side (ids and digests, at most about 100 bytes a row) that may be broadcast.
BROADCAST_ROWS = 300_000
#: Rows that a worker takes from an Arrow batch at once, so that what it makes of them stays small.
ARROW_ROWS = 256


#: Bytes of an Arrow batch for the registered queries and the pipeline, unless the session says otherwise.
ARROW_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """For entry points: hold Arrow batches to ARROW_BYTES where the session has no bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's default
        spark.conf.set(name, str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the data folder, through Spark's reader alone, for a registered query."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, without a copy.

    Spark itself bounds a batch by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB
    unless set), so long texts come few at a time. No operator changes a setting of the session;
    the registered queries lower that bound (``bound_batches``).
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS, items: str | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is.

    Give it materialised, narrow tables: the rows are counted here. Where ``items`` names an array
    column, its items count as rows. Beyond the bound the join shuffles, with the same rows as its
    result.
    """
    some = df.limit(most + 1)
    if items is None:
        return F.broadcast(df) if some.count() <= most else df
    # a null array or an empty one is a row too
    size = some.agg(F.sum(F.greatest(F.size(items), F.lit(1)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def text_of(column: str = "text") -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
