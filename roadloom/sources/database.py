"""A relational store over JDBC: loading, and reading a query's rows in even shares.

An embedded file database serves one JVM, so ``embedded`` is for a local master; on a cluster the
same functions take the URL of a server that all executors reach.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import scratch_path
from .tables import read_database

#: Shares of rows by which the bounds of a read may be off.
ACCURACY = 1_000


def embedded(spark: SparkSession) -> str:
    """The URL of a fresh file database below the scratch folder."""
    path = scratch_path(spark, "database").removeprefix("file://")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", f"{path}.log")
    return f"jdbc:derby:{path};create=true"


def load(df: DataFrame, url: str, table: str, types: str = "") -> None:
    """Write ``df`` as the table ``table``; ``types`` gives column types where the store's own for text are too wide to compare."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode("overwrite")
    (writer.option("createTableColumnTypes", types) if types else writer).save()


def _literal(value: object) -> str:
    """A bound as every JDBC driver reads it."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    return f"{{d '{value:%Y-%m-%d}'}}" if isinstance(value, dt.date) else str(value)


def bounds(keys: DataFrame, key: str, shares: int) -> list:
    """Ascending values of a number, date or time without zone that cut the rows of ``keys`` into about equal shares.

    A value that fills several shares is a bound once, so its rows are one share: a single value
    can't be cut by its own ranges.
    """
    kind = dict(keys.dtypes)[key]
    number, back = F.col(key), lambda v: v
    if kind == "timestamp_ntz":
        number, back = F.unix_micros(F.col(key).cast("timestamp")), lambda v: F.timestamp_micros(v).cast(kind)
    elif kind == "date":
        number, back = F.unix_date(key), F.date_from_unix_date
    at = [i / shares for i in range(1, shares)]
    found = keys.agg(F.percentile_approx(number, at, ACCURACY).alias("b"), F.min(number).alias("least"))
    # the least value bounds nothing off
    cuts = F.array_sort(F.array_distinct(F.filter("b", lambda v: v > F.col("least"))))
    return found.select(F.transform(cuts, back)).first()[0] or []


def _ranges(quoted: str, cuts: list) -> list[str]:
    """Conditions of the ranges between the cuts; rows without a key are in the first."""
    text = [_literal(c) for c in cuts]
    if not text:
        return ["1 = 1"]
    return [f"{quoted} < {text[0]} OR {quoted} IS NULL", *(f"{quoted} >= {a} AND {quoted} < {b}" for a, b in zip(text, text[1:], strict=False)), f"{quoted} >= {text[-1]}"]


def read_even(spark: SparkSession, url: str, table: str, key: str, shares: int) -> DataFrame:
    """The rows of ``table`` in at most ``shares`` parallel reads of about equal size, whatever the key's distribution.

    The key's column alone is read first, in ranges of equal width between its extremes, which the
    store works out; its quantiles then bound the reads of the rows. Rows without a key are in the
    first. Filters and columns that are applied to the result go into each read's query.
    """
    quoted, reader = f'"{key}"', spark.read.option("preferTimestampNTZ", "true")
    low, high = read_database(spark, url, f"SELECT min({quoted}) AS low, max({quoted}) AS high FROM {table}", preferTimestampNTZ="true").first()
    if low is None or low == high or shares < 2:
        return reader.jdbc(url, table)
    even = sorted({low + (high - low) * i / shares if not isinstance(low, int) else low + (high - low) * i // shares for i in range(1, shares)} - {low})
    keys = reader.jdbc(url, table, predicates=_ranges(quoted, even)).select(key)
    return reader.jdbc(url, table, predicates=_ranges(quoted, bounds(keys, key, shares)))
