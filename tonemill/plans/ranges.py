"""Ordered computations without a one-task window.

A global ``Window.orderBy`` moves every row to one task, and so does ``partitionBy`` on a key
that holds much of the data. Here rows are range-partitioned on ``(by, order)`` and written;
what the preceding ranges contribute is then a table of at most *ranges + groups* rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.plans.materialize import materialize

# A table of range summaries is broadcast up to this many rows; it is joined by shuffle beyond.
BROADCAST_ROWS = 200_000
_POSITION_MASK = (1 << 33) - 1

PART, POS = "_part", "_pos"


def range_sorted(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Rows sorted in ranges, with range number ``_part`` and row position in it ``_pos``.

    ``order`` must end in a unique column: that fixes positions and lets a large group be cut
    into several ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in by] + order
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)))
    )
    return materialize(placed, "ranges")


def preceding(by: list[str]):
    """Window over range summaries: all earlier ranges of the same group."""
    return Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def within(by: list[str], order: list[Column]):
    """Window over rows: earlier rows of the same group in the same range, and the row itself."""
    return Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def attach_summary(parts: DataFrame, summary: DataFrame, by: list[str]) -> DataFrame:
    """Join range summaries back to the rows of their range."""
    keys = [*by, PART]
    renamed = summary.select(*[F.col(c).alias(f"_s_{c}") for c in keys],
                             *[c for c in summary.columns if c not in keys])
    if not by or summary.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in keys])
    return parts.join(renamed, same).drop(*[f"_s_{c}" for c in keys])


def dense_index(df: DataFrame, order: list[Column], by: list[str] | None = None,
                name: str = "idx") -> DataFrame:
    """Number rows 0, 1, 2 ... in ``order``, separately for each value of ``by``."""
    by = by or []
    parts = range_sorted(df, by, order)
    summary = parts.groupBy(*by, PART).agg(F.count("*").alias("_n"), F.min(POS).alias("_first"))
    shift = F.coalesce(F.sum("_n").over(preceding(by)), F.lit(0)) - F.col("_first")
    offsets = summary.select(*by, PART, shift.alias("_shift"))
    return (
        attach_summary(parts, offsets, by)
        .withColumn(name, F.col(POS) + F.col("_shift"))
        .drop(PART, POS, "_shift")
    )
