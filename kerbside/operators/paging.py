"""Sorted results in pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from kerbside.session import use_checkpoints

# Hits per page of the attribute search and of the plate search.
ATTR_PAGE, PLATE_PAGE = 50, 100


def _after(order: Sequence[str], last: Sequence) -> Column:
    """Strictly behind ``last`` in the order, written so that the scan can prune on the first column."""
    (name, *names), (value, *values) = order, last
    here = F.col(name) > F.lit(value)
    if not names:
        return here
    return (F.col(name) >= F.lit(value)) & (here | _after(names, values))


def page(
    df: DataFrame, size: int, after: Sequence | None = None, order: Sequence[str] = ("pass_ts", "event_id")
) -> DataFrame:
    """The ``size`` rows behind the key ``after``. Needs no sort of the whole result."""
    rows = df if after is None else df.filter(_after(order, after))
    return rows.orderBy(*order).limit(size)


def scroll(df: DataFrame, size: int, order: Sequence[str] = ("pass_ts", "event_id")) -> Iterator[list[Row]]:
    """Pages one after another until an empty one; each page is a job of its own."""
    after = None
    while rows := page(df, size, after, order).collect():
        yield rows
        after = [rows[-1][name] for name in order]


def sort_result(df: DataFrame, order: Sequence[str] = ("pass_ts", "event_id")) -> DataFrame:
    """Ascending by result time; the id breaks ties."""
    return df.orderBy(*order)


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``position`` from 0 in the total order, without sending the result through one task.

    The range-partitioned rows are written once, to the checkpoint folder, with
    their partition and place in it; the count of the partitions before gives
    the offset. ``order`` must be unique, so that equal times still spread.
    """
    use_checkpoints(df.sparkSession)
    in_partition = (1 << 33) - 1
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = ranged.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    written = written.withColumn("_part", F.shiftright("_at", 33))
    # One row per shuffle partition: small whatever the result's size.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    position = (F.col("_offset") + F.col("_at").bitwiseAND(F.lit(in_partition))).alias("position")
    return written.join(F.broadcast(offsets), "_part").select(*df.columns, position)


def number_pages(df: DataFrame, size: int, order: Sequence[str] = ("pass_ts", "event_id")) -> DataFrame:
    """Every row with its ``page``, from 1."""
    numbered = number_rows(df, order)
    return numbered.select(*df.columns, (F.floor(F.col("position") / size) + 1).alias("page"))
