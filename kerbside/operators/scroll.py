"""Scrolling through a sorted search at a point in time.

A cursor is opened once: it pins the batches that the searched table has then, and counts the hits in ranges of the order. From
then on a page reads the pinned batches within the one or two ranges that hold it, and sorts nothing else. So pages follow one another without gap or
repetition while batches arrive, and no hit is copied. The cursor is a small value that can be handed on as text; like
a search context it expires some time after it was last used. A reader of page after page gets them one by one; who wants all
that are left gets them in one job.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.paging import number_rows

BATCH = "batch_id"
# Fixed value: seconds that a cursor lives on after each use.
KEEP_SECONDS = 60.0

Search = Callable[[DataFrame], DataFrame]


class CursorExpired(ValueError):
    pass


@dataclass(frozen=True)
class Range:
    """Hits between two times in microseconds, both included, and the number of hits before them."""

    low: int
    high: int
    rows: int
    before: int


@dataclass(frozen=True)
class Cursor:
    size: int
    order: tuple[str, ...]
    last_batch: int
    ranges: tuple[Range, ...]
    page: int
    expires: float
    keep_seconds: float = KEEP_SECONDS

    @property
    def rows(self) -> int:
        return sum(r.rows for r in self.ranges)

    @property
    def pages(self) -> int:
        return -(-self.rows // self.size)

    def turned(self, now: float | None = None) -> Cursor:
        """The cursor at the next page, its life renewed."""
        return replace(self, page=self.page + 1, expires=(time.time() if now is None else now) + self.keep_seconds)

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Cursor:
        told = json.loads(text)
        return Cursor(**{**told, "order": tuple(told["order"]), "ranges": tuple(Range(**r) for r in told["ranges"])})


def _pinned(spark: SparkSession, path: str, last_batch: int | None) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(path)
    return rows if last_batch is None else rows.where(F.col(BATCH) <= last_batch)


def open_cursor(
    spark: SparkSession, path: str, search: Search, size: int, order: Sequence[str] = ("pass_ts", "event_id"),
    ranges: int = 200, keep_seconds: float = KEEP_SECONDS, now: float | None = None,
) -> Cursor:
    """A cursor at the first page of ``search`` over the batches that the table below ``path`` has now.

    ``order`` starts with a time that every hit has and is unique as a whole. Hits are counted once, in about ``ranges``
    ranges of that time, which end up as one small row each.
    """
    last = _pinned(spark, path, None).agg(F.max(BATCH)).first()[0]
    found = search(_pinned(spark, path, last)).select(F.unix_micros(F.col(order[0])).alias("t"))
    low, high = found.agg(F.min("t"), F.max("t")).first()
    parts: list[Range] = []
    if low is not None:
        width = max(1, -(-(high - low + 1) // ranges))
        counted = found.groupBy(F.floor((F.col("t") - low) / width).alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counted, key=lambda r: r["at"]):
            start = low + r["at"] * width
            parts.append(Range(start, start + width - 1, r["n"], parts[-1].before + parts[-1].rows if parts else 0))
    alive = (time.time() if now is None else now) + keep_seconds
    return Cursor(size, tuple(order), -1 if last is None else last, tuple(parts), 0, alive, keep_seconds)


def read_page(spark: SparkSession, path: str, search: Search, cursor: Cursor, now: float | None = None) -> DataFrame:
    """The hits of the cursor's page, in order; `Cursor.turned` goes on to the next one."""
    first = cursor.page * cursor.size
    held, found = _found(spark, path, search, cursor, first + cursor.size, now)
    if not held:
        return found.limit(0)
    return found.orderBy(*cursor.order).limit(first - held[0].before + cursor.size).offset(first - held[0].before)


def read_pages(
    spark: SparkSession, path: str, search: Search, cursor: Cursor, pages: int | None = None, now: float | None = None
) -> DataFrame:
    """The hits of the cursor's page and those behind it, ``pages`` in all or as many as are left, each with its ``page``, from 0.

    One job however many pages these are, and no task holds more than a range of the order: the hits are
    numbered where they lie (`number_rows`), which copies them to the checkpoint folder once.
    """
    first = cursor.page * cursor.size
    end = cursor.rows if pages is None else min(cursor.rows, first + pages * cursor.size)
    held, found = _found(spark, path, search, cursor, end, now)
    page = F.floor(F.col("position") / cursor.size).cast("long").alias("page")
    if not held:
        return found.limit(0).withColumn("position", F.lit(0)).select(*found.columns, page)
    numbered = number_rows(found, cursor.order).withColumn("position", F.col("position") + held[0].before)
    return numbered.where((F.col("position") >= first) & (F.col("position") < end)).select(*found.columns, page)


def _found(
    spark: SparkSession, path: str, search: Search, cursor: Cursor, end: int, now: float | None
) -> tuple[list[Range], DataFrame]:
    """The ranges that hold the hits from the cursor's page to before number ``end``, and all hits in them."""
    if (time.time() if now is None else now) > cursor.expires:
        raise CursorExpired(f"the cursor has not been used for {cursor.keep_seconds} seconds")
    held = [r for r in cursor.ranges if r.before < end and r.before + r.rows > cursor.page * cursor.size]
    rows = _pinned(spark, path, cursor.last_batch)
    if not held:
        return held, search(rows)
    # Ranges lie one after another, those without hits between them hold nothing.
    near: list[Column] = [_between(cursor.order[0], r) for r in (held if len(held) < 4 else [replace(held[0], high=held[-1].high)])]
    return held, search(rows.where(reduce(Column.__or__, near)))


def _between(name: str, r: Range) -> Column:
    return F.col(name).between(F.timestamp_micros(F.lit(r.low)), F.timestamp_micros(F.lit(r.high)))
