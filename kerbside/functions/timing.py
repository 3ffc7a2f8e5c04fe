"""Event-time parsing, ranges and formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the message time pattern.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Same pattern with optional leading zeros; text after the seconds is ignored.
_LEADING_TIME = r"^(\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})"
_PARTS = r"^(\d{1,4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(text: Column | str, fallback: Column, lenient: bool = False) -> Column:
    """Timestamp of a message; ``fallback`` (arrival time) where the text is no time.

    ``lenient=True`` rolls out-of-range fields over: month 13 becomes January of
    the next year, 25:00 becomes 01:00 of the next day.
    """
    text = _col(text)
    if not lenient:
        parsed = F.try_to_timestamp(F.regexp_extract(text, _LEADING_TIME, 1), F.lit("yyyy-M-d H:m:s"))
        return F.coalesce(parsed, fallback)
    year, month, day, hour, minute, second = (
        F.regexp_extract(text, _PARTS, i).try_cast("int") for i in range(1, 7)
    )
    first = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    rolled = F.date_add(first, day - 1).cast("timestamp") + F.make_dt_interval(
        F.lit(0), hour, minute, second.cast("decimal(18,6)")
    )
    return F.coalesce(rolled, fallback)


def in_time_range(column: Column | str, start=None, end=None, kind: str = "timestamp") -> Column:
    """Inclusive at both ends, open where a bound is None. Literal bounds reach the scan."""

    def bound(value) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp").cast(kind)

    inside = F.lit(True)
    if start is not None:
        inside = inside & (_col(column) >= bound(start))
    if end is not None:
        inside = inside & (_col(column) <= bound(end))
    return inside


def time_text(df: DataFrame) -> Column:
    """The message's own time text where the frame still carries it."""
    if "time_text" in df.columns:
        return F.col("time_text")
    return F.date_format("pass_ts", TIME_FORMAT)
