"""Historical searches over the index documents."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kerbside.functions.timing import in_time_range

# Attributes that can be matched; any subset may be given.
TERMS = (
    "vehicle_brand", "plate_color", "dir", "tag", "paper", "sun", "drop", "second_belt", "crash", "danger",
)
# The same attributes under the names of the result documents.
RESULT_NAMES = {
    "vehicle_brand": "vehicleBrand", "plate_color": "PlateColor", "dir": "Direction", "second_belt": "secondBelt",
}
_PATTERN_CHARS = re.compile(r"[.?+*|{}\[\]()\"\\#@&<>~^$]")


def attr_search(
    docs: DataFrame, start=None, end=None, time: str = "pass_ts", names: Mapping[str, str] | None = None, **terms
) -> DataFrame:
    """Documents that equal every given term, within the inclusive time range.

    ``names`` gives the columns of terms that the documents call otherwise:
    `RESULT_NAMES`, with ``time="ResultTime"``, for result documents.
    """
    unknown = set(terms) - set(TERMS)
    if unknown:
        raise ValueError(f"unknown terms: {sorted(unknown)}")
    found = docs
    for name, value in terms.items():
        found = found.filter(F.col(f"`{(names or {}).get(name, name)}`") == F.lit(value))
    return _between(found, time, start, end)


def _between(docs: DataFrame, time: str, start, end) -> DataFrame:
    """The range on ``time``; where the table has a ``day`` folder column, on that too.

    Time as text compares as text, which is the same order and reaches the scan.
    """
    kind = "string" if isinstance(docs.schema[time].dataType, StringType) else "timestamp"
    found = docs.filter(in_time_range(time, start, end, kind))
    return found.filter(in_time_range("day", start, end, "date")) if "day" in docs.columns else found


def time_range(docs: DataFrame, start, end, time: str = "pass_ts") -> DataFrame:
    """Documents within the inclusive range."""
    return _between(docs, time, start, end)


def time_count(docs: DataFrame, start, end, time: str = "pass_ts") -> DataFrame:
    """Number of documents in the range, one row."""
    return time_range(docs, start, end, time).agg(F.count(F.lit(1)).alias("total"))


def plate_search(
    docs: DataFrame, start, province: str, suffix: str, end=None, time: str = "pass_ts", plate: str = "plate"
) -> DataFrame:
    """Plates that match ``province`` + any five characters + ``suffix`` as a whole.

    Both texts are pattern text. A plain province also becomes a prefix test,
    which the scan can use to skip row groups; a pattern cannot be pushed down.
    ``end`` defaults to now.
    """
    # (?s): a dot stands for any character; \z: the very end, also before a line break.
    whole = F.col(plate).rlike(f"(?s)^(?:{province}.{{5}}{suffix})\\z")
    found = _between(docs, time, start, F.current_timestamp() if end is None else end)
    alternatives = "|" in suffix
    if province and not _PATTERN_CHARS.search(province) and not alternatives:
        found = found.filter(F.col(plate).startswith(province))
    return found.filter(whole)
