"""Helpers for the open-ended attribute maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(m: Column) -> Column:
    return F.coalesce(m, F.create_map().cast("map<string,string>"))


def merge_maps(*maps: Column) -> Column:
    """Left to right, a later map wins on a shared key; a null map counts as empty."""

    def over(left: Column, right: Column) -> Column:
        kept = F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k))
        return F.map_concat(kept, right)

    return reduce(over, [_present(m) for m in maps])


def map_rows(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per entry of a map column."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias(key, value))
