"""One row per device and day: maps per grain, and the wide text cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.keys import flow_key
from kerbside.operators.flow import flow_all_grains
from kerbside.operators.speed import speed_length_fold

# Key formats of the maps: bucket text per grain.
_BUCKET_TEXT = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH", "minute": "yyyy-MM-dd HH:mm"}


def device_day(counts: DataFrame, speeds: DataFrame) -> DataFrame:
    """Five maps per (device, day) from long counts and per-minute speed and length.

    ``counts``: (device_id, grain, bucket, vehicle_type, n); keys are
    ``type|bucket``. ``speeds``: (device_id, minute, speed, length); keys are the
    minute. A device-day without a day count is left out, as day counts lead.
    A group holds at most 1,440 minutes times the vehicle types.
    """

    def bucket_text(grain: str, column: str) -> Column:
        return F.date_format(column, _BUCKET_TEXT[grain])

    def entries(grain: str) -> Column:
        key = F.concat(F.col("vehicle_type").cast("string"), F.lit("|"), bucket_text(grain, "bucket"))
        entry = F.when(F.col("grain") == grain, F.struct(key.alias("key"), F.col("n").alias("value")))
        return F.map_from_entries(F.collect_list(entry)).alias(f"{grain}_map")

    day = F.to_date("bucket").alias("day")
    counted = counts.groupBy("device_id", day).agg(*[entries(g) for g in ("day", "hour", "minute")])
    counted = counted.filter(F.size("day_map") > 0)

    minute = bucket_text("minute", "minute")
    measured = speeds.groupBy("device_id", F.to_date("minute").alias("day")).agg(*[
        F.map_from_entries(F.collect_list(F.struct(minute.alias("key"), F.col(m).alias("value")))).alias(f"{m}_map")
        for m in ("speed", "length")
    ])
    return counted.join(measured, ["device_id", "day"], "left")


def device_day_of(passes: DataFrame) -> DataFrame:
    """``device_day`` of a pass table, with the running means of speed and length."""
    return device_day(flow_all_grains(passes), speed_length_fold(passes))


def flow_wide(counts: DataFrame, speeds: DataFrame) -> DataFrame:
    """Stored form of the same input: row key and a map of text cells.

    ``D`` is the day, ``{h}h`` an hour of day, ``{m}`` a minute of day, ``{m}S``
    and ``{m}L`` its speed and length. A count cell lists ``type:count|`` by
    ascending type.
    """
    minute_of_day = F.hour("bucket") * 60 + F.minute("bucket")
    slot = (
        F.when(F.col("grain") == "day", F.lit("D"))
        .when(F.col("grain") == "hour", F.concat(F.hour("bucket").cast("string"), F.lit("h")))
        .otherwise(minute_of_day.cast("string"))
    )
    by_type = F.array_sort(F.collect_list(F.struct("vehicle_type", "n")))
    text = F.array_join(F.transform(by_type, lambda t: F.concat(
        t["vehicle_type"].cast("string"), F.lit(":"), t["n"].cast("string"), F.lit("|"))), "")
    count_cells = (
        counts.groupBy("device_id", F.to_date("bucket").alias("day"), slot.alias("key"))
        .agg(text.alias("value"))
    )
    at = (F.hour("minute") * 60 + F.minute("minute")).cast("string")
    measure_cells = speeds.select(
        "device_id", F.to_date("minute").alias("day"),
        F.explode(F.array(*[
            F.struct(F.concat(at, F.lit(suffix)).alias("key"), F.col(m).cast("string").alias("value"))
            for m, suffix in (("speed", "S"), ("length", "L"))
        ])).alias("c"),
    ).select("device_id", "day", "c.key", "c.value")
    days = count_cells.unionByName(measure_cells).groupBy("device_id", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("cells")
    )
    return days.filter(F.map_contains_key("cells", F.lit("D"))).select(
        flow_key(F.col("device_id"), F.date_format("day", "yyyy-MM-dd")).alias("row_key"),
        "device_id", "day", "cells",
    )


def flow_wide_of(passes: DataFrame) -> DataFrame:
    """``flow_wide`` of a pass table, with the running means of speed and length."""
    return flow_wide(flow_all_grains(passes), speed_length_fold(passes))
