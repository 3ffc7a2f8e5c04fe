"""Traffic counts per device and vehicle type."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.speed import speed_length_fold

GRAINS = ("minute", "hour", "day")

# Fixed value: how long a pass keeps its buckets live, in seconds.
RETENTION_SECONDS = 600


def flow(passes: DataFrame, grain: str) -> DataFrame:
    """Passes per device, vehicle type and bucket.

    A partial count runs before the only exchange, so a busy device sends one
    row per bucket and task.
    """
    _check(grain)
    bucket = F.date_trunc(grain, "pass_ts").alias("bucket")
    return passes.groupBy("device_id", "vehicle_type", bucket).agg(F.count(F.lit(1)).alias("n"))


def flow_all_grains(passes: DataFrame) -> DataFrame:
    """All three grains in long form from one scan: coarser counts add up minute counts."""
    return grains_of(flow(passes, "minute"))


def grains_of(minute: DataFrame, grains: Sequence[str] = GRAINS) -> DataFrame:
    """Long counts of the grains from minute counts."""
    for grain in grains:
        _check(grain)
    grained = minute.select(
        "device_id", "vehicle_type", "n",
        F.explode(F.array(*[
            F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "bucket").alias("bucket")) for g in grains
        ])).alias("b"),
    )
    return (
        grained.groupBy("device_id", "b.grain", "b.bucket", "vehicle_type")
        .agg(F.sum("n").alias("n"))
    )


def interval_summary(passes: DataFrame, interval: str, class_map: Mapping[str, list[int]]) -> DataFrame:
    """Totals per device and interval in the columns of the summary message.

    ``class_map`` names the vehicle-type codes of ``large``, ``medium`` and
    ``small``; every other code counts as other.
    """
    unknown = set(class_map) - {"large", "medium", "small"}
    if unknown:
        raise ValueError(f"unknown vehicle classes: {sorted(unknown)}")

    def total(codes: list[int]) -> Column:
        return F.count_if(F.col("vehicle_type").isin(codes))

    named = [code for codes in class_map.values() for code in codes]
    slot = F.window("pass_ts", interval)
    counted = passes.groupBy("device_id", slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("TotalVehicle"),
        total(class_map.get("large", [])).alias("LargeVehicle"),
        total(class_map.get("medium", [])).alias("MediumVehicle"),
        total(class_map.get("small", [])).alias("SmallVehicle"),
        F.count_if(~F.coalesce(F.col("vehicle_type").isin(named), F.lit(False))).alias("OtherVehicle"),
        F.max("drive_chan").alias("DriveChan"),
        F.avg("speed").cast("float").alias("AverageSpeed"),
    )
    return counted.select(
        F.col("device_id").alias("Id"),
        F.date_format("slot.start", "yyyy-MM-dd HH:mm:ss").alias("Time"),
        *[c for c in counted.columns if c not in ("device_id", "slot")],
    )


def flow_live_asof(passes: DataFrame, as_of) -> DataFrame:
    """Buckets still held at ``as_of``: (device, grain, bucket, type, n), n being complete.

    A minute goes as a whole with its first pass; an hour or day goes once a
    pass of a later hour or day has left the retention window. Devices that
    have lost no pass keep everything.
    """
    as_of = F.lit(as_of).cast("timestamp")
    cut = as_of - F.expr(f"interval {RETENTION_SECONDS} seconds")
    seen = passes.filter(F.col("pass_ts") <= as_of)
    minute = seen.groupBy(
        "device_id", "vehicle_type", F.date_trunc("minute", "pass_ts").alias("minute")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.min("pass_ts").alias("first_ts"),
        F.max(F.when(F.col("pass_ts") <= cut, F.col("pass_ts"))).alias("gone_ts"),
    )
    counted = (
        minute.select(
            "device_id", "vehicle_type", "n", "first_ts", "gone_ts",
            F.explode(F.array(*[
                F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "minute").alias("bucket")) for g in GRAINS
            ])).alias("b"),
        )
        .groupBy("device_id", "b.grain", "b.bucket", "vehicle_type")
        .agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("gone_ts").alias("gone_ts"))
        # A device has one row per bucket and type here, however many passes it has.
        .withColumn("expired_ts", F.max("gone_ts").over(Window.partitionBy("device_id")))
    )
    expired = F.col("expired_ts")
    live = (
        F.when(F.col("grain") == "minute", F.col("first_ts") > cut)
        .when(F.col("grain") == "hour", F.col("bucket") >= F.date_trunc("hour", expired))
        .otherwise(F.col("bucket") >= F.date_trunc("day", expired))
    )
    return (
        counted.filter(expired.isNull() | live)
        .select("device_id", "grain", "bucket", "vehicle_type", "n")
    )


def speed_live_asof(
    passes: DataFrame, as_of, average: Callable[[DataFrame], DataFrame] = speed_length_fold
) -> DataFrame:
    """Speed and length of the device-minutes still held at ``as_of``.

    ``average`` is `speed_length_fold` or `speed_length`.
    """
    as_of = F.lit(as_of).cast("timestamp")
    cut = as_of - F.expr(f"interval {RETENTION_SECONDS} seconds")
    # A minute that starts more than a minute before the cut cannot be live, which prunes the scan.
    recent = passes.filter(F.col("pass_ts").between(cut - F.expr("interval 60 seconds"), as_of))
    live = (
        recent.groupBy("device_id", F.date_trunc("minute", "pass_ts").alias("minute"))
        .agg(F.min("pass_ts").alias("first_ts"))
        .filter(F.col("first_ts") > cut)
    )
    return average(recent).join(live, ["device_id", "minute"], "left_semi")


def _check(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
