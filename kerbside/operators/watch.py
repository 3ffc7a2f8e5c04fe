"""Watchlist hits: the alarm table and the alarm messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import keys
from kerbside.functions.timing import time_text
from kerbside.operators.lookup import Join, lookup_join
from kerbside.sources.messages import ALARM_MESSAGE, MESSAGES, REQUIRED
from kerbside.sources.wire import serialize


def watchlist_alerts(passes: DataFrame, watchlist: DataFrame, join: Join = lookup_join) -> DataFrame:
    """Alarm rows for passes of listed plates, in the columns of the alarm table.

    ``watchlist`` has one row per plate.
    """
    time = time_text(passes).alias("GCSJ")
    used = passes.select(
        "plate", time, "device_id", "alarm_type", "plate_color", "plate_type",
        "vehicle_logo", "vehicle_color", "vehicle_type", "speed",
    )
    hits = join(used, watchlist.select("plate", "bkxxbh", "bkjb"), "plate", "inner")
    moment, plate, device = F.col("GCSJ"), F.col("plate"), F.col("device_id")
    return hits.select(
        keys.alarm_key(moment, plate, device).alias("row_key"),
        F.col("bkxxbh").alias("BKXXBH"),
        F.col("bkjb").alias("BKJB"),
        F.col("alarm_type").alias("BKLX"),
        F.col("plate_color").alias("HPYS"),
        F.col("plate_type").alias("HPZL"),
        F.col("vehicle_logo").alias("CLPP1"),
        F.col("vehicle_color").alias("CSYS"),
        F.col("vehicle_type").alias("CLLX"),
        keys.vehicle_id(plate, moment).alias("CLXXBH"),
        device.alias("KKBH"),
        moment,
        F.col("speed").alias("CLSD"),
        keys.alarm_id(device, moment).alias("BJBH"),
        plate.alias("plate"),
    )


def alarm_table(alerts: DataFrame) -> DataFrame:
    """The stored columns: row key and 13 cells."""
    return alerts.drop("plate")


def alarm_fields(alerts: DataFrame) -> DataFrame:
    """Key and the fields of the alarm message; a priority that is no number is null."""
    return alerts.select(
        F.col("row_key").alias("key"),
        F.col("BJBH").alias("Id"),
        F.col("CLXXBH").alias("VehicleId"),
        F.col("BKXXBH").alias("PreyInfoId"),
        F.col("BKJB").try_cast("int").alias("Priority"),
        F.col("KKBH").alias("DeviceId"),
        F.col("GCSJ").alias("Time"),
        F.col("BKLX").alias("Type"),
        F.col("plate").alias("PlateLicense"),
        F.col("HPYS").alias("PlateColor"),
        F.col("HPZL").alias("PlateType"),
        F.col("CLPP1").alias("VehicleLogoRecog"),
        F.col("CLLX").alias("VehicleType"),
        F.col("CLSD").alias("VehicleSpeed"),
    )


def alarm_messages(alerts: DataFrame, wire: str = "json") -> DataFrame:
    """(key, value) records, the value as JSON text or protobuf bytes.

    Alerts that lack a required field make no message: see `alarm_rejects`.
    """
    if wire not in ("json", "protobuf"):
        raise ValueError(f"wire must be json or protobuf, not {wire!r}")
    fields = alarm_fields(alerts).filter(~_lacks_required())
    body = F.struct(*[c for c in fields.columns if c != "key"])
    value = F.to_json(body) if wire == "json" else serialize(body, ALARM_MESSAGE, alerts.sparkSession)
    return fields.select("key", value.alias("value"))


def _required() -> list[str]:
    return [f.name for f in MESSAGES[ALARM_MESSAGE] if f.label == REQUIRED]


def _lacks_required() -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in _required()])


def alarm_rejects(alerts: DataFrame) -> DataFrame:
    """Alerts that make no message, with the fields they lack; a level that is no number is a lack."""
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in _required()]))
    rejected = alarm_fields(alerts).filter(_lacks_required())
    return rejected.select("key", "PlateLicense", "DeviceId", "Time", F.array_join(missing, ",").alias("missing"))
