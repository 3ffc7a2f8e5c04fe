"""Row keys, one builder per stored table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flow_key(device: Column, day_text: Column) -> Column:
    """``salt|device_day``; the salt is the code of the device's last character mod 3."""
    salt = F.ascii(F.right(device, F.lit(1))) % 3
    return F.concat(salt.cast("string"), F.lit("|"), device, F.lit("_"), day_text)


def pass_key(*identity: Column) -> Column:
    """Archive key: a digest of what identifies the pass, so a replay writes the same key.

    Pass topic, partition and offset for messages; plate, device, time and id for files.
    """
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in identity]))


def _reversed_counter(seed: int) -> Column:
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.reverse((row_in_task + F.lit(seed)).cast("string"))


def counter_key(seed: int) -> Column:
    """``reverse(counter)_partition``, counted per task from ``seed``. Not stable on replay."""
    return F.concat(_reversed_counter(seed), F.lit("_"), F.spark_partition_id().cast("string"))


def plate_counter_key(seed: int, plate: Column, device: Column) -> Column:
    """``reverse(counter)_plate_device``. Not stable on replay."""
    return F.concat(_reversed_counter(seed), F.lit("_"), plate, F.lit("_"), device)


def alarm_key(time: Column, plate: Column, device: Column) -> Column:
    return F.concat(time, plate, device)


def alarm_id(device: Column, time: Column) -> Column:
    return F.concat(device, time)


def vehicle_id(plate: Column, time: Column) -> Column:
    return F.concat(plate, time)


def violation_key(time: Column, plate: Column, device: Column) -> Column:
    return F.concat_ws("_", time, plate, device)
