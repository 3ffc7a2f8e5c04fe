"""Traffic flow over a stream, without state and without loss.

A micro-batch adds minute counts with sums of speed and length to one table, and its passes to the running means
of their device-minutes where these are wanted. Counts add up, so a pass counts however late it comes, and a device
whose clock is ahead costs no other device anything. Both tables are kept in `levels`: small folders of batches are merged to
larger ones, and a replayed batch adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.flow import GRAINS, grains_of
from kerbside.streaming import sinks
from kerbside.streaming.levels import Levels, summing
from kerbside.streaming.means import RunningMeans

_KEYS = ["day", "device_id", "vehicle_type", "minute"]
_SUMS = ["n", "speed_n", "speed_sum", "length_n", "length_sum"]
_USED = ("device_id", "vehicle_type", "pass_ts", "event_id", "speed", "length")


def counts_table(path: str, fan: int = 4) -> Levels:
    return Levels(f"{path}/counts", summing(_KEYS, _SUMS), ("day",), fan)


def flow_sink(path: str, means: bool = True, fan: int = 4) -> sinks.Batch:
    """Adds each batch to the counts below ``path`` and, unless ``means`` is off, to the running means."""
    counts, running = counts_table(path, fan), RunningMeans(f"{path}/means", fan=fan)

    def write(batch: DataFrame, batch_id: int) -> None:
        used = batch.select(*_USED)
        if not means:
            counts.add(batch_counts(used), batch_id)
            return
        kept = used.persist()
        try:
            counts.add(batch_counts(kept), batch_id)
            running.add(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def batch_counts(passes: DataFrame) -> DataFrame:
    """Per device, type and minute: passes, and the sums that a mean needs."""
    sums = [
        column for m in ("speed", "length")
        for column in (F.count(m).alias(f"{m}_n"), F.sum(F.col(m).cast("double")).alias(f"{m}_sum"))
    ]
    minute, day = F.date_trunc("minute", "pass_ts").alias("minute"), F.to_date("pass_ts").alias("day")
    return passes.groupBy(day, "device_id", "vehicle_type", minute).agg(F.count(F.lit(1)).alias("n"), *sums)


def read_flow(spark: SparkSession, path: str, *grains: str) -> DataFrame:
    """Long counts of the asked grains (all by default), as `device_day` and `flow_wide` take them."""
    minutes = counts_table(path).rows(spark).groupBy("device_id", "vehicle_type", "minute").agg(F.sum("n").alias("n"))
    return grains_of(minutes.withColumnRenamed("minute", "bucket"), grains or GRAINS)


def read_speed_length(spark: SparkSession, path: str) -> DataFrame:
    """Mean speed and length per device-minute."""
    means = [(F.sum(f"{m}_sum") / F.sum(f"{m}_n")).alias(m) for m in ("speed", "length")]
    return counts_table(path).rows(spark).groupBy("device_id", "minute").agg(*means)


def read_running_mean(spark: SparkSession, path: str) -> DataFrame:
    """The order-dependent running mean per device-minute, passes in order of time."""
    return RunningMeans(f"{path}/means").read(spark)
