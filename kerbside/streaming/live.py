"""The buckets that are live now, kept by a stream: the state of a ten-minute window that slides with event time.

The stream's clock is the newest event time seen. After each batch the state holds what `flow.flow_live_asof`
gives for all passes so far at that time: a minute goes as a whole with its first pass, an hour or
day once a pass of a later one has left the window. The state is small, some buckets per device, and is written whole by each
batch as a new version; the manifest names the current one. A replayed batch finds its version there and changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.operators.flow import GRAINS, RETENTION_SECONDS
from kerbside.streaming.levels import SharedFile

_KEYS = ["device_id", "grain", "bucket", "vehicle_type"]
#: Grain of the row that keeps the hour of the latest pass of a device that has left the window.
_GONE = "gone"
#: Versions before the current one that stay for readers.
VERSIONS_KEPT = 2


class LiveFlow:
    """Live counts below ``path``, written by one query."""

    def __init__(self, path: str):
        self.path = path

    def _manifest(self, spark: SparkSession) -> dict:
        text = SharedFile(spark, f"{self.path}/manifest.json").read()
        return json.loads(text) if text else {"last": -1, "clock": None, "versions": []}

    def add(self, passes: DataFrame, batch_id: int) -> None:
        """Move the clock on to the newest pass, count the batch, and drop what has left the window."""
        spark = passes.sparkSession
        held = self._manifest(spark)
        if batch_id <= held["last"]:
            return
        minutes = passes.where("pass_ts is not null").groupBy(
            "device_id", "vehicle_type", F.date_trunc("minute", "pass_ts").alias("minute")
        ).agg(F.count(F.lit(1)).alias("n"), F.min("pass_ts").alias("first_ts"), F.max("pass_ts").alias("last_ts")).persist()
        try:
            newest = minutes.agg(F.unix_micros(F.max("last_ts"))).first()[0]
            clock = max((t for t in (newest, held["clock"]) if t is not None), default=None)
            rows = _grained(minutes)
            if held["versions"]:
                rows = rows.unionByName(self._version(spark, held["versions"][-1]))
            folder = f"{batch_id}-{uuid.uuid4().hex}"
            (rows if clock is None else _settled(rows, clock)).write.parquet(f"{self.path}/{folder}")
        finally:
            minutes.unpersist()
        file, versions = SharedFile(spark, f"{self.path}/manifest.json"), [*held["versions"], folder]
        file.replace(json.dumps({"last": batch_id, "clock": clock, "versions": versions[-VERSIONS_KEPT - 1:]}))
        for old in versions[:-VERSIONS_KEPT - 1]:
            file.delete_folder(f"{self.path}/{old}")

    def _version(self, spark: SparkSession, folder: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{folder}")

    def read(self, spark: SparkSession) -> DataFrame:
        """(device, grain, bucket, type, n) of the live buckets, as of the stream's clock."""
        held = self._manifest(spark)
        if not held["versions"]:
            raise ValueError(f"no batch has been added to {self.path}")
        rows = self._version(spark, held["versions"][-1])
        started = (F.col("grain") != "minute") | (F.col("first_ts") > _cut(held["clock"]))
        return rows.where(F.col("grain").isin(*GRAINS) & started).select("device_id", "grain", "bucket", "vehicle_type", "n")


def _cut(clock: int | None):
    return F.timestamp_micros(F.lit((clock or 0) - RETENTION_SECONDS * 1_000_000))


def _grained(minutes: DataFrame) -> DataFrame:
    grains = F.array(*[F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "minute").alias("bucket")) for g in GRAINS])
    return minutes.select("device_id", F.explode(grains).alias("b"), "vehicle_type", "n", "first_ts").select(
        "device_id", "b.grain", "b.bucket", "vehicle_type", "n", "first_ts")


def _settled(rows: DataFrame, clock: int) -> DataFrame:
    """Counts added up, without what the window has left behind.

    A minute stays until it lies before the window as a whole: a pass that comes for it later must find that its
    first one has gone. By then the device's row of what is gone has its hour.
    """
    cut = _cut(clock)
    summed = rows.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"))
    minute, grain = F.col("grain") == "minute", F.col("grain")
    left = F.when(grain == _GONE, F.col("bucket")).when(minute & (F.col("first_ts") <= cut), F.date_trunc("hour", "bucket"))
    # A device has one row per bucket and type here, however many passes it has.
    known = summed.withColumn("gone", F.max(left).over(Window.partitionBy("device_id")))
    gone = F.col("gone")
    stays = F.when(minute, F.col("bucket") + F.expr("interval 1 minute") > cut).otherwise(
        gone.isNull() | F.when(grain == "hour", F.col("bucket") >= gone).when(grain == "day", F.col("bucket") >= F.date_trunc("day", gone))
        .otherwise(F.lit(False)))
    # The row of what is gone is made anew from one row of each device that has any.
    first = F.row_number().over(Window.partitionBy("device_id").orderBy("grain", "bucket", "vehicle_type")) == 1
    marked = known.withColumn("stays", stays).withColumn("first", first & gone.isNotNull())
    none = F.lit(None)
    kept = F.when(F.col("stays"), F.struct(*_KEYS, "n", "first_ts"))
    mark = F.when(F.col("first"), F.struct(
        "device_id", F.lit(_GONE).alias("grain"), gone.alias("bucket"), none.cast("int").alias("vehicle_type"),
        F.lit(0).cast("long").alias("n"), none.cast("timestamp").alias("first_ts")))
    return marked.select(F.inline(F.array_compact(F.array(kept, mark))))
