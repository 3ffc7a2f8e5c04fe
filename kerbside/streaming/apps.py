"""The four jobs, from payload stream to stored tables.

Each takes the payload stream of `pass_stream` and returns its running queries.
Tables go below ``out``, and every query has a checkpoint of its own below
``checkpoints``; both must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.streaming import flows, jobs, sinks


@dataclass(frozen=True)
class Setup:
    out: str
    checkpoints: str
    wire: str = "protobuf"
    trigger: str = "1 second"
    available_now: bool = False
    alarm_wire: str = "protobuf"

    def query(self, name: str) -> jobs.JobConfig:
        return jobs.JobConfig(f"{self.checkpoints}/{name}", trigger=self.trigger, available_now=self.available_now)


def arrival(payloads: DataFrame) -> Column:
    """When a payload came in, as far as the stream knows."""
    return F.col("arrival_ts") if "arrival_ts" in payloads.columns else F.current_timestamp()


def _per_batch(payloads: DataFrame, sink: jobs.Batch, name: str, setup: Setup) -> list[StreamingQuery]:
    decoded = jobs.decoded_sink(
        sink, f"{setup.out}/{name}-quarantine", wire=setup.wire, arrival=arrival(payloads))
    return [jobs.start(payloads, decoded, setup.query(name))]


def archive_app(payloads: DataFrame, setup: Setup) -> list[StreamingQuery]:
    """Metadata, pictures and search index of every pass."""
    return _per_batch(payloads, jobs.fan_out_sink(f"{setup.out}/archive"), "archive", setup)


def alerts_app(
    payloads: DataFrame, load_watchlist: Callable[[], DataFrame], setup: Setup,
    send: Callable[[DataFrame, int], None] | None = None, version: Callable[[], object] | None = None,
) -> list[StreamingQuery]:
    """Watchlist alarms, stored and sent."""
    sink = jobs.alerts_sink(load_watchlist, f"{setup.out}/alarms", send, version, setup.alarm_wire)
    return _per_batch(payloads, sink, "alarms", setup)


def overspeed_app(
    payloads: DataFrame, load_gates: Callable[[], DataFrame], setup: Setup,
    version: Callable[[], object] | None = None,
) -> list[StreamingQuery]:
    """Speeding violations."""
    return _per_batch(payloads, jobs.overspeed_sink(load_gates, f"{setup.out}/violations", version), "violations", setup)


def flow_app(payloads: DataFrame, setup: Setup) -> list[StreamingQuery]:
    """Counts of all grains and the running means, each payload being parsed once."""
    sink = flows.flow_sink(f"{setup.out}/flow")

    def placed(passes: DataFrame, batch_id: int) -> None:
        # Messages of one device and second are ordered by where they lie in the topic.
        sink(passes if "event_id" in passes.columns else passes.withColumn("event_id", F.col("offset")), batch_id)

    return _per_batch(payloads, placed, "flow", setup)


def read_flow_tables(spark: SparkSession, setup: Setup) -> tuple[DataFrame, DataFrame]:
    """(counts, speeds) as `device_day` and `flow_wide` take them."""
    path = f"{setup.out}/flow"
    return flows.read_flow(spark, path), flows.read_running_mean(spark, path)
