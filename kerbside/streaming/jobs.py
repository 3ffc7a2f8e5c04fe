"""The streaming jobs: settings, start, and the per-batch work."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from kerbside.functions.timing import time_text
from kerbside.operators import limits, watch
from kerbside.operators.lookup import Join, plain_join, size_up
from kerbside.sources import decode
from kerbside.streaming import sinks
from kerbside.streaming.levels import Levels
from kerbside.streaming.versions import Versions

Batch = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class JobConfig:
    """One checkpoint folder per query, on shared storage."""

    checkpoint: str
    name: str | None = None
    trigger: str = "1 second"
    # Work through what is there, then stop.
    available_now: bool = False
    output_mode: str = "append"


def start(df: DataFrame, sink: Batch, cfg: JobConfig) -> StreamingQuery:
    """Run ``sink`` on every micro-batch; a failing sink fails the batch and it is repeated."""
    writer = df.writeStream.foreachBatch(sink).outputMode(cfg.output_mode)
    writer = writer.option("checkpointLocation", cfg.checkpoint)
    if cfg.name:
        writer = writer.queryName(cfg.name)
    if cfg.available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=cfg.trigger).start()


def with_refresh(load: Callable[[], DataFrame] | Versions, work: Callable[[DataFrame, int, DataFrame, Join], None],
                 version: Callable[[], object] | None = None) -> Batch:
    """Batch function that hands ``work`` a current reference table and the join for its size.

    The table is loaded when ``version()`` changes, or for every micro-batch without it; stored `Versions`
    tell by themselves which one a batch takes. What
    is loaded is held, so that it is read once and measured as it will be used. It
    replaces the old one, so deleted rows stop matching.
    """
    held: dict = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = load.of_batch(spark, batch_id) if isinstance(load, Versions) else None
        now = stored or (version() if version else batch_id)
        if not held or held["version"] != now:
            table = (spark.read.parquet(stored) if stored else load()).persist()
            sized = size_up(table)
            if held:
                held["table"].unpersist()
            held.update(version=now, table=table, sized=sized)
        table, join = held["sized"]
        if join is plain_join:
            work(batch, batch_id, table, join)
            return
        # The salted join also counts the batch.
        kept = batch.persist()
        try:
            work(kept, batch_id, table, join)
        finally:
            kept.unpersist()

    return run


def every(seconds: float) -> Callable[[], object]:
    """A version that changes once in that time at most, when a batch asks for it."""
    state = {"at": float("-inf"), "n": 0}

    def version() -> int:
        if time.monotonic() - state["at"] >= seconds:
            state.update(at=time.monotonic(), n=state["n"] + 1)
        return state["n"]

    return version


def alerts_sink(load_watchlist: Callable[[], DataFrame] | Versions, path: str,
                send: Callable[[DataFrame, int], None] | None = None,
                version: Callable[[], object] | None = None, wire: str = "json", table: Levels | None = None) -> Batch:
    """Watchlist hits of each batch into the alarm table, and to ``send`` as messages.

    Alerts that make no message go to the table ``{path}-rejects``. The alarm table lies in day folders below ``path``,
    or is ``table``, a keyed one.
    """

    def work(batch: DataFrame, batch_id: int, watchlist: DataFrame, join: Join) -> None:
        kept = watch.watchlist_alerts(batch, watchlist, join).persist()
        try:
            alarms = watch.alarm_table(kept)
            if table is None:
                sinks.write_by_day(alarms, batch_id, path, "GCSJ")
            else:
                table.add(alarms, batch_id)
            sinks.write_some(watch.alarm_rejects(kept), batch_id, f"{path}-rejects")
            if send is not None:
                send(watch.alarm_messages(kept, wire), batch_id)
        finally:
            kept.unpersist()

    return with_refresh(load_watchlist, work, version)


def overspeed_sink(load_gates: Callable[[], DataFrame] | Versions, path: str,
                   version: Callable[[], object] | None = None, table: Levels | None = None) -> Batch:
    """Violations of each batch into the violation table, in day folders below ``path`` or ``table``, a keyed one.

    Beside it go the passes at unknown gates, those whose gate gives no usable limit, and the
    batch's counters, into ``{path}-unknown-gates``, ``-unusable-limits`` and ``-counters``.
    """

    def work(batch: DataFrame, batch_id: int, gates: DataFrame, join: Join) -> None:
        used = batch.select(*limits.USED, time_text(batch).alias("WFSJ"))
        kept = limits.with_limit(used, gates, "left", join).persist()
        try:
            if table is None:
                sinks.write_by_day(limits.violations(kept), batch_id, path, "WFSJ")
            else:
                table.add(limits.violations(kept), batch_id)
            sinks.write_some(kept.filter("not known").drop("speedlimit", "limit", "known"), batch_id, f"{path}-unknown-gates")
            sinks.write_some(limits.unusable(kept).drop("limit", "known"), batch_id, f"{path}-unusable-limits")
            sinks.write_batch(kept.agg(*limits.counters()), batch_id, f"{path}-counters")
        finally:
            kept.unpersist()

    return with_refresh(load_gates, work, version)


def fan_out_sink(path: str, outputs=sinks.ARCHIVE) -> Batch:
    return lambda batch, batch_id: sinks.fan_out(batch, batch_id, path, outputs)


def decoded_sink(sink: Batch, quarantine_path: str, payload: str = "payload", wire: str = "json",
                 arrival: Column | None = None, lenient_time: bool = False) -> Batch:
    """Decode a batch of payloads once, run ``sink`` on the passes and keep the rest.

    ``arrival`` stands in for an unreadable event time: the stream's own arrival
    column, so that a replay gives the same passes.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = decode.check_payloads(batch, payload, wire).persist()
        try:
            sinks.write_some(decode.quarantined(kept, payload), batch_id, quarantine_path)
            sink(decode.valid_passes(kept, payload, arrival, lenient_time), batch_id)
        finally:
            kept.unpersist()

    return run
