"""The order-dependent running mean over a stream whose passes come in any order.

A device-minute is a tree over event time: a leaf a second, a root a minute. A node holds what its passes
do to a mean (`step_maps`), which the root composes from its leaves in order of time. A batch appends its passes to a
log and computes the leaves that it touches and their roots again; only where a leaf has passes already, that is for late ones,
the log is read, and then the rows of those seconds alone. Readers take the roots. So the result is that of all
passes in order of time, whatever the batches were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import step_maps
from kerbside.session import fresh_dir
from kerbside.streaming.levels import SINCE, Levels, newest

MEASURES = ("speed", "length")
MINUTE = ["day", "device_id", "minute"]
LEAF = [*MINUTE, "second"]
#: Passes of a second up to which one task folds them; a busier second is cut to pieces of this many.
PIECE = 65536
#: ``second`` of a root.
ROOT = -1


class RunningMeans:
    """The log and the nodes, below ``path``."""

    def __init__(self, path: str, piece: int = PIECE, fan: int = 4):
        self.piece = piece
        self.log = Levels(f"{path}/log", lambda rows: rows.drop(SINCE), ("day",), fan)
        self.nodes = Levels(f"{path}/nodes", newest(LEAF, MEASURES), ("day",), fan)

    def add(self, passes: DataFrame, batch_id: int) -> None:
        """Add a micro-batch, which should be held in memory; a replayed one changes nothing."""
        spark = passes.sparkSession
        known = self.nodes.manifest(spark)
        if batch_id <= known.last:
            return
        rows = passes.select(
            F.to_date("pass_ts").alias("day"), "device_id", F.date_trunc("minute", "pass_ts").alias("minute"),
            F.second("pass_ts").alias("second"), "pass_ts", "event_id", *MEASURES,
        )
        self.log.add(rows, batch_id)
        counts = rows.groupBy(*LEAF).agg(F.count(F.lit(1)).alias("n")).persist()
        before = None
        if known.parts:
            minutes = counts.select(*MINUTE).distinct()
            before = newest(LEAF, MEASURES)(_null_safe(self.nodes.rows(spark), minutes, MINUTE, "left_semi")).persist()
        try:
            late = before and _null_safe(before, counts, LEAF, "left_semi").select(*LEAF)
            if late and not late.isEmpty():
                # All passes of those seconds, these of the batch included: the log has them by now.
                rows = _null_safe(rows, late, LEAF, "left_anti").unionByName(_null_safe(self.log.read(spark), late, LEAF, "left_semi"))
                top = rows.groupBy(*LEAF).count().agg(F.max("count"))
            else:
                top = counts.agg(F.max("n"))
            self._write(rows, (top.first()[0] or 0) > self.piece, before, batch_id)
        finally:
            for held in (counts, before):
                if held:
                    held.unpersist()

    def _write(self, rows: DataFrame, busy: bool, before: DataFrame | None, batch_id: int) -> None:
        leaves = leaf_runs(rows, self.piece, busy).persist()
        try:
            all_leaves = leaves
            if before is not None:
                others = _null_safe(before.where(F.col("second") != ROOT), leaves, LEAF, "left_anti")
                all_leaves = leaves.unionByName(others)
            # A minute has sixty leaves at most.
            roots = _composed(all_leaves, MINUTE, "second").select(*MINUTE, F.lit(ROOT).alias("second"), *MEASURES)
            self.nodes.add(leaves.unionByName(roots), batch_id)
        finally:
            leaves.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """Running mean per device-minute over all passes in order of (pass_ts, event_id)."""
        roots = newest(LEAF, MEASURES)(self.nodes.rows(spark).where(F.col("second") == ROOT))
        return roots.selectExpr("device_id", "minute", *[f"{step_maps.mean_of(m)} as {m}" for m in MEASURES])


def leaf_runs(rows: DataFrame, piece: int, busy: bool) -> DataFrame:
    """What the passes of each device-second do to the means; where some are ``busy``, of more than ``piece`` passes, these are cut."""
    if not busy:
        return _runs(rows, LEAF)
    large = _stored(rows.groupBy(*LEAF).count().where(F.col("count") > piece).select(*LEAF), "busy")
    quiet = _runs(_null_safe(rows, large, LEAF, "left_anti"), LEAF)
    # In ranges of the whole order, so that a busy second spreads over many tasks.
    order = [*LEAF, "pass_ts", "event_id"]
    ranged = _null_safe(rows, large, LEAF, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("piece", F.floor(F.col("at") / piece))
    pieces = _runs(placed, [*LEAF, "piece"])
    return quiet.unionByName(_composed(pieces, LEAF, "piece"))


def _runs(rows: DataFrame, group: list[str]) -> DataFrame:
    gathered = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("pass_ts", "event_id", *MEASURES))).alias("r"))
    return gathered.selectExpr(*group, *[f"{step_maps.run_of(f'r.{m}')} as {m}" for m in MEASURES])


def _composed(runs: DataFrame, group: list[str], order: str) -> DataFrame:
    gathered = runs.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(order, *MEASURES))).alias("r"))
    return gathered.selectExpr(*group, *[f"{step_maps.composed_all(f'r.{m}')} as {m}" for m in MEASURES])


def _null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join in which null keys, of passes without a device or time, are equal to each other."""
    named = right.select(*[F.col(c).alias(f"_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(named, same, how)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again, so that a lost executor repeats no more than this."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
