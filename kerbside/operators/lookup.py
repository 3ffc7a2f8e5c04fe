"""Equality lookups of passes against reference tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import use_checkpoints

# Largest measured table that is sent to every executor, in bytes of its JSON text.
BROADCAST_BYTES = 64 * 1024 * 1024
# Past this estimate a table is not worth measuring: it will not fit.
MEASURE_BYTES = 64 * BROADCAST_BYTES
# Spark's estimates reach this only where it knows nothing, as for a database table.
UNKNOWN_BYTES = 1 << 60

# Rows of both sides that a partition of `even_join` takes.
ROWS_A_PARTITION = 500_000

Join = Callable[..., DataFrame]


def last_row_wins(table: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``."""
    rest = [c for c in table.columns if c not in (key, order)]
    latest = F.max_by(F.struct(*rest), F.col(order)).alias("row")
    return table.groupBy(key).agg(latest).select(key, *[F.col(f"row.{c}").alias(c) for c in rest])


def lookup_join(
    fact: DataFrame, table: DataFrame, key: str, how: str = "inner", counted_on: DataFrame | None = None
) -> DataFrame:
    """``fact`` joined with a reference table that has one row per ``key``."""
    sized, join = size_up(table)
    return join(fact, sized, key, how, counted_on)


def size_up(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, Join]:
    """The table and the join that suits its size.

    Where Spark's own estimate is below its broadcast threshold it will
    broadcast by itself. Above that the table is measured once, unless it is
    plainly too large; what fits is broadcast, what does not is joined with the
    busy keys spread out.
    """
    estimate = _estimated_bytes(table)
    if estimate <= _planner_threshold(table):
        return table, plain_join
    worth_measuring = estimate <= MEASURE_BYTES or estimate >= UNKNOWN_BYTES
    if worth_measuring and measured_bytes(table) <= max_bytes:
        return F.broadcast(table), plain_join
    return table, salted_join


def _estimated_bytes(table: DataFrame) -> int:
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _planner_threshold(table: DataFrame) -> int:
    return int(str(table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def measured_bytes(table: DataFrame) -> int:
    return table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def plain_join(
    fact: DataFrame, table: DataFrame, key: str, how: str, counted_on: DataFrame | None = None
) -> DataFrame:
    return fact.join(table, key, how)


def salted_join(
    fact: DataFrame, table: DataFrame, key: str, how: str, counted_on: DataFrame | None = None
) -> DataFrame:
    """Join where the rows of a busy key, and of no key at all, go to many tasks.

    A key with more rows than a shuffle partition has on average is busy; there
    are fewer of these than partitions. It gets a number of salts in proportion
    to its rows, all busy keys together at most two per shuffle partition, so
    ``table`` grows by no more than that. The salt is a hash of the row, which a repeated task computes again.
    ``counted_on`` is a frame with the same keys that is cheaper to count,
    such as ``fact`` before earlier joins.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(_salts_per_key(fact if counted_on is None else counted_on, key, partitions))
    hashable = [f"`{name}`" for name, kind in fact.dtypes if "map<" not in kind]
    salts = F.when(F.col(key).isNull(), partitions).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = fact.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*hashable), salts))
    every_salt = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))
    spread = table.join(hot, key, "left").select(*table.columns, every_salt.alias("_salt"))
    joined = salted.drop("_salts").join(spread, [key, "_salt"], how)
    return joined.drop("_salt")


def even_join(left: DataFrame, right: DataFrame, key: str, rows: int = ROWS_A_PARTITION) -> DataFrame:
    """Inner join of two stored tables of nearly unique keys, in as many partitions as their rows ask for.

    Narrow columns of a stored table can be few bytes in its files and many in memory, so the planner may take a table of
    millions of rows for a small one and send it to every executor, and partitions of a fixed number grow with the tables. Both are
    counted, from the footers of their files where nothing is filtered, and neither is sent whole.
    """
    partitions = max(left.sparkSession.sparkContext.defaultParallelism, -(-(left.count() + right.count()) // rows))
    return left.repartition(partitions, key).join(right.repartition(partitions, key).hint("merge"), key)


def _salts_per_key(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """(key, _salts) of the keys with more than a partition's share of all rows."""
    use_checkpoints(rows.sparkSession)
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    total = counted.agg(F.sum("_n")).first()[0] or 0
    busy = counted.filter(F.col("_n") * partitions > total)
    return busy.select(key, F.ceil(F.col("_n") * partitions / F.lit(max(total, 1))).cast("int").alias("_salts"))
