"""Reference tables as snapshots: watchlist, gates, dimensions, detail rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.lookup import last_row_wins


def read_table(spark: SparkSession, source: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A table from a parquet path, or from a database where ``source`` is a ``jdbc:`` URL.

    For a database name the table in ``options``; give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a large one in parallel.
    """
    if source.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=source, **(options or {})).load()
    return spark.read.options(**(options or {})).parquet(source)


def load_watchlist(prey: DataFrame, order: str = "seq") -> DataFrame:
    """One row (plate, bkxxbh, bkjb) per plate: the one read last, by ``order``.

    The plate column may also bear its database name, HPHM. A table without
    ``order`` has no last row; there the content settles repeated plates.
    """
    named = {c.lower(): c for c in prey.columns}
    rows = prey.select(
        F.col(named.get("plate") or named["hphm"]).alias("plate"),
        F.col(named["bkxxbh"]).alias("bkxxbh"),
        F.col(named["bkjb"]).alias("bkjb"),
        (F.col(order) if order in prey.columns else F.struct(named["bkxxbh"], named["bkjb"])).alias("_order"),
    )
    return last_row_wins(rows, "plate", "_order")


def load_gates(gate: DataFrame, order: str | None = None) -> DataFrame:
    """One row (id as text, speedlimit) per gate: the one read last, by ``order``.

    A table without ``order`` has no last row; there the content settles repeated ids.
    """
    last = F.col(order) if order and order in gate.columns else F.col("speedlimit")
    return last_row_wins(gate.select(F.col("id").cast("string"), "speedlimit", last.alias("_order")), "id", "_order")


def load_dim(dim: DataFrame, key: str) -> DataFrame:
    """(key, attrs): the JSON object as a map. An unknown key finds no row, hence null."""
    return dim.select(key, F.from_json("doc", "map<string,string>").alias("attrs"))
