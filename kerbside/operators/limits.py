"""Speeding violations against the limits of the gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.functions import keys
from kerbside.functions.numbers import excess_rate
from kerbside.functions.timing import time_text
from kerbside.operators.lookup import Join, lookup_join


def limit_for(limit_text: Column, vehicle_type: Column) -> Column:
    """Limit as float: one value for all, or a list indexed by vehicle type from 0.

    Null where the type is past the list or the text is no number.
    """
    of_type = F.when(vehicle_type >= 0, F.try_element_at(F.split(limit_text, ","), vehicle_type + 1))
    return F.when(limit_text.contains(","), of_type).otherwise(limit_text).try_cast("float")


def with_limit(passes: DataFrame, gates: DataFrame, how: str = "inner", join: Join = lookup_join) -> DataFrame:
    """Passes with ``limit`` and whether their gate is ``known``; ``gates`` has one row (id, speedlimit) per gate."""
    at_gate = gates.select(F.col("id").alias("device_id"), "speedlimit", F.lit(True).alias("known"))
    joined = join(passes, at_gate, "device_id", how)
    return joined.withColumns({
        "limit": limit_for(F.col("speedlimit"), F.col("vehicle_type")), "known": F.coalesce("known", F.lit(False)),
    })


USED = ("device_id", "vehicle_type", "speed", "plate", "plate_type", "chan_index", "dir", "site_id", "illegal_type")


def _violates() -> Column:
    return F.col("speed") > F.col("limit")


def overspeed(passes: DataFrame, gates: DataFrame, join: Join = lookup_join) -> DataFrame:
    """One row per violation: row key and 14 text cells, three of them always empty."""
    used = passes.select(*USED, time_text(passes).alias("WFSJ"))
    return violations(with_limit(used, gates, join=join))


def violations(limited: DataFrame) -> DataFrame:
    """The violations among passes with limits; their time as text is ``WFSJ``."""
    over = limited.filter(_violates())

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    return over.select(
        keys.violation_key(F.col("WFSJ"), F.col("plate"), F.col("device_id")).alias("row_key"),
        F.col("device_id").alias("KKBH"),
        text("chan_index").alias("CLBH"),
        text("dir").alias("FXBH"),
        F.col("plate").alias("HPHM"),
        F.col("plate_type").alias("HPZL"),
        F.col("site_id").alias("WFDD"),
        "WFSJ",
        text("illegal_type").alias("WFXW"),
        text("speed").alias("CLSD"),
        text("vehicle_type").alias("CLLX"),
        F.lit("").alias("TZTX"),
        F.lit("").alias("QJTX"),
        excess_rate(F.col("speed"), F.col("limit")).cast("string").alias("CSB"),
        F.lit("").alias("SFCL"),
    )


def unknown_gates(passes: DataFrame, gates: DataFrame) -> DataFrame:
    """Passes at gates without a limit row."""
    return lookup_join(passes, gates.select(F.col("id").alias("device_id")), "device_id", "left_anti")


def unusable_limits(passes: DataFrame, gates: DataFrame) -> DataFrame:
    """Passes whose gate is known but gives them no limit to divide by, with the reason."""
    return unusable(with_limit(passes, gates))


def unusable(limited: DataFrame) -> DataFrame:
    """The same of passes with limits; those at unknown gates are no part of it."""
    limited = limited.filter("known")
    reason = (
        F.when(F.col("limit") == 0, "zero limit")
        .when(F.col("limit").isNotNull(), None)
        .when(
            F.col("speedlimit").contains(",")
            & ((F.col("vehicle_type") < 0)
               | (F.col("vehicle_type") >= F.size(F.split("speedlimit", ",")))),
            "type past the list",
        )
        .otherwise("not a number")
    )
    return limited.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def counters() -> list[Column]:
    """Passes seen and violations among them, over a frame with ``limit``."""
    return [F.count(F.lit(1)).alias("all"), F.count_if(_violates()).alias("illegal")]


def overspeed_counters(passes: DataFrame, gates: DataFrame) -> DataFrame:
    """Exact totals of a pass table; passes at unknown gates count as seen."""
    used = passes.select("device_id", "vehicle_type", "speed")
    return with_limit(used, gates, "left").agg(*counters())


def observed(limited: DataFrame, to: Observation | str) -> DataFrame:
    """The same totals as a side result of whatever else runs over ``limited``.

    ``to`` is an ``Observation`` in batch, a metric name in a stream.
    """
    return limited.observe(to, *counters())
