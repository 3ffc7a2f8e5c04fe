"""Float arithmetic that has to agree to the last digit with stored values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647


# The steps of the running mean are SQL texts, as they stand inside lambda functions.


def hundredths(n: str) -> str:
    """An int count of hundredths as a float."""
    return f"cast(cast({n} as float) / 100 as float)"


def halving_ticks(mean: str, value: str) -> str:
    """Mean of two floats in whole hundredths, cut towards zero and held inside int range.

    NaN counts as 0. Null gives null, but speed and length are required fields.
    """
    half = f"cast(({mean} + {value}) / 2 as float)"
    scaled = f"cast(nanvl({half} * cast(100 as float), cast(0 as float)) as double)"
    held = f"cast(least(greatest({scaled}, {INT_MIN}D), {INT_MAX}D) as int)"
    # `least` and `greatest` skip nulls.
    return f"if({mean} is null or {value} is null, null, {held})"


def halving_mean(mean: str, value: str) -> str:
    """One step of the running mean that weighs the newest value one half."""
    return hundredths(halving_ticks(mean, value))


def excess_rate(speed: Column, limit: Column) -> Column:
    """Share by which ``speed`` passes ``limit``, two decimals, ties to even.

    The rounding reads the float's exact value (hence the double), and a limit
    of zero gives null.
    """
    over = F.try_divide((speed - limit).cast("float"), limit).cast("float")
    return F.bround(over.cast("double"), 2).cast("float")
