"""A test of fact rows against the keys of a large reference table, before the fact is exchanged.

The keys set bits in a bit field by two hashes, a Bloom filter in blocks of 32,768 bits. Its size follows the number of keys up to a
fixed bound, so the field is small enough to be sent to every task whatever the table is. Fact rows whose bits are
not set cannot have a partner and stay where they are; the few others go through the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.lookup import salted_join
from kerbside.session import use_checkpoints

# Fixed value: bits of one bitmap of the engine.
BLOCK = 32768
BITS_PER_KEY = 16
#: 64 MB; past some 30 million keys the filter lets more rows through, and none is lost.
MAX_BITS = 1 << 29


def _spot(key: Column, hash_: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(hash_)), F.lit(bits))


def key_bits(table: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block, hash, bits) with the keys' bits set, and the number of bits for each hash."""
    keys = table.select(F.col(key).alias("k")).where("k is not null")
    wanted = max(BLOCK, (keys.count() * BITS_PER_KEY) // 2)
    bits = min(MAX_BITS // 2, 1 << (wanted - 1).bit_length())
    spots = keys.select(F.explode(F.array(*[
        F.struct(F.lit(h).alias("hash"), _spot(F.col("k"), h, bits).alias("at")) for h in (1, 2)])).alias("s"))
    field = spots.groupBy("s.hash", F.floor(F.col("s.at") / BLOCK).alias("block")).agg(
        F.bitmap_construct_agg((F.col("s.at") % BLOCK).cast("int")).alias("bits"))
    use_checkpoints(table.sparkSession)
    return field.checkpoint(), bits


def possible(fact: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows of ``fact`` that may have a partner in ``table``; their order and columns stay."""
    field, bits = key_bits(table, key)
    found = fact
    for h in (1, 2):
        block, held, at = f"_block{h}", f"_bits{h}", _spot(F.col(key), h, bits)
        own = F.broadcast(field.where(F.col("hash") == h).select(F.col("block").alias(block), F.col("bits").alias(held)))
        found = found.join(own, F.floor(at / BLOCK) == F.col(block))
        octet = F.conv(F.hex(F.substring(F.col(held), (F.floor((at % BLOCK) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        found = found.where(F.getbit(octet, (at % 8).cast("int")) == 1).drop(block, held)
    return found


def prefiltered_join(
    fact: DataFrame, table: DataFrame, key: str, how: str = "inner", counted_on: DataFrame | None = None
) -> DataFrame:
    """An inner join with a large table: only rows that pass the test are counted, salted and exchanged."""
    if how != "inner":
        raise ValueError(f"rows without a partner are dropped before the join, so it cannot be {how}")
    use_checkpoints(fact.sparkSession)
    return salted_join(possible(fact, table, key).checkpoint(), table, key, how)
