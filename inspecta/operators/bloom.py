"""A Bloom filter of keys built and tested with built-in functions only.

The filter is a table of blocks: a key's hash names its block and ``HASHES`` bits in
it.  Tasks or the bits of their keys by (block, word) before anything is shuffled, so
partial filters are merged; a block is an array of 64-bit words.  Testing a table joins
the broadcast blocks by number, map-side.  A key of the filter always tests true; other
keys do with a small probability, so what tests false can skip any join with the keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15
BITS_PER_KEY = 10.0
HASHES = 4                      # about 1 % false positives at 10 bits a key
MAX_BYTES = 256 << 20           # of a filter that is broadcast; beyond it bits per key get fewer


class KeyFilter:
    """Filter of ``n`` (distinct, about) keys in column ``key`` of ``keys``."""

    def __init__(self, keys: DataFrame, key: str, n: int, bits_per_key: float = BITS_PER_KEY, hashes: int = HASHES,
                 block_bits: int = BLOCK_BITS, max_bytes: int = MAX_BYTES):
        self.block_bits, self.hashes = block_bits, hashes
        self.blocks = max(1, min(math.ceil(n * bits_per_key / block_bits), max_bytes * 8 // block_bits))
        k = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"))
        bits = (k.select(self._block(F.col("k")).alias("block"), F.explode(F.array(*self._places(F.col("k")))).alias("p"))
                .select("block", F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
                .groupBy("block", "w").agg(F.bit_or("b").alias("b"))
                .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m")))
        words = F.sequence(F.lit(0), F.lit(max(1, block_bits // 64) - 1))
        self.rows = bits.select(F.col("block").alias("_block"), F.transform(
            words, lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("_words"))

    def _block(self, k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(self.blocks))

    def _places(self, k: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(i), k), F.lit(self.block_bits)).cast("int") for i in range(self.hashes)]

    def test(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a boolean column ``name``: false for rows whose key is NULL or
        surely not in the filter.  At most ``MAX_BYTES`` are broadcast."""
        k = F.col(key).cast("string")
        hit = F.col("_words").isNotNull() & F.col(key).isNotNull()
        for p in self._places(k):
            hit = hit & (F.getbit(F.get("_words", F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1)
        return (df.withColumn("_block", self._block(k)).join(F.broadcast(self.rows), "_block", "left")
                .withColumn(name, F.coalesce(hit, F.lit(False))).drop("_block", "_words"))
