"""Resume against earlier outputs through a stored membership filter.

The filter is a table of blocks: a key's hash chooses the block and a few bits
in it.  A key with a bit unset was never stored; it needs no shuffle.  Keys
with all bits set, the stored ones and about one in a hundred others, are
compared with the stored keys themselves.  Filters of several outputs are
merged by OR.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.session import join_facts

WORDS = 512  # longs in a block
BITS = WORDS * 64
PROBES = 7
BITS_PER_KEY = 10
BROADCAST_BYTES = 64 << 20


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys: a power of two."""
    return 1 << max(0, math.ceil(math.log2(max(1, keys * BITS_PER_KEY / BITS))))


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(blocks)).cast("int")


def _bits(key: str) -> list[Column]:
    """The bits of a key in its block."""
    text = F.col(key).cast("string")
    one, two = F.xxhash64(text, F.lit(1)), F.xxhash64(text, F.lit(2))
    # An odd step, so that a key's bits differ.
    start, step = F.pmod(one, F.lit(BITS)), F.pmod(two, F.lit(BITS // 2)) * 2 + 1
    return [F.pmod(start + step * i, F.lit(BITS)) for i in range(PROBES)]


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block, words``: the filter of all non-null keys; blocks without a key
    have no row.  Bits combine map-side, whatever copies the keys have."""
    bits = keys.filter(F.col(key).isNotNull()).select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
    word = F.floor(F.col("bit") / 64).cast("int").alias("word")
    set_bits = bits.groupBy("block", word).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS INT))")).alias("bits"))
    filled = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    words = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at("found", w), F.lit(0).cast("bigint")))
    return set_bits.groupBy("block").agg(filled.alias("found")).select("block", words.alias("words"))


def merged(filters: list[DataFrame]) -> DataFrame:
    """The filter of all keys of several filters with the same blocks."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    cells = rows.select("block", F.posexplode("words").alias("word", "bits")).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    return cells.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("cells")).select("block", F.col("cells.bits").alias("words"))


def marked(rows: DataFrame, stored: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows with ``_maybe``: whether the key may be among the stored ones.
    The caller has checked that the filter is small enough to broadcast."""
    hit = F.col("_words").isNotNull() & F.col(key).isNotNull()
    for bit in _bits(key):
        word = F.element_at("_words", F.floor(bit / 64).cast("int") + 1)
        hit = hit & (F.getbit(F.coalesce(word, F.lit(0).cast("bigint")), (bit % 64).cast("int")) == 1)
    table = stored.select(F.col("block").alias("_block"), F.col("words").alias("_words"))
    joined = rows.withColumn("_block", _block(key, blocks)).join(F.broadcast(table), "_block", "left")
    return joined.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))


def not_done(rows: DataFrame, done: DataFrame, stored: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows whose key is not among the keys of ``done``; ``stored`` is their
    filter (it may hold more keys, but no fewer).

    Rows that the filter clears stay where they are; only the others are
    shuffled and compared with ``done``.  A row without key was never done.
    Filters above ``BROADCAST_BYTES`` are not sent to every task: then all
    rows are compared.
    """
    keys = done.select(key).filter(F.col(key).isNotNull()).distinct()
    if blocks * WORDS * 8 > BROADCAST_BYTES:
        return join_facts(rows, keys, key, "left_anti")
    probed = marked(rows, stored, key, blocks)
    clear = probed.filter(~F.col("_maybe")).drop("_maybe")
    return clear.unionByName(join_facts(probed.filter("_maybe").drop("_maybe"), keys, key, "left_anti"))
