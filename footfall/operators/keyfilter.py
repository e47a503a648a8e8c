"""A Bloom filter of join keys as a small table, built and probed with built-in functions.

The filter is blocked: a key's hash names a block (one row of the table), a 64-bit word in it and
four bits of that word.  Building it is a partial aggregate (``bit_or``) of hashes; probing it is a
broadcast join on the block number and one comparison, so the probed rows do not move.  A key that
went in always passes; at ``BITS_PER_KEY`` about one in a hundred others does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
#: The filter's bits in memory; with more keys than fit at ``BITS_PER_KEY`` more rows pass, and
#: the exact join that follows decides them all the same.
MAX_FILTER_BYTES = 64 * 2**20
_WORDS = 64
_BITS_SET = 4


def _place(keys: list[Column], blocks: int) -> tuple[Column, Column, Column]:
    """Block, word and bits of a key; disjoint parts of its hash."""
    h = F.xxhash64(*keys)
    mask = F.lit(0).cast("long")
    for i in range(_BITS_SET):
        bit = F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    word = F.shiftright(h, 6 * _BITS_SET).bitwiseAND(F.lit(_WORDS - 1)).cast("int")
    # never null, so that no null check tells apart the two uses of the filter's broadcast
    block = F.coalesce(F.pmod(F.shiftright(h, 6 * _BITS_SET + 6), F.lit(blocks)).cast("int"), F.lit(0))
    return block, word, mask


def blocks_for(n_keys: int, max_bytes: int = MAX_FILTER_BYTES) -> int:
    """Blocks (rows of the filter) for so many keys, at most ``max_bytes`` in all."""
    wanted = -(-n_keys * BITS_PER_KEY // (64 * _WORDS))
    return max(1, min(wanted, max_bytes // (8 * _WORDS)))


def key_filter(keys: DataFrame, on: list[str], blocks: int) -> DataFrame:
    """The filter of the keys ``on``: ``block`` and its ``words``, one row per block that is not
    empty.  Null keys match nothing and are left out; repeated keys change nothing."""
    block, word, mask = _place([F.col(c) for c in on], blocks)
    words = (keys.dropna(subset=on).select(block.alias("block"), word.alias("word"), mask.alias("mask"))
             .groupBy("block", "word").agg(F.bit_or("mask").alias("mask")))
    of_block = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("set"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)),
                         lambda i: F.coalesce(F.try_element_at("set", i), F.lit(0).cast("long")))
    return of_block.select("block", filled.alias("words"))


def split_by_filter(df: DataFrame, keys: DataFrame, on: list[str],
                    max_bytes: int = MAX_FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key in ``keys``, rows that surely have none), without moving a row.

    Rows with a null in ``on`` have none.  The keys are counted first (one job), which sizes the
    filter; it is broadcast at no more than ``max_bytes`` of bits.  The two frames share that
    broadcast, and each reads ``df``."""
    for c in on:
        if df.schema[c].dataType != keys.schema[c].dataType:
            raise ValueError(f"{c} is {df.schema[c].dataType} here and {keys.schema[c].dataType} in the keys")
    blocks = blocks_for(keys.count(), max_bytes)
    block, word, mask = _place([F.col(f"s.{c}") for c in on], blocks)
    probed = df.alias("s").join(F.broadcast(key_filter(keys, on, blocks)).alias("f"), block == F.col("f.block"), "left")
    may = F.element_at("f.words", word + 1).bitwiseAND(mask) == mask
    for c in on:
        may = may & F.col(f"s.{c}").isNotNull()
    may = F.coalesce(may, F.lit(False))
    return probed.where(may).select("s.*"), probed.where(~may).select("s.*")
