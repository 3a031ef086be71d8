"""Bloom filters as bitmaps in blocks of bounded size, built and tested by DataFrame functions.

The number of slots follows the number of keys; the slots are cut into blocks by the key's hash, each of at most MAX_SLOTS bits. Of several blocks one is broadcast at a time: the rows tested by it
are a stored table before the next one's turn comes, so that neither the driver nor an executor holds more than one block's bits (once for each probe). Rows that
a filter rules out pass or go without a shuffle; only the others are joined with the set itself, so results are exact. With SLOTS_PER_KEY slots for each key and two
probes 5 % of the other rows at most are taken for members, at every size. Rows are read once for each block; one block holds 268 million keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, stored

MAX_SLOTS = 1 << 31  # 256 MB of bits
SLOTS_PER_KEY = 8
PROBES = 2
#: Slots for each row where slots are counted, never held as bits: one row in so many is taken for a copy by chance.
SLOTS_PER_ROW = 1024


def slots_for(keys: int) -> int:
    return max(1 << 15, 1 << max(0, keys * SLOTS_PER_KEY - 1).bit_length())


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(blocks))


def slots_of(key: Column, slots: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(slots)) + 1 for seed in range(PROBES)]


def bits_set(keys: DataFrame, key: str, slots: int) -> DataFrame:
    """(bucket, bits) of all keys' slots."""
    slot = keys.select(F.explode(F.array(*slots_of(F.col(f"`{key}`"), slots))).alias("slot"))
    return slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def with_test(rows: DataFrame, key: Column, bits: DataFrame, slots: int, flag: str) -> DataFrame:
    """Adds flag: whether all slots of the key are set. False is certain."""
    keep, test = [F.col(f"`{c}`") for c in rows.columns], F.lit(True)
    for k, slot in enumerate(slots_of(key, slots)):
        at, bucket, held = fresh(rows, "_ms_slot", "_ms_bucket", "_ms_bits")
        rows = rows.withColumn(at, slot)
        side = F.broadcast(bits.select(F.col("bucket").alias(bucket), F.col("bits").alias(held)))
        rows = rows.join(side, F.bitmap_bucket_number(at) == F.col(bucket), "left")
        byte = f"substring(`{held}`, cast(bitmap_bit_position(`{at}`) div 8 as int) + 1, 1)"
        test = test & F.expr(f"coalesce(shiftright(cast(conv(hex({byte}), 16, 10) as int), cast(bitmap_bit_position(`{at}`) % 8 as int)) & 1, 0) = 1")
    return rows.select(*keep, test.alias(flag))


class Filter:
    """A filter of the keys of a stored table; count: how many they are, or more."""

    def __init__(self, keys: DataFrame, key: str, count: int, max_slots: int | None = None):
        slots, most = slots_for(count), max_slots or MAX_SLOTS
        self.blocks, self.slots = max(1, -(-slots // most)), min(slots, most)
        self.bits = []
        for b in range(self.blocks):
            own = keys.filter(block_of(F.col(f"`{key}`"), self.blocks) == b) if self.blocks > 1 else keys
            self.bits.append(stored(bits_set(own, key, self.slots), "bits"))

    def tested(self, rows: DataFrame, key: Column, flag: str) -> DataFrame:
        """rows with the flag; each block's rows are tested with its bits, and stored where there are several blocks. False is certain."""
        if self.blocks == 1:
            return with_test(rows, key, self.bits[0], self.slots, flag)
        parts = [stored(with_test(rows.filter(block_of(key, self.blocks) == b), key, bits, self.slots, flag), "tested") for b, bits in enumerate(self.bits)]
        return reduce(DataFrame.unionByName, parts)


def counted_slot(key: Column, rows: int) -> Column:
    """The slot of a key in the filter of pass one over so many rows."""
    return F.pmod(F.xxhash64(key, F.lit(11)), F.lit(max(1 << 20, rows * SLOTS_PER_ROW)))


def set_twice(rows: DataFrame, slot: str) -> DataFrame:
    """Pass one: the slots that more than one row sets. They are counted in each task before they are dealt out by number, 8 bytes a row, and stay dealt out."""
    return stored(rows.groupBy(slot).agg(F.count("*").alias("times")).filter("times > 1").select(slot), "repeated")


def only(rows: DataFrame, column: str, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose column is among the keys (count of them, stored); others, but for 5 % at most, aren't shuffled."""
    names = [F.col(f"`{c}`") for c in rows.columns]
    flag, of = fresh(rows, "_ms_maybe", "_ms_key")
    maybe = Filter(keys, key, count).tested(rows, F.col(f"`{column}`"), flag).filter(F.col(flag))
    return maybe.join(keys.select(F.col(f"`{key}`").alias(of)).distinct(), F.col(f"`{column}`") == F.col(of), "left_semi").select(*names)


def without(rows: DataFrame, column: str, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose column isn't among the keys; of the rows that stay, all but 5 % at most aren't shuffled."""
    names = [F.col(f"`{c}`") for c in rows.columns]
    flag, of = fresh(rows, "_ms_maybe", "_ms_key")
    tested = Filter(keys, key, count).tested(rows, F.col(f"`{column}`"), flag)
    maybe = tested.filter(F.col(flag)).join(keys.select(F.col(f"`{key}`").alias(of)), F.col(f"`{column}`") == F.col(of), "left_anti")
    return tested.filter(~F.col(flag)).select(*names).unionByName(maybe.select(*names))
