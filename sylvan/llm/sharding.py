"""Shards by jump consistent hashing (operator 8), in DataFrame functions only.

A key and the number of shards decide the shard; there is no ring table.
With one more shard, a key either stays or moves into the new shard.

The hash steps a 64-bit generator; Spark's long product must not overflow,
so the state is kept as two 32-bit halves.

Integer keys are used as they are; keys of other types are hashed first.
A null key counts as 0.  Repeated rows get the same shard and slots of
their own; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import fresh, materialize, quoted

#: Fixed value: the multiplier of the generator.
MULTIPLIER = 2862933555777941757
_MASK = (1 << 32) - 1
_M_HI, _M_LO = MULTIPLIER >> 32, MULTIPLIER & _MASK


def _times(a: Column, m: int) -> tuple[Column, Column]:
    """Low 32 bits of ``a * m`` and what carries over, for ``a`` and ``m`` below 2^32."""
    low, high = a.bitwiseAND(F.lit(0xFFFF)) * F.lit(m), F.shiftright(a, 16) * F.lit(m)
    total = low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)
    return total.bitwiseAND(F.lit(_MASK)), F.shiftright(total, 32) + F.shiftright(high, 16)


def _step(state: Column, n: int) -> Column:
    """One jump; the state stands still once the next bucket lies beyond ``n``."""
    hi, lo = state["hi"], state["lo"]
    p_lo, p_hi = _times(lo, _M_LO)
    plus = p_lo + F.lit(1)                        # the generator's increment
    new_lo = plus.bitwiseAND(F.lit(_MASK))
    new_hi = (p_hi + F.shiftright(plus, 32) + _times(hi, _M_LO)[0] + _times(lo, _M_HI)[0]
              ).bitwiseAND(F.lit(_MASK))
    jump = F.floor((state["next"] + F.lit(1)).cast("double")
                   * (F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + F.lit(1)).cast("double")))
    moved = F.struct(new_hi.alias("hi"), new_lo.alias("lo"), state["next"].alias("shard"), jump.alias("next"))
    return F.when(state["next"] < n, moved).otherwise(state)


def jump_hash(key: Column, n: int) -> Column:
    """Shard 0 to ``n`` - 1 of a long key."""
    if n < 1:
        raise ValueError("the number of shards must be at least 1")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_MASK)).alias("lo"),
                     F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))
    # every jump goes forward by a shard at least: n steps always reach the end
    last = F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, lambda s, _: _step(s, n))
    return last["shard"].cast("int")


def long_key(docs: DataFrame, name: str) -> Column:
    """The key column as a long: integers as they are, all else hashed, null as 0."""
    col = quoted(name)
    whole = isinstance(docs.schema[name].dataType, T.IntegralType)
    return F.coalesce(col.cast("long") if whole else F.when(col.isNotNull(), F.xxhash64(col)), F.lit(0).cast("long"))


def assign_shards(docs: DataFrame, n: int = 16, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` plus its shard, without any shuffle."""
    (out,) = fresh(docs, out)
    return docs.withColumn(out, jump_hash(long_key(docs, key), n))


def shard_manifest(docs: DataFrame, n: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots count from 0 within each shard in the order of (doc_id, checksum,
    size).  They come from one range partitioning of these small rows by
    (shard, order): the place within a partition plus the rows of that shard
    in earlier partitions, of which there is one count per partition and
    shard that meet.  Equal rows are told apart by a number, so no key makes
    a partition that can't be split.
    """
    body = F.coalesce(quoted(text).cast("string"), F.lit(""))
    small = materialize(docs.select(
        quoted(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_hash(long_key(docs, key), n).alias("shard"),
        jump_hash(long_key(docs, key), n + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row")))
    order = ["shard", "doc_id", "text_crc32", "size", "row"]
    placed = materialize(small.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id())
                         .withColumn("part", F.shiftright("at", 33)))
    counts = placed.groupBy("part", "shard").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    base = _before(counts)       # at most partitions + shards rows, each a count
    return (placed.join(F.broadcast(base), ["part", "shard"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("at") - F.col("first")).alias("slot"), "grown_shard"))


def _before(counts: DataFrame) -> DataFrame:
    """Rows of the same shard in earlier partitions."""
    from pyspark.sql import Window

    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", "shard", "first",
                         F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))

