"""Sharding by jump consistent hashing (Lamping and Veach 2014), in DataFrame functions only.

The key alone and the number of shards decide. With one more shard a row either stays or goes to the new shard, and only the necessary
fraction 1 / (n + 1) goes; there is no ring or table to keep. Rows are then numbered inside their shard without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed value: the multiplier of the published generator, key = key * 2862933555777941757 + 1 modulo 2^64.
MULTIPLIER = 2862933555777941757
_MASK = 0xFFFF


def _next_key(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2^64 in 16-bit limbs, because a long product may not overflow in ANSI mode."""
    c = [(MULTIPLIER >> (16 * i)) & _MASK for i in range(4)]
    a = [F.shiftrightunsigned(key, 16 * i).bitwiseAND(F.lit(_MASK).cast("long")) for i in range(4)]
    out, carry = None, F.lit(1).cast("long")
    for i in range(4):
        limb = sum((a[k] * F.lit(c[i - k]).cast("long") for k in range(i + 1)), carry)
        low = F.shiftleft(limb.bitwiseAND(F.lit(_MASK).cast("long")), 16 * i)
        out = low if out is None else out.bitwiseOR(low)
        carry = F.shiftrightunsigned(limb, 16)
    return out


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a long key. The loop of the algorithm visits at most ``shards`` buckets."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(key.alias("key"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def jump(s: Column, _: Column) -> Column:
        k = _next_key(s["key"])
        step = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(k, 33) + 1).cast("double")))
        going = s["j"] < shards
        return F.when(going, F.struct(k.alias("key"), s["j"].alias("b"), step.alias("j"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", per_block: int = 65_536) -> DataFrame:
    """One row per row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (null: 0) plus 1; ``text_crc32`` is unsigned, 0 for a null or empty text. A null key
    counts as key 0 for the shard and stays null in the result. Keys that are not whole numbers are hashed first. Repeated rows each
    get a slot of their own. ``slot`` runs from 0 in each shard; rows of an empty table give an empty result. Other columns of the
    input, whatever their names, are not read.
    """
    integral = dict(docs.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    raw = F.col(f"`{key}`")
    number = F.coalesce(raw.cast("long"), F.lit(0).cast("long")) if integral else F.xxhash64(raw)
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(
        raw.alias(key),
        (F.octet_length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        number.alias("_spread"),
    )
    rows = rows.withColumns({"shard": jump_hash(F.col("_spread"), shards), "grown_shard": jump_hash(F.col("_spread"), shards + 1)})
    order = ["_spread", key, "size", "text_crc32", "grown_shard"]
    out = common.numbered(rows, ["shard"], order, "slot", per_block)
    return out.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(common.table(spark, sf_dir, "documents"), 8)


QUERIES = {"op4_sharding": op4_sharding}
#: SQL has no CRC-32 here; the query is tested against a plain loop.
ORACLES: dict[str, str] = {}
