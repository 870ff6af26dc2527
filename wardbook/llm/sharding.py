"""Sharding by weighted rendezvous hashing of record keys. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settled

# Rows that one task numbers within a shard.
ROWS_PER_BUCKET = 5_000


def _cost(key: Column, shard: int, weight: float) -> Column:
    """The key's waiting time at a shard: exponential with the shard's weight as rate."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 11)
    unit = (bits.cast("double") + 0.5) / float(1 << 53)
    return F.struct((-F.log(unit) / weight).alias("cost"), F.lit(shard).alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: the one with the lowest cost.

    Each shard's cost depends on the key and that shard alone, so a further
    shard takes keys only into itself and a removed one gives up only its
    own; a shard holds its weight's share of the keys. A null key has the
    costs of one fixed key.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    costs = [_cost(key, i, w) for i, w in enumerate(weights)]
    return (costs[0] if len(costs) == 1 else F.least(*costs))["shard"]


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``slot``, counted from 0 without gaps within each group.

    A group may hold any share of the rows: its rows are numbered within
    buckets of a few thousand and each bucket starts where the ones before
    it end. ``rows`` must be a table that reads the same each time.
    """
    buckets = max(16, rows.count() // ROWS_PER_BUCKET)
    cut = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = cut.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    own = cut.withColumn("_row", F.row_number().over(within) - 1)
    return (
        own.join(starts, [group, "_bucket"])
        .withColumn("slot", F.col("_start") + F.col("_row"))
        .drop("_bucket", "_start", "_row")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """One row per document with its shard, its place there and its shard once one more is added.

    ``size`` is the text's UTF-8 bytes plus 1; a null text has none, as an
    empty one. Repeated rows each get a slot of their own in one shard, null
    ids share a shard, an empty table gives no rows. Only doc_id and text are
    read, so other columns may have any name.
    """
    key, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, grown_weight]).alias("grown_shard"),
    )
    return numbered(settled(rows), "shard", ("doc_id", "text_crc32", "size"))
