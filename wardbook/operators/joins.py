"""Joins that must keep, or must not keep, the multiplicity of the joined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Copies made by one inner explode; more copies come from a second, outer one.
_CHUNK = 4096


def having(df: DataFrame, parent: DataFrame, column: str, parent_key: str = "oid") -> DataFrame:
    """Keep the rows whose parent exists; the parent's key is unique, so nothing multiplies."""
    return df.join(parent.select(F.col(parent_key).alias(column)), column, "left_semi")


def latest_version(df: DataFrame, parent: str, version: str = "oid") -> DataFrame:
    """The row with the highest version of each parent, in one aggregation instead of a self-join."""
    others = [c for c in df.columns if c not in (parent, version)]
    return df.groupBy(parent).agg(
        F.max(version).alias(version), *[F.max_by(c, version).alias(c) for c in others]
    )


def count_per(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key. Joined in place of the rows themselves, it carries their multiplicity as a number."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def repeat_rows(df: DataFrame, times: str | Column) -> DataFrame:
    """Emit each row ``times`` times, at least once, as a left join with that many partners would.

    A row of many copies is cut into chunks, and the chunks of all rows are
    dealt out evenly before they become copies: no task makes more than its
    share, however the copies are spread over the rows.
    """
    columns = df.columns
    n = F.greatest(F.coalesce(F.col(times) if isinstance(times, str) else times, F.lit(1)), F.lit(1))
    chunks = (
        df.withColumn("_n", n.cast("bigint"))
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(_CHUNK).cast("bigint"))))
        .withColumn("_size", F.least(F.lit(_CHUNK).cast("bigint"), F.col("_n") - F.col("_from")))
    )
    # A number of its own: by the size of the chunks alone they would be gathered into few tasks again.
    dealt = chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size")))).select(*columns)


def with_partner_count(df: DataFrame, partners: DataFrame, on: str, name: str) -> DataFrame:
    """The first half of ``fan_out_left``: the number of partners, NULL for none.

    For rows that go through further joins before ``repeat_rows`` multiplies them.
    """
    return df.join(count_per(partners, on, name), on, "left")


def fan_out_left(df: DataFrame, partners: DataFrame, on: str) -> DataFrame:
    """Left join that projects nothing of the partners: rows repeat once per partner.

    The partners shrink to one counter per key before they are shuffled or joined.
    """
    return repeat_rows(with_partner_count(df, partners, on, "_partners"), "_partners").select(*df.columns)


def weighted(df: DataFrame, partners: DataFrame, on: str, weight: str) -> DataFrame:
    """Inner fan-out join for counting: keeps one row per row of ``df`` and multiplies its weight."""
    joined = df.join(count_per(partners, on, "_partners"), on)
    product = F.col(weight).cast("decimal(38,0)") * F.col("_partners").cast("decimal(20,0)")
    return joined.withColumn(weight, product.cast("decimal(38,0)")).drop("_partners")
