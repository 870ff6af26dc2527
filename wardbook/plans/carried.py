"""Bed occupancy carried forward from run to run.

The state is the sum of all stays' changes per place and day: what a stay adds
on its first day and takes back after its last. It has at most one row per
place and day, however many stays there are. A run adds the changes of just
those stays that are new, gone or different since the run before, whatever
days they concern, and publishes the days that this can have altered.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.functions.codes import SPINE_START
from wardbook.functions.scalars import whole_days
from wardbook.operators.intervals import DailySpine, _as_date, sum_steps
from wardbook.sources.publish import publish, published

from .common import beds, stays
from .occupancy import daily_occupancy, places

AMOUNTS = ("occupied", "closed_days", "open_stays", "open_since")
_EPOCH = DailySpine.of("1970-01-01", "1970-01-01")
_STATE = "ocupacion_acumulado"


def placed_stays(t, grain: str = "reference") -> DataFrame:
    """The stays with the place of their bed: all that the occupancy of a day depends on."""
    keys = places(grain)
    return stays(t).join(beds(t).select("bed", "site", "floor"), "bed").select(*keys, "start", "end")


def changed(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Rows of ``after`` that ``before`` lacks with ``weight`` 1, and the other way round with -1, as often as they differ.

    Without ``before`` all rows are new. A feed of changes can take its place:
    an altered stay is its old row with -1 and its new one with 1.
    """
    new = after.withColumn("weight", F.lit(1).cast("long"))
    if before is None:
        return new
    both = new.unionByName(before.withColumn("weight", F.lit(-1).cast("long")))
    return both.groupBy(*after.columns).agg(F.sum("weight").alias("weight")).filter("weight != 0")


def changes_by_day(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted stays as summed changes per place and day ``k``, counted from 1970."""
    is_open = F.col("end").isNull()
    first, last = _EPOCH.first_from("start"), _EPOCH.last_until("end")
    held = rows.withColumn("first", first).withColumn("last", last).filter(F.col("first").isNotNull() & (is_open | (F.col("first") <= F.col("last"))))
    none = F.lit(0).cast("long")
    amounts = (
        F.col("weight"),
        F.when(is_open, none).otherwise(F.col("weight") * whole_days("start", "end")),
        F.when(is_open, F.col("weight")).otherwise(none),
        F.when(is_open, F.col("weight") * F.col("first")).otherwise(none),
    )
    named = [a.cast("long").alias(n) for a, n in zip(amounts, AMOUNTS, strict=True)]
    taken_back = [(-a).cast("long").alias(n) for a, n in zip(amounts, AMOUNTS, strict=True)]
    into, out_of = F.struct(F.col("first").alias("k"), *named), F.struct((F.col("last") + 1).alias("k"), *taken_back)
    each = held.select(*keys, F.explode(F.when(is_open, F.array(into)).otherwise(F.array(into, out_of))).alias("c"))
    return sum_steps(each.select(*keys, "c.*"), keys, list(AMOUNTS))


def carried(state: DataFrame | None, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The state after the changes. Days on which nothing is left to change have no row."""
    if state is None:
        return changes
    total = sum_steps(state.select(*keys, "k", *AMOUNTS).unionByName(changes), keys, list(AMOUNTS))
    return total.filter(" or ".join(f"{a} != 0" for a in AMOUNTS))


def occupancy_of_state(t, state: DataFrame, start, end, grain: str = "reference") -> DataFrame:
    """``occupancy_history`` from the state: no stay is read."""
    keys, spine = places(grain), DailySpine.of(start, end)
    ahead = (spine.start - date(1970, 1, 1)).days
    # All that lies before the first day is one change on it.
    upto = state.filter(F.col("k") < ahead + spine.days)
    changes = upto.select(*keys, F.greatest(F.lit(0), F.col("k") - ahead).alias("k"), *AMOUNTS)
    return daily_occupancy(t, changes, spine, keys, ahead)


def _schema(keys: list[str]) -> str:
    return ", ".join([*(f"{c} long" for c in keys), "k int", *(f"{a} long" for a in AMOUNTS), "version string", "until date"])


def _last(spark: SparkSession, path: str, keys: list[str]) -> tuple[DataFrame | None, str | None, date | None]:
    """The state as last published, its version and the last day that has been reported from it."""
    try:
        rows = published(spark, path, "parquet", _schema(keys))
    except ValueError:
        return None, None, None
    told = rows.filter("version is not null").first()
    return rows.filter("version is null").drop("version", "until"), told["version"], told["until"]


def run_occupancy(t, changes: DataFrame, base: str | None, version: str, until, folder: str, grain: str = "reference", start=SPINE_START, format: str = "csv") -> list[str]:
    """Bring the published occupancy up to the day ``until`` with the stays ``changed`` since ``base``; returns the days written.

    ``version`` names the stays that the state stands for afterwards. A run
    whose ``base`` is not what the state stands for is refused, and one that
    has been made already does nothing. The state is published last: a run
    that breaks off before can be made again, as days are replaced as a whole.
    """
    spark, keys, folder = changes.sparkSession, places(grain), folder.rstrip("/")
    path = f"{folder}/{_STATE}"
    state, known, reported = _last(spark, path, keys)
    if known == version:
        return []
    if known != base:
        raise ValueError(f"the state stands for {known}, the changes are since {base}")
    delta = changes_by_day(changes, keys)
    after = carried(state, delta, keys)
    first, until = _as_date(start), _as_date(until)
    if reported is not None:
        until = max(until, reported)
        # A row of the state alters its own day and all later ones.
        altered = delta.filter(" or ".join(f"{a} != 0" for a in AMOUNTS)).agg(F.min("k")).first()[0]
        following = reported + timedelta(days=1)
        first = max(first, following if altered is None else min(following, date(1970, 1, 1) + timedelta(days=altered)))
    days = []
    if first <= until:
        report = occupancy_of_state(t, after, first, until, grain)
        days = list(publish(report, f"{folder}/ocupacion", "append", "FECHA_CONSULTA", format).days)
    told = spark.range(1).select(F.lit(version).alias("version"), F.lit(until).alias("until"))
    publish(after.unionByName(told, allowMissingColumns=True), path, "overwrite", format="parquet")
    return days
