"""Bed occupancy: at one instant, over a daily spine, and by stored bed state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardbook.functions.codes import BED_STATE, FREE, OCCUPIED
from wardbook.functions.scalars import decode, instant, percent, whole_days
from wardbook.operators.intervals import DailySpine, InstantSpine, active_at, running, sorted_by_day, spread, steps, sum_steps
from wardbook.operators.sets import ordered
from wardbook.sources.tables import pick

from .common import beds, floors, sites, stays

# How the queried instant is printed: no leading zeros in month and day.
_INSTANT_TEXT = "yyyy-M-d HH:mm:ss"


def places(grain: str) -> list[str]:
    """Keys of the occupied counts.

    ``reference`` counts them per floor only, so a floor spread over several
    sites shows the same figure at each; ``site_floor`` splits them by site.
    """
    return {"reference": ["floor"], "site_floor": ["site", "floor"]}[grain]


def _bed_totals(t) -> DataFrame:
    return beds(t).groupBy("site", "floor").agg(F.count("*").alias("TOTAL_CAMAS"))


def _occupancy_columns(df: DataFrame, at) -> DataFrame:
    occupied = F.coalesce(F.col("occupied"), F.lit(0))
    return df.select(
        F.date_format(at, _INSTANT_TEXT).alias("FECHA_CONSULTA"),
        "SEDE",
        "PISO",
        "TOTAL_CAMAS",
        occupied.alias("OCUPADAS"),
        (F.col("TOTAL_CAMAS") - occupied).alias("DISPONIBLE"),
        F.coalesce(F.col("bed_days"), F.lit(0)).alias("DIAS_CAMA_OCUP"),
        percent(occupied, "TOTAL_CAMAS").alias("PORC_OCUP"),
    )


def occupancy(t, as_of, grain: str = "reference") -> DataFrame:
    """Beds, occupied beds and bed-days per site and floor at one instant."""
    keys = places(grain)
    at = instant(as_of)
    # Summed per bed before the beds are joined, so the join carries no more rows than there are beds.
    per_bed = (
        active_at(stays(t), as_of)
        .groupBy("bed")
        .agg(
            F.count("*").alias("occupied"),
            F.sum(whole_days("start", F.coalesce("end", at))).alias("bed_days"),
        )
    )
    taken = (
        per_bed.join(beds(t).select("bed", "site", "floor"), "bed")
        .groupBy(*keys)
        .agg(F.sum("occupied").alias("occupied"), F.sum("bed_days").alias("bed_days"))
    )
    rows = _bed_totals(t).join(floors(t), "floor").join(sites(t), "site").join(taken, keys, "left")
    return _occupancy_columns(rows, at)


def occupancy_history(t, start, end, grain: str = "reference") -> DataFrame:
    """The same for 23:59:59 of every day from ``start`` to ``end``, in one pass over the stays.

    A closed stay adds its bed-days while it lasts. An open one is worth
    (day - day of entry), so the open stays of a floor are worth
    day * count - sum of their entry days.
    """
    keys = places(grain)
    spine = DailySpine.of(start, end)
    held = spine.window(stays(t), "start", "end").join(beds(t).select("bed", "site", "floor"), "bed")
    is_open = F.col("end").isNull()
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    amounts = {
        "occupied": one,
        "closed_days": F.when(is_open, none).otherwise(whole_days("start", "end")),
        "open_stays": F.when(is_open, one).otherwise(none),
        "open_since": F.when(is_open, F.col("origin_day").cast("bigint")).otherwise(none),
    }
    return daily_occupancy(t, steps(held, spine, keys, **amounts), spine, keys)


def daily_occupancy(t, changes: DataFrame, spine: DailySpine, keys: list[str], ahead: int = 0) -> DataFrame:
    """The report from what changes on each day ``k`` of a spine; days of entry are counted from ``ahead`` days before it."""
    amounts = ["occupied", "closed_days", "open_stays", "open_since"]
    totals, none = _bed_totals(t), F.lit(0).cast("bigint")
    # Every floor starts at zero, so that days without stays are there as well.
    blank = totals.select(*keys).distinct().select(*keys, F.lit(0).alias("k"), *[none.alias(a) for a in amounts])
    level = running(sum_steps(changes.unionByName(blank), keys, amounts), keys, amounts)
    rows = totals.join(floors(t), "floor").join(sites(t), "site").join(level, keys)
    daily = spread(rows, spine, ["site", "floor"]).withColumn(
        "bed_days", F.col("closed_days") + F.col("open_stays") * (F.col("k") + ahead) - F.col("open_since")
    )
    return _occupancy_columns(daily, spine.instant("k"))


def bed_state(t, fecha: str) -> DataFrame:
    """Beds by site, group, floor and stored state. ``fecha`` is printed as given.

    Grouped by site key and raw state as well, so rows may look alike.
    """
    group = pick(t["hpngrupos"], bed_group="oid", TIPO="hgrnombre")
    rows = beds(t).join(sites(t), "site").join(group, "bed_group").join(floors(t), "floor")
    counts = rows.groupBy("SEDE", "site_name", "site", "bed_state", "TIPO", "PISO").agg(
        F.count("*").alias("CAMAS")
    )
    report = counts.select(
        F.lit(fecha).alias("FECHA"), "SEDE", "TIPO", "PISO", decode("bed_state", BED_STATE).alias("ESTADO"), "CAMAS"
    )
    return ordered(report, "SEDE", "TIPO", "PISO")


def _bed_use(t, spine: DailySpine | InstantSpine, as_of) -> tuple[DataFrame, list[str]]:
    """Beds taken and free at every instant ``k`` of a spine, by the names of site, group and floor."""
    group = pick(t["hpngrupos"], bed_group="oid", TIPO="hgrnombre")
    names = ["SEDE", "TIPO", "PISO"]
    held = spine.window(stays(t), "start", F.coalesce(F.col("end"), instant(as_of)))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    has_patient = F.col("admission").isNotNull()
    per_bed = steps(
        held.filter(F.col("bed").isNotNull()),
        spine,
        ["bed"],
        taken=F.when(has_patient, one).otherwise(none),
        idle=F.when(has_patient, none).otherwise(one),
    )
    amounts = ["taken", "idle"]
    blank = beds(t).select("bed", F.lit(0).alias("k"), none.alias("taken"), none.alias("idle"))
    level = running(sum_steps(per_bed.unionByName(blank), ["bed"], amounts), ["bed"], amounts)
    # A bed counts as free once while no stay covers it.
    shown = level.select(
        "bed",
        "k",
        F.col("taken").alias("taken"),
        (F.col("idle") + F.when(F.col("taken") + F.col("idle") == 0, 1).otherwise(0)).alias("idle"),
    )
    earlier = Window.partitionBy("bed").orderBy("k")
    changes = shown.select(
        "bed", "k", *[(F.col(a) - F.lag(a, 1, 0).over(earlier)).alias(a) for a in amounts]
    )
    # Names, not keys: places of one name are one line of the report.
    placed = (
        changes.join(beds(t).select("bed", "site", "bed_group", "floor"), "bed")
        .join(sites(t), "site").join(group, "bed_group").join(floors(t), "floor")
    )
    return spread(running(sum_steps(placed, names, amounts), names, amounts), spine, names), names


def _by_state(daily: DataFrame, *columns) -> DataFrame:
    """A row for each state that some bed is in."""
    states = F.array(
        F.struct(F.lit(OCCUPIED).alias("ESTADO"), F.col("taken").alias("CAMAS")),
        F.struct(F.lit(FREE).alias("ESTADO"), F.col("idle").alias("CAMAS")),
    )
    report = daily.select(*columns, F.explode(states).alias("s")).filter(F.col("s.CAMAS") > 0)
    return report.select(*[c for c in report.columns if c != "s"], "s.ESTADO", "s.CAMAS")


def bed_use_history(t, start, end, as_of) -> DataFrame:
    """Occupied and free beds at 07:00 of every day, by site, group and floor.

    A bed with several stays at an instant counts once per stay; a stay
    without admission counts as free, and so does a bed without a stay. Open
    stays last until ``as_of``.
    """
    spine = DailySpine.of(start, end, "07:00:00")
    daily, names = _bed_use(t, spine, as_of)
    report = _by_state(daily, "k", *names, F.date_format(spine.date("k"), "dd/MM/yyyy").alias("FECHA"))
    return sorted_by_day(report, spine, *names, "FECHA").drop("k")


def bed_use_at(t, instants: InstantSpine, as_of) -> DataFrame:
    """The same at any instants, as the hourly state is kept: their time is printed to the second, and rows have no order."""
    daily, names = _bed_use(t, instants, as_of)
    rows = instants.at(daily, "k", "_at")
    return _by_state(rows, *names, F.date_format("_at", "dd/MM/yyyy HH:mm:ss").alias("FECHA")).select(
        *names, "FECHA", "ESTADO", "CAMAS"
    )
