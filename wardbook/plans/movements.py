"""Entries to and exits from the floors, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardbook.functions.codes import FLOOR_CLASS, FLOOR_ENTRY, FLOOR_EXIT

from .common import beds, floors, sites, stays


def floor_movements(t, with_label: bool = False) -> DataFrame:
    """Entries and exits by site, floor and calendar day.

    An entry counts only where the bed has a current admission; days of open
    stays without an exit form a group with empty date parts. ``with_label``
    adds the day as text.

    Both kinds come from one pass over the stays, counted per bed and day
    before the beds are joined. They differ in INDICADOR, so distinct and
    plain union are the same here.
    """
    moves = F.array(
        F.struct(F.lit(FLOOR_ENTRY).alias("INDICADOR"), F.col("start").cast("date").alias("day")),
        F.struct(F.lit(FLOOR_EXIT).alias("INDICADOR"), F.col("end").cast("date").alias("day")),
    )
    per_bed = (
        stays(t).select("bed", F.explode(moves).alias("m")).groupBy("bed", "m.INDICADOR", "m.day")
        .agg(F.count("*").alias("n"))
    )
    rows = (
        per_bed.join(beds(t).select("bed", "site", "floor", "current_admission"), "bed")
        .join(sites(t).select("site", "SEDE"), "site")
        .join(floors(t), "floor")
    )
    counted = F.when(
        (F.col("INDICADOR") == FLOOR_EXIT) | F.col("current_admission").isNotNull(), F.col("n")
    ).otherwise(F.lit(0))
    totals = rows.groupBy("SEDE", "PISO", "day", "INDICADOR").agg(F.sum(counted).alias("VALORIND"))
    label = [F.date_format("day", "dd/MM/yyyy").alias("FECHA_IND")] if with_label else []
    return totals.select(
        "SEDE",
        "PISO",
        F.year("day").alias("VIGENCIA"),
        F.month("day").alias("MES"),
        F.dayofmonth("day").alias("DIA"),
        *label,
        F.lit(FLOOR_CLASS).alias("CLASIFICACION"),
        "INDICADOR",
        "VALORIND",
    )
