"""Appointments by site, specialty, time, kind and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.functions.codes import APPOINTMENT_STATE, CONSULTATION_TYPE
from wardbook.functions.scalars import day_bounds, decode
from wardbook.operators.intervals import _as_date
from wardbook.operators.joins import having
from wardbook.sources.tables import pick

from .common import sites


def _report(t, wanted: Column) -> DataFrame:
    appointment = pick(
        t["cmncitmed"],
        activity="cmntipact",
        timetable="cmnhormed",
        plan="gendetcon",
        physician="genmedico1",
        HORARIO_DE_CITA="ccmfecasi",
        state="ccmestado",
        document="ccmpacdoc",
    ).filter(wanted)
    timetable = pick(t["cmnhormed"], timetable="oid", site="adncenate")
    activity = pick(t["cmntipact"], activity="oid", ESPECIALIDAD_NOMBRE="cmanombre", kind="cmatipcon")
    rows = having(having(appointment, t["genmedico"], "physician"), t["gendetcon"], "plan")
    return (
        rows.join(timetable, "timetable")
        .join(activity, "activity")
        .join(sites(t).select("site", "SEDE"), "site")
        .groupBy(
            "SEDE",
            "ESPECIALIDAD_NOMBRE",
            "HORARIO_DE_CITA",
            decode("kind", CONSULTATION_TYPE).alias("TIPO_CONSULTA"),
            decode("state", APPOINTMENT_STATE).alias("ESTADO"),
        )
        .agg(F.count("document").alias("TOTAL"))
    )


def appointments(t, as_of) -> DataFrame:
    """Appointments of the day before ``as_of``."""
    day = day_bounds(as_of)
    return _report(t, F.col("HORARIO_DE_CITA").between(day.yesterday_start, day.yesterday_end))


def appointments_history(t, start, end) -> DataFrame:
    """Appointments of every day from ``start`` to ``end``: one range, since each row carries its own time.

    Each day ends at its last full second, as for a single day.
    """
    first = day_bounds(_as_date(start)).today_start
    last = day_bounds(_as_date(end)).today_end
    at = F.col("HORARIO_DE_CITA")
    return _report(t, at.between(first, last) & (at <= day_bounds(at).today_end))
