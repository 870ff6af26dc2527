"""The published reports: what each job computes, and how it is written and logged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.functions.codes import HISTORY_YEAR, SPINE_START
from wardbook.operators.intervals import _as_date
from wardbook.sources.publish import audit_run, publish, published, sweep

from . import admissions, appointments, billing, emergency, occupancy, services


@dataclass(frozen=True)
class Job:
    """A report of ``(tables, as_of)``, the folder it goes to and, for reports kept by day, the day's column, the
    order within a day and, if days can be without rows, the days that a run covers."""

    report: Callable[..., DataFrame]
    folder: str
    partition: str | None = None
    order: tuple[str, ...] = ()
    covers: Callable[..., list[str]] = lambda as_of, **options: []


def _end_of_yesterday(as_of) -> datetime:
    return datetime.combine(_as_date(as_of), time()) - timedelta(seconds=1)


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("FECHA", F.date_format("HORARIO_DE_CITA", "yyyy-MM-dd"))


def _days(first: date, last: date) -> list[str]:
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def _bed_state(t, as_of) -> DataFrame:
    at = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return occupancy.bed_state(t, at.strftime("%d/%m/%Y %H:%M"))


JOBS = {
    "estancias": Job(
        lambda t, as_of, start=SPINE_START: occupancy.bed_use_history(t, start, _as_date(as_of), as_of),
        "estancias_uso", "FECHA", ("SEDE", "TIPO", "PISO"),
    ),
    "estancias_anexar": Job(_bed_state, "estancias_estado", "FECHA", ("SEDE", "TIPO", "PISO")),
    "ocupacion": Job(
        lambda t, as_of, start=SPINE_START: occupancy.occupancy_history(t, start, _as_date(as_of)),
        "ocupacion", "FECHA_CONSULTA",
    ),
    "ocupacion_anexar": Job(
        lambda t, as_of: occupancy.occupancy(t, _end_of_yesterday(as_of)), "ocupacion", "FECHA_CONSULTA"
    ),
    "seguimiento": Job(services.service_followup, "seguimiento_censo"),
    "censo_diario": Job(services.daily_census, "censo_diario"),
    "historico_servicios": Job(
        lambda t, as_of, year=HISTORY_YEAR: services.service_history(t, year, as_of), "historico_servicios"
    ),
    "ingresosnorm": Job(
        lambda t, as_of: admissions.admissions(t, _end_of_yesterday(as_of)), "ingresosnorm"
    ),
    "radicaciones": Job(lambda t, as_of: billing.filed_invoices(t), "radicaciones"),
    "facturas": Job(lambda t, as_of: billing.invoices(t, _end_of_yesterday(as_of)), "facturas"),
    "ventas": Job(lambda t, as_of: billing.sales(t, _end_of_yesterday(as_of)), "ventas"),
    "recaudos": Job(lambda t, as_of: billing.collections(t), "recaudos"),
    "indicadores_urgencia": Job(emergency.emergency_indicators, "indic_urg"),
    "consultas": Job(
        lambda t, as_of, start=SPINE_START: _with_day(appointments.appointments_history(t, start, _as_date(as_of))),
        "consultas", "FECHA", covers=lambda as_of, start=SPINE_START: _days(_as_date(start), _as_date(as_of)),
    ),
    "consultas_anexar": Job(
        lambda t, as_of: _with_day(appointments.appointments(t, as_of)),
        "consultas", "FECHA", covers=lambda as_of: [_end_of_yesterday(as_of).date().isoformat()],
    ),
}


def run(t, name: str, as_of, folder: str, format: str = "csv", **options) -> str:
    """Publish one report under ``folder`` and log the run; returns where the report lies.

    Reports kept by day replace the days they cover and leave the others, so
    a history and the daily runs after it can be repeated at will. The other
    reports replace their last snapshot. Readers go through ``published`` and
    see a report before a run or after it. The log has the time of the run
    itself, the instant that was asked for, what was written and how long it
    took, or the error with which the run ended.
    """
    job, started = JOBS[name], datetime.now()
    path, log = (f"{folder.rstrip('/')}/{part}" for part in (job.folder, "log"))
    spark = SparkSession.active()
    try:
        df = job.report(t, as_of, **options)
        covers = job.covers(as_of, **options)
        outcome = publish(df, path, "append" if job.partition else "overwrite", job.partition, format, job.order, covers)
    except Exception as error:
        audit_run(spark, name, started, log, as_of, error)
        raise
    audit_run(spark, name, started, log, as_of, outcome)
    sweep(spark, path)
    return path


def report(spark: SparkSession, name: str, folder: str, format: str = "csv", schema=None) -> DataFrame:
    """A report as its job last published it."""
    job = JOBS[name]
    return published(spark, f"{folder.rstrip('/')}/{job.folder}", format, schema, job.partition)
