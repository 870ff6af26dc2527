"""Billed services by the bed stay in which they happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardbook.functions.codes import ADMISSION_TYPE, BILLED, DRUGS, PENDING
from wardbook.functions.predicates import in_year
from wardbook.functions.scalars import (
    date_text,
    decode,
    instant,
    label_by_null,
    rounded_days,
    text_if_null,
)
from wardbook.operators.intervals import attribute_events
from wardbook.operators.joins import repeat_rows, with_partner_count
from wardbook.operators.sets import ordered
from wardbook.sources.tables import pick

from .common import beds, drug_lines, floors, procedures, sites, stays

_FOLLOWUP_ORDER = ("GRUPO_FAC", "SEDE", "SERVICIO", "NUMINGRESO", "OID")
_CENSUS_ORDER = ("SEDE", "PISO", "FECHA_INGRESO", "NUMINGRESO", "PACIENTE")


def _in_bed(t, df: DataFrame) -> DataFrame:
    """Cut a large table down to the admissions that hold a bed now, of which there is at most one per bed."""
    held = beds(t).select(F.col("current_admission").alias("admission"))
    return df.join(held, "admission", "left_semi")


def _patients_in_bed(t) -> DataFrame:
    """Patients in bed with discharge, site and floor."""
    bed = beds(t).select("site", "floor", F.col("current_admission").alias("admission"))
    admission = pick(
        t["adningreso"], admission="oid", NUMINGRESO="ainconsec", entered="ainfecing", patient="genpacien"
    )
    patient = pick(t["genpacien"], patient="oid", PACIENTE="gpanomcom")
    discharge = pick(t["adnegreso"], admission="adningreso", left_at="adefecsal")
    return (
        _in_bed(t, admission)
        .join(patient, "patient")
        .join(_in_bed(t, discharge), "admission", "left")
        .join(bed, "admission")
        .join(floors(t), "floor")
        .join(sites(t).select("site", "SEDE"), "site")
        .select("admission", "NUMINGRESO", "PACIENTE", "SEDE", "PISO", "entered", "left_at")
    )


def _services(t) -> DataFrame:
    return pick(
        t["slnserpro"],
        service="oid",
        admission="adningres1",
        SERVICIO="serdesser",
        served="serfecser",
        quantity="sercantid",
        value="servalpro",
        applied="seraplpro",
    )


def _services_in_stays(t, as_of) -> DataFrame:
    """Services of the patients in bed, paired with the stay that covers them, and ``_invoices`` of the admission.

    Each large table is cut down to the admissions in bed before it meets
    another. The number of invoices is carried along, so that the rows are
    multiplied only after the last join.
    """
    own_stays = (
        _in_bed(t, stays(t))
        .join(beds(t).select("bed", "floor"), "bed")
        .join(floors(t).withColumnRenamed("PISO", "ESTANCIA"), "floor")
        .select("admission", "ESTANCIA", "start", "end")
    )
    own_invoices = _in_bed(t, pick(t["slnfactur"], admission="adningreso"))
    paired = attribute_events(_in_bed(t, _services(t)), own_stays, "admission", "served", "start", "end", as_of)
    return with_partner_count(paired.join(_patients_in_bed(t), "admission"), own_invoices, "admission", "_invoices")


def _dates_and_spans(as_of) -> list:
    return [
        date_text("entered").alias("FECHA_INGRESO"),
        date_text("served").alias("FECHA_SERVICIO"),
        date_text("left_at").alias("FECHA_EGRESO"),
        rounded_days("entered", "served").alias("INGR_VS_SERV"),
        rounded_days("served", "left_at").alias("EGRESO_VS_SERV"),
        rounded_days("entered", F.coalesce("end", instant(as_of))).alias("ESTANCIA_APROX"),
    ]


def service_followup(t, as_of) -> DataFrame:
    """Services of patients in bed, with the supply price where the service has none.

    The price is rounded first and multiplied by the quantity afterwards.
    """
    rows = _services_in_stays(t, as_of)
    rows = rows.join(drug_lines(t), "service", "left").join(procedures(t), "service", "left")
    rows = repeat_rows(rows, "_invoices")
    price = F.when(F.col("value") == 0, F.col("line_value")).otherwise(F.col("value"))
    charged = F.when(F.col("applied") == 0, price).otherwise(F.lit(0).cast("decimal(18,2)"))
    report = rows.select(
        "NUMINGRESO",
        F.col("admission").alias("OID"),
        "PACIENTE",
        text_if_null("group_name", DRUGS).alias("GRUPO_FAC"),
        "SEDE",
        "PISO",
        "ESTANCIA",
        "CUP",
        "SERVICIO",
        *_dates_and_spans(as_of),
        F.col("value").alias("VALORPRO"),
        F.col("applied").alias("APL_PROC"),
        (F.round(charged, 0) * F.col("quantity")).alias("VALORSERV"),
    )
    return ordered(report, *_FOLLOWUP_ORDER)


def daily_census(t, as_of) -> DataFrame:
    """Services of patients in bed without supply prices; the product is rounded, not the price.

    Sorted by the entry date as printed, that is by its text.
    """
    rows = _services_in_stays(t, as_of).join(procedures(t), "service", "left")
    rows = repeat_rows(rows, "_invoices")
    charged = F.when(F.col("applied") == 0, F.col("value")).otherwise(F.lit(0).cast("decimal(18,2)"))
    report = rows.select(
        "NUMINGRESO",
        "PACIENTE",
        text_if_null("group_name", DRUGS).alias("GRUPO_FAC"),
        "SEDE",
        "PISO",
        "ESTANCIA",
        "CUP",
        "SERVICIO",
        *_dates_and_spans(as_of),
        F.round(charged * F.col("quantity"), 0).alias("VALORSERV"),
    )
    return ordered(report, *_CENSUS_ORDER)


def service_volumes(t, services: DataFrame, as_of) -> DataFrame:
    """Count, quantity and value of services per admission, billing group and site of the stay."""
    site_stays = (
        stays(t)
        .join(beds(t).select("bed", "site", "floor"), "bed")
        .join(floors(t).select("floor"), "floor", "left_semi")
        .join(sites(t).select("site", F.col("SEDE").alias("SEDE_HOSP")), "site")
        .select("admission", "SEDE_HOSP", "start", "end")
    )
    # All three detail joins run on the service key, so one shuffle of the services serves them.
    rows = services.join(drug_lines(t), "service", "left").join(procedures(t), "service", "left")
    paired = attribute_events(rows, site_stays, "admission", "served", "start", "end", as_of, how="left")
    price = F.when(F.col("value") == 0, F.col("line_value")).otherwise(F.col("value"))
    return paired.groupBy(
        "admission", text_if_null("group_name", DRUGS).alias("GRUPO_FAC"), "SEDE_HOSP"
    ).agg(
        F.count("*").alias("NUMREG"),
        F.sum("quantity").alias("CANTIDAD"),
        F.sum(price * F.col("quantity")).alias("TOTSER"),
    )


def billed_totals(t) -> DataFrame:
    """Charged amount per admission over its invoices that were not cancelled."""
    invoice = pick(t["slnfactur"], admission="adningreso", charged="sfavalcar", cancelled="sfadocanu")
    return (
        invoice.filter((F.col("cancelled") == 0) & F.col("admission").isNotNull())
        .groupBy("admission")
        .agg(F.sum("charged").alias("TOTALFAC"), F.lit(True).alias("billed"))
    )


def service_history(t, year: int, as_of) -> DataFrame:
    """Volumes and values of the services of a year's admissions, by billing group and site of production."""
    admission = pick(
        t["adningreso"],
        admission="oid",
        AINCONSEC="ainconsec",
        entered="ainfecing",
        admission_type="aintiping",
        site="adncenate",
    ).filter(in_year("entered", year))
    entry_site = sites(t).select("site", F.col("SEDE").alias("SEDE_INGRESO"))
    # Only the year's services take part in the joins on the way to the totals.
    services = _services(t).join(admission.select("admission"), "admission", "left_semi")
    rows = (
        service_volumes(t, services, as_of)
        .join(admission, "admission")
        .join(entry_site, "site")
        .join(billed_totals(t), "admission", "left")
    )
    return rows.select(
        "SEDE_INGRESO",
        "AINCONSEC",
        decode("admission_type", ADMISSION_TYPE).alias("TIPO_INGRESO"),
        F.year("entered").alias("AÑO"),
        F.month("entered").alias("MES"),
        label_by_null("billed", PENDING, BILLED).alias("ESTADO"),
        F.coalesce("SEDE_HOSP", "SEDE_INGRESO").alias("SEDE_PROD"),
        "GRUPO_FAC",
        "NUMREG",
        "CANTIDAD",
        "TOTSER",
        "TOTALFAC",
    )
