"""Admissions with their codes spelled out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardbook.functions.codes import (
    ADMISSION_CAUSE,
    ADMISSION_ORIGIN,
    ADMISSION_STATE,
    ADMISSION_TYPE,
    REPORT_START,
    RISK_TYPE,
)
from wardbook.functions.predicates import between_instants
from wardbook.functions.scalars import decode, normalize_area
from wardbook.operators.joins import having
from wardbook.sources.tables import pick

from .common import beds, with_plan


def admissions(t, as_of, start=REPORT_START) -> DataFrame:
    """Admissions of a period with plan, payer, and the area of their bed in full and in short."""
    admission = pick(
        t["adningreso"],
        CONSECUTIVO="ainconsec",
        FECHA_INGRESO="ainfecing",
        kind="aintiping",
        state="ainestado",
        origin="ainurgcon",
        cause="aincauing",
        risk="aintiprie",
        patient="genpacien",
        plan="gendetcon",
        site="adncenate",
        bed="hpndefcam",
        FECHAHOSP="ainfechos",
        FECHAEGRESO="ainfecegre",
        FECHAFACT="ainfecfac",
    ).filter(between_instants("FECHA_INGRESO", start, as_of))
    site = pick(t["adncenate"], site="oid", CENTRO_DE_ATENCION="acacodigo")
    area = pick(t["hpnsubgru"], floor="oid", NOMBRE_CAMA="hsunombre")
    rows = (
        with_plan(having(admission, t["genpacien"], "patient"), t)
        .join(site, "site")
        .join(beds(t).select("bed", "floor"), "bed", "left")
        .join(area, "floor", "left")
    )
    return rows.select(
        "CONSECUTIVO",
        "FECHA_INGRESO",
        decode("kind", ADMISSION_TYPE).alias("TIPO_INGRESO"),
        decode("state", ADMISSION_STATE).alias("ESTADO_INGRESO"),
        decode("origin", ADMISSION_ORIGIN).alias("INGRESO_POR"),
        decode("cause", ADMISSION_CAUSE).alias("CAUSA_INGRESO"),
        decode("risk", RISK_TYPE).alias("TIPO_RIESGO"),
        "CENTRO_DE_ATENCION",
        F.col("plan_name").alias("PLAN_BENEFICIOS"),
        F.col("payer_name").alias("EPS"),
        "NOMBRE_CAMA",
        "FECHAHOSP",
        "FECHAEGRESO",
        "FECHAFACT",
        normalize_area("NOMBRE_CAMA").alias("SERVICIO"),
    )
