"""Services not yet billed, in full detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.functions.codes import ADMISSION_TYPE, DOCUMENT_TYPE, PLAN_TYPE
from wardbook.functions.predicates import number_between, text_between
from wardbook.functions.scalars import date_text, decode, instant, null_text, round_hundred
from wardbook.operators.joins import having, latest_version
from wardbook.sources.tables import pick

from .common import with_plan

_CANCELLED = 2
_OPEN_STATES = (0, 3)
_MONEY = "decimal(38,4)"


def _wanted(t, start, end, codes: Column) -> DataFrame:
    """Open admissions of the period with their site."""
    admission = pick(
        t["adningreso"],
        admission="oid",
        NUMERO_INGRESO="ainconsec",
        entered="ainfecing",
        patient="genpacien",
        plan="gendetcon",
        site="adncenate",
        state="ainestado",
        admission_type="aintiping",
    )
    site = pick(t["adncenate"], site="oid", CODIGO_CENTROA="acacodigo", NOMBRE_CENTROA="acanombre")
    return admission.filter(
        (F.col("entered") >= start) & (F.col("entered") <= end) & F.col("state").isin(*_OPEN_STATES)
    ).join(site.filter(codes), "site")


def _admissions(t, wanted: DataFrame) -> DataFrame:
    """Admissions with patient, discharge and plan."""
    patient = pick(
        t["genpacien"],
        patient="oid",
        document_type="pactipdoc",
        NUMERO_DE_IDENTIFICACION="pacnumdoc",
        PACIENTE="gpanomcom",
        born="gpafecnac",
    )
    discharge = pick(t["adnegreso"], admission="adningreso", left_at="adefecsal")
    rows = with_plan(wanted, t).join(patient, "patient").join(discharge, "admission", "left")
    return rows.select(
        "admission",
        "NUMERO_INGRESO",
        date_text("entered").alias("FECHA_INGRESO"),
        date_text("left_at").alias("FECHA_EGRESO"),
        F.col("plan_code").alias("CODIGO_PLAN"),
        F.col("plan_name").alias("NOMBRE_PLAN"),
        "CODIGO_CENTROA",
        "NOMBRE_CENTROA",
        F.col("payer_code").alias("CODIGO_ENTIDAD"),
        F.col("payer_name").alias("NOMBRE_ENTIDAD"),
        decode("document_type", DOCUMENT_TYPE).alias("TIPO_DOCUMENTO_PACIENTE"),
        "NUMERO_DE_IDENTIFICACION",
        "PACIENTE",
        date_text("born").alias("PACIENTEFECHANAC"),
        decode("plan_type", PLAN_TYPE).alias("TIPOPLAN"),
        decode("admission_type", ADMISSION_TYPE).alias("TIPO_INGRESO"),
    )


def service_orders(t) -> DataFrame:
    """Orders that were not cancelled, with area and cost centre."""
    order = pick(
        t["slnordser"],
        order="oid",
        NUMERO_ORDEN="sosordser",
        ordered_at="sosfecord",
        order_state="sosestado",
        area="genareser1",
    )
    area = pick(t["genareser"], area="oid", AREACODIGO="gascodigo", AREANOMBRE="gasnombre", centre="ctncencos1")
    centre = pick(t["ctncencos"], centre="oid", CENTROCODIGO="cccodigo", CENTRONOMBRE="ccnombre")
    return (
        order.filter(F.col("order_state") != _CANCELLED)
        .join(area, "area")
        .join(centre, "centre")
        .select(
            "order", "NUMERO_ORDEN", date_text("ordered_at").alias("FECHA_ORDEN"),
            "AREACODIGO", "AREANOMBRE", "CENTROCODIGO", "CENTRONOMBRE",
        )
    )


def _services(t, wanted: DataFrame) -> DataFrame:
    """Unapplied services of the admissions in full detail."""
    service = pick(
        t["slnserpro"],
        service="oid",
        admission="adningres1",
        order="slnordser1",
        physician="genmedico1",
        SERVICIO_NOMBRE="serdesser",
        CANTIDAD="sercantid",
        FECHASERVICIO="serfecser",
        VALPAC="servalpac",
        VALENT="servalent",
        value="servalpro",
        applied="seraplpro",
    )
    physician = pick(t["genmedico"], physician="oid", MEDICOCODIGO="gmecodigo", MEDICONOMBRE="gmenomcom")
    return (
        service.filter(F.col("applied") == 0)
        .join(_admissions(t, wanted), "admission")
        .join(service_orders(t), "order")
        .join(physician, "physician")
    )


def drug_details(t) -> DataFrame:
    """Drug part of a service with product and groups, one row per supply line."""
    product = pick(
        t["innproduc"], product="oid", SERVICIO_CODIGO="iprcodigo", group="igrcodigo", subgroup="isgcodigo"
    )
    group = pick(t["inngrupo"], group="oid", GRUPOSERCODIGO="igrcodigo", GRUPOSERNOMBRE="igrnombre")
    subgroup = pick(t["innsubgru"], subgroup="oid", SUBGRUPOCODIGO="isgcodigo", SUBGRUPONOMBRE="isgnombre")
    part = pick(t["slnprohoj"], service="oid", header="inncsumpa1", product="innproduc1")
    lines = pick(t["innmsumpa"], service="slnprohoj", line_value="ismvalpro")
    return (
        having(part, t["inncsumpa"], "header")
        .join(product, "product")
        .join(group, "group")
        .join(subgroup, "subgroup")
        .drop("header", "product", "group", "subgroup")
        .join(lines, "service")
    )


def tariffs(t) -> DataFrame:
    """Newest tariff of each manual entry."""
    versions = pick(t["genmantar"], oid="oid", manual="genmanser1", tariff="smtvalser")
    return latest_version(versions.filter(F.col("manual").isNotNull()), "manual").select("manual", "tariff")


def procedure_details(t) -> DataFrame:
    """Procedure part of a service with catalogue, groups, newest tariff and surgical group."""
    catalogue = pick(
        t["genserips"], procedure="oid", SERVICIO_CODIGO="sipcodigo", group="gengrupos1", subgroup="gensubgru1"
    )
    group = pick(t["gengrupos"], group="oid", GRUPOSERCODIGO="ggrcodigo", GRUPOSERNOMBRE="ggrnombre")
    subgroup = pick(t["gensubgru"], subgroup="oid", SUBGRUPOCODIGO="gsucodigo", SUBGRUPONOMBRE="gsunombre")
    surgical = pick(t["gengruqui"], surgical="oid", GRUPOQUICODIGO="sgqcodigo", GRUPOQUINOMBRE="sgqnombre")
    manual = pick(t["genmanser"], manual="oid", surgical="gengruqui1")
    part = pick(t["slnserhoj"], service="oid", procedure="genserips1", manual="genmanser1")
    return (
        part.join(catalogue, "procedure")
        .join(group, "group")
        .join(subgroup, "subgroup")
        .join(manual, "manual")
        .join(tariffs(t), "manual")
        .join(surgical, "surgical", "left")
        .drop("procedure", "manual", "group", "subgroup")
    )


_COLUMNS = (
    "TIPO_DOCUMENTO", "NUMERO_ORDEN", "FECHA_ORDEN", "NUMERO_INGRESO", "FECHA_INGRESO", "FECHA_EGRESO",
    "CODIGO_PLAN", "NOMBRE_PLAN", "CODIGO_CENTROA", "NOMBRE_CENTROA", "CODIGO_ENTIDAD", "NOMBRE_ENTIDAD",
    "TIPO_DOCUMENTO_PACIENTE", "NUMERO_DE_IDENTIFICACION", "PACIENTE", "PACIENTEFECHANAC", "TIPOPLAN",
    "TIPO_INGRESO", "SERVICIO_CODIGO", "SERVICIO_NOMBRE", "CANTIDAD", "FECHASERVICIO", "GRUPOSERCODIGO",
    "GRUPOSERNOMBRE", "SUBGRUPOCODIGO", "SUBGRUPONOMBRE", "MEDICOCODIGO", "MEDICONOMBRE", "AREACODIGO",
    "AREANOMBRE", "CENTROCODIGO", "CENTRONOMBRE", "GRUPOQUICODIGO", "GRUPOQUINOMBRE", "CANTIDAD_2", "VALPAC",
    "VALENT", "TOTSER", "GRUPOQUIRURGICO",
)


def unbilled_services(
    t, start, end, site_lo: str | int = "01", site_hi: str | int = "05"
) -> DataFrame:
    """Drug and procedure services of open admissions that entered between two instants.

    Site bounds given as text compare site codes as text, as numbers by value.
    Drug and procedure parts are stacked first and meet the services in one
    join, so the services and what belongs to them are put together once.
    """
    between = text_between if isinstance(site_lo, str) else number_between
    codes = between("CODIGO_CENTROA", site_lo, site_hi)
    services = _services(t, _wanted(t, instant(start), instant(end), codes))
    drugs = drug_details(t).withColumn("is_drug", F.lit(True))
    work = procedure_details(t).withColumn("is_drug", F.lit(False))
    rows = services.join(drugs.unionByName(work, allowMissingColumns=True), "service")

    quantity, value = F.col("CANTIDAD"), F.col("value")
    drug_total = F.when(value == 0, F.col("line_value") * quantity).otherwise(value * quantity)
    price = F.when(F.col("surgical").isNull(), F.col("tariff")).otherwise(value)
    total = F.when(F.col("is_drug"), drug_total.cast(_MONEY)).otherwise(round_hundred(price * quantity).cast(_MONEY))
    known = rows.withColumns(
        {"TOTSER": total, "GRUPOQUIRURGICO": F.col("surgical").cast("string"), "CANTIDAD_2": quantity}
    )
    return known.select([F.col(c) if c in known.columns else null_text().alias(c) for c in _COLUMNS])
