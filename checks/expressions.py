"""Projections, filters and scalar functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardbook.functions import codes as k
from wardbook.functions.predicates import (
    between_instants,
    in_year,
    last_24_hours,
    number_between,
    number_not_in,
    starts_with_any,
    text_between,
)
from wardbook.functions.scalars import (
    concat_text,
    date_text,
    decode,
    elapsed_days,
    instant,
    label_by_null,
    normalize_area,
    null_text,
    parse_dmy,
    parse_ymd,
    percent,
    round_hundred,
    rounded_days,
    site_short_name,
    stamp_text,
    text_if_null,
    truncate,
    whole_days,
)
from wardbook.plans.billing import countable_invoices
from wardbook.plans.common import drug_lines, procedures, stays
from wardbook.sources.tables import pick

from .case import Check, case_of, days, dmy, oracle, short
from .reports import _COUNTABLE, AREA
from .samples import EVENTS_AS_OF, ORDERS_AS_OF, ORDERS_START, YEAR

_AT = f"timestamp '{ORDERS_AS_OF}'"
_EV = f"timestamp '{EVENTS_AS_OF}'"
_MID_START, _MID_END = "1997-03-01 00:00:00", "1999-10-31 23:59:59"


def _decoded(c):
    i = c.t["adningreso"]
    return i.select(
        "oid",
        decode("aintiping", k.ADMISSION_TYPE).alias("tipo"),
        decode("ainestado", k.ADMISSION_STATE).alias("estado"),
        decode("ainurgcon", k.ADMISSION_ORIGIN).alias("origen"),
        decode("aincauing", k.ADMISSION_CAUSE).alias("causa"),
        decode("aintiprie", k.RISK_TYPE).alias("riesgo"),
    )


def _valued(c):
    rows = c.t["slnserpro"].withColumnRenamed("oid", "service").join(drug_lines(c.t), "service", "left")
    price = F.when(F.col("servalpro") == 0, F.col("line_value")).otherwise(F.col("servalpro"))
    return rows.select(
        "service", F.when(F.col("seraplpro") == 0, price).otherwise(F.lit(0).cast("decimal(18,2)")).alias("price")
    )


def _post_join_filter(c):
    held = c.t["adningreso"].join(stays(c.t), F.col("oid") == F.col("admission"), "left")
    return held.filter(F.col("ainfecing") >= F.col("start")).select("oid", "start")


_PROJECTIONS = {
    "p1_pick_and_alias": Check(
        lambda c: pick(c.t["hpndefcam"], cama="oid", sede="adncenate", codigo="hcacodigo"),
        oracle("select oid as cama, adncenate as sede, hcacodigo as codigo from hpndefcam"),
    ),
    "p2_literal_columns": Check(
        lambda c: c.t["cmnconsul"].select(
            "adncenate", F.lit("02").alias("indicador"), null_text().alias("vacio"), stamp_text(instant(EVENTS_AS_OF)).alias("fecha")
        ),
        oracle(
            "select adncenate, '02' as indicador, cast(null as varchar) as vacio, "
            f"strftime({_EV}, '%d/%m/%Y %H:%M:%S') as fecha from cmnconsul"
        ),
    ),
    "p3_simple_case": Check(
        lambda c: c.t["cmncitmed"].select("oid", decode("ccmestado", k.APPOINTMENT_STATE).alias("estado")),
        oracle(f"select oid, {case_of('ccmestado', k.APPOINTMENT_STATE)} as estado from cmncitmed"),
    ),
    "p3_bed_state_case": Check(
        lambda c: c.t["hpndefcam"].select("oid", decode("hcaestado", k.BED_STATE).alias("estado")),
        oracle(f"select oid, {case_of('hcaestado', k.BED_STATE)} as estado from hpndefcam"),
    ),
    "p4_searched_case": Check(
        _decoded,
        oracle(
            f"select oid, {case_of('aintiping', k.ADMISSION_TYPE)} as tipo, {case_of('ainestado', k.ADMISSION_STATE)} as estado, "
            f"{case_of('ainurgcon', k.ADMISSION_ORIGIN)} as origen, {case_of('aincauing', k.ADMISSION_CAUSE)} as causa, "
            f"{case_of('aintiprie', k.RISK_TYPE)} as riesgo from adningreso"
        ),
    ),
    "p4_document_and_plan_type": Check(
        lambda c: c.t["genpacien"].select(
            "oid",
            decode("pactipdoc", k.DOCUMENT_TYPE).alias("documento"),
            decode(F.col("pactipdoc") - 1, k.PLAN_TYPE).alias("plan"),
            decode(F.col("pactipdoc") - 2, k.FILING_STATE).alias("radicado"),
        ),
        oracle(
            f"select oid, {case_of('pactipdoc', k.DOCUMENT_TYPE)} as documento, {case_of('pactipdoc - 1', k.PLAN_TYPE)} as plan, "
            f"{case_of('pactipdoc - 2', k.FILING_STATE)} as radicado from genpacien"
        ),
    ),
    "p5_case_with_else": Check(
        lambda c: c.t["slnfactur"].select(
            "oid", decode("sfatipdoc", k.INVOICE_TYPE, default=null_text()).alias("tipo")
        ),
        oracle(f"select oid, nullif({case_of('sfatipdoc', k.INVOICE_TYPE, chr(39) * 2)}, '') as tipo from slnfactur"),
    ),
    "p6_null_driven_label": Check(
        lambda c: procedures(c.t).select(
            "service",
            text_if_null("group_name", k.DRUGS).alias("grupo"),
            label_by_null("group_name", k.PENDING, k.BILLED).alias("estado"),
        ),
        oracle(
            "select h.oid as service, coalesce(c.gcfnombre, 'MEDICAMENTOS') as grupo, "
            "if(c.gcfnombre is null, 'PENDIENTE', 'FACTURADO') as estado from slnserhoj h "
            "left join genserips p on p.oid = h.genserips1 left join genconfac c on c.oid = p.genconfac1"
        ),
    ),
    "p7_nested_case_price": Check(
        _valued,
        oracle(
            "select v.oid as service, cast(case when v.seraplpro <> 0 then 0 when v.servalpro <> 0 then v.servalpro "
            "else m.ismvalpro end as decimal(18,2)) as price from slnserpro v left join slnprohoj h on h.oid = v.oid "
            "left join innmsumpa m on m.slnprohoj = h.oid"
        ),
    ),
    "p8_two_way_label": Check(
        lambda c: c.t["genpacien"].select(
            "oid", F.when(F.col("gpasexpac") == 1, k.EMERGENCY_INDICATORS["05H"])
            .otherwise(k.EMERGENCY_INDICATORS["05M"]).alias("indicador"),
        ),
        oracle(
            f"select oid, if(gpasexpac = 1, '{k.EMERGENCY_INDICATORS['05H']}', '{k.EMERGENCY_INDICATORS['05M']}') "
            "as indicador from genpacien"
        ),
    ),
    "p9_quoted_identifiers": Check(
        lambda c: c.t["hcniyaevts"].select(
            F.col("`InsidentesAccidentes`").alias("InsidentesAccidentes"), F.col("`EventosAdversos`").alias("año")
        ),
        oracle('select InsidentesAccidentes as "InsidentesAccidentes", EventosAdversos as "año" from hcniyaevts'),
    ),
    "p10_derived_column": Check(
        lambda c: c.t["hpnsubgru"].withColumn("servicio", normalize_area("hsunombre")).join(
            c.t["hpndefcam"].select(F.col("oid").alias("cama"), F.col("hpnsubgru").alias("oid")), "oid"
        ).select("cama", "hsunombre", "servicio"),
        oracle(
            f"select b.oid as cama, f.x as hsunombre, {AREA.replace('(x,', '(f.x,').replace('else x end', 'else f.x end')} "
            "as servicio from hpndefcam b join (select oid, hsunombre as x from hpnsubgru) f on f.oid = b.hpnsubgru"
        ),
    ),
}

_FILTERS = {
    "f1_equality": Check(
        lambda c: c.t["hpndefcam"].filter(F.col("hcaobshos") == 2).select("oid"),
        oracle("select oid from hpndefcam where hcaobshos = 2"),
    ),
    "f2_inequality": Check(
        lambda c: c.t["adnegreso"].filter(F.col("adeestpac") != 2).select("oid"),
        oracle("select oid from adnegreso where adeestpac <> 2"),
    ),
    "f3_closed_range": Check(
        lambda c: c.t["slnserpro"].filter(between_instants("serfecser", _MID_START, _MID_END)).select("oid", "serfecser"),
        oracle(
            f"select oid, serfecser from slnserpro where serfecser >= timestamp '{_MID_START}' "
            f"and serfecser <= timestamp '{_MID_END}'"
        ),
    ),
    "f4_fixed_start_to_as_of": Check(
        lambda c: c.t["adningreso"].filter(between_instants("ainfecing", ORDERS_START, ORDERS_AS_OF)).select("oid"),
        oracle(f"select oid from adningreso where ainfecing between timestamp '{ORDERS_START}' and {_AT}"),
    ),
    "f5_last_24_hours": Check(
        lambda c: c.t["hcnfolio"].filter(last_24_hours("hcfecfol", EVENTS_AS_OF)).select("oid", "hcfecfol"),
        oracle(f"select oid, hcfecfol from hcnfolio where hcfecfol between {_EV} - interval 1 day and {_EV}"),
    ),
    "f6_in_list": Check(
        lambda c: c.t["adningreso"].filter(F.col("ainestado").isin(0, 1, 3)).select("oid", "ainestado"),
        oracle("select oid, ainestado from adningreso where ainestado in (0, 1, 3)"),
    ),
    "f6_in_text_list": Check(
        lambda c: c.t["hcntriage"].withColumnRenamed("oid", "triage").join(
            c.t["hcnclaurgtr"].filter(F.col("hccodigo").isin("003", "004", "005")), F.col("hcnclaurgtr") == F.col("oid")
        ).select("triage", "hccodigo"),
        oracle(
            "select r.oid as triage, t.hccodigo from hcntriage r join hcnclaurgtr t on t.oid = r.hcnclaurgtr "
            "where t.hccodigo in ('003', '004', '005')"
        ),
    ),
    "f7_not_in_list": Check(
        lambda c: c.t["adnegreso"].filter(~F.col("adeestpac").isin(3, 4)).select("oid", "adeestpac"),
        oracle("select oid, adeestpac from adnegreso where adeestpac not in (3, 4)"),
    ),
    "f7_number_not_in_text_code": Check(
        lambda c: c.t["slnfactur"].filter(number_not_in("sfatipdoc", k.EXCLUDED_INVOICE_TYPES)).select("oid", "sfatipdoc"),
        oracle(
            "select oid, sfatipdoc from slnfactur where cast(sfatipdoc as integer) not in (3,4,9,10,11,12,13,14,15)"
        ),
    ),
    "f8_prefix_and_contains": Check(
        lambda c: c.t["gendiagno"].filter(
            starts_with_any("diacodigo", ("T63", "X20")) | F.col("diacodigo").contains("A0")
        ).select("oid", "diacodigo"),
        oracle(
            "select oid, diacodigo from gendiagno where diacodigo like 'T63%' or diacodigo like 'X20%' "
            "or diacodigo like '%A0%'"
        ),
    ),
    "f9_text_range": Check(
        lambda c: c.t["adningreso"].join(
            c.t["adncenate"].filter(text_between("acacodigo", "02", "04")).select(F.col("oid").alias("adncenate"), "acacodigo"),
            "adncenate",
        ).select("oid", "acacodigo"),
        oracle(
            "select i.oid, a.acacodigo from adningreso i join adncenate a on a.oid = i.adncenate "
            "where a.acacodigo >= '02' and a.acacodigo <= '04'"
        ),
    ),
    "f10_number_range": Check(
        lambda c: c.t["slnfactur"].filter(number_between("sfatipdoc", 2, 11)).select("oid", "sfatipdoc"),
        oracle("select oid, sfatipdoc from slnfactur where try_cast(sfatipdoc as integer) between 2 and 11"),
    ),
    "f11_is_not_null": Check(
        lambda c: c.t["slnfactur"].filter(F.col("ctntipcom1").isNotNull()).select("oid", "ctntipcom1"),
        oracle("select oid, ctntipcom1 from slnfactur where ctntipcom1 is not null"),
    ),
    "f12_or_of_conjunctions": Check(
        lambda c: countable_invoices(c.t, ORDERS_AS_OF, ORDERS_START).select("FACTURA", "SFAFECFAC"),
        oracle(
            'select u.sfanumfac as "FACTURA", u.sfafecfac as "SFAFECFAC" from slnfactur u '
            f"where ({_COUNTABLE} and u.ctntipcom1 is not null) or ({_COUNTABLE} and u.ctntipcom3 is not null)"
        ),
    ),
    "f13_calendar_year": Check(
        lambda c: c.t["adningreso"].filter(in_year("ainfecing", YEAR)).select("oid", "ainfecing"),
        oracle(f"select oid, ainfecing from adningreso where year(ainfecing) = {YEAR}"),
    ),
    "f14_filter_on_outer_side": Check(
        _post_join_filter,
        oracle(
            'select i.oid, e.hesfecing as "start" from adningreso i left join hpnestanc e on e.adningres = i.oid '
            "where i.ainfecing >= e.hesfecing"
        ),
    ),
}


def _area_of_admissions(c):
    areas = c.t["hpndefcam"].join(
        c.t["hpnsubgru"].select(F.col("oid").alias("hpnsubgru"), "hsunombre"), "hpnsubgru"
    ).select(F.col("oid").alias("hpndefcam"), "hsunombre")
    return c.t["adningreso"].join(areas, "hpndefcam", "left").select("oid", normalize_area("hsunombre").alias("servicio"))


_SCALARS = {
    "m1_site_short_name": Check(
        lambda c: c.t["hcntriage"].select(F.col("oid").alias("triage"), F.col("adncenate").alias("oid")).join(
            c.t["adncenate"], "oid").select(
            "triage", site_short_name("acanombre").alias("sede"), site_short_name("acacodigo").alias("corto")
        ),
        oracle(
            f"select r.oid as triage, {short('a.acanombre')} as sede, {short('a.acacodigo')} as corto "
            "from hcntriage r join adncenate a on a.oid = r.adncenate"
        ),
    ),
    "m2_nvl": Check(
        lambda c: c.t["hpnestanc"].select(
            "hpndefcam", F.coalesce("hesfecsal", instant(ORDERS_AS_OF)).alias("hasta"), F.coalesce("adningres", F.lit(0)).alias("ingreso")
        ),
        oracle(f"select hpndefcam, ifnull(hesfecsal, {_AT}) as hasta, ifnull(adningres, 0) as ingreso from hpnestanc"),
    ),
    "m3_truncate_number": Check(
        lambda c: c.t["genmantar"].select(
            "oid",
            truncate("smtvalser", 0).cast("decimal(18,2)").alias("entero"),
            truncate(F.col("smtvalser") * F.lit(-0.75).cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias("negativo"),
        ),
        oracle(
            "select oid, cast(trunc(smtvalser) as decimal(18,2)) as entero, "
            "cast(-(cast(smtvalser * 7500 as bigint) // 100) * 0.01 as decimal(18,2)) as negativo from genmantar"
        ),
    ),
    "m4_whole_days": Check(
        lambda c: c.t["hpnestanc"].select(
            "hpndefcam", "hesfecing", whole_days("hesfecing", F.coalesce("hesfecsal", instant(ORDERS_AS_OF))).alias("dias")
        ),
        oracle(
            f"select hpndefcam, hesfecing, date_sub('day', hesfecing, coalesce(hesfecsal, {_AT})) as dias from hpnestanc"
        ),
    ),
    "m5_round_half_away": Check(
        lambda c: c.t["slnserpro"].select(
            "oid",
            F.round(F.col("sercantid") / 2, 0).cast("bigint").alias("mitad"),
            F.round(-F.col("sercantid") / 2, 0).cast("bigint").alias("negativo"),
            F.round(F.col("servalpro"), 0).cast("bigint").alias("valor"),
        ),
        oracle(
            "select oid, cast((cast(sercantid as bigint) + 1) // 2 as bigint) as mitad, "
            "cast(-((cast(sercantid as bigint) + 1) // 2) as bigint) as negativo, "
            "cast(round(servalpro) as bigint) as valor from slnserpro"
        ),
    ),
    "m6_round_to_hundred": Check(
        lambda c: c.t["slnserpro"].select(
            "oid", round_hundred(F.col("servalpro") * F.col("sercantid")).cast("decimal(38,0)").alias("total")
        ),
        oracle("select oid, cast(round(servalpro * sercantid, -2) as decimal(38,0)) as total from slnserpro"),
    ),
    "m7_round_before_or_after": Check(
        lambda c: c.t["slnserpro"].select(
            "oid",
            (F.round("servalpro", 0) * F.col("sercantid")).cast("decimal(36,2)").alias("antes"),
            F.round(F.col("servalpro") * F.col("sercantid"), 0).cast("decimal(36,2)").alias("despues"),
        ),
        oracle(
            "select oid, cast(round(servalpro) * sercantid as decimal(36,2)) as antes, "
            "cast(round(servalpro * sercantid) as decimal(36,2)) as despues from slnserpro"
        ),
    ),
    "m8_fractional_days": Check(
        lambda c: c.t["hpnestanc"].select(
            "hpndefcam",
            "hesfecing",
            (elapsed_days("hesfecing", "hesfecsal") * 24).cast("decimal(12,3)").alias("horas"),
            rounded_days("hesfecing", "hesfecsal").alias("dias"),
        ),
        oracle(
            "select hpndefcam, hesfecing, cast((epoch_us(hesfecsal) - epoch_us(hesfecing)) // 3600000000 as decimal(12,3)) "
            f"as horas, {days('hesfecing', 'hesfecsal')} as dias from hpnestanc"
        ),
    ),
    "m9_format_instant": Check(
        lambda c: c.t["hcnfolio"].select("oid", date_text("hcfecfol").alias("fecha"), stamp_text("hcfecfol").alias("hora")),
        oracle(f"select oid, {dmy('hcfecfol')} as fecha, strftime(hcfecfol, '%d/%m/%Y %H:%M:%S') as hora from hcnfolio"),
    ),
    "m10_text_cast": Check(
        lambda c: c.t["genmanser"].select("oid", F.col("gengruqui1").cast("string").alias("grupo")),
        oracle("select oid, cast(gengruqui1 as varchar) as grupo from genmanser"),
    ),
    "m11_parse_instant": Check(
        lambda c: c.t["adningreso"].select(
            "oid",
            parse_dmy(F.date_format("ainfecing", "dd/MM/yyyy HH:mm:ss")).alias("con_ceros"),
            parse_dmy(F.date_format("ainfecing", "d/M/yyyy HH:mm:ss")).alias("sin_ceros"),
            parse_ymd(F.date_format("ainfecing", "yyyy-M-d HH:mm:ss")).alias("invertido"),
        ),
        oracle("select oid, ainfecing as con_ceros, ainfecing as sin_ceros, ainfecing as invertido from adningreso"),
    ),
    "m12_date_parts": Check(
        lambda c: c.t["hpnestanc"].select(
            "hpndefcam", "hesfecing", F.year("hesfecsal").alias("vigencia"), F.month("hesfecsal").alias("mes"), F.dayofmonth("hesfecsal").alias("dia")
        ),
        oracle(
            "select hpndefcam, hesfecing, cast(year(hesfecsal) as integer) as vigencia, cast(month(hesfecsal) as integer) "
            "as mes, cast(day(hesfecsal) as integer) as dia from hpnestanc"
        ),
    ),
    "m13_reference_instant": Check(
        lambda c: c.t["hcnrefer"].select(
            "hcnfolio", instant(EVENTS_AS_OF).alias("ahora"), (instant(EVENTS_AS_OF) - F.expr("interval 1 day")).alias("ayer")
        ),
        oracle(f"select hcnfolio, {_EV} as ahora, {_EV} - interval 1 day as ayer from hcnrefer"),
    ),
    "m14_concatenation": Check(
        lambda c: c.t["crncxc"].select("oid", concat_text(F.lit("07. CONSULTAS "), "cxcdocume").alias("texto")),
        oracle("select oid, '07. CONSULTAS ' || coalesce(cxcdocume, '') as texto from crncxc"),
    ),
    "m15_arithmetic": Check(
        lambda c: c.t["slnfactur"].select(
            "oid",
            (F.col("sfatotfac") + F.col("sfavalrec") - F.col("sfavalfra")).cast("decimal(20,2)").alias("total"),
            (F.col("sfavalrec") * F.col("sfavalfra")).cast("decimal(36,4)").alias("producto"),
            (F.col("sfavalrec") / 8).cast("decimal(18,3)").alias("octavo"),
            percent(F.col("sfavalrec").cast("bigint"), F.lit(7).cast("bigint")).alias("porcentaje"),
        ),
        oracle(
            "select oid, cast(sfatotfac + sfavalrec - sfavalfra as decimal(20,2)) as total, "
            "cast(sfavalrec * sfavalfra as decimal(36,4)) as producto, cast(sfavalrec / 8 as decimal(18,3)) as octavo, "
            "cast(cast(cast(sfavalrec as bigint) * 10000 // 7 as decimal(16,0)) * 0.01 as decimal(18,2)) as porcentaje "
            "from slnfactur"
        ),
    ),
    "m16_area_name": Check(
        lambda c: c.t["hpndefcam"].select(F.col("oid").alias("cama"), F.col("hpnsubgru").alias("oid")).join(
            c.t["hpnsubgru"], "oid").select(
            "cama", normalize_area("hsunombre").alias("area"),
            normalize_area(F.concat(F.lit("CACR "), "hsunombre")).alias("al_inicio"),
            normalize_area(F.concat(F.lit("SEDE"), F.lit("_X"))).alias("sin_blanco"),
        ),
        oracle(
            f"select b.oid as cama, {AREA.replace('(x,', '(f.x,').replace('else x end', 'else f.x end')} as area, "
            f"{AREA.replace('(x,', '(f.y,').replace('else x end', 'else f.y end')} as al_inicio, "
            "cast(null as varchar) as sin_blanco from hpndefcam b join "
            "(select oid, hsunombre as x, concat('CACR ', hsunombre) as y from hpnsubgru) f on f.oid = b.hpnsubgru"
        ),
    ),
    "x1_area_name_of_admissions": Check(
        _area_of_admissions,
        oracle(
            f"select i.oid, {AREA.replace('(x,', '(f.x,').replace('else x end', 'else f.x end')} as servicio from adningreso i "
            "left join hpndefcam b on b.oid = i.hpndefcam left join (select oid, hsunombre as x from hpnsubgru) f "
            "on f.oid = b.hpnsubgru"
        ),
    ),
}

CHECKS = {**_PROJECTIONS, **_FILTERS, **_SCALARS}
