"""Joins, aggregations, orders and unions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardbook.functions import codes as k
from wardbook.functions.scalars import decode, percent, site_short_name, whole_days
from wardbook.operators.intervals import DailySpine, InstantSpine, active_at, active_at_each, attribute_events, count_daily
from wardbook.operators.joins import count_per, fan_out_left, having, latest_version, weighted
from wardbook.operators.sets import ordered, union_all, union_distinct
from wardbook.plans import emergency as er, services as srv, unbilled
from wardbook.plans.common import beds, drug_lines, floors, sites, stays
from wardbook.sources.tables import pick

from .case import Check, case_of, oracle, short
from .reports import END_DAY, START_DAY, UNEVEN, _spine, _stack_sql, _unbilled_sql
from .samples import EVENTS_AS_OF, ORDERS_AS_OF, ORDERS_START

_AT = f"timestamp '{ORDERS_AS_OF}'"


def _bed_places(c):
    return beds(c.t).join(sites(c.t), "site").join(floors(c.t), "floor").select("bed", "SEDE", "PISO")


def _snowflake(c):
    detail = unbilled.unbilled_services(c.t, ORDERS_START, ORDERS_AS_OF)
    return detail.groupBy("NOMBRE_ENTIDAD", "GRUPOSERNOMBRE", "AREANOMBRE").agg(
        F.count("*").alias("n"), F.sum("TOTSER").cast("decimal(38,4)").alias("total")
    )


def _daily_stays(c):
    spine = DailySpine.of(START_DAY, END_DAY, "07:00:00")
    return count_daily(stays(c.t), spine, ["bed"], "stays", as_of=ORDERS_AS_OF)


def _services_and_stays(c, how):
    services = pick(c.t["slnserpro"], service="oid", admission="adningres1", served="serfecser")
    paired = attribute_events(services, stays(c.t), "admission", "served", "start", "end", ORDERS_AS_OF, how=how)
    return paired.select("service", "served", "bed", "start", "end")


def _pairs_sql(how: str) -> str:
    return oracle(
        'select v.oid as service, v.serfecser as served, e.hpndefcam as bed, e.hesfecing as "start", '
        f'e.hesfecsal as "end" from slnserpro v {how} join hpnestanc e on e.adningres = v.adningres1 '
        f"and v.serfecser >= e.hesfecing and v.serfecser < coalesce(e.hesfecsal, {_AT})"
    )


def _folios_times_referrals(c):
    folio = pick(c.t["hcnfolio"], folio="oid", admission="adningreso")
    referred = folio.join(pick(c.t["hcnrefer"], folio="hcnfolio"), "folio")
    total = weighted(count_per(folio, "admission", "n"), referred, "admission", "n")
    return total.select("admission", F.col("n").cast("bigint").alias("n"))


def _entry_and_bed_site(c):
    entry = pick(c.t["adncenate"], entry_site="oid", entry=site_short_name("acanombre"))
    ward = pick(c.t["adncenate"], ward_site="oid", ward=site_short_name("acanombre"))
    admission = pick(c.t["adningreso"], admission="oid", entry_site="adncenate", bed="hpndefcam")
    bed = pick(c.t["hpndefcam"], bed="oid", ward_site="adncenate")
    return admission.join(entry, "entry_site").join(bed.join(ward, "ward_site"), "bed").select("admission", "entry", "ward")


def _subtypes(c):
    drug = pick(c.t["slnprohoj"], service="oid", product="innproduc1")
    work = pick(c.t["slnserhoj"], service="oid", procedure="genserips1")
    service = pick(c.t["slnserpro"], service="oid")
    return service.join(drug, "service", "left").join(work, "service", "left").select("service", "product", "procedure")


def _price():
    return F.when(F.col("servalpro") == 0, F.col("line_value")).otherwise(F.col("servalpro"))


def _priced(c):
    return c.t["slnserpro"].withColumnRenamed("oid", "service").join(drug_lines(c.t), "service", "left")


_JOINS = {
    "j1_inner": Check(
        _bed_places,
        oracle(
            f'select b.oid as bed, {short("a.acanombre")} as "SEDE", f.hsunombre as "PISO" from hpndefcam b '
            "join adncenate a on a.oid = b.adncenate join hpnsubgru f on f.oid = b.hpnsubgru"
        ),
    ),
    "j2_equalities_in_where": Check(
        lambda c: c.t["hpndefcam"].alias("b").join(c.t["hpngrupos"].alias("g")).where(
            F.col("b.hpngrupos") == F.col("g.oid")).select(F.col("b.oid").alias("bed"), "g.hgrnombre"),
        oracle("select b.oid as bed, g.hgrnombre from hpndefcam b join hpngrupos g on b.hpngrupos = g.oid"),
    ),
    "j3_left": Check(
        lambda c: pick(c.t["adningreso"], admission="oid").join(
            pick(c.t["adnegreso"], admission="adningreso", left_at="adefecsal"), "admission", "left"),
        oracle(
            "select i.oid as admission, d.adefecsal as left_at from adningreso i left join adnegreso d "
            "on d.adningreso = i.oid"
        ),
    ),
    "j4_snowflake": Check(
        _snowflake,
        'select "NOMBRE_ENTIDAD", "GRUPOSERNOMBRE", "AREANOMBRE", count(*) as n, cast(sum("TOTSER") as decimal(38,4)) '
        f"as total from ({_unbilled_sql("a.acacodigo between '01' and '05'")}) group by all",
    ),
    "j5_left_made_inner": Check(
        lambda c: pick(c.t["slnserpro"], service="oid").join(
            unbilled.drug_details(c.t).select("service", "SERVICIO_CODIGO", "line_value"), "service"),
        oracle(
            'select v.oid as service, t.iprcodigo as "SERVICIO_CODIGO", m.ismvalpro as line_value from slnserpro v '
            "left join slnprohoj h on h.oid = v.oid join inncsumpa s on s.oid = h.inncsumpa1 "
            "join innmsumpa m on m.slnprohoj = h.oid join innproduc t on t.oid = h.innproduc1 "
            "join inngrupo g on g.oid = t.igrcodigo join innsubgru u on u.oid = t.isgcodigo"
        ),
    ),
    "j6_existence_only": Check(
        lambda c: having(
            having(c.t["cmncitmed"], c.t["genmedico"], "genmedico1"),
            c.t["adningreso"].filter(F.col("ainestado") == 1), "genpacien", "genpacien").select("oid"),
        oracle(
            "select c.oid from cmncitmed c join genmedico m on m.oid = c.genmedico1 "
            "where c.genpacien in (select genpacien from adningreso where ainestado = 1)"
        ),
    ),
    "j7_stays_at_instant": Check(
        lambda c: active_at(stays(c.t), ORDERS_AS_OF),
        oracle(
            'select hpndefcam as bed, adningres as admission, hesfecing as "start", hesfecsal as "end" from hpnestanc '
            f"where {_AT} between hesfecing and coalesce(hesfecsal, {_AT})"
        ),
    ),
    "j7_stays_at_uneven_instants": Check(
        lambda c: active_at_each(stays(c.t), InstantSpine.of(UNEVEN)),
        oracle(
            'select s.at as "at", e.hpndefcam as bed, e.adningres as admission, e.hesfecing as "start", e.hesfecsal as "end" '
            "from spine s join hpnestanc e on s.at >= e.hesfecing and (e.hesfecsal is null or s.at <= e.hesfecsal)",
            spine=" union all ".join(f"select timestamp '{i}' as at" for i in UNEVEN),
        ),
    ),
    "j7_stay_as_of": Check(
        _daily_stays,
        oracle(
            'select s.at as "at", e.hpndefcam as bed, count(*) as stays from spine s join hpnestanc e '
            f"on s.at between e.hesfecing and coalesce(e.hesfecsal, {_AT}) group by s.at, e.hpndefcam",
            spine=_spine(START_DAY, END_DAY, "07:00:00"),
        ),
    ),
    "j8_event_in_interval": Check(lambda c: _services_and_stays(c, "inner"), _pairs_sql("")),
    "j9_event_in_interval_left": Check(lambda c: _services_and_stays(c, "left"), _pairs_sql("left")),
    "j10_join_to_totals": Check(
        lambda c: pick(c.t["adningreso"], admission="oid").join(srv.billed_totals(c.t), "admission", "left")
        .select("admission", "TOTALFAC"),
        oracle(
            'select i.oid as admission, cast(u.total as decimal(28,2)) as "TOTALFAC" from adningreso i left join '
            "(select adningreso, sum(sfavalcar) total from slnfactur where sfadocanu = 0 group by adningreso) u "
            "on u.adningreso = i.oid"
        ),
    ),
    "j11_latest_version": Check(
        lambda c: latest_version(c.t["genmantar"], "genmanser1"),
        oracle(
            "select m.oid, e.oid as genmanser1, m.smtvalser from genmanser e join genmantar m on m.genmanser1 = e.oid "
            "and m.oid = (select max(n.oid) from genmantar n where n.genmanser1 = e.oid)"
        ),
    ),
    "j12_fan_out_left": Check(
        lambda c: fan_out_left(pick(c.t["adningreso"], admission="oid"), pick(c.t["slnfactur"], admission="adningreso"), "admission"),
        oracle("select i.oid as admission from adningreso i left join slnfactur u on u.adningreso = i.oid"),
    ),
    "j13_fan_out_count": Check(
        _folios_times_referrals,
        oracle(
            "select h.adningreso as admission, count(*) as n from hcnfolio h join (select q.adningreso from hcnrefer w "
            "join hcnfolio q on q.oid = w.hcnfolio) r on r.adningreso = h.adningreso group by h.adningreso"
        ),
    ),
    "j14_role_playing": Check(
        _entry_and_bed_site,
        oracle(
            f"select i.oid as admission, {short('a.acanombre')} as entry, {short('w.acanombre')} as ward from adningreso i "
            "join adncenate a on a.oid = i.adncenate join hpndefcam b on b.oid = i.hpndefcam "
            "join adncenate w on w.oid = b.adncenate"
        ),
    ),
    "j15_extra_predicate": Check(
        lambda c: pick(c.t["slnserpro"], service="oid", order="slnordser1").join(unbilled.service_orders(c.t), "order")
        .select("service", "NUMERO_ORDEN", "CENTRONOMBRE"),
        oracle(
            'select v.oid as service, o.sosordser as "NUMERO_ORDEN", n.ccnombre as "CENTRONOMBRE" from slnserpro v '
            "join slnordser o on o.oid = v.slnordser1 and o.sosestado <> 2 join genareser r on r.oid = o.genareser1 "
            "join ctncencos n on n.oid = r.ctncencos1"
        ),
    ),
    "j16_subtype": Check(
        _subtypes,
        oracle(
            "select v.oid as service, o.innproduc1 as product, h.genserips1 as procedure from slnserpro v "
            "left join slnprohoj o on o.oid = v.oid left join slnserhoj h on h.oid = v.oid"
        ),
    ),
}


def _floor_use(c):
    rows = beds(c.t).groupBy("floor").agg(
        F.count("current_admission").alias("used"), F.count("*").alias("beds")
    )
    return rows.join(floors(c.t), "floor").select("PISO", "used", "beds", percent("used", "beds").alias("share"))


def _by_all_columns(c):
    u = c.t["slnfactur"]
    keys = ["adningreso", "sfafecfac", "sfatotfac", "sfatipdoc", "genusuario1"]
    return u.groupBy(*keys).agg(F.sum(F.col("sfatotfac") + F.col("sfavalrec") - F.col("sfavalfra")).alias("total"))


def _volumes(c):
    services = pick(
        c.t["slnserpro"], service="oid", admission="adningres1", served="serfecser", quantity="sercantid", value="servalpro"
    )
    return srv.service_volumes(c.t, services, ORDERS_AS_OF).dropDuplicates()


_AGGREGATES = {
    "a1_count_rows": Check(
        lambda c: beds(c.t).groupBy("site", "floor").agg(F.count("*").alias("n")),
        oracle("select adncenate as site, hpnsubgru as floor, count(*) as n from hpndefcam group by all"),
    ),
    "a2_count_column": Check(
        lambda c: c.t["cmncitmed"].groupBy("cmntipact").agg(F.count("ccmpacdoc").alias("n")),
        oracle("select cmntipact, count(ccmpacdoc) as n from cmncitmed group by all"),
    ),
    "a3_sum_column": Check(
        lambda c: c.t["slnserpro"].groupBy("adningres1").agg(F.sum("sercantid").alias("total")),
        oracle("select adningres1, cast(sum(sercantid) as decimal(28,2)) as total from slnserpro group by all"),
    ),
    "a4_sum_expression": Check(
        lambda c: c.t["slnserpro"].groupBy("serdesser").agg(F.sum(F.col("sercantid") * F.col("servalpro")).alias("total")),
        oracle("select serdesser, cast(sum(sercantid * servalpro) as decimal(38,4)) as total from slnserpro group by all"),
    ),
    "a5_conditional_sum": Check(
        lambda c: _priced(c).groupBy("serdesser").agg(F.sum(_price() * F.col("sercantid")).alias("total")),
        oracle(
            "select v.serdesser, cast(sum(case when v.servalpro = 0 then m.ismvalpro * v.sercantid else v.servalpro * "
            "v.sercantid end) as decimal(38,4)) as total from slnserpro v left join slnprohoj h on h.oid = v.oid "
            "left join innmsumpa m on m.slnprohoj = h.oid group by all"
        ),
    ),
    "a6_bed_days": Check(
        lambda c: stays(c.t).groupBy("bed").agg(F.sum(whole_days("start", "end")).alias("days")),
        oracle(
            "select hpndefcam as bed, cast(sum(date_sub('day', hesfecing, hesfecsal)) as bigint) as days "
            "from hpnestanc group by all"
        ),
    ),
    "a7_carried_label": Check(
        lambda c: stays(c.t).groupBy("bed").agg(F.count("*").alias("n")).select(
            "bed", F.lit(k.FLOOR_CLASS).alias("clasificacion"), F.lit(k.FLOOR_EXIT).alias("indicador"), "n"),
        oracle(
            "select hpndefcam as bed, max('HOSPITALIZACION') as clasificacion, max('EGRESO DE PISO') as indicador, "
            "count(*) as n from hpnestanc group by all"
        ),
    ),
    "a8_group_max": Check(
        lambda c: c.t["genmantar"].groupBy("genmanser1").agg(F.max("oid").alias("oid")),
        oracle("select genmanser1, max(oid) as oid from genmantar group by all"),
    ),
    "a9_by_date_parts": Check(
        lambda c: c.t["adningreso"].groupBy(
            F.year("ainfecing").alias("vigencia"), F.month("ainfecing").alias("mes"), F.dayofmonth("ainfecing").alias("dia")
        ).agg(F.count("*").alias("n")),
        oracle(
            "select cast(year(ainfecing) as integer) as vigencia, cast(month(ainfecing) as integer) as mes, "
            "cast(day(ainfecing) as integer) as dia, count(*) as n from adningreso group by all"
        ),
    ),
    "a10_by_case_label": Check(
        lambda c: c.t["adningreso"].groupBy(
            decode("ainurgcon", k.ADMISSION_ORIGIN).alias("origen"), decode("aintiprie", k.RISK_TYPE).alias("riesgo")
        ).agg(F.count("*").alias("n")),
        oracle(
            f"select {case_of('ainurgcon', k.ADMISSION_ORIGIN)} as origen, {case_of('aintiprie', k.RISK_TYPE)} as riesgo, "
            "count(*) as n from adningreso group by all"
        ),
    ),
    "a11_hidden_keys": Check(
        lambda c: c.t["genpacien"].groupBy("gpasexpac", "pactipdoc").agg(F.count("*").alias("n")).select(
            F.when(F.col("gpasexpac") == 1, "HOMBRES").otherwise("MUJERES").alias("grupo"), "n"),
        oracle(
            "select if(gpasexpac = 1, 'HOMBRES', 'MUJERES') as grupo, count(*) as n from genpacien "
            "group by gpasexpac, pactipdoc"
        ),
    ),
    "a12_by_all_columns": Check(
        _by_all_columns,
        oracle(
            "select adningreso, sfafecfac, sfatotfac, sfatipdoc, genusuario1, "
            "cast(sum(sfatotfac + sfavalrec - sfavalfra) as decimal(30,2)) as total from slnfactur group by all"
        ),
    ),
    "a13_distinct_groups": Check(
        _volumes,
        oracle(
            f"""select distinct v.adningres1 as admission, coalesce(c.gcfnombre, 'MEDICAMENTOS') as "GRUPO_FAC",
            z.sede as "SEDE_HOSP", count(*) as "NUMREG", cast(sum(v.sercantid) as decimal(28,2)) as "CANTIDAD",
            cast(sum(case when v.servalpro = 0 then m.ismvalpro else v.servalpro end * v.sercantid)
                as decimal(38,4)) as "TOTSER"
            from slnserpro v left join slnserhoj h on h.oid = v.oid left join genserips p on p.oid = h.genserips1
            left join genconfac c on c.oid = p.genconfac1 left join slnprohoj o on o.oid = v.oid
            left join innmsumpa m on m.slnprohoj = o.oid left join z on z.adningres = v.adningres1
                and v.serfecser >= z.hesfecing and v.serfecser < coalesce(z.hesfecsal, {_AT})
            group by v.adningres1, coalesce(c.gcfnombre, 'MEDICAMENTOS'), z.sede""",
            z=f"select e.adningres, e.hesfecing, e.hesfecsal, {short('a.acanombre')} sede from hpnestanc e "
            "join hpndefcam b on b.oid = e.hpndefcam join hpnsubgru f on f.oid = b.hpnsubgru "
            "join adncenate a on a.oid = b.adncenate",
        ),
    ),
    "a14_ratio_of_totals": Check(
        _floor_use,
        oracle(
            'select f.hsunombre as "PISO", b.used, b.beds, cast(cast(10000 * b.used // b.beds as decimal(16,0)) * 0.01 '
            "as decimal(18,2)) as share from hpnsubgru f join (select hpnsubgru, count(adningreso) as used, "
            "count(*) as beds from hpndefcam group by hpnsubgru) b on b.hpnsubgru = f.oid"
        ),
    ),
    "a15_null_date_parts": Check(
        lambda c: stays(c.t).groupBy(F.year("end").alias("vigencia"), F.month("end").alias("mes")).agg(F.count("*").alias("n")),
        oracle(
            "select cast(year(hesfecsal) as integer) as vigencia, cast(month(hesfecsal) as integer) as mes, "
            "count(*) as n from hpnestanc group by all"
        ),
    ),
}

_ORDERS = {
    "o1_ascending_nulls_last": Check(
        lambda c: ordered(stays(c.t).select("end", "admission", "bed"), "end", "admission", "bed"),
        oracle(
            'select hesfecsal as "end", adningres as admission, hpndefcam as bed from hpnestanc '
            "order by 1 nulls last, 2 nulls last, 3"
        ),
    ),
    "o2_descending_nulls_first": Check(
        lambda c: c.t["crncxc"].select("cxcdocume", "oid").orderBy(F.col("cxcdocume").desc_nulls_first(), "oid"),
        oracle("select cxcdocume, oid from crncxc order by 1 desc nulls first, 2"),
    ),
    "o3_by_name": Check(
        lambda c: ordered(c.t["slnfactur"].select("oid", "sfanumfac"), "sfanumfac"),
        oracle("select oid, sfanumfac from slnfactur order by sfanumfac"),
    ),
    "o4_date_text_order": Check(
        lambda c: ordered(c.t["adningreso"].select(F.date_format("ainfecing", "dd/MM/yyyy").alias("fecha"), "oid"), "fecha", "oid"),
        oracle("select strftime(ainfecing, '%d/%m/%Y') as fecha, oid from adningreso order by 1, 2"),
    ),
    "o5_order_without_effect": Check(
        lambda c: pick(c.t["adningreso"], admission="oid").join(stays(c.t).select("admission", "start"), "admission"),
        oracle(
            'select i.oid as admission, e.hesfecing as "start" from adningreso i '
            "join (select * from hpnestanc order by hesfecing) e on e.adningres = i.oid"
        ),
    ),
}

_SETS = {
    "u1_union_distinct": Check(
        lambda c: union_distinct(
            c.t["hpnestanc"].select(F.col("hesfecing").cast("date").alias("dia"), "hpndefcam"),
            c.t["hpnestanc"].select(F.col("hesfecsal").cast("date"), "hpndefcam"),
        ),
        oracle(
            "select cast(hesfecing as date) as dia, hpndefcam from hpnestanc union "
            "select cast(hesfecsal as date), hpndefcam from hpnestanc"
        ),
    ),
    "u2_union_all_filling_columns": Check(
        lambda c: union_all(
            pick(c.t["slnprohoj"], service="oid", product="innproduc1"),
            pick(c.t["slnserhoj"], service="oid", procedure="genserips1", manual="genmanser1"),
        ),
        oracle(
            "select oid as service, innproduc1 as product, null::bigint as procedure, null::bigint as manual from slnprohoj "
            "union all select oid, null, genserips1, genmanser1 from slnserhoj"
        ),
    ),
    "u3_indicator_stack": Check(
        lambda c: er.emergency_indicators(c.t, EVENTS_AS_OF, codes=er.CODES),
        _stack_sql(er.CODES),
    ),
}

CHECKS = {**_JOINS, **_AGGREGATES, **_ORDERS, **_SETS}
