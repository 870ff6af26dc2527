"""The reports, whole and by indicator."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wardbook.functions import codes as k
from wardbook.operators.intervals import InstantSpine
from wardbook.plans import (
    admissions as adm,
    appointments as app,
    billing,
    carried,
    emergency as er,
    movements,
    occupancy as occ,
    services as srv,
    unbilled,
)

from .case import Check, case_of, days, dmy, oracle, short
from .samples import EVENTS_AS_OF, EVENTS_START, ORDERS_AS_OF, ORDERS_START, YEAR

START_DAY, END_DAY = ORDERS_START[:10], ORDERS_AS_OF[:10]
MIDDLE_DAY = "1996-06-15"
EVENTS_FIRST, EVENTS_LAST = EVENTS_START[:10], EVENTS_AS_OF[:10]
FECHA = "30/06/2001 23:00"

_AT = f"timestamp '{ORDERS_AS_OF}'"
_EV = f"timestamp '{EVENTS_AS_OF}'"


def _spine(first: str, last: str, time: str) -> str:
    return (
        f"select cast(g as timestamp) + interval '{time}' as at, cast(g as date) as day "
        f"from generate_series(timestamp '{first} 00:00:00', timestamp '{last} 00:00:00', interval 1 day) s(g)"
    )


def _occupancy_sql(spine: str, by_site: bool = False) -> str:
    site_key, site_join = (", b.adncenate", " and o.adncenate = c.adncenate") if by_site else ("", "")
    return oracle(
        f"""select strftime(s.at, '%Y-%-m-%-d %H:%M:%S') as "FECHA_CONSULTA", {short("a.acanombre")} as "SEDE",
        f.hsunombre as "PISO", c.total as "TOTAL_CAMAS", coalesce(o.n, 0) as "OCUPADAS",
        c.total - coalesce(o.n, 0) as "DISPONIBLE", cast(coalesce(o.d, 0) as bigint) as "DIAS_CAMA_OCUP",
        cast(cast((10000 * coalesce(o.n, 0)) // c.total as decimal(16,0)) * 0.01 as decimal(18,2)) as "PORC_OCUP"
        from totals c join hpnsubgru f on f.oid = c.hpnsubgru join adncenate a on a.oid = c.adncenate
        cross join spine s
        left join occupied o on o.hpnsubgru = c.hpnsubgru{site_join} and o.at = s.at""",
        spine=spine,
        totals="select adncenate, hpnsubgru, count(*) total from hpndefcam group by all",
        occupied=f"select s.at, b.hpnsubgru{site_key}, count(*) n, "
        "sum(date_sub('day', e.hesfecing, coalesce(e.hesfecsal, s.at))) d "
        "from spine s join hpnestanc e on s.at >= e.hesfecing and (e.hesfecsal is null or s.at <= e.hesfecsal) "
        "join hpndefcam b on b.oid = e.hpndefcam group by all",
    )


_ONE_INSTANT = f"select {_AT} as at"
R1 = _occupancy_sql(_ONE_INSTANT)
R2 = _occupancy_sql(_spine(START_DAY, END_DAY, "23:59:59"))

R3 = oracle(
    f"""select '{FECHA}' as "FECHA", {short("a.acanombre")} as "SEDE", g.hgrnombre as "TIPO", f.hsunombre as "PISO",
    {case_of("b.hcaestado", k.BED_STATE)} as "ESTADO", count(*) as "CAMAS"
    from hpndefcam b join adncenate a on a.oid = b.adncenate join hpngrupos g on g.oid = b.hpngrupos
    join hpnsubgru f on f.oid = b.hpnsubgru
    group by a.acanombre, b.adncenate, b.hcaestado, g.hgrnombre, f.hsunombre"""
)

R4 = oracle(
    f"""select {short("a.acanombre")} as "SEDE", g.hgrnombre as "TIPO", f.hsunombre as "PISO",
    {dmy("s.day")} as "FECHA", case when e.adningres is null then 'Desocupada' else 'Ocupada' end as "ESTADO",
    count(*) as "CAMAS"
    from hpndefcam b join hpngrupos g on g.oid = b.hpngrupos join hpnsubgru f on f.oid = b.hpnsubgru
    join adncenate a on a.oid = b.adncenate cross join spine s
    left join hpnestanc e on e.hpndefcam = b.oid
        and s.at between e.hesfecing and coalesce(e.hesfecsal, {_AT})
    group by all""",
    spine=_spine(START_DAY, END_DAY, "07:00:00"),
)

# Every hour of two weeks, and some instants at uneven distances.
HOURS = ("1998-03-01 00:00:00", "1998-03-14 23:00:00")
UNEVEN = ("1996-02-29 23:59:59", "1998-03-03 00:00:00", "1998-03-03 00:00:01", "1998-03-03 12:30:00", "2001-06-30 07:00:00", "2001-06-30 23:59:59")


def _bed_use_at_sql(instants: str) -> str:
    at = """strftime(s.at, '%d/%m/%Y %H:%M:%S')"""
    return R4.replace(dmy("s.day"), at).replace(f"spine as ({_spine(START_DAY, END_DAY, '07:00:00')})", f"spine as ({instants})")


_HOURLY = f"select cast(g as timestamp) as at from generate_series(timestamp '{HOURS[0]}', timestamp '{HOURS[1]}', interval 1 hour) s(g)"
_AT_UNEVEN = " union all ".join(f"select timestamp '{i}' as at" for i in UNEVEN)

_FOLLOWED = f"""from slnserpro v
    left join slnserhoj h on h.oid = v.oid left join genserips p on p.oid = h.genserips1
    left join genconfac c on c.oid = p.genconfac1
    join adningreso i on i.oid = v.adningres1 join genpacien x on x.oid = i.genpacien
    left join adnegreso d on d.adningreso = i.oid left join slnfactur u on u.adningreso = i.oid
    join hpndefcam b on b.adningreso = i.oid join hpnsubgru f on f.oid = b.hpnsubgru
    join adncenate a on a.oid = b.adncenate
    join history z on z.adningres = i.oid"""
_HISTORY = (
    "select e.adningres, f.hsunombre estancia, e.hesfecing, e.hesfecsal from hpnestanc e "
    "join hpndefcam b on b.oid = e.hpndefcam join hpnsubgru f on f.oid = b.hpnsubgru"
)
_IN_STAY = f"v.serfecser >= z.hesfecing and v.serfecser < coalesce(z.hesfecsal, {_AT})"
_SPANS = f"""{dmy("i.ainfecing")} as "FECHA_INGRESO", {dmy("v.serfecser")} as "FECHA_SERVICIO",
    {dmy("d.adefecsal")} as "FECHA_EGRESO", {days("i.ainfecing", "v.serfecser")} as "INGR_VS_SERV",
    {days("v.serfecser", "d.adefecsal")} as "EGRESO_VS_SERV",
    {days("i.ainfecing", f"coalesce(z.hesfecsal, {_AT})")} as "ESTANCIA_APROX" """
_WHO = f"""coalesce(c.gcfnombre, 'MEDICAMENTOS') as "GRUPO_FAC", {short("a.acanombre")} as "SEDE",
    f.hsunombre as "PISO", z.estancia as "ESTANCIA", p.sipcodcup as "CUP", v.serdesser as "SERVICIO" """

R5 = oracle(
    f"""select i.ainconsec as "NUMINGRESO", i.oid as "OID", x.gpanomcom as "PACIENTE", {_WHO}, {_SPANS},
    v.servalpro as "VALORPRO", v.seraplpro as "APL_PROC",
    cast(round(case when v.seraplpro <> 0 then 0 when v.servalpro = 0 then m.ismvalpro else v.servalpro end)
        * v.sercantid as decimal(36,2)) as "VALORSERV"
    {_FOLLOWED} left join slnprohoj o on o.oid = v.oid left join innmsumpa m on m.slnprohoj = o.oid
    where {_IN_STAY}""",
    history=_HISTORY,
)

R6 = oracle(
    f"""select i.ainconsec as "NUMINGRESO", x.gpanomcom as "PACIENTE", {_WHO}, {_SPANS},
    cast(round((case when v.seraplpro = 0 then v.servalpro else 0 end) * v.sercantid) as decimal(34,0)) as "VALORSERV"
    {_FOLLOWED} where {_IN_STAY}""",
    history=_HISTORY,
)


def _movements_sql(with_label: bool, union: str) -> str:
    def branch(column: str, label: str, count: str) -> str:
        text = f"{dmy(f'max({column})')} as \"FECHA_IND\"," if with_label else ""
        return f"""select {short("a.acanombre")} as "SEDE", f.hsunombre as "PISO",
            cast(year(e.{column}) as integer) as "VIGENCIA", cast(month(e.{column}) as integer) as "MES",
            cast(day(e.{column}) as integer) as "DIA", {text} 'HOSPITALIZACION' as "CLASIFICACION",
            '{label}' as "INDICADOR", {count} as "VALORIND"
            from hpnestanc e join hpndefcam b on b.oid = e.hpndefcam join adncenate a on a.oid = b.adncenate
            join hpnsubgru f on f.oid = b.hpnsubgru
            group by {short("a.acanombre")}, f.hsunombre, year(e.{column}), month(e.{column}), day(e.{column})"""

    return oracle(
        branch("hesfecing", "INGRESO A PISO", "count(b.adningreso)")
        + f" {union} "
        + branch("hesfecsal", "EGRESO DE PISO", "count(*)")
    )


def _unbilled_sql(site_filter: str) -> str:
    head = f"""cast(null as varchar) as "TIPO_DOCUMENTO", o.sosordser as "NUMERO_ORDEN",
        {dmy("o.sosfecord")} as "FECHA_ORDEN", i.ainconsec as "NUMERO_INGRESO", {dmy("i.ainfecing")} as "FECHA_INGRESO",
        {dmy("d.adefecsal")} as "FECHA_EGRESO", l.gdecodigo as "CODIGO_PLAN", l.gdenombre as "NOMBRE_PLAN",
        a.acacodigo as "CODIGO_CENTROA", a.acanombre as "NOMBRE_CENTROA", y.entcodigo as "CODIGO_ENTIDAD",
        y.entnombre as "NOMBRE_ENTIDAD", {case_of("x.pactipdoc", k.DOCUMENT_TYPE)} as "TIPO_DOCUMENTO_PACIENTE",
        x.pacnumdoc as "NUMERO_DE_IDENTIFICACION", x.gpanomcom as "PACIENTE", {dmy("x.gpafecnac")} as "PACIENTEFECHANAC",
        {case_of("l.gdetippla", k.PLAN_TYPE)} as "TIPOPLAN", {case_of("i.aintiping", k.ADMISSION_TYPE)} as "TIPO_INGRESO" """
    middle = """v.serdesser as "SERVICIO_NOMBRE", v.sercantid as "CANTIDAD", v.serfecser as "FECHASERVICIO" """
    people = """w.gmecodigo as "MEDICOCODIGO", w.gmenomcom as "MEDICONOMBRE", r.gascodigo as "AREACODIGO",
        r.gasnombre as "AREANOMBRE", n.cccodigo as "CENTROCODIGO", n.ccnombre as "CENTRONOMBRE" """
    money = """v.sercantid as "CANTIDAD_2", v.servalpac as "VALPAC", v.servalent as "VALENT" """
    shared = f"""join adningreso i on i.oid = v.adningres1 join genpacien x on x.oid = i.genpacien
        left join adnegreso d on d.adningreso = i.oid join gendetcon l on l.oid = i.gendetcon
        join adncenate a on a.oid = i.adncenate join gencontra q on q.oid = l.gencontra1
        join geenentadm y on y.oid = q.dgnentadm1 join genmedico w on w.oid = v.genmedico1
        join slnordser o on o.oid = v.slnordser1 and o.sosestado <> 2 join genareser r on r.oid = o.genareser1
        join ctncencos n on n.oid = r.ctncencos1
        where i.ainfecing >= timestamp '{ORDERS_START}' and i.ainfecing <= {_AT} and i.ainestado in (0, 3)
        and v.seraplpro = 0 and {site_filter}"""
    return oracle(
        f"""select {head}, t.iprcodigo as "SERVICIO_CODIGO", {middle}, g.igrcodigo as "GRUPOSERCODIGO",
        g.igrnombre as "GRUPOSERNOMBRE", s.isgcodigo as "SUBGRUPOCODIGO", s.isgnombre as "SUBGRUPONOMBRE", {people},
        cast(null as varchar) as "GRUPOQUICODIGO", cast(null as varchar) as "GRUPOQUINOMBRE", {money},
        cast(case when v.servalpro = 0 then m.ismvalpro * v.sercantid else v.servalpro * v.sercantid end
            as decimal(38,4)) as "TOTSER", cast(null as varchar) as "GRUPOQUIRURGICO"
        from slnserpro v join slnprohoj h on h.oid = v.oid join inncsumpa c on c.oid = h.inncsumpa1
        join innmsumpa m on m.slnprohoj = h.oid join innproduc t on t.oid = h.innproduc1
        join inngrupo g on g.oid = t.igrcodigo join innsubgru s on s.oid = t.isgcodigo {shared}
        union all
        select {head}, t.sipcodigo, {middle}, g.ggrcodigo, g.ggrnombre, s.gsucodigo, s.gsunombre, {people},
        z.sgqcodigo, z.sgqnombre, {money},
        cast(round(case when e.gengruqui1 is null then m.smtvalser * v.sercantid
            else v.servalpro * v.sercantid end, -2) as decimal(38,4)), cast(e.gengruqui1 as varchar)
        from slnserpro v join slnserhoj h on h.oid = v.oid join genserips t on t.oid = h.genserips1
        join gengrupos g on g.oid = t.gengrupos1 join gensubgru s on s.oid = t.gensubgru1
        join genmanser e on e.oid = h.genmanser1 join genmantar m on m.genmanser1 = e.oid
            and m.oid = (select max(n.oid) from genmantar n where n.genmanser1 = e.oid)
        left join gengruqui z on z.oid = e.gengruqui1 {shared}"""
    )


_VOLUMES = f"""select v.adningres1, coalesce(c.gcfnombre, 'MEDICAMENTOS') grupo, z.sede, count(*) n,
    sum(v.sercantid) q, sum(case when v.servalpro = 0 then m.ismvalpro else v.servalpro end * v.sercantid) total
    from slnserpro v left join slnserhoj h on h.oid = v.oid left join slnprohoj o on o.oid = v.oid
    left join genserips p on p.oid = h.genserips1 left join genconfac c on c.oid = p.genconfac1
    left join innmsumpa m on m.slnprohoj = o.oid
    left join (select e.adningres, e.hesfecing, e.hesfecsal, {short("a.acanombre")} sede
        from hpnestanc e join hpndefcam b on b.oid = e.hpndefcam join hpnsubgru f on f.oid = b.hpnsubgru
        join adncenate a on a.oid = b.adncenate) z
        on z.adningres = v.adningres1 and {_IN_STAY}
    group by all"""

R9 = oracle(
    f"""select {short("a.acanombre")} as "SEDE_INGRESO", i.ainconsec as "AINCONSEC",
    {case_of("i.aintiping", k.ADMISSION_TYPE)} as "TIPO_INGRESO", cast(year(i.ainfecing) as integer) as "AÑO",
    cast(month(i.ainfecing) as integer) as "MES",
    case when u.adningreso is null then 'PENDIENTE' else 'FACTURADO' end as "ESTADO",
    coalesce(w.sede, {short("a.acanombre")}) as "SEDE_PROD", w.grupo as "GRUPO_FAC", w.n as "NUMREG",
    cast(w.q as decimal(28,2)) as "CANTIDAD", cast(w.total as decimal(38,4)) as "TOTSER",
    cast(u.total as decimal(28,2)) as "TOTALFAC"
    from adningreso i join adncenate a on a.oid = i.adncenate
    left join (select adningreso, sum(sfavalcar) total from slnfactur where sfadocanu = 0 group by adningreso) u
        on u.adningreso = i.oid
    join volumes w on w.adningres1 = i.oid where year(i.ainfecing) = {YEAR}""",
    volumes=_VOLUMES,
)

AREA = """case when strpos(x, 'CACE') = 1 or (strpos(x, 'CACE') = 0 and strpos(x, 'CACR') = 1)
        or (strpos(x, 'CACE') = 0 and strpos(x, 'CACR') = 0 and strpos(x, 'SEDE') = 1)
    then case when strpos(substr(x, 6), ' ') = 0 then null
        else trim(substr(substr(x, 6), strpos(substr(x, 6), ' ') + 1)) end
    when strpos(x, 'CACE') > 0 then trim(left(x, strpos(x, 'CACE') - 2))
    when strpos(x, 'CACR') > 0 then trim(left(x, strpos(x, 'CACR') - 2))
    when strpos(x, 'SEDE') > 0 then trim(left(x, strpos(x, 'SEDE') - 2))
    else x end"""

R10 = oracle(
    f"""select i.ainconsec as "CONSECUTIVO", i.ainfecing as "FECHA_INGRESO",
    {case_of("i.aintiping", k.ADMISSION_TYPE)} as "TIPO_INGRESO",
    {case_of("i.ainestado", k.ADMISSION_STATE)} as "ESTADO_INGRESO",
    {case_of("i.ainurgcon", k.ADMISSION_ORIGIN)} as "INGRESO_POR",
    {case_of("i.aincauing", k.ADMISSION_CAUSE)} as "CAUSA_INGRESO",
    {case_of("i.aintiprie", k.RISK_TYPE)} as "TIPO_RIESGO", a.acacodigo as "CENTRO_DE_ATENCION",
    l.gdenombre as "PLAN_BENEFICIOS", y.entnombre as "EPS", f.hsunombre as "NOMBRE_CAMA",
    i.ainfechos as "FECHAHOSP", i.ainfecegre as "FECHAEGRESO", i.ainfecfac as "FECHAFACT",
    {AREA.replace("(x,", "(f.hsunombre,").replace("else x end", "else f.hsunombre end")} as "SERVICIO"
    from adningreso i join genpacien x on x.oid = i.genpacien join gendetcon l on l.oid = i.gendetcon
    join gencontra q on q.oid = l.gencontra1 join geenentadm y on y.oid = q.dgnentadm1
    join adncenate a on a.oid = i.adncenate left join adnegreso d on d.oid = i.adnegreso
    left join hpndefcam b on b.oid = i.hpndefcam left join hpnsubgru f on f.oid = b.hpnsubgru
    where i.ainfecing between timestamp '{ORDERS_START}' and {_AT}"""
)

R11 = oracle(
    f"""select u.sfanumfac as "SFANUMFAC", {case_of("c.crfestado", k.FILING_STATE)} as "ESTADO",
    d.crffecrad as "CRFFECRAD"
    from slnfactur u join crnradfacd d on d.slnfactur = u.oid join crnradfacc c on c.oid = d.crnradfacc"""
)

_COUNTABLE = f"""u.sfafecfac between timestamp '{ORDERS_START}' and {_AT} and u.sfadocanu = 0 and u.sfaestdoc <> 0
    and cast(u.sfatipdoc as integer) not in (3,4,9,10,11,12,13,14,15)"""

R12 = oracle(
    f"""select i.ainconsec as "INGCONSECUTIVO", u.sfanumfac as "FACTURA", u.sfafecfac as "SFAFECFAC",
    cast(trunc(u.sfatotfac) as decimal(17,0)) as "VALOR", u.sfavalrec as "RECIBO_DE_CAJA", u.sfavalfra as "FRANQUICIA",
    cast(sum(u.sfatotfac + u.sfavalrec - u.sfavalfra) as decimal(30,2)) as "VALORTOTAL",
    {case_of("u.sfatipdoc", k.INVOICE_TYPE)} as "TIPO_FACTURA", u.genusuario1 as "FACTURADOR",
    s.usudescri as "NOMFACT"
    from slnfactur u join adningreso i on i.oid = u.adningreso left join adncenate a on a.oid = i.adncenate
    join genusuario s on s.oid = u.genusuario1
    where ({_COUNTABLE} and u.ctntipcom1 is not null) or ({_COUNTABLE} and u.ctntipcom3 is not null)
    group by i.ainconsec, u.sfafecfac, u.sfanumfac, u.sfatotfac, u.sfavalrec, u.sfavalfra, u.sfatipdoc,
        u.genusuario1, s.usudescri"""
)

R13 = oracle(
    f"""select i.ainconsec as "INGRESO", count(v.sercantid) as "CANTIDAD",
    cast(sum(v.sercantid * v.servalpro) as decimal(38,4)) as "VALOR", v.serfecser as "FECHASER"
    from slnserpro v join adningreso i on i.oid = v.adningres1 join slnordser o on o.oid = v.slnordser1
    where i.ainestado in (0, 1, 3) and v.serfecser between timestamp '{ORDERS_START}' and {_AT}
    and o.sosestado <> 2 and v.seraplpro <> 1 group by i.ainconsec, v.serfecser"""
)

R14 = oracle(
    """select t.cctnumtra as "TRASLADO", c.cxcdocume as "FACTURA", c.cxcdocfecven as "FECHA_VENCIMIENTO",
    t.cctfectra as "FECHA_TRASLADO", m.cmtnvalor as "VALOR_TRASLADO", c.crnsaldo as "SALDO_CARTERA"
    from crnmtrasl m join crnctrasl t on t.oid = m.crnctrasl join gentercer g on g.oid = m.gentercer
    join crncxc c on c.oid = m.crncxc where g.tertipcon in (1, 2, 3)"""
)


def _recent(column: str) -> str:
    return f"{column} between {_EV} - interval 1 day and {_EV}"


_FOLIOS = """from hcnfolio h join hcntiphis y on y.oid = h.hcntiphis join adningreso i on i.oid = h.adningreso
    join adncenate a on a.oid = i.adncenate"""
_DIAGNOSES = """join adnegreso d on d.oid = i.adnegreso join adndiaegr g on g.adnegreso = d.oid
    join gendiagno j on j.oid = g.diacodigo join genpacien x on x.oid = i.genpacien"""
_VISIT = f"y.oid = 3 and {_recent('h.hcfecfol')}"


def _indicator(label: str, rest: str, total: str = "count(*)", more_keys: str = "") -> str:
    return (
        f"select a.acacodigo as \"SEDE\", {label} as \"INDICADOR\", cast({total} as decimal(28,2)) as \"TOTAL\" "
        f"{rest} group by a.acacodigo{more_keys}"
    )


def _label(code: str) -> str:
    return f"'{k.EMERGENCY_INDICATORS[code]}'"


R15 = {
    "01": _indicator(_label("01"), "from hpndefcam b join adncenate a on a.oid = b.adncenate where b.hcaobshos = 2"),
    "02": _indicator(_label("02"), "from cmnconsul c join adncenate a on a.oid = c.adncenate where c.ccnurgen = 1"),
    "03": _indicator(_label("03"), f"{_FOLIOS} where {_VISIT}"),
    "04": _indicator(
        _label("04"),
        "from hpndefcam b join adncenate a on a.oid = b.adncenate where b.hcaobshos = 2 and b.hpngrupos = 5",
    ),
    "05": _indicator(
        f"case when x.gpasexpac = 1 then {_label('05H')} else {_label('05M')} end",
        f"{_FOLIOS} join gendetcon l on l.oid = i.gendetcon join hpndefcam b on b.oid = i.hpndefcam "
        f"join genpacien x on x.oid = i.genpacien where {_VISIT} and b.hcaobshos = 2 and b.hpngrupos = 5",
        more_keys=", x.gpasexpac",
    ),
    "06": _indicator(
        _label("06"),
        "from adnegreso d join adningreso i on i.oid = d.adningreso join adncenate a on a.oid = i.adncenate "
        f"where d.adeestpac not in (3, 4) and d.adealturg = 1 and {_recent('d.adefecsal')}",
    ),
    "07": _indicator(
        f"{_label('07')} || t.cmanombre",
        "from cmncitmed c join cmntipact t on t.oid = c.cmntipact join cmnhormed h on h.oid = c.cmnhormed "
        "join genpacien x on x.oid = c.genpacien join genespeci s on s.oid = c.genespeci "
        "join adncenate a on a.oid = h.adncenate where t.cmanombre like '%PSI%' and t.cmaconsul = 1 "
        f"and t.cmatipcon = 2 and {_recent('c.ccmfeccit')}",
        more_keys=", t.cmanombre",
    ),
    "08": _indicator(
        _label("08"),
        "from hcntriage r join adncenate a on a.oid = r.adncenate join hcnclaurgtr t on t.oid = r.hcnclaurgtr "
        "join genpacien x on x.oid = r.genpacien join adningreso i on i.hcentriage = r.oid "
        f"where t.hccodigo in ('003', '004', '005') and {_recent('r.hctfectri')}",
    ),
    "09": _indicator(
        _label("09"),
        f"{_FOLIOS} join hpndefcam b on b.oid = i.hpndefcam join genpacien x on x.oid = i.genpacien "
        f"where {_VISIT} and b.hcaobshos = 1",
    ),
    "10": _indicator(
        _label("10"),
        "from hcninyacc r join hcniyaevts e on e.InsidentesAccidentes = r.oid "
        "join adningreso i on i.oid = r.adningreso join hcnfolio h on h.adningreso = i.oid "
        "join hcntiphis y on y.oid = h.hcntiphis join adncenate a on a.oid = i.adncenate "
        f"where e.EventosAdversos = 70 and y.oid = 3 and {_recent('r.iyafecdoc')}",
    ),
    "11": _indicator(
        _label("11"),
        f"{_FOLIOS} {_DIAGNOSES} where {_VISIT} and (j.diacodigo like 'T63%' or j.diacodigo like 'X20%') and g.tipo = 1",
    ),
    "12": _indicator(
        _label("12"),
        f"{_FOLIOS} {_DIAGNOSES} join slnserpro v on v.adningres1 = i.oid "
        f"where {_VISIT} and g.tipo = 1 and v.serdesser like '%RESPIRATORIA%'",
        total="sum(v.sercantid)",
    ),
    "13": _indicator(_label("13"), f"{_FOLIOS} {_DIAGNOSES} where {_VISIT} and j.diacodigo like '0%' and g.tipo = 1"),
    "14": _indicator(
        _label("14"),
        "from adnegreso d join adningreso i on i.oid = d.adningreso join adncenate a on a.oid = i.adncenate "
        f"where d.adeestpac in (3, 4) and d.adealturg = 1 and {_recent('d.adefecsal')}",
    ),
    "15": _indicator(
        _label("15"),
        f"{_FOLIOS} {_DIAGNOSES} join (select q.adningreso from hcnrefer w join hcnfolio q on q.oid = w.hcnfolio) r "
        f"on r.adningreso = i.oid where {_VISIT}",
    ),
}


def _stack_sql(codes) -> str:
    branches = " union ".join(R15[code] for code in codes)
    return oracle(
        f"""select "SEDE", strftime({_EV}, '%d/%m/%Y %H:%M:%S') as "FECHA", "INDICADOR", "TOTAL"
        from (select distinct * from ({branches}))"""
    )


def _appointments_sql(first: str, last: str) -> str:
    return oracle(
        f"""select {short("a.acanombre")} as "SEDE", t.cmanombre as "ESPECIALIDAD_NOMBRE",
        c.ccmfecasi as "HORARIO_DE_CITA", {case_of("t.cmatipcon", k.CONSULTATION_TYPE)} as "TIPO_CONSULTA",
        {case_of("c.ccmestado", k.APPOINTMENT_STATE)} as "ESTADO", count(c.ccmpacdoc) as "TOTAL"
        from cmncitmed c join cmnhormed h on h.oid = c.cmnhormed join genmedico m on m.oid = c.genmedico1
        join gendetcon l on l.oid = c.gendetcon join cmntipact t on t.oid = c.cmntipact
        join adncenate a on a.oid = h.adncenate
        join (select g.d from generate_series(timestamp '{first} 00:00:00', timestamp '{last} 00:00:00', interval 1 day) g(d)) s
            on c.ccmfecasi >= s.d and c.ccmfecasi <= s.d + interval '23:59:59'
        group by all"""
    )


R17 = _appointments_sql(EVENTS_FIRST, EVENTS_LAST)

def _carried(c):
    """The state of what was known at an instant, and then all that has changed since."""
    keys, now = occ.places("reference"), carried.placed_stays(c.t)
    at = F.lit(f"{MIDDLE_DAY} 12:00:00").cast("timestamp_ntz")
    then = now.filter(F.col("start") <= at).withColumn("end", F.when(F.col("end") <= at, F.col("end")))
    state = carried.changes_by_day(carried.changed(None, then), keys)
    state = carried.carried(state, carried.changes_by_day(carried.changed(then, now), keys), keys)
    return carried.occupancy_of_state(c.t, state, START_DAY, END_DAY)


CHECKS = {
    "r1_occupancy": Check(lambda c: occ.occupancy(c.t, ORDERS_AS_OF), R1),
    "r1_occupancy_by_site_and_floor": Check(
        lambda c: occ.occupancy(c.t, ORDERS_AS_OF, grain="site_floor"), _occupancy_sql(_ONE_INSTANT, by_site=True)
    ),
    "r2_occupancy_history": Check(lambda c: occ.occupancy_history(c.t, START_DAY, END_DAY), R2),
    "r2_occupancy_carried": Check(_carried, R2),
    "r2_occupancy_history_by_site_and_floor": Check(
        lambda c: occ.occupancy_history(c.t, START_DAY, END_DAY, grain="site_floor"),
        _occupancy_sql(_spine(START_DAY, END_DAY, "23:59:59"), by_site=True),
    ),
    "r3_bed_state": Check(lambda c: occ.bed_state(c.t, FECHA), R3),
    "r4_bed_use_history": Check(lambda c: occ.bed_use_history(c.t, START_DAY, END_DAY, ORDERS_AS_OF), R4),
    "r4_bed_use_hourly": Check(
        lambda c: occ.bed_use_at(c.t, InstantSpine.every(*HOURS, timedelta(hours=1)), ORDERS_AS_OF), _bed_use_at_sql(_HOURLY)
    ),
    "r4_bed_use_at_uneven_instants": Check(
        lambda c: occ.bed_use_at(c.t, InstantSpine.of(UNEVEN), ORDERS_AS_OF), _bed_use_at_sql(_AT_UNEVEN)
    ),
    "r5_service_followup": Check(lambda c: srv.service_followup(c.t, ORDERS_AS_OF), R5),
    "r6_daily_census": Check(lambda c: srv.daily_census(c.t, ORDERS_AS_OF), R6),
    "r7_floor_movements": Check(lambda c: movements.floor_movements(c.t), _movements_sql(False, "union")),
    "r7_floor_movements_labelled": Check(
        lambda c: movements.floor_movements(c.t, with_label=True), _movements_sql(True, "union all")
    ),
    "r8_unbilled_services": Check(
        lambda c: unbilled.unbilled_services(c.t, ORDERS_START, ORDERS_AS_OF),
        _unbilled_sql("a.acacodigo >= '01' and a.acacodigo <= '05'"),
    ),
    "r8_unbilled_services_numeric_sites": Check(
        lambda c: unbilled.unbilled_services(c.t, ORDERS_START, ORDERS_AS_OF, 2, 4),
        _unbilled_sql("cast(a.acacodigo as integer) between 2 and 4"),
    ),
    "r9_service_history": Check(lambda c: srv.service_history(c.t, YEAR, ORDERS_AS_OF), R9),
    "r10_admissions": Check(lambda c: adm.admissions(c.t, ORDERS_AS_OF, ORDERS_START), R10),
    "r11_filed_invoices": Check(lambda c: billing.filed_invoices(c.t), R11),
    "r12_invoices": Check(lambda c: billing.invoices(c.t, ORDERS_AS_OF, ORDERS_START), R12),
    "r13_sales": Check(lambda c: billing.sales(c.t, ORDERS_AS_OF, ORDERS_START), R13),
    "r14_collections": Check(lambda c: billing.collections(c.t), R14),
    "r15_emergency_indicators": Check(lambda c: er.emergency_indicators(c.t, EVENTS_AS_OF), _stack_sql(R15)),
    "r16_appointments": Check(
        lambda c: app.appointments(c.t, EVENTS_AS_OF), _appointments_sql("2024-01-29", "2024-01-29")
    ),
    "r17_appointments_history": Check(lambda c: app.appointments_history(c.t, EVENTS_FIRST, EVENTS_LAST), R17),
}

_NAMES = {
    "01": "emergency_stretchers",
    "02": "consulting_rooms",
    "03": "emergency_visits",
    "04": "observation_beds",
    "05": "observation_patients_by_sex",
    "06": "live_discharges",
    "07": "psychology_visits",
    "08": "priority_visits",
    "09": "moved_to_ward",
    "10": "care_infections",
    "11": "snake_bites",
    "12": "respiratory_therapies",
    "13": "gynaecological_emergencies",
    "14": "deaths",
    "15": "referrals",
}

for _code, _name in _NAMES.items():
    CHECKS[f"r15_{_code}_{_name}"] = Check(
        lambda c, code=_code: er.emergency_indicators(c.t, EVENTS_AS_OF, codes=(code,)), _stack_sql([_code])
    )
