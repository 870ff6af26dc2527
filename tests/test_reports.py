"""Properties of the reports, and edge cases on hand-made hospital tables."""

from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.case import Context
from checks.samples import EVENTS_AS_OF, ORDERS_AS_OF
from wardbook.plans.admissions import admissions
from wardbook.plans.appointments import appointments, appointments_history
from wardbook.plans.billing import collections, invoices
from wardbook.plans.emergency import CODES, emergency_indicators
from wardbook.plans.movements import floor_movements
from wardbook.plans.occupancy import bed_state, bed_use_history, occupancy, occupancy_history
from wardbook.plans.services import daily_census, service_followup
from wardbook.sources.schemas import schema
from wardbook.sources.tables import HospitalTables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Context(spark, SF).t


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def hospital(spark):
    """Hospital tables from ``{table: [{column: value}]}``; the rest is empty or NULL."""

    def make(**content):
        def table(name):
            fields = schema(name).fields
            text = ", ".join(f"`{f.name}` string" for f in fields)
            given = [
                tuple(None if r.get(f.name) is None else str(r[f.name]) for f in fields) for r in content.get(name, [])
            ]
            raw = spark.createDataFrame(given, text)
            return raw.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])

        return HospitalTables(table)

    return make


PLACES = {
    "adncenate": [
        {"oid": 1, "acacodigo": "01", "acanombre": "01 - NORTE"},
        {"oid": 2, "acacodigo": "02", "acanombre": "02 - SUR"},
    ],
    "hpnsubgru": [{"oid": 1, "hsunombre": "PISO 1"}, {"oid": 2, "hsunombre": "PISO 2"}, {"oid": 3, "hsunombre": None}],
    "hpngrupos": [{"oid": 1, "hgrnombre": "ADULTOS"}],
    "hpndefcam": [
        {"oid": 10, "adncenate": 1, "hpnsubgru": 1, "hpngrupos": 1, "hcaestado": 1, "adningreso": 100},
        {"oid": 11, "adncenate": 2, "hpnsubgru": 1, "hpngrupos": 1, "hcaestado": 9},
        {"oid": 12, "adncenate": 1, "hpnsubgru": 2, "hpngrupos": 1, "hcaestado": 2, "adningreso": 101},
        {"oid": 13, "adncenate": 1, "hpnsubgru": 3, "hpngrupos": 1},
    ],
}


def stay(bed, admission, start, end=None):
    return {"hpndefcam": bed, "adningres": admission, "hesfecing": start, "hesfecsal": end}


STAYS = [
    stay(10, 100, "2020-01-01 07:00:00", "2020-01-04 07:00:00"),
    stay(10, 102, "2020-01-03 00:00:00", "2020-01-03 12:00:00"),
    stay(11, None, "2020-01-02 00:00:00", "2020-01-03 00:00:00"),
    stay(12, 101, "2020-01-05 23:59:59"),
    stay(13, 103, "2019-01-01 00:00:00", "2025-01-01 00:00:00"),
    stay(99, 104, "2020-01-01 00:00:00"),
    stay(None, 105, "2020-01-01 00:00:00"),
]


@pytest.mark.parametrize("grain", ["reference", "site_floor"])
def test_history_of_occupancy_equals_single_days(hospital, grain):
    t = hospital(**PLACES, hpnestanc=STAYS)
    history = rows(occupancy_history(t, "2019-12-31", "2020-01-09", grain))
    single = Counter()
    for d in range(10):
        single += rows(occupancy(t, datetime(2019, 12, 31, 23, 59, 59) + timedelta(days=d), grain))
    assert history == single


def test_occupancy_at_one_instant(hospital):
    t = hospital(**PLACES, hpnestanc=STAYS)
    got = {(r.SEDE, r.PISO): tuple(r)[3:] for r in occupancy(t, "2020-01-03 07:00:00").collect()}
    # Floor 1 lies in both sites: its two stays show at each.
    assert got[("NORTE", "PISO 1")] == (1, 2, -1, 3, Decimal("200.00"))
    assert got[("SUR", "PISO 1")] == (1, 2, -1, 3, Decimal("200.00"))
    assert got[("NORTE", "PISO 2")] == (1, 0, 1, 0, Decimal("0.00"))
    # The real end counts, even if it is later than the instant.
    assert got[("NORTE", None)] == (1, 1, 0, 2192, Decimal("100.00"))
    split = {(r.SEDE, r.PISO): tuple(r)[3:] for r in occupancy(t, "2020-01-03 07:00:00", "site_floor").collect()}
    assert split[("SUR", "PISO 1")] == (1, 0, 1, 0, Decimal("0.00"))


def test_occupied_and_free_make_up_the_beds(t):
    for r in occupancy_history(t, "1999-01-01", "1999-02-01").collect():
        assert r.OCUPADAS + r.DISPONIBLE == r.TOTAL_CAMAS


def test_bed_use_equals_counting_each_bed(hospital):
    as_of = datetime(2020, 1, 7, 6, 0, 0)
    t = hospital(**PLACES, hpnestanc=STAYS)
    got = Counter()
    for r in bed_use_history(t, "2019-12-30", "2020-01-09", as_of).collect():
        got[tuple(r)[:5]] += r.CAMAS
    sites, floors = {1: "NORTE", 2: "SUR"}, {1: "PISO 1", 2: "PISO 2", 3: None}
    want = Counter()
    for d in range(11):
        at = datetime(2019, 12, 30, 7) + timedelta(days=d)
        for bed in PLACES["hpndefcam"]:
            held = [
                s for s in STAYS
                if s["hpndefcam"] == bed["oid"] and datetime.fromisoformat(s["hesfecing"]) <= at
                and at <= (datetime.fromisoformat(s["hesfecsal"]) if s["hesfecsal"] else as_of)
            ]
            for state in ["Ocupada" if s["adningres"] else "Desocupada" for s in held] or ["Desocupada"]:
                place = sites[bed["adncenate"]], "ADULTOS", floors[bed["hpnsubgru"]]
                want[(*place, f"{at:%d/%m/%Y}", state)] += 1
    assert got == want


def test_bed_use_is_sorted_by_day_and_place(hospital):
    got = [tuple(r)[:4] for r in bed_use_history(hospital(**PLACES, hpnestanc=STAYS), "2020-01-30", "2020-02-03", "2020-01-07 06:00:00").collect()]
    key = [(datetime.strptime(f, "%d/%m/%Y"), s, g, p is None, p) for s, g, p, f in got]
    assert key == sorted(key, key=lambda x: (x[:4], x[4] or ""))


def test_bed_state_keeps_rows_that_look_alike(hospital):
    places = {**PLACES, "adncenate": [{"oid": 1, "acacodigo": "01", "acanombre": "01 - NORTE"},
                                      {"oid": 2, "acacodigo": "02", "acanombre": "02 - NORTE"}]}
    places["hpndefcam"] = [{"oid": i, "adncenate": 1 + i % 2, "hpnsubgru": 1, "hpngrupos": 1, "hcaestado": 2} for i in range(4)]
    got = rows(bed_state(hospital(**places), "01/01/2020 07:00"))
    assert got == Counter({("01/01/2020 07:00", "NORTE", "ADULTOS", "PISO 1", "Ocupada", 2): 2})


def test_movements_of_open_stays_form_a_group_without_date(hospital):
    got = rows(floor_movements(hospital(**PLACES, hpnestanc=STAYS)).filter("INDICADOR = 'EGRESO DE PISO' and VIGENCIA is null"))
    assert got == Counter([("NORTE", "PISO 2", None, None, None, "HOSPITALIZACION", "EGRESO DE PISO", 1)])
    empty_bed = rows(floor_movements(hospital(**PLACES, hpnestanc=STAYS)).filter("SEDE = 'SUR' and INDICADOR like 'INGRESO%'"))
    assert [r[-1] for r in empty_bed] == [0]


SERVED = {
    **PLACES,
    "hpnestanc": STAYS,
    "adningreso": [{"oid": 100, "ainconsec": 7, "ainfecing": "2020-01-01 07:00:00", "genpacien": 1}],
    "genpacien": [{"oid": 1, "gpanomcom": "ANA"}],
    "slnserpro": [
        {"oid": i, "adningres1": 100, "serdesser": f"S{i}", "serfecser": at, "sercantid": q, "servalpro": v, "seraplpro": a}
        for i, (at, q, v, a) in enumerate(
            [
                ("2020-01-01 07:00:00", "2.00", "10.50", 0),
                ("2020-01-04 07:00:00", "1.00", "10.00", 0),
                ("2020-01-03 08:00:00", "3.00", "0.00", 0),
                ("2020-01-03 08:00:00", "3.00", "5.00", 1),
                ("2020-01-02 19:00:00", "1.50", None, 0),
            ]
        )
    ],
    "slnprohoj": [{"oid": 2, "inncsumpa1": 1}],
    "innmsumpa": [{"slnprohoj": 2, "ismvalpro": "4.50"}, {"slnprohoj": 2, "ismvalpro": "1.40"}],
}


def test_followup_prices_and_repeats(hospital):
    t = hospital(**SERVED)
    got = Counter((r.SERVICIO, r.VALORSERV, r.ESTANCIA, r.GRUPO_FAC) for r in service_followup(t, "2020-02-01 00:00:00").collect())
    at = ("PISO 1", "MEDICAMENTOS")
    # Rounded first, then multiplied; the stay's end is outside; two supply lines make two rows.
    assert got == Counter([("S0", Decimal("22.00"), *at), ("S2", Decimal("15.00"), *at), ("S2", Decimal("3.00"), *at),
                           ("S3", Decimal("0.00"), *at), ("S4", None, *at)])
    census = {(r.SERVICIO, r.VALORSERV) for r in daily_census(t, "2020-02-01 00:00:00").collect()}
    assert census == {("S0", 21), ("S2", 0), ("S3", 0), ("S4", None)}


def test_each_invoice_repeats_a_service(hospital):
    bills = [{"oid": i, "adningreso": 100} for i in range(3)] + [{"oid": 9, "adningreso": 5}]
    got = rows(daily_census(hospital(**SERVED, slnfactur=bills), "2020-02-01 00:00:00"))
    once = rows(daily_census(hospital(**SERVED), "2020-02-01 00:00:00"))
    assert got == Counter({r: 3 * n for r, n in once.items()})


def test_rounded_spans_of_a_service(hospital):
    r = next(r for r in daily_census(hospital(**SERVED), "2020-02-01 00:00:00").collect() if r.SERVICIO == "S4")
    assert (r.INGR_VS_SERV, r.EGRESO_VS_SERV, r.ESTANCIA_APROX) == (2, None, 3)  # 1.5 days round up


def test_one_day_of_appointments_equals_the_history_of_that_day(t):
    day = rows(appointments(t, "2024-01-16 05:00:00"))
    assert day and day == rows(appointments_history(t, "2024-01-15", "2024-01-15"))


def test_indicators_one_by_one_make_up_the_stack(t):
    stack = rows(emergency_indicators(t, EVENTS_AS_OF))
    single = set()
    for code in CODES:
        single |= set(rows(emergency_indicators(t, EVENTS_AS_OF, codes=(code,))))
    assert set(stack) == single and max(stack.values()) == 1


ER = {
    **PLACES,
    "hpndefcam": [{"oid": 10, "adncenate": 1, "hpngrupos": 5, "hcaobshos": 2}, {"oid": 11, "adncenate": 1, "hpngrupos": 1, "hcaobshos": 1}],
    "adningreso": [
        {"oid": a, "adncenate": 1, "genpacien": a, "gendetcon": 1, "hpndefcam": 10 if a < 5 else 11, "adnegreso": a}
        for a in range(1, 7)
    ],
    "genpacien": [{"oid": a, "gpasexpac": {1: 1, 2: 2, 3: 3, 4: None}.get(a, 1)} for a in range(1, 7)],
    "gendetcon": [{"oid": 1}],
    "hcntiphis": [{"oid": 3}],
    "adnegreso": [{"oid": a, "adningreso": a} for a in range(1, 7)],
    "hcnfolio": [{"oid": 100 + i, "hcntiphis": 3, "adningreso": 1 + i % 6, "hcfecfol": "2021-05-05 10:00:00"} for i in range(12)]
    + [{"oid": 300, "hcntiphis": 3, "adningreso": 1, "hcfecfol": "2021-05-01 10:00:00"}],
    "adndiaegr": [{"adnegreso": 1, "diacodigo": d, "tipo": k} for d, k in ((1, 1), (1, 1), (2, 1), (3, 2), (4, 1), (9, 1))],
    "gendiagno": [{"oid": 1, "diacodigo": "T630"}, {"oid": 2, "diacodigo": "X20"}, {"oid": 3, "diacodigo": "T63"}, {"oid": 4, "diacodigo": "O80"}],
    "slnserpro": [{"oid": i, "adningres1": 1, "serdesser": "TERAPIA RESPIRATORIA", "sercantid": "1.50"} for i in range(2)],
    "hcnrefer": [{"hcnfolio": 100}, {"hcnfolio": 300}, {"hcnfolio": 300}],
    "hcninyacc": [{"oid": 1, "adningreso": 1, "iyafecdoc": "2021-05-05 09:00:00"}],
    "hcniyaevts": [{"InsidentesAccidentes": 1, "EventosAdversos": 70}, {"InsidentesAccidentes": 1, "EventosAdversos": 70}],
}


def test_indicators_count_what_the_joins_would(hospital):
    t = hospital(**ER)
    got = {}
    for r in emergency_indicators(t, "2021-05-05 12:00:00", gyn_prefix="O").collect():
        got.setdefault(r.INDICADOR[:2], []).append((r.INDICADOR[-7:], int(r.TOTAL)))
    assert got["03"][0][1] == 12
    # Three sex codes share one label and one count, and equal rows appear once.
    assert sorted(got["05"]) == [("HOMBRES", 2), ("MUJERES", 2)]
    assert got["09"][0][1] == 4
    assert got["10"][0][1] == 2 * 3
    assert got["11"][0][1] == 2 * 3
    assert got["12"][0][1] == 2 * 4 * 3
    assert got["13"][0][1] == 2 * 1
    assert got["15"][0][1] == 2 * 5 * 3
    assert "15" not in {r.INDICADOR[:2] for r in emergency_indicators(t, "2021-05-05 12:00:00", codes=("15",), year=2020).collect()}


def test_admission_without_bed_or_floor_stays(hospital):
    t = hospital(
        **PLACES,
        adningreso=[{"oid": i, "ainconsec": i, "ainfecing": "2022-01-01 00:00:00", "genpacien": 1, "gendetcon": 1,
                     "adncenate": 1, "hpndefcam": b} for i, b in enumerate((10, 13, 77, None))],
        genpacien=[{"oid": 1}], gendetcon=[{"oid": 1, "gencontra1": 1}], gencontra=[{"oid": 1, "dgnentadm1": 1}],
        geenentadm=[{"oid": 1}],
    )
    got = {r.CONSECUTIVO: (r.NOMBRE_CAMA, r.SERVICIO) for r in admissions(t, "2022-06-01 00:00:00").collect()}
    assert got == {0: ("PISO 1", "PISO 1"), 1: (None, None), 2: (None, None), 3: (None, None)}


def test_report_orders(t):
    factura = [r.FACTURA for r in collections(t).collect()]
    assert factura == sorted(factura, key=lambda x: (x is None, x or ""), reverse=True) and None in factura[:1]
    factura = [r.FACTURA for r in invoices(t, ORDERS_AS_OF, "1995-01-01 00:00:00").collect()]
    assert factura and factura == sorted(factura)


@pytest.mark.parametrize("report, places", [
    (lambda t: bed_state(t, "01/01/2020 07:00"), (2, 3, 4)),
    (lambda t: service_followup(t, ORDERS_AS_OF), (4, 5, 9, 1, 2)),
    (lambda t: daily_census(t, ORDERS_AS_OF), (4, 5, 9, 1, 2)),
])
def test_rows_come_in_the_order_of_the_report(t, report, places):
    """Ascending by the columns at these places, counted from 1, NULLs last."""
    got = [[(r[i - 1] is None, "" if r[i - 1] is None else r[i - 1]) for i in places] for r in report(t).collect()]
    assert len(got) > 1 and got == sorted(got)


def test_reports_do_not_depend_on_the_session_zone(spark, t):
    zone = spark.conf.get("spark.sql.session.timeZone")
    utc = rows(occupancy(t, ORDERS_AS_OF)), rows(service_followup(t, ORDERS_AS_OF))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
        other = Context(spark, SF).t
        assert (rows(occupancy(other, ORDERS_AS_OF)), rows(service_followup(other, ORDERS_AS_OF))) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
