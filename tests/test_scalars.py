from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardbook.functions import codes
from wardbook.functions.predicates import in_year, last_24_hours, number_between, number_not_in, text_between
from wardbook.functions.scalars import (
    BLANKS,
    concat_text,
    day_bounds,
    decode,
    elapsed_days,
    instant,
    normalize_area,
    parse_dmy,
    parse_ymd,
    percent,
    round_hundred,
    rounded_days,
    site_short_name,
    truncate,
    whole_days,
)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "name, short",
    [("01 - NORTH", "NORTH"), ("AB-C", "AB-C"), ("AB-", "AB-"), ("NODASH", "ODASH"), ("X", "X"), (None, None),
     ("1 - A - B", "A - B")],
)
def test_site_short_name(frame, name, short):
    assert values(frame([(name,)], "x string"), site_short_name("x")) == [short]


def expected_area(name):
    """What the area rule says, word by word."""
    if name is None:
        return None
    for marker in ("CACE", "CACR", "SEDE"):
        at = name.find(marker)
        if at == 0:
            head, blank, tail = name[5:].partition(" ")
            return tail.strip() if blank else None
        if at > 0:
            return name[: at - 1].strip()
    return name


@pytest.mark.parametrize(
    "name",
    [
        "CACE 01 NORTE", "CACE01", "CACE 01", "URGENCIAS CACE", "URGENCIAS-CACR SUR", "SEDE NORTE PISO 2",
        "PISO 3 SEDE SUR", "xCACE", "CACR 1 CACE 2", "SEDE CACR", " sin marca ", "", None, "CACE", "CACE  DOBLE BLANCO ",
        "CACR 7 \tTAB ", "A  CACE", "UCI - CACE - SEDE",
    ],
)
def test_normalize_area(frame, name):
    assert values(frame([(name,)], "x string"), normalize_area("x")) == [expected_area(name)]


def test_blanks_are_those_that_python_strips():
    assert not BLANKS.strip()
    assert {c for c in map(chr, range(0x3001)) if c.isspace()} == set(BLANKS)


@pytest.mark.parametrize("x, places, cut", [("1.29", 1, "1.2"), ("-1.29", 1, "-1.2"), ("-0.99", 0, "0"), ("7.00", 0, "7")])
def test_truncate(frame, x, places, cut):
    assert values(frame([(x,)], "x dec"), truncate("x", places)) == [Decimal(cut)]


def test_percent_is_exact(frame):
    rows = frame([(23, 2000), (1, 3), (29, 100), (0, 7), (1999999, 2000000)], "a bigint, b bigint")
    assert values(rows, percent("a", "b")) == [Decimal(x) for x in ("1.15", "33.33", "29.00", "0.00", "99.99")]


def test_rounding_is_away_from_zero(frame):
    rows = frame([("0.50",), ("-0.50",), ("2.50",), ("-2.49",)], "x dec")
    assert values(rows, F.round("x", 0)) == [1, -1, 3, -2]
    rows = frame([("150.00",), ("149.99",), ("-250.00",), ("49.99",)], "x dec")
    assert values(rows, round_hundred("x")) == [200, 100, -300, 0]


def test_days_between_instants(frame):
    rows = frame(
        [
            ("2020-01-01 23:00:00", "2020-01-02 01:00:00"),
            ("2020-01-01 00:00:00", "2020-01-01 12:00:00"),
            ("2020-01-01 12:00:00", "2020-01-01 00:00:00"),
            ("2020-02-28 06:00:00", "2020-03-01 06:00:00"),
            ("2020-01-01 00:00:00", None),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert values(rows, whole_days("a", "b")) == [0, 0, 0, 2, None]
    assert values(rows, rounded_days("a", "b")) == [0, 1, -1, 2, None]
    hours = values(rows.limit(4), (elapsed_days("a", "b") * 24).cast("double"))
    assert hours == pytest.approx([2, 12, -12, 48])


def test_days_do_not_depend_on_the_session_zone(spark, frame):
    rows = frame([("2021-03-13 12:00:00", "2021-03-14 12:00:00")], "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(rows, whole_days("a", "b")) == [1]
        assert values(rows, elapsed_days("a", "b").cast("double")) == [1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_instants(spark):
    one = spark.range(1)
    for given in ("2020-1-2 03:04:05", datetime(2020, 1, 2, 3, 4, 5)):
        assert values(one, instant(given)) == [datetime(2020, 1, 2, 3, 4, 5)]
    assert values(one, instant(date(2020, 1, 2))) == [datetime(2020, 1, 2)]
    assert values(one, parse_dmy(F.lit("1/2/2020 03:04:05"))) == [datetime(2020, 2, 1, 3, 4, 5)]
    assert values(one, parse_ymd(F.lit("2020-1-2 03:04:05"))) == [datetime(2020, 1, 2, 3, 4, 5)]


def test_day_bounds(spark):
    bounds = day_bounds("2024-03-01 10:00:00")
    assert spark.range(1).select(*bounds).first() == (
        datetime(2024, 2, 29), datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 3, 1), datetime(2024, 3, 1, 23, 59, 59),
    )


def test_decode_and_text(frame):
    rows = frame([(0, "a"), (6, None), (7, "c"), (None, "d")], "code int, x string")
    assert values(rows, decode("code", codes.BED_STATE)) == ["Ninguno", "Inactiva", None, None]
    assert values(rows, decode("code", codes.BED_STATE, F.lit("?"))) == ["Ninguno", "Inactiva", "?", "?"]
    assert values(rows, concat_text(F.lit("<"), "x")) == ["<a", "<", "<c", "<d"]


# Labels as the reports print them, written down apart from the code tables.
PRINTED = {
    "DOCUMENT_TYPE": [(8, "Número único de identificación"), (14, "Permiso por protección temporal"),
                      (15, "Documento de identificación extranjero"), (13, None), (16, None)],
    "PLAN_TYPE": [(13, "ConvenioUCI"), (14, None)],
    "ADMISSION_ORIGIN": [(8, "Urgencia_Ginecologica"), (11, "Cirugia_Programada"), (13, "Uci_Adulto"), (14, None)],
    "ADMISSION_CAUSE": [(5, "Odontología"), (8, "Quemados"), (11, "Cirugia_Programada"), (12, None)],
    "RISK_TYPE": [(8, "Lesión_por_Agresión"), (14, "Accidente_Ofídico"), (17, "Sospecha_de_Maltrato_Emocional"), (-1, None)],
    "BED_STATE": [(4, "Desbloqueada"), (7, None)],
    "FILING_STATE": [(-1, "No Registrado"), (2, "Radicado Entidad"), (4, None)],
    "INVOICE_TYPE": [("16", "Factura_GlobalPFGP"), ("3", None), ("016", None)],
    "CONSULTATION_TYPE": [(0, "Ninguna"), (1, "General"), (2, "Especializada"), (3, None)],
    "APPOINTMENT_STATE": [(5, "INATENCION"), (6, None)],
}


@pytest.mark.parametrize("name", sorted(PRINTED))
def test_labels_read_as_printed(frame, name):
    kind = "string" if isinstance(PRINTED[name][0][0], str) else "int"
    rows = frame([(code,) for code, _ in PRINTED[name]], f"code {kind}")
    assert values(rows, decode("code", getattr(codes, name))) == [label for _, label in PRINTED[name]]


def test_last_24_hours_is_closed(frame):
    rows = frame(
        [("2024-01-01 10:00:00",), ("2024-01-01 09:59:59",), ("2024-01-02 10:00:00",), ("2024-01-02 10:00:01",), (None,)],
        "x timestamp_ntz",
    )
    kept = rows.filter(last_24_hours("x", "2024-01-02 10:00:00")).collect()
    assert [r[0] for r in kept] == [datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)]


def test_year_bounds(frame):
    rows = frame(
        [("2021-12-31 23:59:59",), ("2022-01-01 00:00:00",), ("2022-12-31 23:59:59",), ("2023-01-01 00:00:00",)],
        "x timestamp_ntz",
    )
    assert rows.filter(in_year("x", 2022)).count() == 2


def test_text_codes_as_text_and_as_numbers(frame):
    rows = frame([("1",), ("01",), ("010",), ("05",), ("6",), ("x",), (None,)], "x string")
    assert [r[0] for r in rows.filter(text_between("x", "01", "05")).collect()] == ["01", "010", "05"]
    assert [r[0] for r in rows.filter(number_between("x", 1, 5)).collect()] == ["1", "01", "05"]
    assert [r[0] for r in rows.filter(number_not_in("x", (1, 6))).collect()] == ["010", "05"]
