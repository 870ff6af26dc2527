"""Emergency indicators: fifteen counts per site, stacked into one report.

Many of the indicators are counts over joins that multiply rows: every folio
of an admission meets every diagnosis, referral or therapy of it. Here the
events of the last 24 hours become rows of one shape, are summed per key and
meet the admissions once. What follows is counted per admission as well, and
the counts are multiplied, so no product of two large groups is ever built.

The frame of the day's admissions is the only one that is staged: computed
once, and joined with the tables of all time at its true size, so that a day
small enough to be broadcast spares those tables a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.functions.codes import EMERGENCY_INDICATORS as LABELS
from wardbook.functions.predicates import in_year, last_24_hours, starts_with_any
from wardbook.functions.scalars import concat_text, instant, stamp_text
from wardbook.operators.joins import count_per, having
from wardbook.sources.staging import staged
from wardbook.sources.tables import pick

from .common import beds

CODES = tuple(f"{i:02d}" for i in range(1, 16))

_TOTAL = "decimal(28,2)"
_EMERGENCY_FOLIO = 3
_EMERGENCY_BED, _WARD_BED = 2, 1
_OBSERVATION_GROUP = 5
_DEAD = (3, 4)
_INFECTION = 70
_MAIN_DIAGNOSIS = 1
_SNAKE_BITE = ("T63", "X20")
_PRIORITY_CLASSES = ("003", "004", "005")

# Indicators about what happened on the day, about its visits, and about their diagnoses.
_OF_DAY = {"03", "05", "06", "08", "09", "10", "11", "12", "13", "14", "15"}
_OF_DIAGNOSES = {"11", "12", "13", "15"}
_OF_VISITS = _OF_DIAGNOSES | {"03", "05", "09"}


def _site_codes(t) -> DataFrame:
    return pick(t["adncenate"], site="oid", SEDE="acacodigo")


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def _stack(df: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """One row per key and measure that counted something: (SEDE, INDICADOR, TOTAL)."""
    rows = F.array(
        *[
            F.struct(F.lit(LABELS[code]).alias("INDICADOR"), F.col(m).cast(_TOTAL).alias("TOTAL"))
            for code, m in measures.items()
        ]
    )
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*").filter(F.col("TOTAL") > 0)


def bed_indicators(t, codes: set[str]) -> DataFrame:
    """01 emergency stretchers and 04 observation beds."""
    emergency = beds(t).filter(F.col("bed_class") == _EMERGENCY_BED)
    counts = emergency.join(_site_codes(t), "site").groupBy("SEDE").agg(
        F.count("*").alias("01"), F.count(F.when(F.col("bed_group") == _OBSERVATION_GROUP, 1)).alias("04")
    )
    return _stack(counts, ["SEDE"], {c: c for c in ("01", "04") if c in codes})


def room_indicators(t) -> DataFrame:
    """02 emergency consulting rooms."""
    rooms = pick(t["cmnconsul"], site="adncenate", emergency="ccnurgen").filter(F.col("emergency") == 1)
    counts = rooms.join(_site_codes(t), "site").groupBy("SEDE").agg(F.count("*").alias("n"))
    return _stack(counts, ["SEDE"], {"02": "n"})


def psychology_indicators(t, as_of) -> DataFrame:
    """07 psychology and psychiatry visits, one indicator per activity."""
    appointment = pick(
        t["cmncitmed"],
        activity="cmntipact",
        timetable="cmnhormed",
        patient="genpacien",
        specialty="genespeci",
        at="ccmfeccit",
    ).filter(last_24_hours("at", as_of))
    activity = pick(
        t["cmntipact"], activity="oid", name="cmanombre", kind="cmatipcon", consultation="cmaconsul"
    ).filter(F.col("name").contains("PSI") & (F.col("consultation") == 1) & (F.col("kind") == 2))
    timetable = pick(t["cmnhormed"], timetable="oid", site="adncenate")
    rows = having(having(appointment, t["genpacien"], "patient"), t["genespeci"], "specialty")
    return (
        rows.join(activity, "activity")
        .join(timetable, "timetable")
        .join(_site_codes(t), "site")
        .groupBy("SEDE", "name")
        .agg(F.count("*").alias("n"))
        .select("SEDE", concat_text(F.lit(LABELS["07"]), "name").alias("INDICADOR"), F.col("n").cast(_TOTAL).alias("TOTAL"))
    )


def _folios(t) -> DataFrame:
    return pick(t["hcnfolio"], folio="oid", folio_type="hcntiphis", admission="adningreso", at="hcfecfol")


def _visits(t, as_of, year: int | None) -> DataFrame:
    """Emergency folios of the day, by admission; those of one calendar year, or all of them, apart."""
    recent = _folios(t).filter((F.col("folio_type") == _EMERGENCY_FOLIO) & last_24_hours("at", as_of))
    of_year = F.lit(True) if year is None else in_year("at", year)
    return having(recent, t["hcntiphis"], "folio_type").select(
        F.lit("admission").alias("tag"), F.col("admission").alias("key"),
        F.lit(1).alias("visits"), F.when(of_year, 1).alias("visits_of_year"),
    )


def _discharges(t, as_of) -> DataFrame:
    """Emergency discharges of the day, by admission."""
    discharge = pick(
        t["adnegreso"], admission="adningreso", at="adefecsal", state="adeestpac", emergency="adealturg"
    ).filter((F.col("emergency") == 1) & last_24_hours("at", as_of))
    dead = F.col("state").isin(*_DEAD)
    return discharge.select(
        F.lit("admission").alias("tag"), F.col("admission").alias("key"),
        F.when(~dead, 1).alias("alive"), F.when(dead, 1).alias("dead"),
    )


def _triages(t, as_of) -> DataFrame:
    """Priority triages of the day, by the triage that an admission names, with the triage's own site."""
    triage = pick(
        t["hcntriage"], triage="oid", site="adncenate", triage_class="hcnclaurgtr", patient="genpacien", at="hctfectri"
    ).filter(last_24_hours("at", as_of))
    priority = t["hcnclaurgtr"].filter(F.col("hccodigo").isin(*_PRIORITY_CLASSES))
    return having(having(triage, priority, "triage_class"), t["genpacien"], "patient").select(
        F.lit("triage").alias("tag"), F.col("triage").alias("key"), F.col("site").alias("own_site"), F.lit(1).alias("priority")
    )


def _infections(t, as_of) -> DataFrame:
    """Care-associated infections recorded on the day, by admission."""
    record = pick(t["hcninyacc"], record="oid", admission="adningreso", at="iyafecdoc").filter(
        last_24_hours("at", as_of)
    )
    event = pick(t["hcniyaevts"], record="`InsidentesAccidentes`", kind="`EventosAdversos`").filter(
        F.col("kind") == _INFECTION
    )
    return event.join(record, "record").select(
        F.lit("admission").alias("tag"), F.col("admission").alias("key"), F.lit(1).alias("infections")
    )


_DAY = ("visits", "visits_of_year", "alive", "dead", "priority", "infections")


def admissions_of_day(t, as_of, codes: set[str], year: int | None = None) -> DataFrame:
    """Admissions that something of the day refers to, with its site and the number of each kind of event.

    The events are rows of one shape, (tag, key, counts): summed once, and
    met once by the admissions, each under its own key and, if triages are
    asked for, under that of the triage it names.
    """
    events = []
    if codes & _OF_VISITS:
        events.append(_visits(t, as_of, year))
    if codes & {"06", "14"}:
        events.append(_discharges(t, as_of))
    if "08" in codes:
        events.append(_triages(t, as_of))
    if "10" in codes:
        events.append(_infections(t, as_of))
    day = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events).filter(F.col("key").isNotNull())
    for name, kind in (*[(m, "int") for m in _DAY], ("own_site", "long")):
        if name not in day.columns:
            day = day.withColumn(name, F.lit(None).cast(kind))
    summed = day.groupBy("tag", "key", "own_site").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _DAY])
    admission = pick(
        t["adningreso"],
        admission="oid",
        triage="hcentriage",
        site="adncenate",
        bed="hpndefcam",
        patient="genpacien",
        plan="gendetcon",
        discharge="adnegreso",
    )
    tags = [tag for tag, asked in (("admission", codes - {"08"}), ("triage", codes & {"08"})) if asked]
    keys = F.array(*[F.struct(F.lit(tag).alias("tag"), F.col(tag).alias("key")) for tag in tags])
    named = admission.withColumn("named", F.explode(keys)).select("*", "named.*").filter(F.col("key").isNotNull())
    return (
        named.join(summed, ["tag", "key"])
        .withColumn("site", F.coalesce("own_site", "site"))
        .join(_site_codes(t), "site")
        .select("admission", "SEDE", "bed", "patient", "plan", "discharge", *_DAY)
    )


def _facts(t, admissions: DataFrame, codes: set[str], gyn_prefix: str) -> DataFrame:
    """What the tables of all time say of the day's admissions, summed to one row per admission.

    Each of those tables is read once and meets the small frame of
    admissions; its rows become rows of one shape, (admission, counts).
    """
    of_patient, of_discharge = (admissions.filter("visits > 0").select("admission", c) for c in ("patient", "discharge"))
    frames = []
    if codes & (_OF_VISITS - {"03"}):
        person = pick(t["genpacien"], patient="oid", sex="gpasexpac")
        frames.append(person.join(of_patient, "patient").select("admission", "sex", F.lit(1).alias("known")))
    if codes & _OF_DIAGNOSES:
        closed = pick(t["adnegreso"], discharge="oid").join(of_discharge, "discharge")
        frames.append(closed.select("admission", F.lit(1).alias("closed")))
        diagnosis = pick(t["adndiaegr"], discharge="adnegreso", diagnosis="diacodigo", kind="tipo")
        catalogue = pick(t["gendiagno"], diagnosis="oid", code="diacodigo")
        main = F.col("kind") == _MAIN_DIAGNOSIS
        frames.append(
            diagnosis.join(of_discharge, "discharge").join(catalogue, "diagnosis").select(
                "admission",
                F.lit(1).alias("diagnoses"),
                F.when(main, 1).alias("main_diagnoses"),
                F.when(main & starts_with_any("code", _SNAKE_BITE), 1).alias("snake_bites"),
                F.when(main & F.col("code").startswith(gyn_prefix), 1).alias("gynaecological"),
            )
        )
    if "12" in codes:
        service = pick(t["slnserpro"], admission="adningres1", name="serdesser", quantity="sercantid")
        therapy = service.filter(F.col("name").contains("RESPIRATORIA"))
        frames.append(
            therapy.join(admissions.filter("visits > 0").select("admission"), "admission")
            .select("admission", "quantity", F.lit(1).alias("therapies"))
        )
    if codes & {"10", "15"}:
        known = pick(t["hcntiphis"], folio_type="oid").withColumn("typed", F.lit(True))
        folio = _folios(t).drop("at").join(admissions.filter("visits + infections > 0").select("admission"), "admission")
        emergency = F.col("typed") & (F.col("folio_type") == _EMERGENCY_FOLIO)
        folio = folio.join(known, "folio_type", "left").withColumn("emergency_folios", F.when(emergency, 1))
        if "15" in codes:
            folio = folio.join(count_per(pick(t["hcnrefer"], folio="hcnfolio"), "folio", "referrals"), "folio", "left")
        frames.append(folio.select("admission", "emergency_folios", *(["referrals"] if "15" in codes else [])))
    if not frames:
        return admissions
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    facts = [c for c in stacked.columns if c not in ("admission", "sex")]
    latest = [F.max("sex").alias("sex")] if "sex" in stacked.columns else []
    summed = stacked.groupBy("admission").agg(*latest, *[F.sum(c).alias(c) for c in facts])
    return admissions.join(summed, "admission", "left")


def day_indicators(t, as_of, codes: set[str], gyn_prefix: str, year: int | None) -> DataFrame:
    """The indicators about the day's visits, discharges, triages and infections, out of one pass.

    The frame of the day's admissions is the one that is staged: it is small,
    and joined with the tables of all time at its true size it spares them a
    shuffle. Counts over joins that multiply rows are products of counts per
    admission, so no product of two groups is built.
    """
    rows = _facts(t, staged(admissions_of_day(t, as_of, codes, year)), codes, gyn_prefix)
    types = {"sex": "int", "quantity": "decimal(28,2)"}
    facts = ("sex", "known", "closed", "diagnoses", "main_diagnoses", "snake_bites", "gynaecological", "quantity",
             "therapies", "emergency_folios", "referrals")
    rows = rows.select("*", *[F.lit(None).cast(types.get(f, "bigint")).alias(f) for f in facts if f not in rows.columns])
    if codes & {"05", "09"}:
        bed = beds(t).select("bed", "bed_class", "bed_group")
        plan = pick(t["gendetcon"], plan="oid", planned=F.lit(True))
        rows = rows.join(bed, "bed", "left").join(plan, "plan", "left")
        observed = (
            (F.col("known") > 0) & F.col("planned")
            & (F.col("bed_class") == _EMERGENCY_BED) & (F.col("bed_group") == _OBSERVATION_GROUP)
        )
        moved = (F.col("known") > 0) & (F.col("bed_class") == _WARD_BED)
    else:
        observed = moved = F.lit(False)
    man = F.coalesce(F.col("sex") == 1, F.lit(False))
    diagnosed = (F.col("visits") > 0) & (F.col("known") > 0) & (F.col("closed") > 0) & (F.col("diagnoses") > 0)
    treated = diagnosed & (F.col("main_diagnoses") > 0) & (F.col("therapies") > 0)
    weight = (_big("visits") * _big("main_diagnoses")).cast("decimal(20,0)")
    # 05 is counted per sex code, of which several share a label.
    measures = {
        "03": F.col("visits"),
        "05H": F.when(observed & man, F.col("visits")),
        "05M": F.when(observed & ~man, F.col("visits")),
        "06": F.col("alive"),
        "08": F.col("priority"),
        "09": F.when(moved, F.col("visits")),
        "10": _big("infections") * _big("emergency_folios"),
        "11": F.when(diagnosed, _big("visits") * _big("snake_bites")),
        "12": F.when(treated, weight * F.col("quantity")),
        "13": F.when(diagnosed, _big("visits") * _big("gynaecological")),
        "14": F.col("dead"),
        "15": F.when(diagnosed, _big("visits_of_year") * _big("diagnoses") * _big("referrals")),
    }
    asked = {code: m for code, m in measures.items() if code[:2] in codes}
    some_therapy = F.count(F.when(treated, 1)).alias("some_therapy")
    per_sex = rows.groupBy("SEDE", "sex").agg(*[F.sum(m).alias(code) for code, m in asked.items()], some_therapy)

    def line(code: str) -> Column:
        # A quantity is shown wherever there was a therapy, a count where there was something to count.
        shown = F.col("some_therapy") > 0 if code == "12" else F.col(code) > 0
        own = F.col("sex") if code[:2] == "05" else F.lit(None).cast("int")
        return F.struct(
            F.lit(LABELS[code]).alias("INDICADOR"), own.alias("own"), F.col(code).cast(_TOTAL).alias("TOTAL"), shown.alias("shown")
        )

    # Stacked before the sexes are summed up, so that all lines come from the same rows.
    lines = per_sex.select("SEDE", F.explode(F.array(*[line(code) for code in asked])).alias("l")).select("SEDE", "l.*")
    return (
        lines.groupBy("SEDE", "INDICADOR", "own")
        .agg(F.sum("TOTAL").cast(_TOTAL).alias("TOTAL"), F.max("shown").alias("shown"))
        .filter("shown")
        .select("SEDE", "INDICADOR", "TOTAL")
    )


def emergency_indicators(
    t, as_of, codes=CODES, gyn_prefix: str = "0", year: int | None = None
) -> DataFrame:
    """SEDE, FECHA, INDICADOR and TOTAL of the indicators asked for, all of them by default.

    ``gyn_prefix`` is the diagnosis prefix of indicator 13, ``year`` limits
    indicator 15 to one calendar year. Equal rows appear once.
    """
    wanted = set(codes)
    frames = []
    if wanted & {"01", "04"}:
        frames.append(bed_indicators(t, wanted))
    if "02" in wanted:
        frames.append(room_indicators(t))
    if "07" in wanted:
        frames.append(psychology_indicators(t, as_of))
    if wanted & _OF_DAY:
        frames.append(day_indicators(t, as_of, wanted & _OF_DAY, gyn_prefix, year))
    stacked = reduce(DataFrame.union, frames).distinct()
    return stacked.select("SEDE", stamp_text(instant(as_of)).alias("FECHA"), "INDICADOR", "TOTAL")
