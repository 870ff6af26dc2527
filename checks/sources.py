"""Reading, publishing, the run log, the date spine and day bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardbook.functions.scalars import day_bounds, parse_ymd
from wardbook.operators.intervals import DailySpine, active_daily, date_spine
from wardbook.plans import appointments as app, occupancy as occ, services
from wardbook.plans.common import stays
from wardbook.sources.publish import audit, publish, published
from wardbook.sources.staging import shared_folder
from wardbook.sources.tables import HospitalTables, load

from .case import Check, Context, dmy, oracle
from .reports import CHECKS as REPORTS, END_DAY, EVENTS_FIRST, EVENTS_LAST, FECHA, R1, R3, R17, START_DAY, _spine
from .samples import ORDERS_AS_OF, YEAR


def _read_csv(c: Context, path: str, schema: StructType) -> DataFrame:
    return c.spark.read.schema(schema).option("header", True).csv(path)


def _loaded(c: Context) -> DataFrame:
    folder = shared_folder(c.spark)
    c.t["hpndefcam"].write.parquet(f"{folder}/hpndefcam.parquet")
    return load(c.spark, "hpndefcam", folder)


def _over_files(c: Context) -> DataFrame:
    """A report over tables that were stored and are read with their declared types."""
    folder = shared_folder(c.spark)

    def stored(name: str) -> DataFrame:
        c.t[name].write.parquet(f"{folder}/{name}.parquet")
        return load(c.spark, name, folder)

    return services.service_history(HospitalTables(stored), YEAR, ORDERS_AS_OF)


def _snapshot(c: Context) -> DataFrame:
    report, path = occ.occupancy(c.t, ORDERS_AS_OF), shared_folder(c.spark)
    publish(report.limit(1), path)
    publish(report, path)
    return published(c.spark, path, schema=report.schema)


def _incremental(c: Context) -> DataFrame:
    path = shared_folder(c.spark)
    for first, last in ((EVENTS_FIRST, "2024-01-20"), ("2024-01-11", EVENTS_LAST)):
        report = app.appointments_history(c.t, first, last).withColumn(
            "FECHA", F.date_format("HORARIO_DE_CITA", "yyyy-MM-dd")
        )
        publish(report, path, mode="append", partition="FECHA")
    return published(c.spark, path, schema=report.schema, partition="FECHA")


def _header(c: Context) -> DataFrame:
    path = shared_folder(c.spark)
    publish(occ.bed_state(c.t, FECHA), path)
    return published(c.spark, path)


def _audit(c: Context) -> DataFrame:
    path = shared_folder(c.spark)
    runs = c.given("events").select(F.col("event_type").alias("job"), F.col("ts").alias("run_ts"))
    audit(runs, path)
    log = StructType([StructField("job", StringType()), StructField("run_time", StringType())])
    return _read_csv(c, path, log)


def _entries_per_day(c: Context) -> DataFrame:
    entries = c.t["adningreso"].groupBy(F.col("ainfecing").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return (
        date_spine(c.spark, START_DAY, END_DAY).join(entries, "day", "left")
        .select("fecha", F.coalesce("n", F.lit(0)).alias("n"))
    )


def _backfill(c: Context) -> DataFrame:
    spine = DailySpine.of(START_DAY, END_DAY, "07:00:00")
    held = active_daily(stays(c.t), spine, as_of=ORDERS_AS_OF)
    return held.groupBy("at").agg(F.count("*").alias("stays"), F.count("admission").alias("patients"))


def _bounds(c: Context) -> DataFrame:
    now = parse_ymd(F.date_format("hesfecing", "yyyy-M-d HH:mm:ss"))
    day = day_bounds(now)
    return c.t["hpnestanc"].select("hpndefcam", *[b.alias(n) for n, b in day._asdict().items()])


CHECKS = {
    "s1_table_scan": Check(
        _loaded,
        oracle(
            "select oid, adncenate, hpnsubgru, hpngrupos, cast(hcaestado as integer) hcaestado, hcacodigo, "
            "cast(hcaobshos as integer) hcaobshos, adningreso from "
            "(select oid, cast(adncenate as bigint) adncenate, cast(hpnsubgru as bigint) hpnsubgru, "
            "cast(hpngrupos as bigint) hpngrupos, hcaestado, hcacodigo, hcaobshos, adningreso from hpndefcam)"
        ),
    ),
    "s1_report_over_stored_tables": Check(_over_files, REPORTS["r9_service_history"].sql),
    "s2_snapshot_publish": Check(_snapshot, R1),
    "s3_incremental_publish": Check(
        _incremental,
        f"""select *, strftime("HORARIO_DE_CITA", '%Y-%m-%d') as "FECHA" from ({R17})""",
    ),
    "s4_output_header": Check(
        _header,
        f"""select "FECHA", "SEDE", "TIPO", "PISO", "ESTADO", cast("CAMAS" as varchar) as "CAMAS" from ({R3})""",
    ),
    "s5_run_audit": Check(
        _audit, "select event_type as job, strftime(ts, '%d/%m/%Y %H:%M') as run_time from events"
    ),
    "s6_date_spine": Check(
        _entries_per_day,
        oracle(
            f"select {dmy('s.day')} as fecha, count(i.oid) as n from spine s "
            "left join adningreso i on cast(i.ainfecing as date) = s.day group by s.day",
            spine=_spine(START_DAY, END_DAY, "00:00:00"),
        ),
    ),
    "s7_backfill_in_one_plan": Check(
        _backfill,
        oracle(
            "select s.at as at, count(*) as stays, count(e.adningres) as patients from spine s join hpnestanc e "
            f"on s.at between e.hesfecing and coalesce(e.hesfecsal, timestamp '{ORDERS_AS_OF}') group by s.at",
            spine=_spine(START_DAY, END_DAY, "07:00:00"),
        ).replace("s.at as at", 's.at as "at"'),
    ),
    "s8_day_bounds": Check(
        _bounds,
        oracle(
            "select hpndefcam, date_trunc('day', hesfecing) - interval 1 day as yesterday_start, "
            "date_trunc('day', hesfecing) - interval 1 second as yesterday_end, "
            "cast(date_trunc('day', hesfecing) as timestamp) as today_start, "
            "date_trunc('day', hesfecing) + interval '23:59:59' as today_end from hpnestanc"
        ),
    ),
}
