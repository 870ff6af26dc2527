from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.case import Context
from checks.samples import EVENTS_AS_OF, ORDERS_AS_OF
from wardbook.plans.jobs import JOBS, report, run

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Context(spark, SF).t


def back(spark, folder, name):
    df = report(spark, name, folder)
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


OPTIONS = {"estancias": {"start": "2001-06-20"}, "ocupacion": {"start": "2001-06-20"}, "historico_servicios": {"year": 1998}}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_every_job_publishes_and_logs(spark, t, tmp_path, name):
    as_of = EVENTS_AS_OF if name.startswith(("consultas", "indicadores")) else ORDERS_AS_OF
    if name == "consultas":
        OPTIONS[name] = {"start": "2024-01-01"}
    run(t, name, as_of, str(tmp_path), **OPTIONS.get(name, {}))
    once = back(spark, str(tmp_path), name)
    if name not in ("facturas", "ventas", "ingresosnorm"):
        assert once
    if JOBS[name].partition:
        run(t, name, as_of, str(tmp_path), **OPTIONS.get(name, {}))
        assert back(spark, str(tmp_path), name) == once
    log = spark.read.option("header", True).csv(f"{tmp_path}/log").collect()
    assert {(r.job, r.result, int(r.rows)) for r in log} == {(name, "ok", sum(once.values()))}
    assert all(float(r.seconds) > 0 and bool(r.days) == bool(JOBS[name].partition) for r in log)


def test_a_day_whose_appointments_are_all_gone_is_emptied(spark, t, tmp_path):
    folder = str(tmp_path)
    run(t, "consultas", EVENTS_AS_OF, folder, start="2024-01-01")
    before = report(spark, "consultas", folder).select("FECHA").distinct().count()
    gone = {name: t[name] for name in t} | {"cmncitmed": t["cmncitmed"].limit(0)}
    run(gone, "consultas_anexar", EVENTS_AS_OF, str(tmp_path))
    assert report(spark, "consultas", folder).select("FECHA").distinct().count() == before - 1
    log = spark.read.option("header", True).csv(f"{tmp_path}/log").collect()
    assert len({r.as_of for r in log}) == 1


def test_a_daily_run_adds_to_the_history(spark, t, tmp_path):
    folder = str(tmp_path)
    run(t, "ocupacion", "2001-06-25 23:59:59", folder, start="2001-06-20")
    history = back(spark, folder, "ocupacion")
    run(t, "ocupacion_anexar", "2001-06-26 07:00:00", str(tmp_path))
    assert back(spark, folder, "ocupacion") == history
    run(t, "ocupacion_anexar", "2001-06-27 07:00:00", str(tmp_path))
    days = {r[0] for r in report(spark, "ocupacion", folder).select("FECHA_CONSULTA").distinct().collect()}
    assert len(days) == 7


def test_a_failing_run_is_logged_and_leaves_the_report(spark, t, tmp_path):
    folder = str(tmp_path)
    run(t, "ocupacion_anexar", ORDERS_AS_OF, folder)
    before = back(spark, folder, "ocupacion_anexar")
    broken = {name: t[name] for name in t} | {"hpnestanc": t["hpnestanc"].withColumn("hesfecing", F.expr("cast(raise_error('bad row') as timestamp_ntz)"))}
    for tables, error in ((broken, "bad row"), ({}, "KeyError")):
        with pytest.raises(Exception, match="bad row" if tables else "adncenate|hpn"):
            run(tables, "ocupacion_anexar", ORDERS_AS_OF, folder)
        log = spark.read.option("header", True).csv(f"{tmp_path}/log").collect()
        assert sum(r.result.startswith("failed") and error in r.result for r in log) == 1
    assert back(spark, folder, "ocupacion_anexar") == before
