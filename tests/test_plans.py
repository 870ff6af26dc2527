"""What the plans must and must not contain."""

import re
from collections import Counter

import pytest

from checks import CHECKS
from checks.case import Context
from checks.samples import EVENTS_AS_OF, ORDERS_AS_OF
from wardbook.functions.predicates import between_instants, last_24_hours
from wardbook.operators.intervals import active_at
from wardbook.plans import common, emergency, occupancy
from wardbook.sources.staging import staged as sources_staged
from wardbook.sources.tables import open_tables

SF = "/root/testdata/sf0.001"
REPORTS = [n for n in CHECKS if re.match(r"r\d+_(?!\d)", n)] + ["j7_stay_as_of", "j8_event_in_interval", "j9_event_in_interval_left"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_products_and_no_python(spark, name):
    text = plan(CHECKS[name].query(spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["r5_service_followup", "r6_daily_census", "r8_unbilled_services", "r9_service_history"])
def test_service_reports_are_one_lazy_plan(spark, name, monkeypatch):
    def eager(*_):
        raise AssertionError("a job ran while the frame was built")

    frame = type(spark.range(0))
    for method in ("count", "collect", "first", "isEmpty"):
        monkeypatch.setattr(frame, method, eager)
    monkeypatch.setattr(frame, "write", property(eager))
    text = plan(CHECKS[name].query(spark, SF))
    if name in ("r5_service_followup", "r6_daily_census"):
        assert "_bucket" in text and "/wardbook-" not in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Some hospital tables as files, with their declared types."""
    folder = tmp_path_factory.mktemp("hospital")
    t = Context(spark, SF).t
    for name in ("hpnestanc", "hpndefcam", "adncenate", "hpnsubgru", "hcnfolio", "slnserpro"):
        t[name].write.parquet(f"{folder}/{name}.parquet")
    return open_tables(spark, str(folder))


EMERGENCY = (
    "adncenate", "hpndefcam", "cmnconsul", "hcnfolio", "hcntiphis", "adningreso", "adnegreso", "hcntriage", "hcnclaurgtr", "genpacien",
    "hcninyacc", "hcniyaevts", "adndiaegr", "gendiagno", "slnserpro", "hcnrefer", "gendetcon", "cmncitmed", "cmntipact", "cmnhormed", "genespeci",
)


def test_indicators_write_once_and_read_each_large_table_once(spark, tmp_path, monkeypatch):
    t = Context(spark, SF).t
    for name in EMERGENCY:
        t[name].write.parquet(f"{tmp_path}/{name}.parquet")
    stored = open_tables(spark, str(tmp_path))
    staged = []
    monkeypatch.setattr(emergency, "staged", lambda df: staged.append(df) or sources_staged(df))
    report = emergency.emergency_indicators(stored, EVENTS_AS_OF)
    assert len(staged) == 1
    scans = [Counter(re.findall(r"/(\w+)\.parquet\]", plan(df))) for df in (staged[0], report)]
    both = scans[0] + scans[1]
    for name in ("adningreso", "hcntriage", "hcninyacc", "hcniyaevts", "adndiaegr", "slnserpro", "hcnrefer", "cmncitmed"):
        assert both[name] == 1, (name, both)
    # The day's rows on one side, those of all time for the day's admissions on the other.
    assert scans[0]["hcnfolio"] == scans[1]["hcnfolio"] == scans[0]["adnegreso"] == scans[1]["adnegreso"] == 1
    assert scans[0]["genpacien"] == 1 and scans[1]["genpacien"] == 2
    for code in emergency.CODES:
        staged.clear()
        emergency.emergency_indicators(stored, EVENTS_AS_OF, codes=(code,))
        assert len(staged) == (code not in ("01", "02", "04", "07"))


def test_instants_reach_the_scan(stored):
    text = plan(active_at(common.stays(stored), ORDERS_AS_OF))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "LessThanOrEqual(hesfecing,2001-06-30T23:59:59)" in pushed
    assert "GreaterThanOrEqual(hesfecsal,2001-06-30T23:59:59)" in pushed
    text = plan(stored["hcnfolio"].filter(last_24_hours("hcfecfol", EVENTS_AS_OF)))
    assert "GreaterThanOrEqual(hcfecfol,2024-01-29T23:59:59)" in text


def test_the_spine_range_reaches_the_scan(stored):
    text = plan(occupancy.occupancy_history(stored, "1999-01-01", "1999-01-31"))
    assert "LessThanOrEqual(hesfecing,1999-01-31T23:59:59)" in text


def test_only_needed_columns_are_read(stored):
    text = plan(occupancy.occupancy(stored, ORDERS_AS_OF))
    read = [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", text)]
    assert {"hpndefcam", "hesfecing", "hesfecsal"} in read
    services = stored["slnserpro"].filter(between_instants("serfecser", "1999-01-01", ORDERS_AS_OF)).select("serdesser")
    assert "ReadSchema: struct<serdesser:string,serfecser:timestamp_ntz>" in plan(services)
