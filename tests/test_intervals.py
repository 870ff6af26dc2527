import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import CHECKS
from wardbook.operators.intervals import (
    DailySpine,
    InstantSpine,
    active_at,
    active_at_each,
    active_daily,
    attribute_events,
    count_daily,
    date_spine,
    running,
    slot,
    sorted_by_day,
    spread,
    steps,
)

SCHEMA = "stay int, key int, start timestamp_ntz, end timestamp_ntz"
AS_OF = datetime(2020, 2, 10, 12, 0, 0)


def text(instant):
    return None if instant is None else instant.isoformat(sep=" ")


def random_stays(n, seed, keys=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = datetime(2019, 12, 20) + timedelta(hours=rng.randrange(0, 60 * 24, 1 if i % 2 else 7))
        if i % 5 == 0:
            start = start.replace(hour=7, minute=0)
        end = None if rng.random() < 0.2 else start + timedelta(hours=rng.choice((-3, 0, 1, 5, 24, 48, 31 * 24, 200 * 24)))
        out.append((i, None if i % 17 == 0 else rng.randrange(keys), start, end))
    return out


def as_rows(stays):
    return [(i, k, text(s), text(e)) for i, k, s, e in stays]


def test_date_spine_includes_both_ends(spark):
    rows = date_spine(spark, "2022-12-30", "2023-01-02").orderBy("day").collect()
    assert [r.fecha for r in rows] == ["30/12/2022", "31/12/2022", "01/01/2023", "02/01/2023"]


def test_one_instant_is_closed_at_both_ends(frame):
    at = "2020-01-05 10:00:00"
    rows = [
        (1, 1, at, "2020-01-06 00:00:00"),
        (2, 1, "2020-01-01 00:00:00", at),
        (3, 1, "2020-01-01 00:00:00", "2020-01-05 09:59:59"),
        (4, 1, "2020-01-05 10:00:01", None),
        (5, 1, "2020-01-01 00:00:00", None),
    ]
    assert {r.stay for r in active_at(frame(rows, SCHEMA), at).collect()} == {1, 2, 5}


@pytest.mark.parametrize("as_of", [None, AS_OF])
@pytest.mark.parametrize("time", ["07:00:00", "23:59:59", "00:00:00"])
def test_daily_pairs_equal_comparing_everything(frame, as_of, time):
    stays = random_stays(150, seed=len(time) + (as_of is None))
    spine = DailySpine.of("2020-01-01", "2020-02-20", time)
    got = active_daily(frame(as_rows(stays), SCHEMA), spine, as_of=text(as_of)).select("stay", "at").collect()
    hms = timedelta(hours=int(time[:2]), minutes=int(time[3:5]), seconds=int(time[6:]))
    days = [datetime(2020, 1, 1) + timedelta(days=d) + hms for d in range(spine.days)]
    want = Counter(
        (i, t) for i, _, s, e in stays for t in days if s <= t and (e or as_of or t) >= t
    )
    assert Counter((r.stay, r.at) for r in got) == want


@pytest.mark.parametrize("as_of", [None, AS_OF])
def test_daily_counts_equal_counted_pairs(frame, as_of):
    stays = frame(as_rows(random_stays(300, seed=11) + random_stays(40, seed=12)), SCHEMA)
    spine = DailySpine.of("2020-01-01", "2020-02-20", "07:00:00")
    pairs = active_daily(stays, spine, as_of=text(as_of)).groupBy("at", "key").count()
    counted = count_daily(stays, spine, ["key"], "n", as_of=text(as_of))
    assert counted.columns == ["at", "key", "n"]
    assert sorted(map(str, map(tuple, counted.collect()))) == sorted(map(str, map(tuple, pairs.collect())))


def test_daily_stays_per_bed_sum_up_no_days(spark):
    """What is summed before the shuffle is a stay's two changes, not its days."""
    plan = CHECKS["j7_stay_as_of"].query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate [") :]
    assert "sequence(" not in below and "sequence(" in plan


def instants(kind):
    if kind == "hourly":
        return InstantSpine.every("2020-01-01 00:30:00", "2020-01-20 12:00:00", timedelta(hours=1))
    rng = random.Random(kind)
    start = datetime(2020, 1, 1)
    some = [start + timedelta(seconds=rng.choice((0, 1, 59, 3600, 86_399)) + 86_400 * rng.randrange(70)) for _ in range(kind)]
    return InstantSpine.of([*some, *some[:2]])


@pytest.mark.parametrize("as_of", [None, AS_OF])
@pytest.mark.parametrize("kind", ["hourly", 1, 7, 60])
def test_pairs_at_any_instants_equal_comparing_everything(frame, as_of, kind):
    stays, spine = random_stays(120, seed=5), instants(kind)
    # Stays that begin or end at an instant itself.
    for i, t in enumerate(spine.instants[:20]):
        stays += [(500 + i, 1, t, t), (600 + i, 1, t - timedelta(days=900), t), (700 + i, 1, t, None), (800 + i, 1, t + timedelta(seconds=1), t + timedelta(days=900))]
    df = frame(as_rows(stays), SCHEMA)
    got = active_at_each(df, spine, as_of=text(as_of)).select("stay", "at").collect()
    want = Counter((i, t) for i, _, s, e in stays for t in spine.instants if s <= t and (e or as_of or t) >= t)
    assert Counter((r.stay, r["at"]) for r in got) == want
    plan = active_at_each(df, spine)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_running_totals_at_any_instants(frame):
    stays, spine = [s for s in random_stays(200, seed=4) if s[1] is not None], instants(40)
    held = spine.window(frame(as_rows(stays), SCHEMA), "start", "end")
    changes = steps(held, spine, ["key"], n=F.lit(1))
    level = spread(running(changes, ["key"], ["n"]), spine, ["key"])
    got = {(r.key, r["at"]): r.n for r in spine.at(level, "k", "at").collect()}
    for key in range(4):
        for t in spine.instants:
            assert got.get((key, t), 0) == sum(k == key and s <= t and (e or t) >= t for _, k, s, e in stays)


def test_a_spine_of_instants_is_sorted_and_has_each_once():
    assert InstantSpine.of(["2020-01-02 00:00:00", datetime(2020, 1, 1), "2020-01-02 00:00:00"]).instants == (datetime(2020, 1, 1), datetime(2020, 1, 2))
    assert instants("hourly").days == 19 * 24 + 12
    with pytest.raises(ValueError):
        InstantSpine.of([])


def test_running_totals_equal_counting_each_day(spark, frame):
    stays = [s for s in random_stays(200, seed=3) if s[1] is not None]
    spine = DailySpine.of("2020-01-01", "2020-02-20", "07:00:00")
    held = spine.window(frame(as_rows(stays), SCHEMA), "start", "end")
    changes = steps(held, spine, ["key"], n=F.lit(1), weight=F.col("stay").cast("bigint"))
    daily = spread(running(changes, ["key"], ["n", "weight"]), spine, ["key"]).withColumn("at", spine.instant("k"))
    got = {(r.key, r["at"]): (r.n, r.weight) for r in daily.collect()}
    for key in range(4):
        for d in range(spine.days):
            t = datetime(2020, 1, 1, 7) + timedelta(days=d)
            inside = [i for i, k, s, e in stays if k == key and s <= t and (e or t) >= t]
            assert got.get((key, t), (0, 0)) == (len(inside), sum(inside))


def test_sorted_by_day_is_one_global_order(spark):
    spine = DailySpine.of("2020-01-01", "2020-03-31")
    rows = spark.range(900).select((F.col("id") * 7 % spine.days).cast("int").alias("k"), (F.col("id") % 10).alias("x"))
    got = [(r.k, r.x) for r in sorted_by_day(rows, spine, "x").collect()]
    assert got == sorted(got) and len(got) == 900


def brute_force(events, stays, as_of, left):
    out = Counter()
    for e, key, at in events:
        hits = [
            i for i, k, s, end in stays
            if k is not None and k == key and at is not None and s <= at < (end or as_of)
        ]
        for i in hits or ([None] if left else []):
            out[(e, i)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bucket_days", [1, 7, 400])
def test_events_in_intervals_equal_comparing_everything(frame, how, bucket_days):
    rng = random.Random(bucket_days)
    stays = random_stays(120, seed=9)
    stays += [(1000, 1, datetime(1901, 1, 1), None), (1001, 2, datetime(2020, 1, 1), datetime(9999, 12, 31))]
    events = []
    for i in range(400):
        at = datetime(2019, 12, 15) + timedelta(hours=rng.randrange(80 * 24))
        if i % 3 == 0:
            at = rng.choice(stays)[rng.choice((2, 3))] or at
        events.append((i, rng.choice((None, 0, 1, 2, 3, 99)), None if i % 50 == 49 else at))
    for i in range(300, 500):
        start = datetime(1850, 1, 1) + timedelta(hours=rng.randrange(170 * 365 * 24))
        stays.append((i, rng.randrange(4), start, start + timedelta(days=rng.choice((1, 40, 600, 9_000, 40_000)))))
        events += [(i, rng.randrange(4), rng.choice(stays[-1][2:])), (1000 + i, rng.randrange(4), start + timedelta(days=rng.randrange(5_000)))]
    events += [(2000, 1, datetime(1950, 5, 5)), (2001, 2, datetime(2500, 1, 1)), (2002, 1, datetime(2500, 1, 1))]
    got = attribute_events(
        frame([(e, k, text(a)) for e, k, a in events], "event int, key int, at timestamp_ntz"),
        frame(as_rows(stays), SCHEMA),
        "key", "at", "start", "end", text(AS_OF), how=how, bucket_days=bucket_days,
    ).select("event", "stay").collect()
    assert Counter((r.event, r.stay) for r in got) == brute_force(events, stays, AS_OF, how == "left")


@pytest.mark.parametrize("days", [1, 7, 400])
def test_slots_of_time_grow_with_the_distance(frame, days):
    # Steps of a hundredth: the widest slots are a thirty-second part of their distance.
    ages = [0]
    while ages[-1] < 700_000:
        ages.append(max(ages[-1] + 1, int(ages[-1] * 1.01)))
    instants = [AS_OF - timedelta(days=age) for age in ages] + [AS_OF + timedelta(days=2 * days), datetime(9999, 12, 31)]
    df = frame([(i, text(t)) for i, t in enumerate(instants)], "i int, t timestamp_ntz")
    found = [r.s for r in df.select("i", slot("t", text(AS_OF), days).alias("s")).orderBy("i").collect()]
    past, later = found[: len(ages)], found[len(ages) :]
    # No gap: neighbours in time have the same number or the next one.
    assert past == sorted(past) and set(past) == set(range(past[0], past[-1] + 1)) and past[0] == 1
    assert later == [0, 0] and past[-1] < 64 + 32 * 14
    near = [s for age, s in zip(ages, past, strict=True) if age < 60 * days]
    assert len(set(near)) >= min(60, 900 // days)


def test_a_stay_is_a_bounded_number_of_rows(spark, frame):
    """Rows of stays in the plan's join, told by an accumulating count on the exploded side."""
    ends = [("2020-02-01 00:00:00", "2020-02-06 00:00:00", 2), ("2015-02-03 00:00:00", "2015-02-06 00:00:00", 2),
            ("2019-06-01 00:00:00", "2020-02-01 00:00:00", 37), ("1900-01-01 00:00:00", "9999-12-31 00:00:00", 64 + 32 * 8),
            ("0001-01-01 00:00:00", None, 64 + 32 * 11)]
    for start, end, most in ends:
        stay = frame([(start, end)], "start timestamp_ntz, end timestamp_ntz")
        until = F.coalesce("end", F.lit(text(AS_OF)).cast("timestamp_ntz"))
        first, last = stay.select(slot(until, text(AS_OF), 7), slot("start", text(AS_OF), 7)).first()
        assert 1 <= last - first + 1 <= most


def test_event_at_the_end_is_outside_and_overlaps_repeat(frame):
    stays = [
        (1, 1, "2020-01-01 00:00:00", "2020-01-03 00:00:00"),
        (2, 1, "2020-01-02 00:00:00", "2020-01-05 00:00:00"),
        (3, 1, "2020-01-05 00:00:00", None),
    ]
    events = [(1, 1, "2020-01-01 00:00:00"), (2, 1, "2020-01-02 12:00:00"), (3, 1, "2020-01-03 00:00:00"),
              (4, 1, "2020-01-05 00:00:00"), (5, 1, "2020-02-10 12:00:00")]
    got = attribute_events(
        frame(events, "event int, key int, at timestamp_ntz"), frame(stays, SCHEMA),
        "key", "at", "start", "end", text(AS_OF),
    )
    assert Counter((r.event, r.stay) for r in got.collect()) == Counter([(1, 1), (2, 1), (2, 2), (3, 2), (4, 3)])
