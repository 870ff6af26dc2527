"""Occupancy carried from run to run against the whole history of the stays as they are."""

from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from test_reports import PLACES, STAYS, hospital, rows, stay  # noqa: F401
from wardbook.plans.carried import changed, changes_by_day, carried, occupancy_of_state, placed_stays, run_occupancy
from wardbook.plans.occupancy import occupancy_history, places
from wardbook.sources.publish import published

START = "2020-01-01"


def versions(rng, runs: int):
    """Stays as they are at each run: new ones, ends that come late, are moved or taken back, stays that go or repeat."""
    now = list(STAYS)
    yield list(now), list(PLACES["hpndefcam"])
    for r in range(runs):
        day = datetime(2020, 1, 3) + timedelta(days=2 * r)
        for _ in range(rng.integers(1, 5)):
            begin = day - timedelta(hours=int(rng.integers(0, 200)))
            end = None if rng.random() < 0.4 else begin + timedelta(hours=int(rng.integers(-20, 300)))
            now.append(stay(int(rng.choice([10, 11, 12, 13, 99])), 1, str(begin), end and str(end)))
        for _ in range(rng.integers(0, 4)):
            i = int(rng.integers(len(now)))
            what = rng.random()
            if what < 0.3:
                now.pop(i)
            elif what < 0.5:
                now.append(now[i])
            else:
                now[i] = now[i] | {"hesfecsal": None if what < 0.6 else str(day - timedelta(hours=int(rng.integers(0, 150))))}
        moved = [b | {"hpnsubgru": int(rng.integers(1, 4))} if rng.random() < 0.2 else b for b in PLACES["hpndefcam"]]
        yield list(now), moved


@pytest.mark.parametrize("grain", ["reference", "site_floor"])
def test_daily_runs_equal_the_whole_history(spark, hospital, tmp_path, grain):  # noqa: F811
    rng, before, base = np.random.default_rng(len(grain)), None, None
    for r, (now, bed_rows) in enumerate(versions(rng, 4)):
        t = hospital(**(PLACES | {"hpndefcam": bed_rows}), hpnestanc=now)
        after, until = placed_stays(t, grain), date(2020, 1, 4) + timedelta(days=2 * r)
        args = t, changed(before, after), base, f"v{r}", until, str(tmp_path), grain, START, "parquet"
        days = run_occupancy(*args)
        assert days and run_occupancy(*args) == []
        got = published(spark, f"{tmp_path}/ocupacion", "parquet", partition="FECHA_CONSULTA")
        want = occupancy_history(t, START, until, grain)
        assert rows(got.select(want.columns)) == rows(want), r
        before, base = after, f"v{r}"
    with pytest.raises(ValueError, match="stands for"):
        run_occupancy(t, changed(before, after), "v1", "v9", until, str(tmp_path), grain, START, "parquet")


def test_runs_write_only_what_can_have_altered(spark, hospital, tmp_path):  # noqa: F811
    t = hospital(**PLACES, hpnestanc=STAYS)
    first = placed_stays(t)
    assert len(run_occupancy(t, changed(None, first), None, "a", "2020-01-08", str(tmp_path), start=START)) == 8
    # Nothing has changed: the next day alone.
    assert run_occupancy(t, changed(first, first), "a", "b", "2020-01-09", str(tmp_path), start=START) == ["2020-1-9 23:59:59"]
    t = hospital(**PLACES, hpnestanc=[*STAYS, stay(11, 7, "2020-01-06 10:00:00", "2020-01-07 10:00:00")])
    late = run_occupancy(t, changed(first, placed_stays(t)), "b", "c", "2020-01-10", str(tmp_path), start=START)
    assert late == sorted(f"2020-1-{d} 23:59:59" for d in (6, 7, 8, 9, 10))


def test_a_run_that_breaks_off_can_be_made_again(spark, hospital, tmp_path, monkeypatch):  # noqa: F811
    from wardbook.plans import carried as module

    t = hospital(**PLACES, hpnestanc=STAYS)
    known, publish = placed_stays(t), module.publish
    run_occupancy(t, changed(None, known), None, "a", "2020-01-08", str(tmp_path), start=START, format="parquet")
    t = hospital(**PLACES, hpnestanc=STAYS[2:])

    def broken(df, path, *args, **settings):
        if path.endswith("acumulado"):
            raise OSError("gone")
        return publish(df, path, *args, **settings)

    args = t, changed(known, placed_stays(t)), "a", "b", "2020-01-09", str(tmp_path)
    monkeypatch.setattr(module, "publish", broken)
    with pytest.raises(OSError):
        run_occupancy(*args, start=START, format="parquet")
    monkeypatch.setattr(module, "publish", publish)
    assert run_occupancy(*args, start=START, format="parquet")
    got, want = published(spark, f"{tmp_path}/ocupacion", "parquet", partition="FECHA_CONSULTA"), occupancy_history(t, START, "2020-01-09")
    assert rows(got.select(want.columns)) == rows(want)


def test_the_state_has_a_row_per_place_and_day(spark, hospital):  # noqa: F811
    many = [stay(10, i, "2020-01-01 00:00:00", "2020-01-03 00:00:00") for i in range(500)]
    t, keys = hospital(**PLACES, hpnestanc=many), places("reference")
    state = changes_by_day(changed(None, placed_stays(t)), keys)
    assert state.count() == 2
    gone = changes_by_day(changed(placed_stays(t), placed_stays(hospital(**PLACES))), keys)
    empty = carried(state, gone, keys)
    assert empty.count() == 0
    assert Counter(r.OCUPADAS for r in occupancy_of_state(t, empty, START, "2020-01-03").collect()) == {0: 4 * 3}
