"""Stays per day and bed over the whole spine: range join, exploded days, and running totals, timed side by side.

    python tools/spine_forms.py [given tables]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from checks.case import Context  # noqa: E402
from checks.samples import ORDERS_AS_OF, ORDERS_START  # noqa: E402
from tools.compare import session  # noqa: E402
from wardbook.functions.scalars import instant  # noqa: E402
from wardbook.operators.intervals import DailySpine, active_daily, date_spine, running, spread, steps  # noqa: E402
from wardbook.plans.common import stays  # noqa: E402

spark = session()
c = Context(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
spine = DailySpine.of(ORDERS_START, ORDERS_AS_OF, "07:00:00")


def range_join():
    days = date_spine(spark, spine.start, spine.end).withColumn(
        "at", F.col("day").cast("timestamp_ntz") + F.expr("interval 7 hours")
    )
    until = F.coalesce(F.col("end"), instant(ORDERS_AS_OF))
    joined = stays(c.t).join(F.broadcast(days), F.col("at").between(F.col("start"), until))
    return joined.groupBy("at", "bed").agg(F.count("*").alias("n"))


def exploded():
    return active_daily(stays(c.t), spine, as_of=ORDERS_AS_OF).groupBy("at", "bed").agg(F.count("*").alias("n"))


def totals():
    held = spine.window(stays(c.t), "start", F.coalesce("end", instant(ORDERS_AS_OF)))
    daily = spread(running(steps(held, spine, ["bed"], n=F.lit(1)), ["bed"], ["n"]), spine, ["bed"])
    return daily.filter("n > 0").select(spine.instant("k").alias("at"), "bed", "n")


for form in (exploded, totals, range_join, exploded, totals):
    began = time.time()
    rows, stays_ = form().agg(F.count("*"), F.sum("n")).first()
    print(f"{form.__name__:11} {time.time() - began:6.1f} s, {rows} rows, {stays_} stays", flush=True)
