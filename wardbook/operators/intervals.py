"""Joins and running totals over validity intervals.

A stay is an interval of instants whose end may be missing. Three questions
come up: which stays hold at one instant, which hold at each instant of a
daily spine, and which stay an event falls into.

None of them needs a range join between two tables. One instant is a filter.
A daily spine is regular, so the first and last spine day of a stay follow by
arithmetic: stays are exploded over just those days, or, for totals, turned
into one +1 and one -1 each. Events meet stays on the key and a slot of time,
which keeps a key with very many events and stays from becoming one group in
which everything is compared with everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardbook.functions.scalars import _col, instant



def _as_date(value) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value.split(" ")[0], "%Y-%m-%d").date()


@dataclass(frozen=True)
class DailySpine:
    """One instant per day, at the same time of day, from ``start`` to ``end`` inclusive."""

    start: date
    end: date
    time: str = "23:59:59"

    @classmethod
    def of(cls, start, end, time: str = "23:59:59") -> DailySpine:
        return cls(_as_date(start), _as_date(end), time)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def _time(self) -> Column:
        return F.expr(f"interval '{self.time}' hour to second")

    def _day_number(self, c: Column) -> Column:
        return F.datediff(c.cast("date"), F.lit(self.start.isoformat()).cast("date"))

    def _on_day(self, c: Column) -> Column:
        return c.cast("date").cast("timestamp_ntz") + self._time()

    def first_from(self, c) -> Column:
        """Number of the first spine instant at or after ``c`` (below 0 or past the end if outside)."""
        c = _col(c)
        return self._day_number(c) + F.when(c > self._on_day(c), 1).otherwise(0)

    def last_until(self, c) -> Column:
        """Number of the last spine instant at or before ``c``."""
        c = _col(c)
        return self._day_number(c) - F.when(c < self._on_day(c), 1).otherwise(0)

    def date(self, k) -> Column:
        return F.date_add(F.lit(self.start.isoformat()).cast("date"), _col(k))

    def instant(self, k) -> Column:
        return self.date(k).cast("timestamp_ntz") + self._time()

    def window(self, df: DataFrame, start, end) -> DataFrame:
        """Keep the intervals that hold at some spine instant.

        Adds ``first_day`` and ``last_day``, the numbers of the first and last
        such instant, and ``origin_day``, the first one before clipping to the
        spine. A missing ``end`` reaches to the end of the spine. The plain
        comparisons in front say nothing new, but reach the scan.
        """
        last_of_spine = self.days - 1
        begins, ends = instant(f"{self.start} {self.time}"), instant(f"{self.end} {self.time}")
        start, end = _col(start), _col(end)
        return (
            df.filter((start <= ends) & (end.isNull() | (end >= begins)))
            .withColumn("origin_day", self.first_from(start))
            .withColumn("first_day", F.greatest(F.lit(0), F.col("origin_day")))
            .withColumn("last_day", F.least(F.lit(last_of_spine), self.last_until(end)))
            .filter(F.col("first_day") <= F.col("last_day"))
        )


@dataclass(frozen=True)
class InstantSpine:
    """Any instants, each once, in ascending order and numbered from 0.

    The rank of an instant among them is looked up, not searched for: its day
    says how many instants lie before that day, and only those of the day
    itself, some tens for an hourly spine, are compared. A join on the day is
    all it takes, with a table of one row per day between the first and the
    last of them.
    """

    instants: tuple[datetime, ...]

    @classmethod
    def of(cls, instants) -> InstantSpine:
        parsed = {datetime.fromisoformat(i) if isinstance(i, str) else i for i in instants}
        if not parsed:
            raise ValueError("a spine needs an instant")
        return cls(tuple(sorted(parsed)))

    @classmethod
    def every(cls, first, last, step: timedelta) -> InstantSpine:
        """Instants from ``first`` on at equal steps, up to ``last``."""
        first, last = (datetime.fromisoformat(i) if isinstance(i, str) else i for i in (first, last))
        return cls.of(first + i * step for i in range((last - first) // step + 1))

    @property
    def days(self) -> int:
        """How many instants there are; ``steps`` and ``spread`` take the spine for days numbered so."""
        return len(self.instants)

    def _days(self, spark: SparkSession) -> DataFrame:
        """Every day from the first instant's to the last one's: its instants and the number before them."""
        first, last = self.instants[0].date(), self.instants[-1].date()
        of_day: dict[date, list[datetime]] = {}
        for i in self.instants:
            of_day.setdefault(i.date(), []).append(i)
        rows, before = [], 0
        for n in range((last - first).days + 1):
            day = first + timedelta(days=n)
            own = of_day.get(day, [])
            rows.append((day, before, own))
            before += len(own)
        return spark.createDataFrame(rows, "_day date, _before int, _own array<timestamp_ntz>")

    def _with_rank(self, df: DataFrame, c: Column, name: str, inclusive: bool) -> DataFrame:
        """Add the number of instants before ``c``, or up to and including it. Instants outside the spine have 0 or all."""
        first, last = (F.lit(i.isoformat(sep=" ")).cast("timestamp_ntz") for i in (self.instants[0], self.instants[-1]))
        held = F.least(F.greatest(c, first), last).cast("date")
        near = F.filter("_own", (lambda x: x <= c) if inclusive else (lambda x: x < c))
        return (
            df.withColumn("_day", held)
            .join(self._days(df.sparkSession), "_day", "left")
            .withColumn(name, F.col("_before") + F.size(near))
            .drop("_day", "_before", "_own")
        )

    def window(self, df: DataFrame, start, end) -> DataFrame:
        """Keep the intervals that hold at some instant, with the numbers of the first and last as ``first_day`` and ``last_day``.

        A missing ``end`` reaches to the end of the spine. The plain
        comparisons in front say nothing new, but reach the scan.
        """
        begins, ends = instant(self.instants[0]), instant(self.instants[-1])
        start, end = _col(start), _col(end)
        held = df.filter((start <= ends) & (end.isNull() | (end >= begins)))
        ranked = self._with_rank(self._with_rank(held, start, "first_day", False), F.coalesce(end, ends), "_upto", True)
        return ranked.withColumn("last_day", F.col("_upto") - 1).drop("_upto").filter(F.col("first_day") <= F.col("last_day"))

    def at(self, df: DataFrame, k: str, name: str) -> DataFrame:
        """Put the instant numbered ``k`` beside each row."""
        named = df.sparkSession.createDataFrame(list(enumerate(self.instants)), f"`{k}` int, `{name}` timestamp_ntz")
        return df.join(named, k)


def active_at_each(df: DataFrame, spine: InstantSpine, start="start", end="end", as_of=None) -> DataFrame:
    """One row per interval and instant of the spine that it contains, both ends included, with the instant as ``at``.

    ``as_of`` closes the intervals that have no end; without it they hold to
    the end of the spine.
    """
    closed = _col(end) if as_of is None else F.coalesce(_col(end), instant(as_of))
    held = spine.window(df, start, closed).withColumn("_k", F.explode(F.sequence("first_day", "last_day")))
    return spine.at(held.drop("first_day", "last_day"), "_k", "at").drop("_k")


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive, as ``day`` and as ``fecha`` text."""
    first, last = (F.lit(_as_date(d).isoformat()).cast("date") for d in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.withColumn("fecha", F.date_format("day", "dd/MM/yyyy"))


def active_at(df: DataFrame, at, start="start", end="end") -> DataFrame:
    """Intervals that contain the instant, both ends included; without an end they still hold."""
    at = instant(at)
    return df.filter((_col(start) <= at) & (_col(end).isNull() | (_col(end) >= at)))


def active_daily(df: DataFrame, spine: DailySpine, start="start", end="end", as_of=None) -> DataFrame:
    """One row per interval and spine instant it contains, with the instant as ``at``.

    ``as_of`` closes the intervals that have no end; without it they hold to
    the end of the spine.
    """
    closed = _col(end) if as_of is None else F.coalesce(_col(end), instant(as_of))
    return (
        spine.window(df, start, closed)
        .withColumn("at", F.explode(F.sequence("first_day", "last_day")))
        .withColumn("at", spine.instant("at"))
        .drop("first_day", "last_day", "origin_day")
    )


def steps(df: DataFrame, spine: DailySpine, keys: list[str], **amounts: Column) -> DataFrame:
    """Turn windowed intervals into changes per day.

    Every amount is added on the interval's first day and taken back on the
    day after its last, so an interval costs two rows however long it lasts.
    The rows are summed per key and day on the map side already.
    """
    named = {name: _col(c) for name, c in amounts.items()}
    into = F.struct(F.col("first_day").alias("k"), *[c.alias(n) for n, c in named.items()])
    out_of = F.struct((F.col("last_day") + 1).alias("k"), *[(-c).alias(n) for n, c in named.items()])
    changes = df.select(*keys, F.explode(F.array(into, out_of)).alias("change")).select(*keys, "change.*")
    return sum_steps(changes.filter(F.col("k") < spine.days), keys, list(amounts))


def sum_steps(changes: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    return changes.groupBy(*keys, "k").agg(*[F.sum(a).alias(a) for a in amounts])


def running(changes: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """Running totals of summed changes.

    A key has at most one row per spine day, so no window partition outgrows the spine.
    """
    upto = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return changes.select(*keys, "k", *[F.sum(a).over(upto).alias(a) for a in amounts])


def spread(totals: DataFrame, spine: DailySpine, keys: list[str]) -> DataFrame:
    """Repeat each running total on every day until the next change."""
    following = F.lead("k", 1, spine.days).over(Window.partitionBy(*keys).orderBy("k"))
    return totals.withColumn("until", following - 1).withColumn(
        "k", F.explode(F.sequence("k", "until"))
    ).drop("until")


def count_daily(df: DataFrame, spine: DailySpine, keys: list[str], name: str, start="start", end="end", as_of=None) -> DataFrame:
    """How many intervals of a key hold at each spine instant, both ends included, as ``name``; no row where none does.

    The same as counting the rows of ``active_daily`` by key and ``at``. But
    what a task sums up are two changes per interval at most, not one entry
    for each key and day it meets, of which there are many more.
    """
    closed = _col(end) if as_of is None else F.coalesce(_col(end), instant(as_of))
    changes = steps(spine.window(df, start, closed), spine, keys, **{name: F.lit(1)})
    totals = spread(running(changes, keys, [name]), spine, keys).filter(F.col(name) > 0)
    return totals.select(spine.instant("k").alias("at"), *keys, name)


def sorted_by_day(df: DataFrame, spine: DailySpine, *columns: str) -> DataFrame:
    """Sort by the spine day ``k`` and then by ``columns``, NULLs last.

    The days are known beforehand, so each partition takes an equal run of
    them: no sampling pass over the rows, as a sort by range would need.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(wanted, spine.days)
    run = F.floor(F.col("k") * parts / spine.days).cast("int")
    return df.repartitionById(parts, run).sortWithinPartitions(
        "k", *[df[c].asc_nulls_last() for c in columns]
    )


def bucket(c, days: int) -> Column:
    """Number of the ``days`` long stretch of the calendar that an instant falls into."""
    return F.floor(F.unix_date(_col(c).cast("date")) / F.lit(days)).cast("int")


# Stretches in which time within this many of ``as_of`` is cut; beyond, an octave (twice as far back) has half as many.
_NEAR = 64


def slot(c, as_of, days: int) -> Column:
    """Number of the stretch of time, counted back from ``as_of``, that an instant falls into.

    The last ``_NEAR`` stretches are ``days`` long each. Further back a
    stretch doubles its length with each doubling of the distance, so all of
    time since the year 1 is some hundreds of them. What lies after ``as_of``
    is one. Later instants never have higher numbers.
    """
    back = F.greatest(F.lit(0), bucket(instant(as_of), days) + 1 - bucket(c, days))
    octave = F.length(F.bin(back.cast("bigint"))) - F.length(F.bin(F.lit(_NEAR).cast("bigint")))
    half = _NEAR // 2
    far = F.lit(half) + octave * half + F.call_function("shiftright", back, octave + 1)
    return F.when(back < _NEAR, back).otherwise(far).cast("int")


def attribute_events(
    events: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    as_of,
    how: str = "inner",
    bucket_days: int = 7,
) -> DataFrame:
    """Pair each event with the intervals of its key that it falls into, start <= event < end.

    Intervals without an end run to ``as_of``. An event in two overlapping
    intervals comes out twice; ``how="left"`` keeps events in none.

    An event lies in exactly one slot of time and an interval is repeated for
    each slot it touches, so the pairs are the same as without slots. The key
    and slot together spread a key that holds a large share of the rows, and
    only intervals near an event in time are looked at. Slots grow with their
    distance from ``as_of`` (see ``slot``): a stay of some days is one or two
    rows, one from a made-up start in 1900 until 9999 below three hundred, and events,
    which are many more, are never repeated.
    """
    own = [c for c in intervals.columns if c != key]
    spans = (
        intervals.filter(F.col(key).isNotNull())
        .withColumn("_until", F.coalesce(F.col(end), instant(as_of)))
        .filter(F.col(start) < F.col("_until"))
        .withColumn("_bucket", F.explode(F.sequence(slot("_until", as_of, bucket_days), slot(start, as_of, bucket_days))))
        .withColumnRenamed(key, "_key")
    )
    marked = events.withColumn("_bucket", slot(at, as_of, bucket_days))
    near = (
        (marked[key] == spans["_key"])
        & (marked["_bucket"] == spans["_bucket"])
        & (marked[at] >= spans[start])
        & (marked[at] < spans["_until"])
    )
    joined = marked.join(spans, near, how)
    return joined.select(*events.columns, *[spans[c] for c in own])
