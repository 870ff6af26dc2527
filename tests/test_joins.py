from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardbook.operators import joins
from wardbook.operators.joins import fan_out_left, having, latest_version, repeat_rows, weighted, with_partner_count
from wardbook.operators.sets import ordered, union_all, union_distinct
from wardbook.sources.staging import staged


def test_repeat_rows(frame):
    rows = frame([(1, 3), (2, 0), (3, None), (4, 1), (5, 10001)], "x int, n int")
    assert Counter(r.x for r in repeat_rows(rows, "n").collect()) == Counter({1: 3, 2: 1, 3: 1, 4: 1, 5: 10001})


@pytest.mark.parametrize("n", [joins._CHUNK - 1, joins._CHUNK, joins._CHUNK + 1, 2 * joins._CHUNK])
def test_repeat_rows_around_a_chunk(frame, n):
    assert repeat_rows(frame([(1, n)], "x int, n int"), "n").count() == n


@pytest.mark.parametrize("rows", [[(1, 1_000_000)], [(1, 600_000), (2, 300_000), *[(i, 1) for i in range(3, 900)]]])
def test_copies_of_one_row_are_dealt_over_the_tasks(spark, frame, rows):
    tasks = repeat_rows(frame(rows, "x int, n int").coalesce(1), "n").groupBy(F.spark_partition_id().alias("p")).count().collect()
    made, parts = sum(r["count"] for r in tasks), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made == sum(n for _, n in rows)
    assert max(r["count"] for r in tasks) < 1.2 * made / parts


def test_fan_out_left_repeats_like_a_join(frame):
    rows = frame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, x string")
    partners = frame([(2,), (2,), (2,), (9,), (None,)], "k int")
    want = Counter(map(tuple, rows.join(partners, "k", "left").collect()))
    assert Counter(map(tuple, fan_out_left(rows, partners, "k").collect())) == want


def test_weighted_counts_like_a_join(frame):
    rows = frame([(1, 2), (2, 5), (3, 7), (None, 1)], "k int, n int")
    partners = frame([(1,), (1,), (3,), (4,), (None,)], "k int")
    assert {r.k: int(r.n) for r in weighted(rows, partners, "k", "n").collect()} == {1: 4, 3: 7}


def test_weighted_survives_a_key_with_very_many_rows_on_both_sides(spark):
    rows = spark.range(3_000_000).select((F.col("id") % 3).alias("k"))
    left = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert {int(r.n) for r in weighted(left, rows, "k", "n").collect()} == {10**12}


def test_latest_version_takes_a_missing_value_too(frame):
    rows = frame([(1, 7, "1.00"), (5, 7, None), (3, 7, "3.00"), (2, 8, "2.00")], "oid int, parent int, value dec")
    got = {r.parent: (r.oid, r.value) for r in latest_version(rows, "parent").collect()}
    assert got[7] == (5, None) and got[8][0] == 2


def test_having_does_not_multiply(frame):
    rows = frame([(1,), (2,), (None,)], "parent int")
    parents = frame([(1,), (1,), (None,)], "oid int")
    assert [r.parent for r in having(rows, parents, "parent").collect()] == [1]


def test_partners_are_counted_without_multiplying(frame):
    rows = frame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, x string")
    partners = frame([(2,), (2,), (None,)], "k int")
    got = {r.x: r.n for r in with_partner_count(rows, partners, "k", "n").collect()}
    assert got == {"a": None, "b": 2, "c": None, "d": 2}


def test_staged_keeps_rows_and_types(frame):
    rows = frame([(1, "2020-01-01 00:00:00.123456", "1.50"), (None, None, None)], "a int, b timestamp_ntz, c dec")
    again = staged(rows)
    assert again.dtypes == rows.dtypes and Counter(again.collect()) == Counter(rows.collect())
    assert staged(rows.filter("a = 5")).count() == 0


def test_unions(frame):
    a, b = frame([(1, "x"), (1, "x")], "n int, s string"), frame([(1, "x"), (2, "y")], "m int, t string")
    assert Counter(map(tuple, union_distinct(a, b).collect())) == Counter([(1, "x"), (2, "y")])
    both = union_all(a, b)
    assert both.columns == ["n", "s", "m", "t"] and both.count() == 4


def test_order(frame):
    rows = frame([(None, "a"), (2, "b"), (1, None), (1, "a")], "n int, s string")
    assert [tuple(r) for r in ordered(rows, "n", "s").collect()] == [(1, "a"), (1, None), (2, "b"), (None, "a")]
