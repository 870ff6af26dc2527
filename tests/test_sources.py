import re
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wardbook.sources import publish as sources_publish
from wardbook.sources.publish import audit_run, publish, published, sweep
from wardbook.sources.schemas import GROWING, TABLES, schema
from wardbook.sources.staging import shared_folder
from wardbook.sources.tables import FileSource, HospitalTables, JdbcSource, Split, load, open_tables, pick


def test_every_table_has_a_schema():
    for name in TABLES:
        assert len(schema(name)) == len(TABLES[name].split(","))


def test_load_brings_types_in_line(spark, tmp_path):
    raw = spark.range(3).select(
        F.col("id").cast("int").alias("OID"),
        F.lit("01").alias("ACACODIGO"),
        F.lit("01 - A").alias("ACANOMBRE"),
        F.lit(1).alias("OTHER"),
    )
    raw.write.parquet(f"{tmp_path}/adncenate.parquet")
    got = open_tables(spark, str(tmp_path))["adncenate"]
    assert got.dtypes == [("oid", "bigint"), ("acacodigo", "string"), ("acanombre", "string")]
    assert got.count() == 3


def test_load_csv(spark, tmp_path):
    (tmp_path / "hcntiphis").mkdir()
    (tmp_path / "hcntiphis" / "part.csv").write_text("oid\n3\n4\n")
    source = FileSource(str(tmp_path), "csv", {"header": "true"})
    assert {r.oid for r in load(spark, "hcntiphis", source).collect()} == {3, 4}


WITHOUT_KEY = {"hpnestanc", "adndiaegr", "innmsumpa", "crnradfacd", "crnmtrasl", "cmnconsul", "hcnrefer", "hcniyaevts"}


def test_jdbc_read_is_split_where_bounds_are_known():
    source = JdbcSource({"url": "jdbc:x", "user": "u"}, {"slnserpro": (1, 9000)}, partitions=8)
    options = source.read_options("slnserpro")
    assert options["partitionColumn"] == "OID" and options["numPartitions"] == "8" and options["upperBound"] == "9000"
    assert "partitionColumn" not in source.read_options("adncenate")


@pytest.mark.parametrize("name", sorted(TABLES))
def test_jdbc_options_of_every_table(name):
    fields = {f.name: f.dataType.simpleString() for f in schema(name)}
    assert ("oid" not in fields) == (name in WITHOUT_KEY)
    source = JdbcSource({"url": "jdbc:x"}, {name: (5, 5_000)})
    if name not in GROWING:
        options = JdbcSource({"url": "jdbc:x"}).read_options(name)
        assert "partitionColumn" not in options
        if name in WITHOUT_KEY:
            with pytest.raises(ValueError, match="no column"):
                source.read_options(name)
    else:
        with pytest.raises(ValueError, match="grows"):
            JdbcSource({"url": "jdbc:x"}).read_options(name)
        assert "partitionColumn" not in JdbcSource({"url": "jdbc:x"}, whole=(name,)).read_options(name)
        options = source.read_options(name)
        column = GROWING[name]
        assert column in fields and fields[column] in ("bigint", "timestamp_ntz")
        assert options["partitionColumn"] == (column.upper() if column.islower() else f'"{column}"')
        assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("5", "5000", "64")
    # Types are asked of the connector as declared, so no cast stands between a filter and the database.
    declared = dict(part.replace("`", "").split(" ", 1) for part in re.split(r", (?=`)", options["customSchema"]))
    assert declared == fields
    assert options["dbtable"] == name and options["preferTimestampNTZ"] == "true"


def test_jdbc_reads_follow_the_number_of_rows():
    def reads(rows):
        source = JdbcSource({}, {"adndiaegr": Split((1, 10**9), rows)}, partitions=40, rows_per_read=1000)
        return source.read_options("adndiaegr")["numPartitions"]

    assert [reads(n) for n in (0, 1, 1000, 1001, 20_000, 10**9)] == ["1", "1", "1", "2", "20", "40"]


def test_jdbc_cut_points_cover_every_row_once(spark):
    split = Split(("2020-01-01 00:00:00", "2021-01-01 00:00:00", "2021-06-01 00:00:00", "2022-01-01 00:00:00", "2023-01-01 00:00:00"))
    source = JdbcSource({"url": "jdbc:x"}, {"hpnestanc": split})
    conditions = source.predicates("hpnestanc")
    assert len(conditions) == 4 and "partitionColumn" not in source.read_options("hpnestanc")
    stays = ["1999-01-01 00:00:00", *split.points, "2021-03-03 03:03:03", "2050-01-01 00:00:00", None]
    rows = spark.createDataFrame([(x,) for x in stays], "x string").selectExpr("cast(x as timestamp_ntz) HESFECING")
    hits = rows.select(sum(F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions).alias("n"))
    assert [r.n for r in hits.collect()] == [1] * len(stays)
    numbers = JdbcSource({}, {"slnserpro": Split((1, 10, 20))}).predicates("slnserpro")
    assert numbers == ["OID < 10 OR OID IS NULL", "OID >= 10"]
    assert JdbcSource({}, {"hcniyaevts": Split((1, 10, 20))}).predicates("hcniyaevts")[1] == '"InsidentesAccidentes" >= 10'


@pytest.mark.parametrize("points", [(), (1,), (2, 1), (1, 1), (None, 5)])
def test_jdbc_points_have_to_rise(points):
    with pytest.raises((ValueError, TypeError)):
        Split(points)


def test_jdbc_options_reach_the_reader(spark, tmp_path):
    """A reader that only notes what it is asked for."""
    noted = {}

    def empty(name):
        spark.createDataFrame([], schema(name)).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    class Reader:
        def format(self, name):
            noted["format"] = name
            return self

        def options(self, **options):
            noted["options"] = options
            return self

        def load(self):
            return empty("slnserpro")

        def jdbc(self, url, table, predicates, properties):
            noted.update(url=url, table=table, predicates=predicates, options=properties)
            return empty(table)

    session = SimpleNamespace(read=Reader())
    source = JdbcSource({"url": "jdbc:x", "user": "u"}, {"slnserpro": (1, 9), "hcnrefer": Split((1, 5, 9))})
    df = load(session, "slnserpro", source)
    assert noted["format"] == "jdbc" and noted["options"] == source.read_options("slnserpro")
    # Types are already those declared: nothing is cast after the read.
    assert df.schema == schema("slnserpro") and "cast" not in df._jdf.queryExecution().optimizedPlan().toString()
    load(session, "hcnrefer", source)
    assert (noted["url"], noted["table"], noted["predicates"]) == ("jdbc:x", "hcnrefer", source.predicates("hcnrefer"))
    assert "dbtable" not in noted["options"] and noted["options"]["customSchema"] == "`hcnfolio` bigint"


def test_tables_are_read_once():
    read = []
    tables = HospitalTables(lambda n: read.append(n) or n, ("a", "b"))
    assert (tables["a"], tables["a"], len(tables), read) == ("a", "a", 2, ["a"])
    with pytest.raises(KeyError):
        tables["c"]


def report(frame, day, n):
    return frame([(day, i, "x" if i else None, f"{day} 10:00:00.000001") for i in range(n)],
                 "fecha string, i int, s string, t timestamp_ntz")


def read_back(spark, path, df, partition=None):
    return Counter(map(tuple, published(spark, path, schema=df.schema, partition=partition).select(df.columns).collect()))


def test_snapshot_replaces(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    publish(report(frame, "2024-01-01", 5), path)
    last = report(frame, "2024-01-02", 2)
    publish(last, path)
    assert read_back(spark, path, last) == Counter(map(tuple, last.collect()))


def test_a_rerun_of_a_day_leaves_one_run(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    first, second = report(frame, "2024-01-01", 3), report(frame, "2024-01-02", 2)
    for df in (first, second, first, second):
        publish(df, path, mode="append", partition="fecha")
    assert read_back(spark, path, first, "fecha") == Counter(map(tuple, first.union(second).collect()))


def test_a_covered_day_without_rows_is_emptied(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    days = ["2024-01-01", "2024-01-02", "03/01/2024 07:00"]
    first, second, third = (report(frame, "2024-01-01", 2).withColumn("fecha", F.lit(day)) for day in days)
    publish(first.union(second).union(third), path, mode="append", partition="fecha")
    publish(second.limit(0), path, mode="append", partition="fecha", covers=days[1:])
    assert read_back(spark, path, first, "fecha") == Counter(map(tuple, first.collect()))
    publish(second, path, mode="append", partition="fecha", covers=["2024-01-02", "2024-01-09"])
    assert read_back(spark, path, first, "fecha") == Counter(map(tuple, first.union(second).collect()))


def test_a_day_is_written_in_order(spark, frame, tmp_path):
    rows = [("2024-01-0" + str(1 + i % 2), (i * 7) % 50 if i else None, "x") for i in range(50)]
    path = f"{tmp_path}/out"
    publish(frame(rows, "fecha string, i int, s string").repartition(3), path, mode="append", partition="fecha", order=("i",))
    for day in ("2024-01-01", "2024-01-02"):
        files = list(Path(f"{path}/rows").glob(f"run=*/fecha={day}/part-*"))
        assert len(files) == 1
        values = [line.split(",")[0].strip('"') for line in files[0].read_text().split("\n")[1:-1]]
        numbers = [int(v) for v in values if v]
        assert numbers == sorted(numbers) and len(values) == 25 and "" not in values[:24]


def test_plain_append_adds(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    df = report(frame, "2024-01-01", 2)
    publish(df, path, mode="append")
    publish(df, path, mode="append")
    assert sum(read_back(spark, path, df).values()) == 4


def test_header_carries_the_column_names(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    publish(report(frame, "2024-01-01", 1), path)
    assert published(spark, path).columns == ["fecha", "i", "s", "t"]


def test_a_run_that_breaks_off_before_the_switch_changes_nothing(spark, frame, tmp_path, monkeypatch):
    path = f"{tmp_path}/out"
    days = [report(frame, f"2024-01-0{i}", i) for i in (1, 2, 3)]
    publish(days[0].union(days[1]), path, mode="append", partition="fecha")
    before = read_back(spark, path, days[0], "fecha")
    during = []

    def broken(*_):
        # The new rows are all there, and no reader sees them.
        assert len(list(Path(f"{path}/rows").glob("run=*"))) == 2
        during.append(read_back(spark, path, days[0], "fecha"))
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(sources_publish, "_switch", broken)
        with pytest.raises(OSError):
            publish(report(frame, "2024-01-01", 9), path, mode="append", partition="fecha", covers=["2024-01-02"])
    assert during == [before] == [read_back(spark, path, days[0], "fecha")]
    # Repeated, the run replaces the one day and empties the other in one step.
    publish(report(frame, "2024-01-01", 9), path, mode="append", partition="fecha", covers=["2024-01-02"])
    assert read_back(spark, path, days[0], "fecha") == Counter(map(tuple, report(frame, "2024-01-01", 9).collect()))
    publish(days[2], path)
    with monkeypatch.context() as m:
        m.setattr(sources_publish, "_switch", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            publish(days[0], path)
    assert read_back(spark, path, days[2]) == Counter(map(tuple, days[2].collect()))


def test_a_frame_that_was_built_keeps_its_version(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    first, second = report(frame, "2024-01-01", 3), report(frame, "2024-01-01", 2)
    publish(first, path, mode="append", partition="fecha")
    held = published(spark, path, schema=first.schema, partition="fecha")
    publish(second, path, mode="append", partition="fecha")
    sweep(spark, path)
    assert held.count() == 3 and published(spark, path, partition="fecha").count() == 2


def test_sweeping_empties_only_what_two_versions_no_longer_name(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    swept = []
    for n in (1, 2, 3, 4):
        publish(report(frame, "2024-01-01", n), path)
        swept += sweep(spark, path)
    assert len(swept) == 2 and published(spark, path).count() == 4
    kept = {f.parent.name for f in Path(f"{path}/rows").glob("run=*/part-*.csv")}
    assert len(kept) == 2 and not {f"run={r}" for r in swept} & kept


def test_days_are_texts_and_may_be_missing(spark, frame, tmp_path):
    path = f"{tmp_path}/out"
    rows = frame([("007", 1), (None, 2), ("1e5", 3), ("2024-01-01", 4)], "fecha string, i int")
    outcome = publish(rows, path, mode="append", partition="fecha")
    assert (outcome.rows, len(outcome.days)) == (4, 4) and outcome.seconds > 0
    assert {(r.fecha, r.i) for r in published(spark, path, partition="fecha").collect()} == {("007", "1"), (None, "2"), ("1e5", "3"), ("2024-01-01", "4")}
    publish(rows.filter("fecha is null").withColumn("i", F.lit(9)), path, mode="append", partition="fecha")
    assert {(r.fecha, r.i) for r in published(spark, path, partition="fecha").collect()} == {("007", "1"), (None, "9"), ("1e5", "3"), ("2024-01-01", "4")}
    with pytest.raises(ValueError, match="by day"):
        published(spark, path)
    with pytest.raises(ValueError, match="kept by day or not"):
        publish(rows, path, mode="append")
    publish(rows.limit(0), path, mode="append", partition="fecha", covers=outcome.days)
    assert published(spark, path, schema=rows.schema, partition="fecha").count() == 0
    with pytest.raises(ValueError, match="nothing"):
        published(spark, f"{path}/elsewhere")


def test_run_log_grows(spark, tmp_path):
    path = f"{tmp_path}/log"
    audit_run(spark, "ocupacion", "2024-01-05 07:00:30", path)
    audit_run(spark, "ventas", "2024-1-5 3:00:00", path)
    rows = spark.read.option("header", True).csv(path).collect()
    assert {(r.job, r.run_time) for r in rows} == {("ocupacion", "05/01/2024 07:00"), ("ventas", "05/01/2024 03:00")}


def session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_one_the_cluster_names():
    named = {"spark.checkpoint.dir": "s3://shared/x/"}
    assert shared_folder(session("yarn", **named)).startswith("s3://shared/x/wardbook-")
    assert shared_folder(session("local[4]")) != shared_folder(session("local[4]"))
    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077"))


def test_pick(frame):
    assert pick(frame([(1, "a")], "oid int, x string"), key="oid", y=F.upper("x")).first().asDict() == {"key": 1, "y": "A"}
