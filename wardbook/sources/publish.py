"""Writing reports and the run log, and reading what is published.

A publication is a folder with two tables. ``rows/run=<id>`` holds what one
run wrote and never changes after it. ``manifest`` says which runs, or which
days of which runs, are the report now; each change adds one file with the
whole new list under the next version. A run first writes its rows and then
that one file, so readers see the report before it or after it and nothing in
between, and a run that breaks off has changed nothing. Both steps are plain
Spark writes, on any storage and from any kind of session.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardbook.functions.scalars import instant, stamp_text

_MANIFEST = "version long, run string, day string"
# What the writer calls the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Outcome:
    """What a run wrote, as observed by the write itself."""

    run: str
    rows: int
    days: tuple[str, ...]
    seconds: float


def _entries(spark: SparkSession, path: str) -> list[tuple[int, set[tuple[str, str | None]]]]:
    """Versions of a publication with their (run, day) entries, newest first. A day of None stands for a whole run."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path}/manifest").collect()  # one row per live day and version
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    versions: dict[int, set[tuple[str, str | None]]] = {}
    for r in rows:
        own = versions.setdefault(r["version"], set())
        if r["run"] is not None:
            own.add((r["run"], r["day"]))
    return sorted(versions.items(), key=lambda v: v[0], reverse=True)


def _switch(spark: SparkSession, path: str, version: int, entries: set[tuple[str, str | None]]) -> None:
    """Make ``entries`` the report, by one file. Without any entry the report is empty."""
    listed = sorted(entries, key=lambda e: (e[0], e[1] or "")) or [(None, None)]
    rows = spark.createDataFrame([(version, *e) for e in listed], _MANIFEST)
    rows.coalesce(1).write.mode("append").json(f"{path}/manifest")


def publish(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition: str | None = None,
    format: str = "csv",
    order: tuple[str, ...] = (),
    covers: Iterable[str] = (),
) -> Outcome:
    """Write a report and make it the published one in one step; ``published`` reads it.

    ``overwrite`` replaces the whole snapshot. ``append`` with ``partition``
    adds the report's days and replaces days already present, so a rerun
    leaves the same rows as one run. Days that the report ``covers`` without
    having rows for them lose the rows of earlier runs. ``append`` without
    ``partition`` only adds rows. A day's rows lie in its files sorted by
    ``order``, NULLs last. One run at a time publishes to a folder.
    """
    spark, path, began = df.sparkSession, path.rstrip("/"), time.monotonic()
    if partition is not None:
        # One folder per day: gather each day's rows first, and let AQE split a day that is too large.
        df = df.hint("rebalance", partition).sortWithinPartitions(
            F.col(f"`{partition}`"), *[F.col(f"`{c}`").asc_nulls_last() for c in order]
        )
    if format == "csv":
        # The writer's own time pattern would drop what is finer than milliseconds.
        df = df.select([F.col(f"`{n}`").cast("string").alias(n) if t.startswith("timestamp") else F.col(f"`{n}`") for n, t in df.dtypes])
    # Told by the write itself: no second run of the report.
    written, told_of = Observation(), [F.count(F.lit(1)).alias("rows")]
    if partition is not None:
        told_of.append(F.collect_set(F.coalesce(F.col(f"`{partition}`").cast("string"), F.lit(_NO_DAY))).alias("days"))
    df = df.observe(written, *told_of)
    # A letter in front, so that no run is taken for a number.
    run = f"r{uuid.uuid4().hex}"
    writer = df.write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.save(f"{path}/rows/run={run}")
    told = written.get
    own = tuple(sorted(told["days"])) if partition is not None else ()

    versions = _entries(spark, path)
    version, live = versions[0] if versions else (0, set())
    if mode == "append" and live and (partition is None) != any(day is None for _, day in live):
        raise ValueError("a report is kept by day or not; overwrite it to change that")
    if mode == "overwrite":
        live = {(run, None)}
    elif partition is None:
        live = live | {(run, None)}
    else:
        gone = set(own) | set(covers)
        live = {e for e in live if e[1] not in gone} | {(run, day) for day in own}
    _switch(spark, path, version + 1, live)
    return Outcome(run, told["rows"], own, time.monotonic() - began)


def published(
    spark: SparkSession, path: str, format: str = "csv", schema: StructType | str | None = None, partition: str | None = None
) -> DataFrame:
    """The report as last published. ``partition`` names the column of its days, if it is kept by day.

    Without ``schema`` a CSV report comes as text. The files read are those
    of the version found when the frame is built, whatever is published
    later, as long as they are not swept.
    """
    path = path.rstrip("/")
    versions = _entries(spark, path)
    if not versions:
        raise ValueError(f"nothing is published under {path}")
    live = versions[0][1]
    runs = sorted({run for run, _ in live})
    dated = [f"{run} {day}" for run, day in live if day is not None]
    if dated and partition is None:
        raise ValueError("this report is kept by day: name the column of its days")
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not runs:
        return spark.createDataFrame([], fields or StructType([]))
    # Files of other runs are not even listed.
    reader, folders = spark.read.format(format).option("basePath", f"{path}/rows"), [f"{path}/rows/run={run}" for run in runs]
    if format == "csv":
        reader = reader.option("header", True)
    if fields is None:
        # Folder names are texts as they stand, not numbers or dates.
        found = [StructField(f.name, StringType()) if f.name == partition else f for f in reader.load(folders).schema]
        fields = StructType([f for f in found if f.name != "run"])
    rows = reader.schema(StructType(fields.fields + [StructField("run", StringType())])).load(folders)
    if dated:
        day = F.coalesce(F.col(f"`{partition}`").cast("string"), F.lit(_NO_DAY))
        rows = rows.filter(F.concat_ws(" ", "run", day).isin(dated))
    return rows.drop("run")


def sweep(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Empty the runs that none of the newest ``keep`` versions names; returns them.

    Readers that started before the newest version may still be at the files
    of the one before, which is why two are kept.
    """
    path = path.rstrip("/")
    versions = _entries(spark, path)
    live = {run for _, entries in versions[:keep] for run, _ in entries}
    # Runs that broke off before they were listed are not looked for here.
    dead = sorted({run for _, entries in versions[keep : keep + 1] for run, _ in entries} - live)
    for run in dead:
        spark.createDataFrame([], "none string").write.mode("overwrite").text(f"{path}/rows/run={run}")
    return dead


def audit(runs: DataFrame, path: str | None = None) -> DataFrame:
    """Run log: job name and time text of each run in ``runs(job, run_ts)``, appended to ``path`` if given.

    A column ``as_of``, the instant a report was asked for, and what is known
    of the outcome (``result``, ``rows``, ``days``, ``seconds``) go with them.
    """
    more = [stamp_text("as_of", "dd/MM/yyyy HH:mm:ss").alias("as_of")] if "as_of" in runs.columns else []
    more += [F.col(c) for c in ("result", "rows", "days", "seconds") if c in runs.columns]
    log = runs.select("job", stamp_text("run_ts", "dd/MM/yyyy HH:mm").alias("run_time"), *more)
    if path is not None:
        log.write.mode("append").option("header", True).csv(path)
    return log


def audit_run(
    spark: SparkSession, job: str, run_ts, path: str | None = None, as_of=None, outcome: Outcome | Exception | None = None
) -> DataFrame:
    """Log one run, with the instant that it was asked for and its outcome if given.

    The outcome is what the run wrote or the error that it ended with, whose
    message is cut to its first line.
    """
    runs = spark.range(1).select(F.lit(job).alias("job"), instant(run_ts).alias("run_ts"))
    if as_of is not None:
        runs = runs.withColumn("as_of", instant(as_of))
    if outcome is not None:
        failed = isinstance(outcome, Exception)
        result = f"failed: {type(outcome).__name__}: {str(outcome).strip().splitlines()[0] if str(outcome).strip() else ''}" if failed else "ok"
        known = (None, None, None) if failed else (outcome.rows, " ".join(outcome.days), round(outcome.seconds, 3))
        columns = zip(("rows", "days", "seconds"), ("long", "string", "double"), known, strict=True)
        runs = runs.withColumn("result", F.lit(result[:500])).select("*", *[F.lit(v).cast(t).alias(n) for n, t, v in columns])
    return audit(runs, path)
