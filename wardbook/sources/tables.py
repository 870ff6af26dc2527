"""Reading the hospital tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import GROWING, TABLES, schema


@dataclass(frozen=True)
class FileSource:
    """One folder or file per table under ``path``."""

    path: str
    format: str = "parquet"
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: by ranges of one column.

    ``points`` are the lowest and highest value, for as many equal ranges as
    the table's ``rows`` ask for, or all the points at which to cut, for values that
    are spread unevenly. Numbers, or instants as ``2024-01-31 00:00:00``.
    ``column`` is the table's own split column unless given.
    """

    points: tuple
    rows: int | None = None
    column: str | None = None

    def __post_init__(self):
        if len(self.points) < 2 or any(a is None for a in self.points) or list(self.points) != sorted(set(self.points)):
            raise ValueError("a split needs two or more rising points")


def _sql(value) -> str:
    return f"TIMESTAMP '{value}'" if isinstance(value, str) else str(value)


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database.

    ``options`` go to the connector as they are (url, user, driver, ...).
    ``bounds`` names, per table, its lowest and highest key, or a ``Split``.
    A table that grows with time and has no bounds is refused, as it would be
    read by one connection into one task, unless it is named in ``whole``.
    A read has one query for each ``rows_per_read`` rows where their number is
    known, and no more than ``partitions``, which is what the database bears.
    """

    options: dict
    bounds: dict = field(default_factory=dict)
    partitions: int = 64
    rows_per_read: int = 1_000_000
    whole: tuple[str, ...] = ()

    def split(self, name: str) -> Split | None:
        given = self.bounds.get(name)
        if given is None:
            if name in GROWING and name not in self.whole:
                raise ValueError(f"{name} grows with time: give its bounds, or name it in `whole`")
            return None
        split = given if isinstance(given, Split) else Split(tuple(given))
        column = split.column or GROWING.get(name) or "oid"
        if column not in schema(name).names:
            raise ValueError(f"{name} has no column {column} to be split by")
        return replace(split, column=column)

    def read_options(self, name: str) -> dict:
        """Options of one read. The declared types go with them, so that filters reach the database without a cast."""
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema(name))
        options = {
            "preferTimestampNTZ": "true", "fetchsize": "10000", **self.options, "dbtable": name, "customSchema": types,
        }
        split = self.split(name)
        if split is not None and len(split.points) == 2:
            reads = self.partitions if split.rows is None else max(1, min(self.partitions, -(-split.rows // self.rows_per_read)))
            options |= {
                "partitionColumn": self.written(split.column),
                "lowerBound": str(split.points[0]),
                "upperBound": str(split.points[1]),
                "numPartitions": str(reads),
            }
        return options

    def written(self, column: str) -> str:
        """A column as the database has it: upper case, or quoted if its name is mixed."""
        return column.upper() if column.islower() else f'"{column}"'

    def predicates(self, name: str) -> list[str] | None:
        """One condition per query where cut points are given. Together they hold for each row once, also without a value."""
        split = self.split(name)
        if split is None or len(split.points) == 2:
            return None
        column, inner = self.written(split.column), [_sql(x) for x in split.points[1:-1]]
        between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(inner, inner[1:], strict=False)]
        return [f"{column} < {inner[0]} OR {column} IS NULL", *between, f"{column} >= {inner[-1]}"]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        options, predicates = self.read_options(name), self.predicates(name)
        if predicates is None:
            return spark.read.format("jdbc").options(**options).load()
        url = options.pop("url")
        table = options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Bring a table to its declared columns and types; a cast that changes nothing leaves no trace."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema(name)])


def load(spark: SparkSession, name: str, source: str | FileSource | JdbcSource) -> DataFrame:
    """Read one source table, lazily, with its declared column types."""
    if isinstance(source, str):
        source = FileSource(source)
    if isinstance(source, JdbcSource):
        raw = source.read(spark, name)
    else:
        reader = spark.read.format(source.format).options(**source.options)
        if source.format == "csv":
            reader = reader.schema(schema(name))
        suffix = ".parquet" if source.format == "parquet" else ""
        raw = reader.load(f"{source.path.rstrip('/')}/{name}{suffix}")
    return conform(raw, name)


class HospitalTables(Mapping):
    """The source tables by name, each read when first asked for."""

    def __init__(self, opener, names=tuple(TABLES)):
        self._opener, self._names, self._open = opener, tuple(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self._opener(name)
        return self._open[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


def open_tables(spark: SparkSession, source) -> HospitalTables:
    return HospitalTables(lambda name: load(spark, name, source))


def pick(df: DataFrame, **columns) -> DataFrame:
    """Select columns under new names: ``pick(beds, bed="oid", site="adncenate")``."""
    return df.select(
        [(c if isinstance(c, Column) else F.col(c)).alias(name) for name, c in columns.items()]
    )
