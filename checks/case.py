"""How a check is stated: a Spark query over the sample tables and, where there is one, its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wardbook.sources.tables import HospitalTables

from .samples import SAMPLES, given, sample_sql, sample_tables


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def t(self) -> HospitalTables:
        return sample_tables(self.spark, self.sf_dir)

    def given(self, name: str) -> DataFrame:
        return given(self.spark, self.sf_dir, name)


@dataclass(frozen=True)
class Check:
    build: Callable[[Context], DataFrame]
    sql: str | None = None

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Context(spark, sf_dir))


def oracle(sql: str, **extra: str) -> str:
    """Put the sample tables that ``sql`` reads in front of it; ``extra`` are further named queries."""
    body = ", ".join(f"{name} as ({text})" for name, text in extra.items())
    read = set(re.findall(r"(?:from|join)\s+(\w+)", f"{body} {sql}", re.IGNORECASE))
    samples = ", ".join(f"{name} as ({sample_sql(name)})" for name in SAMPLES if name in read)
    both = ", ".join(part for part in (samples, body) if part)
    return f"with {both} {sql}" if both else sql


def case_of(value: str, labels: dict, default: str = "null") -> str:
    """SQL text of a code's label."""
    def quoted(code):
        return f"'{code}'" if isinstance(code, str) else str(code)

    whens = " ".join(f"when {value} = {quoted(code)} then '{label}'" for code, label in labels.items())
    return f"case {whens} else {default} end"


def short(name: str) -> str:
    """SQL text of a site's short name."""
    return f"substr({name}, strpos({name}, '-') - length({name}) + 1)"


def dmy(value: str) -> str:
    return f"strftime({value}, '%d/%m/%Y')"


def days(start: str, end: str) -> str:
    """SQL text of the rounded days between two instants."""
    return f"cast(round((epoch_us({end}) - epoch_us({start})) / 86400000000.0) as bigint)"
