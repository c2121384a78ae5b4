"""Registered queries: a Spark callable and, where SQL can say it, the same query for the oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from paddock.functions.scalars import round_half_up

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}

_MODULES = ("race", "tables", "functions", "checks", "ingest", "streams")


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def load() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"paddock.registry.{module}")
    return REGISTRY


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in doubles}) if doubles else df


def round_sql(expression: str, digits: int) -> str:
    """A double rounded half up on its decimal value."""
    return f"round(CAST({expression} AS DECIMAL(28, 10)), {digits})::DOUBLE"


def rounded_sql(body: str, *columns: str, digits: int = 6) -> str:
    replaced = ", ".join(f"{round_sql(c, digits)} AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({body})"
