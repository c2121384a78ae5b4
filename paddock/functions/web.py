"""Parts of a URL as column expressions, and the table of hits they give."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _without(column: Column, *schemes: str) -> Column:
    for scheme in schemes:
        column = F.replace(column, F.lit(scheme), F.lit(""))
    return column


def _part(column: Column, delimiter: str, number: int) -> Column:
    return F.split_part(column, F.lit(delimiter), F.lit(number))


def url_host(url: Column) -> Column:
    """Host: the text before the first ``/`` or ``?``, after the scheme."""
    bare = _without(url, "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """Path without leading slash and query; empty when there is none."""
    bare = _without(url, "http://", "https://")
    slash = F.instr(bare, "/")
    skipped = F.coalesce(F.nullif(slash, F.lit(0)), F.instr(bare, "?") - 1)
    return _part(F.right(bare, F.length(bare) - skipped), "?", 1)


def url_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter, NULL when missing or empty. ``name`` matches as a substring."""
    return F.nullif(_part(_part(url, f"{name}=", 2), "&", 1), F.lit(""))


def with_url_parts(df: DataFrame, column: str, parameters: Sequence[str] = ()) -> DataFrame:
    url = F.col(column)
    parts = {"host": url_host(url), "path": url_path(url)}
    return df.withColumns({**parts, **{f"param_{p}": url_parameter(url, p) for p in parameters}})


def url_breakdown(df: DataFrame, column: str) -> DataFrame:
    """Hits and distinct paths per host."""
    return (
        with_url_parts(df.select(column), column)
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("path").alias("paths"))
    )
