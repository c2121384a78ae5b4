"""Column selection, renaming and row filters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


# Characters that become an underscore, and those that are dropped.
SEPARATORS = "[ -]+"
DROPPED = "[^a-z0-9_]+"


def _folded(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def select_renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Projection ``new_name=old_name``."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "", alias: str | None = None
) -> list[Column]:
    """All columns but the excluded ones (any case), optionally with prefix and suffix.

    ``alias`` names the aliased frame the columns are taken from.
    """
    dropped = _folded(exclude)
    qualify = "" if alias is None else f"{alias}."
    return [
        F.col(f"{qualify}`{c}`").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in dropped
    ]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Frame without the named columns, names matched in any case."""
    dropped = _folded(names)
    return df.drop(*[c for c in df.columns if c.lower() in dropped])


def slugify(text: str) -> str:
    """Lower-case name of letters, digits and underscores that does not start with a digit."""
    kept = re.sub(DROPPED, "", re.sub(SEPARATORS, "_", text.lower()))
    return f"_{kept}" if kept[:1].isdigit() else kept


def slugify_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[slugify(c) for c in df.columns])


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings as NULL, in all string columns or the given ones."""
    chosen = df.columns if columns is None else columns
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name in chosen]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def in_list(df: DataFrame, column: str, values: Sequence, negate: bool = False) -> DataFrame:
    """Rows whose value is in the list; with ``negate`` rows whose value is known not to be."""
    hit = F.col(column).isin(list(values))
    return df.where(~hit if negate else hit)


def qualify(df: DataFrame, condition: Column, name: str, window_value: Column) -> DataFrame:
    """Rows for which a condition on a window value holds."""
    return df.withColumn(name, window_value).where(condition).drop(name)
