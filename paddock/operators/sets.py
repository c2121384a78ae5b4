"""Unions over a superset of columns, differences, unpivot."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paddock.functions.scalars import as_text

# Fixed value: default name of the column that holds the relation's name.
SOURCE_COLUMN = "source_relation"


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = SOURCE_COLUMN,
    where: Column | str | None = None,
) -> DataFrame:
    """UNION ALL over all columns of the named frames.

    A column missing in a frame is NULL. A column has the type of the first frame that has
    it, unless ``column_override`` gives another.
    """
    if include and exclude:
        raise ValueError("give an include or an exclude list, not both")
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    keep = lambda c: c.lower() not in unwanted and (not wanted or c.lower() in wanted)
    types: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            if keep(field.name):
                types.setdefault(field.name, field.dataType.simpleString())
    if not types:
        raise ValueError(f"no columns to union in {', '.join(relations)}")
    types.update({c: t for c, t in (column_override or {}).items() if c in types})

    def shaped(name: str, df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        source = [] if source_column is None else [F.lit(name).alias(source_column)]
        columns = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return rows.select(*source, *columns)

    return reduce(DataFrame.unionAll, [shaped(name, df) for name, df in relations.items()])


def _like(pattern: str) -> re.Pattern:
    """Regular expression for a LIKE pattern, in any case."""
    parts = [".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern]
    return re.compile("".join(parts), re.IGNORECASE | re.DOTALL)


def tables_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", temporary: bool = False
) -> dict[str, DataFrame]:
    """Catalog tables and views whose schema and name match LIKE patterns, any case.

    With ``temporary`` the session's temporary views, which have no schema, are matched by
    name instead.
    """
    schema, table, without = _like(schema_pattern), _like(table_pattern), _like(exclude)
    databases = [spark.catalog.currentDatabase()] if temporary else [d.name for d in spark.catalog.listDatabases()]
    found = {}
    for database in databases:
        if not temporary and not schema.fullmatch(database):
            continue
        for entry in spark.catalog.listTables(database):
            if entry.isTemporary == temporary and table.fullmatch(entry.name) and not without.fullmatch(entry.name):
                name = entry.name if temporary else f"{database}.{entry.name}"
                found[name] = spark.table(".".join(f"`{part}`" for part in name.split(".")))
    return dict(sorted(found.items()))


def tables_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    return tables_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_by_pattern(
    spark: SparkSession,
    schema_pattern: str,
    table_pattern: str,
    exclude: str = "",
    temporary: bool = False,
    **options,
) -> DataFrame:
    return union_relations(tables_by_pattern(spark, schema_pattern, table_pattern, exclude, temporary), **options)


def union_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "", **options) -> DataFrame:
    return union_relations(tables_by_prefix(spark, schema, prefix, exclude), **options)


def union_files(spark: SparkSession, pattern: str, source_column: str | None = SOURCE_COLUMN) -> DataFrame:
    """Union by name of all parquet files that match a path pattern, with the file as source."""
    files = spark.read.option("mergeSchema", "true").parquet(pattern)
    if source_column is None:
        return files
    return files.select(F.col("_metadata.file_path").alias(source_column), "*")


def sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both frames with the number of copies on each side, ``_left`` and ``_right``.

    One shuffle for both frames; copies of a row are counted before it, and NULLs are equal.
    Columns are matched by position and named as in ``left``.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    a = left.select("*", one.alias("_left"), none.alias("_right"))
    b = right.toDF(*left.columns).select("*", none.alias("_left"), one.alias("_right"))
    return a.unionAll(b).groupBy(*left.columns).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))


def difference(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of left that are not in right, NULLs equal; distinct unless copies are kept."""
    if keep_duplicates:
        return left.exceptAll(right)
    return sides(left, right).where((F.col("_left") > 0) & (F.col("_right") == 0)).drop("_left", "_right")


def both_differences(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows found on one side only, labelled ``a_minus_b`` or ``b_minus_a``."""
    if keep_duplicates:
        a = left.exceptAll(right).select(F.lit("a_minus_b").alias("which_diff"), "*")
        return a.unionAll(right.exceptAll(left).select(F.lit("b_minus_a").alias("which_diff"), "*"))
    only = sides(left, right).where((F.col("_left") == 0) | (F.col("_right") == 0))
    label = F.when(F.col("_right") == 0, "a_minus_b").otherwise("b_minus_a")
    return only.select(label.alias("which_diff"), *left.columns)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns as (field, value) rows in one scan; ``exclude`` columns are kept on each row."""
    fixed = {c.lower() for c in exclude}
    left_out = fixed | {c.lower() for c in remove}
    names = [c for c in df.columns if c.lower() not in left_out]
    ids = [c for c in df.columns if c.lower() in fixed]
    cast = lambda c: as_text(df, c) if cast_to == "string" else F.col(c).cast(cast_to)
    return df.select(*ids, *[cast(c).alias(c) for c in names]).unpivot(ids, names, field_name, value_name)
