"""Merging the rows of one entity, and nesting children below a parent.

Values are made distinct in the map tasks first; then an entity is one row, whatever
its size. Who must not gather an entity's values into one cell reads them in the long form
(``distinct_values``), which is complete and spreads a hot entity over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.functions.text import to_null

# Field names of an ordinal made of a file and a position in it.
ORDINAL_FILE = "file"
ORDINAL_POSITION = "position"
# Name of the joined text of a column that keeps its first value, in its type, under its own name.
ALL_SUFFIX = "_all"


def distinct_values(df: DataFrame, key: str, columns: list[str], ordinal: str) -> DataFrame:
    """Long form: every distinct trimmed value per key and column with its first ordinal.

    The entry without a column name stands for the key itself, so that an entity
    whose cells are all blank is kept.
    """
    cells = F.array(
        F.struct(F.lit("").alias("column_name"), F.lit("").alias("value")),
        *[F.struct(F.lit(c).alias("column_name"), to_null(F.col(c).cast("string")).alias("value")) for c in columns],
    )
    long = df.select(F.col(key), F.col(ordinal).alias("_ord"), F.inline(cells))
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(key, "column_name", "value")
        .agg(F.min("_ord").alias("first_ordinal"))
    )


def merge_entities(
    df: DataFrame,
    key: str,
    columns: list[str],
    ordinal: str,
    first_columns: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """One row per key: in each column its distinct values in order of appearance, joined by ``", "``.

    ``first_columns`` keep their type and give their first value; the joined text of all
    their values stands beside it, under the name with ``_all``. ``ordinal`` is unique and orders the rows.
    """
    values = distinct_values(df, key, [*columns, *first_columns], ordinal)
    pairs = {
        c: F.collect_list(F.when(F.col("column_name") == c, F.struct("first_ordinal", "value")))
        for c in [*columns, *first_columns]
    }
    firsts = [
        F.min_by("value", F.when(F.col("column_name") == c, F.col("first_ordinal"))).alias(c) for c in first_columns
    ]
    return values.groupBy(key).agg(
        *[_joined(pairs[c]).alias(c) for c in columns],
        *firsts,
        *[_joined(pairs[c]).alias(c + ALL_SUFFIX) for c in first_columns],
    )


def _joined(pairs: Column) -> Column:
    ordered = F.transform(F.array_sort(pairs), lambda p: p["value"])
    return F.nullif(F.array_join(ordered, ", "), F.lit(""))


def nest_children(df: DataFrame, parent: str, ordinal: str, fields: list[str], name: str = "children") -> DataFrame:
    """One row per parent: its children as an ordered array of structs, and how many there are."""
    return df.groupBy(parent).agg(
        F.array_sort(F.collect_list(F.struct(ordinal, *[f for f in fields if f != ordinal]))).alias(name),
        F.count(F.lit(1)).alias("total_" + name),
    )
