"""Checks of silver tables: shape, nulls, duplicates, cleaning, lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.functions.parsing import rate
from review_engine.operators.dedup import duplicate_groups
from review_engine.operators.shaping import all_present

LINEAGE_COLUMNS = ("bronze_file_name", "bronze_source_type", "processed_at")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows() -> Column:
    return F.count(F.lit(1))


def shape(datasets: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(_rows().alias("rows")).select(
                F.lit(name).alias("dataset"),
                "rows",
                F.lit(len(df.columns)).cast("bigint").alias("cols"),
                F.lit(", ".join(df.columns)).alias("columns"),
            )
            for name, df in datasets.items()
        ]
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows, with the number of values present in each column."""
    fields = df.schema.fields
    counted = df.agg(*[F.count(f"`{f.name}`").alias(f.name) for f in fields])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"`{f.name}`").alias("present"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*entries)))


def head(df: DataFrame, order: list[Column], n: int = 2) -> DataFrame:
    return df.orderBy(*order).limit(n)


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, most first."""
    counted = df.agg(_rows().alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"`{c}`")).alias("null_count"), "_rows")
        for c in df.columns
    ]
    return (
        counted.select(F.inline(F.array(*entries)))
        .filter(F.col("null_count") > 0)
        .select("column_name", "null_count", rate(F.col("null_count"), F.col("_rows"), 1).alias("null_pct"))
        .orderBy(F.col("null_count").desc(), "column_name")
    )


def duplicates(name: str, df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows that repeat an earlier key; NULLs in a key are equal to each other."""
    available = [k for k in keys if k in df.columns]
    # keys are compared as they are: NULL and empty text stay different here
    marked = df.select(*[F.struct(F.col(k).isNull().alias("none"), F.col(k)).alias(k) for k in available])
    groups = duplicate_groups(marked, available)
    return groups.agg(
        F.lit(name).alias("dataset"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.lit(", ".join(available)).alias("dedup_keys"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included, most first."""
    return df.groupBy(F.col(column).alias("value")).agg(_rows().alias("rows")).orderBy(F.col("rows").desc(), "value")


def changed(raw: str = "review_text", clean: str = "review_text_clean") -> Column:
    return F.coalesce(F.col(raw) != F.col(clean), F.lit(False))


def text_cleaning(df: DataFrame, raw: str = "review_text", clean: str = "review_text_clean") -> DataFrame:
    names = ("total_rows", "raw_text_not_null", "clean_text_not_null", "both_present", "changed_after_cleaning")
    counted = df.agg(
        _rows().alias(names[0]),
        F.count(raw).alias(names[1]),
        F.count(clean).alias(names[2]),
        F.count_if(all_present([raw, clean])).alias(names[3]),
        F.count_if(changed(raw, clean)).alias(names[4]),
    )
    return counted.unpivot([], list(names), "metric", "value")


def changed_sample(df: DataFrame, order: list[Column], columns: list[str], n: int = 3) -> DataFrame:
    return df.filter(changed()).orderBy(*order).limit(n).select(*columns)


def lineage(name: str, df: DataFrame, required: tuple[str, ...] = LINEAGE_COLUMNS) -> DataFrame:
    """Coverage of the lineage columns; an absent column has none."""
    present = [F.count(c) if c in df.columns else F.lit(0).cast("bigint") for c in required]
    counted = df.agg(_rows().alias("total_rows"), *[p.alias(c) for p, c in zip(present, required)])
    long = counted.unpivot(["total_rows"], list(required), "column_name", "not_null_rows")
    return long.select(
        F.lit(name).alias("dataset"),
        "column_name",
        "not_null_rows",
        "total_rows",
        rate(F.col("not_null_rows"), F.col("total_rows"), 1).alias("coverage_pct"),
    )


def source_files(name: str, df: DataFrame, column: str = "bronze_file_name") -> DataFrame:
    """Distinct raw files of a table; a merged cell names several."""
    files = df.select(F.explode(F.split(column, ",")).alias("f")).select(F.btrim("f").alias("bronze_file"))
    return files.distinct().select(F.lit(name).alias("dataset"), "bronze_file").orderBy("bronze_file")


def summary(name: str, df: DataFrame, source: str, file_name: str) -> DataFrame:
    counted = df.agg(
        _rows().alias("rows"),
        F.count_distinct(source).alias("unique_sources"),
        *[F.count(f"`{c}`").alias(f"present {c}") for c in df.columns],
    )
    present = reduce(lambda a, b: a + b, [F.col(f"`present {c}`") for c in df.columns])
    cells = F.col("rows") * len(df.columns)
    return counted.select(
        F.lit(name).alias("dataset"),
        "rows",
        F.lit(len(df.columns)).cast("bigint").alias("cols"),
        "unique_sources",
        rate(cells - present, cells, 1).alias("null_pct_avg"),
        F.lit(file_name).alias("parquet_file"),
    )


def before_after(name: str, df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows before and after dedup: one grouped count gives both."""
    return duplicate_groups(df, keys).agg(
        F.lit(name).alias("family"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        _rows().alias("rows_after"),
    )


def extraction_quality(items: DataFrame, noise: tuple[str, ...] = ("Streaming", "Link to")) -> DataFrame:
    """How many extracted rows have each field, and how many titles keep noise words."""
    filled = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return items.agg(
        _rows().alias("items"),
        filled("critics_score").alias("with_critics_score"),
        filled("audience_score").alias("with_audience_score"),
        filled("release_date").alias("with_release_date"),
        *[F.count_if(F.col("title").contains(w)).alias("noise_" + w.lower().replace(" ", "_")) for w in noise],
    )


def ingest_totals(parents: DataFrame, child_count: str) -> DataFrame:
    return parents.agg(
        _rows().alias("parents"), F.coalesce(F.sum(child_count), F.lit(0)).cast("bigint").alias("children")
    )
