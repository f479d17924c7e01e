"""Data-quality facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from review_engine.operators import governance as g
from review_engine.plans.registry import query
from review_engine.plans.tables import (
    COLUMNS,
    DATE_COLUMN,
    FAMILIES,
    FAMILY_SQL,
    RUN,
    SPECS,
    TEXT_COLUMNS,
    families,
    table,
)
from review_engine.schemas import FamilySpec


# --- the facts in SQL --------------------------------------------------------


def fact(kpi: str, metric: str, family: str, column: str | None, value: str, unit: str, source: str) -> str:
    """One SELECT giving facts; ``metric`` and ``value`` are SQL expressions."""
    column_sql = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{kpi}' AS kpi_type, {metric} AS metric_name, '{family}' AS family, {column_sql} AS column_name, "
        f"CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, '{RUN.computed_at}' AS computed_at, "
        f"'{RUN.run_stamp}' AS run_stamp FROM {source}"
    )


def null_rate_sql(f: str) -> list[str]:
    return [
        fact("null_rate", f"'null_rate_{f}_{c}'", f, c, f"round(100.0 * (count(*) - count({c})) / count(*), 2)",
             "percentage", f)
        for c in COLUMNS[f]
    ]


def volume_sql(f: str) -> list[str]:
    return [fact("volume", f"'total_records_{f}'", f, None, "count(*)", "count", f)]


def text_sql(f: str, mean: bool = False) -> list[str]:
    functions = {"min": "min", "max": "max"} | ({"mean": "avg"} if mean else {})
    return [
        fact("text_statistics", f"'{name}_text_length_{f}_{c}'", f, c,
             f"round({fn}(length(coalesce({c}, ''))), 2)", "characters", f)
        for c in TEXT_COLUMNS.get(f, ())
        for name, fn in functions.items()
    ]


def compliance_of(f: str, required: tuple[str, ...]) -> list[str]:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in required)
    return [
        fact("schema_compliance", f"'schema_compliance_rate_{f}'", f, ",".join(required),
             f"round(100.0 * count(*) FILTER (WHERE {complete}) / count(*), 2)", "percentage", f)
    ]


def compliance_sql(f: str) -> list[str]:
    return compliance_of(f, tuple(c for c in SPECS[f].required if c in COLUMNS[f]))


def frequency_of(f: str, column: str) -> list[str]:
    day = f"CAST({column} AS DATE)"
    value = f"round(least(100.0 * count(DISTINCT {day}) / (date_diff('day', min({day}), max({day})) + 1), 100.0), 2)"
    return [fact("ingestion_frequency", f"'ingestion_frequency_compliance_{f}'", f, column, value, "percentage", f)]


def frequency_sql(f: str) -> list[str]:
    return frequency_of(f, DATE_COLUMN[f]) if f in DATE_COLUMN else []


def duplicates_of(f: str, keys: tuple[str, ...]) -> list[str]:
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    groups = f"(SELECT count(*) AS copies FROM {f} WHERE {complete} GROUP BY {', '.join(keys)}) AS groups_{f}"
    return [fact("duplicates", f"'duplicate_rate_{f}'", f, ",".join(keys),
                 "round(100.0 * (sum(copies) - count(*)) / sum(copies), 2)", "percentage", groups)]


def duplicates_sql(f: str) -> list[str]:
    return duplicates_of(f, SPECS[f].duplicate_keys)


def source_sql(f: str) -> list[str]:
    groups = f"(SELECT coalesce(source, 'UNKNOWN') AS s, count(*) AS n FROM {f} GROUP BY 1) AS sources_{f}"
    return [fact("volume_by_source", f"'volume_{f}_' || s", f, "source", "n", "count", groups)]


def outlier_select(f: str, c: str, relation: str) -> str:
    quartiles = (
        f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, "
        f"count({c}) AS n FROM {relation})"
    )
    counted = (
        f"(SELECT any_value(n) AS n, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) "
        f"AS outside FROM {relation}, {quartiles} AS q WHERE n >= 4 AND q3 > q1 HAVING count(*) > 0) AS o_{f}_{c}"
    )
    return fact("outlier_rate", f"'outlier_rate_{f}_{c}'", f, c, "round(100.0 * outside / n, 2)", "percentage", counted)


def outlier_sql(f: str) -> list[str]:
    return [outlier_select(f, c, f) for c in SPECS[f].numeric]


def definition_sql(f: str) -> list[str]:
    present = f"(SELECT count(*) AS n FROM {f} HAVING count(*) > 0) AS present_{f}"
    return [
        fact("definition", f"'governance_definition_{suffix}'", f, title, "1.0", "definition", present)
        for suffix, title in g.DEFINITIONS
    ]


def family_sql(f: str) -> list[str]:
    return [
        select
        for part in (null_rate_sql, volume_sql, text_sql, compliance_sql, frequency_sql, duplicates_sql, source_sql,
                     outlier_sql, definition_sql)
        for select in part(f)
    ]


def union_sql(selects: list[str]) -> str:
    return FAMILY_SQL + "\nUNION ALL\n".join(selects)


REPORT_SELECTS = [select for f in FAMILIES for select in family_sql(f)]
REPORT_SQL = union_sql(REPORT_SELECTS)


# --- the queries -------------------------------------------------------------


def _each(spark: SparkSession, folder: str, names: tuple[str, ...], measure) -> DataFrame:
    frames = families(spark, folder, names)
    return reduce(DataFrame.unionByName, [measure(df, SPECS[n], RUN) for n, df in frames.items()])


def _sql_each(names: tuple[str, ...], part) -> str:
    return union_sql([select for n in names for select in part(n)])


def _part(name: str, **options):
    return lambda df, spec, run: g.profile(df, spec, run, parts=(name,), **options)


ALL = tuple(FAMILIES)


@query("gov_null_rate", _sql_each(ALL, null_rate_sql))
def gov_null_rate(spark, folder):
    return _each(spark, folder, ALL, _part("null_rate"))


@query("gov_volume", _sql_each(ALL, volume_sql))
def gov_volume(spark, folder):
    return _each(spark, folder, ALL, _part("volume"))


@query("gov_text_stats", _sql_each(ALL, lambda f: text_sql(f, mean=True)))
def gov_text_stats(spark, folder):
    return _each(spark, folder, ALL, _part("text", with_mean=True))


@query("gov_schema_compliance", _sql_each(ALL, compliance_sql))
def gov_schema_compliance(spark, folder):
    return _each(spark, folder, ALL, _part("compliance"))


@query("gov_ingestion_frequency", _sql_each(("user_reviews", "dated_reviews"), frequency_sql))
def gov_ingestion_frequency(spark, folder):
    return _each(spark, folder, ("user_reviews", "dated_reviews"), _part("frequency"))


@query("gov_duplicate_rate", _sql_each(ALL, duplicates_sql))
def gov_duplicate_rate(spark, folder):
    return _each(spark, folder, ALL, g.duplicate_rate)


@query("gov_volume_by_source", _sql_each(ALL, source_sql))
def gov_volume_by_source(spark, folder):
    return _each(spark, folder, ALL, g.volume_by_source)


LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_SPEC = FamilySpec("lineitem", "title", "lineitem", numeric=LINE_NUMBERS)


@query("gov_outlier_rate",
       "\nUNION ALL\n".join([outlier_select("lineitem", c, "lineitem") for c in LINE_NUMBERS]))
def gov_outlier_rate(spark, folder):
    return g.outlier_rates({"lineitem": table(spark, folder, "lineitem")}, {"lineitem": LINE_SPEC}, RUN)


@query("gov_definitions", _sql_each(ALL, definition_sql))
def gov_definitions(spark, folder):
    return _each(spark, folder, ALL, _part("definition"))


def report(spark: SparkSession, folder: str, kinds: tuple[str, ...] = g.KINDS) -> DataFrame:
    return g.governance_report(spark, families(spark, folder), SPECS, RUN, kinds=kinds)


@query("governance_report", REPORT_SQL)
def governance_report(spark, folder):
    return report(spark, folder)
