"""Data-quality facts per family, in long form."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions.parsing import double_of, parse_timestamp
from review_engine.operators.dedup import duplicate_groups
from review_engine.operators.quantiles import approx_quantiles, histogram, long_values, series_quantiles
from review_engine.schemas import GOVERNANCE_FACT, FamilySpec

# First of these columns that exists dates a row.
DATE_COLUMNS = ("review_date", "scraped_at", "processed_at")
MIN_OUTLIER_VALUES = 4
FENCE = 1.5

# The definition rows every family carries (metric suffix, title).
DEFINITIONS = (
    ("3_1_overview", "3.1 Overview"),
    ("3_2_1_null_rate", "3.2.1 Null Rate per Field"),
    ("3_2_2_volume_metrics", "3.2.2 Volume Metrics"),
    ("3_2_3_duplicate_rate", "3.2.3 Duplicate Rate"),
    ("3_2_4_schema_compliance", "3.2.4 Schema Compliance Rate"),
    ("3_2_5_outlier_rate", "3.2.5 Outlier Rate per Numeric Field"),
    ("3_2_6_text_length", "3.2.6 Text Length Statistics"),
    ("3_2_7_ingestion_frequency", "3.2.7 Ingestion Frequency Compliance"),
)


@dataclass(frozen=True)
class Run:
    """Stamp and time that every fact of a run carries."""

    run_stamp: str
    computed_at: str


# Facts are described by SQL expressions: a report has hundreds of them, and one
# text handed to the parser is far cheaper to plan than as many column objects.


def text_literal(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name_of(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def rate_of(part: str, whole: str, digits: int = 2) -> str:
    """Rounded percentage; an empty whole gives 0."""
    return f"CASE WHEN {whole} > 0 THEN round({part} / {whole} * 100, {digits}) ELSE 0.0D END"


def _entry(kpi: str, metric: str, column: str | None, value: str, unit: str) -> str:
    """A fact; ``metric`` and ``value`` are SQL expressions."""
    return (
        f"named_struct('kpi_type', '{kpi}', 'metric_name', {metric}, 'column_name', {text_literal(column)}, "
        f"'value', CAST({value} AS DOUBLE), 'unit', '{unit}')"
    )


def _facts(df: DataFrame, entries: list[str], spec: FamilySpec, run: Run) -> DataFrame:
    """One fact per entry and row of an aggregate; entries without a value give none."""
    return _named(df.selectExpr(f"inline(array({', '.join(entries)}))"), spec, run)


def _named(entries: DataFrame, spec: FamilySpec, run: Run) -> DataFrame:
    return (
        entries.filter("value IS NOT NULL")
        .selectExpr(
            "kpi_type",
            "metric_name",
            f"{text_literal(spec.name)} AS family",
            "column_name",
            "value",
            "unit",
            f"{text_literal(run.computed_at)} AS computed_at",
            f"{text_literal(run.run_stamp)} AS run_stamp",
        )
    )


# --- measures taken in one pass over the family ------------------------------


class _Measures:
    """Aggregates of one pass, how they are merged, and the fact entries made of them."""

    def __init__(self):
        self.aggregates = ["count(*) AS _rows"]
        self.merges = ["coalesce(sum(_rows), 0) AS _rows"]
        self.entries: list[str] = []

    def add(self, name: str, aggregate: str, merge: str | None = None) -> str:
        """``merge`` names the function that joins partial results; without one the result is only taken whole."""
        self.aggregates.append(f"{aggregate} AS {name_of(name)}")
        merged = f"{merge}({name_of(name)})" if merge else aggregate
        self.merges.append(f"{f'coalesce({merged}, 0)' if merge == 'sum' else merged} AS {name_of(name)}")
        return name_of(name)


def _null_rates(df: DataFrame, spec: FamilySpec, m: _Measures) -> None:
    for c in df.columns:
        present = m.add(f"present {c}", f"count({name_of(c)})", "sum")
        metric = text_literal(f"null_rate_{spec.name}_{c}")
        m.entries.append(_entry("null_rate", metric, c, rate_of(f"(_rows - {present})", "_rows"), "percentage"))


def _volume(df: DataFrame, spec: FamilySpec, m: _Measures) -> None:
    m.entries.append(_entry("volume", text_literal(f"total_records_{spec.name}"), None, "_rows", "count"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and "text" in f.name.lower()]


def _text_lengths(df: DataFrame, spec: FamilySpec, m: _Measures, with_mean: bool) -> None:
    functions = {"min": "min", "max": "max"} | ({"mean": "avg"} if with_mean else {})
    for c in text_columns(df):
        for name, function in functions.items():
            value = m.add(f"{name} length {c}", f"{function}(length(coalesce({name_of(c)}, '')))", function)
            metric = text_literal(f"{name}_text_length_{spec.name}_{c}")
            m.entries.append(_entry("text_statistics", metric, c, f"round({value}, 2)", "characters"))


def complete(columns) -> str:
    return " AND ".join(f"{name_of(c)} IS NOT NULL" for c in columns)


def _compliance(df: DataFrame, spec: FamilySpec, m: _Measures) -> None:
    required = [c for c in spec.required if c in df.columns]
    if required:
        rows = m.add("complete", f"count_if({complete(required)})", "sum")
        value = f"CASE WHEN _rows > 0 THEN {rate_of(rows, '_rows')} END"
        metric = text_literal(f"schema_compliance_rate_{spec.name}")
        m.entries.append(_entry("schema_compliance", metric, ",".join(required), value, "percentage"))


def day_of(df: DataFrame, column: str) -> Column:
    """Calendar day of a date column, text or not."""
    value = F.col(column)
    return F.to_date(parse_timestamp(value) if isinstance(df.schema[column].dataType, T.StringType) else value)


def _date_column(df: DataFrame) -> str | None:
    return next((c for c in DATE_COLUMNS if c in df.columns), None)


def _frequency(df: DataFrame, spec: FamilySpec, m: _Measures) -> None:
    column = _date_column(df)
    if column is None:
        return
    days = m.add("days", "count(DISTINCT _day)")
    first, last = m.add("first day", "min(_day)", "min"), m.add("last day", "max(_day)", "max")
    share = f"round(least({days} / (datediff({last}, {first}) + 1) * 100, 100.0D), 2)"
    value = f"CASE WHEN {days} > 0 THEN {share} END"
    metric = text_literal(f"ingestion_frequency_compliance_{spec.name}")
    m.entries.append(_entry("ingestion_frequency", metric, column, value, "percentage"))


def _definitions(spec: FamilySpec, m: _Measures) -> None:
    """The fixed rows of a family, whether it has rows or not."""
    for suffix, title in DEFINITIONS:
        metric = text_literal(f"governance_definition_{suffix}")
        m.entries.append(_entry("definition", metric, title, "1.0D", "definition"))


# Part of a profile -> the kind of facts it gives.
PROFILE_KINDS = {
    "null_rate": "null_rate", "volume": "volume", "text": "text_statistics", "compliance": "schema_compliance",
    "frequency": "ingestion_frequency", "definition": "definition",
}
PROFILE_PARTS = tuple(PROFILE_KINDS)
KINDS = (*PROFILE_KINDS.values(), "duplicates", "volume_by_source", "outlier_rate")


def _measured(df: DataFrame, spec: FamilySpec, with_mean: bool, parts: tuple[str, ...]) -> _Measures:
    m = _Measures()
    steps = {
        "null_rate": lambda: _null_rates(df, spec, m),
        "volume": lambda: _volume(df, spec, m),
        "text": lambda: _text_lengths(df, spec, m, with_mean),
        "compliance": lambda: _compliance(df, spec, m),
        "frequency": lambda: _frequency(df, spec, m),
        "definition": lambda: _definitions(spec, m),
    }
    for part in parts:
        steps[part]()
    return m


def profile(df: DataFrame, spec: FamilySpec, run: Run, with_mean: bool = False,
            parts: tuple[str, ...] = PROFILE_PARTS) -> DataFrame:
    """Null rates, volume, text lengths, compliance, frequency and definitions from one scan."""
    m = _measured(df, spec, with_mean, parts)
    if not m.entries:
        return df.sparkSession.createDataFrame([], GOVERNANCE_FACT)
    return _facts(_dated(df, parts).selectExpr(*m.aggregates), m.entries, spec, run)


def _dated(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    column = _date_column(df) if "frequency" in parts else None
    return df if column is None else df.withColumn("_day", day_of(df, column))


def profile_by_source(df: DataFrame, spec: FamilySpec, run: Run, parts: tuple[str, ...] = PROFILE_PARTS) -> DataFrame:
    """A profile and the volume by source from one scan.

    The scan is grouped by source and day. What is left is rolled up by grouping sets: a row
    for each source, and the grand total that the profile is made of. An empty row keeps the
    total of an empty family.
    """
    m = _measured(df, spec, False, parts)
    dated = _dated(df, parts)
    day = ["_day"] if "_day" in dated.columns else []
    distinct = {"`days`"}  # counted at the top only
    partial = [a for a in m.aggregates if not any(a.endswith(f"AS {d}") for d in distinct)]
    small = dated.withColumn("_source", F.expr("coalesce(source, 'UNKNOWN')")).groupBy("_source", *day).agg(*map(F.expr, partial))
    nothing = df.sparkSession.range(1).select([F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields])
    rolled = small.unionByName(nothing).groupingSets([[F.col("_source")], []], F.col("_source")).agg(
        F.grouping_id().alias("_total"), *map(F.expr, m.merges))
    by_source = _source_entry("_source", "_rows", spec)
    rows = rolled.filter("_total = 1 OR _rows > 0")
    facts = f"CASE _total WHEN 1 THEN array({', '.join(m.entries)}) ELSE array({by_source}) END"
    return _named(rows.selectExpr(f"inline({facts})"), spec, run)


# --- measures that need their own shuffle ------------------------------------


def duplicate_rate(df: DataFrame, spec: FamilySpec, run: Run) -> DataFrame | None:
    """Share of surplus copies among the rows whose key is complete."""
    keys = spec.duplicate_keys
    if not keys or not set(keys) <= set(df.columns):
        return None
    groups = duplicate_groups(df.filter(complete(keys)), keys).selectExpr(
        "coalesce(sum(copies), 0) AS rows", "count(*) AS keys"
    )
    metric = text_literal(f"duplicate_rate_{spec.name}")
    entry = _entry("duplicates", metric, ",".join(keys), rate_of("(rows - keys)", "rows"), "percentage")
    return _facts(groups, [entry], spec, run)


def _source_entry(source: str, n: str, spec: FamilySpec) -> str:
    metric = f"concat({text_literal(f'volume_{spec.name}_')}, {source})"
    return _entry("volume_by_source", metric, "source", n, "count")


def volume_by_source(df: DataFrame, spec: FamilySpec, run: Run) -> DataFrame | None:
    if "source" not in df.columns:
        return None
    counts = df.groupBy(F.expr("coalesce(source, 'UNKNOWN') AS source")).agg(F.expr("count(*) AS n"))
    return _facts(counts, [_source_entry("source", "n", spec)], spec, run)


def _numbers(df: DataFrame, spec: FamilySpec) -> dict[str, Column]:
    return {c: double_of(df, c) for c in spec.numeric if c in df.columns}


def outlier_rates(families: dict[str, DataFrame], specs: dict[str, FamilySpec], run: Run) -> DataFrame | None:
    """Share of values outside the Tukey fences, per numeric column of every family.

    Each family is read once, into one histogram of all numeric columns; the quartiles are
    selected from it, and the values outside the fences are counted in it.
    """
    values = [long_values(df, {f"{specs[name].name} {c}": v for c, v in numbers.items()})
              for name, df in families.items() if (numbers := _numbers(df, specs[name]))]
    if not values:
        return None
    counts = histogram(reduce(DataFrame.unionByName, values))
    fences = series_quantiles(counts, [0.25, 0.75]).filter(f"total >= {MIN_OUTLIER_VALUES}").selectExpr(
        "series", "total", f"q0 - {FENCE}D * (q1 - q0) AS low", f"q1 + {FENCE}D * (q1 - q0) AS high", "q1 - q0 AS spread")
    # One row for each numeric column.
    held = counts.join(F.broadcast(fences.filter("spread <> 0 AND NOT isnan(spread)")), "series")
    rates = held.groupBy("series", "total").agg(F.expr("coalesce(sum(n) FILTER (WHERE value < low OR value > high), 0) AS outside"))
    names = F.split("series", " ", 2)
    return rates.select(
        F.lit("outlier_rate").alias("kpi_type"),
        F.concat(F.lit("outlier_rate_"), names[0], F.lit("_"), names[1]).alias("metric_name"),
        names[0].alias("family"),
        names[1].alias("column_name"),
        F.expr(f"CAST({rate_of('outside', 'total')} AS DOUBLE)").alias("value"),
        F.lit("percentage").alias("unit"),
        F.lit(run.computed_at).alias("computed_at"),
        F.lit(run.run_stamp).alias("run_stamp"),
    )


def approx_outlier_rate(df: DataFrame, spec: FamilySpec, run: Run) -> DataFrame | None:
    """As ``outlier_rates`` with quartiles from a sketch, which come first as a few numbers."""
    columns = _numbers(df, spec)
    if not columns:
        return None
    numbers = df.select([value.alias(c) for c, value in columns.items()])
    m = _Measures()
    for c, (n, found) in approx_quantiles(numbers, list(columns), [0.25, 0.75]).items():
        if n < MIN_OUTLIER_VALUES or found[0] == found[1]:
            continue
        low, high = found
        fences = [f"double('{fence!r}')" for fence in (low - FENCE * (high - low), high + FENCE * (high - low))]
        outside = m.add(c, f"count_if({name_of(c)} < {fences[0]} OR {name_of(c)} > {fences[1]})")
        metric = text_literal(f"outlier_rate_{spec.name}_{c}")
        m.entries.append(_entry("outlier_rate", metric, c, rate_of(outside, str(n)), "percentage"))
    return _facts(numbers.selectExpr(*m.aggregates), m.entries, spec, run) if m.entries else None


# --- reports -----------------------------------------------------------------


def family_facts(df: DataFrame, spec: FamilySpec, run: Run, kinds: tuple[str, ...] = KINDS) -> list[DataFrame]:
    """The facts of these kinds, but for outliers, which all families share; what is not asked for is not planned."""
    parts = tuple(part for part, kind in PROFILE_KINDS.items() if kind in kinds)
    made = []
    if parts and "volume_by_source" in kinds and "source" in df.columns:
        made.append(profile_by_source(df, spec, run, parts))
    else:
        if parts:
            made.append(profile(df, spec, run, parts=parts))
        if "volume_by_source" in kinds:
            made.append(volume_by_source(df, spec, run))
    if "duplicates" in kinds:
        made.append(duplicate_rate(df, spec, run))
    return [part for part in made if part is not None]


def governance_report(spark: SparkSession, families: dict[str, DataFrame | None], specs: dict[str, FamilySpec],
                      run: Run, approx: bool = False, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Facts of all families that exist, of the kinds asked for; an empty typed table if there are none."""
    present = {name: df for name, df in families.items() if df is not None}
    made = [part for name, df in present.items() for part in family_facts(df, specs[name], run, kinds)]
    if "outlier_rate" in kinds:
        made += ([approx_outlier_rate(df, specs[name], run) for name, df in present.items()] if approx
                 else [outlier_rates(present, specs, run)])
    made = [part for part in made if part is not None]
    return reduce(DataFrame.unionByName, made) if made else spark.createDataFrame([], GOVERNANCE_FACT)
