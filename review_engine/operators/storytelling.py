"""Opinion facts per family, in long form."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from review_engine.functions.parsing import double_of
from review_engine.operators.governance import Run, day_of, text_literal
from review_engine.operators.sentiment import fill_labels, token_counts, top_counts
from review_engine.schemas import STORY_FACT, FamilySpec

TOP_KEYWORDS = 10
TOP_REVIEWERS = 10
TOP_TITLES = 15
FIRST_GROUPS = 10

# The definition rows (metric suffix, dimension, text).
DEFINITIONS = (
    ("4_1_dashboard_narrative", "4.1 Dashboard Narrative", "Narrative summary for dashboards"),
    ("4_2_1_sentiment_distribution", "4.2.1 Sentiment Distribution", "Sentiment distribution"),
    ("4_2_2_sentiment_trend", "4.2.2 Sentiment Trend Over Time", "Sentiment trend over time"),
    ("4_2_3_critic_vs_audience", "4.2.3 Critic vs Audience Score Comparison", "Score comparison"),
    ("4_2_4_top_keywords", "4.2.4 Top Keywords and N-grams", "Keyword and n-gram summary"),
    ("4_2_5_source_volume", "4.2.5 Source Volume and Activity Trends", "Source volume and activity"),
    ("4_2_6_release_period", "4.2.6 Top Content by Release Period", "Release period analysis"),
)


def _fact(kind: str, metric: str, dimension: str, dimension_value: str, value: str, unit: str) -> list[str]:
    """The columns of a fact that differ within a family, as SQL expressions."""
    return [
        f"'{kind}' AS aggregation_type",
        f"{metric} AS metric_name",
        f"{text_literal(dimension)} AS dimension",
        f"CAST({dimension_value} AS STRING) AS dimension_value",
        f"CAST({value} AS DOUBLE) AS value",
        f"'{unit}' AS unit",
    ]


def _metric(prefix: str, *parts: str) -> str:
    """Metric name of a fixed prefix and computed parts; a missing part reads ``unknown``."""
    computed = [f"coalesce(CAST({p} AS STRING), 'unknown')" for p in parts]
    return f"concat({', '.join([text_literal(prefix), *computed])})"


def _facts(df: DataFrame, fact: list[str], family: str, run: Run) -> DataFrame:
    """One fact per row. A single projection, so that a top-k below it stays one operator."""
    return df.selectExpr(
        *fact[:4],
        f"{text_literal(family)} AS family",
        *fact[4:],
        f"{text_literal(run.computed_at)} AS computed_at",
        f"{text_literal(run.run_stamp)} AS run_stamp",
    )


FACT_NAMES = ["aggregation_type", "metric_name", "dimension", "dimension_value", "value", "unit"]


def _as_struct(fact: list[str]) -> str:
    return f"struct({', '.join(fact)})"


def _has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


def _ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rank of the few rows a limit has left."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


# --- counts and means per group: one pass over narrow columns -----------------


@dataclass(frozen=True)
class Measure:
    """Groups of a family by one key, and the facts made of them."""

    kind: str
    keys: tuple[str, ...]
    needs: tuple[str, ...]
    fact: Callable[[FamilySpec], list[str]]
    most: int | None = None  # the first groups only, in the order of by_count and the key
    by_count: bool = False


DAY, LABEL = "date_format(day, 'yyyy-MM-dd')", "coalesce(label, 'UNKNOWN')"

MEASURES = {
    "distribution": Measure(
        "sentiment_distribution", ("label",), ("sentiment_label",),
        lambda s: _fact("sentiment_distribution", _metric(f"{s.prefix}_sentiment_", LABEL), "sentiment_label", LABEL, "n", "count")),
    "trend": Measure(
        "sentiment_trend", ("label", "day"), ("sentiment_label", "review_date"),
        lambda s: _fact("sentiment_trend", _metric(f"{s.prefix}_sentiment_trend_", DAY, "'_'", LABEL), "day", DAY, "n", "count")),
    "volume": Measure(
        "volume_by_date", ("day",), ("review_date",),
        lambda s: _fact("volume_by_date", _metric(f"{s.prefix}_volume_", DAY), "date", DAY, "CASE WHEN day IS NOT NULL THEN n END", "count")),
    "rating": Measure(
        "avg_rating_by_source", (), ("rating",),
        lambda s: _fact("avg_rating_by_source", text_literal(f"{s.prefix}_avg_rating"), "source", text_literal(s.prefix),
                        "round(rating, 2)", "score")),
    "rating_trend": Measure(
        "sentiment_trend", ("day",), ("review_date", "rating"),
        lambda s: _fact("sentiment_trend", _metric(f"{s.prefix}_sentiment_trend_", DAY), "day", DAY, "round(coalesce(rating, 0.0D), 2)", "score"),
        most=FIRST_GROUPS),
    "gap": Measure(
        "critic_vs_audience", ("title",), ("critics_score", "audience_score", "canonical_title"),
        lambda s: _fact("critic_vs_audience", _metric(f"{s.prefix}_critic_vs_audience_", "title"), "canonical_title", "title",
                        "round(coalesce(critics, 0.0D) - coalesce(audience, 0.0D), 2)", "score_delta"),
        most=FIRST_GROUPS),
    "source": Measure(
        "source_volume", ("source",), ("source",),
        lambda s: _fact("source_volume", _metric(f"{s.prefix}_source_volume_", "source"), "source", "source", "n", "count")),
    "title_source": Measure(
        "volume_by_source", ("source",), ("source",),
        lambda s: _fact("volume_by_source", _metric(f"{s.name}_volume_", "source"), "source", "source", "n", "count")),
    "reviewers": Measure(
        "top_reviewers", ("reviewer",), ("reviewer_name",),
        lambda s: _fact("top_reviewers", _metric(f"{s.prefix}_reviewer_rank_", "rank"), "reviewer_name", "reviewer", "n", "count"),
        most=TOP_REVIEWERS, by_count=True),
    "titles": Measure(
        "top_titles_by_reviews", ("title",), ("canonical_title",),
        lambda s: _fact("top_titles_by_reviews", _metric(f"{s.prefix}_title_rank_", "rank"), "canonical_title", "title", "n", "count"),
        most=TOP_TITLES, by_count=True),
    "year": Measure(
        "release_period", ("year",), ("release_year",),
        lambda s: _fact("release_period", _metric(f"{s.prefix}_release_period_", "year"), "release_year", "year", "n", "count"),
        most=FIRST_GROUPS),
    "popularity": Measure(
        "avg_popularity", (), ("popularity",),
        lambda s: _fact("avg_popularity", text_literal(f"{s.name}_avg_popularity"), "global", "'all'", "round(popularity, 2)", "score")),
}
KEYS = ("label", "day", "source", "reviewer", "title", "year")
KEY_COLUMNS = {"label": "sentiment_label", "source": "source", "reviewer": "reviewer_name", "title": "canonical_title", "year": "release_year"}
MEANS = {"rating": "rating", "critics": "critics_score", "audience": "audience_score", "popularity": "popularity"}


def _measurable(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if _has(df, *MEASURES[n].needs)]


def _narrow(df: DataFrame, names: list[str], keys: list[str]) -> tuple[DataFrame, list[Column]]:
    """Only the columns the measures read, and their aggregates."""
    needed = {c for n in names for c in MEASURES[n].needs}
    means = [m for m, column in MEANS.items() if column in needed]
    columns = [(day_of(df, "review_date") if k == "day" else F.col(KEY_COLUMNS[k])).alias(k) for k in keys]
    columns += [double_of(df, MEANS[m]).alias(m) for m in means]
    return df.select(*columns), [_count(), *[F.avg(m).alias(m) for m in means]]


def _one_measure(df: DataFrame, spec: FamilySpec, run: Run, name: str, k: int | None = None) -> DataFrame | None:
    """A single measure: a grouped count, and one top-k operator where only the first groups are wanted."""
    if not _measurable(df, [name]):
        return None
    m = MEASURES[name]
    narrow, aggregates = _narrow(df, [name], list(m.keys))
    grouped = narrow.groupBy(*m.keys).agg(*aggregates)
    if m.most is not None:
        order = [*([F.col("n").desc()] if m.by_count else []), *[F.col(key).asc_nulls_last() for key in m.keys]]
        grouped = grouped.orderBy(*order).limit(k or m.most)
        grouped = _ranked(grouped, order) if m.by_count else grouped
    fact = m.fact(spec)
    # A fact whose value may be missing is left out then.
    if name in ("volume", "rating", "popularity"):
        return _facts(grouped.selectExpr(*fact).filter("value IS NOT NULL"), FACT_NAMES, spec.name, run)
    return _facts(grouped, fact, spec.name, run)


def measured(df: DataFrame, spec: FamilySpec, run: Run, names: Iterable[str]) -> DataFrame | None:
    """The measures of a family that its columns allow, from one scan.

    Each measure is a grouping set, so what is shuffled are partial counts. Measures that
    want their first groups only share one window by measure, which Spark limits in every
    task before the shuffle; each group of the others is a partition of its own there.
    """
    names = _measurable(df, names)
    if len(names) < 2:
        return _one_measure(df, spec, run, names[0]) if names else None
    keys = [k for k in KEYS if any(k in MEASURES[n].keys for n in names)]
    narrow, aggregates = _narrow(df, names, keys)
    # Measures of the same key are told apart by columns that hold nothing.
    seen: Counter[tuple[str, ...]] = Counter()
    sets = []
    for n in names:
        key = MEASURES[n].keys
        sets.append([*key, *[f"twin{i}" for i in range(seen[key])]])
        seen[key] += 1
    extra = [f"twin{i}" for i in range(max(seen.values()) - 1)]
    columns = [*keys, *extra]
    levels = {n: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in chosen)
              for n, chosen in zip(names, sets, strict=True)}
    grouped = (narrow.select("*", *[F.lit(0).alias(t) for t in extra])
               .groupingSets([[F.col(c) for c in chosen] for chosen in sets], *map(F.col, columns))
               .agg(F.grouping_id().alias("level"), *aggregates))
    ranked = {n: MEASURES[n].most for n in names if MEASURES[n].most is not None}
    if ranked:
        limited = F.col("level").isin([levels[n] for n in ranked])
        counted = F.when(F.col("level").isin([levels[n] for n in ranked if MEASURES[n].by_count]), -F.col("n")).otherwise(0)
        apart = [F.when(~limited, F.struct(k)) for k in keys]
        window = Window.partitionBy("level", *apart).orderBy(counted, *[F.col(k).asc_nulls_last() for k in keys])
        grouped = grouped.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= max(ranked.values()))
        below = [(F.col("level") != levels[n]) | (F.col("rank") <= most) for n, most in ranked.items() if most < max(ranked.values())]
        grouped = reduce(DataFrame.filter, below, grouped)
    cases = " ".join(f"WHEN {levels[n]} THEN {_as_struct(MEASURES[n].fact(spec))}" for n in names)
    long = grouped.selectExpr(f"inline(array(CASE level {cases} END))").filter("value IS NOT NULL")
    return _facts(long, FACT_NAMES, spec.name, run)


def activity(df: DataFrame, spec: FamilySpec, run: Run,
             parts: tuple[str, ...] = ("distribution", "trend", "volume", "rating")) -> DataFrame | None:
    """Counts per label, per day and label, per day, and the mean rating."""
    return measured(df, spec, run, parts)


def rating_trend(df: DataFrame, spec: FamilySpec, run: Run, k: int = FIRST_GROUPS) -> DataFrame | None:
    """Mean rating of the first ``k`` days; a day without ratings counts as 0."""
    return _one_measure(df, spec, run, "rating_trend", k)


def critic_vs_audience(df: DataFrame, spec: FamilySpec, run: Run, k: int = FIRST_GROUPS) -> DataFrame | None:
    """Mean critic minus mean audience score of the first ``k`` titles by name."""
    return _one_measure(df, spec, run, "gap", k)


def source_volume(df: DataFrame, spec: FamilySpec, run: Run, kind: str = "source_volume") -> DataFrame | None:
    """Rows per source; rows without a source are a group of their own."""
    return _one_measure(df, spec, run, "source" if kind == "source_volume" else "title_source")


def top_reviewers(df: DataFrame, spec: FamilySpec, run: Run, k: int = TOP_REVIEWERS) -> DataFrame | None:
    """The ``k`` busiest reviewers with their rank."""
    return _one_measure(df, spec, run, "reviewers", k)


def top_titles_by_reviews(df: DataFrame, spec: FamilySpec, run: Run, k: int = TOP_TITLES) -> DataFrame | None:
    """The ``k`` most reviewed titles with their rank."""
    return _one_measure(df, spec, run, "titles", k)


def release_period(df: DataFrame, spec: FamilySpec, run: Run, k: int = FIRST_GROUPS) -> DataFrame | None:
    """Titles per release year, first ``k`` years."""
    return _one_measure(df, spec, run, "year", k)


def avg_popularity(df: DataFrame, spec: FamilySpec, run: Run) -> DataFrame | None:
    return _one_measure(df, spec, run, "popularity")


# --- keywords and rated titles ---------------------------------------------------


def top_keywords(df: DataFrame, spec: FamilySpec, run: Run, k: int = TOP_KEYWORDS,
                 text: str = "review_text_clean") -> DataFrame | None:
    if not _has(df, text):
        return None
    top = top_counts(token_counts(df, text), "token", k)
    fact = _fact("top_keywords", _metric(f"{spec.prefix}_top_keyword_", "token"), "keyword", "token", "mentions", "count")
    return _facts(top, fact, spec.name, run)


def top_titles_by_rating(df: DataFrame, spec: FamilySpec, run: Run, k: int = TOP_TITLES) -> DataFrame | None:
    """The ``k`` best rated rows with their rank."""
    if not _has(df, "vote_average", "canonical_title"):
        return None
    ties = [F.col(c).asc_nulls_last() for c in ("canonical_title", "source_id") if c in df.columns]
    order = [F.col("score").desc_nulls_last(), *ties]
    rated = df.filter(F.col("vote_average").isNotNull()).withColumn("score", double_of(df, "vote_average"))
    top = _ranked(rated.orderBy(*order).limit(k), order)
    fact = _fact("top_titles_by_rating", _metric(f"{spec.prefix}_rank_", "rank"), "canonical_title", "canonical_title",
                 "coalesce(score, 0.0D)", "score")
    return _facts(top, fact, spec.name, run)


def definitions(once: DataFrame, run: Run) -> DataFrame:
    """The fixed definition rows, for each row of ``once``."""
    entries = [
        _as_struct(_fact("definition", text_literal(f"storytelling_definition_{suffix}"), dimension, text_literal(text),
                         "1.0D", "definition"))
        for suffix, dimension, text in DEFINITIONS
    ]
    return _facts(once.selectExpr(f"inline(array({', '.join(entries)}))"), FACT_NAMES, "dashboard", run)


# --- reports -----------------------------------------------------------------


MEASURES_OF = {
    "critic": ("distribution", "trend", "volume", "rating", "gap", "source", "reviewers"),
    "user": ("distribution", "volume", "rating", "rating_trend", "titles"),
    "title": ("year", "title_source", "popularity"),
}
KINDS = (*dict.fromkeys(m.kind for m in MEASURES.values()), "top_keywords", "top_titles_by_rating", "definition")


def needs_labels(df: DataFrame, spec: FamilySpec, kinds: Iterable[str]) -> bool:
    """Whether facts of these kinds read the labels of the family."""
    wanted = [MEASURES[n].needs for n in MEASURES_OF[spec.kind] if MEASURES[n].kind in kinds]
    return any("sentiment_label" in needs and {*needs} - {"sentiment_label"} <= {*df.columns} for needs in wanted)


def family_facts(df: DataFrame, spec: FamilySpec, run: Run, kinds: Iterable[str] = KINDS) -> DataFrame | None:
    """The opinion facts of one family; what is not asked for, or needs an absent column, is not planned."""
    parts = [measured(df, spec, run, [n for n in MEASURES_OF[spec.kind] if MEASURES[n].kind in kinds])]
    if spec.kind != "title" and "top_keywords" in kinds:
        parts.append(top_keywords(df, spec, run))
    if spec.kind == "title" and "top_titles_by_rating" in kinds:
        parts.append(top_titles_by_rating(df, spec, run))
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def with_labels(df: DataFrame, key: str | None, lexicon: DataFrame) -> DataFrame:
    """Label the family from its clean text, else its raw text, if no row has a label.

    Without a key the digest of the text serves: copies of a text share a label.
    """
    text = next((c for c in ("review_text_clean", "review_text") if c in df.columns), None)
    if text is None:
        return df
    if key is not None:
        return fill_labels(df, key, text, lexicon)
    keyed = df.withColumn("_text_key", F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)))
    return fill_labels(keyed, "_text_key", text, lexicon).drop("_text_key")


def storytelling_report(spark: SparkSession, families: dict[str, DataFrame | None], specs: dict[str, FamilySpec],
                        run: Run, kinds: Iterable[str] = KINDS) -> DataFrame:
    """Facts of all families that exist, and the definition rows, as far as their kinds are asked for."""
    parts = [family_facts(df, specs[name], run, kinds) for name, df in families.items() if df is not None]
    parts = [p for p in parts if p is not None]
    if "definition" in kinds or not parts:
        fixed = definitions(spark.range(1), run)
        parts.append(fixed if "definition" in kinds else fixed.limit(0))
    return reduce(DataFrame.unionByName, parts).select(*STORY_FACT.fieldNames())
