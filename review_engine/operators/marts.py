"""Queries over the long-format facts: what a dashboard shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_engine.functions.parsing import double_of, parse_timestamp
from review_engine.functions.text import keyword_letters, label_text, sentiment_from_name
from review_engine.operators.shaping import BANNED_KEYWORDS, meaningful_keywords, where_equal, where_in
from review_engine.schemas import GOVERNANCE_FACT, STORY_FACT

# Kinds of facts a view shows.
QUALITY_KINDS = ("null_rate", "duplicates", "schema_compliance", "ingestion_frequency", "text_statistics")
SOURCE_KINDS = ("source_volume", "volume_by_source")
EVIDENCE_KINDS = (
    "sentiment_distribution", "sentiment_trend", "critic_vs_audience", "top_keywords", "source_volume",
    "volume_by_source", "volume_by_date", "top_titles_by_reviews",
)
NARRATIVE_KINDS = ("sentiment_distribution", *SOURCE_KINDS, "top_keywords", "critic_vs_audience", "top_titles_by_reviews")
LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")
UPPER_SENTINELS = ("<NA>", "NAN", "NONE", "")
HIDDEN_VALUES = ("<NA>", "nan", "None", "UNKNOWN", "")
NARRATIVE_HIDDEN = ("<NA>", "nan")

# Sentences of the narrative.
NO_DATA = "No Gold storytelling data is available yet."
NO_PIECES = "Gold data loaded, but there is not enough information to build a narrative summary yet."
SENTIMENT_SENTENCE = "The dominant sentiment is %s."
SOURCE_SENTENCE = "The most active source is %s in %s."
KEYWORD_SENTENCE = "The most repeated keyword is '%s'."
GAP_SENTENCE = "The strongest critic-vs-audience gap appears for %s, where %s."
CRITICS_LOWER = "critics scored it lower than audiences"
CRITICS_HIGHER = "critics scored it higher than audiences"
TITLE_SENTENCE = "The most discussed title is %s."

TOP_KEYWORDS = 12


# --- quality -----------------------------------------------------------------


def governance_cards(facts: DataFrame) -> DataFrame:
    null_rate = F.when(F.col("kpi_type") == "null_rate", F.coalesce("value", F.lit(0.0)))
    return facts.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("family").alias("families"),
        F.count_distinct("metric_name").alias("metrics"),
        F.round(F.coalesce(F.avg(null_rate), F.lit(0.0)), 2).alias("avg_null_rate"),
        F.max("run_stamp").alias("last_run_stamp"),
    )


def null_rates(facts: DataFrame) -> DataFrame:
    label = label_text(F.col("family"), F.col("column_name"))
    return where_equal(facts, "kpi_type", "null_rate").select(label.alias("label"), "value").orderBy("value", "label")


def volumes(facts: DataFrame) -> DataFrame:
    total = where_equal(facts, "kpi_type", "volume")
    by_source = where_equal(facts, "kpi_type", "volume_by_source")
    label = F.concat_ws(" · ", F.coalesce("family", F.lit("unknown")), F.coalesce("metric_name", F.lit("volume")))
    return total.unionByName(by_source).select(label.alias("label"), "kpi_type", "value")


def compliance(facts: DataFrame) -> DataFrame:
    return where_equal(facts, "kpi_type", "schema_compliance").select(
        F.coalesce("family", F.lit("unknown")).alias("label"), "value"
    )


def outliers(facts: DataFrame) -> DataFrame:
    return (
        where_equal(facts, "kpi_type", "outlier_rate")
        .select(
            "family",
            F.coalesce("column_name", F.lit("unknown")).alias("column_name"),
            double_of(facts, "value").alias("value"),
        )
        .filter(F.col("value").isNotNull())
        .orderBy("value", "family", "column_name")
    )


def quality_summary(facts: DataFrame) -> DataFrame:
    columns = [c for c in ("family", "kpi_type", "metric_name", "column_name", "value", "unit", "computed_at",
                           "run_stamp")]
    return where_in(facts, "kpi_type", QUALITY_KINDS).select(*columns).orderBy("family", "kpi_type", "metric_name")


def last_updated(facts: DataFrame) -> DataFrame:
    newest = F.max(parse_timestamp(F.col("computed_at")))
    return facts.agg(F.date_format(newest, "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


# --- opinion -----------------------------------------------------------------


def sentiment_share(facts: DataFrame) -> DataFrame:
    upper = F.upper(F.coalesce("dimension_value", F.lit("UNKNOWN")))
    label = F.when(upper.isin(*UPPER_SENTINELS), "UNKNOWN").otherwise(upper)
    totals = (
        where_equal(facts, "aggregation_type", "sentiment_distribution")
        .select(label.alias("sentiment"), "value")
        .filter(F.col("sentiment").isin(*LABELS))
        .groupBy("sentiment")
        .agg(F.sum("value").alias("value"))
    )
    # three rows at most
    share = F.round(F.col("value") / F.sum("value").over(Window.partitionBy()) * 100, 2)
    return totals.withColumn("share", share).orderBy(F.col("value").desc(), "sentiment")


def sentiment_trend(facts: DataFrame, family: str) -> DataFrame:
    rows = where_equal(facts, "aggregation_type", "sentiment_trend").filter(F.col("family") == family)
    return (
        rows.select(
            F.try_to_date("dimension_value").alias("day"),
            sentiment_from_name(F.col("metric_name")).alias("sentiment"),
            double_of(facts, "value").alias("value"),
        )
        .filter(F.col("day").isNotNull() & F.col("value").isNotNull() & F.col("sentiment").isin(*LABELS))
        .groupBy("day", "sentiment")
        .agg(F.sum("value").alias("value"))
        .orderBy("day", "sentiment")
    )


def keywords(facts: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    rows = where_equal(facts, "aggregation_type", "top_keywords")
    named = rows.select(F.col("dimension_value").alias("keyword"), "family", "value")
    totals = meaningful_keywords(named, "keyword", "value").groupBy("keyword", "family").agg(
        F.sum("value").alias("value")
    )
    return totals.orderBy(F.col("value").desc(), "keyword", "family").limit(k)


def sources(facts: DataFrame) -> DataFrame:
    return (
        where_in(facts, "aggregation_type", SOURCE_KINDS)
        .groupBy(label_text(F.col("family"), F.col("dimension_value")).alias("label"), "family", "aggregation_type")
        .agg(F.sum("value").alias("value"))
        .orderBy("value", "label")
    )


def activity(facts: DataFrame) -> DataFrame:
    return (
        where_equal(facts, "aggregation_type", "volume_by_date")
        .withColumn("day", F.try_to_date("dimension_value"))
        .filter(F.col("day").isNotNull())
        .groupBy("day", "family")
        .agg(F.sum("value").alias("value"))
        .orderBy("day", "family")
    )


def evidence(facts: DataFrame) -> DataFrame:
    value = F.btrim("dimension_value")
    return (
        where_in(facts, "aggregation_type", EVIDENCE_KINDS)
        .withColumn("dimension_value", value)
        .filter(F.col("dimension_value").isNotNull() & ~F.col("dimension_value").isin(*HIDDEN_VALUES))
        .select("aggregation_type", "metric_name", "family", "dimension", "dimension_value", "value", "unit",
                "computed_at", "run_stamp")
        .orderBy("aggregation_type", "family", "metric_name")
    )


def story_cards(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("family").alias("families"),
        F.count_distinct("aggregation_type").alias("aggregations"),
        F.max("run_stamp").alias("last_run_stamp"),
    )


def narrative(facts: DataFrame) -> DataFrame:
    """One row with the summary sentences.

    Every candidate is tagged with the sentence it belongs to; one grouped sum
    and one arg-max per sentence give all of them in a single pass.
    """
    kind, dimension = F.col("aggregation_type"), F.col("dimension_value")
    letters = keyword_letters(dimension)
    sentence = (
        F.when((kind == "sentiment_distribution") & ~dimension.isin(*NARRATIVE_HIDDEN), "sentiment")
        .when(kind.isin(*SOURCE_KINDS), "source")
        .when((kind == "top_keywords") & (F.length(letters) >= 3) & ~letters.isin(*BANNED_KEYWORDS), "keyword")
        .when(kind == "critic_vs_audience", "gap")
        .when(kind == "top_titles_by_reviews", "title")
    )
    tagged = facts.select(
        sentence.alias("sentence"),
        F.when(sentence == "keyword", letters).otherwise(dimension).alias("name"),
        F.when(sentence == "source", F.col("family")).otherwise(F.lit("")).alias("family"),
        "value",
    )
    totals = tagged.groupBy("sentence", "name", "family").agg(
        F.sum("value").alias("total"),
        F.max_by("value", F.struct(F.abs("value"), F.col("value"))).alias("gap"),
        F.count(F.lit(1)).alias("facts"),
    )

    def best(tag: str, size: Column) -> Column:
        usable = (F.col("sentence") == tag) & F.col("name").isNotNull()
        order = F.struct(-size, F.col("name"), F.col("family"))
        return F.min_by(F.struct("name", "family", "gap"), F.when(usable, order))

    top = totals.agg(
        best("sentiment", F.col("total")).alias("sentiment"),
        best("source", F.col("total")).alias("source"),
        best("keyword", F.col("total")).alias("keyword"),
        best("gap", F.abs("gap")).alias("gap"),
        best("title", F.col("total")).alias("title"),
        F.coalesce(F.sum("facts"), F.lit(0)).alias("facts"),
    )
    direction = F.when(F.col("gap.gap") < 0, CRITICS_LOWER).otherwise(CRITICS_HIGHER)
    text = F.concat_ws(
        " ",
        F.when(F.col("sentiment").isNotNull(), F.printf(F.lit(SENTIMENT_SENTENCE), F.lower("sentiment.name"))),
        F.when(F.col("source").isNotNull(), F.printf(F.lit(SOURCE_SENTENCE), F.col("source.name"), F.col("source.family"))),
        F.when(F.col("keyword").isNotNull(), F.printf(F.lit(KEYWORD_SENTENCE), F.col("keyword.name"))),
        F.when(F.col("gap").isNotNull(), F.printf(F.lit(GAP_SENTENCE), F.col("gap.name"), direction)).when(
            F.col("title").isNotNull(), F.printf(F.lit(TITLE_SENTENCE), F.col("title.name"))
        ),
    )
    return top.select(
        F.when(F.col("facts") == 0, NO_DATA).when(text == "", NO_PIECES).otherwise(text).alias("narrative")
    )


def empty_facts(spark, governance: bool = False) -> DataFrame:
    return spark.createDataFrame([], GOVERNANCE_FACT if governance else STORY_FACT)
