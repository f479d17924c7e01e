"""Marts: what a dashboard shows, over the kinds of facts each of them reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from review_engine.operators import marts, storytelling as st
from review_engine.operators.shaping import BANNED_KEYWORDS
from review_engine.plans import gold, opinion, quality
from review_engine.plans.registry import query
from review_engine.plans.tables import RUN, SPECS, families, table

GOV = f"WITH facts AS ({quality.REPORT_SQL}) "
STO = f"WITH facts AS ({opinion.REPORT_SQL}) "


# --- quality -----------------------------------------------------------------


@query("mart_gov_cards", GOV + """
SELECT count(*) AS total_rows, count(DISTINCT family) AS families, count(DISTINCT metric_name) AS metrics,
       round(avg(value) FILTER (WHERE kpi_type = 'null_rate'), 2) AS avg_null_rate, max(run_stamp) AS last_run_stamp FROM facts""")
def mart_gov_cards(spark, folder):
    return marts.governance_cards(gold.governance(spark, folder))


@query("mart_null_rates", GOV + """
SELECT coalesce(family, 'unknown') || ' · ' || coalesce(column_name, 'unknown') AS label, value FROM facts WHERE kpi_type = 'null_rate'""")
def mart_null_rates(spark, folder):
    return marts.null_rates(gold.governance(spark, folder, "null_rate"))


@query("mart_volume", GOV + """
SELECT family || ' · ' || coalesce(metric_name, 'volume') AS label, kpi_type, value FROM facts
WHERE kpi_type IN ('volume', 'volume_by_source')""")
def mart_volume(spark, folder):
    return marts.volumes(gold.governance(spark, folder, "volume", "volume_by_source"))


@query("mart_compliance", GOV + "SELECT family AS label, value FROM facts WHERE kpi_type = 'schema_compliance'")
def mart_compliance(spark, folder):
    return marts.compliance(gold.governance(spark, folder, "schema_compliance"))


@query("mart_outliers", GOV + "SELECT family, column_name, value FROM facts WHERE kpi_type = 'outlier_rate' AND value IS NOT NULL")
def mart_outliers(spark, folder):
    return marts.outliers(gold.governance(spark, folder, "outlier_rate"))


@query("mart_quality_summary", GOV + f"""
SELECT family, kpi_type, metric_name, column_name, value, unit, computed_at, run_stamp FROM facts
WHERE kpi_type IN ({', '.join(f"'{k}'" for k in marts.QUALITY_KINDS)})""")
def mart_quality_summary(spark, folder):
    return marts.quality_summary(gold.governance(spark, folder, *marts.QUALITY_KINDS))


@query("mart_last_updated", """
SELECT strftime(max(o_orderdate + INTERVAL 3 HOUR), '%Y-%m-%d %H:%M:%S') AS last_updated FROM orders WHERE o_orderkey % 3 > 0""")
def mart_last_updated(spark, folder):
    """Each order states a time of its own; every third one is not a time."""
    stated = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T03:00:00"))
    text = F.when(F.col("o_orderkey") % 3 > 0, stated).otherwise("soon")
    return marts.last_updated(table(spark, folder, "orders").select(text.alias("computed_at")))


# --- opinion -----------------------------------------------------------------


@query("mart_sentiment_share", STO + """, labelled_facts AS (
  SELECT CASE WHEN upper(coalesce(dimension_value, 'UNKNOWN')) IN ('<NA>', 'NAN', 'NONE', '') THEN 'UNKNOWN'
              ELSE upper(coalesce(dimension_value, 'UNKNOWN')) END AS sentiment, value
  FROM facts WHERE aggregation_type = 'sentiment_distribution'),
totals AS (SELECT sentiment, sum(value) AS value FROM labelled_facts WHERE sentiment IN ('POSITIVE', 'NEGATIVE', 'NEUTRAL') GROUP BY 1)
SELECT sentiment, value, round(100.0 * value / sum(value) OVER (), 2) AS share FROM totals""")
def mart_sentiment_share(spark, folder):
    return marts.sentiment_share(gold.storytelling(spark, folder, "sentiment_distribution"))


@query("mart_sentiment_trend", STO + """
SELECT CAST(dimension_value AS DATE) AS day, regexp_extract(metric_name, '(POSITIVE|NEGATIVE|NEUTRAL)', 1) AS sentiment,
       sum(value) AS value FROM facts
WHERE aggregation_type = 'sentiment_trend' AND family = 'user_reviews' AND regexp_matches(metric_name, '(POSITIVE|NEGATIVE|NEUTRAL)')
GROUP BY 1, 2""")
def mart_sentiment_trend(spark, folder):
    return marts.sentiment_trend(gold.storytelling(spark, folder, "sentiment_trend"), "user_reviews")


BANNED_SQL = ", ".join(f"'{w}'" for w in BANNED_KEYWORDS)


@query("mart_keywords", STO + f""", named AS (
  SELECT regexp_replace(lower(trim(dimension_value)), '[^a-z]', '', 'g') AS keyword, family, value
  FROM facts WHERE aggregation_type = 'top_keywords')
SELECT keyword, family, sum(value) AS value FROM named WHERE length(keyword) >= 3 AND keyword NOT IN ({BANNED_SQL})
GROUP BY 1, 2 ORDER BY value DESC, keyword, family LIMIT 12""")
def mart_keywords(spark, folder):
    return marts.keywords(gold.storytelling(spark, folder, "top_keywords"))


@query("mart_sources", STO + """
SELECT coalesce(family, 'unknown') || ' · ' || coalesce(dimension_value, 'unknown') AS label, family, aggregation_type,
       sum(value) AS value FROM facts WHERE aggregation_type IN ('source_volume', 'volume_by_source') GROUP BY 1, 2, 3""")
def mart_sources(spark, folder):
    return marts.sources(gold.storytelling(spark, folder, *marts.SOURCE_KINDS))


@query("mart_activity", STO + """
SELECT CAST(dimension_value AS DATE) AS day, family, sum(value) AS value FROM facts
WHERE aggregation_type = 'volume_by_date' GROUP BY 1, 2""")
def mart_activity(spark, folder):
    return marts.activity(gold.storytelling(spark, folder, "volume_by_date"))


@query("mart_evidence", STO + f"""
SELECT aggregation_type, metric_name, family, dimension, trim(dimension_value) AS dimension_value, value, unit, computed_at, run_stamp
FROM facts WHERE aggregation_type IN ({', '.join(f"'{k}'" for k in marts.EVIDENCE_KINDS)})
  AND trim(dimension_value) NOT IN ('<NA>', 'nan', 'None', 'UNKNOWN', '')""")
def mart_evidence(spark, folder):
    return marts.evidence(gold.storytelling(spark, folder, *marts.EVIDENCE_KINDS))


@query("mart_sto_cards", STO + """
SELECT count(*) AS total_rows, count(DISTINCT family) AS families, count(DISTINCT aggregation_type) AS aggregations,
       max(run_stamp) AS last_run_stamp FROM facts""")
def mart_sto_cards(spark, folder):
    return marts.story_cards(gold.storytelling(spark, folder))


def narrative_sql(facts: str) -> str:
    return facts + f"""
, sentiment AS (SELECT dimension_value AS d FROM facts WHERE aggregation_type = 'sentiment_distribution'
    AND dimension_value NOT IN ('<NA>', 'nan') GROUP BY 1 ORDER BY sum(value) DESC, 1 LIMIT 1),
source AS (SELECT dimension_value AS d, family AS f FROM facts WHERE aggregation_type IN ('source_volume', 'volume_by_source')
    AND dimension_value IS NOT NULL GROUP BY 1, 2 ORDER BY sum(value) DESC, 1, 2 LIMIT 1),
keyword AS (SELECT regexp_replace(lower(dimension_value), '[^a-z]', '', 'g') AS d, value FROM facts WHERE aggregation_type = 'top_keywords'),
top_keyword AS (SELECT d FROM keyword WHERE length(d) >= 3 AND d NOT IN ({BANNED_SQL}) GROUP BY 1 ORDER BY sum(value) DESC, 1 LIMIT 1),
gap AS (SELECT dimension_value AS d, value FROM facts WHERE aggregation_type = 'critic_vs_audience' ORDER BY abs(value) DESC, 1 LIMIT 1),
title AS (SELECT dimension_value AS d FROM facts WHERE aggregation_type = 'top_titles_by_reviews' AND dimension_value IS NOT NULL
    GROUP BY 1 ORDER BY sum(value) DESC, 1 LIMIT 1)
SELECT concat_ws(' ',
  (SELECT 'The dominant sentiment is ' || lower(d) || '.' FROM sentiment),
  (SELECT 'The most active source is ' || d || ' in ' || f || '.' FROM source),
  (SELECT 'The most repeated keyword is ''' || d || '''.' FROM top_keyword),
  coalesce(
    (SELECT 'The strongest critic-vs-audience gap appears for ' || d || ', where critics scored it ' ||
            CASE WHEN value < 0 THEN 'lower' ELSE 'higher' END || ' than audiences.' FROM gap),
    (SELECT 'The most discussed title is ' || d || '.' FROM title))) AS narrative"""


@query("mart_narrative", narrative_sql(STO))
def mart_narrative(spark, folder):
    return marts.narrative(gold.storytelling(spark, folder, *marts.NARRATIVE_KINDS))


NO_GAP_SQL = "WITH facts AS (" + opinion.with_ctes(
    opinion.distribution_sql("dated_reviews"), opinion.reviewed_titles_sql("dated_reviews")) + ")"


@query("mart_narrative_titles", narrative_sql(NO_GAP_SQL))
def mart_narrative_titles(spark, folder):
    """Without score gaps the most discussed title closes the narrative."""
    name = "dated_reviews"
    df, spec = families(spark, folder, (name,))[name], SPECS[name]
    return marts.narrative(
        st.activity(df, spec, RUN, ("distribution",)).unionByName(st.top_titles_by_reviews(df, spec, RUN)))
