"""Opinion facts, sentiment and keywords."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.operators import sentiment, storytelling as st
from review_engine.plans.registry import query
from review_engine.plans.tables import (
    FAMILIES,
    FAMILY_SQL,
    RUN,
    SPECS,
    WORDS,
    critic_reviews,
    dated_reviews,
    families,
    table,
    titles,
    user_reviews,
)
from review_engine.session import small_table

# A small lexicon for the driver's invented texts: (word, polarity, intensity).
LEXICON = [
    ("the", 0.3, None), ("and", -0.2, None), ("that", 0.5, None), ("was", -0.4, None), ("der", 0.4, None),
    ("und", -0.6, None), ("les", -0.5, None), ("une", 0.2, None), ("los", 0.6, None), ("para", -0.3, None),
    ("with", None, 1.5), ("for", None, 0.5), ("this", None, -0.5), ("des", None, -0.5), ("las", None, 1.3),
]
LEXICON_SQL = "lexicon(word, polarity, intensity) AS (VALUES " + ", ".join(
    f"('{w}', CAST({'NULL' if p is None else p} AS DOUBLE), CAST({'NULL' if i is None else i} AS DOUBLE))"
    for w, p, i in LEXICON
) + ")"


def lexicon(spark: SparkSession) -> DataFrame:
    return small_table(spark, "word string, polarity double, intensity double", LEXICON)


def labelled_families(spark: SparkSession, folder: str, kinds: tuple[str, ...] = st.KINDS) -> dict[str, DataFrame]:
    """The families; critics are labelled by text, as their source has no labels, where a kind reads labels."""
    frames = families(spark, folder)
    if st.needs_labels(frames["critic_reviews"], SPECS["critic_reviews"], kinds):
        frames["critic_reviews"] = st.with_labels(frames["critic_reviews"], "review_id", lexicon(spark))
    return frames


# --- the facts in SQL --------------------------------------------------------


def story(kind: str, metric: str, dimension: str, dimension_value: str, family: str, value: str, unit: str,
          source: str) -> str:
    return (
        f"SELECT '{kind}' AS aggregation_type, {metric} AS metric_name, '{dimension}' AS dimension, "
        f"CAST({dimension_value} AS VARCHAR) AS dimension_value, '{family}' AS family, CAST({value} AS DOUBLE) AS value, "
        f"'{unit}' AS unit, '{RUN.computed_at}' AS computed_at, '{RUN.run_stamp}' AS run_stamp FROM {source}"
    )


# Labels from text: each token with the token before it.
POLARITY_CTES = rf"""{LEXICON_SQL},
words AS (
  SELECT review_id, regexp_extract_all(lower(review_text_clean), '{WORDS}') AS w FROM critic_reviews),
tokens AS (
  SELECT review_id, unnest(w) AS word, unnest(list_prepend(NULL, w[:-2])) AS before FROM words),
scored AS (
  SELECT review_id, avg(r.polarity * coalesce(s.intensity, 1.0)) AS mean
  FROM tokens t LEFT JOIN lexicon r ON t.word = r.word AND r.polarity IS NOT NULL
                LEFT JOIN lexicon s ON t.before = s.word AND s.intensity IS NOT NULL
  GROUP BY review_id),
polarities AS (
  SELECT c.review_id, round(coalesce(mean, 0.0), 6) + 0.0 AS polarity
  FROM critic_reviews c LEFT JOIN scored s ON c.review_id = s.review_id),
labelled AS (
  SELECT review_id, polarity, CASE WHEN polarity >= 0.1 THEN 'POSITIVE' WHEN polarity <= -0.1 THEN 'NEGATIVE'
                                   ELSE 'NEUTRAL' END AS sentiment_label
  FROM polarities),
critics_labelled AS (
  SELECT c.* REPLACE (coalesce(c.sentiment_label, l.sentiment_label) AS sentiment_label)
  FROM critic_reviews c JOIN labelled l ON c.review_id = l.review_id)
"""
STORY_SQL = f"{FAMILY_SQL}, {POLARITY_CTES}"
RELATION = {f: f for f in FAMILIES} | {"critic_reviews": "critics_labelled"}


def groups(name: str, select: str) -> str:
    return f"({select}) AS {name}"


def distribution_sql(f: str) -> str:
    source = groups("d", f"SELECT coalesce(sentiment_label, 'UNKNOWN') AS label, count(*) AS n FROM {RELATION[f]} GROUP BY 1")
    return story("sentiment_distribution", f"'{SPECS[f].prefix}_sentiment_' || label", "sentiment_label", "label", f,
                 "n", "count", source)


def trend_sql(f: str) -> str:
    source = groups("t", "SELECT strftime(CAST(review_date AS DATE), '%Y-%m-%d') AS day, "
                         f"coalesce(sentiment_label, 'UNKNOWN') AS label, count(*) AS n FROM {RELATION[f]} GROUP BY 1, 2")
    return story("sentiment_trend", f"'{SPECS[f].prefix}_sentiment_trend_' || day || '_' || label", "day", "day", f,
                 "n", "count", source)


def volume_sql(f: str) -> str:
    source = groups("v", f"SELECT strftime(CAST(review_date AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM {f} "
                         "WHERE review_date IS NOT NULL GROUP BY 1")
    return story("volume_by_date", f"'{SPECS[f].prefix}_volume_' || day", "date", "day", f, "n", "count", source)


def rating_sql(f: str) -> str:
    p = SPECS[f].prefix
    source = groups("r", f"SELECT avg(rating) AS mean FROM {f} HAVING avg(rating) IS NOT NULL")
    return story("avg_rating_by_source", f"'{p}_avg_rating'", "source", f"'{p}'", f, "round(mean, 2)", "score", source)


def rating_trend_sql(f: str) -> str:
    source = groups("rt", "SELECT strftime(CAST(review_date AS DATE), '%Y-%m-%d') AS day, avg(rating) AS mean "
                          f"FROM {f} GROUP BY 1 ORDER BY 1 NULLS LAST LIMIT 10")
    return story("sentiment_trend", f"'{SPECS[f].prefix}_sentiment_trend_' || day", "day", "day", f,
                 "round(coalesce(mean, 0.0), 2)", "score", source)


def gap_sql(f: str) -> str:
    source = groups("g", f"SELECT canonical_title, avg(critics_score) AS c, avg(audience_score) AS a FROM {f} "
                         "GROUP BY 1 ORDER BY 1 NULLS LAST LIMIT 10")
    return story("critic_vs_audience", f"'{SPECS[f].prefix}_critic_vs_audience_' || canonical_title",
                 "canonical_title", "canonical_title", f, "round(coalesce(c, 0.0) - coalesce(a, 0.0), 2)",
                 "score_delta", source)


def keywords_sql(f: str) -> str:
    source = groups("k", "SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all("
                         f"lower(review_text_clean), '{WORDS}')) AS token FROM {f}) GROUP BY 1 ORDER BY n DESC, token LIMIT 10")
    return story("top_keywords", f"'{SPECS[f].prefix}_top_keyword_' || token", "keyword", "token", f, "n", "count", source)


def source_sql(f: str, kind: str = "source_volume") -> str:
    prefix = f"{SPECS[f].prefix}_source_volume_" if kind == "source_volume" else f"{f}_volume_"
    source = groups("s", f"SELECT source AS src, count(*) AS n FROM {f} GROUP BY 1")
    return story(kind, f"'{prefix}' || coalesce(src, 'unknown')", "source", "src", f, "n", "count", source)


def top_sql(f: str, column: str, kind: str, label: str, k: int) -> str:
    source = groups("tc", f"SELECT {column} AS item, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {column}) "
                          f"AS rank FROM {f} GROUP BY 1 QUALIFY rank <= {k}")
    return story(kind, f"'{label}_rank_' || rank", column, "item", f, "n", "count", source)


def reviewers_sql(f: str) -> str:
    return top_sql(f, "reviewer_name", "top_reviewers", f"{SPECS[f].prefix}_reviewer", 10)


def reviewed_titles_sql(f: str) -> str:
    return top_sql(f, "canonical_title", "top_titles_by_reviews", f"{SPECS[f].prefix}_title", 15)


def release_sql(f: str) -> str:
    source = groups("y", f"SELECT release_year, count(*) AS n FROM {f} GROUP BY 1 ORDER BY 1 NULLS LAST LIMIT 10")
    return story("release_period", f"'{SPECS[f].prefix}_release_period_' || release_year", "release_year",
                 "release_year", f, "n", "count", source)


def rated_titles_sql(f: str) -> str:
    source = groups("rr", "SELECT canonical_title, vote_average, row_number() OVER (ORDER BY vote_average DESC, "
                          f"canonical_title, source_id) AS rank FROM {f} WHERE vote_average IS NOT NULL QUALIFY rank <= 15")
    return story("top_titles_by_rating", f"'{SPECS[f].prefix}_rank_' || rank", "canonical_title", "canonical_title", f,
                 "vote_average", "score", source)


def popularity_sql(f: str) -> str:
    source = groups("p", f"SELECT avg(popularity) AS mean FROM {f} HAVING avg(popularity) IS NOT NULL")
    return story("avg_popularity", f"'{f}_avg_popularity'", "global", "'all'", f, "round(mean, 2)", "score", source)


def definitions_sql(source: str) -> list[str]:
    return [
        story("definition", f"'storytelling_definition_{suffix}'", dimension, f"'{text}'", "dashboard", "1.0",
              "definition", source)
        for suffix, dimension, text in st.DEFINITIONS
    ]


def with_ctes(*selects: str) -> str:
    return STORY_SQL + "\nUNION ALL\n".join(selects)


ONE_ROW = "(SELECT 1) AS once"
REPORT_SELECTS = [
    distribution_sql("critic_reviews"), gap_sql("critic_reviews"), keywords_sql("critic_reviews"),
    source_sql("critic_reviews"),
    distribution_sql("user_reviews"), trend_sql("user_reviews"), volume_sql("user_reviews"), rating_sql("user_reviews"),
    source_sql("user_reviews"), reviewers_sql("user_reviews"),
    distribution_sql("dated_reviews"), volume_sql("dated_reviews"), rating_sql("dated_reviews"),
    rating_trend_sql("dated_reviews"), reviewed_titles_sql("dated_reviews"),
    release_sql("titles"), rated_titles_sql("titles"), source_sql("titles", "volume_by_source"), popularity_sql("titles"),
    *definitions_sql(ONE_ROW),
]
REPORT_SQL = with_ctes(*REPORT_SELECTS)


# --- the queries -------------------------------------------------------------


@query("sto_sentiment_distribution", with_ctes(distribution_sql("user_reviews"), distribution_sql("dated_reviews")))
def sto_sentiment_distribution(spark, folder):
    parts = families(spark, folder, ("user_reviews", "dated_reviews"))
    return reduce(DataFrame.unionByName, [st.activity(df, SPECS[n], RUN, ("distribution",)) for n, df in parts.items()])


@query("sto_sentiment_trend", with_ctes(trend_sql("user_reviews")))
def sto_sentiment_trend(spark, folder):
    return st.activity(user_reviews(spark, folder), SPECS["user_reviews"], RUN, ("trend",))


@query("sto_rating_trend", with_ctes(rating_trend_sql("user_reviews"), rating_trend_sql("dated_reviews")))
def sto_rating_trend(spark, folder):
    parts = families(spark, folder, ("user_reviews", "dated_reviews"))
    return reduce(DataFrame.unionByName, [st.rating_trend(df, SPECS[n], RUN) for n, df in parts.items()])


@query("sto_score_delta", with_ctes(gap_sql("critic_reviews")))
def sto_score_delta(spark, folder):
    return st.critic_vs_audience(critic_reviews(spark, folder), SPECS["critic_reviews"], RUN)


@query("sto_top_keywords", with_ctes(keywords_sql("critic_reviews")))
def sto_top_keywords(spark, folder):
    return st.top_keywords(critic_reviews(spark, folder), SPECS["critic_reviews"], RUN)


@query("sto_source_volume", with_ctes(source_sql("critic_reviews"), source_sql("user_reviews")))
def sto_source_volume(spark, folder):
    parts = families(spark, folder, ("critic_reviews", "user_reviews"))
    return reduce(DataFrame.unionByName, [st.source_volume(df, SPECS[n], RUN) for n, df in parts.items()])


@query("sto_top_reviewers", with_ctes(reviewers_sql("dated_reviews")))
def sto_top_reviewers(spark, folder):
    return st.top_reviewers(dated_reviews(spark, folder), SPECS["dated_reviews"], RUN)


@query("sto_volume_by_date", with_ctes(volume_sql("dated_reviews"), volume_sql("user_reviews")))
def sto_volume_by_date(spark, folder):
    parts = families(spark, folder, ("dated_reviews", "user_reviews"))
    return reduce(DataFrame.unionByName, [st.activity(df, SPECS[n], RUN, ("volume",)) for n, df in parts.items()])


@query("sto_avg_rating", with_ctes(rating_sql("user_reviews"), rating_sql("dated_reviews")))
def sto_avg_rating(spark, folder):
    parts = families(spark, folder, ("user_reviews", "dated_reviews"))
    return reduce(DataFrame.unionByName, [st.activity(df, SPECS[n], RUN, ("rating",)) for n, df in parts.items()])


@query("sto_activity", with_ctes(distribution_sql("user_reviews"), trend_sql("user_reviews"),
                                 volume_sql("user_reviews"), rating_sql("user_reviews")))
def sto_activity(spark, folder):
    """Distribution, trend, volume and rating from one scan."""
    return st.activity(user_reviews(spark, folder), SPECS["user_reviews"], RUN)


@query("sto_release_period", with_ctes(release_sql("titles")))
def sto_release_period(spark, folder):
    return st.release_period(titles(spark, folder), SPECS["titles"], RUN)


@query("sto_top_titles_rating", with_ctes(rated_titles_sql("titles")))
def sto_top_titles_rating(spark, folder):
    return st.top_titles_by_rating(titles(spark, folder), SPECS["titles"], RUN)


@query("sto_titles_by_source", with_ctes(source_sql("titles", "volume_by_source")))
def sto_titles_by_source(spark, folder):
    return st.source_volume(titles(spark, folder), SPECS["titles"], RUN, "volume_by_source")


@query("sto_avg_popularity", with_ctes(popularity_sql("titles")))
def sto_avg_popularity(spark, folder):
    return st.avg_popularity(titles(spark, folder), SPECS["titles"], RUN)


@query("sto_top_titles_reviews", f"""
SELECT 'top_titles_by_reviews' AS aggregation_type, 'line_title_rank_' || rank AS metric_name,
       'canonical_title' AS dimension, title AS dimension_value, 'lineitem' AS family, CAST(n AS DOUBLE) AS value,
       'count' AS unit, '{RUN.computed_at}' AS computed_at, '{RUN.run_stamp}' AS run_stamp
FROM (SELECT 'part ' || l_partkey AS title, count(*) AS n,
             row_number() OVER (ORDER BY count(*) DESC, 'part ' || l_partkey) AS rank
      FROM lineitem GROUP BY 1 QUALIFY rank <= 15)""")
def sto_top_titles_reviews(spark, folder):
    title = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    reviews = table(spark, folder, "lineitem").select(title.alias("canonical_title"))
    spec = st.FamilySpec("lineitem", "user", "line")
    return st.top_titles_by_reviews(reviews, spec, RUN)


@query("sto_definitions", FAMILY_SQL + "\nUNION ALL\n".join(
    definitions_sql("(SELECT count(*) AS n FROM dated_reviews HAVING count(*) > 0) AS present")))
def sto_definitions(spark, folder):
    present = dated_reviews(spark, folder).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    return st.definitions(present, RUN)


def report(spark: SparkSession, folder: str, kinds: tuple[str, ...] = st.KINDS) -> DataFrame:
    return st.storytelling_report(spark, labelled_families(spark, folder, kinds), SPECS, RUN, kinds)


@query("storytelling_report", REPORT_SQL)
def storytelling_report(spark, folder):
    return report(spark, folder)


# --- text --------------------------------------------------------------------


@query("nlp_sentiment", f"{STORY_SQL} SELECT review_id, polarity, sentiment_label FROM labelled")
def nlp_sentiment(spark, folder):
    return sentiment.polarity(critic_reviews(spark, folder), "review_id", "review_text_clean", lexicon(spark))


@query("nlp_fill_labels", f"{STORY_SQL} SELECT review_id, sentiment_label FROM critics_labelled")
def nlp_fill_labels(spark, folder):
    filled = st.with_labels(critic_reviews(spark, folder), "review_id", lexicon(spark))
    return filled.select("review_id", "sentiment_label")


@query("nlp_fill_labels_by_row", f"""{STORY_SQL}
SELECT c.review_id, CASE WHEN q.quality = 1 THEN 'POSITIVE' ELSE c.sentiment_label END AS sentiment_label
FROM critics_labelled c LEFT JOIN labels q ON c.review_id = q.doc_id""")
def nlp_fill_labels_by_row(spark, folder):
    reviews = critic_reviews(spark, folder).withColumn("sentiment_label", F.when(F.col("critics_score") == 100, "POSITIVE"))
    filled = sentiment.fill_labels(reviews, "review_id", "review_text_clean", lexicon(spark), fill="row")
    return filled.select("review_id", "sentiment_label")


@query("nlp_top_bigrams", rf"""
WITH words AS (SELECT regexp_extract_all(lower(text), '{WORDS}') AS w FROM documents),
pairs AS (SELECT unnest(w[:-2]) || ' ' || unnest(w[2:]) AS ngram FROM words WHERE len(w) >= 2)
SELECT ngram, count(*) AS mentions FROM pairs GROUP BY 1 ORDER BY mentions DESC, ngram LIMIT 10""")
def nlp_top_bigrams(spark, folder):
    return sentiment.top_ngrams(table(spark, folder, "documents"), "text", 10)
