"""Quality and opinion facts, marts and validation on small frames."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from review_engine.operators import extraction, governance as g, marts, sentiment, shaping, storytelling as st, validation as v
from review_engine.schemas import GOVERNANCE_FACT, SILVER_SPECS, STORY_FACT, FamilySpec
from review_engine.session import small_table

RUN = g.Run("20250101_000000", "2025-01-01T00:00:00")
SPEC = FamilySpec("fam", "critic", "rt", ("k",), ("x",), ("canonical_title", "need"))


def values(df, kpi):
    return {r.metric_name: r.value for r in df.filter(F.col("kpi_type") == kpi).collect()}


def test_profile(spark):
    df = small_table(spark, "canonical_title string, need string, some_text string, review_date string", [
        ("a", "x", "abc", "2024-01-01"), ("b", None, None, "2024-01-01T10:00:00"), ("c", "y", "", "2024-01-03"),
        ("d", "z", "ab", "bad")])
    facts = g.profile(df, SPEC, RUN, with_mean=True)
    assert facts.schema.simpleString() == GOVERNANCE_FACT.simpleString()
    assert values(facts, "null_rate")["null_rate_fam_need"] == 25.0
    assert values(facts, "schema_compliance") == {"schema_compliance_rate_fam": 75.0}
    assert values(facts, "text_statistics") == {
        "min_text_length_fam_some_text": 0.0, "max_text_length_fam_some_text": 3.0, "mean_text_length_fam_some_text": 1.25}
    assert values(facts, "ingestion_frequency") == {"ingestion_frequency_compliance_fam": 66.67}
    assert values(facts, "volume") == {"total_records_fam": 4.0}
    assert len(values(facts, "definition")) == 8


def test_empty_family(spark):
    df = small_table(spark, "canonical_title string, k string, x double, source string, review_date string", [("a", "b", 1.0, "s", "d")]).limit(0)
    facts = g.governance_report(spark, {"fam": df}, {"fam": SPEC}, RUN)
    assert set(values(facts, "null_rate").values()) == {0.0}
    assert values(facts, "duplicates") == {"duplicate_rate_fam": 0.0}
    for kpi in ("text_statistics", "schema_compliance", "ingestion_frequency", "outlier_rate"):
        assert values(facts, kpi) == {}
    assert len(values(facts, "definition")) == 8
    assert g.governance_report(spark, {"fam": None}, {"fam": SPEC}, RUN).schema == GOVERNANCE_FACT


def test_duplicates_and_sources(spark):
    df = small_table(spark, "k string, source string", [("a", "s"), ("a", None), ("b", "s"), (None, "s"), (None, "it's")])
    assert values(g.duplicate_rate(df, SPEC, RUN), "duplicates") == {"duplicate_rate_fam": 33.33}
    assert values(g.volume_by_source(df, SPEC, RUN), "volume_by_source") == {
        "volume_fam_s": 3.0, "volume_fam_UNKNOWN": 1.0, "volume_fam_it's": 1.0}
    assert g.duplicate_rate(df.drop("k"), SPEC, RUN) is None
    assert g.volume_by_source(df.drop("source"), SPEC, RUN) is None
    # validation counts rows with NULL keys as equal to each other
    assert v.duplicates("d", df, ["k", "absent"]).first().duplicate_rows == 2


@pytest.mark.parametrize("rows, expected", [
    ([1.0, 2.0, 3.0, 4.0, 100.0], {"outlier_rate_fam_x": 20.0}),
    ([1.0, 2.0, 100.0], {}),
    ([5.0] * 6, {}),
])
def test_outliers(spark, rows, expected):
    df = small_table(spark, "x double", [(x,) for x in rows])
    text = df.select(F.col("x").cast("string").alias("x")).unionByName(small_table(spark, "x string", [("7.1, 8.2",)]))
    for frame in (df, text):  # a merged cell is not a number
        assert values(g.outlier_rates({"fam": frame}, {"fam": SPEC}, RUN), "outlier_rate") == expected
        if len(rows) < 6:
            facts = g.approx_outlier_rate(frame, SPEC, RUN)
            assert (values(facts, "outlier_rate") if facts is not None else {}) == expected
    assert g.outlier_rates({"fam": df.select(F.lit("a").alias("k"))}, {"fam": SPEC}, RUN) is None


def test_profile_by_source_equals_its_parts(spark):
    rows = [(f"t{i % 3}", None if i % 4 else "n", "x" * (i % 5), None if i % 7 == 0 else f"2024-01-{1 + i % 9:02}", ["s", None, "it's"][i % 3])
            for i in range(40)]
    df = small_table(spark, "canonical_title string, need string, some_text string, review_date string, source string", rows)
    for frame in (df, df.drop("review_date"), df.limit(0)):
        apart = g.profile(frame, SPEC, RUN).unionByName(g.volume_by_source(frame, SPEC, RUN)).collect()
        assert sorted(map(str, g.profile_by_source(frame, SPEC, RUN).collect())) == sorted(map(str, apart))


def test_only_kinds_asked_for_are_built(spark):
    df = small_table(spark, "canonical_title string, k string, x double, source string, review_date string", [("a", "b", 1.0, "s", "d")])
    for kind in g.KINDS:
        facts = g.governance_report(spark, {"fam": df}, {"fam": SPEC}, RUN, kinds=(kind,))
        assert {r.kpi_type for r in facts.collect()} <= {kind}


REVIEWS = [("2024-01-02", "POSITIVE", "8", "p"), ("2024-01-02", None, "bad", None), (None, "NEGATIVE", None, "p")]


def test_activity(spark):
    df = small_table(spark, "review_date string, sentiment_label string, rating string, source string", REVIEWS)
    facts = st.activity(df, SPEC, RUN)
    assert facts.schema.simpleString() == STORY_FACT.simpleString()
    got = {(r.aggregation_type, r.metric_name): (r.dimension_value, r.value) for r in facts.collect()}
    assert got == {
        ("sentiment_distribution", "rt_sentiment_POSITIVE"): ("POSITIVE", 1.0),
        ("sentiment_distribution", "rt_sentiment_NEGATIVE"): ("NEGATIVE", 1.0),
        ("sentiment_distribution", "rt_sentiment_UNKNOWN"): ("UNKNOWN", 1.0),
        ("sentiment_trend", "rt_sentiment_trend_2024-01-02_POSITIVE"): ("2024-01-02", 1.0),
        ("sentiment_trend", "rt_sentiment_trend_2024-01-02_UNKNOWN"): ("2024-01-02", 1.0),
        ("sentiment_trend", "rt_sentiment_trend_unknown_NEGATIVE"): (None, 1.0),
        ("volume_by_date", "rt_volume_2024-01-02"): ("2024-01-02", 2.0),
        ("avg_rating_by_source", "rt_avg_rating"): ("rt", 8.0),
    }
    assert st.activity(df.select("source"), SPEC, RUN) is None
    only = st.activity(df.drop("review_date"), SPEC, RUN, ("distribution", "trend", "volume"))
    assert {r.aggregation_type for r in only.collect()} == {"sentiment_distribution"}


def test_gap_counts_a_missing_score_as_zero(spark):
    df = small_table(spark, "canonical_title string, critics_score double, audience_score double",
                     [("b", 90.0, None), ("a", 10.0, 30.5), ("a", 20.0, 30.5)])
    got = [(r.dimension_value, r.value) for r in st.critic_vs_audience(df, SPEC, RUN).collect()]
    assert got == [("a", -15.5), ("b", 90.0)]


def test_rating_trend_and_rankings(spark):
    df = small_table(spark, "review_date string, rating double, canonical_title string", [
        ("2024-01-02", 2.0, "t"), ("2024-01-01", None, "t"), ("2024-01-02", 3.0, "s"), ("2024-01-03", 9.0, "t")])
    got = [(r.dimension_value, r.value) for r in st.rating_trend(df, SPEC, RUN, k=2).collect()]
    assert got == [("2024-01-01", 0.0), ("2024-01-02", 2.5)]
    top = [(r.metric_name, r.dimension_value, r.value) for r in st.top_titles_by_reviews(df, SPEC, RUN).collect()]
    assert top == [("rt_title_rank_1", "t", 3.0), ("rt_title_rank_2", "s", 1.0)]


def test_report_of_nothing_has_definitions_only(spark):
    facts = st.storytelling_report(spark, {"titles": None}, SILVER_SPECS, RUN)
    assert facts.schema.names == STORY_FACT.names and facts.count() == 7


LEXICON = [("good", 0.5, None), ("bad", -0.6, None), ("very", None, 1.5), ("not", None, -0.5)]


def test_polarity(spark):
    lexicon = small_table(spark, "word string, polarity double, intensity double", LEXICON)
    docs = small_table(spark, "id int, t string", [
        (1, "Very good. Not bad!"), (2, "bad"), (3, "nothing"), (4, None), (5, "good good bad"), (6, "very")])
    got = {r.id: (r.polarity, r.sentiment_label) for r in sentiment.polarity(docs, "id", "t", lexicon).collect()}
    assert got == {1: (0.525, "POSITIVE"), 2: (-0.6, "NEGATIVE"), 3: (0.0, "NEUTRAL"), 4: (0.0, "NEUTRAL"),
                   5: (0.133333, "POSITIVE"), 6: (0.0, "NEUTRAL")}


def test_fill_labels(spark):
    lexicon = small_table(spark, "word string, polarity double, intensity double", LEXICON)
    docs = small_table(spark, "id int, t string, sentiment_label string", [(1, "good", None), (2, "bad", "POSITIVE")])
    labels = lambda df: {r.id: r.sentiment_label for r in df.collect()}
    assert labels(sentiment.fill_labels(docs, "id", "t", lexicon)) == {1: None, 2: "POSITIVE"}
    assert labels(sentiment.fill_labels(docs, "id", "t", lexicon, fill="row")) == {1: "POSITIVE", 2: "POSITIVE"}
    bare = docs.drop("sentiment_label")
    assert labels(sentiment.fill_labels(bare, "id", "t", lexicon)) == {1: "POSITIVE", 2: "NEGATIVE"}


def test_ngrams(spark):
    docs = small_table(spark, "t string", [("one two one two",), ("alone",), (None,)])
    got = {r.ngram: r.mentions for r in sentiment.ngram_counts(docs, "t").collect()}
    assert got == {"one two": 2, "two one": 1}
    assert {r.ngram for r in sentiment.ngram_counts(docs, "t", 3).collect()} == {"one two one", "two one two"}


@pytest.mark.parametrize("spread", [0.0, 2.0])
@pytest.mark.parametrize("k, n, buckets", [(1, 2, 1 << 16), (1, 2, 256), (3, 2, 512), (2, 3, 256), (10, 2, 2), (5000, 2, 1 << 16)])
def test_top_ngrams_are_those_of_all_counts(spark, spread, k, n, buckets):
    """Also where the counts are even, so that buckets beyond the heaviest hold some of the top, and where names decide."""
    rand = random.Random(f"{spread} {k} {n} {buckets}")
    texts = [" ".join(f"w{int(60 * rand.random() ** (1 + spread)):02}" for _ in range(rand.randrange(30))) for _ in range(200)]
    docs = small_table(spark, "t string", [*((t,) for t in texts), (None,), ("",), ("alone",), ("w01 w02",)])
    counts = Counter(" ".join(w[i:i + n]) for t in [*texts, "w01 w02"] for w in [t.split()] for i in range(len(w) - n + 1))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    got = sentiment.top_ngrams(docs, "t", k, n, buckets)
    assert [tuple(r) for r in got.collect()] == top


@pytest.mark.parametrize("k", [2, 7])
def test_top_ngrams_of_light_buckets_are_found(spark, k):
    """Heavy buckets hold many pairs of one mention each, and the top pairs are elsewhere."""
    twice = [(f"twice n{i}n",) for i in range(5)] * 2
    docs = small_table(spark, "t string", [*((f"a{i:04} b{i:04}",) for i in range(4000)), *twice])
    top = [*((f"twice n{i}n", 2) for i in range(5)), ("a0000 b0000", 1), ("a0001 b0001", 1)][:k]
    assert [tuple(r) for r in sentiment.top_ngrams(docs, "t", k, buckets=1024).collect()] == top


def story(spark, rows):
    full = [(k, f"m_{d}", "x", d, f, val, "u", "2025-01-01T00:00:00", "s") for k, d, f, val in rows]
    return small_table(spark, STORY_FACT, full)


def narrative(spark, rows):
    return marts.narrative(story(spark, rows) if rows else marts.empty_facts(spark)).first().narrative


def test_narrative(spark):
    assert narrative(spark, []) == marts.NO_DATA
    assert narrative(spark, [("other", "d", "f", 1.0)]) == marts.NO_PIECES
    rows = [("sentiment_distribution", "POSITIVE", "f", 1.0), ("sentiment_distribution", "NEGATIVE", "f", 3.0),
            ("sentiment_distribution", "<NA>", "f", 9.0), ("source_volume", "s1", "f", 2.0), ("volume_by_source", "s2", "t", 5.0),
            ("top_keywords", "the", "f", 9.0), ("top_keywords", "Plot2", "f", 3.0), ("top_keywords", "plot", "g", 1.0),
            ("critic_vs_audience", "up", "f", 4.0), ("critic_vs_audience", "down", "f", -7.0),
            ("top_titles_by_reviews", "t", "f", 2.0)]
    assert narrative(spark, rows) == (
        "The dominant sentiment is negative. The most active source is s2 in t. The most repeated keyword is 'plot'. "
        "The strongest critic-vs-audience gap appears for down, where critics scored it lower than audiences.")
    assert narrative(spark, rows[-1:]) == "The most discussed title is t."


def test_marts_on_empty_facts(spark):
    facts = marts.empty_facts(spark)
    for mart in (marts.sentiment_share, marts.keywords, marts.sources, marts.activity, marts.evidence):
        assert mart(facts).count() == 0
    assert marts.last_updated(facts).first().last_updated is None
    assert marts.governance_cards(marts.empty_facts(spark, True)).first().total_rows == 0
    assert shaping.where_equal(facts.drop("family"), "family", "x").count() == 0


def test_keyword_filter_and_sentinels(spark):
    df = small_table(spark, "k string, n string", [("Plot!", "2"), ("the", "9"), ("ab", "9"), (None, "1"), ("good", "x")])
    assert [(r.k, r.n) for r in shaping.meaningful_keywords(df, "k", "n").collect()] == [("plot", 2.0)]
    facts = story(spark, [("sentiment_distribution", "positive", "f", 1.0), ("sentiment_distribution", "nan", "f", 5.0),
                          ("sentiment_distribution", "NEUTRAL", "f", 3.0)])
    assert [(r.sentiment, r.share) for r in marts.sentiment_share(facts).collect()] == [("NEUTRAL", 75.0), ("POSITIVE", 25.0)]


def test_lineage_of_an_absent_column(spark):
    rows = v.lineage("d", small_table(spark, "bronze_file_name string", [("a",), (None,)])).collect()
    assert {r.column_name: r.coverage_pct for r in rows} == {
        "bronze_file_name": 50.0, "bronze_source_type": 0.0, "processed_at": 0.0}


def test_cards_and_links(spark):
    page = ('<div data-qa="discovery-media-list-item" class="c"><a data-qa="discovery-media-list-item-caption" href="/m/x">'
            '<span data-qa="discovery-media-list-item-title"> A &lt; B </span></a></div>')
    card = extraction.extract_cards(small_table(spark, "page_id int, html string", [(1, "<p></p>" + page), (2, "none")])).collect()
    assert [(c.page_id, c.title, c.url, c.critics_score) for c in card] == [
        (1, "A < B", "https://www.rottentomatoes.com/m/x", None)]
    anchors = '<a href="/m/a">90% 80% Alpha Streaming May 1, 2025</a><a href="/m/a">again</a><a href="/x">no</a>'
    link = extraction.extract_links(small_table(spark, "page_id int, html string", [(1, anchors)])).collect()
    assert [(r.title, r.critics_score, r.audience_score, r.release_date) for r in link] == [
        ("Alpha", "90%", "80%", "May 1, 2025")]
