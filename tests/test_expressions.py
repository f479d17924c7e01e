"""Column expressions against literal cases."""

import datetime as dt
import html
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions import markup, parsing, text


def apply(spark, expression, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


CASES = [
    (text.to_null, ["  ", " a ", None, "　\xa0"], [None, "a", None, None]),
    (text.canonical_title, ["  The   Film ", "\t", "A B"], ["the film", None, "a b"]),
    (text.null_sentinels, ["nan", "<NA>", "None", "", "x"], [None, None, None, None, "x"]),
    (text.tokens, ["The café, a 2nd-rate_x"], [["the", "café", "2nd", "rate_x"]]),
    (text.clean_title,
     ["Project Hail MaryStreaming", "ObsessionLink to Obsession", "The Sheep DetectivesLink to The Sheep Detectives",
      "Send HelpStreaming", "94% 95% My Title Streaming May 12, 2026", "12 Angry Men", "95%", None],
     ["Project Hail Mary", "Obsession", "The Sheep Detectives", "Send Help", "My Title", "Angry Men", None, None]),
    (text.date_text, ["x Sept 3 2026 y", "none"], ["Sept 3 2026", None]),
    (text.sentiment_from_name, ["rt_sentiment_trend_2024-01-01_POSITIVE", "rt_x"], ["POSITIVE", "UNKNOWN"]),
    (text.keyword_letters, [" Nan ", "café2", None], ["nan", "caf", ""]),
    (markup.clean_review_text, ["Tom &amp; Jerry...  WOW", " \n", "&nbsp;", "A.B..C"],
     ["tom & jerry. wow", None, "", "a.b.c"]),
    (parsing.parse_percent, ["94%", "", "n/a", " 7.5 %", "nan", "5d"], [94.0, None, None, 7.5, None, None]),
    (parsing.safe_double, ["1e3", "-.5", "x", "+2.", "inf"], [1000.0, -0.5, None, 2.0, float("inf")]),
    (parsing.parse_flag, ["Yes", "0", "maybe", None, " TRUE "], [True, False, None, None, True]),
    (parsing.parse_release_date, ["Opened May 12, 2026", "Streaming Sep 3, 2026", "junk"],
     [dt.date(2026, 5, 12), dt.date(2026, 9, 3), None]),
    (parsing.parse_date, ["12/05/2026", "2024", "May 2024", "2024-02-30", "2024-01-05T23:30:00-05:00"],
     [dt.date(2026, 12, 5), dt.date(2024, 1, 1), dt.date(2024, 5, 1), None, dt.date(2024, 1, 5)]),
]


@pytest.mark.parametrize("expression, values, expected", CASES, ids=[c[0].__name__ for c in CASES])
def test_literal_cases(spark, expression, values, expected):
    assert apply(spark, expression, values) == expected


def test_timestamps_are_utc(spark):
    shown = lambda c: F.date_format(parsing.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss")
    got = apply(spark, shown, ["2024-01-05T10:00:00+02:00", "2024-01-05T10:00:00", "2024-01-05", "10:00", "x"])
    assert got == ["2024-01-05 08:00:00", "2024-01-05 10:00:00", "2024-01-05 00:00:00", None, None]


def test_percent_pair(spark):
    first, second = text.critics_and_audience_percent(F.col("v"))
    df = spark.createDataFrame([("94% 80% x",), ("7%",), ("x",)], "v string").select(first.alias("a"), second.alias("b"))
    assert [tuple(r) for r in df.collect()] == [("94%", "80%"), ("7%", None), (None, None)]


def test_ids_text(spark):
    assert apply(spark, parsing.ids_text, [[28, 12], [], None, [1, None]], "array<bigint>") == [
        "[28, 12]", "[]", None, "[1, null]"]


def test_sorted_json(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'a', array(named_struct('z', 1, 'y', 'q'))) AS v")
    dtype = df.schema["v"].dataType
    assert df.select(parsing.sorted_json(F.col("v"), dtype).alias("x")).first().x == '{"a":[{"y":"q","z":1}],"b":1}'
    assert isinstance(dtype, T.StructType)


def test_html_references_match_the_standard(spark):
    rng = random.Random(7)
    pieces = ["&amp;", "&lt", "&copy;", "&notit;", "&notin;", "&#65;", "&#x1F600;", "&#x80;", "&#0;", "&#xD800;", "&#13;",
              "&#99999999999999;", "&bogus;", "&", ";", " ", "x", "&eacute", "&NotEqualTilde;", "&#1;", "&#xFFFE;", "&AMP",
              "&#", "&#x;", "&amp;lt;", "\n", "&#x110000;", "&#150", "&gtcc;"]
    samples = ["".join(rng.choices(pieces, k=rng.randint(1, 8))) for _ in range(400)] + [None, ""]
    expected = [html.unescape(s) if s is not None else None for s in samples]
    assert apply(spark, markup.html_unescape, samples) == expected
