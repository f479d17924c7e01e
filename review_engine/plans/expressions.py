"""Column expressions over the driver tables.

Raw spellings that the tables lack are composed from their values, so every row
of a table passes through the expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions import markup, parsing, text
from review_engine.plans.registry import query
from review_engine.plans.tables import WORDS, sql_clean, sql_space, table


def pick(number: Column, *choices: Column | str | None) -> Column:
    """One of several spellings, by the remainder of a number."""
    result = None
    for i, choice in enumerate(choices):
        value = choice if isinstance(choice, Column) else F.lit(choice).cast("string")
        condition = number % len(choices) == i
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result


def sql_pick(number: str, *choices: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices))
    return f"CASE {number} % {len(choices)} {whens} END"


# --- text --------------------------------------------------------------------


@query("fn_tokens", f"""
SELECT doc_id, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORDS}') AS w FROM documents)""")
def fn_tokens(spark, folder):
    words = table(spark, folder, "documents").select("doc_id", text.tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("bigint").alias("n_tokens"), F.array_join("w", " ").alias("tokens"))


PADDED = "CASE WHEN p_size % 5 = 0 THEN '  ' || chr(9) || ' ' ELSE ' ' || chr(9) || p_name || '  ' END"


@query("fn_to_null", f"SELECT p_partkey, nullif(trim({PADDED}, ' ' || chr(9)), '') AS value FROM part")
def fn_to_null(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.to_null(F.expr(PADDED)).alias("value"))


@query("fn_normalize_ws", f"SELECT doc_id, {sql_space('text')} AS value FROM documents")
def fn_normalize_ws(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.normalize_space(F.col("text")).alias("value"))


@query("fn_canonical_title",
       f"SELECT p_partkey, lower({sql_space(chr(39) + '  ' + chr(39) + ' || upper(p_name) || chr(10) || p_brand')}) AS canonical_title FROM part")
def fn_canonical_title(spark, folder):
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\n"), F.col("p_brand"))
    return table(spark, folder, "part").select("p_partkey", text.canonical_title(raw).alias("canonical_title"))


@query("fn_clean_text", f"SELECT doc_id, {sql_clean('text')} AS value FROM documents")
def fn_clean_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", markup.clean_review_text(F.col("text")).alias("value"))


def sql_unescape(x: str) -> str:
    """The references that occur in the driver pages; the ampersand last, so nothing is decoded twice."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        # a title cut off inside a reference may lack the semicolon
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


@query("fn_html_unescape", f"SELECT page_id, {sql_unescape('html')} AS value FROM pages")
def fn_html_unescape(spark, folder):
    return table(spark, folder, "pages").select("page_id", markup.html_unescape(F.col("html")).alias("value"))


@query("fn_clean_title", rf"""
WITH raw AS (SELECT p_partkey, {sql_pick('p_partkey', "p_name || 'Streaming'", "' Link to ' || p_name",
  "p_size || '% 95% ' || p_name || ' Streaming May 12, 2026'", "p_name || 'Link to ' || p_name",
  "p_name || ' May ' || p_size || ', 2024'", "'12%'")} AS t FROM part),
a AS (SELECT p_partkey, t, regexp_replace(t, '(?i)^\s*Link to\s+', '') AS x FROM raw),
b AS (SELECT p_partkey, t, regexp_replace(x, '^\s*[\d%\s]+', '') AS x FROM a),
c AS (SELECT p_partkey, t, regexp_replace(regexp_replace(regexp_replace(x, '[Ss]treaming.*$', ''), '[Oo]pened.*$', ''),
                                          '[Ll]ink\s+to\s+.*$', '') AS x FROM b),
d AS (SELECT p_partkey, t, regexp_replace(x,
  '(?i)\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]?\s+\d{{1,2}},?\s+\d{{4}}\s*$', '') AS x FROM c)
SELECT p_partkey, t AS raw_title, {sql_space('x')} AS title FROM d""")
def fn_clean_title(spark, folder):
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    raw = pick(
        F.col("p_partkey"),
        F.concat(name, F.lit("Streaming")),
        F.concat(F.lit(" Link to "), name),
        F.concat(size, F.lit("% 95% "), name, F.lit(" Streaming May 12, 2026")),
        F.concat(name, F.lit("Link to "), name),
        F.concat(name, F.lit(" May "), size, F.lit(", 2024")),
        "12%",
    )
    rows = table(spark, folder, "part").select("p_partkey", raw.alias("raw_title"))
    return rows.withColumn("title", text.clean_title(F.col("raw_title")))


SCORES = "CASE p_partkey % 3 WHEN 0 THEN p_size || '% ' || (p_size + 7) || '% ' || p_name WHEN 1 THEN p_name || p_size || '%' ELSE p_name END"


@query("fn_extract_percents", rf"""
SELECT p_partkey, regexp_extract_all({SCORES}, '\d{{1,3}}%')[1] AS critics,
       regexp_extract_all({SCORES}, '\d{{1,3}}%')[2] AS audience FROM part""")
def fn_extract_percents(spark, folder):
    critics, audience = text.critics_and_audience_percent(F.expr(SCORES))
    return table(spark, folder, "part").select("p_partkey", critics.alias("critics"), audience.alias("audience"))


@query("fn_extract_date", r"""
SELECT o_orderkey, nullif(regexp_extract(CASE o_orderkey % 3 WHEN 0 THEN 'x ' || strftime(o_orderdate, '%b %d, %Y') || ' y'
    WHEN 1 THEN 'Opened ' || strftime(o_orderdate, '%b %d %Y') ELSE o_orderpriority END,
  '(?i)(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]?\s+\d{1,2},?\s+\d{4}'), '') AS date_text FROM orders""")
def fn_extract_date(spark, folder):
    raw = pick(
        F.col("o_orderkey"),
        F.concat(F.lit("x "), F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(" y")),
        F.concat(F.lit("Opened "), F.date_format("o_orderdate", "MMM dd yyyy")),
        F.col("o_orderpriority"),
    )
    return table(spark, folder, "orders").select("o_orderkey", text.date_text(raw).alias("date_text"))


SENTINELS = "CASE event_type WHEN 'view' THEN 'nan' WHEN 'click' THEN '<NA>' WHEN 'error' THEN 'None' ELSE event_type END"


@query("fn_null_sentinels", f"""
SELECT event_id, CASE WHEN lower({SENTINELS}) NOT IN ('nan', '<na>', 'none', '') THEN {SENTINELS} END AS value FROM events""")
def fn_null_sentinels(spark, folder):
    return table(spark, folder, "events").select("event_id", text.null_sentinels(F.expr(SENTINELS)).alias("value"))


# --- dates -------------------------------------------------------------------


@query("fn_parse_timestamp", f"""
SELECT o_orderkey, strftime({sql_pick('o_orderkey',
    "o_orderdate + INTERVAL 8 HOUR", "o_orderdate + INTERVAL 10 HOUR + INTERVAL 30 MINUTE", "o_orderdate",
    "o_orderdate", "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP)")}, '%Y-%m-%d %H:%M:%S') AS parsed FROM orders""")
def fn_parse_timestamp(spark, folder):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = pick(
        F.col("o_orderkey"),
        F.concat(day, F.lit("T10:00:00+02:00")),
        F.concat(day, F.lit(" 10:30:00")),
        day,
        F.concat(day, F.lit("T00:00:00Z")),
        F.concat(F.lit("junk "), day),
        "  ",
    )
    parsed = F.date_format(parsing.parse_timestamp(raw), "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "orders").select("o_orderkey", parsed.alias("parsed"))


def spelled_date() -> Column:
    spell = lambda pattern: F.date_format("o_orderdate", pattern)
    return pick(
        F.col("o_orderkey"), spell("MMM d, yyyy"), spell("MMMM d, yyyy"), spell("M/d/yyyy"), spell("yyyy-MM-dd"),
        spell("MMM yyyy"), spell("yyyy"), spell("yyyy-MM-dd'T'23:30:00-05:00"), "junk",
    )


DAY = "CAST(o_orderdate AS DATE)"
SPELLED_DAY = sql_pick("o_orderkey", DAY, DAY, DAY, DAY, f"CAST(date_trunc('month', {DAY}) AS DATE)",
                       f"CAST(date_trunc('year', {DAY}) AS DATE)", DAY, "CAST(NULL AS DATE)")


@query("fn_parse_date", f"SELECT o_orderkey, {SPELLED_DAY} AS parsed FROM orders")
def fn_parse_date(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", parsing.parse_date(spelled_date()).alias("parsed"))


@query("fn_release_date", f"SELECT o_orderkey, {SPELLED_DAY} AS released FROM orders")
def fn_release_date(spark, folder):
    prefix = pick(F.col("o_custkey"), "Opened ", "streaming ", "")
    released = parsing.parse_release_date(F.concat(prefix, spelled_date()))
    return table(spark, folder, "orders").select("o_orderkey", released.alias("released"))


@query("fn_extract_year", f"SELECT o_orderkey, CAST(year({SPELLED_DAY}) AS INTEGER) AS release_year FROM orders")
def fn_extract_year(spark, folder):
    year = parsing.release_year(parsing.parse_date(spelled_date()))
    return table(spark, folder, "orders").select("o_orderkey", year.alias("release_year"))


# --- numbers, flags, arrays --------------------------------------------------


@query("fn_parse_percent", f"""
SELECT p_partkey, {sql_pick('p_partkey', "CAST(p_size AS DOUBLE)", "p_size + 0.5", "NULL", "NULL", "NULL")} AS percent FROM part""")
def fn_parse_percent(spark, folder):
    size = F.col("p_size").cast("string")
    raw = pick(F.col("p_partkey"), F.concat(size, F.lit("%")), F.concat(F.lit(" "), size, F.lit(".5 % ")), "", "n/a", None)
    return table(spark, folder, "part").select("p_partkey", parsing.parse_percent(raw).alias("percent"))


@query("fn_safe_numeric", f"""
SELECT p_partkey, {sql_pick('p_partkey', "CAST(p_size AS DOUBLE)", "p_size * 1000.0", "CAST(-p_size AS DOUBLE)", "NULL", "NULL", "NULL", "NULL")} AS number FROM part""")
def fn_safe_numeric(spark, folder):
    size = F.col("p_size").cast("string")
    raw = pick(F.col("p_partkey"), size, F.concat(size, F.lit("e3")), F.concat(F.lit(" -"), size, F.lit(".0 ")),
               F.concat(size, F.lit("d")), "nan", F.col("p_name"), "")
    return table(spark, folder, "part").select("p_partkey", parsing.safe_double(raw).alias("number"))


@query("fn_parse_bool", f"""
SELECT event_id, {sql_pick('event_id', 'true', 'false', 'NULL', 'true', 'false', 'true', 'NULL')} AS flag FROM events""")
def fn_parse_bool(spark, folder):
    raw = pick(F.col("event_id"), " Yes", "0", "maybe", "TRUE", "n", "1", None)
    return table(spark, folder, "events").select("event_id", parsing.parse_flag(raw).alias("flag"))


@query("fn_serialize_ids", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 6 THEN '[' || l_partkey || ', ' || l_suppkey || ']' END AS ids
FROM lineitem""")
def fn_serialize_ids(spark, folder):
    ids = F.when(F.col("l_linenumber") < 6, F.array("l_partkey", "l_suppkey"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", parsing.ids_text(ids).alias("ids"))


@query("fn_sorted_json", """
SELECT event_id, '{"a":{"b":' || user_id || ',"c":"' || event_type || '"},"z":[' || user_id || ']}' AS value FROM events""")
def fn_sorted_json(spark, folder):
    nested = F.struct(
        F.array("user_id").alias("z"),
        F.struct(F.col("event_type").alias("c"), F.col("user_id").alias("b")).alias("a"),
    )
    rows = table(spark, folder, "events").select("event_id", nested.alias("value"))
    return rows.select("event_id", parsing.sorted_json(F.col("value"), rows.schema["value"].dataType).alias("value"))


@query("src_json_roundtrip", r"""
SELECT event_id, CAST(regexp_extract(props, '"k": (\d+)', 1) AS BIGINT) AS k, 'none' AS name FROM events""")
def src_json_roundtrip(spark, folder):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
    parsed = table(spark, folder, "events").select("event_id", F.from_json("props", schema).alias("p"))
    return parsed.select("event_id", "p.k", F.coalesce("p.name", F.lit("none")).alias("name"))


