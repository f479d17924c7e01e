"""Every named query against its SQL, and the shape of the plans."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from review_engine.plans import registry

RUNS, SQLS = registry.runs(), registry.sqls()
WRITES = ("stream_", "mart_", "batch_silver", "batch_governance", "batch_storytelling", "batch_rejects", "batch_manifest", "manifest_load", "read_family_drift", "scan_family", "latest_snapshot_or", "sink_")
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=lambda r: [(type(v).__name__, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(RUNS) == set(SQLS)


def test_entry(spark, folder):
    own = lambda names: {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own(entry_module.queries()) == RUNS.keys() and own(entry_module.oracle_sql()) == SQLS.keys()
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(RUNS))
def test_query_matches_sql(spark, duck, folder, name):
    df = RUNS[name](spark, folder)
    columns = sorted(df.columns)
    rows = [tuple(row[c] for c in columns) for row in df.collect()]
    assert rows
    if name not in SQLS:
        return
    result = duck.execute(SQLS[name])
    types = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema} == types
    assert ordered(rows) == ordered(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", [n for n in RUNS if not n.startswith(WRITES)])
def test_plan_stays_native(spark, folder, name):
    plan = RUNS[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for operator in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                     "CollectLimit"):
        assert operator not in plan, operator


@pytest.mark.parametrize("name", ["sto_top_keywords", "sto_top_reviewers", "sto_top_titles_rating", "sto_release_period",
                                  "sto_score_delta", "sto_rating_trend", "nlp_top_bigrams"])
def test_top_k_is_one_operator(spark, folder, name):
    assert "TakeOrderedAndProject" in RUNS[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filtered(spark, folder):
    def plan(name):
        return RUNS[name](spark, folder)._jdf.queryExecution().executedPlan().toString()

    assert "PushedFilters: [IsNotNull(o_orderdate), EqualTo(o_orderdate,ScalarSubquery" in plan("latest_snapshot")
    assert re.search(r"PushedFilters: \[[^\n]*In\(event_type, \[", plan("filter_in_list"))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan("sto_avg_rating"))
    assert schemas == ["struct<value:double>", "struct<o_totalprice:double>"]
    # labels are not joined where none is read
    assert "Join" not in plan("sto_top_keywords") and "Join" not in plan("gov_text_stats")


def test_bigrams_are_counted_by_name_in_heavy_buckets_only(spark, folder):
    """And no filter finds the tokens of a text a second time."""
    plan = RUNS["nlp_top_bigrams"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" in plan and not re.search(r"Filter [^\n]*regexp_extract_all", plan)
    by_name = re.findall(r"Exchange hashpartitioning\(_w0.*\n.*HashAggregate.*\n.*Project.*\n.*", plan)
    assert by_name and all("BroadcastHashJoin" in part and "LeftSemi" in part for part in by_name)


def scans(df, name):
    return df._jdf.queryExecution().executedPlan().toString().count(f"/{name}.parquet")


def test_reports_read_each_family_few_times(spark, folder):
    """Beside these scans, the histogram of the numeric columns reads each family once."""
    quality, story = RUNS["governance_report"](spark, folder), RUNS["storytelling_report"](spark, folder)
    for name in ("part", "documents", "events", "orders"):
        assert scans(quality, name) <= 3, name
    assert scans(story, "events") == 1  # its texts would be a second scan
    assert scans(story, "orders") == 1 and scans(story, "part") == 2


@pytest.mark.parametrize("name, read", [
    ("mart_null_rates", {"part": 1, "documents": 1, "events": 1, "orders": 1, "labels": 1}), ("mart_outliers", {}),
    ("mart_compliance", {"part": 1, "documents": 1, "events": 1, "orders": 1, "labels": 1}), ("mart_keywords", {"documents": 1}),
    ("mart_activity", {"events": 1, "orders": 1}), ("mart_sources", {"documents": 1, "events": 1, "part": 1}),
    ("mart_sentiment_trend", {"events": 1})])
def test_marts_plan_what_they_show(spark, folder, name, read):
    df = RUNS[name](spark, folder)
    assert {t: n for t in ("part", "documents", "events", "orders", "labels") if (n := scans(df, t))} == read


@pytest.mark.parametrize("parts", [1, 3])
def test_lineage_names_the_file_of_a_table_kept_in_parts(spark, folder, tmp_path, parts):
    spark.read.parquet(f"{folder}/documents.parquet").repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = RUNS["with_lineage"](spark, str(tmp_path)).collect()
    assert len(rows) > 1 and {r.bronze_file_name for r in rows} == {"documents.parquet"}
