"""Streams equal their batch twins, and repeats change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from review_engine.session import small_table
from review_engine.streaming import dedup, ingest, trend

DAY = dt.datetime(2024, 1, 1)
ROWS = [(i % 40, DAY + dt.timedelta(hours=i), ["POSITIVE", "NEGATIVE", None][i % 3]) for i in range(300)]
SCHEMA = "k bigint, ts timestamp, label string"


@pytest.fixture
def source(spark, tmp_path):
    df = small_table(spark, SCHEMA, ROWS)
    df.filter("k < 20").coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    path = str(tmp_path / "in" / "a")
    return df, path


def add_rest(df, path):
    df.filter("k >= 20").coalesce(1).write.mode("append").parquet(path)


def wait(query):
    query.awaitTermination()
    assert query.exception() is None


def test_each_file_once(spark, source, tmp_path):
    df, path = source
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: wait(ingest.ingest(ingest.read_parquet_stream(spark, path, df.schema), out, check))
    run()
    assert spark.read.parquet(out).count() == df.filter("k < 20").count()
    add_rest(df, path)
    run()
    run()
    assert spark.read.parquet(out).exceptAll(df).count() == 0 and spark.read.parquet(out).count() == len(ROWS)


def test_repeated_batch_replaces_itself(spark, source, tmp_path):
    df, _ = source
    write = ingest.batch_writer(str(tmp_path / "out"), ["batch_id"])
    for batch, number in ((df.filter("k < 20"), 0), (df.filter("k >= 20"), 1), (df.filter("k >= 20"), 1)):
        write(batch, number)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_replay_in_other_batches(spark, source, tmp_path):
    df, path = source
    add_rest(df, path)
    df.filter("k = 3").coalesce(1).write.mode("append").parquet(path)
    out = str(tmp_path / "out")
    for run, files_per_trigger in enumerate((1, 1000, 2)):
        stream = ingest.read_parquet_stream(spark, path, df.schema, files_per_trigger=files_per_trigger,
                                            file_column="source_file")
        wait(ingest.ingest_idempotent(stream, out, str(tmp_path / f"check{run}")))
        got, expected = spark.read.parquet(out).select(*df.columns), spark.read.parquet(path)
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.mark.parametrize("salts", [1, 8])
def test_dedup_equals_batch(spark, source, tmp_path, salts):
    df, path = source
    add_rest(df, path)
    stream = ingest.read_parquet_stream(spark, path, df.schema)
    unique = dedup.stream_dedup(stream, ["k", "label"], "ts", "60 days", salts)
    wait(ingest.ingest(unique.select("k", "label"), str(tmp_path / "out"), str(tmp_path / "check")))
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = df.select("k", "label").distinct()
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0


def test_dedup_across_runs(spark, source, tmp_path):
    """A second run with a fresh checkpoint adds no known key; a repeated run replaces its own rows."""
    df, path = source
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(name, checkpoint):
        stream = ingest.read_parquet_stream(spark, path, df.schema)
        wait(dedup.dedup_across_runs(stream, out, state, str(tmp_path / checkpoint), ["k", "label"], ["ts"], name))
        return {(r.k, r.label, r.run) for r in spark.read.parquet(out).collect()}

    first = {(r.k, r.label) for r in df.filter("k < 20").collect()}
    assert run("a", "check_a") == {(*key, "a-0") for key in first}
    assert run("a", "check_lost") == {(*key, "a-0") for key in first}
    add_rest(df, path)
    every = {(r.k, r.label) for r in df.collect()}
    assert run("b", "check_b") == {(*key, "a-0" if key in first else "b-0") for key in every}
    assert spark.read.parquet(state).count() == len(every)


@pytest.mark.parametrize("width", ["1 day", "7 days"])
def test_trend_equals_batch(spark, source, tmp_path, width):
    df, path = source
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def publish():
        events = ingest.read_parquet_stream(spark, path, df.schema)
        counted = trend.sentiment_trend(events, "ts", "label", "30 days", width)
        wait(ingest.publish_totals(counted, out, check, ["period_start", "label"]))
        return ingest.read_totals(spark, out, counted.schema)

    assert publish().agg(F.sum("mentions")).first()[0] == df.filter("k < 20").count()
    add_rest(df, path)
    got, expected = publish(), trend.sentiment_trend(df, "ts", "label", "30 days", width)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert got.agg(F.sum("mentions")).first()[0] == len(ROWS)


def test_files_grow_with_windows_not_labels(spark, tmp_path):
    """A thousand labels, null and empty ones too, in batches cut differently: a file for each window, the same totals."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, DAY + dt.timedelta(days=i % 3, minutes=i % 60), None if i % 1000 == 0 else "" if i % 1000 == 1 else f"l{i % 1000}") for i in range(2400)]
    for part in range(4):
        small_table(spark, SCHEMA, rows[part::4]).coalesce(1).write.mode("append").parquet(path)
    expected = trend.sentiment_trend(spark.read.parquet(path), "ts", "label", "30 days")
    for run, files_per_trigger in enumerate((1, 1000, 2)):
        events = ingest.read_parquet_stream(spark, path, SCHEMA, files_per_trigger=files_per_trigger)
        counted = trend.sentiment_trend(events, "ts", "label", "30 days")
        wait(ingest.publish_totals(counted, out, str(tmp_path / f"check{run}"), ["period_start", "label"]))
        got = ingest.read_totals(spark, out, counted.schema)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
        assert len(list((tmp_path / "out").rglob("*.parquet"))) == 3


def test_closed_windows_are_left_alone(spark, tmp_path):
    path, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")

    def publish(day, n):
        rows = [(i, day + dt.timedelta(minutes=i), "POSITIVE") for i in range(n)]
        small_table(spark, SCHEMA, rows).coalesce(1).write.mode("append").parquet(path)
        events = ingest.read_parquet_stream(spark, path, SCHEMA)
        counted = trend.sentiment_trend(events, "ts", "label", "2 days")
        query = ingest.publish_totals(counted, out, check, ["period_start", "label"])
        wait(query)
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return {(r.period_start, r.mentions) for r in ingest.read_totals(spark, out, counted.schema).collect()}, states

    assert publish(DAY, 5)[0] == {("2024-01-01", 5)}
    written = sorted(p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet"))
    totals, states = publish(DAY + dt.timedelta(days=10), 7)
    assert totals == {("2024-01-01", 5), ("2024-01-11", 7)} and states[-1] == 1
    assert written[0] in {p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}


def test_document_stream(spark, tmp_path):
    from review_engine import schemas

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "tmdb_now_playing_20250102_030405.json").write_text('{"results": [{"id": 1}],\n "source": "x"}')
    stream = ingest.read_document_stream(spark, str(tmp_path / "in"), schemas.API_CATALOG_DOC)
    wait(ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "check")))
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row.results[0].id == 1 and row.bronze_source_type == "tmdb_catalog_now_playing"
