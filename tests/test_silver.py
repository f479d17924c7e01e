"""Raw documents to silver tables, routing, manifest and snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from review_engine import schemas
from review_engine.operators import flatten
from review_engine.session import small_table
from review_engine.sources import bronze, manifest, snapshots

AT = "2025-01-03 00:00:00"
STAMP = "20250102_030405.json"


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def write(name, document):
        (folder / name).write_text(json.dumps(document, indent=1))

    write(f"tmdb_now_playing_{STAMP}", {
        "results": [
            {"id": 1, "title": " The  Film", "popularity": 7.5, "genre_ids": [28, 12], "release_date": "2024-01-05"},
            {"id": 2, "title": " "}, {"id": 1, "title": "The Film", "popularity": 9.0}],
        "ingested_at": "2025-01-02T03:04:05"})
    write(f"rottentomatoes_at_home_{STAMP}", {"results": [
        {"title": "the film", "release_date": "Streaming Sep 3, 2026", "critics_score": "94%", "url": "u1"},
        {"title": "B", "critics_score": "x"}]})
    critic = {"critic": "A", "review_text": "Good &amp; bad...", "sentiment": "POSITIVE", "is_top_critic": True,
              "date": "2024-01-05T10:00:00+02:00"}
    write(f"rottentomatoes_at_home_reviews_{STAMP}", {"results": [
        {"title": "The Film", "url": "u", "critics_score": "90%", "critic_reviews": [critic, critic],
         "audience_reviews": [{"user": "u", "rating": 4.5, "review_text": "ok", "is_verified": "no"},
                              {"user": "v", "review_text": "  "}]},
        {"title": "C", "critic_reviews": None}]})
    write(f"tmdb_movie_reviews_{STAMP}", {"results": [
        {"movie": {"id": 1, "title": "The Film", "genre_ids": [1]}, "total_reviews": 3,
         "reviews": [{"author": "z", "content": "txt", "rating": 8, "review_id": "r1"},
                     {"author": "late", "review_id": "r1"}, {"review_id": None}]}]})
    (folder / f"tmdb_trending_movie_day_{STAMP}").write_text('{"results": null}')
    return folder


def at():
    return F.lit(AT).cast("timestamp")


def test_titles(spark, raw):
    api = bronze.read_documents(spark, f"{raw}/tmdb_[nt]*", schemas.API_CATALOG_DOC)
    scraped = bronze.read_documents(spark, f"{raw}/rottentomatoes_at_home_2*", schemas.SCRAPED_CATALOG_DOC)
    df = flatten.transform_titles(api, scraped, at())
    names = schemas.TITLES.fieldNames()
    assert df.select(*names).schema.simpleString() == schemas.TITLES.simpleString()
    assert all(c.endswith("_all") for c in df.columns[len(names):])
    rows = {r.canonical_title: r for r in df.collect()}
    assert set(rows) == {"the film", "b"}
    film = rows["the film"]
    assert (film.source, film.source_title) == ("rottentomatoes, tmdb", "the film, The Film")
    # typed columns keep the first value: the repeated id is dropped before the merge
    assert (film.source_id, film.popularity, film.critics_score) == (1, 7.5, 94.0)
    assert (film.source_id_all, film.release_year_all) == ("1", "2026, 2024")
    assert str(film.release_date) == "2026-09-03" and film.genre_ids == "[28, 12]"
    assert rows["b"].critics_score is None


def test_title_reviews(spark, raw):
    docs = bronze.read_documents(spark, f"{raw}/rottentomatoes_*reviews*", schemas.TITLE_REVIEWS_DOC)
    rows = {r.review_type: r for r in flatten.transform_title_reviews(docs, at()).collect()}
    assert set(rows) == {"critic", "audience"}  # the copy and the blank text are gone
    assert rows["critic"].review_text_clean == "good & bad." and rows["critic"].is_top_critic is True
    assert str(rows["critic"].review_date) == "2024-01-05 08:00:00"
    assert (rows["audience"].rating, rows["audience"].is_verified, rows["audience"].critics_score) == (4.5, False, 90.0)
    assert rows["critic"].bronze_source_type == "rt_reviews_at_home"


def test_user_reviews(spark, raw):
    docs = bronze.read_documents(spark, f"{raw}/*.json", schemas.USER_REVIEWS_DOC)  # other types are skipped
    rows = flatten.transform_user_reviews(docs, at()).collect()
    assert [(r.movie_id, r.review_id, r.reviewer_name, r.rating, r.total_reviews) for r in rows] == [(1, "r1", "z", 8.0, 3)]


def test_longest_prefix_routes_reviews_to_reviews(spark):
    names = {
        f"tmdb_now_playing_{STAMP}": "silver_titles",
        f"rottentomatoes_at_home_{STAMP}": "silver_titles",
        f"rottentomatoes_at_home_reviews_{STAMP}": "silver_rt_reviews",
        f"tmdb_movie_reviews_{STAMP}": "silver_tmdb_reviews",
        "other.json": "ignored",
    }
    files = small_table(spark, "file_name string", [(n,) for n in names])
    typed = files.withColumn("source_type", bronze.source_type(F.col("file_name")))
    routed = bronze.route(typed, bronze.family_lookup(spark))
    assert {r.file_name: r.family for r in routed.collect()} == names


def test_listing_and_required_outputs(spark, raw):
    files = bronze.list_files(spark, str(raw))
    assert files.count() == 5
    expected = small_table(spark, "file_name string", [(f"tmdb_now_playing_{STAMP}",), ("gone.json",)])
    assert [r.file_name for r in bronze.missing_outputs(expected, files).collect()] == ["gone.json"]
    with pytest.raises(FileNotFoundError, match="gone.json"):
        bronze.require_outputs(expected, files)
    total = bronze.file_inventory(files).filter("file_name = 'TOTAL'").first()
    assert total.files == 5


def test_manifest(spark, tmp_path):
    (tmp_path / "list.txt").write_text(f"a/x_{STAMP}\n\n  a/plain.json \n")
    found = manifest.load_manifest(spark, str(tmp_path / "none"), str(tmp_path / "list.txt"))
    rows = {r.file_path: (r.creation_day, r.creation_time) for r in found.collect()}
    # a name without a stamp is remembered too, so that it is not read again
    assert rows == {f"a/x_{STAMP}": ("2025-01-02", "03:04:05"), "a/plain.json": (None, None)}
    processed = small_table(spark, "file_path string", [("a/plain.json",), ("b/new.json",), ("b/new.json",)])
    after = manifest.append_to_manifest(found, processed)
    assert sorted(r.file_path for r in after.collect()) == ["a/plain.json", f"a/x_{STAMP}", "b/new.json"]
    assert [r.file_path for r in bronze.new_files(processed, found).distinct().collect()] == ["b/new.json"]
    assert manifest.load_manifest(spark, str(tmp_path / "none")).count() == 0


def test_snapshots(spark, tmp_path):
    base = str(tmp_path)
    one = small_table(spark, "id bigint, v string", [(1, "a"), (2, "<NA>")])
    two = small_table(spark, "id double, v string, w int", [(3.0, "nan", 1)])
    for _ in range(2):  # a retry replaces its own run only
        snapshots.write_snapshot(one, base, "f", "20250101_000000")
    assert snapshots.scan_family(spark, base, "f").count() == 2
    snapshots.write_snapshot(two, base, "f", "20250102_000000")
    drift = snapshots.read_family_drift(spark, base, "f").orderBy("id").collect()
    assert [(r.id, r.v, r.w) for r in drift] == [("1", "a", None), ("2", None, None), ("3.0", None, "1")]
    newest = snapshots.latest_or_empty(spark, base, "f", two.schema).collect()
    assert [tuple(r) for r in newest] == [(3.0, "nan", 1)]
    assert snapshots.latest_or_empty(spark, base, "absent", two.schema).count() == 0
    assert snapshots.read_family_drift(spark, base, "absent") is None
    assert snapshots.write_snapshot_if_any(one.limit(0), base, "g", "20250101_000000") is None


def test_unreadable_run_fails_by_name(spark, tmp_path):
    base = str(tmp_path)
    snapshots.write_snapshot(small_table(spark, "id bigint", [(1,)]), base, "f", "20250101_000000")
    bad = tmp_path / "f" / "run_stamp=20250102_000000"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("junk")
    with pytest.raises(Exception, match="part-0.parquet"):
        snapshots.read_family_drift(spark, base, "f").collect()


def test_broken_and_empty_documents(spark, tmp_path):
    from review_engine import jobs

    raw, silver, known = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "manifest")
    raw.mkdir()
    (raw / f"tmdb_now_playing_{STAMP}").write_text('{"results": [], "ingested_at": null}')
    assert jobs.run_silver(spark, str(raw), silver, known, "20250103_000000", AT).count() == 0
    assert manifest.load_manifest(spark, known).count() == 1
    (raw / f"tmdb_movie_reviews_{STAMP}").write_text('{"results": [')
    with pytest.raises(Exception, match="tmdb_movie_reviews"):
        jobs.run_silver(spark, str(raw), silver, known, "20250104_000000", AT)
    assert manifest.load_manifest(spark, known).count() == 1


def test_empty_retry_leaves_no_old_rows(spark, tmp_path):
    rows = small_table(spark, "id bigint", [(1,)])
    snapshots.write_snapshot(rows, str(tmp_path), "f", "20250101_000000")
    assert snapshots.write_snapshot_if_any(rows.limit(0), str(tmp_path), "f", "20250101_000000") is None
    assert snapshots.scan_family(spark, str(tmp_path), "f").count() == 0


def test_both_runs(spark, raw, tmp_path):
    from review_engine import jobs
    from review_engine.operators.governance import Run

    silver, gold, known = (str(tmp_path / n) for n in ("silver", "gold", "manifest"))
    summary = jobs.run_silver(spark, str(raw), silver, known, "20250103_000000", AT)
    assert {r.family: r.rows for r in summary.collect()} == {
        "silver_titles": 2, "silver_rt_reviews": 2, "silver_tmdb_reviews": 1}
    # nothing is left for a second run
    assert jobs.run_silver(spark, str(raw), silver, known, "20250104_000000", AT).count() == 0
    assert manifest.load_manifest(spark, known).count() == 5

    lexicon = small_table(spark, "word string, polarity double, intensity double", [("txt", 0.4, None)])
    jobs.run_gold(spark, silver, gold, Run("20250105_000000", "2025-01-05T00:00:00"), lexicon)
    facts = {r.metric_name: r.value for r in snapshots.scan_family(spark, gold, "governance").collect()}
    assert facts["total_records_titles"] == 2.0 and facts["null_rate_titles_critics_score"] == 50.0
    assert facts["schema_compliance_rate_rt_reviews"] == 50.0 and facts["volume_rt_reviews_rottentomatoes"] == 2.0
    assert not any("run_stamp" in name or name.endswith("_all") for name in facts)
    story = {r.metric_name: (r.dimension_value, r.value) for r in snapshots.scan_family(spark, gold, "storytelling").collect()}
    assert story["rt_sentiment_POSITIVE"] == ("POSITIVE", 1.0) and story["rt_sentiment_UNKNOWN"] == ("UNKNOWN", 1.0)
    assert story["tmdb_sentiment_POSITIVE"] == ("POSITIVE", 1.0)  # no label in the data: filled from text
    assert story["rt_critic_vs_audience_the film"] == ("the film", 90.0) and story["tmdb_avg_rating"] == ("tmdb", 8.0)
    assert story["rt_reviewer_rank_1"] == ("A", 1.0)


def test_unreadable_files_are_left_out_on_demand(spark, tmp_path):
    base = str(tmp_path)
    snapshots.write_snapshot(small_table(spark, "id bigint", [(1,)]), base, "f", "20250101_000000")
    assert snapshots.write_snapshot_if_any(small_table(spark, "id bigint", [(2,)]).limit(0), base, "f", "20250103_000000") is None
    for run in ("20250101_000000", "20250102_000000"):  # beside a good file, and alone in a run without an entry
        (tmp_path / "f" / f"run_stamp={run}").mkdir(exist_ok=True)
        (tmp_path / "f" / f"run_stamp={run}" / "bad.parquet").write_text("junk")
    with pytest.raises(Exception, match="bad.parquet"):
        snapshots.read_family_drift(spark, base, "f").collect()
    assert [r.id for r in snapshots.read_family_drift(spark, base, "f", skip_unreadable=True).collect()] == ["1"]
    left_out = [(r.file_path.split("run_stamp=")[1], r.bytes) for r in snapshots.unreadable_files(spark, base, "f").collect()]
    assert sorted(left_out) == [("20250101_000000/bad.parquet", 4), ("20250102_000000/bad.parquet", 4)]


def test_schemas_come_from_the_registry(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for day in range(1, 6):
        snapshots.write_snapshot(small_table(spark, "id bigint", [(day,)]), base, "f", f"2025010{day}_000000")
    small_table(spark, "id double", [(9.0,)]).write.parquet(f"{base}/f/run_stamp=20250106_000000")  # no entry
    opened = []
    own = snapshots._own_schema
    monkeypatch.setattr(snapshots, "_own_schema", lambda s, path, *skip: opened.append(path) or own(s, path, *skip))
    df = snapshots.read_family_drift(spark, base, "f")
    assert sorted(r.id for r in df.collect()) == ["1", "2", "3", "4", "5", "9.0"]
    assert len(opened) == 1 and opened[0].endswith("20250106_000000")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_broken_documents_are_set_aside(spark, raw, tmp_path):
    from review_engine import jobs

    silver, known, rejects = (str(tmp_path / n) for n in ("silver", "manifest", "rejects"))
    broken = {f"tmdb_movie_reviews_9_{STAMP}": '{"results": [', f"rottentomatoes_theaters_{STAMP}": '{"results": [{"title": "x", "id": "none"}]}',
              f"tmdb_now_playing_9_{STAMP}": ""}
    for name, text in broken.items():
        (raw / name).write_text(text)
    run = lambda stamp: {r.family: (r.rows, r.rejected) for r in jobs.run_silver(spark, str(raw), silver, known, stamp, AT, rejects).collect()}
    assert run("20250103_000000") == {"silver_titles": (2, 1), "silver_rt_reviews": (2, 0), "silver_tmdb_reviews": (1, 1)}
    found = {r.file_name: r.reason for r in spark.read.parquet(rejects).collect()}
    assert found == dict(zip(broken, (bronze.NOT_JSON, bronze.NOT_OF_SCHEMA), strict=False))  # the empty file waits
    assert manifest.load_manifest(spark, known).count() == 5
    # mended, the file is taken up; the others are met again
    (raw / f"tmdb_movie_reviews_9_{STAMP}").write_text('{"results": [{"movie": {"id": 2, "title": "B"}, "reviews": [{"review_id": "r9"}]}]}')
    assert run("20250104_000000") == {"silver_tmdb_reviews": (1, 0)}
    assert manifest.load_manifest(spark, known).count() == 6
    with pytest.raises(Exception, match="rottentomatoes_theaters"):  # without a table of rejects
        jobs.run_silver(spark, str(raw), silver, known, "20250105_000000", AT)


def test_catalogs_of_both_shapes_are_read_once(spark, raw):
    docs = bronze.read_documents(spark, f"{raw}/*[tey]_2*.json", schemas.CATALOG_DOC)
    once = flatten.transform_titles(docs, docs, at())
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    api = bronze.read_documents(spark, f"{raw}/tmdb_now*", schemas.API_CATALOG_DOC)
    scraped = bronze.read_documents(spark, f"{raw}/rottentomatoes_at_home_2*", schemas.SCRAPED_CATALOG_DOC)
    apart = flatten.transform_titles(api, scraped, at())
    assert once.columns == apart.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))


def test_documents_are_parsed_once_for_both_sides(spark, raw, tmp_path):
    (raw / f"tmdb_now_playing_9_{STAMP}").write_text('{"results": [')
    names = [str(p) for p in raw.glob("tmdb_now*")]
    good, rejected = bronze.sorted_documents(spark, names, schemas.CATALOG_DOC)
    for side in (good, rejected):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan json" not in plan
    assert good.columns == [*schemas.CATALOG_DOC.names, "bronze_file_name"]
    assert good.count() == len(names) - 1 and [r.reason for r in rejected.collect()] == [bronze.NOT_JSON]


def test_small_raw_files_are_laid_out_by_several_tasks(spark, tmp_path, monkeypatch):
    from review_engine.plans import batch

    listed = []
    whole = bronze.list_files
    monkeypatch.setattr(batch.bronze, "list_files", lambda *a, **k: listed.append(whole(*a, **k)) or listed[-1])
    batch.lay_out(spark.range(60).selectExpr("concat('f', id, '.json') AS name", "concat('{\"id\": ', id, '}') AS value"), f"{tmp_path}/raw")
    parts = {p.rsplit("/", 1)[1].split("-")[1] for p in (f.split("/name=")[1] for f in listed[0].inputFiles())} if listed else set()
    assert len(parts) > 1
    assert {p.name: p.read_text() for p in (tmp_path / "raw").glob("*.json")} == {f"f{i}.json": f'{{"id": {i}}}\n' for i in range(60)}
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 1000
