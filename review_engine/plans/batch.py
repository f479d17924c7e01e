"""The batch runs end to end: raw JSON files on disk, two silver runs, gold facts, marts over them.

The raw files are multi-line JSON composed by Spark from the tables, several for each source. The
first run sees the API's catalogs and the even blocks of reviews, the second all others; among
the files of each run are broken ones, which are set aside.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine import jobs, schemas
from review_engine.operators import marts
from review_engine.operators.governance import Run
from review_engine.plans import documents as docs
from review_engine.plans import opinion, quality, shapes
from review_engine.plans.registry import query
from review_engine.plans.tables import table
from review_engine.session import shared_path
from review_engine.sources import bronze, snapshots
from review_engine.streaming import ingest

FIRST, SECOND = "20250103_000000", "20250104_000000"
GOLD = Run("20250105_000000", "2025-01-05T00:00:00")
AT = "2025-01-03 00:00:00"
TALKS = 256  # conversations in a file
MOVERS = 8  # threads that move files


def _blocks(documents: DataFrame, prefix: str) -> DataFrame:
    """Documents of one entry joined to larger ones, a block of conversations in each."""
    number = F.regexp_extract("bronze_file_name", rf"^{prefix}(\d+)_", 1).cast("bigint")
    block = F.floor(number / TALKS).alias("block")
    order = F.array_sort(F.collect_list(F.struct(number.alias("number"), F.col("results")[0].alias("entry"))))
    return documents.groupBy(block).agg(F.transform(order, lambda x: x["entry"]).alias("results")).select(
        "results", F.lit(None).cast("string").alias("ingested_at"), docs.file_name(prefix, F.col("block")).alias("bronze_file_name"),
        (F.col("block") % 2 + 1).alias("run"))


SOURCES = ("titles", "reviews", "user_reviews", "broken")


def raw_files(spark: SparkSession, folder: str, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """(run, name, value): the content of the raw files of these sources."""
    parts = []
    if "titles" in sources:
        api, scraped = docs.title_documents(spark, folder)
        parts += [api.withColumn("run", F.lit(1)), scraped.withColumn("run", F.lit(2))]
    if "reviews" in sources:
        parts.append(_blocks(docs.review_documents(spark, folder), "rottentomatoes_reviews_"))
    if "user_reviews" in sources:
        parts.append(_blocks(docs.user_review_documents(spark, folder), "tmdb_movie_reviews_"))
    document = F.to_json(F.struct("results", "ingested_at"), {"pretty": "true", "ignoreNullFields": "false"})
    texts = [part.select(F.col("run").cast("int").alias("run"), F.col("bronze_file_name").alias("name"), document.alias("value")) for part in parts]
    if "broken" in sources:
        key = F.col("n_nationkey")
        texts.append(table(spark, folder, "nation").select(
            (key % 2 + 1).cast("int").alias("run"),
            docs.file_name("tmdb_trending_movie_day_", key).alias("name"),
            F.when(key % 3 == 0, '{"results": [\n').when(key % 3 == 1, '{"results": [{"id": "no number"}]}').otherwise('{"results": []}').alias("value")))
    return reduce(DataFrame.unionByName, texts)


def lay_out(files: DataFrame, target: str) -> None:
    """Write each file under its own name: Spark writes a folder for each, and the one part in it is moved.

    The number of tasks is given, as Spark would join small files into one task whatever their number. The
    parts are listed by Spark and moved by several threads, so that little is asked of the driver for a file.
    """
    spark = files.sparkSession
    staged = shared_path(spark, "raw-staged")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files.repartition(tasks, "name").write.partitionBy("name").text(staged)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    parts = [row.file_path for row in bronze.list_files(spark, staged, "part-*", recursive=True).select("file_path").collect()]
    names = [part.rsplit("/", 2)[1].removeprefix("name=") for part in parts]
    if len(set(names)) < len(names):
        raise ValueError("a raw file was written in several parts")

    def move(part: str, name: str) -> bool:
        return fs.rename(path(part), path(f"{target}/{name}"))

    with ThreadPoolExecutor(MOVERS) as pool:
        if not all(pool.map(move, parts, names)):
            raise OSError(f"not all raw files could be moved to {target}")


def silver_runs(spark: SparkSession, folder: str, *sources: str) -> tuple[str, str, str]:
    """Both silver runs over these sources (all if none is named); returns the folders of silver tables, rejects and manifest."""
    raw, silver, rejects, manifest = (shared_path(spark, n) for n in ("raw", "silver", "rejects", "manifest"))
    files = raw_files(spark, folder, sources or SOURCES)
    for number, stamp in ((1, FIRST), (2, SECOND)):
        lay_out(files.filter(F.col("run") == number).select("name", "value"), raw)
        jobs.run_silver(spark, raw, silver, manifest, stamp, AT, rejects)
    return silver, rejects, manifest


def stamped(run: str) -> str:
    return f"CASE WHEN {run} THEN '{FIRST}' ELSE '{SECOND}' END AS run_stamp"


def _runs(df: DataFrame) -> DataFrame:
    return df.withColumn("run_stamp", F.col("run_stamp").cast("string"))


@query("batch_silver_titles", f"SELECT *, {stamped("source = 'tmdb'")} FROM ({shapes.SILVER_TITLES_SQL})")
def batch_silver_titles(spark, folder):
    silver, _, _ = silver_runs(spark, folder, "titles", "broken")
    return _runs(snapshots.scan_family(spark, silver, "silver_titles")).select(
        "canonical_title", "source_title", "source", "url", "source_id", "popularity", "source_id_all", "release_date_all", "run_stamp")


EVEN = f"(conv_id // {TALKS}) % 2 = 0"
REVIEWS_SQL = shapes.TWO_ARRAYS_SQL.replace("90.0 AS critics_score", f"CAST(90.0 AS DOUBLE) AS critics_score, {stamped(EVEN)}") + " WHERE trim(text) <> ''"


@query("batch_silver_reviews", REVIEWS_SQL)
def batch_silver_reviews(spark, folder):
    silver, _, _ = silver_runs(spark, folder, "reviews", "broken")
    rows = _runs(snapshots.scan_family(spark, silver, "silver_rt_reviews"))
    return rows.select(*shapes.TWO_ARRAYS_COLUMNS, F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("review_date"), "critics_score", "run_stamp")


@query("batch_rejects", f"""
SELECT 'tmdb_trending_movie_day_' || n_nationkey || '{docs.STAMPED}' AS file_name,
       CASE n_nationkey % 3 WHEN 0 THEN '{bronze.NOT_JSON}' ELSE '{bronze.NOT_OF_SCHEMA}' END AS reason,
       {stamped('n_nationkey % 2 = 0')} FROM nation WHERE n_nationkey % 3 < 2""")
def batch_rejects(spark, folder):
    """Broken documents with their reason. As they are not in the manifest, the second run meets those of the first again."""
    _, rejects, _ = silver_runs(spark, folder, "titles", "broken")
    found = _runs(spark.read.parquet(rejects))
    return found.groupBy("file_name", "reason").agg(F.min("run_stamp").alias("run_stamp"))


@query("batch_manifest", f"""
SELECT DISTINCT file_name, '2025-01-02' AS creation_day, '03:04:05' AS creation_time FROM (
  SELECT 'tmdb_now_playing_' || p_partkey // {docs.DOC_ITEMS} || '{docs.STAMPED}' AS file_name FROM part
  UNION ALL SELECT 'rottentomatoes_theaters_' || s_suppkey // {docs.DOC_ITEMS} || '{docs.STAMPED}' FROM supplier
  UNION ALL SELECT 'rottentomatoes_reviews_' || conv_id // {TALKS} || '{docs.STAMPED}' FROM conversations
  UNION ALL SELECT 'tmdb_movie_reviews_' || conv_id // {TALKS} || '{docs.STAMPED}' FROM conversations
  UNION ALL SELECT 'tmdb_trending_movie_day_' || n_nationkey || '{docs.STAMPED}' FROM nation WHERE n_nationkey % 3 = 2)""")
def batch_manifest(spark, folder):
    """Each file once, without the broken ones."""
    _, _, manifest = silver_runs(spark, folder)
    return spark.read.parquet(manifest).select("file_name", "creation_day", "creation_time")


# --- gold ------------------------------------------------------------------------

# The silver reviews of both runs, as far as facts read them.
SILVER_SQL = f"""WITH rt_reviews AS (
  SELECT canonical_title, 'rottentomatoes' AS source, review_type, reviewer_name, review_text, review_text_clean, sentiment_label, rating,
         CAST(review_date AS TIMESTAMP) AS review_date, critics_score, CAST(NULL AS DOUBLE) AS audience_score
  FROM ({shapes.TWO_ARRAYS_SQL}) WHERE review_text <> ''),
tmdb_reviews AS (
  SELECT movie_id, canonical_title, 'tmdb' AS source, reviewer_name, nullif(review_text, '') AS review_text, rating, review_id,
         TIMESTAMP '2024-01-05' AS review_date, 1.5 AS popularity, CAST(NULL AS DOUBLE) AS vote_average, total_reviews AS vote_count,
         2026 AS release_year, total_reviews
  FROM ({shapes.USER_REVIEWS_SQL}) QUALIFY row_number() OVER (PARTITION BY movie_id, review_id ORDER BY rating) = 1)
"""
STORED_KINDS = ("volume", "volume_by_source", "duplicates", "schema_compliance", "ingestion_frequency", "outlier_rate")


def stored_facts(spark: SparkSession, folder: str, *sources: str) -> str:
    """Silver and gold runs over these sources; returns the gold folder."""
    silver, _, _ = silver_runs(spark, folder, *sources)
    gold = shared_path(spark, "gold")
    jobs.run_gold(spark, silver, gold, GOLD, opinion.lexicon(spark))
    return gold


def _quality_sql() -> str:
    selects = []
    for name in ("rt_reviews", "tmdb_reviews"):
        spec = schemas.SILVER_SPECS[name]
        selects += [*quality.volume_sql(name), *quality.source_sql(name), *quality.duplicates_of(name, spec.duplicate_keys),
                    *quality.compliance_of(name, spec.required), *quality.frequency_of(name, "review_date"),
                    *[quality.outlier_select(name, c, name) for c in spec.numeric if (name, c) != ("tmdb_reviews", "popularity")]]
    body = "\nUNION ALL\n".join(selects).replace(quality.RUN.computed_at, GOLD.computed_at).replace(quality.RUN.run_stamp, GOLD.run_stamp)
    return f"{SILVER_SQL} {body}"


@query("batch_governance", _quality_sql())
def batch_governance(spark, folder):
    """Stored quality facts of both review families, read back as the newest gold run."""
    gold = stored_facts(spark, folder, "reviews", "user_reviews")
    facts = snapshots.latest_or_empty(spark, gold, "governance", schemas.GOVERNANCE_FACT)
    return facts.filter(F.col("kpi_type").isin(*STORED_KINDS) & F.col("family").isin("rt_reviews", "tmdb_reviews"))


@query("batch_storytelling", f"""{SILVER_SQL},
labelled AS (SELECT coalesce(sentiment_label, 'UNKNOWN') AS label, count(*) AS n FROM rt_reviews GROUP BY 1),
talks AS (SELECT canonical_title AS title, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, canonical_title) AS rank
          FROM tmdb_reviews GROUP BY 1 QUALIFY rank <= 15)
SELECT 'sentiment_distribution' AS aggregation_type, 'rt_sentiment_' || label AS metric_name, label AS dimension_value, 'rt_reviews' AS family,
       CAST(n AS DOUBLE) AS value FROM labelled
UNION ALL SELECT 'source_volume', 'rt_source_volume_rottentomatoes', 'rottentomatoes', 'rt_reviews', count(*) FROM rt_reviews
UNION ALL SELECT 'critic_vs_audience', 'rt_critic_vs_audience_' || canonical_title, canonical_title, 'rt_reviews', 90.0
          FROM (SELECT DISTINCT canonical_title FROM rt_reviews ORDER BY 1 LIMIT 10)
UNION ALL SELECT 'top_titles_by_reviews', 'tmdb_title_rank_' || rank, title, 'tmdb_reviews', n FROM talks
UNION ALL SELECT 'avg_rating_by_source', 'tmdb_avg_rating', 'tmdb', 'tmdb_reviews', round(avg(rating), 2) FROM tmdb_reviews""")
def batch_storytelling(spark, folder):
    gold = stored_facts(spark, folder, "reviews", "user_reviews")
    facts = snapshots.latest_or_empty(spark, gold, "storytelling", schemas.STORY_FACT)
    kept = [("rt_reviews", k) for k in ("sentiment_distribution", "source_volume", "critic_vs_audience")]
    kept += [("tmdb_reviews", k) for k in ("top_titles_by_reviews", "avg_rating_by_source")]
    chosen = F.struct("family", "aggregation_type").isin([F.struct(F.lit(f).alias("family"), F.lit(k).alias("aggregation_type")) for f, k in kept])
    return facts.filter(chosen).select("aggregation_type", "metric_name", "dimension_value", "family", "value")


@query("mart_stored_sources", f"""{SILVER_SQL}
SELECT 'rt_reviews · rottentomatoes' AS label, 'rt_reviews' AS family, 'source_volume' AS aggregation_type, CAST(count(*) AS DOUBLE) AS value FROM rt_reviews
UNION ALL SELECT 'titles · ' || source, 'titles', 'volume_by_source', count(*) FROM ({shapes.SILVER_TITLES_SQL}) GROUP BY source""")
def mart_stored_sources(spark, folder):
    """A mart over the stored gold layer, which is built once and read by any number of marts."""
    gold = stored_facts(spark, folder, "titles", "reviews")
    return marts.sources(snapshots.latest_or_empty(spark, gold, "storytelling", schemas.STORY_FACT))


@query("stream_documents", f"""
SELECT 'rottentomatoes_reviews_' || conv_id // {TALKS} || '{docs.STAMPED}' AS bronze_file_name, 'rt_reviews_theaters' AS bronze_source_type,
       'talk ' || conv_id AS canonical_title, count(*) AS reviews FROM conversations GROUP BY ALL""")
def stream_documents(spark, folder):
    """Raw review documents as a stream of JSON files, in two runs over one checkpoint."""
    raw, output, checkpoint = (shared_path(spark, n) for n in ("raw", "documents", "documents_checkpoint"))
    files = raw_files(spark, folder, ("reviews",))
    for number in (1, 2):
        lay_out(files.filter(F.col("run") == number).select("name", "value"), raw)
        stream = ingest.read_document_stream(spark, raw, schemas.TITLE_REVIEWS_DOC)
        running = ingest.ingest(stream.select("results", "bronze_file_name", "bronze_source_type"), output, checkpoint)
        running.awaitTermination()
    entries = spark.read.parquet(output).select("bronze_file_name", "bronze_source_type", F.explode("results").alias("item"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return entries.select(
        "bronze_file_name", "bronze_source_type", F.lower(F.btrim(F.regexp_replace("item.title", " +", " "))).alias("canonical_title"),
        (size("item.critic_reviews") + size("item.audience_reviews")).cast("bigint").alias("reviews"))
