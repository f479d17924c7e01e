"""Sources, routing, manifest, snapshots and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from review_engine.functions.parsing import run_stamp
from review_engine.operators.shaping import conform
from review_engine.plans.registry import query
from review_engine.plans.tables import FAMILY_SQL, families, table, titles
from review_engine.schemas import FAMILY_BY_SOURCE_TYPE, MANIFEST, SOURCE_TYPE_BY_PREFIX
from review_engine.session import shared_path
from review_engine.sources import bronze, manifest, snapshots

STAMPED = "20250102_030405.json"
PREFIXES = [*SOURCE_TYPE_BY_PREFIX, "other_"]

# --- files and routing -------------------------------------------------------


INVENTORY_SQL = """SELECT doc_id::VARCHAR AS file_name, 1::BIGINT AS files, round(n_chars / (1024.0 * 1024), 2)::DOUBLE AS size_mb
FROM documents UNION ALL
SELECT 'TOTAL', count(*)::BIGINT, round(sum(n_chars) / (1024.0 * 1024), 2)::DOUBLE FROM documents"""


@query("file_inventory", INVENTORY_SQL)
def file_inventory(spark, folder):
    """The inventory of a listing in which each document stands for a file."""
    listing = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("file_name"), F.col("n_chars").alias("bytes"))
    return bronze.file_inventory(listing)


def document_file(number: Column) -> Column:
    """A raw file name per document, over all known prefixes and an unknown one."""
    prefix = F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (number % len(PREFIXES) + 1).cast("int"))
    return F.concat(prefix, F.lit(STAMPED))


FILES_SQL = "files AS (SELECT doc_id, CASE doc_id % {n} {whens} END || '{stamp}' AS file_name FROM documents)".format(
    n=len(PREFIXES), whens=" ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PREFIXES)), stamp=STAMPED
)
TYPE_SQL = "CASE {whens} END".format(
    whens=" ".join(
        f"WHEN starts_with(file_name, '{p}') THEN '{SOURCE_TYPE_BY_PREFIX[p]}'"
        for p in sorted(SOURCE_TYPE_BY_PREFIX, key=len, reverse=True)
    )
)
FAMILY_OF_SQL = "CASE {whens} ELSE 'ignored' END".format(
    whens=" ".join(f"WHEN source_type = '{t}' THEN '{f}'" for t, f in FAMILY_BY_SOURCE_TYPE.items())
)


@query("classify_source_type", f"WITH {FILES_SQL} SELECT doc_id, file_name, {TYPE_SQL} AS source_type FROM files")
def classify_source_type(spark, folder):
    files = table(spark, folder, "documents").select("doc_id", document_file(F.col("doc_id")).alias("file_name"))
    return files.withColumn("source_type", bronze.source_type(F.col("file_name")))


@query("route_family", f"""
WITH {FILES_SQL}, typed AS (SELECT doc_id, {TYPE_SQL} AS source_type FROM files)
SELECT doc_id, source_type, {FAMILY_OF_SQL} AS family FROM typed""")
def route_family(spark, folder):
    typed = table(spark, folder, "documents").select(
        "doc_id", bronze.source_type(document_file(F.col("doc_id"))).alias("source_type"))
    return bronze.route(typed, bronze.family_lookup(spark))


@query("missing_outputs", """
SELECT c_name AS file_name FROM customer WHERE c_name NOT IN (
  SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 400000)""")
def missing_outputs(spark, folder):
    """Expected names without a file that has bytes."""
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    expected = customer.select(F.col("c_name").alias("file_name"))
    files = customer.join(orders, customer.c_custkey == orders.o_custkey).select(
        F.col("c_name").alias("file_name"), F.greatest(F.col("o_totalprice") - 400000, F.lit(0)).alias("bytes"))
    return bronze.missing_outputs(expected, files)


# --- manifest ----------------------------------------------------------------


def order_path() -> Column:
    """A raw file path per order; every fifth has no stamp."""
    stamp = run_stamp(F.col("o_orderdate"))
    name = F.concat(F.lit("bronze/f"), F.col("o_orderkey").cast("string"), F.lit("_"), stamp, F.lit(".json"))
    bare = F.concat(F.lit("bronze/f"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    return F.when(F.col("o_orderkey") % 5 > 0, name).otherwise(bare)


ORDER_FILE = "'f' || o_orderkey || CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '_%Y%m%d_%H%M%S') ELSE '' END || '.json'"
DAY_SQL = "CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END"
TIME_SQL = "CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%H:%M:%S') END"
MANIFEST_SQL = (f"SELECT 'bronze/' || {ORDER_FILE} AS file_path, {ORDER_FILE} AS file_name, {DAY_SQL} AS creation_day, "
                f"{TIME_SQL} AS creation_time FROM orders")


@query("manifest_parse", MANIFEST_SQL)
def manifest_parse(spark, folder):
    return manifest.manifest_rows(table(spark, folder, "orders").select(order_path().alias("file_path")))


@query("incremental_new_files", f"SELECT 'bronze/' || {ORDER_FILE} AS file_path FROM orders WHERE o_totalprice >= 250000")
def incremental_new_files(spark, folder):
    orders = table(spark, folder, "orders")
    files = orders.select(order_path().alias("file_path"))
    processed = orders.filter("o_totalprice < 250000").select(order_path().alias("file_path"))
    return bronze.new_files(files, manifest.manifest_rows(processed))


@query("manifest_append", MANIFEST_SQL)
def manifest_append(spark, folder):
    """Two overlapping runs leave one row per path."""
    orders = table(spark, folder, "orders")
    known = manifest.manifest_rows(orders.filter("o_totalprice < 250000").select(order_path().alias("file_path")))
    processed = orders.filter("o_totalprice > 200000").select(order_path().alias("file_path"))
    return manifest.append_to_manifest(known, processed.unionByName(processed))


@query("manifest_load", MANIFEST_SQL)
def manifest_load(spark, folder):
    """A manifest on disk, first imported from the older plain list of paths."""
    paths = table(spark, folder, "orders").select(order_path().alias("value"))
    text, path = shared_path(spark, "paths"), shared_path(spark, "manifest")
    paths.write.text(text)
    imported = manifest.load_manifest(spark, path, text)
    conform(imported, MANIFEST).write.parquet(path)
    return manifest.load_manifest(spark, path, text)


# --- snapshots ---------------------------------------------------------------

RUNS = ("20250101_000000", "20250102_000000")


@query("read_family_drift", """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE run WHEN 1 THEN CAST(user_id AS VARCHAR) ELSE CAST(CAST(user_id AS DOUBLE) AS VARCHAR) END AS user_id,
       CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
       CASE run WHEN 2 THEN props END AS props, '2025010' || run || '_000000' AS run_stamp
FROM events, (VALUES (1), (2)) AS r(run)""")
def read_family_drift(spark, folder):
    """Two runs written with different types and columns, read back as text."""
    base = shared_path(spark, "drift")
    events = table(spark, folder, "events")
    kind = F.when(F.col("event_type") == "view", "<NA>").otherwise(F.col("event_type")).alias("event_type")
    snapshots.write_snapshot(events.select("event_id", "user_id", kind), base, "events", RUNS[0])
    snapshots.write_snapshot(
        events.select("event_id", F.col("user_id").cast("double").alias("user_id"), kind, "props"), base, "events", RUNS[1])
    return snapshots.read_family_drift(spark, base, "events").select(
        "event_id", "user_id", "event_type", "props", "run_stamp")


def two_runs(spark, folder, base: str) -> None:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    snapshots.write_snapshot(orders.filter("o_totalprice < 250000"), base, "orders", RUNS[0])
    snapshots.write_snapshot(orders.filter("o_totalprice >= 250000"), base, "orders", RUNS[1])


@query("scan_family_parquet", f"""
SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice < 250000 THEN '{RUNS[0]}' ELSE '{RUNS[1]}' END AS run_stamp FROM orders""")
def scan_family_parquet(spark, folder):
    base = shared_path(spark, "scan")
    two_runs(spark, folder, base)
    return snapshots.scan_family(spark, base, "orders").select("o_orderkey", "o_totalprice", "run_stamp")


@query("latest_snapshot", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def latest_snapshot(spark, folder):
    """Each order date is a run; the newest one is looked up in the same plan and pushed to the scan."""
    return snapshots.latest(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey", "o_totalprice")


@query("latest_snapshot_or_empty", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000")
def latest_snapshot_or_empty(spark, folder):
    """The newest run of a family that exists, and of one that does not."""
    base = shared_path(spark, "latest")
    two_runs(spark, folder, base)
    schema = table(spark, folder, "orders").select("o_orderkey", "o_totalprice").schema
    found = snapshots.latest_or_empty(spark, base, "orders", schema)
    return found.unionByName(snapshots.latest_or_empty(spark, base, "absent", schema))


def written_twice(spark, df, family: str):
    """The same stamp written twice holds the rows once."""
    base = shared_path(spark, family)
    for _ in range(2):
        snapshots.write_snapshot_if_any(df, base, family, RUNS[0])
    return snapshots.scan_family(spark, base, family)


@query("sink_silver_roundtrip", f"""{FAMILY_SQL} SELECT *, '{RUNS[0]}' AS run_stamp FROM titles""")
def sink_silver_roundtrip(spark, folder):
    return written_twice(spark, titles(spark, folder), "silver_titles")


@query("sink_gold_roundtrip", f"""
SELECT o_orderpriority AS source, CAST(count(*) AS DOUBLE) AS value, '{RUNS[0]}' AS run_stamp FROM orders GROUP BY 1""")
def sink_gold_roundtrip(spark, folder):
    facts = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("source")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return written_twice(spark, facts, "gold_facts")


SUMMARY_FAMILIES = ("titles", "critic_reviews", "user_reviews")


@query("run_summary", FAMILY_SQL + " UNION ALL ".join(
    f"SELECT '{f}' AS family, count(*) AS rows, CASE WHEN count(*) > 0 THEN 'silver/{f}' END AS path FROM {f}"
    for f in SUMMARY_FAMILIES) + " UNION ALL SELECT 'none' AS family, count(*) AS rows, CASE WHEN count(*) > 0 THEN 'silver/none' END AS path FROM titles WHERE source_id < 0")
def run_summary(spark, folder):
    outputs = {f: (df, f"silver/{f}") for f, df in families(spark, folder, SUMMARY_FAMILIES).items()}
    outputs["none"] = (titles(spark, folder).filter("source_id < 0"), "silver/none")
    return snapshots.run_summary(outputs)
