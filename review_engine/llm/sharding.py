"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a row's hash. All rows start in one bucket of
depth 0; a bucket over the byte limit is split on the next bit, and only that one, until
every shard fits. Sizes for many depths come from one pass: bytes are counted by a long
prefix of the hash (a cell), and a bucket is the sum of its cells, so it is decided for
each cell at which depth its bucket first fits. Cells that are too large at their full
length are counted again, alone, with more bits.

Rows that are equal in key and text have equal hashes and no bit parts them. When all bits
are used up, they are dealt to as many numbered shards as the limit asks. One row larger
than the limit is a shard of its own.

Defined results: a null text has 0 bytes; null keys and repeated rows are hashed like any
other; an empty table gives no row and an empty directory; other columns pass through.
Only DataFrame operations are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_engine.llm.common import written

SHARD_BYTES = 64 << 20
HASH_BITS = 60
EXTRA_BITS = 4


def hash_bits(key: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of key and text, as a number."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("?")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(value: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", value, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int, extra_bits: int = EXTRA_BITS) -> DataFrame:
    """Cells of the directory (bits, prefix) with their shard (depth, shard_prefix, shard_bytes).

    ``rows`` has ``hash`` and ``n_bytes``. A cell belongs to the rows whose hash begins with its prefix.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + extra_bits)
    done, from_bits, left = None, 0, rows
    while True:
        cells = written(left.groupBy(_prefix(F.col("hash"), bits).alias("prefix")).agg(F.sum("n_bytes").alias("n_bytes")),
                        "shard-cells")
        # Bytes of the bucket of each cell at every depth of this round; it only falls with depth.
        buckets = cells.select(F.explode(F.sequence(F.lit(from_bits), F.lit(bits))).alias("depth"), "prefix", "n_bytes")
        above = F.call_function("shiftright", F.col("prefix"), (F.lit(bits) - F.col("depth")).cast("int"))
        sums = buckets.groupBy("depth", above.alias("shard_prefix")).agg(F.sum("n_bytes").alias("shard_bytes"))
        fits = (F.col("shard_bytes") <= limit) if bits < HASH_BITS else (
            (F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS))
        choices = cells.select("prefix", F.explode(F.sequence(F.lit(from_bits), F.lit(bits))).alias("depth")).withColumn(
            "shard_prefix", above)
        found = (choices.join(sums.where(fits), ["depth", "shard_prefix"])
                 .groupBy("prefix").agg(F.min(F.struct("depth", "shard_prefix", "shard_bytes")).alias("s"))
                 .select(F.lit(bits).alias("bits"), "prefix", "s.depth", "s.shard_prefix", "s.shard_bytes"))
        found = written(found, "shard-directory")
        done = found if done is None else done.unionByName(found)
        open_cells = cells.join(found, "prefix", "left_anti").select("prefix")
        if bits == HASH_BITS or open_cells.isEmpty():
            return done
        left = left.withColumn("prefix", _prefix(F.col("hash"), bits)).join(open_cells, "prefix", "left_semi").drop("prefix")
        from_bits, bits = bits + 1, min(HASH_BITS, bits + 12)


def shard(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: int = SHARD_BYTES,
          extra_bits: int = EXTRA_BITS) -> DataFrame:
    """Add ``n_bytes``, ``shard`` (depth and prefix bits, and a number where bits ran out), ``depth``, ``shard_bytes``."""
    docs = docs.drop("n_bytes", "shard", "depth", "shard_bytes")
    marks = docs.withColumns({
        "_hash": hash_bits(F.col(key), F.col(text)),
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")})
    narrow = written(marks.select(F.col("_hash").alias("hash"), "n_bytes"), "shard-rows")
    cells = directory(narrow, limit, extra_bits)
    rounds = [r["bits"] for r in cells.select("bits").distinct().collect()]
    by_round = None
    for bits in sorted(rounds):
        own = cells.where(F.col("bits") == bits).select(
            F.col("prefix").alias("_prefix"), "depth", F.col("shard_prefix").alias("_shard_prefix"), "shard_bytes")
        part = marks.withColumn("_prefix", _prefix(F.col("_hash"), bits)).join(own, "_prefix").drop("_prefix")
        by_round = part if by_round is None else by_round.unionByName(part)
    if by_round is None:
        by_round = marks.limit(0).withColumns({"depth": F.lit(0), "_shard_prefix": F.lit(0).cast("long"), "shard_bytes": F.lit(0).cast("long")})
    bits_text = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.lpad(F.conv(F.col("_shard_prefix").cast("string"), 10, 2), HASH_BITS, "0"))
    label = F.concat(F.lit("s"), F.expr(f"substring(lpad(_bits_text, {HASH_BITS}, '0'), {HASH_BITS} - depth + 1, depth)"))
    named = by_round.withColumn("_bits_text", bits_text).withColumn("shard", label)
    if HASH_BITS in rounds:
        named = _numbered(named, limit)
    return named.select(*[F.col(f"`{c}`") for c in docs.columns],
                        "n_bytes", "shard", "depth", "shard_bytes")


def _numbered(named: DataFrame, limit: int) -> DataFrame:
    """Deal rows of one full hash (equal rows) to numbered shards that fit.

    Equal rows have equal sizes, so a shard takes ``per`` of them. They are numbered within
    slices of the group, a bounded part each, after counts of the slices before.
    """
    whole = (F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit)
    fine, group = named.where(~whole), named.where(whole).withColumn("_slice", F.spark_partition_id())
    counts = group.groupBy("_hash", "_slice").agg(F.count("*").alias("n"))
    before = counts.select("_hash", "_slice", (F.sum("n").over(Window.partitionBy("_hash").orderBy("_slice")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("_hash", "_slice").orderBy(F.lit(0))) - 1
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("n_bytes"))))
    dealt = group.withColumn("_number", number).join(before, ["_hash", "_slice"]).withColumn(
        "_to", F.floor((F.col("before") + F.col("_number")) / per))
    bytes_of = F.sum("n_bytes").over(Window.partitionBy("_hash", "_to"))
    dealt = dealt.withColumns({"shard_bytes": bytes_of, "shard": F.concat(F.col("shard"), F.lit("-"), F.col("_to").cast("string"))})
    return fine.unionByName(dealt.select(*fine.columns))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard."""
    sharded.write.partitionBy("shard").parquet(path)


def shard_sql(limit: int = SHARD_BYTES, depths: int = 16) -> str:
    """The same rows in SQL, for tables whose shards are no deeper than ``depths``."""
    return f"""WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '?') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}))::BIGINT AS h
  FROM documents),
p AS (SELECT d.*, r.range::INTEGER AS depth, h >> ({HASH_BITS} - r.range)::INTEGER AS prefix FROM d, range(0, {depths + 1}) r),
s AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM p GROUP BY ALL HAVING sum(n_bytes) <= {limit})
SELECT doc_id, n_bytes, depth, shard_bytes,
       's' || CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), {HASH_BITS}, '0'), depth) END AS shard
FROM (SELECT p.doc_id, p.n_bytes, p.depth, p.prefix, s.shard_bytes,
             row_number() OVER (PARTITION BY p.doc_id, p.h ORDER BY p.depth) AS n
      FROM p JOIN s ON p.depth = s.depth AND p.prefix = s.prefix)
WHERE n = 1"""
