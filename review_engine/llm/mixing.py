"""Mixing sources to target weights by Sainte-Laguë apportionment.

The size of a document is its number of words (runs of characters other than ASCII white
space). Sources in code point order, null last, weigh 1, 2, 3, repeating, and share all
words; a source's target stops at ``most`` times its size, the excess is shared again by
weight. Words are dealt in equal blocks: sources get blocks by highest quotients
(target / 1, / 3, / 5 ...), and each source's blocks go to its shards by the same rule, so
every quota is a whole number of blocks and no shard is asked for more than ``most`` times
its words. A shard is a bounded part of a source, by a seeded hash; a large source has
many. Its documents lie end to end in seeded order, as on a tape, and its quota is read
from the front and round again: each document is taken once a round, and the last one
where the reading ends in part. Reruns give the same rows.

Defined results: a null text has size 0; a null source is a source of its own; a source
without words has target 0; rows of equal key and text are each their own document (which
of them is taken is all one); an empty table gives no row. Above ``MOST_SOURCES`` sources
the mix is refused, as weights are then no list to be set by hand.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_engine.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 8
SHARD_WORDS = 1 << 18
MOST_SHARDS = 4096
MOST_SOURCES = 100_000
WEIGHTS = (1, 2, 3)


def targets(sizes: list[int], most: int = 3) -> list[float]:
    """Each source's share of all words by weight 1, 2, 3, repeating, none above ``most`` times its size."""
    total = sum(sizes)
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    # Sources reach their limit in the order of limit / weight; what is left is shared by weight.
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    out, left, weight = [0.0] * len(sizes), float(total), sum(weights)
    for at, i in enumerate(order):
        if most * sizes[i] >= left * weights[i] / weight:
            for j in order[at:]:
                out[j] = left * weights[j] / weight
            break
        out[i] = float(most * sizes[i])
        left -= out[i]
        weight -= weights[i]
    return out


def sainte_lague(shares: list[float], seats: int, limits: list[int]) -> list[int]:
    """Whole numbers by highest quotients share / (2 n + 1), none above its limit; ties to the first.

    A divisor that awards no seat too many is found first, so the rest to award one by one
    is no more than a seat for each party.
    """
    seats = min(seats, sum(limit for limit, share in zip(limits, shares, strict=True) if share > 0))

    def awarded(divisor: float) -> list[int]:
        return [min(limit, math.floor(s / divisor + 0.5)) if s > 0 else 0 for s, limit in zip(shares, limits, strict=True)]

    if seats <= 0:
        return [0] * len(shares)
    low, high = 0.0, 2.0 * max(shares) + 1.0
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (low, middle) if sum(awarded(middle)) <= seats else (middle, high)
    got = awarded(high)
    queue = [(-s / (2 * n + 1), i) for i, (s, n) in enumerate(zip(shares, got, strict=True)) if s > 0 and n < limits[i]]
    heapq.heapify(queue)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < limits[i]:
            heapq.heappush(queue, (-shares[i] / (2 * got[i] + 1), i))
    return got


def sized(docs: DataFrame, text: str, source: str, key: str, seed: int) -> DataFrame:
    """Key, source, size and seeded order of each document."""
    return docs.select(
        F.col(key).alias("doc"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(key), F.md5(F.col(text).cast("binary")), F.lit(seed)).alias("order"))


def _source_table(rows: DataFrame, block: int, shard_words: int, most: int) -> DataFrame:
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("words")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [r["words"] for r in found]
    aims = targets(words, most)
    quotas = sainte_lague(aims, sum(words) // block, [most * w // block for w in words])
    table = [(r["source"], r["source"] is None, w, aim, quota, max(1, min(MOST_SHARDS, -(-w // shard_words))))
             for r, w, aim, quota in zip(found, words, aims, quotas, strict=True)]
    # At most MOST_SOURCES short rows.
    return F.broadcast(spark.createDataFrame(
        table, "source string, is_null boolean, source_size long, target double, source_quota long, shards int"))


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _shard_quotas(block: int, most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def deal(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard", ignore_index=True)
        words = [int(w) for w in shards["words"]]
        quota = sainte_lague([float(w) for w in words], int(shards["source_quota"].iloc[0]), [most * w // block for w in words])
        return shards[["source", "shard", "words"]].assign(quota=quota)

    return deal


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 17,
        block: int = BLOCK, shard_words: int = SHARD_WORDS, most: int = 3) -> DataFrame:
    """One row per document: key, order (the seeded hash), size, source_size, target, taken."""
    rows = written(sized(docs, text, source, key, seed), "mix-sizes")
    sources = _source_table(rows, block, shard_words, most)
    placed = (rows.alias("r").join(sources.alias("s"), _same_source("r", "s"))
              .select("r.*", "source_size", "target", "source_quota",
                      F.pmod(F.xxhash64("order"), F.col("shards")).cast("int").alias("shard")))
    totals = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("source_quota").alias("source_quota"))
    quotas = totals.groupBy("source").applyInPandas(
        _shard_quotas(block, most), "source string, shard int, words long, quota long")
    tape = Window.partitionBy("r.source", "r.shard").orderBy("order", "doc", "size")
    asked = F.col("quota") * block
    rounds = F.floor(asked / F.col("words")).cast("long")
    begin = F.col("end") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), asked - rounds * F.col("words") - begin))
    return (placed.alias("r").join(quotas.alias("q"), _same_source("r", "q") & (F.col("r.shard") == F.col("q.shard")))
            .withColumn("end", F.sum("size").over(tape.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .select(F.col("doc").alias(key), "order", "size", "source_size", "target",
                    F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("size") * rounds + part).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
                    seed: int = 17, **options) -> DataFrame:
    """The documents of the mix, whole: each as many times as its taken words fill it, rounded.

    Only where a shard's reading ends is a document taken in part, so rounding moves a
    shard's words by half a document at most.
    """
    taken = mix(docs, text, source, key, seed, **options)
    copies = taken.select(F.col("order").alias("_order"), F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")))
                          .otherwise(0).cast("int").alias("_copies"))
    # Rows of equal key and text have equal order: their copies are dealt among them by number.
    number = Window.partitionBy("_order").orderBy(F.desc("_copies"))
    copies = copies.withColumn("_number", F.row_number().over(number))
    same = Window.partitionBy("_order").orderBy(F.lit(0))
    ordered = docs.withColumn("_order", F.xxhash64(F.col(key), F.md5(F.col(text).cast("binary")), F.lit(seed)))
    joined = ordered.withColumn("_number", F.row_number().over(same)).join(copies, ["_order", "_number"])
    return (joined.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
