"""Exact quantiles of many columns by distributed selection, on one path at every size.

Values are counted (equal ones share a row), the counted values are parted by range and written,
and the number of values below each part is summed over the parts. A rank then lies in one part
only, and only that part is ordered. What is ordered or held in one task is one range part, whose
size the session's number of shuffle partitions sets; the data is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_engine.session import shared_path

RELATIVE_ERROR = 1e-4


def long_values(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(series, value): the numbers of several columns under each other, without NULL."""
    entries = [F.struct(F.lit(name).alias("series"), value.cast("double").alias("value")) for name, value in values.items()]
    return df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())


def histogram(values: DataFrame) -> DataFrame:
    """(part, series, value, n): how often each value occurs, parted by range and written."""
    counted = values.groupBy("series", "value").agg(F.count(F.lit(1)).alias("n"))
    parted = counted.repartitionByRange("series", "value").select(F.spark_partition_id().alias("part"), "series", "value", "n")
    path = shared_path(values.sparkSession, "histogram")
    parted.write.parquet(path)
    return values.sparkSession.read.schema(parted.schema).parquet(path)


def series_quantiles(counts: DataFrame, probabilities: list[float]) -> DataFrame:
    """(series, total, q0, q1, ...): number of values and linearly interpolated quantiles of a histogram."""
    parts = counts.groupBy("series", "part").agg(F.sum("n").alias("inside"))
    in_order = Window.partitionBy("series").orderBy("part")
    total = F.sum("inside").over(Window.partitionBy("series"))
    # One row for each range part, whatever the data holds.
    placed = parts.select("series", "part", total.alias("total"), (F.sum("inside").over(in_order) - F.col("inside")).alias("below"), "inside")
    place = [F.lit(p) * (F.col("total") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in place for f in (F.floor, F.ceil)]))
    wanted = placed.select("series", "part", "total", "below", "inside", F.explode(ranks).alias("rank")).filter(
        (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("inside"))).drop("inside")
    # At most two ranks for each probability and series, all of them in as many parts.
    held = counts.join(F.broadcast(wanted.select("series", "part").distinct()), ["series", "part"], "left_semi")
    upto = F.sum("n").over(Window.partitionBy("series", "part").orderBy("value"))
    found = held.withColumn("upto", upto).join(F.broadcast(wanted), ["series", "part"]).filter(
        (F.col("below") + F.col("upto") > F.col("rank")) & (F.col("below") + F.col("upto") - F.col("n") <= F.col("rank")))
    low = [F.max(F.when(F.col("rank") == F.floor(x), F.col("value"))) for x in place]
    high = [F.max(F.when(F.col("rank") == F.ceil(x), F.col("value"))) for x in place]
    share = [F.max(x - F.floor(x)) for x in place]
    return found.groupBy("series").agg(
        F.max("total").alias("total"),
        *[(a + (b - a) * s).alias(f"q{i}") for i, (a, b, s) in enumerate(zip(low, high, share, strict=True))])


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, tuple[int, list[float]]]:
    """Count and linearly interpolated quantiles per column, at once; (0, []) for a column without values."""
    if not columns:
        return {}
    found = series_quantiles(histogram(long_values(df, {c: F.col(c) for c in columns})), probabilities)
    result: dict[str, tuple[int, list[float]]] = {c: (0, []) for c in columns}
    for row in found.collect():  # one row per column
        result[row.series] = (row.total, [row[f"q{i}"] for i in range(len(probabilities))])
    return result


def approx_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, tuple[int, list[float]]]:
    """As ``exact_quantiles`` from one sketch pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    rows = df.approxQuantile(columns, probabilities, RELATIVE_ERROR)
    return {c: (counts[c], q) for c, q in zip(columns, rows)}
