"""Sentiment by lexicon, label filling, keyword and n-gram counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.functions.text import tokens

POSITIVE_FROM = 0.1
NEGATIVE_TO = -0.1
# Buckets that n-grams are first counted by, and how many of the heaviest are counted by name for each row asked for.
NGRAM_BUCKETS = 1 << 16
HEAVY_BUCKETS = 64


def label_of(polarity: Column) -> Column:
    return (
        F.when(polarity >= POSITIVE_FROM, "POSITIVE").when(polarity <= NEGATIVE_TO, "NEGATIVE").otherwise("NEUTRAL")
    )


def polarity(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity and label per document.

    ``lexicon`` (word, polarity, intensity) rates words; a word with an intensity
    scales the rated word after it, and a negative intensity turns it round.
    Each token is paired with the one before it inside its own row, so words and
    scales are plain lookups. Whether the lexicon is broadcast is left to the
    planner, which knows its size. Sums are built per task before the shuffle,
    so what moves is one row per document and task.
    """
    words = df.select(key, tokens(F.col(text)).alias("word"))
    before = F.concat(F.array(F.lit(None).cast("string")), "word")
    paired = words.select(key, "word", before.alias("before"))
    long = paired.select(key, F.inline_outer(F.arrays_zip("word", "before")))
    rated = lexicon.filter(F.col("polarity").isNotNull()).select("word", "polarity")
    scales = lexicon.filter(F.col("intensity").isNotNull()).select(
        F.col("word").alias("before"), F.col("intensity").alias("scale")
    )
    scored = long.join(rated, "word", "left").join(scales, "before", "left")
    value = F.avg(F.col("polarity") * F.coalesce("scale", F.lit(1.0)))
    # adding 0 turns a negative zero into zero
    mean = F.round(F.coalesce(value, F.lit(0.0)), 6) + F.lit(0.0)
    return scored.groupBy(key).agg(mean.alias("polarity")).withColumn("sentiment_label", label_of(F.col("polarity")))


def fill_labels(df: DataFrame, key: str, text: str, lexicon: DataFrame, label: str = "sentiment_label",
                fill: str = "column") -> DataFrame:
    """Labels from the text where the data has none.

    ``fill="column"`` fills only if no row at all has a label, which a look for
    one label decides before any text is read; ``fill="row"`` fills each missing
    label.
    """
    if label not in df.columns:
        df = df.withColumn(label, F.lit(None).cast("string"))
    if fill == "column" and not df.filter(F.col(label).isNotNull()).isEmpty():
        return df
    predicted = polarity(df, key, text, lexicon).select(key, F.col("sentiment_label").alias("_predicted"))
    filled = df.join(predicted, key, "left")
    return filled.withColumn(label, F.coalesce(label, "_predicted")).drop("_predicted")


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """Mentions per token; counted in each task before the shuffle."""
    return df.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("mentions")
    )


def ngrams(df: DataFrame, text: str, n: int) -> DataFrame:
    """A row per run of ``n`` tokens, its words in columns.

    Texts with fewer tokens are left out by slices without length, not by a filter: that would be
    pushed below the tokens and find them a second time.
    """
    names = [f"_w{i}" for i in range(n)]
    words = df.select(tokens(F.col(text)).alias("_words"))
    # the same words shifted by one place each, cut to the number of n-grams
    length = F.greatest(F.size("_words") - (n - 1), F.lit(0))
    shifted = words.select(*[F.slice("_words", i + 1, length).alias(name) for i, name in enumerate(names)])
    return shifted.select(F.inline(F.arrays_zip(*names)))


def count_ngrams(grams: DataFrame, names: list[str]) -> DataFrame:
    counted = grams.groupBy(*names).agg(F.count(F.lit(1)).alias("mentions"))
    return counted.select(F.concat_ws(" ", *names).alias("ngram"), "mentions")


def ngram_counts(df: DataFrame, text: str, n: int = 2) -> DataFrame:
    """Mentions per run of ``n`` tokens."""
    grams = ngrams(df, text, n)
    return count_ngrams(grams, grams.columns)


def top_ngrams(df: DataFrame, text: str, k: int, n: int = 2, buckets: int = NGRAM_BUCKETS) -> DataFrame:
    """The ``k`` most frequent runs of ``n`` tokens, ties by name; the same rows as ``top_counts`` of all counts.

    Most n-grams are rare, and counting each by name shuffles nearly all of them. So they are first counted by
    hashed bucket: no n-gram has more mentions than its bucket. Those of the heaviest buckets are then counted by
    name, and so are those of any other bucket that reaches the k-th of these counts; the rest can't be among the top.
    Where counts are so even that most buckets reach it, this counts everything by name. The work on buckets is the
    same exchange wherever it is named, so texts are read twice, and a third time only if other buckets reach it.
    """
    grams = ngrams(df, text, n)
    names = grams.columns
    # never null, or the join would put a filter below the counts, and they would be made once with it and once without;
    # ``buckets`` is a power of two
    grams = grams.withColumn("_bucket", F.xxhash64(*names).bitwiseAND(F.lit(buckets - 1)))
    totals = grams.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_total"))
    total = F.col("_total")
    cut = totals.orderBy(total.desc()).limit(HEAVY_BUCKETS * k).agg(F.min("_total")).scalar()

    def counts(chosen: DataFrame) -> DataFrame:
        return count_ngrams(grams.join(F.broadcast(chosen.select("_bucket")), "_bucket", "left_semi"), names)

    heavy = counts(totals.filter(total >= cut))
    kth = F.when(F.count(F.lit(1)) == k, F.min("mentions")).otherwise(0)
    reached = heavy.orderBy(F.col("mentions").desc()).limit(k).agg(kth).scalar()
    others = counts(totals.filter((total < cut) & (total >= reached)))
    return top_counts(heavy.unionByName(others), "ngram", k)


def top_counts(counts: DataFrame, item: str, k: int, count: str = "mentions") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(item).asc()).limit(k)
