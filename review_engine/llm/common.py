"""Helpers shared by the operators: tables, cut lineage, worker caches, folded words."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from review_engine.session import configure, shared_path

# Texts are worked through in groups of about so many characters, to bound memory.
GROUP_CHARS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def bounded(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small batches, as texts can be long."""
    spark = configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that a table does not have, whatever its user's columns are called."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def worker_cache(key: str, build: Callable[[], object]) -> object:
    """A value kept for the life of this Python process, whichever task runs."""
    kept = sys.modules.setdefault("_review_engine_worker", type(sys)("_review_engine_worker")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _fold_table(letters_only: bool) -> np.ndarray:
    def fold(i: int) -> int:
        c = chr(i)
        return ord(c.lower()[0]) if (c.isalpha() if letters_only else c.isalnum()) else 0

    return np.fromiter(map(fold, range(0x110000)), np.uint32, 0x110000)


def fold_table(letters_only: bool = False) -> np.ndarray:
    """Code point to its lower-case letter (or digit); 0 for everything else."""
    return worker_cache(f"fold-{letters_only}", lambda: _fold_table(letters_only))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = worker_cache("powers", dict)
    if have.get("n", 0) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            have[name] = np.cumprod(step)
        have["n"] = n
    return have["up"], have["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters; a longer text is a range of its own."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of letters and digits, lower case) of joined texts.

    Returns the 64-bit hash of each word, where each text's words begin (one entry
    more than texts), and where each word begins and ends among the joined characters.
    """
    points = fold_table()[code_points("\n".join(texts) + "\n")]
    inside = np.empty(len(points) + 1, bool)
    inside[0], inside[1:] = False, points != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    up, down = _powers(len(points) + 1)
    sums = np.empty(len(points) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    hashes = mix((sums[ends] - sums[begins]) * down[begins])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.concatenate([[0], np.searchsorted(begins, text_ends)])
    return hashes, firsts, begins, ends
