"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Shingles are five words (runs of letters and digits, lower case; a text with fewer words is
one shingle). A sketch takes the four least of a text's shingles under one of its hash
functions, a repeated shingle being told apart by its occurrence number, and keeps them in
text order: equal sketches tell of shared shingles in the same order. Texts with an equal
sketch are candidates. A candidate is verified on the whole texts: shared shingles over all
shingles must reach 0.8, and so must, to ``IN_ORDER``, those that a banded alignment of the
two shingle sequences brings together in order.
Groups are the connected components of verified links.

Exact copies are one node, so a group of copies costs one sketch. Within a bucket, all
members are first compared with its most central one (whose buckets are the largest), a
few rounds of centres for the members still apart. What is then still in different groups
is compared all the same: pair by pair in buckets of a few texts, block by block inside
tasks in larger ones, where only the links come out. So pairs grow with the rows, tasks hold a
bounded number of texts, and no link between different texts in a bucket is passed over. A task
returns those links only that join groups still apart (a spanning forest), so there are fewer of
them than members, however many pairs of a group are alike.

Defined results: a null text counts as empty. Texts without words are alike only if equal.
A key names one document: rows that share a key share its class. A null key is named by its
text. The class is the least key of the group; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import groups, mix, unused, word_hashes, written
from review_engine.llm.components import components, forest

WORDS = 5
THRESHOLD = 0.8
IN_ORDER = 0.7
SKETCHES = 14
TAKEN = 4
CENTRE_ROUNDS = 2
FEW = 8
BLOCK = 256
_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of each run of ``size`` words in order; of the whole text if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * _P + words[k : len(words) - size + 1 + k]
    return mix(total + np.uint64(size))


def labelled(runs: np.ndarray) -> np.ndarray:
    """Shingle hashes that tell the second, third ... occurrence of a shingle from the first."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if fresh.all():
        return runs
    at = np.arange(len(runs))
    occurrence = np.empty(len(runs), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(occurrence > 0, mix(runs + occurrence * _P), runs)


def sketches(runs: np.ndarray) -> np.ndarray:
    """One 64-bit sketch for each hash function."""
    taken = min(TAKEN, len(runs))
    seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _P) | np.uint64(1)
    marked = labelled(runs)
    ranks = (marked * seeds[:, None]) ^ (marked >> np.uint64(29))
    least = np.sort(np.argpartition(ranks, taken - 1, axis=1)[:, :taken], axis=1)
    total = np.zeros(SKETCHES, np.uint64)
    for k in range(taken):
        total = mix(total * _P + marked[least[:, k]])
    return total


def aligned(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Most shingles that can be aligned in order, none further than ``band`` off the diagonal."""
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    head = n if same.all() else int(same.argmin())
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    same = x[len(x) - n :][::-1] == y[len(y) - n :][::-1]
    tail = n if same.all() else int(same.argmin())
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if not len(x) or not len(y):
        return head + tail
    places: dict[int, int] = {}
    for i, shingle in enumerate(x.tolist()):
        places[shingle] = places.get(shingle, 0) | 1 << i
    # Bit i of ``open_`` is clear where one more of x[: i + 1] is aligned.
    full = (1 << len(x)) - 1
    open_, window = full, (1 << (2 * band + 1)) - 1
    for j, shingle in enumerate(y.tolist()):
        match = places.get(shingle)
        if match is not None:
            match &= window << (j - band) if j >= band else window >> (band - j)
            both = open_ & match
            open_ = ((open_ + both) | (open_ - both)) & full
    return head + tail + len(x) - open_.bit_count()


def similarity(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Shared shingles over all; 0 where they are too few, or too few of them align in order."""
    if not len(x) or not len(y):
        return 0.0
    total = len(x) + len(y)
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return 0.0
    shared = len(np.intersect1d(labelled(x), labelled(y), assume_unique=True))
    if shared < threshold * (total - shared):
        return 0.0
    # So many shingles in all are left unaligned at ``IN_ORDER``.
    band = int(total * (1 - IN_ORDER) / (1 + IN_ORDER)) + 1
    together = aligned(x, y, band)
    return shared / (total - shared) if together >= IN_ORDER * (total - together) else 0.0


def _all_shingles(texts: list[str]) -> Iterator[np.ndarray]:
    for first, last in groups(texts):
        words, firsts, _, _ = word_hashes(texts[first:last])
        for a, b in zip(firsts, firsts[1:], strict=False):
            yield shingles(words[a:b])


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = list(_all_shingles(batch["text"].tolist()))
        yield pd.DataFrame({"digest": batch["digest"], "key": batch["key"], "length": [len(r) for r in made],
                            "sketches": [sketches(r).view(np.int64) if len(r) else [] for r in made]})


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = list({*batch["text_a"], *batch["text_b"]})
        runs = dict(zip(texts, _all_shingles(texts), strict=True))
        alike = [similarity(runs[a], runs[b]) for a, b in zip(batch["text_a"], batch["text_b"], strict=True)]
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": alike})


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


class _Search:
    """Candidate texts, their buckets and the links found so far."""

    def __init__(self, docs: DataFrame, text: str, key: str):
        rows = docs.select(_digest(F.col(text)).alias("digest"), F.col(key).cast("long").alias("key"),
                           F.coalesce(F.col(text), F.lit("")).alias("text"))
        made = rows.mapInPandas(_sketched, "digest binary, key long, length long, sketches array<long>")
        # One node for each text: named by its least key.
        self.nodes = written(made.groupBy("digest").agg(
            F.coalesce(F.min("key"), F.xxhash64("digest")).alias("node"), F.first("length").alias("length"),
            F.first("sketches").alias("sketches")), "omh-nodes")
        banded = self.nodes.select("node", "length", F.posexplode("sketches").alias("band", "sketch"))
        sizes = banded.groupBy("band", "sketch").agg(F.count("*").alias("n")).where("n > 1")
        shared = written(banded.join(sizes, ["band", "sketch"]), "omh-shared")
        weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
        self.buckets = written(shared.join(weights, "node").select(
            F.xxhash64("band", "sketch").alias("bucket"), "node", "length", "weight"), "omh-buckets")
        wanted = weights.select("node").join(self.nodes.select("node", "digest"), "node")
        self.texts = written(rows.join(wanted, "digest").groupBy("node").agg(F.first("text").alias("text")), "omh-texts")
        self.named: DataFrame | None = None
        self.tested: DataFrame | None = None

    def grouped(self) -> DataFrame:
        """Buckets with each member's component so far."""
        if self.named is None:
            return self.buckets.withColumn("component", F.col("node"))
        return self.buckets.join(self.named, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def open_buckets(self) -> DataFrame:
        """Members of buckets that still hold more than one component."""
        members = written(self.grouped(), "omh-grouped")
        apart = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        return members.join(apart.select("bucket"), "bucket", "left_semi")

    def test(self, pairs: DataFrame, threshold: float) -> None:
        """Verify pairs (a < b) that were not verified before."""
        near = pairs.where(F.least("length_a", "length_b") >= threshold * F.greatest("length_a", "length_b"))
        fresh = near.groupBy("a", "b").agg(F.lit(1).alias("one")).drop("one")
        if self.tested is not None:
            fresh = fresh.join(self.tested, ["a", "b"], "left_anti")
        named = {x: self.texts.withColumnsRenamed({"node": x, "text": f"text_{x}"}) for x in "ab"}
        checked = written(fresh.join(named["a"], "a").join(named["b"], "b").mapInPandas(
            _verified, "a long, b long, similarity double"), "omh-checked")
        self.join_up(checked.where(F.col("similarity") >= threshold).select("a", "b"))
        seen = checked.select("a", "b")
        self.tested = seen if self.tested is None else self.tested.union(seen)

    def join_up(self, links: DataFrame) -> None:
        self.named = components(links, self.named)


def _pair(left: str, right: str) -> list[Column]:
    a, b = F.col(left), F.col(right)
    swap = F.col(f"{left}.node") > F.col(f"{right}.node")
    return [F.when(swap, b["node"]).otherwise(a["node"]).alias("a"), F.when(swap, a["node"]).otherwise(b["node"]).alias("b"),
            a["length"].alias("length_a"), b["length"].alias("length_b")]


def _links_in_blocks(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between different components of large buckets (bucket, n, me), found inside tasks.

    A bucket of n members has n / BLOCK blocks; a task gets two of them, at most about 2 BLOCK texts.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("me.node"), blocks).cast("int")
    dealt = members.select("bucket", "me.node", "me.component", own.alias("own"),
                           F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("node", "component", "bucket", "own", F.least("own", "other").alias("low"),
                         F.greatest("own", "other").alias("high"))

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        runs = list(_all_shingles(frame["text"].tolist()))
        sets = [np.unique(labelled(r)) for r in runs]
        sizes = np.array([len(x) for x in sets])
        node, component, own = (frame[c].to_numpy() for c in ("node", "component", "own"))
        shared = _shared(sets)
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        enough = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
        enough &= (node[:, None] < node[None, :]) & (component[:, None] != component[None, :])
        if low != high:
            enough &= own[:, None] != own[None, :]
        pairs = np.argwhere(enough)
        kept = forest(component, pairs, lambda i, j: similarity(runs[i], runs[j], threshold) >= threshold)
        out = [(node[i], node[j]) for i, j in pairs[kept]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.join(texts, "node").groupBy("bucket", "low", "high").applyInPandas(linked, "a long, b long")


def _shared(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """How many shingles each two of the sets share."""
    found, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(found), columns):
        a, b = np.searchsorted(at, [first, first + columns])
        has = np.zeros((len(sets), columns), np.float32)
        has[row[a:b], at[a:b] - first] = 1
        total += has @ has.T
    return total


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``class_id``, the least key among the documents alike to this one (its own if none is)."""
    docs = docs.drop("class_id")
    search = _Search(docs, text, key)
    me = F.struct("node", "length", "component").alias("me")
    for _ in range(CENTRE_ROUNDS):
        members = search.open_buckets().select("bucket", "weight", me)
        # The centre: of the members apart from the largest group met so far, the one of most weight.
        counts = members.groupBy("bucket", "me.component").agg(
            F.count("*").alias("n"), F.max(F.struct("weight", "me")).alias("top"))
        centres = counts.groupBy("bucket").agg(
            F.min(F.struct(F.col("n"), -F.col("top.weight"), F.col("top.me").alias("me"))).alias("c") if search.named is not None
            else F.max(F.struct(F.col("top.weight"), F.col("top.me").alias("me"))).alias("c")).select(
            "bucket", F.col("c.me").alias("centre"))
        pairs = members.join(centres, "bucket").where("me.component <> centre.component").select(*_pair("centre", "me"))
        search.test(pairs, threshold)
    members = search.open_buckets().select("bucket", me)
    members = written(members.join(members.groupBy("bucket").agg(F.count("*").alias("n")), "bucket"), "omh-rest")
    few = members.where(F.col("n") <= FEW)
    left, right = few.withColumnRenamed("me", "x"), few.withColumnRenamed("me", "y")
    rest = left.join(right, "bucket").where("x.node < y.node AND x.component <> y.component").select(*_pair("x", "y"))
    search.test(rest, threshold)
    search.join_up(_links_in_blocks(members.where(F.col("n") > FEW), search.texts, threshold))
    named = search.named
    classes = search.nodes.select("digest", "node").join(named, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class_id"))
    by = unused(docs, "digest")
    marked = docs.withColumn(by, _digest(F.col(text)))
    return marked.join(classes.withColumnRenamed("digest", by), by).select(*[F.col(f"`{c}`") for c in docs.columns], "class_id")


def one_of_each(classed: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The document that stands for each class; repeated rows of it once."""
    own = F.coalesce(F.col(key).cast("long"), F.xxhash64(_digest(F.col(text))))
    return classed.where(own == F.col("class_id")).dropDuplicates(["class_id"])
