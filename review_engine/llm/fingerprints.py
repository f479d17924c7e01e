"""Document fingerprints by a randomised edit embedding.

A walk over a text writes, at each step, the character it stands on, and then stays or
moves on by a random bit that depends on the step and the character. All texts share the
bits, so two walks over nearly equal texts fall into step again after an edit: edit
distance becomes Hamming distance between what the walks wrote. Of the embedding, 256
positions are sampled, and of each four bits of (position, the characters there). A
sampled position is the last record, within the embedding's length, of a fixed sequence of
records; so texts of like length share most positions, and any length has its 256.

Likeness of two fingerprints is the share of equal samples, less what chance gives. Near
duplicates are found by banding samples drawn from the fingerprint, then verified by
likeness against the whole fingerprint.

Defined results: a null text counts as empty; the empty text has its own fixed
fingerprint, like to itself (1) and unlike to others. A single document is its own next.
Rows of equal keys follow in the order of their texts; null keys come first; repeated rows
stay. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_engine.llm.common import code_points, mix, worker_cache, written
from review_engine.llm.components import components, forest

SAMPLES = 256
SEED = 20240
BATCH_CHARS = 1 << 23
STOP = 63
MOST_CUTS = 512
MOST_SENT = 100_000
BLOCK = 512
_STEPS = 4096
_REST = 64


def _records() -> dict[int, np.ndarray]:
    """Position to the samples that take it: each sample's records thin out as 1/position."""
    at: dict[int, list[int]] = {}
    for sample in range(SAMPLES):
        draw = np.random.default_rng([SEED, sample])
        position = 0
        while position < 1 << 40:
            at.setdefault(position, []).append(sample)
            position = int((position + 1) / max(draw.random(), 1e-9))
    return {p: np.array(s) for p, s in at.items()}


def _moves(first: int) -> np.ndarray:
    """For ``_STEPS`` steps from ``first``: whether the walk moves on, by symbol."""
    steps = np.arange(first, first + _STEPS, dtype=np.uint64)
    words = mix(steps * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))
    bits = (words[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    bits[:, STOP] = 0
    return bits.astype(np.int64)


def symbols(text: str) -> np.ndarray:
    return (((code_points(text) * np.uint32(0x9E3779B1)) >> np.uint32(20)) % np.uint32(63)).astype(np.uint8)


def embed(texts: list[str]) -> np.ndarray:
    """One row of ``SAMPLES`` four-bit samples for each text; the walks go in step."""
    records = worker_cache("walk-records", _records)
    out = np.zeros((len(texts), SAMPLES), np.uint8)
    stop = np.full(4, STOP, np.uint8)
    line = np.concatenate([x for t in texts for x in (symbols(t), stop)] or [stop])
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 4) - lengths - 4
    grams = line[:-3].astype(np.uint32)
    for k in (1, 2, 3):
        grams = (grams << np.uint32(6)) ^ line[k : len(line) - 3 + k]
    who = np.flatnonzero(lengths)
    place = begins[who]
    step = 0
    while len(who):
        moves = _moves(step)
        for row in range(_STEPS):
            if row % _REST == 0:
                going = line[place] != STOP
                if not going.all():
                    who, place = who[going], place[going]
                    if not len(who):
                        break
            taken = records.get(step)
            if taken is not None:
                walking = line[place] != STOP
                value = mix(grams[place[walking]].astype(np.uint64) + (np.uint64(step) << np.uint64(24)))
                out[np.ix_(who[walking], taken)] = (value[:, None] >> (taken % 16 * 4).astype(np.uint64)) & np.uint64(15)
            place += moves[row][line[place]]
            step += 1
    return out


def as_text(samples: np.ndarray) -> str:
    return (samples[::2] << 4 | samples[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.clip(((a == b).mean(axis=-1) - 1 / 16) * 16 / 15, 0.0, 1.0)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _described(rows: list[tuple], following: tuple) -> pd.DataFrame:
    """Rows in order, the last followed by ``following``."""
    texts = [t for _, t in [*rows, following]]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    made = embed(texts + changed)
    own, after, new = made[: len(rows)], made[1 : len(rows) + 1], made[len(texts) :]
    return pd.DataFrame({
        "key": pd.array([k for k, _ in rows], "Int64"), "n_chars": [len(t) for _, t in rows],
        "edited_sha256": [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
        "fingerprint": [as_text(x) for x in own], "edited_fingerprint": [as_text(x) for x in new],
        "near_edited": likeness(own, new), "near_next": likeness(own, after)})


def _batches(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket and key; the last row of a bucket is its guest, the row to follow."""
    held: list[tuple] = []
    chars, bucket = 0, None
    for frame in stream:
        for b, key, text in zip(frame["bucket"], frame["key"], frame["text"], strict=True):
            row = (None if pd.isna(key) else int(key), text)
            if b != bucket:
                if len(held) > 1:
                    yield _described(held[:-1], held[-1])
                held, chars, bucket = [], 0, b
            held.append(row)
            chars += len(text)
            if chars >= BATCH_CHARS and len(held) > 1:
                yield _described(held[:-1], held[-1])
                held, chars = [row], len(text)
    if len(held) > 1:
        yield _described(held[:-1], held[-1])


def _range_of(docs: DataFrame, key: str, buckets: int) -> Column:
    """The number of a key's range: quantile cuts, each parted again into equal widths."""
    if buckets == 1:
        return F.lit(0)
    coarse = min(buckets, MOST_CUTS)
    fine = -(-buckets // coarse)
    cuts = sorted({int(c) for c in docs.stat.approxQuantile(key, [i / coarse for i in range(coarse + 1)], 0.05 / coarse)})
    at = F.col("key")
    above = F.array(*[F.lit(c) for c in cuts])
    # Cuts are sorted: the number of cuts at or below the key. Null keys go to the first range.
    index = F.greatest(F.lit(1), F.size(F.filter(above, lambda c: c <= at)))
    low, high = F.get(above, index - 1), F.coalesce(F.get(above, index), F.lit(cuts[-1] + 1))
    inside = F.floor((at - low).cast("double") / (high - low) * fine).cast("long")
    return F.coalesce(index * fine + F.greatest(F.lit(0), F.least(inside, F.lit(fine - 1))), F.lit(0)).cast("long")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id",
                 bucket_chars: int = 1 << 24) -> DataFrame:
    """Each document's fingerprint, and that of the text edited with the next document."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text")).alias("chars"), F.count("key").alias("n")).first()
    buckets = max(1, min(size["n"], -(-(size["chars"] or 0) // bucket_chars)))

    # Ranges of keys, so that a document and its next are together. The first document of a
    # range is sent to the range before as well, as the one that follows (a guest).
    placed = rows.withColumn("bucket", _range_of(docs, key, buckets))
    order = [F.col("key").asc_nulls_first(), F.col("text")]
    lead = placed.groupBy("bucket").agg(F.min(F.struct(F.col("key").isNotNull().alias("k"), "key")).alias("first"))
    chain = Window.orderBy("bucket")
    guests = lead.select(
        F.col("first.key").alias("key"), F.col("bucket").alias("of"),
        F.coalesce(F.lag("bucket").over(chain),
                   F.max("bucket").over(chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("bucket"))
    wanted = guests.select(F.col("key").alias("k"), "of")
    if buckets <= MOST_SENT:  # one row of two numbers for each range
        wanted = F.broadcast(wanted)
    first_text = (placed.join(wanted, (F.col("bucket") == F.col("of")) & F.col("key").eqNullSafe(F.col("k")), "left_semi")
                  .groupBy("bucket").agg(F.min("text").alias("text")))
    sent = guests.join(first_text.withColumnRenamed("bucket", "of"), "of").select("bucket", "key", "text", F.lit(True).alias("guest"))
    everything = placed.select("bucket", "key", "text", F.lit(False).alias("guest")).unionByName(sent)
    sorted_rows = everything.repartition(buckets, "bucket").sortWithinPartitions("bucket", "guest", *order)
    made = sorted_rows.select("bucket", "key", "text").mapInPandas(
        _batches, "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  "near_edited double, near_next double")
    return made.withColumnRenamed("key", key)


def _name(key: str) -> Column:
    """The name of a class of equal fingerprints; a class of null keys is named by its fingerprint."""
    return F.coalesce(F.min(key), F.xxhash64("fingerprint"))


def _joined_up(marked: DataFrame, key: str, threshold: float = 0.8, bands: int = 32, drawn: int = 6) -> tuple[DataFrame, DataFrame]:
    """Links between documents of like fingerprints, and the components they give.

    Equal fingerprints are one class, stood for by its least key. A class shares a band with
    another if ``drawn`` sampled places agree. Each member of a band is verified against
    the band's head; heads are taken by one order of all classes, so the bands of a group agree on
    few of them, and links grow with the rows and not with the square of a group. Members that are
    then still in different groups are compared all the same, block by block inside tasks, which
    return the links that join what is apart. Joined up, the links give the groups that all pairs
    of all bands would give.
    """
    classes = written(marked.groupBy("fingerprint").agg(_name(key).alias("id")), "fingerprint-classes")
    places = np.random.default_rng(SEED).permuted(np.tile(np.arange(SAMPLES), (bands, 1)), axis=1)[:, :drawn]
    banded = F.array(*[F.concat_ws("", F.lit(f"{b}:"), *[F.substring("fingerprint", int(p) + 1, 1) for p in row])
                       for b, row in enumerate(places)])
    every = classes.select("id", F.explode(F.transform(banded, lambda b: F.xxhash64(b))).alias("band"))
    shared = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = written(every.join(shared, "band"), "fingerprint-bands")
    heads = members.groupBy("band").agg(F.min_by("id", F.struct(F.xxhash64("id"), "id")).alias("head"))
    pairs = members.join(heads, "band").where("id <> head").select(
        F.least("id", "head").alias("left"), F.greatest("id", "head").alias("right")).distinct()
    for side, name in (("left", "a"), ("right", "b")):
        pairs = pairs.join(classes.withColumnsRenamed({"id": side, "fingerprint": name}), side)
    same = F.size(F.filter(F.arrays_zip(F.split("a", "").alias("x"), F.split("b", "").alias("y")), lambda z: z["x"] == z["y"]))
    close = F.greatest(F.lit(0.0), (same / SAMPLES - 1 / 16) * 16 / 15)
    links = written(pairs.select("left", "right", close.alias("likeness")).where(F.col("likeness") >= threshold),
                    "fingerprint-links")
    named = components(_ends(links))
    grouped = members.join(named.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    apart = grouped.groupBy("band", "n").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y AND n > 2")
    rest = written(_links_in_blocks(grouped.join(apart.select("band"), "band", "left_semi"), classes, threshold).distinct(), "fingerprint-links")
    return links.union(rest), components(_ends(rest), named)


def near_duplicates(marked: DataFrame, key: str = "doc_id", threshold: float = 0.8, bands: int = 32, drawn: int = 6) -> DataFrame:
    """Links (left, right, likeness) between documents of like fingerprints that join up their groups."""
    return _joined_up(marked, key, threshold, bands, drawn)[0]


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("left").alias("a"), F.col("right").alias("b"))


def _links_in_blocks(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links between different components of bands (band, n, id, component), found inside tasks.

    A band of n members has n / BLOCK blocks; a task gets two of them, at most about 2 BLOCK members.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = members.select("band", "id", "component", own.alias("own"),
                           F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("band", "id", "component", "own", F.least("own", "other").alias("low"),
                         F.greatest("own", "other").alias("high"))

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        made = np.frombuffer(bytes.fromhex("".join(frame["fingerprint"])), np.uint8).reshape(len(frame), -1)
        made = np.stack([made >> 4, made & 15], axis=2).reshape(len(frame), SAMPLES)
        ids, component, own = (frame[c].to_numpy() for c in ("id", "component", "own"))
        apart = len(set(own)) > 1
        found: list[tuple[int, int, float]] = []

        def pairs() -> Iterator[tuple[int, int]]:
            for i in range(len(frame)):
                near = likeness(made[i], made)
                some = (near >= threshold) & (ids > ids[i]) & (component != component[i])
                if apart:
                    some &= own != own[i]
                for j in np.flatnonzero(some):
                    found.append((ids[i], ids[j], near[j]))
                    yield i, j

        kept = forest(component, pairs())
        out = [found[k] for k in kept]
        return pd.DataFrame(out, columns=["left", "right", "likeness"]).astype(
            {"left": "int64", "right": "int64", "likeness": "float64"})

    return dealt.join(classes, "id").groupBy("band", "low", "high").applyInPandas(linked, "left long, right long, likeness double")


def classed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints, with ``class_id``: the least key of the group of near duplicates."""
    marked = written(fingerprints(docs, text, key), "fingerprints")
    _, named = _joined_up(marked, key)
    classes = marked.groupBy("fingerprint").agg(_name(key).alias("node")).join(named, "node", "left").select(
        "fingerprint", F.coalesce("component", "node").alias("class_id"))
    return marked.join(classes, "fingerprint").select(*marked.columns, "class_id")
