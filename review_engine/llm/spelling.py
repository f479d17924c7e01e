"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

The words of the corpus are counted by Spark. Their vocabulary goes into blocked Bloom filters,
one shard for each length, whose total size has a fixed bound (a larger vocabulary gets fewer
bits a word, so more false positives, never a lost link); the filters are broadcast. Each word's
edits are generated as hashes only: a rolling hash gives the hash of every edit from that of the
word. Being near is symmetric, so deletions (the inverse of insertions) and replacements by a
larger character are all that is probed. Only edits the filters hold are spelled out and shuffled,
to an exact join with the vocabulary that removes the false ones.

Chains of forms are followed by doubling: each round joins a word's form with that form's form.
Frequencies at least double along a chain, so rounds are few; each is a written table.

Defined results: a null or empty text has no words; a null key counts as an empty one. Repeated
rows count as often as they occur. Ties for the form go to the least word in code-point order. Other
columns of ``docs`` are not read. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import code_points, mix, worker_cache, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_IN = 97
MIN_LENGTH = 5
MIN_COUNT = 3
TIMES = 2

LAST_SHARD = 64
BITS_A_WORD = 16
MOST_BLOCKS = 1 << 22
PROBES_AT_ONCE = 1 << 19
WORDS_A_TASK = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SIX = np.uint64(63)


# --- the vocabulary -----------------------------------------------------------


def lower_ascii(value: Column) -> Column:
    """Only A-Z in lower case; texts of ASCII alone take the quicker function."""
    return F.when(F.octet_length(value) == F.length(value), F.lower(value)).otherwise(F.translate(value, UPPER, LOWER))


def misspelled(key: Column, run: Column) -> Column:
    """One run in 97, by a checksum of key and run, loses one of its characters."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % ONE_IN == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): words of at least ``MIN_LENGTH`` characters that occur at least ``MIN_COUNT`` times."""
    runs = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = runs.where(F.length("run") >= MIN_LENGTH).select("key", lower_ascii(F.col("run")).alias("run"))
    words = lowered.select(misspelled(F.col("key"), F.col("run")).alias("word")).where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


# --- filters and probes --------------------------------------------------------


def powers(n: int) -> np.ndarray:
    """Powers of the base, from the zeroth on."""
    have = worker_cache("spelling-powers", dict)
    if len(have.get("up", ())) < n:
        step = np.full(2 * n, BASE, np.uint64)
        step[0] = 1
        have["up"] = np.cumprod(step)
    return have["up"][:n]


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: places of its words, and their code points as rows."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, code_points("".join(words[i] for i in places)).reshape(len(places), size).astype(np.uint64)


def masks(hashes: np.ndarray) -> np.ndarray:
    """Four bits of a 64-bit block."""
    one = np.uint64(1)
    out = one << (hashes & SIX)
    for shift in (6, 12, 18):
        out |= one << ((hashes >> np.uint64(shift)) & SIX)
    return out


class Filters:
    """Blocked Bloom filters, a shard for each length: shard ``s`` has blocks ``starts[s]`` to ``starts[s + 1]``."""

    def __init__(self, starts: np.ndarray, blocks: np.ndarray):
        self.starts, self.blocks = starts, blocks

    @classmethod
    def empty(cls, counts: dict[int, int]) -> Filters:
        wanted = np.array([-(-counts.get(s, 0) * BITS_A_WORD // 64) for s in range(LAST_SHARD + 1)], np.int64)
        if wanted.sum() > MOST_BLOCKS:
            wanted = np.maximum(wanted * (MOST_BLOCKS - LAST_SHARD) // wanted.sum(), np.minimum(wanted, 1))
        return cls(np.concatenate([[0], np.cumsum(wanted)]), np.zeros(wanted.sum(), np.uint64))

    def place(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """The block of each hash; the shard must have blocks."""
        first, last = self.starts[min(length, LAST_SHARD)], self.starts[min(length, LAST_SHARD) + 1]
        return np.int64(first) + (((hashes >> np.uint64(32)) * np.uint64(last - first)) >> np.uint64(32)).astype(np.int64)

    def holds(self, length: int, hashes: np.ndarray) -> np.ndarray:
        shard = min(length, LAST_SHARD)
        if self.starts[shard] == self.starts[shard + 1]:
            return np.zeros(hashes.shape, bool)
        mask = masks(hashes)
        return (self.blocks[self.place(length, hashes)] & mask) == mask


def filters_of(words: DataFrame) -> Filters:
    """Filters of a table of distinct words: blocks are joined by Spark, their number is bounded."""
    counts = words.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard")).count()
    empty = Filters.empty({r["shard"]: r["count"] for r in counts.collect()})

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in by_length(batch.column(0).to_pylist()):
                hashes = mix((points * powers(points.shape[1])).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(empty.place(points.shape[1], hashes)), pa.array(masks(hashes).view(np.int64))],
                                                 names=["block", "mask"])

    made = words.select("word").mapInArrow(blocks, "block long, mask long").groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    empty.blocks[made["block"].to_numpy()] = made["mask"].to_numpy().view(np.uint64)
    return empty


def edits_held(points: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(word, place, new character) of the edits the filters hold; no characters for deletions."""
    n, size = points.shape
    up = powers(size)
    terms = points * up
    whole = terms.sum(1, keepdims=True)
    before = np.cumsum(terms, axis=1) - terms
    down = np.uint64(pow(int(BASE), -1, 1 << 64))
    fresh = np.ones((n, size), bool)
    fresh[:, 1:] = points[:, 1:] != points[:, :-1]  # in a run of equal characters all deletions are one
    word, at = np.nonzero(fresh & filters.holds(size - 1, mix(before + (whole - before - terms) * down)))
    yield word, at, None
    step = max(1, PROBES_AT_ONCE // (n * len(alphabet)))
    for first in range(0, size, step):
        old, power = points[:, first : first + step, None], up[first : first + step, None]
        hashes = mix(whole[:, :, None] + (alphabet - old) * power)
        word, at, new = np.nonzero((alphabet > old) & filters.holds(size, hashes))
        yield word, at + first, alphabet[new]


def candidates(words: DataFrame, filters: Filters) -> DataFrame:
    """(word, n, near): edits of each word that the filters hold, each pair of words from one side only."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().where("letter <> ''")
    # Never more than the 90 characters of a run.
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters.collect()), np.uint64)
    shared = words.sparkSession.sparkContext.broadcast((filters.starts, filters.blocks))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filters(*shared.value)
        for batch in batches:
            all_words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for places, points in by_length(all_words):
                for word, at, new in edits_held(points, alphabet, held):
                    of = places[word]
                    near = [all_words[w][:i] + ("" if new is None else chr(new[k])) + all_words[w][i + 1 :]
                            for k, (w, i) in enumerate(zip(of, at, strict=True))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([all_words[w] for w in of], pa.string()), pa.array(counts[of]), pa.array(near, pa.string())],
                        names=["word", "n", "near"])

    return words.select("word", "n").mapInArrow(probe, "word string, n long, near string")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, once."""
    spread = words.repartition(-(-words.count() // WORDS_A_TASK) or 1)
    found = candidates(spread, filters_of(words))
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


# --- forms ---------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form): the last of the chain of forms."""
    tops = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        above = tops.select(F.col("word").alias("root"), F.col("root").alias("above"))
        moved = written(tops.select("word", "root").join(above, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "spelling-roots")
        tops = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return tops


def variants(words: DataFrame) -> DataFrame:
    """Each word of a table (word, n) with ``form``, ``root``, ``n_near`` and ``form_n``."""
    sides = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    links = near_pairs(words).select(sides.alias("link")).select("link.*")
    best = links.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    top = roots(formed.where("form is not null"))
    return formed.join(top, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Words of the corpus with their near words, forms and roots."""
    return variants(written(vocabulary(docs, text, key), "spelling-words"))


# The checksum is the standard one: polynomial 0xEDB88320, bytes reflected.
SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i] || range(8), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS entries
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT k, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY 1, 2),
checked AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(k || ':' || run, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + unicode(c) // 64 AS BIGINT), CAST(128 + unicode(c) % 64 AS BIGINT)] END)),
    lambda s, b: xor(s >> 8, entries[CAST(xor(s & 255, b) AS INTEGER) + 1]))) AS h
  FROM counted, crc_table),
spelled AS (
  SELECT CASE WHEN h % {ONE_IN} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
              ELSE run END AS word, n FROM checked),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= {MIN_LENGTH} GROUP BY 1 HAVING sum(n) >= {MIN_COUNT}),
holes AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
links AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM links GROUP BY 1),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {TIMES} * w.n THEN near END AS form,
         CASE WHEN near_n >= {TIMES} * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON c.next = f.word)
SELECT word, form, root, n, n_near, form_n FROM chains JOIN formed USING (word) WHERE next IS NULL"""
