"""Benchmark decontamination by latent semantic retrieval.

Words are weighted by inverse document frequency over all documents. The benchmark's
passages become TF-IDF rows, whose leading right singular vectors are found by a randomised
SVD: each task multiplies its passages with a shared random matrix and sends one sketch of
fixed size; the sketches are added, made orthogonal, and the passes repeated. Windows of
every document are laid into that latent space and compared with the passages of their
length: a passage's window is the least of 2, 3, 4, 6, 8, 12 ... segments that holds a stretch
``STRETCH`` times as long as the passage wherever it begins.
What words a passage must share with a window is known from the verification, and so the
least product of the two: that of its lightest words which make up ``COVER`` of it, less what
the latent space does not hold. A window that reaches it, and has so many of the passage's
words, is verified on its words: the longest common subsequence with the
passage must cover ``COVER`` of it, and ``ANSWER`` of its closing words (the answer), so
paraphrases with words changed, put in or left out are found and chance likeness is not. No
window is passed over that could be verified.

The benchmark is worked through in slices of about ``RANK`` passages and of bounded size, so
what is broadcast is bounded. The latent space of a slice has a direction for each of its
passages, so it holds them whole.

Defined results: null or empty texts and passages without words match nothing. Passages of
fewer than ``SHORT`` words must be found whole, their words one after the other. Repeated rows are searched once, and
found as often as they repeat. With an
empty benchmark, or no documents, nothing is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import groups, word_hashes, written

IDF_BITS = 18
SEGMENT = 8
STRETCH = 2  # a passage is found in a stretch of up to so many times its length
PIECE = 1 << 13  # words of a text worked on at once
RANK = 256  # passages in a slice, about: each adds one direction to the latent space, and all are kept
EXTRA = 8
PASSES = 2
MOST_COLUMNS = 1 << 16
SLICE_CHARS = 1 << 22
TOGETHER = 16  # slices searched in one pass over the documents
EXACT = 1e-4  # for rounding, as a share
COVER = 0.6
ANSWER = 0.5
SHORT = 8

HITS = "array<struct<item_id: long, cosine: double, cover: double, answer: double, word: long, copies: long>>"


@dataclass(frozen=True)
class Index:
    idf: np.ndarray  # by hashed word
    vocabulary: np.ndarray  # sorted word hashes of the passages
    latent: np.ndarray  # latent coordinates of each passage, scaled to unit TF-IDF length
    products: np.ndarray  # of each column's latent coordinates with each passage's; the last row is for no column
    spans: list[list[tuple[int, int, int]]]  # window in segments, first and last passage; windows of one list double
    needed: list[int]  # words of each passage that must be found
    least: np.ndarray  # product with a passage of any window in which it can be found
    missing: np.ndarray  # the most by which products of a column are short of the exact ones, by passage
    items: list[int]
    words: list[np.ndarray]  # word hashes of each passage
    held: list[frozenset[int]]  # places of each passage's words in the vocabulary
    copies: list[int]  # rows of the benchmark that are this passage


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - IDF_BITS)).astype(np.int64)


def _texts_words(texts: list[str | None]) -> Iterator[np.ndarray]:
    texts = [t or "" for t in texts]
    for first, last in groups(texts):
        words, firsts, _, _ = word_hashes(texts[first:last])
        for a, b in zip(firsts, firsts[1:], strict=False):
            yield words[a:b]


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals, n = np.zeros(1 << IDF_BITS, np.int64), 0
    for batch in batches:
        for words in _texts_words(batch["text"].tolist()):
            totals[np.unique(_bucket(words))] += 1
            n += 1
    found = np.flatnonzero(totals)
    yield pd.DataFrame({"bucket": np.append(found, -1), "docs": np.append(totals[found], n)})


def inverse_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Weight of each hashed word, from all documents."""
    counted = docs.select(F.col(text).alias("text")).mapInPandas(_document_frequencies, "bucket long, docs long")
    table = counted.groupBy("bucket").agg(F.sum("docs").alias("docs")).toArrow()  # 2 ** IDF_BITS rows at most
    bucket, with_it = table["bucket"].to_numpy(), table["docs"].to_numpy()
    total = int(with_it[bucket < 0].sum())
    docs_with = np.zeros(1 << IDF_BITS)
    docs_with[bucket[bucket >= 0]] = with_it[bucket >= 0]
    return np.log((1.0 + total) / (1.0 + docs_with)).astype(np.float32) + np.float32(0.1)


def _places(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary; -1 for words the passages do not have."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, at, -1)


def _columns(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Column of each word; -1 for words the passages do not have."""
    places = _places(words, vocabulary)
    return np.where(places < 0, -1, places % MOST_COLUMNS)


def _row(words: np.ndarray, idf: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    columns = _columns(words, vocabulary)
    own = columns >= 0
    found, inverse = np.unique(columns[own], return_inverse=True)
    values = np.bincount(inverse, idf[_bucket(words[own])].astype(float), len(found))
    norm = np.sqrt(values @ values)
    return found, values / norm if norm else values


def randomised_svd(passages: DataFrame, idf: np.ndarray, vocabulary: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (a row for each column) of the TF-IDF rows of ``passages``."""
    width = min(len(vocabulary), MOST_COLUMNS)
    columns = min(rank + EXTRA, width)
    basis = np.random.default_rng(5).standard_normal((width, columns))

    def summed(times_transpose: bool) -> np.ndarray:
        def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((width if times_transpose else columns, columns))
            for batch in batches:
                for words in _texts_words(batch["text"].tolist()):
                    found, values = _row(words, idf, vocabulary)
                    ahead = values @ basis[found]
                    if times_transpose:
                        total[found] += values[:, None] * ahead
                    else:
                        total += np.outer(ahead, ahead)
            yield pd.DataFrame({"sketch": [total.astype(np.float32).tobytes()]})

        sent = passages.mapInPandas(sketch, "sketch binary").collect()
        return sum(np.frombuffer(r["sketch"], np.float32).reshape(-1, columns).astype(float) for r in sent)

    for _ in range(PASSES):
        basis, _ = np.linalg.qr(summed(True))
    _, turned = np.linalg.eigh(summed(False))
    return (basis @ turned[:, ::-1][:, :rank]).astype(np.float32)


def _window(n: int) -> int:
    """Segments of the window for a passage of ``n`` words: wherever its stretch begins, one window holds it."""
    least = -(-(STRETCH * n + SEGMENT - 1) // SEGMENT)
    power = 1 << (least - 1).bit_length()
    return power * 3 // 4 if power * 3 // 4 >= least else power


def fit(idf: np.ndarray, passages: DataFrame) -> Index | None:
    """An index of a bounded slice of passages (item_id, text, and copies if rows repeat)."""
    if "copies" not in passages.columns:
        passages = passages.withColumn("copies", F.lit(1))
    rows = passages.orderBy("item_id", "text").collect()
    words = list(_texts_words([r["text"] for r in rows]))
    # Passages of one window stand together, and windows that come of each other by doubling.
    kept = sorted((i for i, w in enumerate(words) if len(w)), key=lambda i: (_window(len(words[i])) % 3 == 0, _window(len(words[i]))))
    if not kept:
        return None
    rows, words = [rows[i] for i in kept], [words[i] for i in kept]
    vocabulary = np.unique(np.concatenate(words))
    basis = randomised_svd(passages.select("text").coalesce(4), idf, vocabulary, len(rows))
    laid = [_row(w, idf, vocabulary) for w in words]
    latent = np.array([v @ basis[f] for f, v in laid], np.float32)
    products = basis @ latent.T
    least, missing = np.zeros(len(words)), np.zeros(len(words))
    for i, (found, values) in enumerate(laid):
        short = -products[:, i]
        short[found] += values.astype(np.float32)
        missing[i] = max(0.0, short.max())
        # The words that must be found weigh as much as the passage's lightest ones, or more.
        exact = values[np.searchsorted(found, _columns(words[i], vocabulary))] * idf[_bucket(words[i])]
        least[i] = np.sort(exact)[: _needed(len(exact))].sum() * (1 - EXACT)
    sizes = [_window(len(w)) for w in words]
    spans: list[list[tuple[int, int, int]]] = [[], []]
    for size in dict.fromkeys(sizes):
        spans[size % 3 == 0].append((size, sizes.index(size), sizes.index(size) + sizes.count(size)))
    return Index(idf, vocabulary, latent, np.vstack([products, np.zeros_like(products[:1])]), [s for s in spans if s],
                 [_needed(len(w)) for w in words], least, missing, [r["item_id"] for r in rows], words,
                 [frozenset(_places(w, vocabulary).tolist()) for w in words], [r["copies"] for r in rows])


def common_subsequence(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence of two sequences of word hashes."""
    places: dict[int, int] = {}
    for i, word in enumerate(x.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(x)) - 1
    open_ = full
    for word in y.tolist():
        match = places.get(word)
        if match is not None:
            both = open_ & match
            open_ = ((open_ + both) | (open_ - both)) & full
    return len(x) - open_.bit_count()


def _needed(n: int) -> int:
    """Words of a passage of ``n`` words that must be found."""
    return n if n < SHORT else next(k for k in range(int(COVER * n), n + 1) if k / n >= COVER)


def _whole(item: np.ndarray, region: np.ndarray) -> bool:
    """Whether the words of ``item`` stand one after the other in ``region``."""
    at = np.flatnonzero(region[: max(0, len(region) - len(item) + 1)] == item[0])
    return bool(len(at)) and bool((region[at[:, None] + np.arange(len(item))] == item).all(axis=1).any())


def verified(item: np.ndarray, region: np.ndarray) -> tuple[float, float] | None:
    """Shares of the passage and of its closing words found in order in a stretch of text."""
    if len(item) < SHORT:
        return (1.0, 1.0) if _whole(item, region) else None
    # No subsequence is longer than the number of the passage's words that are there at all.
    if sum(map(set(region.tolist()).__contains__, item.tolist())) < COVER * len(item):
        return None
    cover = common_subsequence(item, region) / len(item)
    if cover < COVER:
        return None
    closing = item[-max(3, len(item) // 4) :]
    answer = common_subsequence(closing, region) / len(closing)
    return (cover, answer) if answer >= ANSWER else None


def _window_sums(segments: np.ndarray, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Sums of every so many segments in a row, by doubling: size, first passage, sums of the span's passages."""
    begin, end, size = spans[0][1], spans[-1][2], 1
    sums = segments[:, begin:end]
    if spans[0][0] % 3 == 0:
        sums, size = sums[:-2] + sums[1:-1] + sums[2:], 3
    for wanted, first, last in spans:
        if wanted >= len(segments):  # one window is all there is
            yield len(segments), first, segments[:, first:last].sum(axis=0, keepdims=True)
            continue
        sums, begin = sums[:, first - begin :], first
        while size < wanted:
            sums, size = sums[:-size] + sums[size:], 2 * size
        yield size, first, sums[:, : last - first]


def candidates(columns: np.ndarray, weight: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Windows of a text that may hold a passage: first word, passage, number of words."""
    if not (columns >= 0).any():
        return
    n = -(-len(columns) // SEGMENT)
    laid = np.full(n * SEGMENT, len(index.products) - 1)
    laid[: len(columns)] = np.where(columns >= 0, columns, laid[0])
    by_segment = np.zeros((n, 1, SEGMENT), np.float32)
    by_segment.ravel()[: len(columns)] = np.where(columns >= 0, weight, 0)
    segments = np.matmul(by_segment, np.take(index.products, laid, axis=0, mode="clip").reshape(n, SEGMENT, -1))[:, 0]
    weights = np.concatenate([[0.0], np.cumsum(by_segment.sum(axis=2)[:, 0], dtype=float)])
    for spans in index.spans:
        for size, begin, sums in _window_sums(segments, spans):
            passages = slice(begin, begin + sums.shape[1])
            heaviest = (weights[size:] - weights[:-size]).max()
            least = (index.least[passages] - heaviest * index.missing[passages]).astype(np.float32)
            first, which = np.divmod(np.flatnonzero(sums >= least), sums.shape[1])
            yield first * SEGMENT, begin + which, size * SEGMENT


def _cosine(columns: np.ndarray, weight: np.ndarray, passage: int, index: Index) -> float:
    """Of a window's words and a passage, in the latent space."""
    own = columns >= 0
    product = weight[own] @ index.products[columns[own], passage].astype(float)
    return float(product / np.sqrt(weight @ weight))


def hits_of(words: np.ndarray, index: Index) -> list[dict]:
    if not len(words):
        return []
    overlap = max(s for spans in index.spans for s, _, _ in spans) * SEGMENT + -(-max(map(len, index.words)) // SEGMENT) * SEGMENT
    size_of_piece = max(PIECE, overlap)
    best: dict[int, dict] = {}
    most: dict[int, tuple[float, float]] = {}
    for begin in range(0, max(1, len(words) - overlap), size_of_piece):
        piece = words[begin : begin + size_of_piece + overlap]
        places = _places(piece, index.vocabulary)
        columns, weight = np.where(places < 0, -1, places % MOST_COLUMNS), index.idf[_bucket(piece)]
        # The passages' words alone, and how many of them stand before each word.
        listed, before = places[places >= 0].tolist(), [0, *np.cumsum(places >= 0).tolist()]
        n = len(piece)
        for first, which, size in candidates(columns, weight, index):
            order = np.argsort(which, kind="stable")
            run, until, some = -1, 0, False
            for w, i in zip(first[order].tolist(), which[order].tolist(), strict=True):
                item, reach, held, needed = index.words[i], len(index.words[i]), index.held[i], index.needed[i]
                spare = reach - len(held)
                if i != run or w >= until:  # windows that begin within this one are looked at together first
                    run, until = i, w + size
                    around = listed[before[max(0, w - reach)] : before[min(n, until + size + reach)]]
                    some = spare + len(held.intersection(around)) >= needed
                if not some:
                    continue
                # Words of the passage that are not there leave fewer than must be found; the window itself has so many.
                begins, ends = max(0, w - reach), min(n, w + size + reach)
                if spare + len(held.intersection(listed[before[begins] : before[ends]])) < needed:
                    continue
                if sum(map(held.__contains__, listed[before[w] : before[min(n, w + size)]])) < needed:
                    continue
                found = verified(item, piece[begins:ends])
                if not found or found[0] < most.get(i, (0.0, 0.0))[0]:
                    continue
                c = _cosine(columns[w : w + size], weight[w : w + size].astype(float), i, index)
                if (found[0], c) > most.get(i, (0.0, 0.0)):
                    most[i] = found[0], c
                    best[i] = {"item_id": index.items[i], "cosine": c, "cover": found[0],
                               "answer": found[1], "word": int(begin + w), "copies": index.copies[i]}
    return [best[i] for i in sorted(best)]


def _found(text: str, shared: Broadcast) -> Column:
    @F.pandas_udf(HITS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([hits_of(w, shared.value) for w in _texts_words(batch.tolist())], dtype=object)

    return found(F.col(text))


def searcher(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
             passage: str = "text") -> list[Column]:
    """Columns, one for each slice of the benchmark, with the passages found in ``text``."""
    rows = benchmark.select(F.col(item).alias("item_id"), F.coalesce(F.col(passage), F.lit("")).alias("text"))
    passages = written(rows.groupBy("item_id", "text").agg(F.count("*").alias("copies")), "benchmark-passages")
    size = passages.agg(F.sum(F.length("text") + 1).alias("chars"), F.count("*").alias("n")).first()
    slices = max(-(-(size["chars"] or 0) // SLICE_CHARS), -(-size["n"] // RANK))
    idf = inverse_frequencies(docs, text) if slices else None
    out = []
    for number in range(slices):
        index = fit(idf, passages.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number))
        if index is None:
            continue
        # At most MOST_COLUMNS x RANK products, about, and a slice of passages.
        shared = docs.sparkSession.sparkContext.broadcast(index)

        out.append(_found(text, shared))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each document and passage found in it."""
    columns = searcher(docs, benchmark, text)
    out = None
    for some in [columns[k : k + TOGETHER] for k in range(0, max(1, len(columns)), TOGETHER)]:
        hits = F.concat(F.array().cast(HITS), *some)
        found = docs.select(F.col(key), F.explode(hits).alias("h")).select(
            key, "h.*", F.explode(F.sequence(F.lit(1), F.col("h.copies"))).alias("copy")).drop("copies", "copy")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no passage is found."""
    for number, column in enumerate(searcher(docs, benchmark, text)):
        if number and number % TOGETHER == 0:
            docs = written(docs, "decontaminated")
        docs = docs.where(F.size(column) == 0)
    return docs
