"""Language identification.

Sparse multinomial logistic regression on TF-IDF of hashed character n-grams
(orders 1 to 3 over lower-case letters, other characters as one gap). The weights
are trained by follow-the-regularised-leader with L1 and L2 penalties, then a
temperature is fitted on rows kept out of the training.

Document frequencies come from all labelled rows of the learning fold. The weights
are fitted on about ``rows_per_label`` rows of each label, chosen by a hash of the
row, so the fit does not grow with the corpus. Every whole text is predicted.

Defined results: a null text, or one without a letter, is ``und`` with score 0.
Empty labelled input: every text is ``und``. Rows repeat as given, other columns pass
through untouched, and a null key belongs to no fold: it is neither learned from nor
held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import code_points, fold_table

UNDETERMINED = "und"
BITS = 15
ORDERS = 3
_SPREAD = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


def fold_of(key: Column, folds: int = 5) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % folds


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs; none without a letter."""
    letters = fold_table(letters_only=True)[code_points(text)]
    if not letters.any():
        return np.empty(0, np.int64), np.empty(0)
    padded = np.concatenate([[0], letters, [0]]).astype(np.uint32)
    keep = padded != 0
    keep[1:] |= padded[:-1] != 0
    keep[0] = True
    line = padded[keep]
    gram, parts = line, []
    for order in range(ORDERS):
        if order:
            if len(gram) < 2:
                break
            gram = gram[:-1] * np.uint32(0x01000193) + line[order:]
        parts.append(((gram + np.uint32(order * 0x51ED27)) * _SPREAD) >> np.uint32(32 - BITS))
    counts = np.bincount(np.concatenate(parts), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = counts_of(text)
    values = (1.0 + np.log(counts)) * idf[found] if len(found) else np.empty(0)
    norm = np.sqrt(values @ values)
    return found, values / norm if norm else values


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return scores / scores.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, alpha: float = 1.0, beta: float = 1.0,
               l1: float = 0.01, l2: float = 0.01, epochs: int = 3) -> np.ndarray:
    """Per-coordinate follow-the-regularised-leader; a coordinate within ``l1`` stays zero."""
    z = np.zeros((1 << BITS, n_labels))
    n = np.zeros_like(z)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        pull = np.sign(zs) * l1 - zs
        return np.where(np.abs(zs) <= l1, 0.0, pull / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for found, values, label in rows:
            zs, ns = z[found], n[found]
            now = weights(zs, ns)
            miss = softmax(values @ now)
            miss[label] -= 1.0
            gradient = values[:, None] * miss
            squares = gradient * gradient
            z[found] = zs + gradient - (np.sqrt(ns + squares) - np.sqrt(ns)) / alpha * now
            n[found] = ns + squares
    return weights(z, n).astype(np.float32)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for text in batch["text"]:
            totals[counts_of(text)[0]] += 1
    found = np.flatnonzero(totals)
    yield pd.DataFrame({"feature": found.astype(np.int32), "docs": totals[found]})


def fit(docs: DataFrame, learn: Column, text: str = "text", label: str = "lang", key: str = "doc_id",
        rows_per_label: int = 800, calibration_share: float = 0.2) -> Model:
    """Learn from the rows where ``learn`` holds and text and label are not null."""
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).alias("label"),
        F.xxhash64(F.col(key).cast("string"), F.lit(7)).alias("pick"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.ones(1 << BITS), np.zeros((1 << BITS, 1), np.float32), 1.0)
    total = sum(sizes.values())
    found = rows.select("text").mapInPandas(_document_frequencies, "feature int, docs long")
    docs_with = np.zeros(1 << BITS)
    for r in found.groupBy("feature").agg(F.sum("docs").alias("docs")).collect():
        docs_with[r["feature"]] = r["docs"]
    idf = np.log((1.0 + total) / (1.0 + docs_with)) + 1.0

    shares = F.create_map(*[F.lit(x) for name in labels for x in (name, min(1.0, rows_per_label / sizes[name]))])
    sample = rows.where(F.pmod("pick", F.lit(1 << 20)) < shares[F.col("label")] * (1 << 20))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [vector(t, idf) for t in batch["text"]]
            yield pd.DataFrame({
                "pick": batch["pick"], "label": [labels.index(x) for x in batch["label"]],
                "found": [f.astype(np.int32).tobytes() for f, _ in made],
                "vals": [v.astype(np.float32).tobytes() for _, v in made]})

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        if not len(rows):
            return
        rows = rows.sort_values(["pick", "label", "found"], ignore_index=True)
        made = [(np.frombuffer(f, np.int32), np.frombuffer(v, np.float32).astype(float), k)
                for f, v, k in zip(rows["found"], rows["vals"], rows["label"], strict=True)]
        aside = ((rows["pick"].to_numpy() >> 20) % 1000) < calibration_share * 1000
        weights = train_ftrl([m for m, a in zip(made, aside, strict=True) if not a], len(labels))
        held = [m for m, a in zip(made, aside, strict=True) if a]
        scores = np.array([v @ weights[f] for f, v, _ in held]).reshape(-1, len(labels))
        yield pd.DataFrame({"weights": [weights.tobytes()],
                            "temperature": [fit_temperature(scores, np.array([k for *_, k in held], int))]})

    # Scanned in many tasks; one then holds the bounded sample: at most about rows_per_label vectors of each label.
    sent = sample.mapInPandas(vectors, "pick long, label int, found binary, vals binary").repartition(1)
    model = sent.mapInPandas(learned, "weights binary, temperature double").collect()
    if not model:
        return Model([], idf, np.zeros((1 << BITS, 1), np.float32), 1.0)
    weights = np.frombuffer(model[0]["weights"], np.float32).reshape(-1, len(labels))
    return Model(labels, idf, weights, model[0]["temperature"])


def predict_one(text: str | None, model: Model) -> tuple[str, float]:
    if text is None or not model.labels:
        return UNDETERMINED, 0.0
    found, values = vector(text, model.idf)
    if not len(found):
        return UNDETERMINED, 0.0
    chances = softmax((values @ model.weights[found]) / model.temperature)
    best = int(chances.argmax())
    return model.labels[best], float(min(1.0, chances[best]))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the calibrated chance of that label)."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([predict_one(t, model) for t in batch], columns=["lang_pred", "score"])

    docs = docs.drop("lang_pred", "score")
    return docs.withColumn("_p", predicted(F.col(text))).select(
        *[F.col(f"`{c}`") for c in docs.columns], "_p.lang_pred", "_p.score")
