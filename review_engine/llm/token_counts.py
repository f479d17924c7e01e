"""Token counts of whole texts, as the tokenizer's own library gives them.

The vocabulary never joins a piece over a gap: the marker of a space stands only at the
front of a piece and no piece holds a line feed (checked when the model is opened). So a
text is the sum of its pre-tokens, a run of spaces with the word after it. Two tiers
give a pre-token's length, both inside the map task: a broadcast table of frequent
pre-tokens, and a cache in each worker which encodes what it has not seen. No pre-token
is shuffled; the first tier is found from an even share of all texts, and each task hands
in its most frequent ones only. Both tiers hold exact strings, so no count can be wrong.

Defined results: a null or empty text has 0 bytes and 0 tokens. Rows repeat as given and
other columns pass through.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import worker_cache

GAP = "▁"
CACHED = 300_000
LONGEST_CACHED = 64
_ODD = re.compile(f"{GAP}*[^{GAP}]+|{GAP}+")


class Lengths(dict):
    """Pre-token to its number of tokens; unseen ones are encoded and kept, up to a bound."""

    def __init__(self, model: str, frequent: dict[str, int]):
        import sentencepiece

        super().__init__(frequent)
        self.frequent = frequent
        self.encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.encoder.id_to_piece(i) for i in range(self.encoder.get_piece_size())]
        if any(GAP in p.lstrip(GAP) or "\n" in p for p in pieces) or self.encoder.encode("a b\nb", out_type=str)[0][0] != GAP:
            raise ValueError("this vocabulary joins pieces over gaps; count whole texts instead")
        self.line_feed = len(self.encoder.encode("\n", num_threads=1))

    def __missing__(self, token: str) -> int:
        # The library puts one marker in front of a text; after a line feed there is none.
        if token[0] == GAP:
            n = len(self.encoder.encode(token[1:], num_threads=1)) if len(token) > 1 else 1
        else:
            n = len(self.encoder.encode("\n" + token, num_threads=1)) - self.line_feed
        if len(token) <= LONGEST_CACHED:
            if len(self) > CACHED + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[token] = n
        return n


def pre_tokens(text: str) -> Iterator[list[str]]:
    """Lists of pre-tokens, one list for each line."""
    for line in (GAP + text).split("\n") if text else ():
        line = line.replace(" ", GAP)
        if not line:
            yield []
        elif GAP * 2 in line or line[-1] == GAP:
            yield _ODD.findall(line)
        else:
            words = line.replace(GAP, " " + GAP).split(" ")
            yield words[1:] if not words[0] else words


def count(text: str | None, lengths: Lengths) -> int:
    if not text:
        return 0
    total = lines = 0
    for words in pre_tokens(text):
        total += sum(map(lengths.__getitem__, words))
        lines += 1
    return total + (lines - 1) * (lengths.line_feed - 1)


def frequent_lengths(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", one_in: int = 64,
                     kept: int = 20_000) -> dict[str, int]:
    """The first tier: at most ``kept`` pre-tokens with their lengths, from one text in ``one_in``."""

    def most_frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch["text"]:
                for words in pre_tokens(t):
                    seen.update(words)
                if len(seen) > 20 * kept:
                    seen = Counter(dict(seen.most_common(kept)))
        top = [(w, n) for w, n in seen.most_common(kept) if len(w) <= LONGEST_CACHED and n > 1]
        yield pd.DataFrame(top, columns=["word", "n"])

    share = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(F.col(key)), F.lit(one_in)) == 0))
    top = (share.select(F.col(text).alias("text")).mapInPandas(most_frequent, "word string, n long")
           .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(kept))
    lengths = Lengths(model, {})
    return {r["word"]: lengths[r["word"]] for r in top.collect()}


def token_counts(docs: DataFrame, model: str, limit: int = 4096, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    frequent = frequent_lengths(docs, model, text, key)
    shared = docs.sparkSession.sparkContext.broadcast((list(frequent), bytes(min(n, 255) for n in frequent.values())))

    name = uuid.uuid4().hex

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, sizes = shared.value
        lengths = worker_cache(f"lengths-{name}", lambda: Lengths(
            model, {w: n for w, n in zip(words, sizes, strict=True) if n < 255}))
        for batch in batches:
            yield pd.Series([count(t, lengths) for t in batch], dtype="int64")

    value = F.col(text)
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(value), F.lit(0)).cast("long"))
            .withColumn("n_tokens", counted(value))
            .withColumn("over_limit", F.col("n_tokens") > limit))
