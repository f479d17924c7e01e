"""Token ids in packed binary blocks: patched frame of reference.

Documents are sorted by id over the whole table and encoded in that order. The ids are
cut into blocks of ``BLOCK``. A block stores its least id, and each id's distance from
it, packed at the width that holds ``PERCENT`` of the block's distances; the others are
outliers, kept whole in an exception list (place, distance) that patches the block. A
segment is one binary value: a header, the index of block starts (so that any block can
be read alone), then the blocks. Segments are rows of a Parquet table with the ids and
lengths of their documents, so files are committed as Spark commits them and can lie in
any store it writes to.

Segment layout, little-endian: magic "PFOR", u32 ids, u32 blocks, u32[blocks + 1] block
starts in bytes from the first block; a block is u32 least id, u16 ids, u16 exceptions,
u8 width, the packed distances, u16[exceptions] places, u32[exceptions] distances.

Defined results: a null or empty text holds the end id alone. Null keys come first. Rows
of equal keys follow each other in the order of their texts; repeated rows stay. An empty
table gives no segment and no row.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_engine.llm.common import groups, worker_cache
from review_engine.llm.units import Ids, UnitIds

MAGIC = b"PFOR"
BLOCK = 4096
PERCENT = 98
SEGMENT_IDS = 1 << 19
CACHED = 600_000
LONGEST_CACHED = 64

SEGMENTS = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<int>, payload binary"


def pack_block(ids: np.ndarray) -> bytes:
    least = int(ids.min())
    away = (ids.astype(np.int64) - least).astype(np.uint32)
    widest = np.sort(away)[min(len(away) - 1, len(away) * PERCENT // 100)]
    width = int(widest).bit_length()
    outside = np.flatnonzero(away >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    inside = away.copy()
    inside[outside] = 0
    if width == 16:
        packed = inside.astype("<u2").tobytes()
    else:
        bits = (inside[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return b"".join([
        np.uint32(least).tobytes(), np.array([len(ids), len(outside)], np.uint16).tobytes(), bytes([width]), packed,
        outside.astype(np.uint16).tobytes(), away[outside].tobytes()])


def unpack_block(data: memoryview) -> np.ndarray:
    least = int(np.frombuffer(data, np.uint32, 1)[0])
    n, patches = (int(x) for x in np.frombuffer(data, np.uint16, 2, 4))
    width = data[8]
    packed = (n * width + 7) // 8
    if width == 16:
        away = np.frombuffer(data, "<u2", n, 9).astype(np.uint32)
    else:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, packed, 9), count=n * width, bitorder="little")
        whole = np.zeros((n, 32), np.uint8)
        whole[:, :width] = bits.reshape(n, width)
        away = np.packbits(whole, axis=1, bitorder="little").view(np.uint32).ravel().copy()
    at = 9 + packed
    places = np.frombuffer(data, np.uint16, patches, at)
    away[places] = np.frombuffer(data, np.uint32, patches, at + 2 * patches)
    return away + np.uint32(least)


def pack_segment(ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.uint32)
    return b"".join([MAGIC, np.array([len(ids), len(blocks)], np.uint32).tobytes(), starts.tobytes(), *blocks])


def unpack_segment(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (all), found by the index."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of packed token ids")
    _, n_blocks = (int(x) for x in np.frombuffer(payload, np.uint32, 2, 4))
    starts = np.frombuffer(payload, np.uint32, n_blocks + 1, 12).astype(np.int64) + 12 + 4 * (n_blocks + 1)
    view = memoryview(payload)
    wanted = range(first, n_blocks if last is None else min(last, n_blocks))
    return np.concatenate([np.empty(0, np.uint32), *[unpack_block(view[starts[i] : starts[i + 1]]) for i in wanted]])


class Encoder:
    """Ids of texts as bytes, by way of bounded tables of words and of lower-case words.

    The tokenizer drops white space and joins nothing over it, so a text's ids are those of
    its words in order. Words of Latin letters with punctuation behind them go to the
    library's merge model part by part (its own splitting, in lower case); any other word, and
    white space other than blank and line feed, is left to the whole tokenizer.
    """

    _PLAIN = re.compile(r"^(([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*))$", re.MULTILINE)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        self.heads: dict[str, bytes] = {}
        self.units = UnitIds(self._words)
        # The library's spelling of letters beyond ASCII, as its merge model wants them.
        spelled = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = {c: spelled(chr(c))[0][0] for c in range(0xDF, 0x100) if chr(c).isalpha()}

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _head(self, head: str) -> bytes:
        tokens = self.merged(head if head.isascii() else head.translate(self.spelling))
        found = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(head) <= LONGEST_CACHED:
            if len(self.heads) >= CACHED:
                self.heads.clear()
            self.heads[head] = found
        return found

    def _words(self, words: list[str]) -> list[Ids]:
        made: dict[str, bytes] = {}
        tails: dict[str, bytes] = {"": b""}
        known = self.heads
        for word, head, tail in self._PLAIN.findall("\n".join(words)):
            head = head.lower()
            if tail not in tails:
                tails[tail] = self.whole(tail)
            made[word] = (known.get(head) or self._head(head)) + tails[tail]
        found = [made[word] if word in made else self.whole(word) for word in words]
        return [(np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4)]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        ((ids, sizes),) = self.units.of(split.flatten())
        # The ids of a text end with those of its last word.
        ends = 4 * np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        joined, places = ids.tobytes(), ends.tolist()
        return [joined[a:b] for a, b in zip(places, places[1:], strict=False)]


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text",
                 key: str = "doc_id") -> None:
    """Encode all documents in ascending key order and write the segments below ``path``."""

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_cache(f"encoder-{tokenizer}", lambda: Encoder(tokenizer))
        part, seq, end = TaskContext.get().partitionId(), 0, np.uint32(end_id).tobytes()
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held), np.uint32)
            return pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [len(ids)], "doc_ids": [keys],
                                 "lengths": [[len(b) // 4 for b in held]], "payload": [pack_segment(ids)]})

        def encoded() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                texts = batch["text"].tolist()
                names = [None if pd.isna(k) else int(k) for k in batch["key"]]
                for a, b in groups(texts, 1 << 22):
                    yield from zip(names[a:b], encoder.encode(texts[a:b]), strict=True)

        for name, ids in encoded():
            keys.append(name)
            held.append(ids + end)
            size += len(ids) // 4 + 1
            if size >= SEGMENT_IDS:
                yield flush()
                keys, held, size, seq = [], [], 0, seq + 1
        if held:
            yield flush()

    ordered = (docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
               .repartitionByRange("key").sortWithinPartitions("key", "text"))
    ordered.mapInPandas(segments, SEGMENTS).write.parquet(path)


def read_blocks(spark, path: str, key: str = "doc_id") -> DataFrame:
    """One row per document of the written files: key, start, n_tokens, ids_crc32."""
    stored = spark.read.schema(SEGMENTS).parquet(path)
    names = stored.select("part", "seq", "n_ids")
    # Starts: sums within a part, after the sums of all parts before it (a few rows each).
    parts = names.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = names.withColumn("inside", inside).join(before, "part").select(
        "part", "seq", (F.col("before") + F.col("inside")).alias("first"))

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, keys, lengths, payload in zip(
                    batch["part"], batch["seq"], batch["doc_ids"], batch["lengths"], batch["payload"], strict=True):
                raw = unpack_segment(payload).astype("<u4").tobytes()
                ends = np.cumsum(np.asarray(lengths, np.int64))
                begins = ends - np.asarray(lengths, np.int64)
                yield pd.DataFrame({
                    "part": np.int32(part), "seq": np.int32(seq), "doc": pd.array(list(keys), "Int64"), "at": begins,
                    "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]})

    docs = stored.select("part", "seq", "doc_ids", "lengths", "payload").mapInPandas(
        decoded, "part int, seq int, doc long, at long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select(
        F.col("doc").alias(key), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
