"""Alignment of two tokenizers' tokens: lockstep merging of their byte ranges.

Texts are cut into units that no token of either reaches over, and a worker encodes a unit once
(if B has pieces over gaps or changes texts, it gets them whole). Both tokenizers cut the same
bytes, so their tokens are two sorted lists of ends, merged by a pointer in each. One NumPy state
vector holds the pointers of all documents of a batch: a step emits the link under every pair of
pointers, marks a cut where both tokens end together, and advances the pointer whose token ends
first (both at a cut). Finished documents are compacted away. A document of more than ``LANE``
tokens rides on several lanes of the vector, each beginning where a token of A begins, so one
long document does not hold up the others.

How often an id pair is linked over the whole corpus is counted without shuffling links. A map
task numbers the pairs it meets (a block's dictionary: bounded, the next block starts a new
one); a document keeps the numbers of its pairs, packed; only dictionaries are shuffled, once to
sum counts by pair, once to bring the sums back to their blocks. The highest count of each id
of A is a table of at most A's vocabulary, which is what is broadcast.

Defined results: texts that are null or empty, or whose joined token bytes differ from space and
text, have no tokens: zeros and the empty alignment. Documents are counted by row: repeated rows
and equal or null ids count each on its own. Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import groups, worker_cache, written
from review_engine.llm.units import Ids, UnitIds

GAP = "▁"
PROBE = " Two  words,\n\t\ufb01 \u00e9 \u4e2d\u3000x\u00a0 \x00"
# A's pattern begins a new pre-token at a single space between these, whatever stands around them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
MARKS = "0-9.,;:!?"
_JOINABLE = re.compile(f" [{LETTERS}](?s:.*)(?<=[{LETTERS}{MARKS}])\\Z")
JOINED = 64  # units that are encoded in one call
LANE = 256
BATCH_CHARS = 1 << 20
BLOCK_PAIRS = 400_000
BLOCK_LINKS = 1 << 24
PAIR = 1 << 32
FIELDS = ("n_a", "n_b", "n_groups", "n_links")
PARTS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in FIELDS], ("groups", pa.string()),
    ("links", pa.binary()), ("is_doc", pa.bool_()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])
PARTS_DDL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, "
             "is_doc boolean, pairs array<long>, docs array<long>")


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Pair:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        known, added = byte_of_char(), {t["id"] for t in json.loads(self.a.to_str())["added_tokens"]}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = token.encode() if i in added else bytes(known[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(t.strip("<>"), 16)]) if self.b.is_byte(i) else t.replace(GAP, " ").encode() for i, t in enumerate(names)]
        self.sizes_a, self.sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        # No piece of B goes on over a gap and texts are left as they are, so B can be cut where A is.
        joining = any(GAP in n.lstrip(GAP) for n in names)
        probed = b"".join(map(self.bytes_b.__getitem__, self.b.encode(PROBE)))
        self.apart = not joining and probed == utf8(" " + PROBE)
        self.units = UnitIds(self._units)

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [made.ids for made in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with the space that B puts in front."""
        return self.b.encode([t[1:] for t in texts], num_threads=1)

    def _units(self, units: list[bytes]) -> list[Ids]:
        """Ids of units; none for a unit whose tokens do not spell it."""
        texts = [u.decode("utf-8", "surrogatepass") for u in units]
        # Units that can stand side by side are encoded together, and cut at their bytes.
        joinable = [bool(_JOINABLE.match(t)) for t in texts]
        places = np.flatnonzero(joinable).tolist()
        runs = [places[k : k + JOINED] for k in range(0, len(places), JOINED)]
        encoders = [(self._ids_a, self.bytes_a, self.sizes_a)]
        if self.apart:
            encoders.append((self._ids_b, self.bytes_b, self.sizes_b))
        out = []
        for encode, spelling, lengths in encoders:
            ids: list[np.ndarray] = [np.empty(0, np.int32)] * len(units)
            alone = [k for k, apart in enumerate(joinable) if not apart]
            for run, made in zip(runs, encode(["".join(map(texts.__getitem__, run)) for run in runs]), strict=True):
                if b"".join(map(spelling.__getitem__, made)) != b"".join(map(units.__getitem__, run)):
                    alone += run
                    continue
                of_run, begin = np.array(made, np.int32), 0
                ends = np.searchsorted(np.cumsum(lengths[of_run]), np.cumsum([len(units[k]) for k in run])) + 1
                for k, end in zip(run, ends.tolist(), strict=True):
                    ids[k], begin = of_run[begin:end], end
            for k, made in zip(alone, encode([texts[k] for k in alone]), strict=True):
                if b"".join(map(spelling.__getitem__, made)) == units[k]:
                    ids[k] = np.array(made, np.int32)
            out.append((np.concatenate([np.empty(0, np.int32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))))
        return out

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B with the places where each text's begin; no ids where their bytes are not those of space and text."""
        spelled = [utf8(" " + (t or "")) for t in texts]
        units, firsts = cut(spelled)
        found = self.units.of(units)
        good = np.array([len(s) > 1 for s in spelled], bool)
        for _, sizes in found:  # a unit without ids is not spelled
            good &= np.diff(np.concatenate([[0], np.cumsum(sizes == 0)])[firsts]) == 0
        out = [(ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[firsts])) for ids, sizes in found]
        if not self.apart:
            whole = self.b.encode([t or "" for t in texts], num_threads=1)
            good &= [b"".join(map(self.bytes_b.__getitem__, ids)) == s for ids, s in zip(whole, spelled, strict=True)]
            sizes = np.array([*map(len, whole)], np.int64)
            out.append((np.fromiter(chain.from_iterable(whole), np.int32, sizes.sum()), sizes))
        (a, n_a), (b, n_b) = ((ids[np.repeat(good, sizes)], np.where(good, sizes, 0)) for ids, sizes in out)
        return a, np.concatenate([[0], np.cumsum(n_a)]), b, np.concatenate([[0], np.cumsum(n_b)])

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of A and of B by text."""
        a, firsts_a, b, firsts_b = self.flat(texts)
        return np.split(a, firsts_a[1:-1]), [ids.tolist() for ids in np.split(b, firsts_b[1:-1])]


def _byte_set(letters: str) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte is one of the letters; whether it is so after the first byte of U+00C0 to U+00FF."""
    one = re.compile(f"[{letters}]")
    plain = np.array([i < 0x80 and bool(one.match(chr(i))) for i in range(256)])
    second = np.array([0x80 <= i < 0xC0 and bool(one.match(chr(i + 0x40))) for i in range(256)])
    return plain, second


def cut(spelled: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Units of texts that begin with a space, and the place of each text's first unit (one more than texts).

    A unit begins at a space that has a letter behind it and a letter, digit or mark before it.
    """
    data = b"".join(spelled)
    begins = np.concatenate([[0], np.cumsum([*map(len, spelled)], dtype=np.int64)])
    at = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20)
    around = np.frombuffer(b"\0\0" + data + b"\0\0", np.uint8)
    earlier, before, after, later = (around[at + k] for k in (0, 1, 3, 4))
    (plain, second), (letter, accented) = _byte_set(LETTERS + MARKS), _byte_set(LETTERS)
    keep = (plain[before] | (second[before] & (earlier == 0xC3))) & (letter[after] | ((after == 0xC3) & accented[later]))
    keep[np.searchsorted(at, begins[:-1])] = True
    starts = at[keep]
    offsets = np.append(starts, len(data)).astype(np.int64)
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return units, np.searchsorted(starts, begins)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, firsts_a: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all documents (place in A, place in B), and which tokens of A end at a cut.

    ``ends`` run on over the documents' bytes; ``firsts_a`` has the place of each document's
    first token of A, and their number at the end.
    """
    sizes = np.diff(firsts_a)
    lanes = -(-sizes // lane)
    number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at_a = np.repeat(firsts_a[:-1], lanes) + number * lane
    stop = np.minimum(at_a + lane, np.repeat(firsts_a[1:], lanes))
    at_b = np.searchsorted(ends_b, np.concatenate([[0], ends_a])[at_a], "right")
    linked_a, linked_b, cut = [at_a[:0]], [at_b[:0]], np.zeros(len(ends_a), bool)
    while len(at_a):
        linked_a.append(at_a)
        linked_b.append(at_b)
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        cut[at_a[end_a == end_b]] = True
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = at_a < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    return np.concatenate(linked_a), np.concatenate(linked_b), cut


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([str(i) for i in range(n)], "S9")
    return text.view(np.uint8).reshape(n, 9), np.char.str_len(text)


def alignment_texts(a: np.ndarray, b: np.ndarray, firsts_a: np.ndarray, firsts_b: np.ndarray, cut_a: np.ndarray,
                    cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every document: the joined bytes, and where each text ends."""
    last_a, last_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    place_a = np.arange(len(a)) + np.concatenate([[0], last_b])[group_a]
    place_b = np.arange(len(b)) + last_a[group_b] if len(b) else np.empty(0, np.int64)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a], mark[place_b] = np.where(cut_a, ord("|"), ord(",")), np.where(cut_b, ord(";"), ord(","))
    digits, widths = worker_cache("decimals", lambda: _decimals(1 << 17))
    out = np.empty((len(ids), 10), np.uint8)
    out[:, :9] = digits[ids]
    width = widths[ids]
    out[np.arange(len(ids)), width] = mark
    taken = np.arange(10) < (width + 1)[:, None]
    doc_ends = (firsts_a + firsts_b)[1:]
    filled = doc_ends[doc_ends > (firsts_a + firsts_b)[:-1]]
    taken[filled - 1, width[filled - 1]] = False
    sizes = np.concatenate([[0], np.cumsum(taken.sum(1))])
    return out[taken], sizes[doc_ends]


def pack_links(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Rising numbers as differences, with how often each is linked; byte planes, compressed."""
    both = np.stack([np.diff(numbers, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").reshape(2, -1).astype(np.int64)
    return np.cumsum(both[0]), both[1]


class Dictionary:
    """The pairs of a block, numbered as they are met, and in how many documents each is linked."""

    def __init__(self) -> None:
        self.sorted = self.numbers = self.pairs = self.docs = np.empty(0, np.int64)
        self.links = 0

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of distinct sorted pairs."""
        at = np.searchsorted(self.sorted, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.sorted)
        known[inside] = self.sorted[at[inside]] == keys[inside]
        new = keys[~known]
        out = np.empty(len(keys), np.int64)
        out[known] = self.numbers[at[known]]
        out[~known] = len(self.pairs) + np.arange(len(new))
        self.numbers = np.insert(self.numbers, at[~known], out[~known])
        self.sorted = np.insert(self.sorted, at[~known], new)
        self.pairs, self.docs = np.concatenate([self.pairs, new]), np.concatenate([self.docs, np.zeros(len(new), np.int64)])
        return out

    def full(self) -> bool:
        return len(self.pairs) >= BLOCK_PAIRS or self.links >= BLOCK_LINKS


def align_batch(pair: Pair, texts: list[str | None], known: Dictionary) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[bytes]]:
    """The four sizes, the alignment texts and the packed links of a batch of documents."""
    a, firsts_a, b, firsts_b = pair.flat(texts)
    a, b = a.astype(np.int64), b.astype(np.int64)
    ends_a, ends_b = np.cumsum(pair.sizes_a[a]), np.cumsum(pair.sizes_b[b])
    at_a, at_b, cut_a = lockstep(ends_a, ends_b, firsts_a)
    cut_b = np.zeros(len(b), bool)
    cut_b[np.searchsorted(ends_b, ends_a[cut_a])] = True
    letters, text_ends = alignment_texts(a, b, firsts_a, firsts_b, cut_a, cut_b)

    keys, which = np.unique(a[at_a] * PAIR + b[at_b], return_inverse=True)
    numbers = known.number(keys)[which]
    doc = np.repeat(np.arange(len(texts)), np.diff(firsts_a))[at_a]
    seen, times = np.unique(doc * PAIR + numbers, return_counts=True)
    known.docs += np.bincount(seen % PAIR, minlength=len(known.docs))
    known.links += len(at_a)
    firsts = np.searchsorted(seen, np.arange(len(texts) + 1) * PAIR)
    packed = [pack_links(seen[i:j] % PAIR, times[i:j]) for i, j in zip(firsts, firsts[1:], strict=False)]
    cuts = np.concatenate([[0], np.cumsum(cut_a)])[firsts_a]
    sizes = [np.diff(firsts_a), np.diff(firsts_b), np.diff(cuts), np.bincount(doc, minlength=len(texts))]
    return sizes, letters, text_ends, packed


def align(docs: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Documents with their alignment, and the dictionary of every block (``is_doc`` false)."""

    def dictionary(block: int, known: Dictionary) -> pa.RecordBatch:
        row = {"block": block, "is_doc": False, "pairs": known.pairs, "docs": known.docs}
        return pa.RecordBatch.from_pylist([row], PARTS)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_cache(f"pair-{a}-{b}", lambda: Pair(a, b))
        known, block = Dictionary(), TaskContext.get().partitionId() << 24
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0)
            for i, j in groups([t or "" for t in texts], BATCH_CHARS):
                sizes, letters, ends, packed = align_batch(pair, texts[i:j], known)
                lines = pa.StringArray.from_buffers(j - i, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(letters))
                nothing = pa.nulls(j - i, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(j - i, block)), ids.slice(i, j - i), *[pa.array(s.astype(np.int64)) for s in sizes], lines,
                    pa.array(packed, pa.binary()), pa.array(np.ones(j - i, bool)), nothing, nothing], schema=PARTS)
                if known.full():
                    yield dictionary(block, known)
                    known, block = Dictionary(), block + 1
        if len(known.pairs):
            yield dictionary(block, known)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(aligned, PARTS_DDL)


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents a pair is linked, and whether no pair of its A id is in more."""
    counts = dictionaries.groupBy("pair").agg(F.sum("docs").alias("n"))
    highest = counts.groupBy((F.shiftrightunsigned("pair", 32)).alias("a")).agg(F.max("n").alias("most"))
    # One row for each id of A: never more than A's vocabulary.
    return counts.join(F.broadcast(highest), F.shiftrightunsigned("pair", 32) == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """One block: its documents with the sums over their links."""
    place = counts["place"].to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for data in docs["links"]:
        numbers, times = unpack_links(data.as_py())
        n_best.append(int(times @ best[numbers]))
        total.append(int(times @ n[numbers]))
    out = docs.drop_columns(["block", "links"])
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def score(parts: DataFrame) -> DataFrame:
    """Documents with ``n_best`` and ``count_sum``: links whose pair is its A id's commonest, and the sum of counts.

    ``parts`` is a written table of ``align``; columns of documents that it has beside them stay.
    """
    docs = parts.where("is_doc").drop("is_doc", "pairs", "docs")
    known = parts.where("not is_doc").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "entry")).select(
        "block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.docs").alias("docs"))
    counts = written(pair_counts(known), "pair-counts")
    placed = known.select(F.col("block").alias("of_block"), "place", "pair").join(counts, "pair").select("of_block", "place", "n", "best")
    kept = [f for f in docs.schema.fields if f.name not in ("block", "links")]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"
    return docs.groupBy("block").cogroup(placed.groupBy("of_block")).applyInArrow(_scored, ddl)


def digests(docs: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: sizes, sums over links, and the digest of its alignment ('' without tokens)."""
    made = align(docs, a, b, text, key)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return score(written(made.withColumn("groups_sha256", digest).drop("groups"), "alignment"))
