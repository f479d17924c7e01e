"""SentencePiece encoding and decoding, exact for merge-type (BPE) models.

A merge-type model starts from single characters and merges, again and again, the adjacent
pair whose piece scores best (the leftmost of equals). A sequence of pieces is what that
gives if and only if every two neighbours are: merges inside two neighbours never look at
anything else. So a text can be encoded from left to right. One Aho-Corasick pass (over the
reversed text, with reversed pieces) finds the longest piece that begins at each place; a
piece follows another if merging both of them anew gives the two again (kept in a memo);
else the next shorter piece is tried, and when none is left the last piece is taken back.
What is encoded so far is always the one right encoding of its characters, hence a place
from which no piece went on fails for good: it is marked in a bitfield and never tried again.

Characters without a piece become their UTF-8 bytes, as the library does. No merge spans two
characters that no piece holds side by side. If that is so for line feeds, for gap markers after other
characters and for punctuation marks after letters, a text is cut there first, and each
worker keeps the ids of units it has met; other models are encoded as whole texts.

Defined results: a null or empty text has no ids and decodes to the empty text. Rows repeat as
given; other columns pass through, those of the result's names are replaced. Models that
normalise texts or hold pieces of the user are refused when opened.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import unused, worker_cache

GAP = "▁"
CACHED = 250_000
LONGEST_CACHED = 64
NONE = -1
SHIFT = 22  # more numbers than there are pieces and characters
NEVER = float("-inf")
# Fixed value: what the library writes for an unknown id.
UNKNOWN = " ⁇ ".encode()
PROBE = " Two  words,\n\tﬁ é 中　x \x00" + GAP
MARKS = ".,;:!?"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_UNITS = re.compile(f"{GAP}*[{LETTERS}]++(?=[{GAP}\n{MARKS}]|\\Z)|{GAP}*[^{GAP}\n]+|{GAP}+|\n")
_JOINED = re.compile(f"[^{GAP}]{GAP}|\n|[{LETTERS}][{MARKS}]")


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Units(dict):
    """Ids of the units met, in two generations, so the frequent ones stay."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, unit: str) -> bytes:
        made = self.older.get(unit) or self.encode(unit)
        if len(unit) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[unit] = made
        return made


class Pieces:
    """A merge-type vocabulary: encodes texts to ids and decodes ids."""

    def __init__(self, model: str):
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i) for i in range(n)]
        names = [library.id_to_piece(i) for i in range(n)]
        self.ids = {names[i]: i for i in range(n) if not special[i]}
        self.scores = {names[i]: library.get_score(i) for i in range(n) if not special[i]}
        self.bytes = {int(names[i].strip("<>"), 16): i for i in range(n) if library.is_byte(i)}
        self.unknown = library.unk_id()
        # Tokens by number: pieces by their id, from n on characters without a piece.
        self.texts, self.sizes, self.shorter = names, [len(p) for p in names], [NONE] * n
        self.characters: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece[::-1], i)
            self.shorter[i] = next((self.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), NONE)
            if self.shorter[i] == NONE and len(piece) > 1:
                self.shorter[i] = self._character(piece[0])
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.units = Units(self._unit)
        self.apart = not any(map(_JOINED.search, self.ids))
        self.spelled = [b"" if x else name.replace(GAP, " ").encode() for x, name in zip(special, names, strict=True)]
        self.spelled[self.unknown] = UNKNOWN
        for byte, i in self.bytes.items():
            self.spelled[i] = bytes([byte])
        self.gapped = np.array([names[i].startswith(GAP) and not special[i] for i in range(n)], bool)
        codecs.register_error("review_engine_bytes", _one_by_one)
        if self.encode(PROBE).tolist() != library.encode(PROBE) or self.decode(library.encode(PROBE)) != library.decode(library.encode(PROBE)):
            raise ValueError("not a plain merge-type model: it normalises texts or has pieces of the user")

    def merged(self, text: str) -> list[str]:
        """The merges of the model, step by step: for short texts."""
        parts, score = list(text), self.scores.get
        joint = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while joint and (best := max(joint)) > NEVER:
            i = joint.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joint[i]
            if i:
                joint[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(joint):
                joint[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def _character(self, character: str) -> int:
        """The number of a character: its piece, or a number of its own."""
        known = self.ids.get(character, self.characters.get(character))
        if known is None:
            known = self.characters[character] = len(self.texts)
            self.texts.append(character)
            self.sizes.append(1)
            self.shorter.append(NONE)
        return known

    def fits(self, before: int, token: int) -> bool:
        """Whether a token may follow another (or begin a text, after none)."""
        if len(self.pairs) >= CACHED:
            self.pairs.clear()
        last = [] if before == NONE else [self.texts[before]]
        known = self.pairs[before << SHIFT | token] = self.merged("".join(last) + self.texts[token]) == [*last, self.texts[token]]
        return known

    def tokens_of(self, text: str) -> list[int]:
        """The encoding of a text (gap markers in place) by backtracking."""
        n = len(text)
        longest = [NONE] * (n + 1)
        for end, token in self.automaton.iter(text[::-1]):  # of the pieces at a place the longest comes first
            if longest[n - 1 - end] == NONE:
                longest[n - 1 - end] = token
        if NONE in longest[:n]:
            longest = [self._character(c) if t == NONE else t for c, t in zip(text, longest, strict=False)] + [NONE]
        sizes, shorter, pairs = self.sizes, self.shorter, self.pairs
        failed, some_failed = bytearray((n >> 3) + 1), False
        made: list[int] = []
        at, before, token = 0, NONE, longest[0]
        while at < n:
            while token != NONE:
                end = at + sizes[token]
                if not (some_failed and failed[end >> 3] >> (end & 7) & 1):
                    fits = pairs.get(before << SHIFT | token)
                    if fits or (fits is None and self.fits(before, token)):
                        break
                token = shorter[token]
            if token != NONE:
                made.append(token)
                at, before, token = end, token, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                some_failed = True
                last = made.pop()
                at, before, token = at - sizes[last], made[-1] if made else NONE, shorter[last]
        return made

    def pieces_of(self, text: str) -> list[str]:
        return [self.texts[token] for token in self.tokens_of(text)]

    def _unit(self, unit: str) -> bytes:
        made = self.tokens_of(unit)
        if self.characters:
            ids: list[int] = []
            for token in made:
                if token < len(self.spelled):
                    ids.append(token)
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in self.texts[token].encode())
                else:
                    ids.append(self.unknown)
            made = ids
        return array("i", made).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        marked = GAP + text.replace(" ", GAP)
        units = _UNITS.findall(marked) if self.apart else [marked]
        return np.frombuffer(b"".join(map(self.units.__getitem__, units)), np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "review_engine_bytes")
        first = next((i for i in ids if self.spelled[i]), None)
        return text[1:] if first is not None and self.gapped[first] else text


def opened(model: str) -> Pieces:
    """The vocabulary, kept for the life of this worker."""
    return worker_cache(f"pieces-{model}", lambda: Pieces(model))


def encoded(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text as an array."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = opened(model)
        for batch in batches:
            made = [pieces.encode(t.as_py()) for t in batch]
            ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*made, np.empty(0, np.int32)])))

    # Not deterministic for the planner only: what reads the ids must not encode once more.
    return docs.withColumn(ids, encode.asNondeterministic()(F.col(text)))


def decoded(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each array of ids; null for a null array."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = opened(model)
        for batch in batches:
            flat, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            made = (pieces.decode(flat[i:j].tolist()) for i, j in zip(ends, ends[1:], strict=False))
            yield pa.array([text if known else None for text, known in zip(made, batch.is_valid().to_pylist(), strict=True)], pa.string())

    return docs.withColumn(text, decode(F.col(ids)))


def digests(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Number of ids and digests of the ids and of the text they decode to."""
    ids, back = unused(docs, "ids"), unused(docs, "decoded")
    made = decoded(encoded(docs, model, text, ids), model, ids, back)
    return made.withColumns({
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256),
        "decoded_sha256": F.sha2(back, 256)}).drop(ids, back)
