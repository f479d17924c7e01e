"""Alignment, piece encoding and spelling variants: against the libraries and brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_engine.llm import alignment, piece_encoding, queries, spelling

A, B = (queries.tokenizer_path(n) for n in (queries.BYTES, queries.PIECES))
ODD = "ab AÉ \n\t▁é　\x1c\x85'12ﬁ\x00\rΣ<|endoftext|>!*the.  中"


def odd_texts(n, seed, most=60):
    rng = random.Random(seed)
    return [None, "", "a", " ", "▁", "the " * 90, "<|endoftext|> x", "x" * 400, "the cat's  ran, and\n sat. É était 12 fois 's",
            *["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]]


# --- piece encoding ---------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.mark.parametrize("apart", [True, False])
def test_pieces_equal_the_library(library, apart):
    pieces = piece_encoding.Pieces(B)
    pieces.apart = apart
    for text in odd_texts(3000, 1):
        ids = pieces.encode(text).tolist()
        assert ids == library.encode(text or "")
        assert pieces.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_the_library_does(library):
    pieces, rng = piece_encoding.Pieces(B), random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000)]) for _ in range(rng.randint(0, 9))]
        assert pieces.decode(ids) == library.decode(ids)


def test_backtracking_takes_pieces_back(library):
    """Some words are not what the longest pieces give: places fail and are not tried again."""
    pieces, greedy = piece_encoding.Pieces(B), 0
    for word in {w for t in odd_texts(500, 3) if t for w in t.split()} | {"thntand", "erthhaon", "nationinthe"}:
        text, longest, at = "▁" + word, [], 0
        while at < len(text):
            size = next(n for n in range(len(text) - at, 0, -1) if n == 1 or text[at : at + n] in pieces.ids)
            longest.append(text[at : at + size])
            at += size
        made = pieces.pieces_of(text)
        greedy += made != longest
        assert made == pieces.merged(text)
    assert greedy > 10


def test_long_texts_without_gaps(library):
    pieces = piece_encoding.Pieces(B)
    text = "x" * 60_000 + "ab" * 20_000
    assert pieces.encode(text).tolist() == library.encode(text)


def test_encoding_of_rows(library, small, odd_rows):
    df = small(odd_rows).withColumns({"ids_sha256": F.lit("clash"), "ids": F.lit("own"), "decoded": F.lit("own")})
    rows = piece_encoding.digests(df, B).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted((i or 0, t or "") for i, t, _, _ in odd_rows)
    for r in rows:
        ids = library.encode(r.text or "")
        assert r.ids == r.decoded == "own"  # columns of any other name pass through
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piece_encoding.digests(df.limit(0), B).count() == 0
    null = df.limit(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert piece_encoding.decoded(null, B).first().decoded is None


def test_query_encodes_the_whole_table(spark, folder, library, llm_runs):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = llm_runs["op12_piece_encoding"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


# --- alignment --------------------------------------------------------------------


def ranges(ids, spelled):
    ends = np.cumsum([0, *[len(spelled[i]) for i in ids]]).tolist()
    return list(zip(ends, ends[1:], strict=False))


def brute_alignment(texts):
    from tokenizers import Tokenizer

    pair, whole = alignment.Pair(A, B), Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    docs, counts, best = [], collections.Counter(), collections.Counter()
    for t in texts:
        a, b = whole.encode(" " + (t or ""), add_special_tokens=False).ids, pair.b.encode(t or "")
        bytes_ = (" " + (t or "")).encode()
        if not t or any(b"".join(map(s.__getitem__, ids)) != bytes_ for s, ids in ((pair.bytes_a, a), (pair.bytes_b, b))):
            a = b = []
        at_a, at_b = ranges(a, pair.bytes_a), ranges(b, pair.bytes_b)
        links = [(i, j) for i, (s, e) in zip(a, at_a, strict=True) for j, (u, v) in zip(b, at_b, strict=True) if s < v and u < e]
        cuts = [0, *sorted({e for _, e in at_a} & {e for _, e in at_b})]
        parts = ["|".join(",".join(str(i) for i, (s, _) in zip(ids, at, strict=True) if lo <= s < hi) for ids, at in ((a, at_a), (b, at_b)))
                 for lo, hi in zip(cuts, cuts[1:], strict=False)]
        counts.update(set(links))
        docs.append((a, b, links, parts))
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(len(a), len(b), len(parts), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(parts).encode()).hexdigest() if a else "") for a, b, links, parts in docs]


def aligned_rows(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
            for r in alignment.digests(df, A, B).orderBy("doc_id").collect()]


@pytest.mark.parametrize("limits", [{}, {"LANE": 3, "BLOCK_PAIRS": 40, "BATCH_CHARS": 500}])
def test_alignment_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment.lockstep, "__defaults__", (limits.get("LANE", alignment.LANE),))
    texts = odd_texts(120, 4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert aligned_rows(df) == brute_alignment(texts)


def test_alignment_of_rows(small, odd_rows):
    df = small(odd_rows).withColumns({"links": F.lit("clash"), "block": F.lit("clash")})
    rows = alignment.digests(df, A, B).collect()
    expected = brute_alignment([t for _, t, _, _ in odd_rows])
    order = lambda r: (r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows], key=order) == sorted(
        [(k, *e) for (k, *_), e in zip(odd_rows, expected, strict=True)], key=order)
    assert alignment.digests(df.limit(0), A, B).count() == 0


def test_alignment_query(spark, folder, llm_runs):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    expected = brute_alignment([d.text if len(d.text or "") < 900 else None for d in docs])
    rows = llm_runs["op11_token_alignment"](spark, folder).orderBy("doc_id").collect()
    assert len(rows) == len(docs)
    for d, e, r in zip(docs, expected, rows, strict=True):
        assert r.doc_id == d.doc_id
        if len(d.text or "") < 900:
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*e[:4], e[6])


def test_units_of_a_are_cut_where_its_pattern_cuts():
    from tokenizers import Tokenizer

    whole, pair = Tokenizer.from_file(A), alignment.Pair(A, B)
    whole.encode_special_tokens = True
    texts = [t for t in odd_texts(3000, 5) if t]
    for text, ids in zip(texts, pair.encode(texts)[0], strict=True):
        assert not len(ids) or ids.tolist() == whole.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("apart", [True, False])
def test_units_are_encoded_once_for_both_tokenizers(monkeypatch, apart):
    pair, learned = alignment.Pair(A, B), []
    monkeypatch.setattr(pair, "apart", apart and pair.apart)
    monkeypatch.setattr(pair.units, "encode", lambda units: (learned.extend(units), pair._units(units))[1])
    texts = [*odd_texts(2000, 7), "an \u00e9t\u00e9 \u00d7 \u00f7 x\u00d7 y\u00f7 z\u00ff a", "a \u2581b c", "Ende. Und  so\n weiter, ja", None, "", " ", "<|endoftext|> a"]
    assert pair.apart == apart and len(texts) > 2000
    made = [pair.encode(texts) for _ in range(2)]
    assert len(learned) == len(set(learned))
    for t, a, b in zip(texts, *made[0], strict=True):
        whole_a, whole_b = pair.a.encode(" " + (t or ""), add_special_tokens=False).ids, pair.b.encode(t or "")
        spelled = t and all(b"".join(map(s.__getitem__, ids)) == (" " + t).encode() for s, ids in ((pair.bytes_a, whole_a), (pair.bytes_b, whole_b)))
        assert (a.tolist(), b) == ((whole_a, whole_b) if spelled else ([], []))
    assert [x.tolist() for x in made[0][0]] == [x.tolist() for x in made[1][0]] and made[0][1] == made[1][1]


def test_links_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        numbers, times = np.unique(rng.integers(0, 1 << 31, n)), rng.integers(1, 1 << 20, n)
        times = times[: len(numbers)]
        back = alignment.unpack_links(alignment.pack_links(numbers, times))
        assert (back[0] == numbers).all() and (back[1] == times).all()


# --- spelling ---------------------------------------------------------------------


def brute_spelling(rows):
    lower, counts = str.maketrans(spelling.UPPER, spelling.LOWER), collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))

    forms, out = {}, {}
    for w in words:
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
        out[w] = len(others)

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {w: (forms[w], root(w), words[w], out[w], words.get(forms[w])) for w in words}


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Ab", "ba", "é", "É", "ç"]) + rng.choice(["cdef", "cdeff", "cde", "aaaa"]) + rng.choice(["", "x", "é"]) * rng.randint(0, 3)
                      for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return [*enumerate(texts), (None, "Abcdefg abcdefg"), (7, None), (8, ""), (9, "..."), (10, "longrun" * 500), (11, "longrun" * 500),
            (12, "longrun" * 500), (13, "longrun" * 499 + "longrum"), (14, "longrun" * 499 + "longrum"), (15, "longrun" * 499 + "longrum")]


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(df).collect()}


def test_spelling_equals_brute_force(spark, spelled):
    df = spark.createDataFrame(spelled, "doc_id bigint, text string").withColumn("word", F.lit("clash"))
    expected = brute_spelling(spelled)
    assert found(df) == expected and any(f and r != f for f, r, *_ in expected.values())
    assert found(df.limit(0)) == {} and found(df.where("text is null")) == {}


def test_full_filters_lose_no_link(spark, spelled, monkeypatch):
    """Few blocks for all words: more false candidates, the same result."""
    monkeypatch.setattr(spelling, "MOST_BLOCKS", spelling.LAST_SHARD + 3)
    monkeypatch.setattr(spelling, "PROBES_AT_ONCE", 500)
    df = spark.createDataFrame(spelled, "doc_id bigint, text string")
    assert found(df) == brute_spelling(spelled)


def test_filters_turn_most_others_away():
    rng = random.Random(7)
    words = list({"".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(4000)})
    filters = spelling.Filters.empty({8: len(words)})
    (_, points), = spelling.by_length(words)
    hashes = spelling.mix((points * spelling.powers(8)).sum(1))
    for block, mask in zip(filters.place(8, hashes), spelling.masks(hashes), strict=True):
        filters.blocks[block] |= mask
    assert filters.holds(8, hashes).all() and not filters.holds(7, hashes).any()
    assert filters.holds(8, spelling.mix(hashes + np.uint64(1))).mean() < 0.03


def test_long_chains_end(spark):
    chain = [(f"w{i:04}", f"w{i + 1:04}") for i in range(100)]
    tops = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in tops} == {w: "w0100" for w, _ in chain}
