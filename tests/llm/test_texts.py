"""Language, extraction and tokens: against the libraries, by round trip, on held-out rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_engine.llm import html_extract, langid, queries, token_blocks, token_counts, units

SPM, HF = (queries.tokenizer_path(n) for n in (queries.PIECES, queries.WORDS))
ODD = "ab AÉ \n\t▁é　\x1c\x85'12ﬁ\x00\rΣ<|endoftext|>!*"


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["", "a", "<|endoftext|>", "x" * 5000, *["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)]]


def test_token_counts_equal_the_library():
    lengths = token_counts.Lengths(SPM, {"▁a": 1})
    texts = odd_texts(3000, 1)
    assert [token_counts.count(t, lengths) for t in texts] == [len(lengths.encoder.encode(t)) for t in texts]
    assert token_counts.count(None, lengths) == 0


def test_token_counts_of_odd_rows(small, odd_rows):
    df = small(odd_rows).withColumn("n_tokens_", F.lit(1))
    rows = token_counts.token_counts(df, SPM, limit=10).collect()
    lengths = token_counts.Lengths(SPM, {})
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.n_tokens == len(lengths.encoder.encode(r.text or "")) and r.over_limit == (r.n_tokens > 10)
        assert r.n_bytes == len((r.text or "").encode())
    assert token_counts.token_counts(df.limit(0), SPM).count() == 0


def test_encoder_equals_the_library():
    encoder = token_blocks.Encoder(HF)
    texts = odd_texts(3000, 2)
    for made, e in zip(encoder.encode(texts), encoder.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert made == np.array(e.ids, np.uint32).tobytes()


@pytest.mark.parametrize("bounds", [{"MOST_UNITS": 20}, {"MOST_IDS": 50}])
def test_words_met_before_are_not_encoded_again(monkeypatch, bounds):
    encoder, learned = token_blocks.Encoder(HF), []
    monkeypatch.setattr(encoder.units, "encode", lambda words: (learned.extend(words), encoder._words(words))[1])
    texts = [t for t in odd_texts(300, 6) if t] + ["one  two\nthree", "", " ", "three one"]
    expected = [encoder.whole(t) for t in texts]
    assert encoder.encode(texts) == expected == encoder.encode(texts) and len(learned) == len(set(learned)) > 300
    for name, value in bounds.items():
        monkeypatch.setattr(units, name, value)
    assert [encoder.encode([t])[0] for t in texts] == expected and encoder.encode([]) == []
    assert len(encoder.units.places) <= 20 or sum(len(k[0]) for k in encoder.units.kept) <= 50


@pytest.mark.parametrize("ids", [[5], [7] * 9000, [0, 2**32 - 1], list(range(5000)) + [2**31], []])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    packed = token_blocks.pack_segment(ids)
    assert (token_blocks.unpack_segment(packed) == ids).all()
    assert (token_blocks.unpack_segment(packed, 1, 2) == ids[4096:8192]).all()


def test_files_hold_every_document_in_order(spark, small, odd_rows, tmp_path):
    df = small(odd_rows)
    for name, rows in (("some", df), ("none", df.limit(0))):
        token_blocks.write_blocks(rows, str(tmp_path / name), HF, 1)
    assert token_blocks.read_blocks(spark, str(tmp_path / "none")).count() == 0
    encoder, start = token_blocks.Encoder(HF), 0
    expected = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    read = token_blocks.read_blocks(spark, str(tmp_path / "some")).orderBy("start").collect()
    for row, (key, text, _, _) in zip(read, expected, strict=True):
        ids = encoder.encode([text or ""])[0] + np.uint32(1).tobytes()
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (key, start, len(ids) // 4, zlib.crc32(ids))
        start += row.n_tokens


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav>
<header><h1>Site</h1></header><div class="ad">Buy now, a long advert text that has no tags at all in it.</div>
<article><h1>Title &amp; more</h1><p><b>First  line<br><p>Second
 line &copy; x.</p><form>Subscribe <input></form><ul><li>one<li>two</ul></article>
<div class="comments"><p>A reader comment, fairly long and without tags.</p></div><footer>foot</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == "Title & more\nFirst line\nSecond line © x.\none\ntwo"
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p> </p><script>x</script>") == ""
    assert html_extract.main_text("</p></div>plain <b>text") == "plain text"
    without = PAGE.replace("article>", "section>").replace("<p><b>First", "<p>" + "Long text. " * 30 + "<b>First")
    assert "Second line © x." in html_extract.main_text(without) and "Menu" not in html_extract.main_text(without)


@pytest.mark.parametrize("name", ["content has-sidebar", "with-nav", "no-comments", "related-content", "sidebar"])
def test_wrappers_named_like_parts_beside(name):
    expected = html_extract.main_text(PAGE)
    wrapped = PAGE.replace("<nav>", f'<div class="{name}"><nav>').replace("<footer>", "</div><footer>")
    assert html_extract.main_text(wrapped) == expected
    assert html_extract.main_text(wrapped.replace("<div class", "<div id='no_ads'><div class").replace("</div><footer>", "</div></div><footer>")) == expected
    if name not in ("sidebar", "related-content"):
        inside = PAGE.replace("<article>", f"<article><div class='{name}'>").replace("</article>", "</div></article>")
        assert html_extract.main_text(inside) == expected
    if name != "sidebar":
        plain = "<body><nav>Menu</nav><div class='%s'>%s</div><div class='comments'><article>Nice</article></div></body>"
        assert html_extract.main_text(plain % (name, "<p>Long text of a page.</p>" * 9)).count("Long text") == 9


def test_parts_beside_stay_out():
    comments = "<div class='comments'>" + "<article><p>A long comment of a reader.</p></article>" * 20 + "</div>"
    page = f"<body><article><p>The article itself.</p>{comments}</article></body>"
    assert html_extract.main_text(page) == "The article itself."


def test_extraction_of_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (1, "u", PAGE)], "page_id bigint, url string, html string")
    rows = html_extract.extract(pages).collect()
    assert [(r.page_id, r.n_chars) for r in rows] == [(1, len(r0.text)) if (r0 := rows[0]) and i != 1 else (2, 0) for i, r in enumerate(rows)]
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_language_on_held_out_rows(spark, folder, llm_runs):
    made = llm_runs["op1_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = made.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_of_odd_rows(small, odd_rows):
    df = small(odd_rows).withColumn("score", F.lit("clash"))
    model = langid.fit(df, langid.fold_of(F.col("doc_id")) != 9)
    rows = {(r.doc_id, r.text): r for r in langid.predict(df, model).collect()}
    assert rows[2, None].lang_pred == rows[3, ""].lang_pred == rows[4, "..."].lang_pred == "und"
    assert rows[1, odd_rows[0][1]].lang_pred in ("en", "fr")
    empty = langid.fit(df.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}


def test_training_is_sparse_and_calibrated():
    rng = np.random.default_rng(1)
    rows = [(np.array([k, 10 + k]), np.array([0.7, 0.7]), k) for k in rng.integers(0, 3, 600)]
    weights = langid.train_ftrl(rows, 3)
    assert (weights[20:] == 0).all() and all((v @ weights[f]).argmax() == k for f, v, k in rows)
    scores = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in langid.softmax(scores / 2.5)])
    assert 2.2 < langid.fit_temperature(scores, labels) < 2.8
