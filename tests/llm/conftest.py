import pytest

from review_engine.llm import queries


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def small(spark, docs_schema):
    """Awkward rows: nulls everywhere, empty and long texts, ties, repeated rows, a clashing column."""

    def build(rows):
        full = [(i, t, lang, src, len(t or "")) for i, t, lang, src in rows]
        return spark.createDataFrame(full, docs_schema)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    long = "a few words again and again " * 3000
    return [(1, "The first text, with words enough to tell.", "en", "a"), (2, None, "en", None), (3, "", None, "b"),
            (4, "...", "fr", "b"), (5, long, "en", "a"), (6, "Le petit texte de la fin est ici.", "fr", "c"),
            (6, "Le petit texte de la fin est ici.", "fr", "c"), (None, "no key at all here", None, None),
            (8, "Le petit texte de la fin est ici.", None, "c")]


@pytest.fixture(scope="session")
def llm_runs():
    return queries.runs()
