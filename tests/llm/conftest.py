import pytest
from pyspark.sql import functions as F

from settle.llm.common import prepare

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def make(corpus):
    """Documents from texts, or from (doc_id, text) pairs; with columns whose names the operators use inside."""

    def build(texts, lang="en", source="src0"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs]
        made = corpus.createDataFrame(rows, DOCUMENTS)
        clashing = ["fp", "ids", "kept", "score", "lang_pred", "spans", "_row", "value", "bucket", "n_words", "root"]
        return made.withColumns({name: F.lit("x") for name in clashing})

    return build


@pytest.fixture(scope="session")
def odd_texts():
    return [
        None, "", " ", "\n\t ", "A.", "a", "1234567890123456", "é", "日本語のテキスト", "word " * 30_000,
        "the same text twice, word for word", "the same text twice, word for word", "x" * 200_000,
        "token=abcdefghijkl12", 'API_KEY: "abcdefghijklmnop"', "퟿\x00 nul", "😀 smile 😀",
    ]
