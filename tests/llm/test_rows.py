"""Every operator on rows without text, odd texts, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from settle.llm import bpe, decontaminate, language_id, personal, quality, secrets, simhash
from settle.llm.common import store
from settle.llm.queries import multilingual

BENCHMARK = "item_id long, text string, score double"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def benchmark(corpus):
    rows = [(1, "one two three four five", 0.0), (2, None, 0.0), (3, "", 0.0), (None, "the same text twice", 0.0)]
    return corpus.createDataFrame(rows, BENCHMARK)


@pytest.fixture(scope="module")
def labels(corpus):
    return corpus.createDataFrame([(i, i % 2, 0) for i in range(10)] + [(3, None, 0), (None, 1, 0)], LABELS)


def operators(benchmark, labels):
    vocabulary = multilingual()
    return {
        "language": language_id.identify,
        "near": simhash.near_duplicates,
        "contaminated": lambda d: decontaminate.findings(d, benchmark, ["doc_id"]),
        "secrets": lambda d: secrets.scan(d, ["doc_id"]),
        "personal": lambda d: personal.find(d, ["doc_id"]),
        "bpe": lambda d: bpe.decode(bpe.encode(d, vocabulary, ["doc_id"]), vocabulary),
        "quality": lambda d: quality.score(d, labels),
    }


NAMES = ["language", "near", "contaminated", "secrets", "personal", "bpe", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_row(make, odd_texts, benchmark, labels, name):
    pairs = [*enumerate(odd_texts), (4, "A."), (None, "no id"), (None, None)]
    documents = store(make(pairs), "odd")
    rows = operators(benchmark, labels)[name](documents).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in pairs)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(make, benchmark, labels, name):
    assert operators(benchmark, labels)[name](make([])).count() == 0


def run_stages(spark, documents, folder):
    kept = [documents]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], folder), name))
    return kept


def test_pipeline_on_odd_rows(corpus, make, odd_texts, tmp_path):
    corpus.createDataFrame([(1, "word word word")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents = store(make([*enumerate(odd_texts), (None, "no id")]), "odd")
    kept = run_stages(corpus, documents, str(tmp_path))
    for before, after in zip(kept[:-2], kept[1:-1], strict=True):
        assert after.columns == before.columns
        assert after.count() <= before.count()
    texts = [r.text for r in kept[1].collect()]
    assert None not in texts and "" not in texts and "1234567890123456" not in texts
    assert [r.text for r in kept[2].collect()].count("the same text twice, word for word") == 1
    assert not any("word word" in r.text for r in kept[3].collect())
    assert not any("abcdefghijkl12" in r.text for r in kept[4].collect())
    assert kept[5].count() == kept[4].count()


def test_pipeline_on_nothing(corpus, make, tmp_path):
    corpus.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [df.count() for df in run_stages(corpus, make([]), str(tmp_path))] == [0] * 6


def test_ids_without_a_value_share_a_hold_out(make):
    got = language_id.identify(make([(None, "one"), (None, "two")])).select("held_out").distinct().collect()
    assert len(got) == 1
