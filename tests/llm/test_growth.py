"""What a task or a group holds stays the same as the input grows."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from settle.llm import bpe, nearest, simhash
from settle.llm.common import store
from settle.llm.queries import multilingual, token_digests


def test_groups_of_words_do_not_grow(corpus, make, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 8_000)
    monkeypatch.setattr(bpe, "TASK_BYTES", 200_000)
    largest, buckets = [], []
    for documents in (400, 4000):
        rows = store(make([" ".join(f"{hash((i, j)) % 100_000_007:x}" for j in range(200)) for i in range(documents)]), "grown")
        n, tasks = bpe.shares(rows)
        words = bpe.distinct_words(rows.select(F.struct("doc_id").alias("kept"), "text"), n)
        groups = words.groupBy("bucket").agg(F.sum(F.octet_length("words")).alias("size"))
        largest.append(groups.agg(F.max("size")).first()[0])
        buckets.append((n, tasks))
    assert buckets[1][0] > buckets[0][0] and buckets[1][1] > 8
    assert largest[1] < 2 * largest[0]


def test_many_tasks_give_the_same_ids(corpus, make, monkeypatch):
    vocabulary = multilingual()
    rows = store(make([f"some words of text number {i} {'again ' * (i % 7)}" for i in range(300)]), "tasks")
    usual = token_digests(bpe.encode(rows, vocabulary, ["doc_id"]), vocabulary)
    usual = sorted(map(tuple, usual.collect()))
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 1_000)
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 100)
    monkeypatch.setattr(bpe, "TASK_BYTES", 500)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 3)
    encoded = bpe.encode(rows, vocabulary, ["doc_id"])
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # words by bucket, and both sides by block
    assert sorted(map(tuple, token_digests(encoded, vocabulary).collect())) == usual
    assert sorted(map(tuple, token_digests(bpe.round_trip(rows, vocabulary, ["doc_id"]), vocabulary).collect())) == usual
    decoded = {doc: digest for doc, _, _, digest in usual}
    for r in rows.collect():
        assert decoded[r.doc_id] == hashlib.sha256(r.text.encode()).hexdigest()


def test_queries_go_to_cells_within_reach(corpus, monkeypatch):
    """On clustered vectors a query's vector meets few cells, and the results are those of all pairs."""
    monkeypatch.setattr(nearest, "SHARD_ROWS", 100)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 50)
    random_ = np.random.default_rng(9)
    vectors = np.repeat(random_.normal(size=(40, 32)), 100, axis=0) + 0.01 * random_.normal(size=(4000, 32))
    rows = corpus.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    stored, kept = nearest.store, {}
    monkeypatch.setattr(nearest, "store", lambda df, name: kept.setdefault(name, stored(df, name)) if name == "nearest_cells" else stored(df, name))
    got = nearest.nearest(rows, rows.vec_id % 20 == 0, 20, "vec_id", "embedding").toPandas()
    cells = kept["nearest_cells"].groupBy("cell").agg(F.max("apart").alias("reach"), F.count("*").alias("n")).collect()
    assert len(cells) > 20
    codes = nearest.learn(vectors, 20)
    # Cells are tight where vectors lie in clusters: far tighter than codes of different clusters are apart.
    assert sorted(c.reach for c in cells)[len(cells) // 2] < codes.turns.shape[1] // 4
    score = vectors[::20] @ vectors.T
    score[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    want = {(20 * i, int(j)) for i, row in enumerate(score) for j in np.argsort(-row)[:20]}
    assert len(want & set(zip(got.query_id, got.id, strict=True))) / len(want) >= 0.9
    assert got.groupby("query_id").size().eq(20).all()


def test_listed_fingerprints_are_not_sent_through_the_driver(corpus):
    """Each is listed 33 times, which Spark does not count: a small table is no small side."""
    rows = store(corpus.range(2000).select((F.col("id") * 8).alias("fp")), "few_fingerprints")
    links = simhash.links(rows)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    want = {(8 * a, 8 * b) for a in range(2000) for b in {a ^ (1 << i) ^ (1 << j) for i in range(11) for j in range(11)} | {a ^ (1 << i) for i in range(11)} if a < b < 2000}
    assert set(map(tuple, links.collect())) == want
