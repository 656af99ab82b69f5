"""Whitening, exact top-k search and the prefix trie against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from settle.llm import exact_search, prefix_trie, queries, whitening
from settle.llm.radix_tree import Tree

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def vectors(corpus):
    def build(rows, schema=VECTORS):
        made = corpus.createDataFrame([(i, v, 0) for i, v in rows], schema)
        clashing = ["_id", "x", "id", "row", "class", "cell", "rank", "score", "component", "n", "_scaled", "place", "asked", "tree"]
        return made.withColumns({name: F.lit("x") for name in clashing})

    return build


# Whitening.


def plain_whitening(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(1), ((n * x - sums) / n) @ axes, values, np.trace(centred.T @ centred / n)


def check_whitening(got, ids, data, count):
    n, deviation, projected, values, trace = plain_whitening(data)
    got = got.sort_values(["vec_id", "component"])
    order = np.argsort(ids)
    assert sorted(set(got.component)) == list(range(1, count + 1))
    assert set(got.n) == {n} and (got.identity_error < 1e-8).all()
    shape = (len(ids), count)
    assert (got.deviation.to_numpy().reshape(shape) == deviation[order][:, None]).all()
    white = projected[order][:, :count] / np.sqrt(values[:count])
    found = got.whitened.to_numpy().reshape(shape)
    assert np.abs(found * np.sign((found * white).sum(0)) - white).max() < 1e-8
    assert np.allclose(got.explained.to_numpy().reshape(shape), values[:count] / trace, rtol=1e-9)


def test_whitening_of_given_vectors(corpus):
    got = queries.QUERIES["op11_whitening"](corpus, SMALL).toPandas()
    given = corpus.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    check_whitening(got, given.vec_id.to_numpy(), given.embedding.to_list(), 16)


@pytest.mark.parametrize("dimensions, rank, spread", [(3, 3, 0), (40, 40, 2.0), (50, 9, 0.5), (70, 70, -0.02)])
def test_whitening_of_spectra(vectors, dimensions, rank, spread):
    draw = np.random.default_rng(dimensions)
    scales = np.exp(-spread * np.arange(rank) / 4) * 8
    data = np.float32((draw.normal(size=(300, rank)) * scales) @ np.linalg.qr(draw.normal(size=(dimensions, rank)))[0].T)
    if rank < dimensions:  # the rank must survive rounding down
        data = np.float32(draw.integers(-40, 40, (300, rank)) @ draw.integers(-3, 4, (rank, dimensions)))
    got = whitening.whiten(vectors(list(enumerate(data.tolist()))), "vec_id", "embedding").toPandas()
    check_whitening(got, np.arange(300), data, min(16, rank))


def test_whitening_of_odd_rows(corpus, vectors):
    data = np.random.default_rng(1).normal(size=(30, 4)).astype(np.float32).tolist()
    good = list(enumerate(data)) + [(None, data[0]), (3, data[3]), (90, data[4])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0]), (52, [NAN, 0.0, 0.0, 0.0]), (53, [INF, 0.0, 0.0, 0.0]), (54, [3e38, 0.0, 0.0, 0.0])]
    got = whitening.whiten(vectors(good + bad), "vec_id", "embedding").toPandas()
    assert len(got) == 4 * len(good) and set(got.n) == {30} and got.vec_id.isna().sum() == 4
    same = got[got.vec_id == 3].groupby("component").whitened.nunique()
    assert (same == 1).all()
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])]):
        assert whitening.whiten(vectors(few), "vec_id", "embedding").count() == 0


def test_short_vectors_are_filled_up(vectors):
    data = np.random.default_rng(2).normal(size=(20, 3)).astype(np.float32).tolist()
    data[4][2] = 0.0
    short = [v[:2] if i == 4 else v for i, v in enumerate(data)]
    one, other = (whitening.whiten(vectors(list(enumerate(d))), "vec_id", "embedding").orderBy("vec_id", "component").collect() for d in (data, short))
    assert [r["whitened"] for r in one] == pytest.approx([r["whitened"] for r in other])


def test_deviation_beyond_a_long_is_null(vectors):
    rows = [(i, [v, 0.0]) for i, v in enumerate([1e15, -1e15, 5.0, 7.0])]
    got = whitening.whiten(vectors(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding").toPandas()
    assert got.sort_values("vec_id").deviation.isna().tolist() == [True, True, False, False] and (got.identity_error < 1e-8).all()


# Exact search.


def plain_top(rows, k):
    kept = [(i, [int(np.floor(64 * float(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(64 * float(c)) for c in v)]
    result = []
    for at, (i, v) in enumerate(kept):
        if i % 20 == 0:
            scored = [(min(max(sum(a * b for a, b in zip(v, w, strict=False)), 1 - 2**63), 2**63 - 1), j) for other, (j, w) in enumerate(kept) if other != at]
            best = sorted(scored, key=lambda p: (-p[0], p[1]))[:k]
            result += [(i, rank + 1, j, score) for rank, (score, j) in enumerate(best)]
    return sorted(result)


def found_top(table, k=5):
    return sorted(tuple(r) for r in exact_search.top_k(table, F.col("vec_id") % 20 == 0, k, "vec_id", "embedding").collect())


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(exact_search, "SHARD_ROWS", 40)
    monkeypatch.setattr(exact_search, "LEAF_ROWS", 4)
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", 7)


@pytest.mark.parametrize("kind", ["clusters", "lattice", "large"])
def test_exact_search(vectors, small_shards, kind):
    draw = np.random.default_rng(3)
    if kind == "clusters":
        centres = draw.normal(size=(12, 6)) * 3
        data = np.float32(centres[draw.integers(0, 12, 400)] + draw.normal(size=(400, 6)) * 0.05)
    elif kind == "lattice":  # ties and copies everywhere
        data = np.float32(draw.integers(-1, 2, (300, 3)) / 32)
    else:
        data = draw.normal(size=(200, 3)) * 10.0 ** draw.integers(0, 14, (200, 1))
    schema = VECTORS if kind != "large" else "vec_id long, embedding array<double>, label int"
    rows = [(int(i), v) for i, v in zip(draw.permutation(len(data)), data.tolist(), strict=True)]
    assert found_top(vectors(rows, schema)) == plain_top(rows, 5)


def test_clusters_are_pruned(monkeypatch):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 8)) * 30
    data = np.floor(64 * (centres[draw.integers(0, 40, 4000)] + draw.normal(size=(4000, 8)) * 0.1))
    tree, looked = exact_search.build(data, np.arange(4000), np.arange(4000), 50), []
    products = exact_search.products
    monkeypatch.setattr(exact_search, "products", lambda q, rows: looked.append(len(q) * len(rows)) or products(q, rows))
    found = exact_search.search(tree, data[:50], [None] * 50, 6)
    scores = data[:50] @ data.T
    for q, best in enumerate(found):
        order = np.lexsort((np.arange(4000), -scores[q]))[:6]
        assert [c for *_, c in best] == order.tolist()
    assert sum(looked) < 0.2 * 50 * 4000


def test_exact_search_of_odd_rows(vectors, small_shards):
    rows = [
        (0, [0.5, 0.25]), (0, [0.5, 0.25]), (0, [-0.5, 0.0]), (20, [0.0, 0.0]), (40, []), (60, [1.0]), (1, [0.5, 0.25, 0.125]),
        (2, None), (3, [None, 1.0]), (80, [NAN, 1.0]), (5, [INF, 0.0]), (None, [1.0, 1.0]), (7, [3e38, -3e38]), (100, [-3e38, 3e38]), (-20, [1.0, -1.0]),
    ]
    assert found_top(vectors(rows)) == plain_top(rows, 5)
    for few in ([], [(1, [1.0])], [(20, [1.0])], [(20, None)]):
        assert found_top(vectors(few)) == []


def test_hot_vector(vectors, small_shards):
    draw = np.random.default_rng(5)
    rows = [(i, [0.5, 0.5, 0.25] if i % 3 == 0 else draw.normal(size=3).astype(np.float32).tolist()) for i in range(600)]
    assert found_top(vectors(rows), 20) == plain_top(rows, 20)


# Radix trees and the prefix trie.


def test_radix_tree_finds_what_was_put_in():
    draw = random.Random(6)
    for alphabet, longest, count in ((2, 12, 300), (256, 3, 5000), (17, 6, 2000), (60, 2, 3000)):
        words = {bytes(draw.randrange(alphabet) for _ in range(draw.randrange(longest + 1))) for _ in range(count)}
        tree = Tree()
        for word in draw.sample(sorted(words), len(words)):
            tree.insert(word).value = word
        sizes, seen = set(), []

        def visit(node, start, end, results, sizes=sizes, seen=seen):
            sizes.add(node.size)
            if node.value is not None:
                assert len(node.value) == end
                seen.append(node.value)
            below = list(node.ordered())
            assert len(below) == len(results) and (node.value is not None or len(below) > 1)
            return None

        tree.fold(visit)
        assert set(seen) == words
        assert alphabet != 256 or sizes == {4, 16, 48, 256} or 256 in sizes
        for word in words:
            *_, end = tree.path(word)
            assert end.value == word


def plain_trie(rows):
    """Nodes by definition, from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for *_, t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        source = c - int(np.fmod(c, 20))
        whole = tuple(turns.get(source, [])[:h] + turns[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, who in members.items():
        words = len([w for w in p[-1][1].replace("\n", " ").replace("\t", " ").split(" ") if w]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * words
    return sorted(
        (min(who), len(p), min(members[p[:-1]]) if p else -1, len(who), len(children[p]) if p in children else 0, leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, who in members.items()
    )


def found_trie(corpus, rows):
    made = corpus.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = made.withColumns({name: F.lit("x") for name in ["id", "words", "turns", "key", "from", "taken", "head", "kind", "path"]})
    got = prefix_trie.prefix_nodes(prefix_trie.borrowed_heads(made)).select(prefix_trie.COLUMNS)
    return sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())


@pytest.mark.parametrize("pieces", [2, 50_000])
def test_trie(corpus, monkeypatch, pieces):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", pieces)
    draw = random.Random(7)
    texts = ["hello there", "a b c", "", "one\ntwo\tthree", "again", "x " * 50]
    rows = []
    for c in draw.sample(range(-30, 400), 300):
        copy = draw.random() < 0.35  # many conversations are the same
        for t in range(4 if copy else draw.randrange(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", texts[0] if copy else draw.choice(texts)))
    assert found_trie(corpus, rows) == plain_trie(rows)


def test_trie_of_odd_rows(corpus):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "a  b"), (1, 0, "user", "a  b"), (1, 0, "tool", "z"),
        (2, -5, None, "é ü"), (2, 7, "user", None), (41, 1, "user", "only one"), (40, 3, "", ""), (57, 0, "user", "long " * 60_000), (57, None, "user", "first"),
    ]
    rows += [(77, t, "user", f"step {t}") for t in range(300)]
    assert found_trie(corpus, rows) == plain_trie(rows)
    assert found_trie(corpus, [])  == []
    # Turnless: conversation 9 takes over more turns than it has, from a conversation that is not there.
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert found_trie(corpus, [(turnless, 0, "user", "gone")]) == plain_trie([(turnless, 0, "user", "gone")])
    assert len(found_trie(corpus, [(turnless, 0, "user", "gone")])) == 1
