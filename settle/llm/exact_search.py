"""Exact top-k search by inner product with a KD-tree for each shard.

Every component x becomes floor(64 x), so scores are integers and exact.

**Shards.** Equal vectors are one class; of its rows the `k + 1` with the smallest
ids are enough for any query. A coarse KD-tree over a bounded sample (median
splits of the widest dimension) gives up to CELLS cells; a cell is dealt by hash
into shards of SHARD_ROWS classes. Each shard gets a KD-tree, built once: median
splits down to LEAF_ROWS, rows stored in the order of the leaves, and the tight
bounding box of every node. The sample only decides which rows lie together;
every row is in a tree and every result is exact.

**Search.** For a query q no row of a box [low, high] can score above
sum(max(q_i low_i, q_i high_i)). A query walks a tree best first: the open node
of the largest bound is next, and the walk ends when that bound is below the kth
score found so far. The queries of a block take their steps together, so those
at the same leaf are one matrix product. The kth score is propagated: a query
searches the shards of its best cell first; what it found there goes with it to
the shards of the other cells, and cells whose box cannot reach it are left out
before its vector is sent there. Boxes with a bound equal to the kth score
are searched, since ties go to smaller ids.

**Size.** A shard's tree is read by tasks that then stream the blocks of queries
that need it; a task holds one tree and one block. Where boxes cannot prune
(vectors without structure in many dimensions) every query meets every shard,
which is the work of the stated query set against all rows: (queries x rows /
SHARD_ROWS) vectors of 4 bytes a component are shuffled. Only the boxes of the
cells (CELLS at most) go to every task.

Products are computed in the narrowest floating type in which the largest
lengths of the vectors show that every partial sum is an exact integer; beyond
2^53 in Python integers. A score beyond a long counts as 2^63 - 1 or its negative. Vectors that are null or hold null or non-finite
components (also 64 x) take no part, nor do rows with a null id; zero and empty
vectors do. A shorter vector counts as filled up with zeros. Rows that share an
id are rows of their own: each is a candidate, each is a query if its id is, and
a query leaves out only its own row. An empty table gives no rows. Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import prepare, store

SCALE = 64
SAMPLE = 16384  # classes that the coarse tree is learned from
CELLS = 256
SHARD_ROWS = 32768
LEAF_ROWS = 256
BLOCK_ROWS = 512
EXACT = {np.dtype(np.float32): 2.0**24, np.dtype(np.float64): 2.0**53}
LEAST_LONG, MOST_LONG = 1 - 2**63, 2**63 - 1


# Trees.


def halves(vectors: np.ndarray, rows: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
    """Median split of the widest dimension: dimension, last value on the left, rows on either side."""
    inside = vectors[rows]
    widest = int((inside.max(0) - inside.min(0)).argmax())
    order = np.argsort(inside[:, widest], kind="stable")
    middle = len(rows) // 2
    return widest, float(inside[order[middle - 1], widest]), rows[order[:middle]], rows[order[middle:]]


@dataclass
class Tree:
    """Nodes in the order of a walk from the left: the left child follows its parent, `right` is 0 for leaves.

    The rows of a node are `start` to `end` of `vectors`, which lie leaf by leaf.
    """

    vectors: np.ndarray
    classes: np.ndarray
    ids: np.ndarray  # smallest id of each class
    right: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No score of each query in each box is above this."""
    asked = queries.astype(np.float64)
    plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
    top = plus @ high.T + minus @ low.T
    # Room for rounding of the sum, of integers beyond 2^53 too.
    size = plus @ np.abs(high).T + np.abs(minus) @ np.abs(low).T
    return np.maximum(top + size * 1e-13, LEAST_LONG)


def build(vectors: np.ndarray, classes: np.ndarray, ids: np.ndarray, leaf_rows: int) -> Tree:
    right, start, end, rows_of, order = [], [], [], [], []
    placed = 0
    open_: list[tuple[np.ndarray, int]] = [(np.arange(len(vectors)), -1)]
    while open_:
        rows, parent = open_.pop()
        if parent >= 0:
            right[parent] = len(right)
        node = len(right)
        right.append(0)
        start.append(placed)
        end.append(placed + len(rows))
        rows_of.append(rows)
        if len(rows) <= leaf_rows:
            order.append(rows)
            placed += len(rows)
            continue
        _, _, left, other = halves(vectors, rows)
        open_ += [(other, node), (left, -1)]
    box = [(vectors[rows].min(0), vectors[rows].max(0)) for rows in rows_of]
    whole = np.concatenate(order)
    return Tree(
        vectors[whole], classes[whole], ids[whole], np.array(right), np.array(start), np.array(end),
        np.array([low for low, _ in box], dtype=np.float64), np.array([high for _, high in box], dtype=np.float64),
    )


@dataclass
class Cells:
    """The coarse tree: splits by (dimension, value), children by number; a negative child is cell -child - 1."""

    dimension: list[int]
    value: list[float]
    children: list[tuple[int, int]]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(vectors), dtype=np.int64)
        if not self.dimension:
            return cell
        open_ = [(0, np.arange(len(vectors)))]
        while open_:
            node, rows = open_.pop()
            left = vectors[rows, self.dimension[node]] <= self.value[node]
            for child, mine in zip(self.children[node], (rows[left], rows[~left]), strict=True):
                if child < 0:
                    cell[mine] = -child - 1
                else:
                    open_.append((child, mine))
        return cell


def learn_cells(sample: np.ndarray, cells: int) -> Cells:
    made = Cells([], [], [])
    count = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal count
        if wanted > 1 and len(rows) > 1:
            dimension, value, left, right = halves(sample, rows)
            if sample[right, dimension].max() > value:
                node = len(made.dimension)
                made.dimension.append(dimension)
                made.value.append(value)
                made.children.append((0, 0))
                made.children[node] = (grow(left, wanted // 2), grow(right, wanted - wanted // 2))
                return node
        count += 1
        return -count

    grow(np.arange(len(sample)), cells)
    return made


# Search of one shard.


def exact_type(queries: np.ndarray, vectors: np.ndarray) -> np.dtype:
    """The narrowest type in which all sums of products are exact integers."""
    lengths = [np.sqrt((a.astype(np.float64) ** 2).sum(1).max(initial=0)) for a in (queries, vectors)]
    for kind, most in EXACT.items():
        if lengths[0] * lengths[1] * 1.001 < most and max(lengths) < most:
            return kind
    return np.dtype(object)


def as_type(vectors: np.ndarray, kind: np.dtype) -> np.ndarray:
    if kind == object:
        return np.array([[int(v) for v in row] for row in vectors], dtype=object).reshape(vectors.shape)
    return vectors.astype(kind)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact scores as longs; beyond, the outermost long."""
    scores = queries @ rows.T
    if scores.dtype == object:
        scores = np.minimum(np.maximum(scores, LEAST_LONG), MOST_LONG)
    return scores.astype(np.int64)


def search(tree: Tree, queries: np.ndarray, least: list[int | None], most: int) -> list[list[tuple[int, int, int]]]:
    """The best (-score, smallest id, class) of a shard for each query, `most` of them, none below `least`.

    Best-first walks of all queries, a step of each at a time.
    """
    kind = exact_type(queries, tree.vectors)
    asked, rows = as_type(queries, kind), as_type(tree.vectors, kind)
    bounds = box_bounds(queries, tree.low, tree.high)
    found: list[list[tuple[int, int, int]]] = [[] for _ in queries]
    limits = np.array([LEAST_LONG if v is None else v for v in least], dtype=np.int64)
    open_ = [[(-bounds[q, 0], 0)] for q in range(len(queries))]
    walking = list(range(len(queries)))
    while walking:
        at_leaf: dict[int, list[int]] = {}
        for q in walking:
            heap, limit, bound = open_[q], int(limits[q]), bounds[q]
            while heap:
                top, node = heapq.heappop(heap)
                if -top < limit:
                    heap.clear()
                elif tree.right[node]:
                    for child in (node + 1, int(tree.right[node])):
                        heapq.heappush(heap, (-bound[child], child))
                else:
                    at_leaf.setdefault(node, []).append(q)
                    break
        for leaf, mine in at_leaf.items():
            span = slice(tree.start[leaf], tree.end[leaf])
            scores = products(asked[mine], rows[span])
            at, place = np.nonzero(scores >= limits[mine][:, None])
            near = list(zip((-scores[at, place]).tolist(), tree.ids[span][place].tolist(), tree.classes[span][place].tolist(), strict=True))
            ends = np.searchsorted(at, np.arange(len(mine) + 1)).tolist()
            for i, q in enumerate(mine):
                if ends[i] == ends[i + 1]:
                    continue
                best = sorted(found[q] + near[ends[i] : ends[i + 1]])[:most]
                found[q] = best
                if len(best) == most:
                    limits[q] = max(limits[q], -best[-1][0])
        walking = [q for mine in at_leaf.values() for q in mine]
    return found


# Spark.


def taking_part(table: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    """id, integer vector x (as doubles), asked and a number for each row that takes part."""
    scaled = F.transform(F.col(vector_column).cast("array<double>"), lambda c: c * SCALE)
    rows = table.select(
        F.col(id_column).cast("bigint").alias("id"), scaled.alias("s"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    kept = rows.where(F.col("id").isNotNull() & F.col("s").isNotNull()).where(
        F.forall("s", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    )
    # Doubles from 2^53 on are integers.
    whole = F.transform("s", lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c).cast("double")).otherwise(c))
    return kept.select("id", whole.alias("x"), "asked", F.monotonically_increasing_id().alias("row"))


def matrix(x: pa.Array, width: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)


def packed_floats(vectors: np.ndarray) -> bytes:
    """Four bytes a component where that is exact."""
    with np.errstate(over="ignore"):
        narrow = vectors.astype(np.float32)
    return (b"4" + narrow.tobytes()) if (narrow == vectors).all() else (b"8" + vectors.astype(np.float64).tobytes())


def unpacked_floats(data: bytes, shape: tuple[int, int]) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float32 if data[:1] == b"4" else np.float64, offset=1).reshape(shape)


def pack_tree(tree: Tree) -> list[bytes]:
    longs = [tree.classes, tree.ids, tree.right, tree.start, tree.end]
    return [packed_floats(tree.vectors), *[p.astype(np.int64).tobytes() for p in longs], tree.low.tobytes(), tree.high.tobytes()]


def unpack_tree(parts: list[bytes], width: int) -> Tree:
    longs = [np.frombuffer(p, dtype=np.int64) for p in parts[1:6]]
    boxes = [np.frombuffer(p, dtype=np.float64).reshape(len(longs[2]), width) for p in parts[6:8]]
    return Tree(unpacked_floats(parts[0], (len(longs[0]), width)), *longs, *boxes)


RESULT = "query_id bigint, rank int, id bigint, score bigint"
TREES = "cell bigint, shard bigint, low array<double>, high array<double>, tree array<binary>"
FOUND = "query bigint, class bigint, first_id bigint, score bigint"


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """class, x and members (id, row) of the distinct vectors: the `most` members with the smallest ids.

    Ranking within a class is cut off before rows are shuffled, so a class of
    any size costs a few rows for each task.
    """
    order = Window.partitionBy("x").orderBy("id", "row")
    ranked = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    classes = ranked.groupBy("x").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("members"))
    return classes.select(F.monotonically_increasing_id().alias("class"), F.col("members")[0]["id"].alias("first_id"), "x", "members")


def make_trees(classes: DataFrame, width: int, n: int) -> DataFrame:
    """The trees of all shards, by cell and shard, with the boxes of their roots."""
    sample = classes.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).toArrow().column("x").combine_chunks()
    cells = learn_cells(matrix(sample, width), max(1, min(CELLS, n // SHARD_ROWS)))

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells.of(matrix(batch.column("x"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    def make(part: pa.Table) -> pa.Table:
        part = part.sort_by("class")  # a task that runs again makes the same tree
        vectors = matrix(part.column("x").combine_chunks(), width)
        tree = build(vectors, part.column("class").to_numpy(), part.column("first_id").to_numpy(), LEAF_ROWS)
        box = [pa.array([b[0].tolist()], pa.list_(pa.float64())) for b in (tree.low, tree.high)]
        made = [part.column("cell").slice(0, 1), part.column("shard").slice(0, 1), *box, pa.array([pack_tree(tree)], pa.list_(pa.binary()))]
        return pa.table(made, names=["cell", "shard", "low", "high", "tree"])

    placed = classes.select("class", "first_id", "x").mapInArrow(in_cells, "class bigint, first_id bigint, x array<double>, cell bigint")
    placed = store(placed, "search_cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("bigint").alias("shards")).collect()  # CELLS rows at most
    shards = F.create_map(*[F.lit(v) for row in sizes for v in row])[F.col("cell")]
    dealt = placed.withColumn("shard", F.pmod(F.xxhash64("class"), shards))
    return store(dealt.groupBy("cell", "shard").applyInArrow(make, TREES), "search_trees")


def cell_boxes(trees: DataFrame, width: int) -> tuple[list[int], dict[int, int], np.ndarray, np.ndarray]:
    """Cells, shards of each, and their boxes: CELLS x dimensions numbers at most."""
    shards = {r["cell"]: r["n"] for r in trees.groupBy("cell").agg((F.max("shard") + 1).alias("n")).collect()}
    numbers = sorted(shards)
    low, high = np.zeros((len(numbers), width)), np.zeros((len(numbers), width))
    sides = trees.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("d", "side"))
    for cell, d, least, most in sides.groupBy("cell", "d").agg(F.min("side.low"), F.max("side.high")).collect():
        low[numbers.index(cell), d], high[numbers.index(cell), d] = least, most
    return numbers, shards, low, high


def top_k(table: DataFrame, is_query: Column, k: int, id_column: str, vector_column: str) -> DataFrame:
    """query_id, rank, id and score of the k rows with the largest integer inner product for each query row."""
    spark, most = prepare(table.sparkSession), k + 1
    rows = store(taking_part(table, is_query, id_column, vector_column), "search_rows")
    shortest, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != width:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("x"))))
    classes = store(distinct_vectors(rows, most), "search_classes")
    asked = store(rows.where("asked").join(classes.select("class", "x"), "x").select("id", "row", "class"), "search_asked")
    queries = classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "x")
    queries = store(queries, "search_queries")
    if not queries.head(1):
        return spark.createDataFrame([], RESULT)
    trees = make_trees(classes, width, classes.count())
    numbers, shards, lows, highs = cell_boxes(trees, width)
    shards_of = F.create_map(*[F.lit(v) for pair in shards.items() for v in pair])[F.col("cell")]
    # Where shards are few, the queries of each are split over several tasks.
    tasks = 4 * max(spark.sparkContext.defaultParallelism, 1)
    parts = -(-tasks // sum(shards.values()))

    def reachable(batches: Iterator[pa.RecordBatch], home_only: bool) -> Iterator[pa.RecordBatch]:
        """The best cell of each query, or the other cells that can reach its kth score."""
        for batch in batches:
            top = box_bounds(matrix(batch.column("x"), width), lows, highs)
            home = top.argmax(1)
            if home_only:
                q, cell = np.arange(len(top)), home
            else:
                least = [LEAST_LONG if v is None else v for v in batch.column("least").to_pylist()]
                wanted = top >= np.array(least, dtype=np.float64)[:, None] * (1 - 1e-15 * np.sign(np.array(least, dtype=np.float64)))[:, None]
                wanted[np.arange(len(top)), home] = False
                q, cell = np.nonzero(wanted)
            taken = batch.take(pa.array(q, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.array(numbers, dtype=np.int64)[cell])], names=[*batch.schema.names, "cell"])

    def searched(asking: DataFrame, home_only: bool) -> DataFrame:
        """Best classes for each query (class, x, least) in all shards of the cells it can reach."""
        keys = ["cell", "shard", "part"]
        reached = asking.mapInArrow(lambda b: reachable(b, home_only), "class bigint, x array<double>, least bigint, cell bigint")
        each_shard = F.explode(F.sequence(F.lit(0).cast("bigint"), shards_of - 1)).alias("shard")
        sent = reached.select("*", each_shard).withColumn("part", F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int"))
        each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        both = sent.unionByName(trees.select("cell", "shard", "tree", each_part, F.lit(-1).cast("bigint").alias("class")), allowMissingColumns=True)
        # A tree comes first, then the queries that are sent to it.
        lined = both.repartition(sum(shards.values()) * parts, *keys).sortWithinPartitions(*keys, "class")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, block = None, []

            def flush() -> Iterator[pa.RecordBatch]:
                if block:
                    found = search(tree, np.stack([x for _, x, _ in block]), [least for _, _, least in block], most)
                    rows_ = [(who, c, i, -s) for (who, _, _), best in zip(block, found, strict=True) for s, i, c in best]
                    made = [pa.array([r[i] for r in rows_], pa.int64()) for i in range(4)]
                    block.clear()
                    yield pa.RecordBatch.from_arrays(made, names=["query", "class", "first_id", "score"])

            for batch in batches:
                tree_at, x_at, least_at = (batch.column(name) for name in ("tree", "x", "least"))
                for i, who in enumerate(batch.column("class").to_pylist()):
                    if who < 0:
                        yield from flush()
                        tree = unpack_tree(tree_at[i].as_py(), width)
                    else:
                        block.append((who, matrix(x_at.slice(i, 1), width)[0], least_at[i].as_py()))
                        if len(block) == BLOCK_ROWS:
                            yield from flush()
            yield from flush()

        return store(lined.mapInArrow(run, FOUND), "search_found")

    def ranked(df: DataFrame, of: str, ties: list[str], count: int) -> DataFrame:
        order = Window.partitionBy(of).orderBy(F.desc("score"), *ties)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    found = searched(queries.withColumn("least", F.lit(None).cast("bigint")), home_only=True)
    if len(numbers) > 1:
        kth = ranked(found, "query", ["first_id", "class"], most).where(F.col("rank") == most)
        kth = kth.select(F.col("query").alias("class"), F.col("score").alias("least"))
        found = found.unionByName(searched(queries.join(kth, "class", "left").select("class", "x", "least"), home_only=False))
    best = ranked(found, "query", ["first_id", "class"], most).select("query", "class", "score")
    members = best.join(classes.select("class", F.explode("members").alias("member")), "class")
    members = ranked(members.select("query", "score", "member.*"), "query", ["id", "row"], most).drop("rank")
    own = asked.select(F.col("id").alias("query_id"), F.col("row").alias("own"), F.col("class").alias("query"))
    # Query rows are told apart by number, as ids may repeat.
    each = members.join(own, "query").where("row <> own")
    return ranked(each, "own", ["id", "row"], k).select("query_id", "rank", "id", "score")
