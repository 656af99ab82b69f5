"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors get binary codes from rotations learned on a bounded sample: principal
axes turned so that the signs lose little (iterative quantisation), several
turns side by side. A code is cut into substrings and each substring indexed.
By the pigeonhole principle a code within Hamming radius r of a query agrees
with it up to floor(r / m) bits in one of the m substrings, so probing those
buckets retrieves every code within the radius; what is retrieved is reranked
by the exact inner product.

The radius is learned from the same sample: it holds the wanted share of the
sample's own nearest neighbours. Neighbours in the whole table are nearer than
those in a sample, so recall on the table is higher. A query that finds fewer
rows than it is due is searched again with twice the radius, until it has them
or the radius is the code's length, which every row is within. So a query gets
fewer than `k` rows only where there are fewer.

Equal vectors are one class, indexed once; of its rows the `k + 1` with the
smallest ids are enough for any query. Classes lie in cells around up to CELLS
pivot codes, taken from the sample, each class with the pivot nearest to its code.
A query is sent to a cell only if its code is no farther from the pivot than the
cell's outermost code and the radius together: by the triangle inequality no other
cell holds a code within the radius. Cells are dealt into shards and the queries
of a cell into blocks, both of bounded size; every shard returns its best `k + 1`
classes for a query. Where codes lie in clusters, vectors are thus sent to few
shards; where they do not, every block meets every shard, which is the work of the
stated query set against all rows.

Vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null id. A shorter vector counts as filled up with zeros. Rows
that share an id are rows of their own: each is a candidate, each is a query if its
id is, and a query leaves out only its own row. Ties go to smaller ids. An empty
table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import store
from settle.llm.exact_search import distinct_vectors, matrix, packed_floats, unpacked_floats

SAMPLE = 4096  # classes that rotations and radius are learned from
TURNS = 4  # codes of so many rotations side by side
SUBSTRING = 16  # bits of an indexed substring
WANTED = 0.98  # share of the sample's neighbours within the radius
CELLS = 256
SHARD_ROWS = 16384
BLOCK_ROWS = 512
PROBED_ROWS = 64  # queries of a block probed at a time
PRODUCTS = 1 << 21  # components multiplied at a time
ROUNDS = 30
POPCOUNT = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32)).astype(np.uint8)


@dataclass
class Codes:
    """Mean and rotations that turn vectors into substrings of bits, and the search radius."""

    mean: np.ndarray
    turns: np.ndarray
    radius: int = 0

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one row a vector."""
        bits = (vectors.astype(np.float64) - self.mean) @ self.turns > 0
        spare = -bits.shape[1] % SUBSTRING
        bits = np.pad(bits, ((0, 0), (0, spare)))
        return np.packbits(bits, axis=1).reshape(len(vectors), -1, SUBSTRING // 8).copy().view(">u2")[:, :, 0].astype(np.uint16)

    def substring_radius(self, substrings: int) -> list[int]:
        """Bits that may differ in each substring: one of them must hold for a code within the radius."""
        least, rest = divmod(self.radius, substrings)
        return [least if i <= rest else least - 1 for i in range(substrings)]


def learn(sample: np.ndarray, k: int, seed: int = 11) -> Codes:
    """Rotations by iterative quantisation and the radius that holds WANTED of the k nearest."""
    random, mean = np.random.default_rng(seed), sample.mean(0)
    centred = sample.astype(np.float64) - mean
    axes = np.linalg.svd(centred, full_matrices=True)[2].T if len(sample) > 1 else np.eye(sample.shape[1])
    rotated, turns = centred @ axes, []
    for _ in range(TURNS):
        turn = np.linalg.qr(random.normal(size=axes.shape))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.where(rotated @ turn > 0, 1.0, -1.0).T @ rotated)
            turn = (left @ right).T
        turns.append(axes @ turn)
    codes = Codes(mean, np.concatenate(turns, axis=1))
    substrings = codes.encode(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 512))
    near = sample[asked].astype(np.float64) @ sample.T.astype(np.float64)
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, max(len(sample) - 1, 0))]
    apart = POPCOUNT[substrings[asked][:, None, :] ^ substrings[best]].sum(2) if best.size else np.zeros(1, int)
    codes.radius = int(np.quantile(apart, WANTED, method="higher"))
    return codes


def apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits in which the codes of `one` (rows) and `other` (columns) differ."""
    return np.stack([np.bitwise_count(one ^ code).sum(1, dtype=np.int64) for code in other], axis=1)


def choose_pivots(codes: np.ndarray, wanted: int) -> np.ndarray:
    """Distinct codes, each the farthest from those chosen before it."""
    chosen, distance = [0], apart(codes, codes[:1])[:, 0]
    while len(chosen) < wanted and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, apart(codes, codes[chosen[-1:]])[:, 0])
    return codes[chosen]


def inner_products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sums of products row by row, added in the order of the components, in double precision."""
    total = np.zeros(len(one))
    for i in range(one.shape[1]):
        total += one[:, i].astype(np.float64) * other[:, i].astype(np.float64)
    return total


def retrieved(query_codes: np.ndarray, shard_codes: np.ndarray, codes: Codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) of the pairs within the radius: those in probed buckets, checked by the whole code."""
    radii, index = codes.substring_radius(query_codes.shape[1]), []
    for i in range(len(radii)):
        # The index of substring i: rows by value, and where the rows of each distinct value begin.
        order = np.argsort(shard_codes[:, i], kind="stable")
        index.append((order, *np.unique(shard_codes[order, i], return_index=True, return_counts=True)))
    for start in range(0, len(query_codes), PROBED_ROWS):
        part = query_codes[start : start + PROBED_ROWS]
        probed = np.zeros((len(part), len(shard_codes)), dtype=bool)
        for i, (radius, (order, buckets, begins, counts)) in enumerate(zip(radii, index, strict=True)):
            q, bucket = np.nonzero(POPCOUNT[part[:, i, None] ^ buckets[None, :]] <= radius)
            n = counts[bucket]
            place = np.arange(n.sum()) + np.repeat(begins[bucket] - (np.cumsum(n) - n), n)
            probed[np.repeat(q, n), order[place]] = True
        q, v = np.nonzero(probed)
        near = np.bitwise_count(part[q] ^ shard_codes[v]).sum(1, dtype=np.int64) <= codes.radius
        yield q[near] + start, v[near]


def search(asked: tuple, shard: tuple, codes: Codes, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query class, class, score) of the best `most` classes of a shard for each query of a block."""
    query_ids, queries = asked
    ids, vectors = shard
    at_once, parts = max(1, PRODUCTS // queries.shape[1]), []
    for q, v in retrieved(codes.encode(queries), codes.encode(vectors), codes):
        pieces = [slice(i, i + at_once) for i in range(0, len(q), at_once)]
        score = np.concatenate([np.zeros(0), *(inner_products(queries[q[p]], vectors[v[p]]) for p in pieces)])
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < most
        parts.append((query_ids[q[keep]], ids[v[keep]], score[keep]))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def usable(table: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    """id, vector x in double precision, `asked` and a number of the rows that take part."""
    # Adding zero makes both zeros one.
    vector = F.transform(F.col(vector_column).cast("array<double>"), lambda c: c + F.lit(0.0))
    rows = table.select(
        F.col(id_column).cast("bigint").alias("id"), vector.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    kept = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull()).where(
        F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0)
    )
    kept = store(kept.withColumn("row", F.monotonically_increasing_id()), "nearest_rows")
    shortest, width = kept.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != width:
        kept = kept.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("x"))))
    return kept


def packed(rows: DataFrame, keys: list[str], name: str, width: int) -> DataFrame:
    """The classes of each key in one row: numbers and smallest ids by smallest id, and vectors."""

    def pack(part: pa.Table) -> pa.Table:
        part = part.sort_by([("first_id", "ascending"), ("class", "ascending")])
        numbers = [pa.array([part.column(c).to_numpy().tobytes()], pa.binary()) for c in ("class", "first_id")]
        vectors = pa.array([packed_floats(matrix(part.column("x").combine_chunks(), width))], pa.binary())
        made = [part.column(key).slice(0, 1) for key in keys]
        return pa.table([*made, *numbers, vectors], names=[*keys, f"{name}_class", f"{name}_first", f"{name}_x"])

    fields = ", ".join([*(f"{key} bigint" for key in keys), *(f"{name}_{part} binary" for part in ("class", "first", "x"))])
    return rows.groupBy(*keys).applyInArrow(pack, fields)


RESULT = "query_id bigint, rank int, id bigint, score double"
FOUND = "query bigint, class bigint, first_id bigint, score double"
CLASS = "class bigint, first_id bigint, x array<double>"


def nearest(table: DataFrame, is_query: Column, k: int, id_column: str, vector_column: str) -> DataFrame:
    """query_id, rank, id and score of the k rows with the largest inner product found for each query row."""
    spark, most = table.sparkSession, k + 1
    rows = usable(table, is_query, id_column, vector_column)
    found = store(distinct_vectors(rows, most), "vector_classes")
    asked = rows.where("asked").join(found.select("class", "x"), "x").select("id", "row", "class")
    asked = store(asked, "query_classes")
    queries = store(found.join(asked.select("class").distinct(), "class", "left_semi").select("class", "first_id", "x"), "query_vectors")
    n_classes, n_members = found.agg(F.count("*"), F.sum(F.size("members"))).first()
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], RESULT)
    sample = found.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).toArrow().column("x").combine_chunks()
    width = len(sample[0])
    sample = matrix(sample, width)
    codes = learn(sample, k)
    pivots = choose_pivots(codes.encode(sample), max(1, min(CELLS, n_classes // SHARD_ROWS)))
    shared = spark.sparkContext.broadcast((codes, pivots))

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, pivots = shared.value
        for batch in batches:
            far = apart(codes.encode(matrix(batch.column("x"), width)), pivots)
            made = [pa.array(far.argmin(1)), pa.array(far.min(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "cell", "apart"])

    placed = found.select("class", "first_id", "x").mapInArrow(in_cells, f"{CLASS}, cell bigint, apart bigint")
    placed = store(placed, "nearest_cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("reach")).collect()  # CELLS rows at most
    reach = {row["cell"]: row["reach"] for row in cells}
    n_shards = {row["cell"]: -(-row["n"] // SHARD_ROWS) for row in cells}
    shards_of = F.create_map(*[F.lit(v).cast("bigint") for pair in n_shards.items() for v in pair])[F.col("cell")]
    # Where shards are few, the blocks of each are split over several tasks.
    parts = -(-4 * max(spark.sparkContext.defaultParallelism, 1) // sum(n_shards.values()))
    each_part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part")
    shards = placed.withColumn("shard", F.pmod(F.xxhash64("class"), shards_of))
    shards = store(packed(shards, ["cell", "shard"], "shard", width), "nearest_shards")

    def unpack(batch: pa.RecordBatch, name: str, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, first = (np.frombuffer(batch.column(f"{name}_{c}")[i].as_py(), dtype=np.int64) for c in ("class", "first"))
        return ids, first, unpacked_floats(batch.column(f"{name}_x")[i].as_py(), (len(ids), width))

    def searched(queries: DataFrame, n: int, radius: int) -> DataFrame:
        """query, class and score of the best `most` classes within the radius, of every shard that can hold some."""

        def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, pivots = shared.value
            used = np.array(sorted(reach))
            most_apart = np.array([reach[cell] for cell in used.tolist()]) + radius
            for batch in batches:
                far = apart(codes.encode(matrix(batch.column("x"), width)), pivots[used])
                q, cell = np.nonzero(far <= most_apart)
                taken = batch.take(pa.array(q, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(used[cell], pa.int64())], names=[*batch.schema.names, "cell"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            within = replace(shared.value[0], radius=radius)
            for batch in batches:
                for i in range(batch.num_rows):
                    classes, first, vectors = unpack(batch, "shard", i)
                    query_classes, _, asking = unpack(batch, "block", i)
                    query, place, score = search((query_classes, asking), (np.arange(len(classes)), vectors), within, most)
                    made = [query, classes[place], first[place], score]
                    yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=["query", "class", "first_id", "score"])

        reached = queries.mapInArrow(reachable, f"{CLASS}, cell bigint")
        block = F.pmod(F.xxhash64("class"), F.lit(-(-n // BLOCK_ROWS)).cast("bigint"))
        blocks = packed(reached.withColumn("block", block), ["cell", "block"], "block", width)
        each_shard = F.explode(F.sequence(F.lit(0).cast("bigint"), shards_of - 1)).alias("shard")
        blocks = blocks.select("*", each_shard, F.pmod("block", F.lit(parts).cast("bigint")).alias("part"))
        keys, tasks = ["cell", "shard", "part"], sum(n_shards.values()) * parts
        grid = blocks.repartition(tasks, *keys).join(shards.select("*", each_part).repartition(tasks, *keys), keys)
        batch_rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row holds a shard and a block
        try:
            return store(grid.mapInArrow(run, FOUND), "nearest_parts")
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)

    def first(df: DataFrame, of: str, ties: list[str], n: int) -> DataFrame:
        order = Window.partitionBy(of).orderBy(F.desc("score"), *ties)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    def members_of(parts: DataFrame) -> DataFrame:
        best = first(parts, "query", ["first_id", "class"], most).select("query", "class", "score")
        members = best.join(found.select("class", F.explode("members").alias("member")), "class")
        return first(members.select("query", "score", "member.*"), "query", ["id", "row"], most).select(
            F.col("query").alias("class"), "id", "row", "score"
        )

    # A query's own row is among its members, unless `most` others are.
    due, radius, rounds = min(most, n_members), codes.radius, []
    while n_queries:
        members = store(members_of(searched(queries, n_queries, radius)), "nearest_members")
        if radius >= codes.turns.shape[1]:
            rounds.append(members)
            break
        full = members.groupBy("class").count().where(F.col("count") >= due).select("class")
        rounds.append(members.join(full, "class", "left_semi"))
        queries = store(queries.join(full, "class", "left_anti"), "query_vectors")
        n_queries, radius = queries.count(), min(max(2 * radius, SUBSTRING), codes.turns.shape[1])
    # Query rows are told apart by number, as ids may repeat.
    own = asked.select(F.col("id").alias("query_id"), F.col("row").alias("own"), "class")
    each = own.join(reduce(DataFrame.unionByName, rounds), "class").where("row <> own")
    return first(each, "own", ["id", "row"], k).select("query_id", "rank", "id", "score")
