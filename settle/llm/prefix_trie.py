"""Trie of shared conversation prefixes from adaptive radix trees.

A turn's id is the first 16 bytes of the SHA-256 of its role and text, so a
conversation is a byte key: its turns' ids, big-endian, one after the other. The
texts themselves are read once and never shuffled. Conversations are sorted by
key and number over ranges of bounded size, so that copies of a conversation,
however many, are spread over as many tasks as they need.

Each task puts its range into an adaptive radix tree. Folding the tree gives a
node at every byte depth that ends a turn; depths inside an id give none. All
that lies below such a node lies next to each other in the sorted order, so a
node is complete in its task unless it is on the path to the first or the last
key of the range: those two paths are handed on with what is complete below
them. One more tree, of two paths for each task, joins these. What its one task
reads is two keys a range, so it follows the number of tasks and not the rows.

The hash over the conversations that end at a node is taken in the task that has
them in order. Where they may go on in the next task (first and last key), or
are very many, they leave as pieces of bounded size, which are hashed in order.

A conversation's ids are one row (16 bytes a turn, gathered by conversation after
the texts are hashed), so a conversation of some ten million turns is the most
that fits. Rows with a null conversation take no part; null role or text is
empty. Turns that share a number are ordered by the hash of role and text, so
repeated rows are turns of their own, side by side. An empty table has no node,
not even the root. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.llm.common import prepare, store
from settle.llm.radix_tree import Node, Tree, common_length
from settle.session import bounded

TURN = 16  # bytes of a turn's id
TASK_TURNS = 200_000  # turns of a range
PIECE_IDS = 50_000  # numbers of a piece
HEAD_TURNS = 3  # the most that is taken over from another conversation
NO_ENDS = hashlib.sha256(b"").hexdigest()


# Conversations as keys.


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, hash of role and text (hex) and words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * TURN).alias("id"), words.cast("bigint").alias("words"),
    )


def originals(conversations: DataFrame) -> DataFrame:
    """conv_id with its turns (id, words) in order."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    return turn_rows(conversations).groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def rebuilt(original: DataFrame, source: Column, taken: Column) -> DataFrame:
    """Every conversation with its first `taken` turns replaced by those of conversation `source`."""
    sources = original.select(source.alias("from")).distinct()
    heads = original.withColumnRenamed("conv_id", "from").join(sources, "from", "left_semi")
    heads = heads.select("from", F.slice("turns", 1, HEAD_TURNS).alias("head"))
    both = original.select("conv_id", source.alias("from"), taken.cast("int").alias("taken"), "turns").join(heads, "from", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def keys(sequences: DataFrame) -> DataFrame:
    """key, conv_id and the words of each turn."""
    return sequences.select(
        F.unhex(F.array_join("turns.id", "")).alias("key"), "conv_id", F.col("turns.words").alias("words")
    )


# Trees.


class Ends(NamedTuple):
    """Conversations that end at a node: how many, the smallest, and their hash, or the key of the pieces that make it."""

    n: int
    least: int
    digest: str | None
    key: bytes | None
    words: list[int]


class Below(NamedTuple):
    """What lies below a place of the tree: sums, and the rows of the topmost nodes there."""

    n: int
    least: int
    leaves: int
    saved: int
    tops: list[int]
    words: list[int]


class Rows:
    """Rows of finished nodes, by column."""

    NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")

    def __init__(self) -> None:
        self.columns: dict[str, list] = {name: [] for name in (*self.NAMES, "ends_sha256", "ends_key", "side", "edge_depth")}

    def add(self, conv_id: int, depth: int, n: int, children: int, leaves: int, saved: int, ends: str | None, key: bytes | None) -> int:
        values = (conv_id, depth, None, n, children, leaves, saved, ends, key, None, None)
        for column, value in zip(self.columns.values(), values, strict=True):
            column.append(value)
        return len(self.columns["depth"]) - 1

    def set(self, name: str, rows: list[int], value: object) -> None:
        column = self.columns[name]
        for row in rows:
            column[row] = value


class Path:
    """The way to the first or last key of a range: for each depth from `start`, what is complete there or below."""

    FIELDS = ("n", "least", "children", "leaves", "saved", "words", "ends", "pieces")

    def __init__(self, key: bytes, words: list[int], start: int):
        self.key, self.start = key, start
        depths = len(key) // TURN + 1 - start
        self.n, self.children, self.leaves, self.saved = ([0] * depths for _ in range(4))
        self.least: list[int | None] = [None] * depths
        self.words = [0, *words][start:]
        self.ends: list[str | None] = [None] * depths
        self.pieces = [False] * depths

    def add(self, depth: int, n: int, least: int) -> int:
        at = depth - self.start
        self.n[at] += n
        self.least[at] = least if self.least[at] is None else min(self.least[at], least)
        return at

    def as_row(self) -> dict:
        return {"key": self.key, "start": self.start} | {name: getattr(self, name) for name in self.FIELDS}


PATH = (
    "struct<key: binary, start: bigint, n: array<bigint>, least: array<bigint>, children: array<bigint>, leaves: array<bigint>, "
    "saved: array<bigint>, words: array<bigint>, ends: array<string>, pieces: array<boolean>>"
)
LONGS = pa.list_(pa.int64())
PATH_TYPE = pa.struct([
    ("key", pa.binary()), ("start", pa.int64()), ("n", LONGS), ("least", LONGS), ("children", LONGS), ("leaves", LONGS),
    ("saved", LONGS), ("words", LONGS), ("ends", pa.list_(pa.string())), ("pieces", pa.list_(pa.bool_())),
])


def depths_of(start: int, end: int) -> range:
    """Turn depths among the byte depths above `start` up to `end`, the deepest first."""
    return range(end // TURN, start // TURN, -1)


def fold_range(tree: Tree, first: bytes, last: bytes, rows: Rows) -> list[Path]:
    """Rows of the nodes that are complete, and the paths to the first and last key.

    `tree` holds Ends at every key. A node under a path names it by side (0: first
    key, 1: last key) and depth, as its parent's number is not final.
    """
    on_path = {id(node): 1 for node in tree.path(last)} | {id(node): 0 for node in tree.path(first)}
    shared = common_length(first, last) // TURN
    word_lists = [node.value.words for node in (tree.insert(first), tree.insert(last))]
    paths = [Path(first, word_lists[0], 0), Path(last, word_lists[1], shared + 1)]

    def visit(node: Node, start: int, end: int, results: list[Below | None]) -> Below | None:
        below = [r for r in results if r is not None]
        ends: Ends | None = node.value
        n = sum(r.n for r in below) + (ends.n if ends else 0)
        tops = [top for r in below for top in r.tops]
        leaves, saved = sum(r.leaves for r in below), sum(r.saved for r in below)
        least = min([r.least for r in below] + ([ends.least] if ends else []), default=None)
        if id(node) in on_path:
            if not n:
                return None
            depth = end // TURN
            side = on_path[id(node)] if depth > shared else 0
            path = paths[side]
            at = path.add(depth, n, least)
            path.children[at] += len(tops)
            path.leaves[at] += leaves
            path.saved[at] += saved
            if ends:
                path.ends[at], path.pieces[at] = ends.digest, ends.digest is None
            rows.set("side", tops, side)
            rows.set("edge_depth", tops, depth)
            return None
        words = ends.words if ends else below[0].words
        for depth in depths_of(start, end):
            children, leaves = len(tops), leaves or 1
            saved += (n - 1) * words[depth - 1]
            digest, key = (ends.digest, ends.key) if ends else (NO_ENDS, None)
            row = rows.add(least, depth, n, children, leaves, saved, digest, key)
            rows.set("parent_conv_id", tops, least)
            tops, ends = [row], None
        return Below(n, least, leaves, saved, tops, words)

    tree.fold(visit)
    return paths if len(last) // TURN > shared else paths[:1]


TASK_OUT = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, ends_key binary, side int, edge_depth bigint, task int, piece_from bigint, piece string, path " + PATH
)
NODE, EDGE, PIECE = 0, 1, 2
TYPES = {
    "kind": pa.int32(), **dict.fromkeys(Rows.NAMES, pa.int64()), "ends_sha256": pa.string(), "ends_key": pa.binary(), "side": pa.int32(),
    "edge_depth": pa.int64(), "task": pa.int32(), "piece_from": pa.int64(), "piece": pa.string(), "path": PATH_TYPE,
}


def output(n: int, **columns: list) -> pa.RecordBatch:
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(TYPES))


def nodes_out(rows: Rows, task: int) -> pa.RecordBatch:
    n = len(rows.columns["depth"])
    return output(n, kind=[NODE] * n, task=[task] * n, **rows.columns)


def grow_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree of a range of sorted (key, conv_id, words): its nodes, paths and pieces."""
    task = TaskContext.get().partitionId()
    tree, first, key = Tree(), None, None
    n, least, words, waiting, sent = 0, 0, [], [], False

    def piece() -> pa.RecordBatch:
        made = output(1, kind=[PIECE], ends_key=[key], piece_from=[waiting[0]], piece=[",".join(map(str, waiting))])
        waiting.clear()
        return made

    def finish(edge: bool) -> Iterator[pa.RecordBatch]:
        """Put the conversations of `key` into the tree."""
        nonlocal sent
        if edge or sent:
            if waiting:
                yield piece()
            sent = True
        digest = None if sent else hashlib.sha256(",".join(map(str, waiting)).encode()).hexdigest()
        tree.insert(key).value = Ends(n, least, digest, key if sent else None, words)

    for batch in batches:
        word_lists = batch.column("words")
        for i, (one, number) in enumerate(zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)):
            if one != key:
                if key is not None:
                    yield from finish(key == first)
                first = one if first is None else first
                key, n, least, words, sent = one, 0, number, word_lists[i].as_py(), False
                waiting.clear()
            n += 1
            waiting.append(number)
            if len(waiting) == PIECE_IDS:
                yield piece()
                sent = True
    if key is None:
        return
    yield from finish(True)
    rows = Rows()
    paths = fold_range(tree, first, key, rows)
    yield output(len(paths), kind=[EDGE] * len(paths), task=[task] * len(paths), side=list(range(len(paths))), path=[p.as_row() for p in paths])
    yield nodes_out(rows, task)


class Joined(NamedTuple):
    n: int
    least: int | None
    leaves: int
    saved: int
    tops: list[int]
    paths: list


def join_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree of all paths: its nodes, and the final number of every (task, side, depth)."""
    tree = Tree()
    for batch in batches:
        for task, side, path in zip(*(batch.column(name).to_pylist() for name in ("task", "side", "path")), strict=True):
            node = tree.insert(path["key"])
            node.value = [*(node.value or []), (task, side, path)]
    if tree.root is None:
        return
    rows, final = Rows(), {"task": [], "side": [], "edge_depth": [], "conv_id": []}

    def visit(node: Node, start: int, end: int, results: list[Joined]) -> Joined:
        paths = [p for r in results for p in r.paths] + (node.value or [])
        n, leaves, saved = (sum(r[i] for r in results) for i in (0, 2, 3))
        least = min((r.least for r in results if r.least is not None), default=None)
        tops = [top for r in results for top in r.tops]
        for depth in depths_of(start, end):
            here = [(t, s, p, depth - p["start"]) for t, s, p in paths if p["start"] <= depth]
            n += sum(p["n"][at] for *_, p, at in here)
            least = min([p["least"][at] for *_, p, at in here if p["n"][at]] + ([] if least is None else [least]))
            children = len(tops) + sum(p["children"][at] for *_, p, at in here)
            leaves = (leaves + sum(p["leaves"][at] for *_, p, at in here)) if children else 1
            saved += sum(p["saved"][at] for *_, p, at in here) + (n - 1) * here[0][2]["words"][here[0][3]]
            by_pieces = any(p["pieces"][at] for *_, p, at in here)
            digest = next((p["ends"][at] for *_, p, at in here if p["ends"][at]), NO_ENDS)
            key = here[0][2]["key"][: depth * TURN]
            row = rows.add(least, depth, n, children, leaves, saved, None if by_pieces else digest, key if by_pieces else None)
            rows.set("parent_conv_id", tops, least)
            tops = [row]
            for task, side, _, _ in here:
                for name, value in zip(final, (task, side, depth, least), strict=True):
                    final[name].append(value)
        return Joined(n, least, leaves, saved, tops, paths)

    tree.fold(visit)
    yield nodes_out(rows, -1)
    yield output(len(final["task"]), kind=[EDGE] * len(final["task"]), **final)


def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the pieces of each key, which come in order."""
    key, digest = None, None

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["ends_key", "ends_sha256"])

    for batch in batches:
        for one, piece in zip(batch.column("ends_key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if one != key:
                if key is not None:
                    yield made()
                key, digest = one, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if key is not None:
        yield made()


COLUMNS = [*Rows.NAMES, "ends_sha256"]


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations (conv_id, turns): COLUMNS."""
    spark = prepare(sequences.sparkSession)
    keyed = store(keys(sequences), "trie_keys")
    turns = (keyed.agg(F.sum(F.octet_length("key"))).first()[0] or 0) // TURN
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // TASK_TURNS + 1)
    lined = keyed.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = store(lined.mapInArrow(grow_trees, TASK_OUT), "trie_ranges")
    paths = made.where(F.col("kind") == EDGE).select("task", "side", "path").coalesce(1)
    joined = store(paths.mapInArrow(join_paths, TASK_OUT), "trie_paths")

    nodes = made.where(F.col("kind") == NODE)
    final = joined.where(F.col("kind") == EDGE).select("task", "side", "edge_depth", F.col("conv_id").alias("parent"))
    under_path = F.col("edge_depth").isNotNull()
    named = nodes.where(under_path).drop("parent_conv_id").join(bounded(final, within=final), ["task", "side", "edge_depth"])
    every = nodes.where(~under_path).unionByName(joined.where(F.col("kind") == NODE)).unionByName(
        named.withColumnRenamed("parent", "parent_conv_id"), allowMissingColumns=True
    ).select(*COLUMNS, "ends_key")

    pieces = made.where(F.col("kind") == PIECE).select("ends_key", "piece_from", "piece")
    pieces = pieces.repartition("ends_key").sortWithinPartitions("ends_key", "piece_from")
    digests = pieces.mapInArrow(hash_pieces, "ends_key binary, ends_sha256 string")
    hashed = every.where(F.col("ends_key").isNotNull()).drop("ends_sha256").join(digests, "ends_key")
    return every.where(F.col("ends_key").isNull()).select(*COLUMNS).unionByName(hashed.select(*COLUMNS))


def borrowed_heads(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: c begins with the first crc32(c) % 4 turns of conversation c - c % 20 in place of its own."""
    original = store(originals(conversations), "trie_conversations")
    number = F.col("conv_id")
    return rebuilt(original, number - number % 20, F.crc32(number.cast("string").cast("binary")) % 4)
