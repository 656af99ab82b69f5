"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of bounded size and sorts the word
suffixes of a shard into a suffix array, once, as deep as the longest test item
goes. Every suffix of every test item is binary-searched there. The range that
begins with a window of the item gives all places where the window occurs.
Where a suffix would be inserted tells which places it is nearest to: a place's
longest verbatim match with any item is with the test suffix just before or just
after it, so comparing with these two gives the longest run of words that a
document shares with one item, where it begins and in which item, of any length.

The test items are packed into blocks of bounded size in tasks and stored in
the shared folder; a shard is searched by one block after the other. The driver
sees the names of the blocks only. The documents are read once, never shuffled,
and results are a row for each document.

Null or empty texts have no words. Items without words have no windows; an item of
fewer words than a window is one window. Items repeated under one id count once;
items without an id mark words but are not listed. Repeated documents stay rows.
Of several longest matches the first in the document counts, and of items that
hold it the smallest id as text. A very long text is a shard of its own. Without
documents there are no rows; without items every document is clean. Result columns
begin with `_match_`; a document column of such a name fails.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.llm.common import store
from settle.llm.warc import open_store
from settle.session import fresh_path

WINDOW = 13
SHARD_BYTES = 6_000_000
BLOCK_BYTES = 2_000_000
KEPT_BYTES = 64_000_000  # blocks of up to so many bytes of text stay in a task, more are read again for each shard
PART = 20  # a document is contaminated if at least one in so many words is hit

# Bytes that belong to words: digits, lower-case letters, all of other scripts.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of the lower-cased texts, and how many each text has."""
    data = np.frombuffer(b"\x00".join(texts).translate(LOWER) + b"\x00", dtype=np.uint8)
    inside = WORD_BYTE[data]
    step = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    array = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())]
    )
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0) if texts else np.zeros(0, int)
    return array, counts


@dataclass
class Block:
    """Some test items: ids as text, vocabulary, and the words of all items one after the other.

    `tokens` are places in the vocabulary from 1; an item is followed by -1.
    """

    items: list[str | None]
    vocabulary: pa.BinaryArray
    tokens: np.ndarray
    item: np.ndarray  # item of each token
    starts: np.ndarray  # where windows begin
    lengths: np.ndarray  # and how many words they have
    longest: int  # words of the longest item


def make_block(rows: list[tuple[str | None, bytes]]) -> Block:
    found, counts = words([text for _, text in rows])
    encoded = found.dictionary_encode()
    numbers = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    item = np.repeat(np.arange(len(rows)), counts)
    at = np.arange(len(numbers)) + item
    tokens = np.full(len(numbers) + len(rows), -1, dtype=np.int64)
    tokens[at] = numbers
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(numbers))  # words to the item's end
    whole = (left >= WINDOW) | (left == np.repeat(counts, counts))
    owner = np.full(len(tokens), -1, dtype=np.int64)
    owner[at] = item
    return Block(
        [i for i, _ in rows], encoded.dictionary, tokens, owner, at[whole], np.minimum(left, WINDOW)[whole], int(counts.max(initial=0))
    )


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Places of words, sorted by the words that begin there, `depth` of them at least.

    Numbers below 1 (ends of texts) are no places and sort before all words.
    Doubling: the order by 2k words follows from the order by k words; places
    that are told apart already are left where they are.
    """
    places = np.flatnonzero(numbers > 0)
    rank = np.zeros(len(numbers) + 2 * depth + 2, dtype=np.int64)
    rank[: len(numbers)] = np.maximum(numbers, 0)
    slots, reach = np.arange(len(places)), 1
    array = places[np.argsort(rank[places], kind="stable")]
    begin = np.zeros(len(places), dtype=np.int64)  # first slot of the group that a slot belongs to
    first = rank[array]
    begin[1:] = np.maximum.accumulate(np.where(first[1:] != first[:-1], slots[1:], 0))
    while True:
        rank[array] = begin + 1
        tied = np.zeros(len(array) + 1, dtype=bool)
        tied[1:-1] = begin[1:] == begin[:-1]
        open_ = np.flatnonzero(tied[1:] | tied[:-1])
        if reach >= depth or not open_.size:
            return array
        own = array[open_]
        key = rank[own] << 32 | rank[own + reach]
        order = np.argsort(key, kind="stable")
        array[open_], key = own[order], key[order]
        apart = np.concatenate([[True], key[1:] != key[:-1]])
        begin[open_] = np.maximum.accumulate(np.where(apart, open_, 0))
        reach *= 2


def shared_words(one: np.ndarray, at: np.ndarray, other: np.ndarray, place: np.ndarray, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal words from one[at] and other[place] on, and the sign of the first difference; 0 after `most` words.

    The two end with numbers that do not occur in the other.
    """
    length, sign = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    open_, k = np.arange(len(at)), 0
    while open_.size:
        if most is not None:
            open_ = open_[most[open_] > k]
        difference = one[at[open_] + k] - other[place[open_] + k]
        ends = difference != 0
        sign[open_[ends]] = np.sign(difference[ends])
        length[open_] = k
        open_ = open_[~ends]
        k += 1
        length[open_] = k
        if most is None and k >= 16 and k & (k - 1) == 0 and open_.size:
            # A match inside a longer one on the same diagonal cannot be the longest.
            diagonal = at[open_] - place[open_]
            line = np.lexsort((at[open_], diagonal))
            inside = (np.diff(at[open_][line]) == 1) & (np.diff(diagonal[line]) == 0)
            open_ = np.delete(open_, line[1:][inside])
    return length, sign


def bisect(numbers: np.ndarray, array: np.ndarray, asked: np.ndarray, place: np.ndarray, most: np.ndarray | None, past_equal: bool) -> np.ndarray:
    """Slots of the suffix array before which the suffixes of `asked` belong; after equal ones if so told."""
    low, high = np.zeros(len(place), np.int64), np.full(len(place), len(array), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        limit = np.full(len(open_), len(asked)) if most is None else most[open_]
        sign = shared_words(numbers, array[middle], asked, place[open_], limit)[1]
        below = sign < 0 if not past_equal else sign <= 0
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


class Shard:
    """Words of some texts with their suffix array; each text is followed by 0."""

    def __init__(self, texts: list[bytes], depth: int):
        found, counts = words(texts)
        encoded = found.dictionary_encode()
        numbers = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        doc = np.repeat(np.arange(len(texts)), counts)
        self.counts, self.vocabulary = counts, encoded.dictionary
        self.numbers = np.zeros(len(numbers) + len(texts) + 1, dtype=np.int64)
        self.numbers[np.arange(len(numbers)) + doc] = numbers
        self.origin = np.cumsum(counts) - counts + np.arange(len(texts))
        self.array = suffix_array(self.numbers, depth)

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.origin, places, side="right") - 1

    def tokens_of(self, block: Block) -> np.ndarray:
        """The block's words by this shard's numbers; words the shard lacks get numbers of their own."""
        known = pc.fill_null(pc.index_in(block.vocabulary, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.where(known >= 0, known + 1, len(self.vocabulary) + 1 + np.arange(len(known)))
        return np.where(block.tokens > 0, number[np.maximum(block.tokens - 1, 0)], -1) if len(number) else block.tokens


def windows_in(shard: Shard, block: Block, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Starts and ends of the places where windows occur, and (document, item) of each pair that shares one."""
    low = bisect(shard.numbers, shard.array, tokens, block.starts, block.lengths, False)
    high = bisect(shard.numbers, shard.array, tokens, block.starts, block.lengths, True)
    held = np.flatnonzero(high > low)
    # Suffixes with an equal window share their range: list its places once.
    shared, member = np.unique(np.stack([low[held], high[held], block.lengths[held]], 1), axis=0, return_inverse=True)
    width = shared[:, 1] - shared[:, 0]
    group = np.repeat(np.arange(len(shared)), width)
    slot = np.arange(width.sum()) + np.repeat(shared[:, 0] - (np.cumsum(width) - width), width)
    places = shard.array[slot]
    # Documents of a group and items of a group, each once; then their pairs.
    items_of: list[set[int]] = [set() for _ in range(len(shared))]
    for g, i in np.unique(np.stack([member.ravel(), block.item[block.starts[held]]], 1), axis=0).tolist():
        items_of[g].add(i)
    pairs = set()
    for doc, g in np.unique(np.stack([shard.owner(places), group], 1), axis=0).tolist():
        pairs.update((doc, i) for i in items_of[g])
    return places, places + shared[group, 2], sorted(pairs)


def longest_in(shard: Shard, block: Block, tokens: np.ndarray) -> dict[int, tuple[int, int, str | None]]:
    """Longest match of each document with the block's items: words, start, smallest item that holds it."""
    array = shard.array
    if not len(array) or not len(tokens):
        return {}
    tests = suffix_array(np.maximum(tokens, 0), block.longest)
    if not len(tests):
        return {}
    slots = bisect(shard.numbers, array, tokens, tests, None, False)
    after = np.searchsorted(slots, np.arange(len(array)), side="right")
    best = np.zeros(len(array), dtype=np.int64)
    for neighbour, there in ((after - 1, after > 0), (after, after < len(tests))):
        near = np.flatnonzero(there)
        length, _ = shared_words(shard.numbers, array[near], tokens, tests[neighbour[near]])
        best[near] = np.maximum(best[near], length)
    doc = shard.owner(array)
    order = np.lexsort((array, -best, doc))
    first = order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]
    first = first[best[first] > 0]
    # The test suffixes that begin with the match, and the smallest id among their items.
    names = sorted({i for i in block.items if i is not None})
    grade_of = {name: grade for grade, name in enumerate(names)}
    grades = np.array([grade_of.get(i, len(names)) for i in block.items])[block.item[tests]]
    low, high = (bisect(tokens, tests, shard.numbers, array[first], best[first], past) for past in (False, True))
    made = {}
    for d, slot, start, end in zip(doc[first].tolist(), first.tolist(), low.tolist(), high.tolist(), strict=True):
        grade = int(grades[start:end].min())
        made[d] = (int(best[slot]), int(array[slot] - shard.origin[d]), names[grade] if grade < len(names) else None)
    return made


def better(one: tuple[int, int, str | None], other: tuple[int, int, str | None]) -> tuple[int, int, str | None]:
    """The longer match; the earlier of two; then that of the smaller item, an item without id last."""
    return min(one, other, key=lambda m: (-m[0], m[1], m[2] is None, m[2] or ""))


Match = tuple[int, list[tuple[int, int]], list[str], int, int | None, str | None]


def match_shard(texts: list[bytes], blocks: Iterable[Block], depth: int) -> list[Match]:
    """For each text: words, hit ranges [start, end), items, longest match, its start and its item."""
    shard = Shard(texts, depth)
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    items: list[set[str]] = [set() for _ in texts]
    longest: list[tuple[int, int, str | None]] = [(0, -1, None)] * len(texts)
    for block in blocks:
        tokens = shard.tokens_of(block)
        begin, end, pairs = windows_in(shard, block, tokens)
        starts.append(begin)
        ends.append(end)
        for doc, i in pairs:
            if block.items[i] is not None:
                items[doc].add(block.items[i])
        for doc, match_ in longest_in(shard, block, tokens).items():
            longest[doc] = better(longest[doc], match_) if longest[doc][0] else match_
    begin, end = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[True], begin[1:] > reach[:-1]]) if len(begin) else np.zeros(0, bool)
    closes = np.concatenate([opens[1:], [True]]) if len(begin) else opens
    ranges: list[list[tuple[int, int]]] = [[] for _ in texts]
    docs = shard.owner(begin[opens])
    for doc, a, b in zip(docs.tolist(), (begin[opens] - shard.origin[docs]).tolist(), (reach[closes] - shard.origin[docs]).tolist(), strict=True):
        ranges[doc].append((a, b))
    return [
        (n, ranges[i], sorted(items[i]), longest[i][0], longest[i][1] if longest[i][0] else None, longest[i][2])
        for i, n in enumerate(shard.counts.tolist())
    ]


def store_blocks(benchmark: DataFrame) -> DataFrame:
    """path, bytes and longest item of the stored blocks, each of up to BLOCK_BYTES of text, one item at least."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = fresh_path(benchmark.sparkSession, "benchmark_blocks")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = open_store(folder)
        rows: list[tuple[str | None, bytes]] = []

        def save() -> pa.RecordBatch:
            block, path = make_block(rows), f"{top}/{uuid.uuid4().hex}"
            files.create_dir(top, recursive=True)
            with files.open_output_stream(path, compression=None) as out:
                out.write(pickle.dumps(block))
            columns = [pa.array([path]), pa.array([sum(len(t) for _, t in rows)], pa.int64()), pa.array([block.longest], pa.int64())]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["path", "bytes", "longest"])

        for batch in batches:
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                if rows and sum(len(t) for _, t in rows) + len(data) > BLOCK_BYTES:
                    yield save()
                rows.append((item_id, data))
        if rows:
            yield save()

    dealt = items.repartition(max(1, size // (8 * BLOCK_BYTES)), F.xxhash64("item_id", "text"))
    return store(dealt.mapInArrow(build, "path string, bytes bigint, longest bigint"), "benchmark_block_list")


def block_reader(folder: str, paths: list[str], keep: bool) -> Callable[[], Iterator[Block]]:
    """Reads the blocks one after the other; keeps them for the next shard if so told."""
    kept: list[Block] = []

    def read() -> Iterator[Block]:
        if kept:
            yield from kept
            return
        files, _ = open_store(folder)
        for path in paths:
            with files.open_input_stream(path, compression=None) as stream:
                block = pickle.loads(stream.read())
            if keep:
                kept.append(block)
            yield block

    return read


RESULT = (
    "n_words bigint, ranges array<struct<start: int, end: int>>, items array<string>, "
    "longest int, longest_start int, longest_item string"
)
RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def match(documents: DataFrame, benchmark: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of every document with _match_ columns as in RESULT."""
    spark = documents.sparkSession
    listed = store_blocks(benchmark).collect()
    paths, folder = sorted(row["path"] for row in listed), fresh_path(spark, "")
    keep, depth = sum(row["bytes"] for row in listed) <= KEPT_BYTES, max((row["longest"] for row in listed), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = block_reader(folder, paths, keep)
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(text_at).to_pylist()]
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= SHARD_BYTES):
                    size += len(texts[end])
                    end += 1
                values = list(zip(*match_shard(texts[start:end], blocks(), max(depth, 1)), strict=True))
                found = [[{"start": a, "end": b} for a, b in r] for r in values[1]]
                kinds_ = [pa.int64(), RANGES, pa.list_(pa.string()), pa.int32(), pa.int32(), pa.string()]
                made = [values[0], found, *values[2:]]
                arrays = [c.slice(start, end - start) for c in batch.columns[: len(columns)]]
                arrays += [pa.array(v, kind) for v, kind in zip(made, kinds_, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f"_{i}" for i in range(len(arrays))])
                start = end

    # The text is not sent twice where it is among the columns.
    text_at = columns.index("text") if "text" in columns else len(columns)
    kinds = documents.select(*columns).schema
    result = spark.createDataFrame([], RESULT).schema
    sent = columns if "text" in columns else [*columns, "text"]
    renamed = documents.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(sent)])
    schema = type(kinds)()
    for i, field in enumerate([*kinds.fields, *result.fields]):
        schema = schema.add(f"_{i}", field.dataType)
    return renamed.mapInArrow(run, schema).toDF(*columns, *[f"_match_{f.name}" for f in result.fields])


def hit_words(ranges: Column) -> Column:
    """Words in disjoint ranges."""
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda n, r: n + (r["end"] - r["start"]))


def findings(documents: DataFrame, benchmark: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of every document with _match_n_words, _match_n_hit, _match_items, the longest match, _match_contaminated."""
    found = match(documents, benchmark, columns).withColumn("_match_n_hit", hit_words(F.col("_match_ranges")))
    hit, size = F.col("_match_n_hit"), F.col("_match_n_words")
    return found.withColumn("_match_contaminated", (hit > 0) & (PART * hit >= size))


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    columns = documents.columns
    return findings(documents, benchmark, columns).where(~F.col("_match_contaminated")).select(*columns)
