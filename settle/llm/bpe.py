"""Byte-level BPE: every distinct word of the corpus is encoded once.

Texts are cut into words, whose order within a document is kept as numbers. The
distinct words go through one global shuffle, are encoded once each, and their
ids return to the documents, which are put together by position. Decoding looks
every id up in the token-byte table.

A word is a stretch of text from a space that no white space follows to the
next such space. The split pattern always starts a match at such a space, so
the matches of a text are those of its words one after the other. This holds
for patterns that allow white space in front of a match only, or in matches of
nothing else; an encoder with another kind of pattern must not be used here.

Exploding every occurrence would move each word of the corpus twice. Instead a
block (consecutive documents of one task, of bounded size) lists each of its
distinct words once, in buckets by a hash of the word; occurrences are numbers
into that list. A word that makes up any share of the corpus is thus one entry
for each block, and a bucket holds about the same number of words as any other.
Buckets and tasks grow in number with the bytes of the texts, taken from the files
of a stored table, so that a bucket stays within BUCKET_BYTES of text on average
whatever the input; only a single word may be longer than that.

The documents are read twice, once for the words and once for the positions;
that is cheaper than storing either. Both passes must see the same rows in the
same tasks, which holds for stored tables; a checksum of the block's words
stops the job if they ever differ.

Null texts are empty and have no ids. Repeated rows are encoded one by one. An
empty table gives no rows; a text of any length is in one block. Only the columns
asked for are kept, in a struct, so their names cannot clash with those used here.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from settle.session import file_bytes

BLOCK_CHARS = 14_000_000
BUCKET_BYTES = 32 << 20  # text whose distinct words share a bucket
TASK_BYTES = 128 << 20  # text whose words, or whose documents, share a task
BUCKETS_PER_PARTITION = 4
TEXTS_AT_ONCE = 500
WORDS_AT_ONCE = 100_000

CUT = re.compile(r" (?=\S)")


class Numbers(dict):
    """Numbers words in the order of their first occurrence."""

    def __missing__(self, word: str | tuple[str]) -> int:
        number = self[word] = len(self)
        return number

    def of_text(self, text: str) -> np.ndarray:
        """Numbers of the words of a text; only the first one may lack its space and is a tuple here."""
        pieces: list = CUT.split(text)
        if pieces[0]:
            pieces[0] = (pieces[0],)
        else:
            del pieces[0]
        return np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def words(self) -> Iterator[bytes]:
        for word in self:
            yield (word[0] if type(word) is tuple else " " + word).encode("utf-8", "surrogatepass")


def packed(numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The numbers between bounds as bytes: groups of 7 bits, low ones first; the top bit says that more follow."""
    size = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14) + (numbers >= 1 << 21) + (numbers >= 1 << 28)
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(at[-1]), dtype=np.uint8)
    for i in range(5):
        some = np.flatnonzero(size > i)
        out[at[some] + i] = (numbers[some] >> (7 * i)) & 127 | np.where(size[some] > i + 1, 128, 0)
    data, cuts = out.tobytes(), at[bounds].tolist()
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def unpacked(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all parts, and the bounds of the parts among them."""
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    numbers = (raw[starts] & 127).astype(np.int64)
    for i in range(1, 5):
        some = np.flatnonzero(starts + i <= ends)
        if not len(some):
            break
        numbers[some] |= (raw[starts[some] + i] & 127).astype(np.int64) << (7 * i)
    return numbers, np.searchsorted(ends, np.concatenate([[0], np.cumsum([len(p) for p in parts])]))


def squeezed(parts: list[bytes]) -> pa.Array:
    """Compressed parts; each is of many words, and less of it is left than where shuffled bytes are compressed."""
    packer = zstandard.ZstdCompressor(level=1)
    return pa.array([packer.compress(part) for part in parts], pa.binary())


def expanded(parts: pa.ChunkedArray) -> list[bytes]:
    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(part) for part in parts.to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Numbers, int, list[bytes], list]]:
    """Blocks of a task's documents: name, numbered words, their checksum, packed numbers by text, kept columns."""
    task = TaskContext.get().partitionId()
    numbers, sequences, kept, size, count = Numbers(), [], [], 0, 0

    def done():
        check = 0
        for word in numbers.words():
            check = zlib.crc32(word, check)
        return f"{task}-{count}", numbers, check, sequences, kept

    for batch in batches:
        start = 0
        for i, text in enumerate(batch.column(1).to_pylist()):
            found = numbers.of_text(text or "")
            sequences += packed(found, np.array([0, len(found)]))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                kept.append(batch.column(0).slice(start, i + 1 - start))
                yield done()
                numbers, sequences, kept, size, count, start = Numbers(), [], [], 0, count + 1, i + 1
        if start < batch.num_rows:
            kept.append(batch.column(0).slice(start))
    if sequences:
        yield done()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """A rank file and a split pattern, read by the driver and sent to the tasks; its size is that of the file."""

    def __init__(self, path: str, pattern: str):
        self.pattern, self.ranks = pattern, read_ranks(path)

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def token_bytes(self) -> pa.Array:
        """Bytes by id; ids without a token are null."""
        by_id: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        return pa.array(by_id, pa.large_binary())


def distinct_words(documents: DataFrame, buckets: int) -> DataFrame:
    """Distinct words of each block, one row for each bucket: places in the block, lengths, and the words themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, numbers, check, texts, _ in blocks(batches):
            texts.clear()
            words = list(numbers.words())
            numbers.clear()  # the words alone are needed from here on
            if not words:
                continue
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), dtype=np.int32, count=len(words))
            order = np.argsort(bucket, kind="stable")
            used, first = np.unique(bucket[order], return_index=True)
            bounds = np.append(first, len(words))
            spelled = [words[i] for i in order.tolist()]
            # Places rise within a bucket, so their steps are small.
            steps = np.diff(order, prepend=0)
            steps[first] = order[first]
            n = len(used)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * n), pa.array([check] * n, pa.int64()), pa.array(used),
                squeezed(packed(steps, bounds)),
                squeezed(packed(np.fromiter(map(len, spelled), dtype=np.int64), bounds)),
                squeezed([b"".join(spelled[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]),
            ], names=["block", "check", "bucket", "places", "lengths", "words"])

            # Workers are reused: what a block took goes back before the next task.
            pa.default_memory_pool().release_unused()

    return documents.mapInArrow(
        run, "block string, check bigint, bucket int, places binary, lengths binary, words binary"
    )


def sequences(documents: DataFrame) -> DataFrame:
    """The packed word numbers of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, words, check, numbers, kept in blocks(batches):
            words.clear()
            n = len(numbers)
            columns = pa.chunked_array(kept).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array([check] * n, pa.int64()), columns, pa.array(numbers, pa.binary())],
                names=["block", "check", "kept", "numbers"])

    schema = (
        StructType().add("block", StringType()).add("check", LongType())
        .add("kept", documents.schema["kept"].dataType).add("numbers", BinaryType())
    )
    return documents.mapInArrow(run, schema)


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Ids of the words of each (block, bucket); a word is encoded once, whatever the number of blocks."""
    shared = words.sparkSession.sparkContext.broadcast(vocabulary)

    def run(table: pa.Table) -> pa.Table:
        encode = shared.value.encoding.encode_ordinary
        lengths, bounds = unpacked(expanded(table.column("lengths")))
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
        spelled = b"".join(expanded(table.column("words")))
        every = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, ends.buffers()[1], pa.py_buffer(spelled)])
        coded = every.dictionary_encode()
        distinct, made = coded.dictionary, [pa.array([], pa.list_(pa.int32()))]
        for first in range(0, len(distinct), WORDS_AT_ONCE):
            some = distinct.slice(first, WORDS_AT_ONCE).to_pylist()
            made.append(pa.array([encode(word.decode("utf-8", "surrogatepass")) for word in some], pa.list_(pa.int32())))
        found = pa.concat_arrays(made).take(coded.indices)
        sizes = pc.list_value_length(found).to_numpy().astype(np.int64)
        id_bounds = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        return pa.table({
            "block": table.column("block"), "check": table.column("check"), "places": table.column("places"),
            "sizes": squeezed(packed(sizes, bounds)),
            "ids": squeezed(packed(found.flatten().to_numpy().astype(np.int64), id_bounds)),
        })

    return words.groupBy("bucket").applyInArrow(
        run, "block string, check bigint, places binary, sizes binary, ids binary"
    )


def spelled_out(lists: pa.ListArray, token_bytes: pa.Array) -> pa.Array:
    """The bytes that lists of ids stand for; null lists have none. An id without a token is an error."""
    flat = token_bytes.take(lists.flatten())
    if flat.null_count:
        raise ValueError("an id has no token")
    # Tokens lie one after the other: a document's bytes run from its first token to its last.
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1][ends]
    return pa.Array.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(bounds)), data or pa.py_buffer(b"")]
    ).cast(pa.binary())


def reassemble(numbered: DataFrame, coded: DataFrame, decoder: Vocabulary | None = None) -> DataFrame:
    """kept and ids of every document, from its word numbers and the ids of its block's words.

    With a decoder the ids are also decoded, to `decoded`.
    """
    shared = decoder and numbered.sparkSession.sparkContext.broadcast(decoder)

    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        numbers = documents.column("numbers").to_pylist()
        checks = pc.unique(documents.column("check")).to_pylist() + pc.unique(words.column("check")).to_pylist()
        if len(set(checks)) > 1:
            raise ValueError("the documents changed between the two passes; store them first")
        steps, bounds = unpacked(expanded(words.column("places")))
        places = [np.cumsum(steps[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        places = np.concatenate(places) if places else steps
        sizes, _ = unpacked(expanded(words.column("sizes")))
        ids = unpacked(expanded(words.column("ids")))[0].astype(np.int32)
        # Start and length of each word's ids, by the word's number in the block.
        starts, lengths = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        starts[places], lengths[places] = np.cumsum(sizes) - sizes, sizes
        made = [pa.array([], pa.list_(pa.int32()))]
        for first in range(0, len(numbers), TEXTS_AT_ONCE):
            sequence, bounds = unpacked(numbers[first : first + TEXTS_AT_ONCE])
            length = lengths[sequence]
            ends = np.concatenate([[0], np.cumsum(length)])
            flat = ids[np.repeat(starts[sequence] - ends[:-1], length) + np.arange(ends[-1])]
            made.append(pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), pa.array(flat)))
        columns = {"kept": documents.column("kept"), "ids": pa.chunked_array(made)}
        if shared:
            columns["decoded"] = pa.chunked_array([spelled_out(part, shared.value.token_bytes) for part in made])
        return pa.table(columns)

    schema = StructType().add("kept", numbered.schema["kept"].dataType).add("ids", ArrayType(IntegerType()))
    if decoder:
        schema = schema.add("decoded", BinaryType())
    return numbered.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(run, schema)


def bytes_of(documents: DataFrame) -> int:
    """Bytes of the texts: taken from the files of a stored table, else summed by a job."""
    stored = file_bytes(documents)
    return stored if stored is not None else documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def shares(documents: DataFrame) -> tuple[int, int]:
    """Numbers of buckets and of tasks, in proportion to the bytes of the texts."""
    usual = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = bytes_of(documents)
    return max(BUCKETS_PER_PARTITION * max(usual, 16), -(-size // BUCKET_BYTES)), max(usual, -(-size // TASK_BYTES))


def spread(df: DataFrame, tasks: int, key: str) -> DataFrame:
    """Rows of a key in one of `tasks` partitions, where those are more than the session's."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, key) if tasks > usual else df


def assembled(documents: DataFrame, vocabulary: Vocabulary, columns: list[str], decoder: Vocabulary | None = None) -> DataFrame:
    buckets, tasks = shares(documents)
    source = documents.select(F.struct(*columns).alias("kept"), "text")
    coded = encode_words(spread(distinct_words(source, buckets), tasks, "bucket"), vocabulary)
    numbered = sequences(source)
    return reassemble(spread(numbered, tasks, "block"), spread(coded, tasks, "block"), decoder)


def encode(documents: DataFrame, vocabulary: Vocabulary, columns: list[str], ids: str = "ids") -> DataFrame:
    """`columns` of every document and the ids of its text."""
    return assembled(documents, vocabulary, columns).select("kept.*", F.col("ids").alias(ids))


def round_trip(
    documents: DataFrame, vocabulary: Vocabulary, columns: list[str], ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """As `decode` after `encode`. The task that puts the ids together decodes them: one Python worker, not two."""
    made = assembled(documents, vocabulary, columns, vocabulary)
    return made.select("kept.*", F.col("ids").alias(ids), F.col("decoded").alias(decoded))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for. An id that the table lacks fails the job."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    names = encoded.columns
    at = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = spelled_out(batch.column(at), shared.value.token_bytes)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, decoded])

    schema = encoded.select("*").schema.add(decoded, BinaryType())
    return encoded.mapInArrow(run, schema)
