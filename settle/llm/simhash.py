"""Near duplicates by SimHash, found through segment popcounts.

A 64-bit fingerprint is embedded as its bit counts by segment. The Manhattan
distance of two embeddings never exceeds the Hamming distance of the
fingerprints, so a range join in that grid finds every pair within two bits;
the candidates are then verified exactly.

The range join needs no pairwise work: points within Manhattan distance 2 of
each other have a common grid point within distance 1 of both. Each distinct
fingerprint is listed under its own grid point and those one step away (33 at
most for 16 segments), and fingerprints that share a grid point are candidates.
Copies collapse to one fingerprint beforehand, so groups of copies of any size
cost nothing here, and a fingerprint has at most 2,080 others within two bits.

Null and empty texts have fingerprint zero and are linked like any other.
Repeated rows stay rows. A null doc_id never names a component unless the
component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.llm.common import chunks, store, texts_of
from settle.llm.components import connected_components
from settle.session import bounded

SHINGLE = 3
SEED = 42
SEGMENT_BITS = 4
RADIUS = 2  # the embedding below lists neighbours one step away, which serves this radius
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str) -> np.ndarray:
    """XXH64 of every shingle, repeats included; none for a text without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - SHINGLE + 1, 1)
    ends = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends.tolist(), strict=True)], dtype=np.uint64
    )


def bits_set(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set, highest bit first."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return total


def fingerprint(text: str) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the hashes."""
    hashes = shingle_hashes(text)
    majority = 2 * bits_set(hashes) > len(hashes)
    return int(np.packbits(majority).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column("text"))
        made = [fingerprint(t) for start, end in chunks(texts) for t in texts[start:end]]
        arrays = [*batch.columns[:-1], pa.array(made, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "_fingerprint"])


def with_fingerprint(documents: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of the documents and `_fingerprint`."""
    source = documents.select(*columns, F.col("text").alias("_fingerprinted"))
    schema = documents.select(*columns).schema.add("_fingerprint", "long")
    renamed = source.toDF(*columns, "_fingerprinted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _fingerprints(b.rename_columns([*columns, "text"]) for b in batches)

    return renamed.mapInArrow(run, schema)


def grid_points(fingerprint: Column) -> Column:
    """Own grid point and those one step away; a point packs a bit count for each segment."""
    segments = 64 // SEGMENT_BITS
    width = SEGMENT_BITS.bit_length()  # bits that hold counts 0 to SEGMENT_BITS
    counts = [
        F.bit_count(F.shiftrightunsigned(fingerprint, SEGMENT_BITS * i).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)))
        for i in range(segments)
    ]
    own = sum((F.shiftleft(c.cast("bigint"), width * i) for i, c in enumerate(counts)), F.lit(0).cast("bigint"))
    around = [own]
    for i, count in enumerate(counts):
        step = F.lit(1 << (width * i)).cast("bigint")
        around.append(F.when(count < SEGMENT_BITS, own + step))
        around.append(F.when(count > 0, own - step))
    return F.array_compact(F.array(*around))


def links(fingerprints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct values of `fp` that differ in one or two bits.

    Spark sizes the listing as if each value were still one row, and would send up to
    33 times the bytes it expects through the driver; so both sides are shuffled.
    """
    listed = fingerprints.select("fp", F.explode(grid_points(F.col("fp"))).alias("point"))
    one, other = listed.alias("one"), listed.alias("other")
    near = (
        (F.col("one.point") == F.col("other.point"))
        & (F.col("one.fp") < F.col("other.fp"))
        & (F.bit_count(F.col("one.fp").bitwiseXOR(F.col("other.fp"))) <= RADIUS)
    )
    return one.join(other.hint("merge"), near).select(F.col("one.fp").alias("a"), F.col("other.fp").alias("b")).distinct()


def components(fingerprints: DataFrame) -> DataFrame:
    """fp, smallest fingerprint `root` of its component, smallest doc_id `first` and number of links.

    Takes (doc_id, fp) rows. Only fingerprints with a link go through the
    iterations; the others are components of their own.
    """
    distinct = store(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    edges = store(links(distinct.select("fp")), "fingerprint_links")
    roots = connected_components(edges)
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    degree = both.groupBy(F.col("a").alias("fp")).agg(F.count("*").alias("n_links"))
    rooted = (
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .join(degree, "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id", "n_links")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id and number of linked fingerprints of every row."""
    marked = store(with_fingerprint(documents, ["doc_id"]).withColumnRenamed("_fingerprint", "fp"), "simhash")
    found = components(marked)
    return marked.join(found, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_links",
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component: a row of the doc_id that names it.

    Rows that repeat the chosen doc_id and text count as one document. Of
    different texts under the chosen doc_id one stays. Rows are numbered in a
    stored copy, and a small table of the numbers to keep decides: texts are
    written once and never shuffled. Columns may have any names.
    """
    columns = documents.columns
    numbered = documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("kept"))
    numbered = store(numbered, "simhash_rows")
    keyed = numbered.select(
        "row", F.col("kept.doc_id").alias("doc_id"), F.col("kept.text").alias("text"),
        F.xxhash64(F.coalesce("kept.text", F.lit(""))).alias("text_key"),
    )
    marked = store(with_fingerprint(keyed, ["doc_id", "text_key", "row"]).withColumnRenamed("_fingerprint", "fp"), "simhash")
    named = marked.join(components(marked), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = named.groupBy("root").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("own"))
    rows = store(chosen.select(F.col("own.row").alias("row")).distinct(), "simhash_kept")
    return numbered.join(bounded(rows, within=rows), "row", "left_semi").select("kept.*").select(*[f"`{c}`" for c in columns])
