"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit one binary classifier over
hashed letter n-grams tells the languages whose bit is 1 from those whose bit
is 0. A text goes to the language whose codeword has the smallest weighted loss
against the classifiers' margins; a narrow gap to the runner-up is flagged.

Counting n-grams is one pass over the learning rows: each task counts by
language and bucket, and Spark adds the counts up. The model is `buckets x
bits` numbers, whatever the size of the corpus.

Null and empty texts and texts without a letter are `und` with score 0.
Repeated rows are predicted one by one. Without learning rows everything is
`und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import CHUNK_CHARS, chunks, held_out, texts_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)  # lengths of the n-grams
UNDETERMINED = "und"
SMOOTHING = 0.5
SHARPNESS = 8.0  # turns mean log odds into margins
DOUBT = 40  # n-grams at which margins reach half their size: short texts stay unsure
DECISION = 4.0  # turns losses into scores
AMBIGUOUS_GAP = 0.2  # a smaller gap between the two best scores is flagged
EXHAUSTIVE = 7  # up to so many languages every split of them is a bit


@cache
def letter_codes() -> np.ndarray:
    """Code of each code point: its lower case if it is a letter, else 0."""
    codes = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            codes[point] = ord(char.lower()[0])
    return codes


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and letters by text.

    Runs of other characters count as one boundary; texts are kept apart by one.
    """
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])[: len(points)]
    codes = letter_codes()[points]
    is_letter = codes != 0
    letters = np.bincount(owner[is_letter], minlength=len(texts))
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # the boundary after a word
    codes, owner = codes[kept], owner[kept]
    found, owners = [], []
    mixed = np.zeros(len(codes), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        size = len(codes) - order + 1
        if size <= 0:
            break
        mixed = mixed[:size] * np.uint32(0x01000193) + (codes[order - 1 :] + np.uint32(1)) * np.uint32(0x9E3779B1)
        if order in ORDERS:
            whole = owner[:size] == owner[order - 1 :]
            if order == 1:
                whole &= codes != 0
            bucket = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            found.append((bucket >> np.uint32(32 - 15))[whole].astype(np.int32) & (BUCKETS - 1))
            owners.append(owner[:size][whole])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), letters
    return np.concatenate(found), np.concatenate(owners), letters


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = texts_of(batch.column("text")), np.array(batch.column("lang").to_pylist(), dtype=object)
        for start, end in chunks(texts):
            bucket, owner, _ = grams(texts[start:end])
            for lang in set(langs[start:end]):
                mine = (langs[start:end] == lang)[owner]
                seen = np.bincount(bucket[mine], minlength=BUCKETS)
                counts[lang] = counts[lang] + seen if lang in counts else seen
    for lang, seen in counts.items():
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(seen[used].astype(np.int64))],
            names=["lang", "bucket", "n"],
        )


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """Code matrix of +1 and -1, a row for each class, no two rows alike.

    Up to EXHAUSTIVE classes the bits are all splits into two sides; beyond
    that, of some random matrices of 10 log2(classes) bits the one whose rows
    are farthest apart.
    """
    if classes == 1:
        return np.ones((1, 1))
    if classes <= EXHAUSTIVE:
        splits = np.arange(1, 2 ** (classes - 1))
        rest = (splits[None, :] >> np.arange(classes - 1)[:, None]) & 1
        return np.concatenate([np.zeros((1, len(splits))), rest]) * 2 - 1
    random, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(classes)))
    best, best_distance = None, -1
    for _ in range(50):
        code = random.integers(0, 2, (classes, bits)) * 2 - 1
        if (np.abs(code.sum(0)) == classes).any():
            continue
        agree = code @ code.T
        distance = int((bits - agree[~np.eye(classes, dtype=bool)].max()) // 2)
        if distance > best_distance:
            best, best_distance = code, distance
    return best


class Model:
    """Languages, code matrix, n-gram weights by bit, and the weights of the bits."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs)) if langs else np.zeros((0, 0))
        smooth = counts + SMOOTHING
        share = smooth / smooth.sum(1, keepdims=True) if langs else counts
        sides = [(share[column > 0].mean(0), share[column < 0].mean(0)) for column in self.code.T if len(set(column)) == 2]
        odds = [np.log(one / other) for one, other in sides] or [np.ones(BUCKETS)] * bool(langs)
        self.weights = np.array(odds, dtype=np.float32).T.reshape(BUCKETS, -1)
        if langs:
            # Bits that tell their languages apart well have little expected loss and count more.
            expected = share @ self.weights
            loss = np.log1p(np.exp(-self.code * expected * SHARPNESS)).mean(0)
            weight = 1 / (0.05 + loss)
            self.bit_weight = weight / weight.sum()

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by text and language, adding up to 1, and letters by text."""
        bucket, owner, letters = grams(texts)
        n = np.bincount(owner, minlength=len(texts))
        margins = np.empty((len(texts), self.weights.shape[1]))
        for bit in range(self.weights.shape[1]):
            margins[:, bit] = np.bincount(owner, self.weights[:, bit][bucket], minlength=len(texts))
        margins *= (SHARPNESS / (n + DOUBT))[:, None]
        loss = np.stack([np.logaddexp(0, -margins * word) @ self.bit_weight for word in self.code], axis=1)
        likely = np.exp(-DECISION * (loss - loss.min(1, keepdims=True)))
        return likely / likely.sum(1, keepdims=True), letters


def fit(documents: DataFrame) -> Model:
    """Learn from the rows that are not held out and have a language."""
    learning = documents.select("text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counted = (
        learning.mapInArrow(count_grams, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("seen"))
    )
    rows = sorted(counted.toLocalIterator(), key=lambda row: row.lang)
    counts = np.zeros((len(rows), BUCKETS))
    for i, row in enumerate(rows):
        for bucket, n in row.seen:
            counts[i, bucket] = n
    return Model([row.lang for row in rows], counts)


def predict(documents: DataFrame, model: Model, kept: list[str], prefix: str = "") -> DataFrame:
    """Columns `kept` of the documents with lang_pred, score and ambiguous added.

    The text is read from `text`. A prefix keeps the added names apart from others.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    added = {f"{prefix}lang_pred": "string", f"{prefix}score": "double", f"{prefix}ambiguous": "boolean"}

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            texts = texts_of(batch.column("text"))
            pred, score, unsure = [], [], []
            for start, end in chunks(texts, CHUNK_CHARS):
                if not learned.langs:
                    pred += [UNDETERMINED] * (end - start)
                    score += [0.0] * (end - start)
                    unsure += [True] * (end - start)
                    continue
                likely, letters = learned.scores(texts[start:end])
                order = np.sort(likely, axis=1)
                gap = order[:, -1] - (order[:, -2] if likely.shape[1] > 1 else 0)
                known = letters > 0
                best = likely.argmax(1)
                pred += [learned.langs[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
                score += np.where(known, order[:, -1], 0.0).tolist()
                unsure += (~known | (gap < AMBIGUOUS_GAP)).tolist()
            arrays = [batch.column(c) for c in kept] + [
                pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    schema = documents.select(*kept).schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    source = documents.select(*dict.fromkeys([*kept, "text"]))
    return source.mapInArrow(label, schema)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document."""
    found = predict(documents, fit(documents), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(documents: DataFrame) -> DataFrame:
    """Documents whose language can be told; the rest (no letter) is rejected."""
    columns = documents.columns
    found = predict(documents, fit(documents), columns, prefix="_identified_")
    return found.where(F.col("_identified_lang_pred") != UNDETERMINED).select(*columns)
