"""Embedding whitening by Chebyshev-filtered subspace iteration.

Every entry c of a vector becomes the integer x = floor(64 c) + 1,000,000. The
covariance V of the distinct x vectors (the fit list) is never formed: the
iteration needs only products V Q, and a product is one pass over the fit list,
in which every task adds up its part of Xc'(Xc Q)/n, Xc being the centred rows.
A pass brings dimensions x block numbers to the driver, however many rows there are.

A round applies a Chebyshev polynomial of V to the block by its three-term
recurrence, one pass a degree. The polynomial is small on the interval of the
unwanted spectrum (from what a few Lanczos steps find to be its lower end up to
the block's smallest value) and grows fast above it. QR makes the block
orthonormal again and Rayleigh-Ritz turns it to the eigenvectors within it.
Leading pairs that are certified are locked: later rounds filter the others
alone, orthogonal to them. The degree is such that no direction grows over GROWTH
times, beyond which rounding would drown the smaller ones. The rounds end when
the pairs are certified: for every wanted pair the norm of V q - e q is within
CERTIFIED of the largest eigenvalue, so each e is an eigenvalue to that
precision. The block holds GUARDS more vectors than wanted, which keep the cut
away from the wanted pairs and show that none was passed over.

Centring is exact: n x - S is computed in integers and divided once.

Vectors that are null or hold null or non-finite entries, or entries beyond
4.6e18 / 64 in size (x is no long then), take no part. A vector shorter than the
longest counts as filled up with zeros. Repeated vectors are one row of the fit
list, and every row of the table gets its own result rows, null ids included.
Components whose eigenvalue is zero (within RANK of the largest) cannot be
whitened and are left out; so a table with fewer than two distinct vectors, or
none, gives no rows. Equal eigenvalues leave the choice of axes open: any pair
that is orthonormal will do. `deviation` is null where it exceeds a long. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import prepare, store

SCALE, SHIFT = 64, 1_000_000
WANTED = 16
GUARDS = 16
DEGREE = 12  # passes of a round, at most
GROWTH = 1e7
LANCZOS = 10
ROUNDS = 200
CERTIFIED = 2e-14  # residual against the largest eigenvalue
GOOD_ENOUGH = 1e-11  # what a stalled iteration must have reached
RANK = 1e-10
LIMIT = 2.0**62


def integers(table: DataFrame, vector_column: str, *columns: str) -> DataFrame:
    """`columns` and the integer vector `x` of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    scaled = F.transform(vector, lambda c: c * SCALE)
    rows = table.select(*columns, scaled.alias("_scaled")).where(
        F.col("_scaled").isNotNull() & F.forall("_scaled", lambda c: c.isNotNull() & (F.abs(c) < LIMIT))
    )
    return rows.select(*columns, F.transform("_scaled", lambda c: F.floor(c).cast("bigint") + SHIFT).alias("x"))


def filled(x: pa.ListArray, dimensions: int) -> np.ndarray:
    """One row of integers a vector; a short vector is filled up with the integer of zero."""
    lengths = np.diff(x.offsets.to_numpy())
    flat = x.flatten().to_numpy()
    if (lengths == dimensions).all():
        return flat.reshape(len(x), dimensions)
    rows = np.full((len(x), dimensions), SHIFT, dtype=np.int64)
    rows[np.arange(dimensions) < lengths[:, None]] = flat
    return rows


def offsets_from_mean(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they suffice, Python integers else."""
    most = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
    if n * most < 2**62 and max(map(abs, sums), default=0) < 2**62:
        return rows * n - np.array(sums, dtype=np.int64)
    return rows.astype(object) * n - np.array(sums, dtype=object)


def deviations(offsets: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null where they exceed a long."""
    if offsets.dtype != object:
        most = max(abs(int(offsets.max(initial=0))), abs(int(offsets.min(initial=0))))
        if most * most * max(offsets.shape[1], 1) < 2**63:
            return (offsets * offsets).sum(1).tolist()
    whole = offsets.astype(object)
    return [int(v) if v < 2**63 else None for v in (whole * whole).sum(1)]


@dataclass
class Fit:
    """The fit list in packed blocks, its size, sums and the trace of its covariance."""

    blocks: DataFrame
    n: int
    sums: list[int]
    trace: float = 0.0

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def summed(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum over the fit list of what `part` makes of centred rows; one pass."""
        n, sums, width = self.n, self.sums, self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for block in batch.column("rows"):
                    rows = np.frombuffer(block.as_buffer(), dtype=np.int64).reshape(-1, width)
                    total += part((offsets_from_mean(rows, n, sums) / n).astype(np.float64))
            cells = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(cells), dtype=np.int64)), pa.array(cells)], names=["cell", "value"]
            )

        sums_of_cells = self.blocks.mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value"))
        total = np.zeros(math.prod(shape))
        for cell, value in sums_of_cells.collect():
            total[cell] = value
        return total.reshape(shape)

    def product(self, q: np.ndarray) -> np.ndarray:
        """V Q."""
        return self.summed(lambda rows: rows.T @ (rows @ q), q.shape) / self.n


def fit_list(x: DataFrame) -> Fit:
    """Distinct vectors, packed, with their number and exact sums."""
    longest = x.agg(F.max(F.size("x"))).first()[0] or 0
    # Vectors that differ only in zeros left out at the end are one.
    zeros = F.array_repeat(F.lit(SHIFT).cast("bigint"), F.lit(longest) - F.size("x"))
    distinct = x.select(F.concat("x", zeros).alias("x")).distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = filled(batch.column("x"), longest)
            half = np.stack([(rows >> 32).sum(0), (rows & 0xFFFFFFFF).sum(0)], 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(rows)], pa.int64()), pa.array([rows.tobytes()], pa.binary()), pa.array([half.tolist()], pa.list_(pa.list_(pa.int64())))],
                names=["n", "rows", "halves"],
            )

    packed = store(distinct.mapInArrow(pack, "n bigint, rows binary, halves array<array<bigint>>"), "whitening_fit")
    n = packed.agg(F.sum("n")).first()[0] or 0
    each = packed.select(F.posexplode("halves").alias("place", "half")).groupBy("place")
    halves = each.agg(F.sum(F.col("half")[0]), F.sum(F.col("half")[1])).collect()
    sums = [high * 2**32 + low for _, high, low in sorted(halves)]
    fit = Fit(packed.select("rows"), n, sums)
    if n and sums:
        fit.trace = float(fit.summed(lambda rows: np.array([(rows * rows).sum()]), (1,))[0] / n)
    return fit


def rayleigh_ritz(block: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling eigenvalues within the block, their vectors, and V times these."""
    small = block.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], block @ turn, product @ turn


def lower_end(fit: Fit, start: np.ndarray) -> float:
    """About the smallest eigenvalue, from a few Lanczos steps; never below zero.

    If it is somewhat too high, what lies below it is damped less, but still less than wanted pairs grow.
    """
    basis, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(min(LANCZOS, fit.dimensions)):
        step = fit.product(basis[-1])
        diagonal.append(float(np.vdot(basis[-1], step)))
        for _ in range(2):
            for known in basis:
                step = step - known * np.vdot(known, step)
        beside.append(float(np.linalg.norm(step)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        basis.append(step / beside[-1])
    small = np.diag(diagonal) + np.diag(beside[: len(diagonal) - 1], 1) + np.diag(beside[: len(diagonal) - 1], -1)
    return max(float(np.linalg.eigvalsh(small)[0]), 0.0)


def filtered(fit: Fit, block: np.ndarray, product: np.ndarray, locked: np.ndarray, span: tuple[float, float, float]) -> np.ndarray:
    """The Chebyshev polynomial of V that is small on [low, cut], applied to the block.

    Scaled so that it is about 1 at `top`; the first product is known. The block
    is kept orthogonal to what is locked.
    """
    low, cut, top = span
    half, centre = (cut - low) / 2, (cut + low) / 2
    reach = (top - centre) / half
    degree = min(DEGREE, max(1, int(math.log(GROWTH) / math.log(reach + math.sqrt(reach * reach - 1)))))
    sigma = first = half / (top - centre)

    def apart(q: np.ndarray) -> np.ndarray:
        return q - locked @ (locked.T @ q)

    before, now = block, apart(product - centre * block) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, apart((fit.product(now) - centre * now) * (2 * following / half) - before * (sigma * following))
        sigma = following
    return apart(now)


def components(fit: Fit, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (as columns) of the covariance: up to `wanted`, none for zero."""
    size = min(fit.dimensions, wanted + GUARDS)
    if fit.n < 2 or not size or fit.trace <= 0:
        return np.zeros(0), np.zeros((fit.dimensions, 0))
    wanted = min(wanted, size)
    random, best = np.random.default_rng(seed), math.inf
    block = np.linalg.qr(random.normal(size=(fit.dimensions, size)))[0]
    low = lower_end(fit, random.normal(size=(fit.dimensions, 1))) if size < fit.dimensions else 0.0
    for _ in range(ROUNDS):
        values, block, product = rayleigh_ritz(block, fit.product(block))
        residuals = np.linalg.norm(product - block * values, axis=0)[:wanted] / max(values[0], 1e-300)
        left = residuals.max()
        if left <= CERTIFIED or (left <= GOOD_ENOUGH and left > best / 2):
            break  # certified, or as near as rounding lets it come
        best = min(best, left)
        done = int((residuals > CERTIFIED).argmax())
        locked, rest, next_ = block[:, :done], block[:, done:], product[:, done:]
        cut, top = float(values[-1]), float(values[done])
        lowest = min(low, cut - (top - cut) / 2)
        grown = filtered(fit, rest, next_, locked, (max(lowest, 0.0), cut, top)) if cut > 1e-12 * top and cut < top else next_
        block = np.linalg.qr(np.concatenate([locked, grown], axis=1))[0]
    else:
        raise ArithmeticError(f"eigenvectors not certified after {ROUNDS} rounds: residual {left:.1e}")
    kept = int((values[:wanted] > RANK * values[0]).sum())
    vectors = block[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(kept)])
    return values[:kept], vectors * signs


RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, id_column: str, vector_column: str, wanted: int = WANTED) -> DataFrame:
    """The id and RESULT for each row that takes part and each component."""
    prepare(table.sparkSession)
    rows = integers(table, vector_column, id_column).withColumnRenamed(id_column, "_id")
    fit = fit_list(rows.select("x"))
    values, vectors = components(fit, wanted)
    scaled = vectors / np.sqrt(values)
    count, n, sums, width = len(values), fit.n, fit.sums, fit.dimensions
    explained, error = (values / fit.trace if count else values), 0.0
    if count:
        covariance = fit.summed(lambda r: (r @ scaled).T @ (r @ scaled), (count, count)) / n
        error = float(np.abs(covariance - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not count or not batch.num_rows:
                continue
            away = offsets_from_mean(filled(batch.column("x"), width), n, sums)
            white = (away / n).astype(np.float64) @ scaled
            whose = np.repeat(np.arange(batch.num_rows), count)
            component = np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(whose)), pa.array(component),
                    pa.array(np.full(len(whose), n)), pa.array(deviations(away), pa.int64()).take(pa.array(whose)),
                    pa.array(white.ravel()), pa.array(explained[component - 1]), pa.array(np.full(len(whose), error)),
                ],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, {RESULT}").withColumnRenamed("_id", id_column)
