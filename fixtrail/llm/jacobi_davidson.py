"""Whitening of embeddings with eigenvectors found by a block Jacobi-Davidson method.

The covariance matrix is never formed. The only thing known about it is its product with a
few vectors at a time: a Spark job in which every task centres its vectors, multiplies them
with the block and with the result again, and sends one number for each entry of the block. Around
that product the driver holds a search space of a few blocks of vectors (dimensions x some
hundred numbers at most):

* Rayleigh-Ritz on the search space gives approximate pairs and, from stored products, their residuals;
* pairs whose residual has reached double precision are locked, from the largest down, and taken out of the space;
* for the others the projected correction equations ``(I-ZZ')(V-eI)(I-ZZ')t = -r`` are solved by a few
  steps of MINRES, all pairs of a block in step so that each step is one distributed product;
* the corrections join the search space, which is cut back to its best pairs when it gets too wide.

Components become integers, ``floor(64 * c) + 1000000``. Sums are exact, and centring subtracts integers
before anything is rounded, so the large common offset costs no digits.

Vectors that are null, empty or hold null or non-finite components take no part, nor do those of another length
than most (ties: the longer). Equal rows are separate vectors, and a null id stays null. Components whose eigenvalue is
zero to working precision have no whitened value and are left out, so a table of equal vectors, or an empty one, gives an
empty result. Columns other than vec_id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.llm.table_kmeans import whole
from fixtrail.operators.staging import stage

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Vectors multiplied in one job.
WIDTH = 16
INNER_STEPS = 4
#: A residual this small against the largest eigenvalue counts as double precision.
PRECISION = 512 * float(np.finfo(float).eps)
_MOST_ROUNDS = 200
_BLOCK_ROWS = 4096
_LARGEST = 1 << 40
_BLOCK = "ids array<long>, x binary"
_ENTRY = "j long, value double"


def integer_vectors(table: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """vec_id and x (array of long) of the rows that take part, and how many components they have."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") > 0) & whole("x"))
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0]["dims"] if lengths else 0
    small = F.forall("x", lambda c: F.abs(c) * SCALE < _LARGEST)
    integers = F.transform("x", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + OFFSET)
    checked = F.when(small, integers).otherwise(F.raise_error(F.lit("a component is too large to be scaled")))
    return rows.where(F.size("x") == dims).select("vec_id", checked.alias("x")), dims


def _blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(start, _BLOCK_ROWS)
                x = part["x"].flatten().to_numpy(zero_copy_only=False)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part["vec_id"])
                yield pa.record_batch([ids, pa.array([x.tobytes()])], ["ids", "x"])

    return run


def _integers(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for k in range(batch.num_rows):
        yield batch["ids"][k].values, np.frombuffer(batch["x"][k].as_py(), np.int64).reshape(-1, dims)


@dataclass(frozen=True)
class Centre:
    """Number of vectors and exact sums of their components, split into integer means and rests."""

    n: int
    sums: tuple[int, ...]

    @property
    def means(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.means).astype(float) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sum of (n*x - S)**2 of each vector, exact."""
        near, rests = x - self.means, self.rests
        if len(near) and (self.n * (float(np.abs(near).max()) + 1)) ** 2 * near.shape[1] < 2.0**62:
            squares = ((self.n * near - rests) ** 2).sum(1).tolist()
        else:  # beyond 64 bits
            exact = self.n * near.astype(object) - rests.astype(object)
            squares = (exact * exact).sum(1).tolist() if len(near) else []
        return [Decimal(int(s)) for s in squares]


def centre_of(blocks: DataFrame, dims: int) -> Centre | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for _, x in _integers(batch, dims):
                total, n = total + x.sum(0), n + len(x)
        yield pa.record_batch([pa.array(np.arange(dims, dtype=np.int32)), pa.array(total), pa.array([n] * dims, pa.int64())], ["dim", "total", "n"])

    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    rows = blocks.mapInArrow(run, "dim int, total long, n long").groupBy("dim").agg(exact, F.sum("n").alias("n"))
    found = sorted(rows.collect(), key=lambda r: r["dim"])
    return Centre(found[0]["n"], tuple(int(r["total"]) for r in found)) if found and found[0]["n"] else None


def _summed(blocks: DataFrame, dims: int, entries: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of what ``part`` makes of a block of integers: ``entries`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(entries)
        for batch in batches:
            for _, x in _integers(batch, dims):
                total += part(x).ravel()
        yield pa.record_batch([pa.array(np.arange(entries)), pa.array(total)], ["j", "value"])

    out = np.zeros(entries)
    for r in blocks.mapInArrow(run, _ENTRY).groupBy("j").agg(F.sum("value").alias("value")).collect():
        out[r["j"]] = r["value"]
    return out


class Covariance:
    """The covariance of all vectors as a product with a block of vectors."""

    def __init__(self, blocks: DataFrame, dims: int, centre: Centre) -> None:
        self._blocks, self.dims, self._centre = blocks, dims, centre

    def __call__(self, block: np.ndarray) -> np.ndarray:
        centre, width = self._centre, block.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ block)

        return _summed(self._blocks, self.dims, self.dims * width, part).reshape(self.dims, width) / centre.n

    def trace(self) -> float:
        centre = self._centre
        return float(_summed(self._blocks, self.dims, self.dims, lambda x: (centre.centred(x) ** 2).sum(0)).sum() / centre.n)


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, enough: float = 0.05) -> np.ndarray:
    """Solutions of symmetric systems, one a column, all advanced by the same products."""
    x, w, w_before = (np.zeros_like(right) for _ in range(3))
    r_before = r = y = right
    beta = np.linalg.norm(right, axis=0)
    first, beta_before = np.maximum(beta, 1e-300), np.ones_like(beta)
    epsilon = turned = sine = np.zeros_like(beta)
    cosine, left = -np.ones_like(beta), beta.copy()
    for step in range(steps):
        live = beta > 1e-14 * first
        if not (live & (left > enough * first)).any():
            break
        scale = np.where(live, beta, 1.0)
        v = np.where(live, y / scale, 0.0)
        y = apply(v)
        if step:
            y = y - r_before * (beta / beta_before)
        alpha = (v * y).sum(0)
        y = y - r * (alpha / scale)
        r_before, r = r, y
        beta_before, beta = scale, np.linalg.norm(y, axis=0)
        epsilon_before = epsilon
        delta = cosine * turned + sine * alpha
        bar = sine * turned - cosine * alpha
        epsilon, turned = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(bar, beta), 1e-300)
        cosine, sine = bar / gamma, beta / gamma
        phi, left = cosine * left, sine * left
        w_before, w = w, (v - epsilon_before * w_before - delta * w) / gamma
        x = x + np.where(live, phi * w, 0.0)
    return x


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the spaces given."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
    for _ in range(3):
        for space in against:
            block = block - space @ (space.T @ block)
        left, size, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, size > 1e-10]
    return block


def largest_pairs(
    product: Callable[[np.ndarray], np.ndarray],
    dims: int,
    wanted: int,
    width: int = WIDTH,
    steps: int = INNER_STEPS,
    precision: float = PRECISION,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    wanted = min(wanted, dims)
    widest = wanted + 4 * width
    space = orthonormal(np.random.default_rng(11).standard_normal((dims, min(width, dims))))
    image = product(space)
    locked, values = np.empty((dims, 0)), np.empty(0)
    largest = 0.0
    for _ in range(_MOST_ROUNDS):
        inside = space.T @ image
        theta, turn = np.linalg.eigh((inside + inside.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        largest = max(largest, float(np.abs(theta).max(initial=0.0)), float(values.max(initial=0.0)))
        good = size <= max(precision * largest, 1e-300)
        complete = space.shape[1] + locked.shape[1] == dims
        # locked from the largest down; past the wanted number only what belongs before a locked pair
        take = 0
        while take < len(theta) and good[take] and (len(values) < wanted or theta[take] > values.min()):
            locked, values = np.column_stack([locked, space[:, take]]), np.append(values, theta[take])
            take += 1
        space, image, theta, residual = space[:, take:], image[:, take:], theta[take:], residual[:, take:]
        ahead = len(theta) and len(values) and theta[0] > values.min()
        if len(values) >= wanted and not ahead or len(values) == dims:
            order = np.argsort(-values, kind="stable")[:wanted]
            return values[order], locked[:, order]
        if complete and not take:
            raise ArithmeticError(f"residual {size[0]:.3g} with all dimensions searched, eigenvalue {theta[0]:.3g}")
        if space.shape[1] > widest:
            keep = wanted - len(values) + width
            space, image, theta, residual = space[:, :keep], image[:, :keep], theta[:keep], residual[:, :keep]
        active = space[:, :width]
        shift = theta[: active.shape[1]]
        outside = np.column_stack([locked, active])

        def corrected(t: np.ndarray, outside=outside, shift=shift) -> np.ndarray:
            t = t - outside @ (outside.T @ t)
            y = product(t) - t * shift
            return y - outside @ (outside.T @ y)

        right = residual[:, : active.shape[1]]
        right = right - outside @ (outside.T @ right)
        if active.shape[1]:
            found = minres(corrected, -right, steps)
        else:
            found = np.random.default_rng(len(values)).standard_normal((dims, width))
        more = orthonormal(np.where(np.isfinite(found), found, 0.0), locked, space)
        room = dims - locked.shape[1] - space.shape[1]
        if more.shape[1] == 0 and room:
            more = orthonormal(np.random.default_rng(dims + len(values)).standard_normal((dims, min(width, room))), locked, space)
        more = more[:, :room]
        if more.shape[1]:
            space, image = np.column_stack([space, more]), np.column_stack([image, product(more)])
    raise ArithmeticError(f"{len(values)} of {wanted} eigenvectors after {_MOST_ROUNDS} rounds")


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained and identity_error for each vector and component."""
    vectors, dims = integer_vectors(table, vector)
    blocks = stage(vectors.mapInArrow(_blocks(dims), _BLOCK), "integer_blocks")
    centre = centre_of(blocks, dims) if dims else None
    values, basis, trace = np.empty(0), np.empty((dims, 0)), 0.0
    if centre is not None:
        covariance = Covariance(blocks, dims, centre)
        trace = covariance.trace()
    if trace > 0:
        values, basis = largest_pairs(covariance, dims, components)
        there = values > dims * PRECISION * values[0]
        values, basis = values[there], basis[:, there]
    width = len(values)
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(width)] < 0, -1.0, 1.0) if width else basis
    map_ = basis / np.sqrt(values)
    error = 0.0
    if width:

        def moments(x: np.ndarray) -> np.ndarray:
            w = centre.centred(x) @ map_
            return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

        found = _summed(blocks, dims, width * width + width, moments) / centre.n
        mean = found[width * width :]
        error = float(np.abs(found[: width * width].reshape(width, width) - np.outer(mean, mean) - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _integers(batch, dims) if width else ():
                ends = pa.array(np.arange(0, (len(x) + 1) * width, width, dtype=np.int32))
                white = pa.ListArray.from_arrays(ends, pa.array((centre.centred(x) @ map_).ravel()))
                columns = [ids, pa.array(centre.deviations(x), pa.decimal128(38, 0)), white]
                yield pa.record_batch(columns, ["vec_id", "deviation", "white"])

    rows = blocks.mapInArrow(run, "vec_id long, deviation decimal(38,0), white array<double>")
    shares = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(centre.n if centre else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.try_element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
