"""Whitening of vectors on their leading principal components, found by spectrum slicing.

Moments are summed in tasks and merged in Spark; the driver holds matrices of the vectors'
length, whatever the number of rows. The number of eigenvalues above a shift is read from
the signs of the pivots of an LDLᵀ factorisation of the shifted covariance (Sylvester's law of
inertia). Bisection on those counts isolates each leading eigenvalue, Rayleigh quotient
iteration then converges cubically to it, and counts on both sides of what it found certify
its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Entries whose quantised value lies beyond this are taken as this: doubles hold all integers up to it.
LARGEST = 2 ** 53
# Rows of a batch that are multiplied together.
ROWS = 4096


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are positive, zero and negative.

    LDLᵀ from the last row upwards, with pivots of one or two rows (Bunch and Kaufman).
    """
    a, m = np.array(matrix, np.float64), len(matrix)
    positive = zero = negative = 0
    growth = (1 + 17 ** 0.5) / 8
    while m:
        j = m - 1
        own = abs(a[j, j])
        r = int(np.argmax(np.abs(a[:j, j]))) if j else 0
        most = abs(a[r, j]) if j else 0.0
        if max(own, most) < np.finfo(np.float64).tiny:
            zero, m = zero + 1, m - 1
            continue
        single = own >= growth * most
        if not single:
            others = np.abs(a[:m, r])
            others[r] = 0
            if own * others.max() >= growth * most ** 2:
                single = True
            elif abs(a[r, r]) >= growth * others.max():
                _swap(a[:m, :m], r, j)
                single = True
            else:
                _swap(a[:m, :m], r, j - 1)
        if single:
            column, pivot = a[:j, j].copy(), a[j, j]
            a[:j, :j] -= np.outer(column, column / pivot)
            positive, negative, m = positive + (pivot > 0), negative + (pivot < 0), m - 1
        else:  # such a block has an eigenvalue of each sign
            pivot, columns = a[j - 1:m, j - 1:m].copy(), a[:j - 1, j - 1:m].copy()
            a[:j - 1, :j - 1] -= columns @ np.linalg.solve(pivot, columns.T)
            positive, negative, m = positive + 1, negative + 1, m - 2
    return int(positive), int(zero), int(negative)


class Spectrum:
    """Counts of the eigenvalues of a symmetric matrix above shifts; those already made narrow the search."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0))
        # Gershgorin's circles hold all eigenvalues.
        margin = self.norm * 1e-12 + np.finfo(float).tiny
        self.counts = {
            float((np.diag(matrix) - radius).min()) - margin: len(matrix),
            float((np.diag(matrix) + radius).max()) + margin: 0,
        }
        # Shifts that are closer than this cannot be told apart.
        self.least = max(self.norm, np.finfo(float).tiny) * 4 * np.finfo(float).eps * max(1, len(matrix)) ** 0.5

    def above(self, shift: float) -> int:
        """Eigenvalues above ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = inertia(self.matrix - shift * np.eye(len(self.matrix)))[0]
        return self.counts[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """Known shifts around the ``k``-th largest eigenvalue (from 1)."""
        low = max(s for s, n in self.counts.items() if n >= k)
        high = min(s for s, n in self.counts.items() if n < k and s > low)
        return low, high

    def isolate(self, k: int) -> tuple[float, float]:
        """An interval that holds the ``k``-th eigenvalue and no other that can be told from it."""
        while True:
            low, high = self.bracket(k)
            if self.above(low) == k and self.above(high) == k - 1 or high - low <= self.least:
                return low, high
            self.above((low + high) / 2)

    def halve(self, k: int) -> bool:
        """Narrow the bracket of an eigenvalue, unless it is as narrow as can be."""
        low, high = self.bracket(k)
        if high - low <= self.least:
            return False
        self.above((low + high) / 2)
        return True


def _free_of(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """The unit vector's part that is orthogonal to all ``found``."""
    for _ in range(2):
        for other in found:
            vector = vector - other * (other @ vector)
    size = np.linalg.norm(vector)
    return vector / size if size > 0 else vector


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    """Inverse iteration; a shift that is an eigenvalue is moved by a rounding error."""
    step = np.finfo(float).eps * max(1.0, float(np.abs(matrix).max(initial=0)))
    for _ in range(60):
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), vector)
            if np.isfinite(found).all():
                found = found / np.abs(found).max()
                return found / np.linalg.norm(found)
        except np.linalg.LinAlgError:
            pass
        shift, step = shift + step, 2 * step
    return vector


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors in columns.

    Of eigenvalues that rounding makes one, any orthonormal basis is given.
    """
    # Scaled by a power of two, so that no product leaves the range of doubles.
    exponent = int(np.frexp(np.abs(matrix).max(initial=0))[1])
    matrix = np.ldexp((matrix + matrix.T) / 2, -exponent)
    spectrum, vectors, values = Spectrum(matrix), [], []
    random = np.random.default_rng(len(matrix))
    for number in range(1, min(k, len(matrix)) + 1):
        spectrum.isolate(number)
        while True:
            low, high = spectrum.bracket(number)
            vector = _free_of(random.standard_normal(len(matrix)), vectors)
            for _ in range(2):  # inverse iteration at the middle of the interval
                vector = _free_of(_solve(matrix, (low + high) / 2, vector), vectors)
            value, before = float(vector @ matrix @ vector), np.inf
            for _ in range(12):
                residual = float(np.linalg.norm(matrix @ vector - value * vector))
                if residual <= spectrum.least or residual >= before / 2:
                    break
                before = residual
                vector = _free_of(_solve(matrix, value, vector), vectors)
                value = float(vector @ matrix @ vector)
            # The counts just below and above certify the number.
            slack = 4 * spectrum.least
            if spectrum.above(value - slack) >= number > spectrum.above(value + slack):
                break
            if not spectrum.halve(number):
                break
        vectors.append(vector)
        values.append(value)
    order = np.argsort([-v for v in values], kind="stable")
    if not values:
        return np.zeros(0), np.zeros((len(matrix), 0))
    return np.ldexp(np.array(values)[order], exponent), np.stack(vectors, axis=1)[:, order]


@dataclass
class Whitening:
    """What the driver keeps of the vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    largest: int
    identity_error: float = 0.0

    @property
    def usable(self) -> np.ndarray:
        """Components along which the vectors differ by more than rounding."""
        return self.values > self.trace * len(self.mean) * 2.0 ** -50

    @property
    def projection(self) -> np.ndarray:
        scale = np.where(self.usable, np.sqrt(np.where(self.usable, self.values, 1)), np.inf)
        return self.vectors / scale


def quantised(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id, x array<bigint>`` of the vectors without null or non-finite entries, as long integers."""
    vector = F.col(vector_column).cast("array<double>")
    usable = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))

    def whole(v: Column) -> Column:
        limit = F.lit(float(LARGEST - SHIFT))
        return F.floor(F.greatest(-limit, F.least(limit, v * SCALE))) + SHIFT

    rows = embeddings.where(F.col(vector_column).isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select(F.col(id_column).alias("id"), F.transform(vector, whole).alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of the batch, by length, some thousand rows at a time."""
    vectors = batch.column("x")
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), ROWS):
            own = rows[at:at + ROWS]
            yield own, vectors.take(pa.array(own)).flatten().to_numpy().reshape(len(own), int(size))


def _merged(parts: DataFrame) -> DataFrame:
    """Partial sums (``size, values``) added up: first those of some tasks, then entry by entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, values in zip(batch.column("size").to_pylist(), batch.column("part")):
                own = values.values.to_numpy()
                sums[size] = sums[size] + own if size in sums else own.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["size", "part"]
        )

    few = max(1, round(parts.sparkSession.sparkContext.defaultParallelism ** 0.5))
    added = parts.repartition(few).mapInArrow(add, "size int, part array<double>")
    return added.select("size", F.posexplode("part").alias("place", "value")).groupBy("size", "place").agg(F.sum("value").alias("value"))


def _collected(parts: DataFrame) -> dict[int, np.ndarray]:
    """Merged sums by vector length; as many numbers as a matrix of that length has."""
    found: dict[int, dict[int, float]] = {}
    for size, place, value in _merged(parts).collect():
        found.setdefault(size, {})[place] = value
    return {size: np.array([own[k] for k in range(len(own))]) for size, own in found.items()}


def _products(rows: DataFrame, centres: dict[int, np.ndarray], projections: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """Sums over all rows of the products of their centred (and projected) entries, by length.

    With projections the sums of the entries come first, since rounding leaves them off zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                size = x.shape[1]
                own = x - centres[size]
                if projections is not None:
                    own = own @ projections[size]
                made = own.T @ own
                made = np.concatenate([own.sum(axis=0), made.ravel()]) if projections is not None else made.ravel()
                sums[size] = sums[size] + made if size in sums else made
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["size", "part"]
        )

    return _collected(rows.select("x").mapInArrow(run, "size int, part array<double>"))


def fit(rows: DataFrame, k: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of the vectors of each length, by three passes over the rows of ``quantised``.

    Sums are exact, and products are of entries centred before. ``identity_error`` is the
    largest entry of the covariance of what the rows become, less the identity.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                # Upper and lower bits apart, so that sums stay within 64 bits.
                own = [len(x), int(np.abs(x).max(initial=0)), (x >> 27).sum(axis=0), (x & ((1 << 27) - 1)).sum(axis=0)]
                before = found.get(x.shape[1])
                found[x.shape[1]] = [own[0] + before[0], max(own[1], before[1]), own[2] + before[2], own[3] + before[3]] if before else own
        columns = list(zip(*found.values())) or [()] * 4
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), *(pa.array(list(columns[c]), t) for c, t in enumerate((pa.int64(), pa.int64(), longs, longs)))],
            ["size", "n", "largest", "high", "low"],
        )

    parts = rows.select("x").mapInArrow(totals, "size int, n long, largest long, high array<long>, low array<long>")
    spread = parts.select("size", "n", "largest", F.posexplode(F.arrays_zip("high", "low")).alias("place", "halves"))
    exact = [F.sum(F.col(f"halves.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    whole: dict[int, dict[int, tuple]] = {}
    for size, place, *row in spread.groupBy("size", "place").agg(F.sum("n"), F.max("largest"), *exact).collect():
        whole.setdefault(size, {})[place] = row
    fits = {}
    for size, own in whole.items():
        n, largest = own[0][0], own[0][1]
        sums = [(int(own[p][2]) << 27) + int(own[p][3]) for p in range(size)]
        fits[size] = Whitening(n, sums, np.array([_ratio(s, n) for s in sums]), np.zeros(0), np.zeros((size, 0)), 0.0, largest)
    for size, products in _products(rows, {s: f.mean for s, f in fits.items()}).items():
        covariance = products.reshape(size, size) / fits[size].n
        fits[size].trace = float(np.trace(covariance))
        fits[size].values, fits[size].vectors = leading(covariance, k)
    made = _products(rows, {s: f.mean for s, f in fits.items()}, {s: f.projection for s, f in fits.items()})
    worst = 0.0
    for size, products in made.items():
        own, width = fits[size], len(fits[size].values)
        mean = products[:width] / own.n
        covariance = products[width:].reshape(width, width) / own.n - np.outer(mean, mean)
        off = np.abs(covariance - np.eye(width))[np.ix_(own.usable, own.usable)]
        worst = max(worst, float(off.max(initial=0)))
    for own in fits.values():
        own.identity_error = worst
    return fits


def _ratio(total: int, n: int) -> float:
    """The double next to an exact quotient."""
    whole, rest = divmod(total, n)
    return whole + rest / n


def _deviations(x: np.ndarray, own: Whitening) -> list[int | None]:
    """Exact sums over the entries of (n x - S)², None where one does not fit in 64 bits."""
    exact = None
    if own.n * own.largest < 2 ** 61:
        away = x * own.n - np.array(own.sums, np.int64)
        size = (away.astype(np.float64) ** 2).sum(axis=1)
        exact = (away * away).sum(axis=1)
    out = []
    for row in range(len(x)):
        if exact is not None and size[row] < 2.0 ** 62:
            out.append(int(exact[row]))
        else:
            total = sum((own.n * int(v) - s) ** 2 for v, s in zip(x[row], own.sums))
            out.append(total if total < 2 ** 63 else None)
    return out


def whiten(embeddings: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """A row for each vector and leading component: id, ``component int`` (from 1), ``n long``,
    ``deviation long``, ``whitened double``, ``explained double``, ``identity_error double``.

    An entry c becomes x = floor(1024 c) + 100000. Vectors that are null or hold null or
    non-finite entries are dropped; all others are the fit list, n of them with sums S. Components are
    unit eigenvectors of the covariance of x, numbered by falling eigenvalue e; ``whitened`` is x - S/n
    projected on one, over sqrt(e); ``explained`` is e over the trace; ``deviation`` is the exact sum of
    (n x - S)², null beyond 64 bits. Where all vectors agree along a component but for
    rounding (as with one vector, or fewer vectors than components), ``whitened`` is null and
    ``identity_error`` leaves it out; without any variance ``explained`` is 0. Vectors of
    different lengths are fitted by length, ``identity_error`` being the largest; vectors without
    entries have no components. Ids may be null or repeat, each row counts; an empty table gives
    no rows. Entries whose x is beyond 2**53 are taken as 2**53.
    """
    rows = quantised(embeddings, id_column, vector_column)
    kind = rows.schema["id"].dataType.simpleString()
    fits = fit(rows, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in _matrices(batch):
                own = fits[x.shape[1]]
                width = len(own.values)
                white = (x - own.mean) @ own.projection
                unknown = np.broadcast_to(~own.usable, white.shape).ravel()
                explained = own.values / own.trace if own.trace > 0 else np.zeros(width)
                owner = pa.array(np.repeat(places, width))
                deviations = pa.array(_deviations(x, own), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), width)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(owner), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(owner), own.n)), deviations, pa.array(white.ravel(), mask=unknown),
                        pa.array(np.tile(explained, len(x))), pa.array(np.full(len(owner), own.identity_error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    made = rows.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return made.withColumnRenamed("id", id_column)
