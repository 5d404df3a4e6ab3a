"""Whitening of embeddings from variances only: the polarisation identity gives every covariance.

A component c becomes the integer x = floor(1024 * c) + 100000. A first pass sums x by dimension. A second takes
each x less the integer nearest to its mean, z, and sums the squares z_i^2 of every dimension and (z_i + z_j)^2 of
every pair of dimensions. What the mean is off that integer by is then taken away exactly, in whole numbers; so
these are the variances of x_i and of x_i + x_j, and cov(x_i, x_j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2.
All sums are exact whole numbers of any size (limbs of 40 bits), each covariance is rounded once, and `eigh` of
the assembled matrix gives the components. Only the sums, two for each pair of dimensions, reach the driver; tasks
hand theirs on in groups first.

Vectors that are NULL or hold a NULL or non-finite component take no part; nor do those with a component of 2^50
or more in size, whose x has no exact 64-bit form, nor those whose dimension is not the commonest one (ties: the
larger; empty vectors have none). Repeated rows count each. A NULL id is kept. A component without variance (no
more than 1e-12 of the largest eigenvalue) has NULL in place of whitened values and no part in the identity
error. An empty table gives no rows. Further columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024.0, 100_000
#: Components returned for each vector.
COMPONENTS = 8
LARGEST = 2.0**50
ROWS_AT_ONCE = 256
#: Groups in which the tasks' sums are added up, and the limbs of a sum.
GROUPS, LIMBS, LIMB_BITS = 64, 5, 40
NO_VARIANCE = 1e-12


@dataclass
class Whitening:
    """A fit: `n` vectors with sums `total` (exact, by dimension), eigenvalues by falling size and their vectors as columns."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The integers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.total], np.int64)

    @property
    def off(self) -> list[int]:
        """n times what each mean is below its centre, exactly."""
        return [self.n * int(c) - s for c, s in zip(self.centre, self.total, strict=True)]

    def usable(self) -> np.ndarray:
        return self.values > NO_VARIANCE * max(self.values[0], 0.0)

    def whitened(self, x: np.ndarray, components: int = COMPONENTS) -> np.ndarray:
        """Whitened coordinates of integer vectors; NaN for a component without variance."""
        y = (x - self.centre) + np.array([o / self.n for o in self.off])
        out = y @ self.vectors[:, :components]
        ok = self.usable()[:components]
        return np.where(ok, out / np.sqrt(np.where(ok, self.values[:components], 1.0)), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2, exact; None where 64 bits don't hold it."""
        z, off = x - self.centre, self.off
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if len(off) * most * most < 1 << 62:
            return ((self.n * z + np.array(off, np.int64)) ** 2).sum(axis=1).tolist()
        whole = [sum((self.n * v + o) ** 2 for v, o in zip(row, off, strict=True)) for row in z.tolist()]
        return [v if v < 1 << 63 else None for v in whole]


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec array<double>) of the vectors that take part, but for their dimension."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda v: F.coalesce((F.abs(v) < LARGEST) & ~F.isnan(v), F.lit(False)))
    return rows.filter(F.col("vec").isNotNull() & fine & (F.size("vec") > 0))


def _integers(column: pa.Array) -> np.ndarray:
    """Rows of x from lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(len(column), -1)


def _batches(batches: Iterator[pa.RecordBatch], d: int | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors, of `d` dimensions or of any one number of them at a time."""
    for batch in batches:
        vec = batch.column("vec")
        size = np.diff(np.asarray(vec.offsets))
        for own in [d] if d else np.unique(size).tolist():
            at = pa.array(np.flatnonzero(size == own))
            for a in range(0, len(at), ROWS_AT_ONCE):
                rows = at.slice(a, ROWS_AT_ONCE)
                yield batch.column("id").take(rows), _integers(vec.take(rows))


def _limbs(values: list[int]) -> np.ndarray:
    """Whole numbers as rows of limbs; the last one takes the sign."""
    mask = (1 << LIMB_BITS) - 1
    return np.array([[v >> LIMB_BITS * k & mask for k in range(LIMBS - 1)] + [v >> LIMB_BITS * (LIMBS - 1)] for v in values], np.int64)


def _number(limbs: list[int]) -> int:
    return sum(v << LIMB_BITS * k for k, v in enumerate(limbs))


def _column_sums(x: np.ndarray) -> list[int]:
    """Exact sums of columns, of at most ROWS_AT_ONCE rows."""
    return x.sum(axis=0).tolist() if np.abs(x).max(initial=0) < 1 << 52 else x.astype(object).sum(axis=0).tolist()


def _pair_squares(z: np.ndarray) -> list[int]:
    """Sums of z_i^2 (for j = i) and of (z_i + z_j)^2, j > i, row by row of the upper triangle."""
    if np.abs(z).max(initial=0) >= 1 << 25:
        z = z.astype(object)
    out: list[int] = []
    for i in range(z.shape[1]):
        both = z[:, i:] + z[:, i : i + 1]
        both[:, 0] = z[:, i]
        out += (both * both).sum(axis=0).tolist()
    return out


def _summed(rows: DataFrame, of, d: int | None) -> list[tuple[int, int, list[int]]]:
    """(dimensions, rows, exact sums) of what `of` gives for integer vectors, added up over the tasks' groups."""
    schema = f"task int, d int, n long, {', '.join(f'l{k} array<bigint>' for k in range(LIMBS))}"

    def record(task: int, sums: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        cols = {"task": pa.array([task] * len(sums), pa.int32()), "d": pa.array(list(sums), pa.int32()), "n": pa.array([n for n, _ in sums.values()], pa.int64())}
        return pa.RecordBatch.from_pydict(cols | {f"l{k}": pa.array([x[:, k] for _, x in sums.values()], pa.list_(pa.int64())) for k in range(LIMBS)})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums: dict[int, tuple[int, list[int]]] = {}
        for _, x in _batches(batches, d):
            n, have = sums.get(x.shape[1], (0, None))
            own = of(x)
            sums[x.shape[1]] = (n + len(x), own if have is None else [a + b for a, b in zip(have, own, strict=True)])
        yield record(TaskContext.get().partitionId() % GROUPS, {k: (n, _limbs(v)) for k, (n, v) in sums.items()})

    def combined(table: pa.Table) -> pa.Table:
        task, out = table.column("task")[0].as_py(), {}
        for batch in table.to_batches():
            for i in range(batch.num_rows):
                k = batch.column("d")[i].as_py()
                # Limbs add up like numbers; 2^23 tasks' limbs of 40 bits fit 64.
                own = np.stack([batch.column(f"l{j}")[i].values.to_numpy() for j in range(LIMBS)], axis=1)
                n, have = out.get(k, (0, 0))
                out[k] = (n + batch.column("n")[i].as_py(), have + own)
        return pa.Table.from_batches([record(task, out)])

    got = rows.mapInArrow(partial, schema).groupBy("task").applyInArrow(combined, schema).toArrow()
    totals: dict[int, tuple[int, np.ndarray]] = {}
    for row in got.to_pylist():
        own = np.array([row[f"l{k}"] for k in range(LIMBS)], np.int64).T
        n, have = totals.get(row["d"], (0, 0))
        totals[row["d"]] = (n + row["n"], have + own)
    return [(k, n, [_number(x) for x in limbs.tolist()]) for k, (n, limbs) in totals.items()]


def covariances(n: int, off: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix from the squares' sums of centred dimensions and pair sums, each entry rounded once.

    `off` is minus the sum of each z, so n * squares - off^2 is n^2 times a variance.
    """
    d = len(off)
    place = lambda i, j: i * d - i * (i - 1) // 2 + j - i
    own = [n * squares[place(i, i)] - off[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[place(i, j)] - (off[i] + off[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return out


def fit(vectors: DataFrame) -> Whitening | None:
    """From (id, vec); None without vectors."""
    sums = _summed(vectors, _column_sums, None)
    if not sums:
        return None
    d, n, total = max(sums, key=lambda s: (s[1], s[0]))
    fitted = Whitening(n, total, np.zeros(d), np.eye(d), 0.0)
    centre = fitted.centre
    squares = _summed(vectors, lambda x: _pair_squares(x - centre), d)[0][2]
    v = covariances(n, fitted.off, squares)
    values, columns = np.linalg.eigh(v)
    columns = columns[:, ::-1]
    # Either sign will do: the largest entry is positive.
    sign = np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(d)])
    return Whitening(n, total, values[::-1], columns * np.where(sign == 0, 1, sign), float(np.trace(v)))


def identity_error(vectors: DataFrame, fitted: Whitening, components: int = COMPONENTS) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance less the identity, measured over all of them."""
    d = len(fitted.total)
    k = min(components, d)
    ok = np.flatnonzero(fitted.usable()[:k])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums, n = np.zeros((k + 1, k)), 0
        for _, x in _batches(batches, d):
            w = np.nan_to_num(fitted.whitened(x, k))
            sums[0] += w.sum(axis=0)
            sums[1:] += w.T @ w
            n += len(x)
        yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()), "sums": pa.array([sums.reshape(-1)], pa.list_(pa.float64()))})

    def combined(table: pa.Table) -> pa.Table:
        own = np.sum([x.values.to_numpy() for x in table.column("sums")], axis=0)
        return pa.table({"task": table.column("task").slice(0, 1), "sums": pa.array([own], pa.list_(pa.float64()))})

    got = vectors.mapInArrow(partial, "task int, sums array<double>").groupBy("task").applyInArrow(combined, "task int, sums array<double>").toArrow()
    sums = np.sum([x.values.to_numpy() for x in got.column("sums")], axis=0).reshape(k + 1, k) / fitted.n
    gap = sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)
    return float(np.abs(gap[np.ix_(ok, ok)]).max()) if len(ok) else None


def whitened(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = whole_vectors(df, id_col, vec_col)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit(vectors)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    d = len(fitted.total)
    k = min(components, d)
    error = identity_error(vectors, fitted, k)
    explained = [float(e) / fitted.trace if fitted.trace > 0 else None for e in np.maximum(fitted.values[:k], 0)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _batches(batches, d):
            w = fitted.whitened(x, k).reshape(-1)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(w), fitted.n)), "deviation": pa.array(fitted.deviation(x), pa.int64()).take(each),
                "whitened": pa.array(w, mask=np.isnan(w)), "explained": pa.array(explained * len(x), pa.float64()),
                "identity_error": pa.array([error] * len(w), pa.float64())})

    return vectors.mapInArrow(rows, schema)
