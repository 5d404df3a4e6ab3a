"""Approximate nearest neighbours by cosine: inverted lists, scanned with adaptive dimension sampling.

Vectors are scaled to length one and turned by a fixed random rotation, so that the first dimensions of any
difference are a fair sample of all. K-means on a bounded sample cuts the space into lists; a vector goes to the
list of its nearest centroid, a query probes the lists nearest to it. Within a list the rotated vectors lie in
column blocks. After each block the partial squared distance of every candidate still in the race is put to a
test: scaled up to all dimensions, it exceeds the k-th best distance by more than its error bound
(1 + EPSILON / sqrt(dimensions seen))^2 only if the whole distance very likely does too; such candidates are
abandoned. What is left is scored exactly, in double precision, on the original vectors.

Lists are split into slices of bounded size, so a list with a third of all rows is many tasks. Queries travel to
the slices of their lists, k results a slice travel back.

Vectors that are NULL, zero, or hold a NULL or non-finite component take no part, as queries or candidates;
nor do vectors whose dimension is not the commonest one (ties: the larger). An empty table gives no rows. Ties
go to the smaller id; repeated rows are candidates of their own, and a query leaves out every row with its own id.
An id that is a query several times asks once, with the least of its vectors.
Further columns are ignored, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import materialise

#: Sampled rows for k-means, rounds, and the most lists: the bounds of what the driver holds and tasks receive.
SAMPLE_ROWS, ROUNDS, MOST_LISTS = 20_000, 12, 4096
SLICE_ROWS = 4096
#: Lists that a query probes, and the rows that they hold at least: set for a recall well over 0.9 on vectors
#: with little structure.
PROBE_SHARE, LEAST_ROWS = 0.75, 4096
BLOCK_DIMS = 16
#: Of the test: larger abandons later and misses less.
EPSILON = 2.1


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the vectors that take part."""
    x = F.col("vec")
    finite = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix of rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(d: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def fit_centroids(vectors: DataFrame, n_lists: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means over the SAMPLE_ROWS rows with the smallest hash of their id."""
    rows = vectors.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE_ROWS).select("vec").toArrow()
    x = unit(matrix(rows.column("vec")))
    start = np.random.default_rng(seed).permutation(len(x))[:n_lists]
    centres = x[start]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def _assigned(centres: np.ndarray):
    """For rows: the list of the nearest centroid."""
    @F.arrow_udf("int")
    def run(vec: pa.Array) -> pa.Array:
        return pa.array((unit(matrix(vec)) @ centres.T).argmax(axis=1).astype(np.int32) if len(vec) else [], pa.int32())
    return run


def _cells(slices: np.ndarray):
    """For rows: list and slice as one number, `draw` choosing the slice."""
    first = np.cumsum(slices) - slices

    @F.arrow_udf("long")
    def run(lists: pa.Array, draw: pa.Array) -> pa.Array:
        lists, draw = lists.to_numpy(), draw.to_numpy()
        return pa.array(first[lists] + draw % slices[lists], pa.int64())
    return run


def _probed(centres: np.ndarray, sizes: np.ndarray, slices: np.ndarray, probes: int, least: int):
    """For queries: all slices of the lists probed: `probes`, and more until they hold `least` rows."""
    first = np.cumsum(slices) - slices

    @F.arrow_udf("array<long>")
    def run(vec: pa.Array) -> pa.Array:
        out = []
        for near in unit(matrix(vec)) @ centres.T if len(vec) else ():
            order = np.argsort(-near, kind="stable")
            seen = np.cumsum(sizes[order]) - sizes[order]
            take = order[(np.arange(len(order)) < probes) | (seen < least)]
            out.append(np.concatenate([np.arange(first[c], first[c] + slices[c]) for c in take]))
        return pa.array(out, pa.list_(pa.int64()))
    return run


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of one query with rows, in double precision; the same for equal rows wherever they stand."""
    s, t = np.abs(q).max(), np.abs(x).max(axis=1)
    q, x = q / s, x / t[:, None]
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def scan(q: np.ndarray, blocks: list[np.ndarray], first: np.ndarray, k: int, epsilon: float = EPSILON) -> np.ndarray:
    """Places of the candidates that survive the tests for one rotated query.

    `blocks` hold the rotated vectors, dimensions by rows; `first` are the places scanned whole to get a bound.
    """
    d = sum(len(b) for b in blocks)
    whole = sum((((b[:, first] - q[a : a + len(b), None]) ** 2).sum(axis=0) for a, b in zip(_starts(blocks), blocks, strict=True)), np.zeros(len(first)))
    if len(first) < k:
        return np.arange(blocks[0].shape[1])
    bound = np.partition(whole, k - 1)[k - 1]
    alive, part, seen = np.arange(blocks[0].shape[1]), np.zeros(blocks[0].shape[1]), 0
    for b in blocks:
        part = part + ((b[:, alive] - q[seen : seen + len(b), None]) ** 2).sum(axis=0)
        seen += len(b)
        slack = (1 + epsilon / np.sqrt(seen)) ** 2 if seen < d else 1 + 1e-9
        keep = part * d / seen <= bound * slack + 1e-12
        alive, part = alive[keep], part[keep]
        if seen < d and len(alive) <= k:
            break
    return alive


def _starts(blocks: list[np.ndarray]) -> list[int]:
    return np.cumsum([0, *[len(b) for b in blocks[:-1]]]).tolist()


def _search(k: int, block_dims: int, epsilon: float):
    """For cogroup: the queries probing one slice against its rows."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            raw, qraw = matrix(rows.column("vec")), matrix(queries.column("vec"))
            ids, qids = rows.column("id").to_numpy(), queries.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            raw, ids = raw[order], ids[order]
            turn = rotation(raw.shape[1])
            turned, qturned = (unit(raw) @ turn).T, unit(qraw) @ turn
            blocks = [np.ascontiguousarray(turned[a : a + block_dims]) for a in range(0, len(turned), block_dims)]
            for q, qid, own in zip(qturned, qids, qraw, strict=True):
                other = np.flatnonzero(ids != qid)
                # The rows nearest in the first block set the bound.
                near = ((blocks[0] - q[: len(blocks[0]), None]) ** 2).sum(axis=0)[other]
                first = other[np.argpartition(near, min(4 * k, len(other) - 1))[: 4 * k]] if len(other) else other
                left = scan(q, blocks, first, k, epsilon)
                left = left[ids[left] != qid]
                exact = cosine(own, raw[left])
                best = np.lexsort((ids[left], -exact))[:k]
                out["query_id"] += [qid] * len(best)
                out["vec_id"] += ids[left][best].tolist()
                out["score"] += exact[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})
    return run


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            n_lists: int | None = None, probe_share: float = PROBE_SHARE, least_rows: int = LEAST_ROWS, epsilon: float = EPSILON) -> DataFrame:
    """The k nearest other rows of each row for which `is_query` (over a column `id`) holds.

    There are about sqrt(rows) / 4 lists, at most MOST_LISTS; a query probes `probe_share` of them, and more until
    they hold `least_rows` rows (k besides its own at least). Returns query_id, rank from 1, vec_id, score.
    """
    vectors = valid_vectors(df, id_col, vec_col)
    spark, n = df.sparkSession, vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = n_lists or int(min(MOST_LISTS, max(1, round(n**0.5 / 4))))
    centres = fit_centroids(vectors, lists)
    index = materialise(vectors.withColumn("list", _assigned(centres)("vec")), "ads-index")
    sizes = np.zeros(len(centres), np.int64)
    for row in index.groupBy("list").count().collect():  # at most MOST_LISTS numbers
        sizes[row["list"]] = row["count"]
    slices = -(-sizes // SLICE_ROWS)
    probes = max(1, round(len(centres) * probe_share))
    asked = index.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    # So many parts of the queries that one slice meets about SLICE_ROWS of them at once.
    parts = -(-asked.count() * probes // (len(centres) * SLICE_ROWS)) or 1
    sent = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(parts)))
    sent = sent.withColumn("cell", F.explode(_probed(centres, sizes, slices, probes, max(least_rows, k + 2))("vec")))
    draw = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 40))
    rows = index.select("id", "vec", _cells(slices)("list", draw).alias("cell"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    found = sent.groupBy("cell", "part").cogroup(rows.groupBy("cell", "part")).applyInArrow(
        _search(k, BLOCK_DIMS, epsilon), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
