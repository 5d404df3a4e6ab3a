"""Exact top-k by integer inner product, block at a time with term maxima.

A vector is a document of terms: dimension d with sign s is a term, of weight |x_d|. Vectors are ordered so that
alike ones stand together (by the signs of a few fixed random projections), and cut into ranges: a shard is what
one task holds, a block is BLOCK_ROWS consecutive vectors of a shard. A block has a forward index (its vectors)
and, for every term, its maximum. The sum of a query's weights with the maxima of its terms bounds every score
in the block, as a dimension whose maximum is negative lowers the bound. A query takes the blocks of a shard by
falling bound, scores each whole through its forward index, and stops when the next bound is below its k-th
score, so no answer can be missed; a block whose bound equals it is still scored, for the ties.

A first pass scores each query's best block of every shard. The k-th score over all shards is a threshold that
the second pass starts from, so that most blocks are never scored. Both passes join the queries with the shards
in blocks of bounded size, as a stated query set allows.

Components are floor(256 x). Vectors that are NULL or hold a NULL or non-finite component take no part, nor do
those of a dimension other than the commonest (ties: the larger). Zero vectors do. An empty table gives no rows.
Ties go to the smaller id; repeated rows are candidates of their own, and a query leaves out every row with its
own id; an id that is a query several times asks once, with the least of its vectors. Scores beyond 64 bits are
clipped. Further columns are ignored, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.ads import matrix
from riskspark.session import materialise

BLOCK_ROWS = 64
SHARD_ROWS, QUERIES_AT_ONCE = 8192, 4096
SCALE = 256
#: Projections whose signs order the vectors.
ORDER_BITS = 24


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<long>) of the vectors that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    rows = rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))
    return rows.withColumn("vec", F.transform("vec", lambda v: F.floor(v * SCALE)))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of a query with rows, clipped to 64 bits."""
    if q.shape[0] and float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max(initial=0)) * len(q) < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    exact = x.astype(object) @ q.astype(object) if q.shape[0] else np.zeros(len(x), object)
    return np.array([min(max(int(v), -(2**63)), 2**63 - 1) for v in exact], np.int64)


def block_bounds(q: np.ndarray, highest: np.ndarray, lowest: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores in every block. Rounding errors are far below the margin of one half."""
    up, down = np.maximum(q, 0).astype(np.float64), np.maximum(-q.astype(np.float64), 0)
    bound = highest.astype(np.float64) @ up - lowest.astype(np.float64) @ down
    size = np.abs(highest).astype(np.float64) @ up + np.abs(lowest).astype(np.float64) @ down
    return bound + 0.5 + size * 1e-12


def _order_key(vec: np.ndarray) -> np.ndarray:
    if not vec.shape[1]:
        return np.zeros(len(vec), np.int64)
    planes = np.random.default_rng(11).standard_normal((vec.shape[1], ORDER_BITS))
    return (vec.astype(np.float64) @ planes > 0) @ (1 << np.arange(ORDER_BITS)[::-1])


def order_key(vec: str) -> Column:
    @F.arrow_udf("long")
    def run(x: pa.Array) -> pa.Array:
        return pa.array(_order_key(matrix(x)) if len(x) else [], pa.int64())
    return run(vec)


def _search(k: int, only_best: bool):
    """For cogroup: some queries against one shard."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(queries) and len(rows):
            x, ids = matrix(rows.column("vec")), rows.column("id").to_numpy()
            order = np.lexsort((ids, _order_key(x)))
            x, ids = x[order], ids[order]
            starts = np.arange(0, len(x), BLOCK_ROWS)
            highest, lowest = np.maximum.reduceat(x, starts, axis=0), np.minimum.reduceat(x, starts, axis=0)
            floors = queries.column("floor").to_pylist()
            for q, qid, floor in zip(matrix(queries.column("vec")), queries.column("id").to_numpy(), floors, strict=True):
                bounds = block_bounds(q, highest, lowest)
                scores, names = np.empty(0, np.int64), np.empty(0, np.int64)
                for b in np.argsort(-bounds, kind="stable"):
                    least = int(scores[k - 1]) if len(scores) >= k else None
                    least = floor if least is None else least if floor is None else max(floor, least)
                    if least is not None and bounds[b] < least:
                        break
                    own = slice(starts[b], starts[b] + BLOCK_ROWS)
                    other = ids[own] != qid
                    scores = np.concatenate([scores, products(q, x[own][other])])
                    names = np.concatenate([names, ids[own][other]])
                    best = np.lexsort((names, -scores))[:k]
                    scores, names = scores[best], names[best]
                    if only_best and len(scores):
                        break
                found.append((np.full(len(names), qid, np.int64), names, scores))
        columns = [np.concatenate([np.empty(0, np.int64), *[f[i] for f in found]]) for i in range(3)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})
    return run


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, queries_at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """The k highest scores with other rows for each row for which `is_query` (over a column `id`) holds.

    Returns query_id, rank from 1, vec_id, score.
    """
    vectors = integer_vectors(df, id_col, vec_col)
    n = vectors.count()
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = -(-n // shard_rows)
    # Ranges of the order; the id splits equal vectors, the row number equal ids.
    keyed = vectors.withColumn("key", order_key("vec")).withColumn("row", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(shards, "key", "id", "row").select("id", "vec", F.spark_partition_id().alias("shard"))
    rows = materialise(dealt, "blockmax-index")
    asked = rows.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec")).select(F.col("id").alias("id"), "vec")
    parts = -(-asked.count() // queries_at_once) or 1
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def searched(queries: DataFrame, only_best: bool) -> DataFrame:
        pairs = queries.groupBy("shard", "part").cogroup(rows.groupBy("shard", "part"))
        found = pairs.applyInArrow(_search(k, only_best), "query_id long, vec_id long, score long")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    first = searched(asked.withColumn("floor", F.lit(None).cast("long")), only_best=True)
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    primed = asked.join(materialise(floors, "blockmax-floors"), "id", "left")
    final = searched(primed.select(*[F.col(c).alias(c) for c in primed.columns]), only_best=False)
    return final.select("query_id", "rank", "vec_id", "score")
