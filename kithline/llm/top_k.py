"""Operator 9: exact top-k by the threshold algorithm (Fagin, Lotem, Naor).

Candidates fall into blocks of BLOCK rows at most (about). A block keeps, for each dimension, its rows sorted by
that component. For a query the lists are read in step from the end that favours it; each row met is
scored in full. Once the k-th best score exceeds the sum of the query's components times the values
last read, no row not yet met can be among the best, and the block is done. The best of the blocks
are merged by a ranked window, whose partial step keeps k rows a task.

Components are turned into integers, floor(scale * x); scores are exact integers. Ties go to the
smaller id. Queries come in blocks as well: each (query block, candidate block) is one group of bounded
size.

Defined cases: rows with a null id, a null or empty vector, or a null or non-finite component take no
part; vectors of different dimension do not meet; a row with the query's id is the query's own;
repeated candidates are all ranked; several rows of one query id share one ranking; a component whose
integer, or a score, does not fit into 64 bits raises; further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow

BLOCK, QUERY_BLOCK = 65_536, 65_536
#: Blocks are not made smaller than this to give every core some.
LEAST_BLOCK = 4_096


def threshold_search(ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, rows scored): the k best rows of a block for one query. order: rows by each component, ascending."""
    n = len(ids)
    use = np.flatnonzero(query)
    seen = np.zeros(n, bool)
    best_id, best = np.empty(0, np.int64), np.empty(0, vectors.dtype)
    at, step = 0, max(4, 4 * k // max(1, len(use)) + 1)
    while at < n:
        to = min(n, at + step)
        met = np.zeros(n, bool)
        bound = 0
        for d in use:
            if query[d] > 0:
                met[order[d, n - to : n - at]] = True
                bound += query[d] * vectors[order[d, n - to], d]
            else:
                met[order[d, at:to]] = True
                bound += query[d] * vectors[order[d, to - 1], d]
        if not len(use):
            met[:] = True
            to = n
        met &= ~seen
        seen |= met
        new = np.flatnonzero(met)
        score = vectors[new] @ query
        keep = ids[new] != own
        best_id, best = np.concatenate([best_id, ids[new][keep]]), np.concatenate([best, score[keep]])
        if len(best) > k:
            first = np.lexsort((best_id, -best))[:k] if len(best) < 64 else _first(best_id, best, k)
            best_id, best = best_id[first], best[first]
        if len(best) == k and best.min() > bound:
            break
        at, step = to, step * 2
    return best_id, best, int(seen.sum())


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not candidates.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, schema)
        ids, vectors, asked = candidates["id"].to_numpy(), _matrix(candidates["v"]), _matrix(queries["v"])
        most = float(np.abs(vectors).max()) * float(np.abs(asked).max()) * vectors.shape[1]
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64 if most < 2**62 else object  # in which all sums are exact
        vectors, asked = np.ascontiguousarray(vectors, kind), asked.astype(kind)
        order = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)
        out = [[], [], []]
        for own, q in zip(queries["id"].to_pylist(), asked, strict=True):
            best_id, best, _ = threshold_search(ids, vectors, order, q, own, k)
            for column, value in zip(out, (np.full(len(best), own), best_id, best.astype(np.int64)), strict=True):  # of too large a Python integer this raises
                column.append(value)
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in out], schema)

    return run


def _quantize(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            x = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(x) and np.abs(x).max() >= 2.0**63:
                raise ValueError(f"a component of {x[np.abs(x).argmax()] / scale} does not fit into 64 bits once it is multiplied by {scale}")
            x = x.astype(np.int64)
            yield arrow(["id", "v"], [b.column(0), pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32), x)])

    return run


def exact_top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row of df that is_query, the k best other rows."""
    v = F.col("v")
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & sound)
    whole = rows.select("id", "v").mapInArrow(_quantize(scale), "id bigint, v array<bigint>").withColumn("dim", F.size("v"))
    asks = rows.where("asks").select("id", "v").mapInArrow(_quantize(scale), "id bigint, v array<bigint>").withColumn("dim", F.size("v"))
    # of equal rows k are enough, so that a row that fills the table does not fill a block
    enough = lambda d: d.groupBy("id", "v", "dim").agg(F.count("*").alias("m")).withColumn("m", F.explode(F.sequence(F.lit(1), F.least("m", F.lit(k)).cast("int")))).drop("m")
    whole, asks = enough(whole), enough(asks)
    n, n_asks = rows.count(), rows.where("asks").count()
    cores = 2 * df.sparkSession.sparkContext.defaultParallelism
    blocks, query_blocks = max(1, -(-n // BLOCK), min(-(-n // LEAST_BLOCK), cores)), max(1, -(-n_asks // QUERY_BLOCK))
    to_all = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dealt = lambda m, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(m)).cast("int")
    left = asks.withColumn("query_block", dealt(query_blocks, 1)).withColumn("block", to_all(blocks))
    right = whole.withColumn("block", dealt(blocks, 0)).withColumn("query_block", to_all(query_blocks))
    by = ["dim", "block", "query_block"]
    found = left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
