"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates and queries are packed into blocks of bounded size; every query
block meets every candidate block once (a stated query set against all rows).
In a candidate block each dimension has its list of rows in order of value. A
query walks all lists downwards in the direction of its sign, scores the rows
that come up in full, and stops when even a row with the values at the current
depth of every list couldn't reach its k-th score. The k best of each block are
then ranked over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CANDIDATE_ROWS = 8_192
QUERY_ROWS = 512
EXACT = 2.0 ** 53


class SortedLists:
    """A block's rows with, for each dimension, the rows in ascending order of value."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")  # a lower index is a smaller id
        self.ids, self.rows = ids[order], np.ascontiguousarray(rows[order])
        self.lists = np.argsort(self.rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.rows, self.lists.T, axis=0).T.copy()

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k highest scores, ties to smaller ids; a row with the id ``own`` is left out."""
        n = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        left = np.ones(n, dtype=bool)  # rows that no list has brought up yet
        first = np.searchsorted(self.ids, own)
        last = np.searchsorted(self.ids, own, side="right")
        left[first:last] = False
        best_i, best_s = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=self.rows.dtype)
        depth, step = 0, max(4, k // 4)
        while depth < n:
            to = min(n, depth + step)
            mark = np.zeros(n, dtype=bool)
            mark[self.lists[up, depth:to].ravel()] = True
            mark[self.lists[down, n - to: n - depth].ravel()] = True
            new = np.flatnonzero(mark & left)
            if len(up) + len(down) == 0 or 2 * len(new) > n:
                new = np.flatnonzero(left)  # most of the rows: score what is left in one go
            left[new] = False
            scores = (self.rows if len(new) == n else self.rows[new]) @ query
            best_i, best_s = np.concatenate((best_i, new)), np.concatenate((best_s, scores))
            if len(best_s) > k:
                least = np.partition(best_s, len(best_s) - k)[len(best_s) - k]
                kept = np.flatnonzero(best_s >= least)
                kept = kept[np.lexsort((best_i[kept], -best_s[kept]))][:k]
                best_i, best_s = best_i[kept], best_s[kept]
            if not left.any():
                break
            # Any row still unseen lies beyond ``to`` in every list.
            bound = (self.values[up, to - 1] * query[up]).sum() + (self.values[down, n - to] * query[down]).sum() if to < n else None
            if bound is None or len(best_s) >= k and bound < best_s.min():
                break
            depth, step = to, step * 4
        order = np.lexsort((best_i, -best_s))
        return self.ids[best_i[order]], best_s[order]


def _unpack(ids: bytes, rows: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    return i, np.frombuffer(rows, dtype=np.int64).reshape(len(i), dim)


def quantise(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, x as double; null unless all components are there and finite.

    Products beyond the range of a long are outside this operator's domain.
    """
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x)))


def _pack(rows: DataFrame, per_block: int, n: int, dim: int, name: str) -> DataFrame:
    """(block, ids, rows): about ``per_block`` rows a block, as bytes."""
    blocks = max(1, math.ceil(n / per_block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))

    def run(key, table):
        ids = table.column("id").to_numpy()
        v = np.zeros((len(ids), dim), dtype=np.int64)
        for i, x in enumerate(table.column("v").to_pylist()):
            v[i, : len(x)] = x
        return pa.table({f"{name}_block": [key[0].as_py()], f"{name}_ids": [ids.tobytes()], f"{name}_rows": [v.tobytes()]},
                        schema=pa.schema([(f"{name}_block", pa.int32()), (f"{name}_ids", pa.binary()), (f"{name}_rows", pa.binary())]))

    return dealt.groupBy("block").applyInArrow(run, f"{name}_block int, {name}_ids binary, {name}_rows binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each query the k highest inner products of quantised vectors.

    Vectors that are null or hold a null or non-finite component, and rows with a null id, take no
    part; a shorter vector counts as padded by zeros; an empty vector scores 0 against all. A
    query's own id is no candidate of it. Ties go to the smaller id; with repeated ids each row
    counts. Fewer than k candidates: all of them. No vectors: no rows. Other columns are not read.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col), scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q")).where("id IS NOT NULL AND v IS NOT NULL")
    n, nq, dim, top = v.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0)),
                            F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    dim = max(1, dim)
    kind = np.float32 if dim * (top or 0) ** 2 < 2.0 ** 24 else np.float64 if dim * (top or 0) ** 2 < EXACT else np.int64  # exact sums
    rows = _pack(v.select("id", "v"), CANDIDATE_ROWS, n, dim, "c")
    queries = _pack(v.where("q").select("id", "v"), QUERY_ROWS, nq, dim, "q")
    n_blocks = max(1, math.ceil(n / CANDIDATE_ROWS))
    pairs = queries.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(rows, "c_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lists = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["c_block"] != last:
                    ids, x = _unpack(r["c_ids"], r["c_rows"], dim)
                    last, lists = r["c_block"], SortedLists(ids, x.astype(kind))
                q_ids, q = _unpack(r["q_ids"], r["q_rows"], dim)
                q = q.astype(kind)
                found = [lists.top(q[i], q_ids[i], k) for i in range(len(q_ids))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, [len(f[0]) for f in found]), pa.int64()),
                    pa.array(np.repeat(np.arange(len(q_ids)), [len(f[0]) for f in found]), pa.int32()),
                    pa.array([r["q_block"]] * sum(len(f[0]) for f in found), pa.int32()),
                    pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]).astype(np.int64), pa.int64())],
                    names=["query_id", "q_row", "q_block", "id", "score"])

    best = pairs.mapInArrow(run, "query_id long, q_row int, q_block int, id long, score long")
    order = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
