"""Nearest neighbours by largest inner product through low-dimensional stable projections.

Vectors get one more component that makes all norms equal, so the largest inner product is the smallest distance. Gaussian
(2-stable) projections to ``DIMENSIONS`` numbers are indexed by a kd-tree in each index block. Its leaves are
visited in the order of their projected distance and verified by exact products, until the chi-square test holds: a vector closer than the
k-th one found would lie nearer than the next leaf with probability ``CERTAINTY`` or more.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 8
CERTAINTY = 0.97
LEAF = 128
INDEX_ROWS = 8192
QUERY_ROWS = 4096
SEED = 11
RESULT = "query_id long, vec_id long, score double"


def chi_square(x: np.ndarray, dimensions: int) -> np.ndarray:
    """Distribution function for an even number of dimensions."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, dimensions // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


class Tree:
    """kd-tree over projected points: rows of each leaf and the box around them."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                self.leaves.append(rows)
                continue
            inside = points[rows]
            axis = int(np.argmax(inside.max(axis=0) - inside.min(axis=0)))
            order = np.argsort(inside[:, axis], kind="stable")
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        self.low = np.array([points[r].min(axis=0) for r in self.leaves])
        self.high = np.array([points[r].max(axis=0) for r in self.leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each box."""
        out = np.zeros((len(queries), len(self.leaves)))
        for d in range(self.low.shape[1]):
            q = queries[:, d, None]
            out += np.square(np.maximum(0, np.maximum(self.low[:, d] - q, q - self.high[:, d])))
        return out


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column])


def _search(k: int, top: float, dimensions: int, certainty: float, leaf: int):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
        if not len(queries) or not len(index):
            return pd.DataFrame(out)
        index = index.sort_values("vec_id", ignore_index=True)
        ids, own = index["vec_id"].to_numpy(np.int64), queries["vec_id"].to_numpy(np.int64)
        x, q = _matrix(index["vec"]), _matrix(queries["vec"])
        norm_q = np.sqrt(np.square(q).sum(axis=1))
        more = np.sqrt(np.maximum(0, top * top - np.square(x).sum(axis=1)))
        # a query is scaled to the common norm; that changes no order and makes distances as small as they can be
        scaled = q * (top / norm_q)[:, None]
        projection = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, dimensions))
        tree = Tree(np.column_stack((x, more)) @ projection, leaf)
        bounds = tree.distances(np.column_stack((scaled, np.zeros(len(q)))) @ projection)
        order = np.argsort(bounds, axis=1, kind="stable")
        best_score, best_id = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        active = np.arange(len(q))
        for step in range(len(tree.leaves)):
            if step:
                least = best_score[active, -1]
                distance = 2 * top * top - 2 * np.where(np.isfinite(least), least, 0) * top / norm_q[active]
                bound = bounds[active, order[active, step]]
                sure = np.isfinite(least) & (chi_square(bound / np.maximum(distance, 1e-300), dimensions) >= certainty)
                active = active[~sure]
            if not len(active):
                break
            leaf_of = order[active, step]
            rows, points = [], []
            for number in np.unique(leaf_of):
                mine, members = active[leaf_of == number], tree.leaves[number]
                product = q[mine] @ x[members].T
                a, b = np.nonzero(product >= (best_score[mine, -1] - 1e-9 * (1 + np.abs(best_score[mine, -1])))[:, None])
                rows.append(mine[a])
                points.append(members[b])
            row, point = np.concatenate(rows), np.concatenate(points)
            other = own[row] != ids[point]
            row, point = row[other], point[other]
            # summed in one order for every pair, so equal vectors have equal scores
            score = np.concatenate([(q[row[i:i + 65536]] * x[point[i:i + 65536]]).sum(axis=1) for i in range(0, len(row), 65536)] or [np.zeros(0)])
            touched = np.unique(row)
            all_row = np.concatenate((np.repeat(touched, k), row))
            all_score = np.concatenate((best_score[touched].reshape(-1), score))
            all_id = np.concatenate((best_id[touched].reshape(-1), ids[point]))
            o = np.lexsort((all_id, -all_score, all_row))
            r = all_row[o]
            first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, np.int64)
            place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
            keep = o[place < k]
            best_score[touched], best_id[touched] = all_score[keep].reshape(-1, k), all_id[keep].reshape(-1, k)
        found = np.isfinite(best_score)
        return pd.DataFrame({"query_id": np.broadcast_to(own[:, None], found.shape)[found], "vec_id": best_id[found], "score": best_score[found]})

    return run


def usable(vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """(vec_id, vec) in double precision without null ids and without vectors that are null, zero, or hold null or non-finite numbers."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec")).dropna()
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.coalesce(~odd, F.lit(False)) & F.exists("vec", lambda x: x != 0)).dropDuplicates()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vec: str = "embedding",
            dimensions: int = DIMENSIONS, certainty: float = CERTAINTY, leaf: int = LEAF,
            index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the largest inner product found for each query row.

    Every usable row is indexed; see ``usable`` for those that take no part, as candidates and as queries. Of equal vectors only
    the k + 1 smallest ids can be among the k nearest, so only these are dealt out. A query's own id is no candidate. Ties go to the smaller id,
    repeated rows of one id and vector count once. Fewer candidates: all of them. A query meets the vectors of its own length; every
    length is searched on its own. Queries meet all index blocks, in blocks of ``query_rows``. Other columns are ignored.
    """
    if dimensions % 2:
        raise ValueError("the test needs an even number of dimensions")
    rows, asked = usable(vectors, vec_id, vec), usable(queries, vec_id, vec)
    lengths = sorted(r["d"] for r in asked.select(F.size("vec").alias("d")).distinct().collect())  # one, unless the data are mixed
    if len(lengths) < 2:
        parts = [(rows.filter(F.size("vec") == lengths[0]), asked)] if lengths else [(rows, asked)]
    else:
        parts = [(rows.filter(F.size("vec") == d), asked.filter(F.size("vec") == d)) for d in lengths]
    return reduce(DataFrame.unionByName, [_nearest(*part, k, dimensions, certainty, leaf, index_rows, query_rows) for part in parts])


def _nearest(rows: DataFrame, asked: DataFrame, k: int, dimensions: int, certainty: float, leaf: int, index_rows: int, query_rows: int) -> DataFrame:
    """``nearest`` for usable vectors of one length."""
    same = Window.partitionBy("vec").orderBy("vec_id")
    rows = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    seen = rows.agg(F.count("*").alias("n"), F.max(size).alias("top")).first()
    blocks, groups = max(1, math.ceil(seen["n"] / index_rows)), max(1, math.ceil(asked.count() / query_rows))
    block, group = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), F.pmod(F.hash("vec_id"), F.lit(groups))
    left = asked.select("vec_id", "vec", group.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    right = rows.select("vec_id", "vec", block.cast("int").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    left, right = left.select(F.col("g").cast("int").alias("g"), "b", "vec_id", "vec"), right.select("g", "b", "vec_id", "vec")
    search = _search(k, float(seen["top"] or 1.0) * (1 + 1e-12), dimensions, certainty, leaf)
    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInPandas(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
