"""Exact top-k inner products by dual cover trees.

Vectors are dealt to blocks of bounded size, queries too; each task indexes its block of
queries and its block of candidates in one cover tree each and walks both together. For a
node pair with centres q, c and covering radii r, s no inner product exceeds
<q, c> + |q| s + |c| r + r s; a pair is pruned when that is below the worst k-th score of
the query node's queries. The k best of each block are then merged per query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, store

#: Candidates and queries in a block; vectors in a leaf; shrinking of the covering radius.
BLOCK, QUERY_BLOCK, LEAF, SHRINK = 4096, 1024, 64, 0.75


class CoverTree:
    """Nodes (centre, covering radius, rows) over the rows of a matrix, built by greedy covering.

    A node's rows lie within its radius of its centre, which is one of them. Children cover
    ``SHRINK`` of the radius; their centres are farther than that apart. Children of few rows
    stay together in one leaf around the parent's centre.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.nodes: list[tuple[int, float, list[int], np.ndarray | None]] = []
        self.root = self._build(np.arange(len(x)), 0)

    def _far(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.x[rows] - self.x[centre]
        return np.sqrt((d * d).sum(axis=1))

    def _add(self, centre: int, radius: float, children: list[int], rows: np.ndarray | None) -> int:
        self.nodes.append((centre, radius, children, rows))
        return len(self.nodes) - 1

    def _leaves(self, rows: np.ndarray, centre: int) -> list[int]:
        far = self._far(rows, centre)
        rows = rows[np.argsort(far, kind="stable")]
        far.sort()
        return [self._add(centre, float(far[min(at + LEAF, len(rows)) - 1]), [], rows[at:at + LEAF])
                for at in range(0, len(rows), LEAF)]

    def _build(self, rows: np.ndarray, centre: int) -> int:
        far = self._far(rows, centre)
        radius = float(far.max())
        if len(rows) <= LEAF:
            return self._add(centre, radius, [], rows)
        if radius == 0:
            return self._add(centre, 0.0, self._leaves(rows, centre), None)
        reach, left, children, small = radius * SHRINK, rows, [], []
        pick = centre
        while len(left):
            near = self._far(left, pick) <= reach
            group = left[near]
            if len(group) > LEAF and len(group) < len(rows):
                children.append(self._build(group, pick))
            else:
                small.append(group)
            left = left[~near]
            if len(left):
                pick = int(left[0])
        if small:
            children += self._leaves(np.concatenate(small), centre)
        return self._add(centre, radius, children, None)


def dual_search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each query's k best rows of ``data``, ties to the smaller id, its own id left out.

    Both matrices hold whole numbers. Missing places have id -1.
    """
    n = len(queries)
    largest = max(float(np.abs(queries).max(initial=0)), float(np.abs(data).max(initial=0)))
    exact = largest * largest * max(1, queries.shape[1]) < 2 ** 53
    q_int, d_int = (queries, data) if exact else (queries.astype(np.int64), data.astype(np.int64))
    none = np.iinfo(np.int64).min
    best, ids = np.full((n, k), none), np.full((n, k), -1)
    q_tree, d_tree = CoverTree(queries), CoverTree(data)
    radius = np.array([v[1] for v in d_tree.nodes])
    centre = np.array([v[0] for v in d_tree.nodes])

    def compare(rows: np.ndarray, cols: np.ndarray) -> None:
        scores = (q_int[rows] @ d_int[cols].T).astype(np.int64)
        scores[query_ids[rows][:, None] == data_ids[cols][None, :]] = none
        some = (scores >= best[rows, -1][:, None]).any(axis=1)
        if not some.any():
            return
        rows, scores = rows[some], scores[some]
        all_scores = np.concatenate([best[rows], scores], axis=1)
        all_ids = np.concatenate([ids[rows], np.broadcast_to(data_ids[cols], scores.shape)], axis=1)
        # The lowest score stands for "no row" only: it must not win with a real id.
        all_ids = np.where(all_scores == none, np.iinfo(np.int64).max, all_ids)
        order = np.lexsort((all_ids, -np.maximum(all_scores, none + 1)), axis=1)[:, :k]
        best[rows] = np.take_along_axis(all_scores, order, axis=1)
        ids[rows] = np.take_along_axis(all_ids, order, axis=1)

    def members(node: int) -> np.ndarray:
        found, stack = [], [node]
        while stack:
            _, _, children, rows = q_tree.nodes[stack.pop()]
            stack += children
            if rows is not None:
                found.append(rows)
        return np.concatenate(found)

    def bounds(q: int, ds: list[int]) -> np.ndarray:
        c, r, _, _ = q_tree.nodes[q]
        at = centre[ds]
        up = data[at] @ queries[c] + q_tree.norm[c] * radius[ds] + d_tree.norm[at] * r + r * radius[ds]
        return up + np.abs(up) * 1e-9 + 1

    def walk(q: int, ds: list[int], rows: np.ndarray) -> None:
        """Search the candidate nodes for the queries of one query node, best bounds first."""
        up = bounds(q, ds)
        for i in np.argsort(-up):
            if up[i] < best[rows, -1].min():
                return
            _, _, children, cols = d_tree.nodes[ds[i]]
            if cols is None:
                walk(q, children, rows)
            elif q_tree.nodes[q][3] is not None:
                compare(rows, cols)
            else:
                for child in q_tree.nodes[q][2]:
                    walk(child, [ds[i]], inside[child])

    inside = {v: members(v) for v in range(len(q_tree.nodes))}
    # Query leaves first get thresholds of their own: each starts from the candidates' root.
    for v, node in enumerate(q_tree.nodes):
        if node[3] is not None:
            walk(v, [d_tree.root], inside[v])
    ids[best == none] = -1
    return best, ids


def _search(k: int):
    def run(key, queries, data):
        import pandas as pd

        names = ["query_id", "query_key", "vec_id", "score"]
        if not len(queries) or not len(data):
            return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
        data = data.sort_values("vec_id")
        x = np.array(data["v"].tolist(), float).reshape(len(data), -1)
        # Of equal vectors no query's answer in this block holds more than the k + 1 smallest ids.
        _, same = np.unique(x, axis=0, return_inverse=True)
        keep = pd.Series(same.ravel()).groupby(same.ravel()).cumcount().to_numpy() <= k
        y = np.array(queries["v"].tolist(), float).reshape(len(queries), -1)
        own = queries["vec_id"].to_numpy()
        # A repeated row of an id stands for itself once more, so the cut above counts ids, not rows.
        keep |= data["vec_id"].duplicated(keep=False).to_numpy()
        best, ids = dual_search(y, own, x[keep], data["vec_id"].to_numpy()[keep], k)
        found = ids >= 0 if (data["vec_id"] >= 0).all() else best != np.iinfo(np.int64).min
        row, _ = np.nonzero(found)
        return pd.DataFrame({"query_id": own[row], "query_key": queries["query_key"].to_numpy()[row],
                             "vec_id": ids[found], "score": best[found]})[names]
    return run


def scaled_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   factor: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(factor * component); without rows that are null or hold null, NaN or infinity."""
    v = F.transform(table[vector_col], lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.select(table[id_col].cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad)
            .select("vec_id", F.transform("v", lambda x: F.floor(x * factor).cast("long")).alias("v")))


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best rows by inner product of every query: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``; all rows with another id are
    candidates; ties go to the smaller id. Vectors of different lengths are never compared.
    Rows with a null id or vector, or with a null, NaN or infinite component, take no part.
    Repeated rows of an id are candidates each; equal query rows are one query, rows of one
    id with different vectors are queries each. Fewer candidates than k: all of them. An
    empty table gives an empty result. Extra columns are ignored.
    """
    vectors = store(scaled_vectors(table, id_col, vector_col), "vectors")
    queries = (vectors.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
               .withColumn("query_key", F.xxhash64("v")))
    nb, nq = blocks_of(vectors.count(), block), blocks_of(queries.count(), query_block)
    data = (vectors.withColumn("db", F.pmod(F.xxhash64("vec_id"), F.lit(nb))).withColumn("dim", F.size("v"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long")))))
    asked = (queries.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(nq))).withColumn("dim", F.size("v"))
             .withColumn("db", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nb - 1).cast("long")))))
    keys = ["qb", "db", "dim"]
    found = (asked.groupBy(*keys).cogroup(data.groupBy(*keys))
             .applyInPandas(_search(k), "query_id long, query_key long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
