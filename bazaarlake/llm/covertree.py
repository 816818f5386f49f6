"""Exact inner-product top-k by cover trees over queries and data, searched together."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarlake.llm.batches import quoted

QUERY_BLOCK, DATA_BLOCK = 2048, 4096
LEAF = 64
TILE = 256  # queries and points multiplied at once
# A node stays whole unless its net has so few centers for its points.
LEAST_GAIN = 4
# Ratio of the scales of a node and its children. Vectors of many dimensions lie at
# nearly equal distances, where a net at half the radius is all points.
BASE = 1.1
_RESULT = "query_id long, vec_id long, score long"


class CoverTree:
    """Nested balls over points: node i holds points ``start[i]:end[i]`` of ``order``.

    A node at scale s has all its points within BASE^s of its center. Its children are
    centers more than BASE^(s-1) apart that cover its points within BASE^(s-1); the first
    of them is the node's own center again. ``radius`` is the true distance of the
    farthest point. Nodes of at most ``leaf`` points, of equal points, or whose net would
    hold more than a ``LEAST_GAIN``-th of them (no structure to use) are leaves.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.order = np.arange(len(points))
        self.center: list[int] = []
        self.radius: list[float] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.children: list[list[int]] = []
        if not len(points):
            return
        todo = [(self._add(0, 0, len(points), self._far(0, self.order)), leaf)]
        while todo:
            node, leaf = todo.pop()
            todo.extend((child, leaf) for child in self._split(node, leaf))

    def _far(self, center: int, members: np.ndarray) -> np.ndarray:
        gap = self.points[members] - self.points[center]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _add(self, center: int, start: int, end: int, far: np.ndarray) -> int:
        self.center.append(center)
        self.radius.append(float(far.max()))
        self.start.append(start)
        self.end.append(end)
        self.children.append([])
        return len(self.center) - 1

    def _split(self, node: int, leaf: int) -> list[int]:
        start, end = self.start[node], self.end[node]
        if end - start <= leaf or self.radius[node] == 0:
            return []
        cover = BASE ** (np.ceil(np.log(self.radius[node]) / np.log(BASE)) - 1)
        rest, center, net = self.order[start:end], self.center[node], []
        while len(rest):
            if len(net) * LEAST_GAIN >= end - start:
                return []
            far = self._far(center, rest)
            inside = far <= cover
            net.append((center, rest[inside], far[inside]))
            rest = rest[~inside]
            center = int(rest[0]) if len(rest) else -1
        at = start
        for center, members, far in net:
            self.order[at:at + len(members)] = members
            self.children[node].append(self._add(center, at, at + len(members), far))
            at += len(members)
        return self.children[node]


    def longest(self) -> np.ndarray:
        """Greatest squared length of each node's points."""
        squares = np.einsum("ij,ij->i", self.points, self.points)[self.order]
        return np.array([squares[s:e].max() for s, e in zip(self.start, self.end)])


class Best:
    """The k best of each query so far: higher score first, then smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids = ids
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return self.scores[rows, -1]

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates ``ids`` for all ``rows``; a query never finds itself."""
        fits = (scores >= self.worst(rows)[:, None]) & (ids != self.ids[rows][:, None])
        if not fits.any():
            return
        some = np.nonzero(fits.any(axis=0))[0]
        ids, fits, scores = ids[some], fits[:, some], scores[:, some]
        none = np.iinfo(np.int64)
        all_scores = np.hstack([self.scores[rows], np.where(fits, scores, none.min)])
        all_ids = np.hstack([self.found[rows], np.where(fits, ids, none.max)])
        order = np.lexsort((all_ids, ~all_scores), axis=1)  # ~x = -x - 1 never overflows
        k = self.scores.shape[1]
        self.scores[rows] = np.take_along_axis(all_scores, order[:, :k], 1)
        self.found[rows] = np.take_along_axis(all_ids, order[:, :k], 1)


def search(queries: CoverTree, data: CoverTree, data_ids: np.ndarray, best: Best) -> None:
    """Offer to ``best`` every data point that can be among a query's k best.

    Pairs of nodes are taken by descending bound. With centers p, c and radii r, s
    no inner product across the pair exceeds <p,c> + r|c| + s|p| + rs, nor half of the
    greatest squared lengths less the square of the gap |p-c| - r - s (if positive). A
    pair whose bound lies below the worst k-th score of its query group is dropped. Points
    are whole numbers small enough for exact products in 64-bit floats or integers.
    """
    if not len(queries.center) or not len(data.center):
        return
    q_norm, d_norm = (np.linalg.norm(t.points[t.center], axis=1) for t in (queries, data))
    q_peak, d_peak = queries.longest(), data.longest()
    width = queries.points.shape[1]
    peak = max(float(np.abs(t.points).max(initial=0)) for t in (queries, data))
    if width * peak * peak >= 2.0**63:
        raise OverflowError("inner products of these vectors do not fit 64-bit integers")
    exact = width * peak * peak < 2.0**53
    whole = None if exact else (queries.points.astype(np.int64), data.points.astype(np.int64))

    def bounds(q: int, nodes: list[int]) -> np.ndarray:
        inner = data.points[[data.center[d] for d in nodes]] @ queries.points[queries.center[q]]
        s, r = np.array([data.radius[d] for d in nodes]), queries.radius[q]
        apart = np.sqrt(np.maximum(d_norm[nodes] ** 2 + q_norm[q] ** 2 - 2 * inner, 0))
        gap = np.maximum(apart * (1 - 1e-9) - r - s, 0)
        bound = np.minimum(inner + r * d_norm[nodes] + s * q_norm[q] + r * s,
                           (d_peak[nodes] + q_peak[q] - gap * gap) / 2)
        return bound + 1e-9 * (np.abs(bound) + 1)  # rounding never drops a candidate

    heap, count = [(-float(bounds(0, [0])[0]), 0, 0, 0)], 1
    while heap:
        bound, _, q, d = heapq.heappop(heap)
        rows = queries.order[queries.start[q]:queries.end[q]]
        worst = best.worst(rows).min()
        if -bound < worst:
            continue
        split_query = queries.children[q] and (
            not data.children[d] or queries.radius[q] >= data.radius[d])
        if split_query:
            pairs = [(float(bounds(x, [d])[0]), x, d) for x in queries.children[q]]
        elif data.children[d]:
            pairs = list(zip(map(float, bounds(q, data.children[d])),
                             [q] * len(data.children[d]), data.children[d]))
        else:
            members = data.order[data.start[d]:data.end[d]]
            for i, j in ((i, j) for j in range(0, len(members), TILE)
                         for i in range(0, len(rows), TILE)):
                some, those = rows[i:i + TILE], members[j:j + TILE]
                if exact:
                    scores = (queries.points[some] @ data.points[those].T).astype(np.int64)
                else:
                    scores = whole[0][some] @ whole[1][those].T
                best.offer(some, data_ids[those], scores)
            continue
        for value, x, y in pairs:
            if value >= worst:
                heapq.heappush(heap, (-value, count, x, y))
                count += 1


def _blocks(df: DataFrame, name: str, size: int, rows: int) -> DataFrame:
    """Vectors packed into rows of about ``size``: dim, block number, ids and numbers as bytes."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(same=group["whole"].map(tuple)).drop_duplicates(
            ["id", "same"]).sort_values(["id", "same"])
        points = np.array(group["whole"].tolist(), dtype=np.int64)
        return pd.DataFrame({"dim": group["dim"].iloc[:1], name: group["block"].iloc[:1],
                             f"{name}_ids": [group["id"].to_numpy(np.int64).tobytes()],
                             f"{name}_points": [points.tobytes()]})

    numbered = df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-rows // size)))))
    return numbered.groupBy("dim", "block").applyInPandas(
        pack, f"dim int, {name} long, {name}_ids binary, {name}_points binary")


def _unpack(row, name: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(getattr(row, f"{name}_ids"), dtype=np.int64)
    points = np.frombuffer(getattr(row, f"{name}_points"), dtype=np.int64)
    return ids, points.reshape(len(ids), -1).astype(np.float64)


def _search_blocks(k: int):
    def work(frames):
        trees: dict = {}  # query blocks of this task: tree and best so far
        for frame in frames:
            for row in frame.itertuples(index=False):
                if (row.dim, row.q) not in trees:
                    ids, points = _unpack(row, "q")
                    trees[row.dim, row.q] = CoverTree(points), Best(ids, k)
                tree, best = trees[row.dim, row.q]
                ids, points = _unpack(row, "d")
                search(tree, CoverTree(points), ids, best)
        for _, best in trees.values():
            rows, ranks = np.nonzero(best.found != np.iinfo(np.int64).max)
            yield pd.DataFrame({"query_id": best.ids[rows], "vec_id": best.found[rows, ranks],
                                "score": best.scores[rows, ranks]})

    return work


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, whole, dim): components as floor(scale * x). Vectors that are null or empty,
    or hold a null or non-finite component, and rows with a null id take no part."""
    numbers = F.transform(F.col(quoted(vector)), lambda x: x.cast("double"))
    return df.select(F.col(quoted(key)).cast("long").alias("id"), numbers.alias("raw")).filter(
        F.col("id").isNotNull() & F.col("raw").isNotNull() & (F.size("raw") > 0)
        & ~F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (
            F.abs(x) == F.lit(float("inf"))))).select(
        "id", F.transform("raw", lambda x: F.floor(x * scale)).alias("whole"),
        F.size("raw").alias("dim"))


def top_k(df: DataFrame, key: str, vector: str, is_query, k: int, scale: int = 256,
          query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best other rows.

    ``is_query`` is a condition on ``id``. Queries and data are packed into blocks
    of bounded size; every query block meets every data block of its dimension (the
    query set against all rows), and each pair is searched by two cover trees, with the
    k-th scores of earlier data blocks of the task kept as bounds. A task gives k rows
    a query. Rows of one id are one another's own row and never found by it; equal
    vectors tie by smaller id; rows equal in id and vector count once; fewer than ``k`` candidates give fewer rows; queries
    meet candidates of their own dimension only.
    """
    vectors = whole_vectors(df, key, vector, scale)
    queries = vectors.filter(is_query)
    counts = vectors.agg(F.count(F.lit(1)).alias("d"),
                         F.count_if(is_query).alias("q")).first()
    wide = _blocks(queries, "q", query_block, counts["q"])
    data = _blocks(vectors, "d", data_block, counts["d"])
    n_queries = max(1, -(-counts["q"] // query_block))
    meets = data.withColumn("q", F.explode(F.array(
        *[F.lit(i).cast("long") for i in range(n_queries)]))).join(wide, ["dim", "q"])
    found = meets.mapInPandas(_search_blocks(k), _RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
