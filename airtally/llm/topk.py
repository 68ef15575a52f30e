"""Exact top-k inner-product search with pairs of cover trees.

Vectors become whole numbers. The rows are dealt by hash into blocks of a bounded size, and
every block of queries meets every block of rows once. In such a pair both sides are indexed
by a cover tree; the search walks the trees together and drops a pair of nodes
when even their best possible product, from the centres and covering radii, is below the worst
kth score of the query group. The best of each pair are merged per query.

Cases: null vectors and vectors with null or non-finite components take no part, neither as
query nor as row; an empty vector scores 0 with all; of vectors of unequal length the missing
components count as 0. Rows with the query's id are its own and no candidates; a repeated
identical query is answered once, repeated candidates each count. Fewer candidates than k:
all are returned. Null ids take no part. Products beyond 2**53 are added as 64-bit integers.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows and queries of a block, about.
ROW_BLOCK, QUERY_BLOCK = 8192, 2048
#: Covering radii shrink by this factor from level to level.
SHRINK = 1.3
#: Points below which a node is not divided.
LEAF = 48


class CoverTree:
    """Points in tree order. A node covers a range of them within its radius around its centre;
    the centres of a node's children lie apart by more than the child level's radius."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.order = np.zeros(0, np.int64)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.children: list[list[int]] = []
        pieces: list[np.ndarray] = []
        if len(points):
            self._build(pieces)
            self.order = np.concatenate(pieces)
        self.centres = points[np.array(self.centre, np.int64)] if len(points) else points
        self.norms = np.linalg.norm(self.centres, axis=1)
        self.radii = np.array(self.radius)

    def _node(self, centre: int, radius: float) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.start.append(0)
        self.end.append(0)
        self.children.append([])
        return len(self.centre) - 1

    def _build(self, pieces: list[np.ndarray]) -> None:
        """Depth first, with a stack: a long chain of levels needs no deep recursion."""
        everything = np.arange(len(self.points))
        distance = np.linalg.norm(self.points - self.points[0], axis=1)
        stack = [(self._node(0, float(distance.max())), everything, distance)]
        at = 0
        while stack:
            node, members, distance = stack.pop()
            if node < 0:
                self.end[~node] = at
                continue
            self.start[node] = at
            radius = self.radius[node]
            if len(members) <= LEAF or radius == 0.0:
                pieces.append(members)
                at += len(members)
                self.end[node] = at
                continue
            reach = radius / SHRINK
            groups, singles = [], []
            left, apart = members, distance
            centre = self.centre[node]
            while len(left):
                near = apart <= reach
                group, spread = left[near], apart[near]
                if len(group) == 1:
                    singles.append(int(group[0]))
                else:
                    groups.append((centre, group, spread))
                left = left[~near]
                if len(left):
                    centre = int(left[0])
                    apart = np.linalg.norm(self.points[left] - self.points[centre], axis=1)
            stack.append((~node, members, distance))
            # Children with one point have radius 0: they are kept as one run of points.
            for first in range(0, len(singles), LEAF):
                run = np.array(singles[first:first + LEAF])
                apart = np.linalg.norm(self.points[run] - self.points[run[0]], axis=1)
                child = self._node(int(run[0]), float(apart.max()))
                self.children[node].append(child)
                self.start[child], self.end[child] = at, at + len(run)
                pieces.append(run)
                at += len(run)
            for centre, group, spread in groups:
                child = self._node(centre, float(spread.max()))
                self.children[node].append(child)
                stack.append((child, group, spread))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return np.einsum("ik,jk->ij", a.astype(np.int64), b.astype(np.int64))


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of each query's k best rows, ids -1 where there are fewer.

    Larger scores first, then smaller ids; rows with the query's own id are left out.
    """
    best = np.full((len(queries), k), np.iinfo(np.int64).min)
    ids = np.full((len(queries), k), -1, np.int64)
    if not len(queries) or not len(rows):
        return ids, best
    left, right = CoverTree(queries), CoverTree(rows)
    worst = np.full(len(queries), -np.inf)

    def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The best possible product of any points of the nodes, a little rounded up."""
        top = (left.centres[a] @ right.centres[b].T + left.radii[a][:, None] * right.norms[b][None, :]
               + left.norms[a][:, None] * right.radii[b][None, :] + np.outer(left.radii[a], right.radii[b]))
        return top + 1e-9 * np.abs(top) + 0.5

    def compare(a: int, b: int) -> None:
        """All points of one node with all of the other."""
        qs = left.order[left.start[a]:left.end[a]]
        rs = right.order[right.start[b]:right.end[b]]
        scores = _products(queries[qs], rows[rs])
        own = query_ids[qs][:, None] == row_ids[rs][None, :]
        hits = (scores >= worst[qs][:, None]) & ~own
        for i in np.flatnonzero(hits.any(axis=1)):
            q, take = qs[i], np.flatnonzero(hits[i])
            got, names = np.concatenate([best[q], scores[i][take]]), np.concatenate([ids[q], row_ids[rs[take]]])
            keep = np.lexsort((names, -got, names < 0))[:k]
            best[q], ids[q] = got[keep], names[keep]
            worst[q] = best[q][-1] if ids[q][-1] >= 0 else -np.inf

    stack = [(0, 0, float(bound(np.array([0]), np.array([0]))[0, 0]))]
    while stack:
        a, b, top = stack.pop()
        if top < worst[left.order[left.start[a]:left.end[a]]].min():
            continue
        if not left.children[a] and not right.children[b]:
            compare(a, b)
            continue
        if left.children[a] and (not right.children[b] or left.radius[a] >= right.radius[b]):
            pairs = [(child, b) for child in left.children[a]]
            tops = bound(np.array(left.children[a]), np.array([b]))[:, 0]
        else:
            pairs = [(a, child) for child in right.children[b]]
            tops = bound(np.array([a]), np.array(right.children[b]))[0]
        # The most promising pair is taken first, so that the others meet a high kth score.
        stack.extend((*pairs[i], float(tops[i])) for i in np.argsort(tops, kind="stable"))
    return ids, best


def whole_numbers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(256 * x) of every component, as doubles, without unusable vectors."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(256.0)).cast("double"))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, vector in enumerate(column):
        out[i, :len(vector)] = vector
    return out


def _pair(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    names = ["query_id", "query_row", "vec_id", "score"]
    if not len(queries) or not len(rows):
        return pd.DataFrame({name: np.zeros(0, np.int64) for name in names})
    # One order of the rows, whatever order they arrive in.
    rows = rows.sort_values("vec_id", kind="stable")
    width = max(1, int(max(rows["v"].map(len).max(), queries["v"].map(len).max())))
    ids, scores = search(_matrix(queries["v"], width), queries["query_id"].to_numpy(), _matrix(rows["v"], width),
                         rows["vec_id"].to_numpy(), k)
    found = ids >= 0
    which = np.nonzero(found)[0]
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[which],
                         "query_row": queries["query_row"].to_numpy()[which],
                         "vec_id": ids[found], "score": scores[found]})


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, row_block: int = ROW_BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's k best rows.

    ``is_query`` marks the queries by ``vec_id``. Each row goes to one block for each block of
    queries, each query to every block of rows.
    """
    numbers = whole_numbers(vectors)
    asked = (numbers.where(is_query).dropDuplicates(["vec_id", "v"])
             .select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "v").alias("query_row"), "v"))
    counted = numbers.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    row_blocks, query_blocks = -(-max(counted["n"], 1) // row_block), -(-max(counted["q"], 1) // query_block)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # The second seed keeps the blocks of equal vectors apart: blocks hold rows of any kind.
    rows = (numbers.withColumn("b", F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(row_blocks)).cast("int"))
            .withColumn("a", each(query_blocks)))
    queries = (asked.withColumn("a", F.pmod(F.xxhash64("query_row", F.lit(23)), F.lit(query_blocks)).cast("int"))
               .withColumn("b", each(row_blocks)))

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _pair(left, right, k)

    found = queries.groupBy("a", "b").cogroup(rows.groupBy("a", "b")).applyInPandas(
        pair, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    # At most k rows for each query and block of rows.
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
