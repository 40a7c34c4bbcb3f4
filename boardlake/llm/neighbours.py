"""Approximate nearest neighbours by forests of random-projection trees (operator 13).

All rows are dealt evenly into blocks, and each block indexes all of its rows in a forest of
its own.  A tree splits the rows of a node at the median of their projections on a random
direction, down to small leaves; rows whose projections are all equal are not split, however
many they are.  A query is searched in every block: one priority queue holds the open nodes
of all trees of the forest, cheapest first, where a node costs the squared distances from the
query to the splits passed on the wrong side.  Leaves are opened until ``share`` of the
block's rows, and ``ENOUGH`` at least, are candidates, and the candidates are ranked by their exact cosine.  The best of
all blocks are chosen after a partial limit before the shuffle.

The share is what recall depends on: vectors without any structure, 64 dimensions of noise,
need about half of the rows for nine in ten of the true neighbours.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.blocks import against, matrix, sound
from boardlake.llm.common import materialise

TREES, LEAF, SHARE, SEED = 16, 16, 0.6, 42
#: Candidates of a query in a block at least, if it has so many rows.
ENOUGH = 512
#: Blocks of rows in small tables at most, and rows of such a block at least.
GROUPS, LEAST = 12, 1024
#: Leaves of a tree, about, in large blocks.
LEAVES = 256


class Forest:
    """Random-projection trees over unit vectors; all trees share the node arrays."""

    def __init__(self, unit: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        rng, self.size = np.random.default_rng(seed), len(unit)
        self.direction: list[int] = []  # row of ``planes``, -1 for a leaf
        self.cut: list[float] = []
        self.child: list[tuple[int, int]] = []
        self.leaf: list[np.ndarray | None] = []
        self.roots = []
        depth = max(math.ceil(math.log2(max(len(unit), 1) / leaf)), 0) + 1 if len(unit) > leaf else 0
        planes = [np.zeros((0, unit.shape[1]))]
        for t in range(trees):
            # one direction for each level; orthogonal ones see different parts of a vector
            own = rng.standard_normal((unit.shape[1], max(min(depth, unit.shape[1]), 1)))
            own = np.linalg.qr(own)[0].T
            planes.append(own)
            self.roots.append(self._grow(np.arange(len(unit)), unit @ own.T, 0, t * len(own), leaf))
        self.planes = np.concatenate(planes)

    def _node(self, direction: int, cut: float, child: tuple[int, int], rows: np.ndarray | None) -> int:
        self.direction.append(direction)
        self.cut.append(cut)
        self.child.append(child)
        self.leaf.append(rows)
        return len(self.leaf) - 1

    def _grow(self, rows: np.ndarray, seen: np.ndarray, level: int, base: int, leaf: int) -> int:
        if len(rows) <= leaf or level == seen.shape[1]:
            return self._node(-1, 0.0, (-1, -1), rows)
        x = seen[rows, level]
        cut = float(np.median(x))
        right = x > cut
        if not right.any():  # many equal ones at the top: between them and the rest
            right = x >= cut
            if right.all():
                return self._grow(rows, seen, level + 1, base, leaf)
            cut = (cut + float(x[~right].max())) / 2
        a = self._grow(rows[~right], seen, level + 1, base, leaf)
        b = self._grow(rows[right], seen, level + 1, base, leaf)
        return self._node(base + level, cut, (a, b), None)

    def candidates(self, query: np.ndarray, enough: int) -> np.ndarray:
        """Numbers of at least ``enough`` rows (all, if fewer), from the cheapest leaves."""
        seen = (self.planes @ query).tolist()
        found = np.zeros(self.size, bool)
        queue = [(0.0, r) for r in self.roots]
        heapq.heapify(queue)
        n = 0
        while queue and n < enough:
            cost, node = heapq.heappop(queue)
            while self.direction[node] >= 0:
                off = seen[self.direction[node]] - self.cut[node]
                a, b = self.child[node]
                near, far = (b, a) if off > 0 else (a, b)
                heapq.heappush(queue, (cost + off * off, far))
                node = near
            rows = self.leaf[node]
            n += len(rows) - int(np.count_nonzero(found[rows]))
            found[rows] = True
        return np.flatnonzero(found)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near one: squares neither
    overflow nor vanish, and no bit changes."""
    top = np.abs(x).max(axis=1, initial=0.0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of every row of a with the vector b; equal rows have equal results."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * math.sqrt(float((b * b).sum())))


def neighbours(
    rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
    share: float = SHARE, trees: int = TREES, leaf: int = LEAF, groups: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest cosine among those that
    the forests find for each row that ``queries`` names, rank from 1, ties to the smaller id.

    Candidates are all rows but those of the query's own id; of fewer than ``k`` candidates
    all are returned.  Rows with a null id, and vectors that are null, empty or zero or hold a
    null or non-finite component, take no part.  Of vectors of several lengths the shorter are
    filled up with zeros.  Rows that repeat an id are candidates of their own; a query row
    repeated with its vector counts once as query.  An empty table, or one without queries,
    gives an empty result; other columns are ignored.  ``share`` 1 makes the search exact.
    """
    valid = materialise(rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("query"),
    ).where(F.col("id").isNotNull() & sound("vector") & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))))
    n, n_queries, width = valid.agg(F.count("*"), F.count_if("query"), F.max(F.size("vector"))).first()
    width, groups = width or 1, groups or max(min(GROUPS, n // LEAST), 1)
    asked = valid.where("query").withColumn("key", F.xxhash64("id", "vector")).dropDuplicates(["id", "key"]).drop("query")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], scaled(matrix(right.column("vector"), width)[order])
        unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
        forest = Forest(unit, trees, max(leaf, len(unit) // LEAVES))
        out: dict[str, list] = {c: [] for c in ("id", "key", "other", "score")}
        asks = zip(left.column("id").to_pylist(), left.column("key").to_pylist(), scaled(matrix(left.column("vector"), width)), strict=True)
        for own, key, q in asks if len(ids) else ():
            copies = int(np.searchsorted(ids, own, "right") - np.searchsorted(ids, own, "left"))
            got = forest.candidates(q / math.sqrt(float((q * q).sum())), max(math.ceil(share * len(ids)), ENOUGH, k + copies))
            got = got[ids[got] != own]
            score = unit[got] @ q
            if len(got) > k:  # rounding differs by place: leave room, then rank by the exact measure
                least = np.partition(score, len(got) - k)[-k]
                got = got[score >= least - 1e-9]
            score = cosines(x[got], q)
            first = np.lexsort((ids[got], -score))[:k]
            for c, values in (("id", [own] * len(first)), ("key", [key] * len(first)), ("other", ids[got[first]].tolist()), ("score", score[first].tolist())):
                out[c] += values
        return pa.table({"id": pa.array(out["id"], pa.int64()), "key": pa.array(out["key"], pa.int64()), "other": pa.array(out["other"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    found = against(asked, ["id", "key"], valid.drop("query"), n_queries, n, search, "id long, key long, other long, score double", groups)
    place = F.row_number().over(W.partitionBy("id", "key").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", F.col("other").alias("vec_id"), "score")
