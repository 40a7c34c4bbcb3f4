"""Hard-negative mining with exact scores from a residue number system (operator 11).

Components are scaled to integers, x to floor(scale * x), and a score is an integer inner
product.  It is found modulo several small primes: the components' residues, centred around
zero, are multiplied as float32 matrices, in strips of the inner dimension so narrow that
every sum stays below 2**24 and is exact.  The signed score is put together from its residues
by Chinese remaindering (mixed radix digits); as many primes are used as twice the largest
possible score needs, which by Cauchy-Schwarz is the largest squared norm of the rows.

Anchors meet all rows in blocks, twice: once for the best rows of their own label, the
positives, and once, with the windows that the positives' scores give, for the best rows of
other labels in each window.  A block sends only its best few of each anchor or window, and
the best of all blocks are chosen after a partial limit before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.blocks import against, matrix, sound
from boardlake.llm.common import materialise

#: Largest absolute score served: 100 times a score and the product of all primes fit a long.
LIMIT = 1 << 52
#: Sums of products of centred residues below this are exact in float32.
EXACT = 1 << 24
#: Scores held at once.
PIECE = 1 << 21
#: Below every score.
NONE = -(1 << 62)


def primes_for(bound: int, below: int = 256) -> list[int]:
    """The largest primes under ``below`` whose product exceeds twice ``bound``."""
    out, product = [], 1
    for p in range(below - 1, 2, -1):
        if all(p % k for k in range(2, int(p**0.5) + 1)):
            out.append(p)
            product *= p
            if product > 2 * bound + 1:
                return out
    raise ValueError("scores exceed what these primes tell apart")


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """For each prime the centred residues of an integer matrix, as float32."""
    out = []
    for p in primes:
        r = x % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def multiply(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The exact signed integer product of a and b transposed, from their residue matrices."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        strip = max((EXACT - 1) // (p // 2) ** 2, 1)
        rest = None
        for k in range(0, max(a[i].shape[1], 1), strip):
            part = np.remainder(a[i][:, k : k + strip] @ b[i][:, k : k + strip].T, np.float32(p)).astype(np.int64)
            rest = part if rest is None else rest + part
        rest %= p
        # mixed radix: the next digit is what the ones before leave to be explained
        weight = 1
        for q, digit in zip(primes[:i], digits, strict=True):
            rest -= digit * (weight % p)
            weight *= q
        digits.append(rest * pow(weight, -1, p) % p)
    total, weight = np.zeros_like(digits[0]), 1
    for p, digit in zip(primes, digits, strict=True):
        total += digit * weight
        weight *= p
    return np.where(total > weight // 2, total - weight, total)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest scores of each row, ties to the smaller column;
    scores of ``NONE`` do not count."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > NONE))
    else:
        row, col = np.nonzero(scores > NONE)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row[place < k], col[place < k]


class Rows:
    """A block of rows in the order of their ids, with residues."""

    def __init__(self, table: pa.Table, width: int, scale: int, primes: list[int]):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], table.column("label").to_numpy()[order]
        self.parts = residues(np.floor(scale * matrix(table.column("vector"), width)[order]).astype(np.int64), primes)

    def __len__(self) -> int:
        return len(self.ids)

    def some(self, pick: slice | np.ndarray) -> list[np.ndarray]:
        return [x[pick] for x in self.parts]


def _kept(found: list[tuple], groups: int, k: int) -> tuple[np.ndarray, ...]:
    """(group, id, score) of the k best of each group among several pieces."""
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    group, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -score, group))
    group, ids, score = group[order], ids[order], score[order]
    keep = np.arange(len(group)) - np.searchsorted(group, group, "left") < k
    return group[keep], ids[keep], score[keep]


def hard_negatives(
    rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    scale: int = 256, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors.  An anchor's positives are the ``n_positives``
    best other rows of its label; for each, the ``n_negatives`` best rows of other labels with
    ``low * positive <= 100 * negative <= high * positive`` are returned, rank from 1.  Higher
    scores come first, ties by smaller id.

    Rows with a null id, a null label, a null vector or a null or non-finite component take no
    part.  Of vectors of several lengths the shorter are filled up with zeros; an empty vector
    scores 0.  Rows that repeat an id count as rows of their own, but a row of the anchor's
    own id is none of its positives; an anchor row repeated with its label and vector counts
    once as anchor.  An empty table, or one without anchors, gives an empty result; other
    columns are ignored.  Scores beyond 2**52 are an error: the result's integers end there.
    """
    # the anchors' condition may name any column of the input, so it is set first
    valid = materialise(rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound("vector")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0)))
    n, n_anchors, width, bound = valid.agg(
        F.count("*"), F.count_if("anchor"), F.max(F.size("vector")), F.max(norm)
    ).first()
    bound = int((bound or 0) * 1.0001) + 1
    if bound > LIMIT:
        raise ValueError(f"a score may be {bound}; the components are too large for exact scores of {LIMIT}")
    primes, width = primes_for(bound), max(width or 0, 1)
    mine = valid.where("anchor").withColumn("key", F.xxhash64("id", "label", "vector")).dropDuplicates(["id", "key"]).drop("anchor")
    others = valid.drop("anchor")

    def steps(a: Rows, b: Rows):
        size = max(PIECE // max(len(b), 1), 16)
        for i in range(0, len(a), size):
            for j in range(0, len(b), PIECE // 16):
                yield i, j, multiply(a.some(slice(i, i + size)), b.some(slice(j, j + PIECE // 16)), primes)

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(left.column("id").to_numpy(), kind="stable")
        keys = left.column("key").to_numpy()[order]
        a, b = Rows(left, width, scale, primes), Rows(right, width, scale, primes)
        found = []
        for label in np.unique(a.labels):  # only rows of an anchor's label are multiplied
            pick, own = np.flatnonzero(a.labels == label), np.flatnonzero(b.labels == label)
            size = max(PIECE // max(len(own), 1), 16)
            for k in range(0, len(pick) if len(own) else 0, size):
                sub = pick[k : k + size]
                score = multiply(a.some(sub), b.some(own), primes)
                score[a.ids[sub][:, None] == b.ids[own][None, :]] = NONE
                r, c = best(score, n_positives)
                found.append((sub[r], b.ids[own[c]], score[r, c]))
        group, ids, score = _kept(found, len(a), n_positives)
        return pa.table({"id": a.ids[group], "key": keys[group], "other": ids, "score": score})

    near = against(mine, ["id", "key"], others, n_anchors, n, positives, "id long, key long, other long, score long")
    place = F.row_number().over(W.partitionBy("id", "key").orderBy(F.desc("score"), "other"))
    near = materialise(near.withColumn("slot", place).where(F.col("slot") <= n_positives))
    windows = near.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("slot", "score", "other"))).alias("near"))
    mine = mine.join(windows.withColumnsRenamed({"id": "_id", "key": "_key"}), (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key"))).select(
        "id", "key", "label", "vector", F.col("near.slot").alias("slots"), F.col("near.score").alias("scores"), F.col("near.other").alias("others")
    )

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pa.array(np.argsort(left.column("id").to_numpy(), kind="stable")))
        a, b = Rows(left, width, scale, primes), Rows(right, width, scale, primes)
        goal = np.full((len(a), n_positives), NONE)
        for k, x in enumerate(left.column("scores").to_pylist()):
            goal[k, : len(x)] = x
        found = []
        for i, j, score in steps(a, b):
            own = slice(i, i + len(score))
            score[a.labels[own][:, None] == b.labels[j : j + score.shape[1]][None, :]] = NONE
            for slot in range(n_positives):
                target = goal[own, slot]
                there = target > NONE
                floor_ = np.where(there, -(-low * np.where(there, target, 0) // 100), 1)
                top = np.where(there, high * np.where(there, target, 0) // 100, 0)
                if not ((score >= floor_[:, None]) & (score <= top[:, None])).any():
                    continue
                r, c = best(np.where((score >= floor_[:, None]) & (score <= top[:, None]), score, NONE), n_negatives)
                found.append(((i + r) * n_positives + slot, b.ids[j + c], score[r, c]))
        group, ids, score = _kept(found, 0, n_negatives)
        at, slot = group // n_positives, group % n_positives
        keys, ps = left.column("key").to_numpy(), left.column("others").to_pylist()
        positive = np.array([ps[x][y] for x, y in zip(at.tolist(), slot.tolist(), strict=True)], np.int64)
        return pa.table({"id": a.ids[at], "key": keys[at], "slot": (slot + 1).astype(np.int32), "positive": positive, "positive_score": goal[at, slot], "other": ids, "score": score})

    far = against(mine, ["id", "key"], others, n_anchors, n, negatives, "id long, key long, slot int, positive long, positive_score long, other long, score long")
    place = F.row_number().over(W.partitionBy("id", "key", "slot").orderBy(F.desc("score"), "other"))
    return far.withColumn("rank", place).where(F.col("rank") <= n_negatives).select(
        F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
