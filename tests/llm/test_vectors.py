"""Hard negatives (operator 11) and nearest neighbours (operator 13) against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlake.llm import hard_negatives as hn
from boardlake.llm import neighbours as nb
from boardlake.llm.common import table

DDL = "vec_id long, embedding array<float>, label int, id int, key int, score int, slot int, `_q` int, `_r` int"


def rows_of(rng, n=400, dim=9, wide=1.0):
    out = []
    for i in range(n):
        v = [round(rng.gauss(0, wide), 1) for _ in range(dim)]  # coarse: many ties
        out.append([i, v, rng.randrange(4)])
    for i in range(0, 120, 3):  # a large group of one vector
        out[i][1] = list(out[0][1])
    out[10][1], out[11][1], out[12][1] = None, [None] * dim, [*out[12][1][:-1], math.nan]
    out[13][1], out[14][2], out[15][1] = [math.inf, *out[13][1][1:]], None, []
    out[16][1], out[17][1] = out[16][1][:4], [0.0] * dim
    out[50][2], out[100][1] = None, None  # queries that take no part
    out += [[21, out[22][1], 1], [50, out[51][1], 2], [0, out[0][1], out[0][2]], [None, out[3][1], 1], *(list(out[40]) for _ in range(30))]
    rng.shuffle(out)
    return [tuple(x) for x in out]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1, 1) for r in rows], DDL).repartition(3)


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def padded(v, n):
    v = [float(np.float32(x)) for x in v]
    return v + [0.0] * (n - len(v))


def brute_negatives(rows, scale=256, np_=5, nn=3):
    own = [(i, [math.floor(scale * x) for x in padded(v, 9)], y) for i, v, y in rows if i is not None and y is not None and sound(v)]
    anchors = sorted({(i, tuple(q), y) for i, q, y in own if i % 50 == 0})
    out = []
    for a, q, y in anchors:
        scored = sorted((-sum(s * t for s, t in zip(q, p, strict=True)), i, z) for i, p, z in own)
        for s, i, _ in [x for x in scored if x[2] == y and x[1] != a][:np_]:
            fit = [(t, j) for t, j, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s][:nn]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j) in enumerate(fit)]
    return sorted(out)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for top, dim in ((2, 3), (300, 64), (5000, 700), (1 << 24, 5)):
        a, b = (rng.integers(-top, top + 1, (k, dim)) for k in (17, 40))
        bound = int(max((x.astype(object) ** 2).sum(axis=1).max() for x in (a, b)))
        primes = hn.primes_for(bound)
        assert math.prod(primes) > 2 * bound and math.prod(primes[:-1]) <= 2 * bound + 1
        got = hn.multiply(hn.residues(a, primes), hn.residues(b, primes), primes)
        assert (got == a.astype(object) @ b.astype(object).T).all()


def test_best_keeps_ties_by_place():
    scores = np.array([[3, 5, 5, 5, hn.NONE], [hn.NONE] * 5, [1, hn.NONE, 1, 1, 0]])
    row, col = hn.best(scores, 2)
    assert list(zip(row.tolist(), col.tolist(), strict=True)) == [(0, 1), (0, 2), (2, 0), (2, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, seed):
    rows = rows_of(random.Random(seed))
    got = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)
    assert got


def test_hard_negatives_of_small_tables(spark):
    none = frame(spark, rows_of(random.Random(1))).where("false")
    anchor = F.col("vec_id") % 50 == 0
    for df in (none, frame(spark, [(1, [1.0], 1)]), frame(spark, [(0, None, 1)]), frame(spark, [(0, [1.0], 1)])):
        assert hn.hard_negatives(df, anchor).collect() == []
    two = frame(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)])
    assert [tuple(r) for r in hn.hard_negatives(two, anchor).collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]
    with pytest.raises(ValueError, match="too large"):
        hn.hard_negatives(frame(spark, [(0, [1e30], 1)]), anchor)


def brute_neighbours(rows, k=5):
    own = [(i, padded(v, 9)) for i, v, _ in rows if i is not None and sound(v) and any(v)]
    out = {}
    for a, q in sorted({(i, tuple(v)) for i, v in own if i % 50 == 0}):
        cos = sorted((-nb.cosines(nb.scaled(np.array([v])), nb.scaled(np.array([q]))[0])[0], i) for i, v in own if i != a)
        out[(a, q)] = [(round(-s, 12), i) for s, i in cos[:k]]
    return sorted((a, r + 1, i, s) for (a, _), near in out.items() for r, (s, i) in enumerate(near))


def test_neighbours_with_all_rows_equal_brute_force(spark):
    rows = rows_of(random.Random(5))
    got = nb.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, share=1.0, groups=3).collect()
    assert sorted((a, r, i, round(s, 12)) for a, r, i, s in got) == brute_neighbours(rows)


def test_neighbours_of_small_tables(spark):
    query = F.col("vec_id") % 50 == 0
    none = frame(spark, rows_of(random.Random(1))).where("false")
    for df in (none, frame(spark, [(1, [1.0], 1)]), frame(spark, [(0, [1.0], 1)]), frame(spark, [(0, [0.0], 1), (1, [1.0], 1)])):
        assert nb.neighbours(df, query).collect() == []
    some = frame(spark, [(0, [1e-30, 0.0], 1), (3, [2.0, 0.0], 1), (2, [3e38, 0.0], 2), (7, [-1.0, 0.0], None)])
    assert [tuple(r) for r in nb.neighbours(some, query).collect()] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 7, -1.0)]


def test_a_forest_holds_every_row_once_in_each_tree():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 6))
    x[100:300] = x[0]  # cannot be split
    forest = nb.Forest(x, trees=3, leaf=8)
    leaves = [v for v in forest.leaf if v is not None]
    assert np.bincount(np.concatenate(leaves)).tolist() == [3] * 500
    assert len(forest.candidates(x[5], 1)) >= 1
    assert forest.candidates(x[5], 500).tolist() == list(range(500))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    """On the given vectors, noise in 64 dimensions, at least nine in ten true neighbours are found."""
    rows = table(spark, f"/root/testdata/{sf}", "embeddings")
    found = nb.neighbours(rows, F.col("vec_id") % 50 == 0).collect()
    data = rows.select("vec_id", "embedding").toPandas()
    x = np.stack(data.embedding.to_numpy()).astype(float)
    x, ids = x / np.linalg.norm(x, axis=1)[:, None], data.vec_id.to_numpy()
    asked = np.flatnonzero(ids % 50 == 0)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -9
    true = {(ids[q], ids[j]) for q, row in zip(asked, np.argsort(-score, axis=1)[:, :5], strict=True) for j in row}
    hit = len(true & {(r.query_id, r.vec_id) for r in found}) / len(true)
    assert len(found) == 5 * len(asked) and hit >= 0.9, hit
