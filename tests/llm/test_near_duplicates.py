import collections
import random

import xxhash

from boardlake.llm import simhash
from boardlake.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, near):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = roots(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return collections.Counter((i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(rows, fps, root))


def test_equals_brute_force(docs, docs_rows):
    got = collections.Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == expected(docs_rows)


def test_native_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    s = "the quick brown"
    got = spark.range(1).select(F.xxhash64(F.lit(s)).alias("h")).first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest(s.encode(), 42)


def test_crowded_keys_lose_no_link(spark):
    """A dense cloud of fingerprints, once paired under their keys and once through centres."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        x = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = roots(len(signed), lambda i, j: ((signed[i] ^ signed[j]) & ((1 << 64) - 1)).bit_count() <= 2)
    want = {x: signed[r] for x, r in zip(signed, root)}
    for bucket in (1000, 3):
        got = {r.node: r.root for r in components(simhash.links(df, 2, bucket)).collect()}
        assert all(got.get(x, x) == r for x, r in want.items())


def test_pairs_within_one_bit(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (1 << 40,)], "fp long")
    for bucket in (64, 1):
        got = {tuple(sorted((r.a, r.b))) for r in simhash.links(df, 1, bucket).collect()}
        assert got == {(0, 1), (1, 3), (0, 1 << 40)}


def test_keep_one(docs, docs_rows):
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    known = [(i, plain_fingerprint(t)) for i, t in docs_rows if i is not None]
    groups = {}
    for (i, _), r in zip(known, roots(len(known), lambda a, b: (known[a][1] ^ known[b][1]).bit_count() <= 2)):
        groups[r] = min(groups.get(r, i), i)
    survivors = groups.values()  # two groups may have the same smallest id
    ids = [i for i in kept if i is not None]
    assert sorted(ids) == sorted(survivors)
    assert kept.count(None) == sum(i is None for i, _ in docs_rows)
    assert simhash.keep_one(docs).columns == docs.columns


def test_keep_one_decides_row_by_row(spark):
    """Rows of one id with different texts, in any order, each count in the group of their text."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a, "x"), (3, b, "y"), (5, b, "z"), (5, a, "w"), (5, a, "x"), (9, None, "n"), (8, "", "n"), (8, "", "n")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = simhash.keep_one(spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)).collect()
        assert sorted((r.doc_id, r.text) for r in got) == [(3, b), (5, a), (8, "")]
        assert len({tuple(r) for r in got if r.doc_id == 5}) == 1
    names = {next(r.source for r in simhash.keep_one(spark.createDataFrame(o, "doc_id long, text string, source string")).collect() if r.doc_id == 5) for o in (rows, rows[::-1])}
    assert len(names) == 1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (60, 61), (61, 60)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {61: 60}


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
