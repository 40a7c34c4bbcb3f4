import collections
import hashlib

import numpy as np
import pandas as pd
import pytest

from boardlake.llm import repeats

NO_ID = 1 << 70


def brute(rows, length=50):
    data = [(NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            first[g] = min(first.get(g, NO_ID), i)
    out = []
    for (i, b), (raw, _) in zip(data, rows):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((raw, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize(("crowd", "part_bytes"), [(2000, 1 << 24), (2, 3000)])
def test_equals_brute_force(spark, docs, docs_rows, crowd, part_bytes):
    got = repeats.remove_repeats(docs, crowd=crowd, part_bytes=part_bytes).collect()
    found = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert found == brute(docs_rows)
    assert any(r.n_removed for r in got)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_long_documents_are_cut_alike(spark, docs, docs_rows, monkeypatch):
    """The pieces of a long document may be small: results stay."""
    part = repeats.Part.__new__(repeats.Part)
    text = ("lorem ipsum dolor sit amet %d " * 50 % tuple(range(50))).encode()
    part.ids, part.texts, part.lens = np.array([1]), [text], np.array([len(text)])
    part.at, part.data = np.array([0, len(text)]), np.frombuffer(text, np.uint8)
    whole = part.runs(50)
    monkeypatch.setattr(repeats, "PIECE", 70)
    small = part.runs(50)
    starts = lambda runs: sorted((int(k), s + i) for k, s, n, *_ in zip(*runs) for i in range(n))
    assert starts(whole) == starts(small)


def naive_lpf(strings, docs, length):
    out = []
    for s, d in zip(strings, docs, strict=True):
        best = 0
        for t, e in zip(strings, docs, strict=True):
            if e < d:
                k = 0
                while k < length and s[k] == t[k]:
                    k += 1
                best = max(best, k)
        out.append(best)
    return out


@pytest.mark.parametrize(("length", "letters", "many"), [(33, b"ab", 3), (50, b"a", 2), (50, b"abcd", 40), (63, b"ab\x00\xff", 200), (50, b"aaaab", 1)])
def test_longest_previous_factors(length, letters, many):
    rng = np.random.default_rng(length + many)
    base = rng.choice(np.frombuffer(letters, np.uint8), 400)
    text = np.concatenate([base[rng.integers(0, 100) :][:200] for _ in range(3)] + [np.zeros(64, np.uint8)])
    suffix = np.unique(rng.integers(0, len(text) - 64 - length, 300))
    docs = rng.integers(0, many, len(suffix))
    strings = [text[a : a + length].tobytes() for a in suffix]
    want = naive_lpf(strings, docs.tolist(), length)
    assert repeats.longest_previous(text, suffix, docs, length).tolist() == want
    assert repeats.longest_previous(text, suffix, docs, length, 20).tolist() == [x if x >= 20 else 0 for x in want]
    order = repeats.suffix_order(text, suffix, length)
    assert [strings[k] for k in order] == sorted(strings)


def test_previous_smaller_of_long_runs():
    n = 200_000
    doc = np.concatenate((np.zeros(1, np.int64), np.ones(n, np.int64), np.arange(n, 1, -1)))
    common = np.full(len(doc), 9)
    common[n // 2] = 4
    got = repeats.previous_smaller(doc, common, 0)
    assert got[0] == 0 and (got[1 : n // 2] == 9).all() and (got[n // 2 : n + 1] == 4).all()
    assert (got[n + 1 :] == 9).all()  # to the last of the ones


def test_rows_with_clashing_hashes_are_told_apart():
    data = np.frombuffer(b"aaaaaaaabbbbbbbbaaaaaaaaccccccccbbbbbbbbaaaaaaaa", np.uint8)
    at, lens = np.arange(0, 48, 8), np.full(6, 8)
    keys = (np.array([7, 7, 7, 7, 9, 9], np.uint64), np.array([1, 1, 1, 1, 1, 1], np.uint64))
    first, group, least = repeats._least(keys, np.array([5, 4, 3, 2, 1, 0]), (data, at, lens))
    rows = [(int(keys[0][i]), data[a : a + 8].tobytes()) for i, a in enumerate(at.tolist())]
    assert [rows[first[g]] for g in group] == rows
    assert [least[g] for g in group] == [3, 4, 3, 2, 1, 0]
    assert keys[0][first].tolist() == sorted(keys[0][first].tolist())


def test_equal_rows_are_dealt_over_parts(spark):
    rows = [(1, "same text " * 9)] * 300 + [(2, "same text " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter((r.doc_id, r.n_removed) for r in repeats.remove_repeats(df, part_bytes=2000).collect())
    assert got == {(1, 0): 300, (2, 90): 1}


def test_text_result_drops_broken_characters(spark):
    a, b = "é" * 40, "x" + "é" * 40
    df = spark.createDataFrame([(1, a), (2, b[:30] + "ß" + a)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in repeats.remove_repeats(df, kept="text").collect()}
    assert got[1] == a
    assert set(got[2]) <= set("xéß")


def test_empty_table(empty):
    assert repeats.remove_repeats(empty).count() == 0


def test_length_is_checked(docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs, length=20)
