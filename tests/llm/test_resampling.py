"""Importance resampling (operator 12) against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from boardlake.llm import interning, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    ws = WORD.findall((text or "").translate(LOWER))
    return ws, [" ".join(ws[i : i + w]) for w in (1, 2, 3) for i in range(len(ws) - w + 1)]


def brute(docs, target, n=10_000, least=20, percent=5):
    of = lambda texts: Counter(zlib.crc32(f.encode()) % n for t in texts for f in features(t)[1])
    s, t = of(x for _, x in docs), of(target)
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + n) / ((s[b] + 1) * (all_t + n)))) for b in range(n)]
    out = []
    for i, text in docs:
        ws, fs = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % n] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[: percent * len(able) // 100]):
        x[4] = k + 1
    return out


def ordered(rows):
    return sorted((tuple(r)[:5] for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize(("percent", "piece"), [(5, 20_000), (37, 7), (100, 1)])
def test_equals_brute_force(spark, docs, docs_rows, percent, piece, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", piece)  # local tasks are forked before or after: both must agree
    target = [docs_rows[3][1], "ab BA ab", "", None, "x\x00y Éa éa ÉA 12\U0001f600"]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = resampling.resample(docs, bench, percent=percent).collect()
    assert ordered(got) == ordered(brute(docs_rows, target, percent=percent))


def test_pieces_cover_all_runs(docs_rows, monkeypatch):
    texts = [t or "" for _, t in docs_rows]
    for piece in (1, 2, 3, 50, 20_000):
        monkeypatch.setattr(resampling, "PIECE", piece)
        got = Counter()
        for data, starts, lens, doc in resampling.Words(texts).runs():
            raw = data.tobytes()
            got.update((d, raw[a : a + k].decode()) for d, a, k in zip(doc.tolist(), starts.tolist(), lens.tolist(), strict=True))
        assert got == Counter((d, f) for d, t in enumerate(texts) for f in features(t)[1])


def test_empty_tables(spark, docs, empty):
    target = spark.createDataFrame([("a b c",)], "text string")
    assert resampling.resample(empty, target).collect() == []
    got = resampling.resample(docs, target.where("false")).collect()
    assert len(got) == docs.count()


def test_rank_counts_repeated_rows_apart(spark):
    rows = [(1, "a " * 30)] * 200 + [(2, "b " * 30)]
    got = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame([("a",)], "text string"), percent=50).collect()
    assert sorted(r.rank for r in got if r.rank is not None) == list(range(1, 101))


def test_hashes_and_slots():
    rng = random.Random(4)
    raw = bytes(rng.choice(b"ab \xc3") for _ in range(4000))
    starts = np.array([rng.randrange(3900) for _ in range(3000)])
    lens = np.array([rng.choice((0, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 23, 31, 32, 33, 64, 90)) for _ in starts])
    data = np.frombuffer(raw + bytes(8), np.uint8)
    spans = [raw[a : a + n] for a, n in zip(starts.tolist(), lens.tolist(), strict=True)]
    for seed in (0, 42, (1 << 64) - 1):
        assert interning.hashes(data, starts, lens, seed).tolist() == [xxhash.xxh64_intdigest(x, seed) for x in spans]
    assert interning.buckets(data, starts, lens, 997).tolist() == [zlib.crc32(x) % 997 for x in spans]
    for keys in (None, np.zeros(len(spans), np.uint64), lens.astype(np.uint64)):  # clashing keys too
        slot, first = interning.intern(data, starts, lens, keys)
        assert [spans[first[s]] for s in slot] == spans
        assert len(first) == len(set(spans))


def test_a_very_long_word_and_text():
    long = "z" * 70_000
    words = resampling.Words([f"{long} {long} a", "q " * 50_000])
    got = [(data.tobytes()[a : a + n], d) for data, s, k, doc in words.runs() for a, n, d in zip(s.tolist(), k.tolist(), doc.tolist(), strict=True)]
    assert len(got) == 6 + 3 * 50_000 - 3
    data, starts, lens, _ = next(iter(resampling.Words([f"{long} {long} a"]).runs()))
    raw = data.tobytes()
    assert interning.buckets(data, starts, lens, 10_000).tolist() == [zlib.crc32(raw[a : a + n]) % 10_000 for a, n in zip(starts, lens, strict=True)]
