import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken  # noqa: F401
from tokenizers import Tokenizer

from boardlake.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def auto():
    return bpe.Automaton(bpe.read_vocabulary(PATH))


def test_encodes_as_the_library(auto):
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    bits = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "Zebra", "1", "22", "!", "é", "中", "\u00a0", "\x85", "🙂", "<|endoftext|>", "_", "\u2028"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    texts += ["", "aaaaaaaaaaaaaaaa" * 50, "the " * 300, "don't can't we'll'll 're"]
    every = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["a".join(every[i : i + 200]) for i in range(0, len(every), 200)]
    for text, ids in zip(texts, auto.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
        assert auto.labels(ids)[0].tobytes().decode() == text


def test_transitions_equal_the_gadgets(auto):
    rng = random.Random(3)
    alive = [t for t, a in enumerate(auto.alive) if a]
    for _ in range(4000):
        s, t = auto.target[rng.choice(alive)], rng.choice(alive)
        assert auto._follows(s, t) == auto._arc(s, t)


def test_long_text_in_units(auto, monkeypatch):
    text = "some words and more of them, isn't it " * 40
    whole = next(auto.encode([text])).tolist()
    monkeypatch.setattr(bpe, "UNIT", 37)
    assert next(auto.encode([text])).tolist() == whole


def test_hash_collision_is_repaired(auto, monkeypatch):
    monkeypatch.setattr(bpe, "span_hashes", lambda data, a, b: np.zeros(len(a), np.uint64))
    assert next(auto.encode(["two words"])).tolist() == Tokenizer.from_file(PATH).encode("two words").ids


def test_query_columns(docs, docs_rows):
    tokenizer = Tokenizer.from_file(PATH)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(docs, PATH).collect())
    want = []
    for i, t in docs_rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)


def sections_of(tokenizer, text):
    """By the library's own offsets, one token after the other."""
    raw = text.encode()
    ends = [k + 1 for k, b in enumerate(raw) if b == 10] + [len(raw)]
    counts = [0] * len(ends)
    at = 0
    for label in (tokenizer.decode_single_token_bytes(t) for t in tokenizer.encode_ordinary(text)):
        share = [0] * len(ends)
        for p in range(at, at + len(label)):
            share[next(k for k, e in enumerate(ends) if p < e)] += 1
        counts[share.index(max(share))] += 1
        at += len(label)
    return counts


def test_sections_by_brute_force(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = ["a line\nand another\n\n\nthe end\n", "\n\n", "", None, "x\r\n\r\n  y", "é\n中文\n\n\n\n!", "one line"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = token_counts.section_tokens(df, path, public_tokenizers.PATTERN).collect()
    with open(path, "rb") as f:
        encoder, _ = token_counts._encoder(f.read(), public_tokenizers.PATTERN)
    for i, text in enumerate(texts):
        own = sorted((r.section, r.char_start, r.char_end, r.n_tokens) for r in rows if r.doc_id == i)
        assert [x[3] for x in own] == sections_of(encoder, text or "")
        assert sum(x[3] for x in own) == len(encoder.encode_ordinary(text or ""))
        assert "".join((text or "")[a:b] for _, a, b, _ in own) == (text or "")


def test_crossing_rule():
    got = token_counts.attribute(np.array([2, 5, 9]), np.array([1, 6, 6, 9]))
    assert got.tolist() == [0, 1, 3]


def test_empty(empty):
    assert bpe.encode_decode(empty, PATH).count() == 0
    assert token_counts.section_tokens(empty, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
