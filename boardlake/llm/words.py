"""Words and their hashes over whole batches of text, as numpy arrays of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

#: An odd multiplier and its inverse modulo 2**64; positions are weighted with its powers.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]
#: Word characters: ASCII letters and digits, and every byte of a longer character.
WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
#: Only U+0009 to U+000D and U+0020 separate.
INK_BYTE = np.array([b not in (9, 10, 11, 12, 13, 32) for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((STEP, BACK)):
            p = np.full(n, base, np.uint64)
            p[:1] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=upto[1:])
    return mix((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def join_units(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with a line feed behind each, and where each text starts (one more at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate(([0], np.cumsum(lens)))


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; data ends with a byte outside words."""
    ink = is_word[data]
    edge = np.flatnonzero(np.diff(ink, prepend=False))
    return edge[::2], edge[1::2]


def chunks(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in lists of about ``limit`` characters; null counts as empty."""
    own: list[str] = []
    size = 0
    for text in texts:
        own.append(text or "")
        size += len(own[-1])
        if size >= limit:
            yield own
            own, size = [], 0
    if own:
        yield own
