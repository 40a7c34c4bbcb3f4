"""An open-addressed table of byte strings as NumPy arrays."""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

#: The constants of XXH64.
P1, P2, P3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
P4, P5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
#: Strings of this many bytes and more go through the library one by one.
LONG = 32


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of byte spans.  ``data`` has eight bytes more than the last span needs."""
    u = np.uint64
    word = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    half = np.ndarray(max(len(data) - 3, 0), "<u4", data, strides=(1,))
    with np.errstate(over="ignore"):
        h = lens.astype(u) + u((seed + P5) % (1 << 64))
        # longest first: the spans that have a next step are always a prefix
        rank = (LONG - np.minimum(lens, LONG)).astype(np.uint8)
        order = np.argsort(rank, kind="stable")
        at, left, h = starts[order], lens[order], h[order]
        count = np.cumsum(np.bincount(rank, minlength=LONG + 1))
        skip = int(count[0])  # these are done by the library below
        for k in range(LONG // 8 - 1):
            n = int(count[LONG - 8 * (k + 1)])
            if n <= skip:
                break
            x = _rotl(word[at[skip:n] + 8 * k] * u(P2), 31) * u(P1)
            h[skip:n] = _rotl(h[skip:n] ^ x, 27) * u(P1) + u(P4)
        at, left = at + (left & ~7), left & 7
        some = np.flatnonzero(left >= 4)
        h[some] = _rotl(h[some] ^ (half[at[some]].astype(u) * u(P1)), 23) * u(P2) + u(P3)
        at, left = at + (left & 4), left & 3
        for k in range(3):
            some = np.flatnonzero(left > k)
            if not len(some):
                break
            h[some] = _rotl(h[some] ^ (data[at[some] + k].astype(u) * u(P5)), 11) * u(P1)
        h ^= h >> u(33)
        h *= u(P2)
        h ^= h >> u(29)
        h *= u(P3)
        h ^= h >> u(32)
    out = np.empty(len(h), u)
    out[order] = h
    if skip:
        raw, digest = data.tobytes(), xxhash.xxh64_intdigest
        a, b = starts[order[:skip]].tolist(), (starts + lens)[order[:skip]].tolist()
        out[order[:skip]] = [digest(raw[i:j], seed) for i, j in zip(a, b, strict=True)]
    return out


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether the spans from a and from b, of equal lengths, have the same bytes."""
    word = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    same = np.ones(len(a), bool)
    last = np.maximum(lens - 8, 0)  # the last eight bytes may overlap those before
    cut = (np.maximum(8 - lens, 0) * 8).astype(np.uint64)
    some = lens > 0
    same &= ~some | ((word[a + last] ^ word[b + last]) << np.where(some, cut, np.uint64(0)) == 0)
    k, open_ = 0, np.flatnonzero(lens > 8)
    while len(open_):
        same[open_] &= word[a[open_] + k] == word[b[open_] + k]
        k += 8
        open_ = open_[last[open_] > k]
    return same


def intern(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(slot of every span, first span of every slot): equal byte strings share a slot.

    Spans are put into a table of at least twice their number of places, from the place of
    their key onwards.  In each round all spans that are still open look at one place: an empty
    one is taken by one of them, and who meets its own key there and the same length and bytes
    has found its slot; the others go on to the next place.  ``data`` has eight bytes more
    than the last span needs.
    """
    keys = hashes(data, starts, lens) if keys is None else keys
    n = len(starts)
    size = 1 << max(2 * n - 1, 1).bit_length()
    held = np.full(size, -1, np.int32)  # the span that has taken a place
    place = (keys & np.uint64(size - 1)).astype(np.int64)
    open_, at = np.arange(n, dtype=np.int32), place
    while len(open_):
        free = np.flatnonzero(held[at] < 0)
        held[at[free]] = open_[free]  # of several, one stays
        owner = held[at]
        test = np.flatnonzero(owner != open_)
        mine, other = open_[test], owner[test]
        like = (keys[other] == keys[mine]) & (lens[other] == lens[mine])
        known = np.flatnonzero(like)
        like[known] = _same(data, starts[other[known]], starts[mine[known]], lens[mine[known]])
        open_ = mine[~like]
        at = (place[open_] + 1) & (size - 1)
        place[open_] = at
    taken = np.flatnonzero(held >= 0)
    number = np.zeros(size, np.int64)
    number[taken] = np.arange(len(taken))
    return number[place], held[taken]


def _crc_table(bits: int) -> np.ndarray:
    """What ``bits`` low bits of the register add to it, for the reversed polynomial of crc32."""
    c = np.arange(1 << bits, dtype=np.uint32)
    for _ in range(bits):
        c = (c >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (c & np.uint32(1)))
    return c


_ONE, _TWO = _crc_table(8), _crc_table(16)


def buckets(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, n: int) -> np.ndarray:
    """crc32 of the spans' bytes modulo n, two bytes at a time."""
    pair = np.ndarray(max(len(data) - 1, 0), "<u2", data, strides=(1,))
    c = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    short = np.flatnonzero(lens < 1 << 16)
    order = short[np.argsort((0xFFFF - lens[short]).astype(np.uint16), kind="stable")]
    at, half, r = starts[order], lens[order] >> 1, c[order]
    left = np.cumsum(np.bincount(half, minlength=1)[::-1])[::-1]  # spans with at least so many pairs
    for k in range(len(left) - 1):
        m = int(left[k + 1])
        r[:m] = _TWO[(r[:m] ^ pair[at[:m] + 2 * k]) & np.uint32(0xFFFF)] ^ (r[:m] >> np.uint32(16))
    odd = np.flatnonzero(lens[order] & 1)
    r[odd] = _ONE[(r[odd] ^ data[at[odd] + lens[order[odd]] - 1]) & np.uint32(0xFF)] ^ (r[odd] >> np.uint32(8))
    c[order] = r ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(lens >= 1 << 16).tolist():
        c[k] = zlib.crc32(data[starts[k] : starts[k] + lens[k]])
    return c.astype(np.int64) % n
