"""Removal of repeated byte strings by longest-previous-factor arrays (operator 1).

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
smaller id.  Whether a string at a position does is a question to the longest-previous-factor
(LPF) array of the suffixes: take all suffixes in lexicographic order, and for each the
nearest ones before and behind it in that order that come from an earlier document (the
previous and next smaller values); its longest earlier match is the longer of the two common
prefixes.  A match of ``length`` bytes or more marks the position; the first copy has no
earlier match and stays.

No task could sort the suffixes of the corpus, so they are brought together by content:

1. Documents are dealt into parts of bounded size.  In each, every start of a
   ``length``-byte string gets an anchor, the smallest hash among the ``gram``-byte strings
   inside it.  Equal strings have equal anchors.  Neighbouring starts with one anchor are a
   run.  A part sends its distinct anchors, packed by bucket of their hash.
2. A bucket returns, to the parts that sent them, the anchors met in two documents.
3. Parts send, once for each different context, the runs of these anchors with the bytes
   around them and the smallest document id.  An anchor with very many contexts (the edge of
   a passage that a third of all documents share) is not sent as one key: each of its starts
   goes by the hash of its own string, so it spreads over all buckets.
4. A bucket sorts the suffixes under its anchors by prefix doubling, finds the common
   prefixes of neighbours byte by byte, and from them and the previous and next smaller
   documents the LPF array, up to ``length``, beyond which nothing depends on it.  It returns,
   to the parts, the starts whose LPF value reaches ``length``.
5. Parts cover the bytes and cut them out.

Rows that a part or bucket puts together by hash are compared byte by byte.

Every part and bucket sends an anchor once, however many documents have it, so nothing grows
with the number of copies.  Documents and columns travel compressed.  All steps are grouped Arrow functions over one shuffle of the
documents, which the steps share; a repeated step gives the same result on another machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.llm.bpe import ragged
from boardlake.llm.common import parts_for, trim
from boardlake.llm.words import _BYTE, STEP, mix, span_hashes

GRAM = 20
#: Starts that are hashed at once, and bytes of documents in a part.
PIECE, PART_BYTES = 1 << 18, 8 << 20
#: Contexts of one anchor beyond which its starts go by their own hash.
CROWD = 2000
#: Stands for a null id: larger than any other.
NO_ID = (1 << 63) - 1
RUN, START = 0, 1  # kinds of rows sent: a run under its anchor, a start under its own hash


class Part:
    """The documents of one part, in an order that does not depend on how they arrived."""

    def __init__(self, table: pa.Table):
        trim()  # of the part before
        ids = table.column("id").combine_chunks().fill_null(NO_ID).to_numpy()
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [unpack(x.as_py()) for x in table.column("text")]
        self.order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
        self.ids = ids[self.order].astype(np.int64)
        self.texts = [texts[i] for i in self.order]
        self.lens = np.fromiter(map(len, self.texts), np.int64, len(texts))
        self.at = np.concatenate(([0], np.cumsum(self.lens)))
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)

    def runs(self, length: int) -> tuple[np.ndarray, ...]:
        """(anchor, start, number of starts, document, context hash) of every run.  Long
        documents are cut at fixed distances from their start, so copies are cut alike."""
        first, last, of = [], [], []
        for d in np.flatnonzero(self.lens >= length):
            a, stop = int(self.at[d]), int(self.at[d + 1]) - length + 1
            cuts = [*range(a, stop, PIECE), stop]
            first += cuts[:-1]
            last += cuts[1:]
            of += [int(d)] * (len(cuts) - 1)
        out: list[tuple[np.ndarray, ...]] = []
        i = 0
        while i < len(first):
            j = i + 1  # documents of one group adjoin, but for those too short for a string
            while j < len(first) and last[j] - first[i] <= PIECE:
                j += 1
            out.append(_runs(self.data[first[i] : last[j - 1] + length - 1], np.array(first[i:j]) - first[i], np.array(last[i:j]) - first[i], np.array(of[i:j]), first[i], length))
            i = j
        if not out:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint64))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def strings(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the ``length``-byte strings at these places."""
        out = [np.zeros(0, np.uint64)]
        for k in range(0, len(starts), PIECE // 16):
            data = self.data[starts[k : k + PIECE // 16, None] + np.arange(length)].ravel()
            at = np.arange(0, len(data), length)
            out.append(span_hashes(data, at, at + length))
        return np.concatenate(out)


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from every position, by doubling."""
    h, size, step = _BYTE[data], 1, np.uint64(STEP)
    done, done_size, done_step = None, 0, None
    while True:
        if n & size:
            if done is None:
                done, done_size, done_step = h, size, step
            else:
                m = len(data) - done_size - size + 1
                done = done[:m] + h[done_size : done_size + m] * done_step
                done_size, done_step = done_size + size, done_step * step
        if size * 2 > n:
            return mix(done)
        m = len(h) - size
        h = h[:m] + h[size:] * step
        with np.errstate(over="ignore"):
            step = step * step
        size *= 2


def _window_minima(data: np.ndarray, length: int) -> np.ndarray:
    """Anchor of the ``length``-byte string at every place."""
    with np.errstate(over="ignore"):
        low = _grams(data, GRAM)
    window, size = length - GRAM + 1, 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - window + size], low[window - size :]) if window > size else low


def _runs(data: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray, base: int, length: int) -> tuple[np.ndarray, ...]:
    low, window = _window_minima(data, length), length - GRAM + 1
    fresh = np.ones(len(low), bool)
    fresh[1:] = low[1:] != low[:-1]
    fresh[first] = True
    inside = np.zeros(len(low) + 1, np.int8)
    np.add.at(inside, first, 1)
    np.add.at(inside, last, -1)
    start = np.flatnonzero(fresh & (np.cumsum(inside[:-1]) > 0))
    piece = np.searchsorted(first, start, "right") - 1
    n = np.minimum(np.append(start[1:], last[-1]), last[piece]) - start
    long = n > window  # the same string over and over
    if long.any():
        times = -(-n // window)
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        start, piece, rest = np.repeat(start, times) + step * window, np.repeat(piece, times), np.repeat(n, times) - step * window
        n = np.minimum(rest, window)
    return low[start], start + base, n, of[piece], span_hashes(data, start, start + n + length - 1)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a sorted column, or several together, change."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _least(keys: tuple[np.ndarray, ...], values: np.ndarray, spans: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group rows by several hashes of their bytes: first row of each group, group of each row,
    least value.  Rows of a group are compared byte by byte with its first one; ``spans`` is
    data, starts and lengths of the rows' bytes.  Rows whose hashes clash get a group of
    their own bytes."""
    order = np.lexsort((values, *reversed(keys)))
    head = _heads(*(k[order] for k in keys)) if len(order) else np.zeros(0, np.int64)
    group = np.zeros(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
    first = order[head]
    other = np.flatnonzero(first[group] != np.arange(len(group))) if len(group) else group
    clash = other[~_equal_bytes(spans, other, first[group[other]])]
    if not len(clash):
        return first, group, values[first]
    data, at, lens = spans
    own: dict[tuple, int] = {}
    for i in clash.tolist():
        name = (int(group[i]), data[at[i] : at[i] + lens[i]].tobytes())
        group[i] = own.setdefault(name, len(head) + len(own))
    rank = np.lexsort((values, group))
    first = rank[_heads(group[rank])]
    sort = np.lexsort((first, *(k[first] for k in reversed(keys))))  # groups in the order of their hashes again
    place = np.empty(len(sort), np.int64)
    place[sort] = np.arange(len(sort))
    return first[sort], place[group], values[first[sort]]


def _equal_bytes(spans: tuple[np.ndarray, np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b have the same bytes, in pieces of bounded size."""
    data, at, lens = spans
    same = lens[a] == lens[b]
    for k in range(0, len(a), PIECE):
        rows = k + np.flatnonzero(same[k : k + PIECE])
        if len(rows):
            x, y, n = at[a[rows]], at[b[rows]], lens[a[rows]]
            word, done = _words_at(data), np.zeros(len(rows), np.int64)
            ok, open_ = np.ones(len(rows), bool), np.arange(len(rows))
            while len(open_):
                # the last eight bytes may overlap those before; every span has eight at least
                step = np.minimum(done[open_], n[open_] - 8)
                ok[open_] = word[x[open_] + step] == word[y[open_] + step]
                done[open_] += 8
                open_ = open_[ok[open_] & (done[open_] < n[open_])]
            same[rows] = ok
    return same


def _count_in(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of x hold between neighbouring places."""
    upto = np.zeros(len(x) + 1, np.int32)
    np.cumsum(x, out=upto[1:])
    return np.diff(upto[at]).astype(np.int64)


def _member(x: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether x is in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x, at


def _squeezed(values: np.ndarray) -> bytes:
    """Packed bytes of a column; of neighbouring keys only the differences, byte by byte."""
    if values.dtype == np.uint64:
        values = np.ascontiguousarray(np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unsqueezed(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    if kind is np.uint64:
        return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)
    return raw.view(kind)


def _dealt(part: int, bucket: np.ndarray, columns: dict[str, np.ndarray], wide: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, name: str = "bucket", tag: str = "part") -> pa.Table:
    """One row for each bucket, with the packed bytes of its rows' columns.  ``wide`` is bytes
    of varying length: data, starts and lengths."""
    order = np.argsort(bucket, kind="stable")
    head = _heads(bucket[order]) if len(order) else np.zeros(0, np.int64)
    stop = np.append(head, len(order))[1:]
    out = {name: pa.array(bucket[order][head].astype(np.int32)), tag: pa.array(np.full(len(head), part, np.int32)), "n": pa.array(stop - head, pa.int64())}
    for c, values in columns.items():
        values = values[order]
        out[c] = pa.array([_squeezed(values[a:b]) for a, b in zip(head, stop, strict=True)], pa.binary())
    if wide is not None:
        data, at, lens = wide
        at, lens = at[order], lens[order]
        out["context"] = pa.array([_squeezed(data[ragged(at[a:b], lens[a:b])]) for a, b in zip(head, stop, strict=True)], pa.binary())
    return pa.table(out)


def _packed(table: pa.Table, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([np.zeros(0, kind), *(_unsqueezed(x.as_py(), kind) for x in table.column(c))]) for c, kind in kinds.items()}


def _tags(table: pa.Table, tag: str) -> np.ndarray:
    return np.repeat(table.column(tag).to_numpy(), table.column("n").to_numpy())


def _anchors(data: np.ndarray, at: np.ndarray, lens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and hash of every context; contexts adjoin."""
    anchors, hashes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    step = max(PIECE // (2 * length), 1)
    for k in range(0, len(at), step):
        base, end = int(at[k]), int((at + lens)[min(k + step, len(at)) - 1])
        own, start = data[base:end], at[k : k + step] - base
        anchors.append(_window_minima(own, length)[start])
        hashes.append(span_hashes(own, start, start + lens[k : k + step]))
    return np.concatenate(anchors), np.concatenate(hashes)


SENT = {"low": np.int64, "starts": np.uint8, "kind": np.uint8}
BACK = {"key": np.uint64, "context_hash": np.uint64, "a": np.uint8, "b": np.uint8, "kind": np.uint8}


def matched(keys: np.ndarray, contexts: np.ndarray, lows: np.ndarray, starts: np.ndarray, data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every start of every row, whether an equal string starts in a document with a
    smaller id than the row's own; rows one after the other, and the row of each start."""
    row_of = np.repeat(np.arange(len(keys)), starts)
    spans = (data, at, starts.astype(np.int64) + length - 1)
    first, kind, least = _least((keys, contexts), lows, spans)  # the different contexts
    # a context alone under its anchor matches only itself
    under = _heads(keys[first])
    alone = np.zeros(len(first), bool)
    alone[under] = np.diff(np.append(under, len(first))) == 1
    n = starts[first].astype(np.int64)
    cell = np.cumsum(n) - n
    longest = np.zeros(int(n.sum()), np.int64)
    some = np.flatnonzero(~alone)
    if len(some):
        lens = n[some] + length - 1
        text = np.concatenate((data[ragged(at[first[some]], lens)], np.zeros(64, np.uint8)))
        begin = np.cumsum(lens) - lens
        doc = np.repeat(least[some], n[some])
        longest[ragged(cell[some], n[some])] = longest_previous(text, ragged(begin, n[some]), doc, length, length)
    # another row of the same context has all of its strings, the context's first one none but these
    hit = (longest >= length)[ragged(cell[kind], starts.astype(np.int64))]
    return hit | (least[kind] < lows)[row_of], row_of


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place but the last seven, as one number each."""
    return np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes from places a and b are equal, up to ``most``; text goes on eight bytes
    beyond what is compared."""
    word = _words_at(text)
    out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(open_):
        gap = word[a[open_] + out[open_]] ^ word[b[open_] + out[open_]]
        low = gap & (~gap + np.uint64(1))  # the lowest bit that differs
        equal = np.where(gap == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) >> 3)
        out[open_] += equal
        open_ = open_[(equal == 8) & (out[open_] < most)]
    return np.minimum(out, most)


def suffix_order(text: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """The suffixes in lexicographic order of their first ``length`` bytes, by prefix doubling:
    ranks of prefixes twice as long come from pairs of ranks."""
    n = len(text) - 8
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | text[k : k + n]
    _, rank = np.unique(word, return_inverse=True)
    rank, size = rank.astype(np.uint64), 8
    while size * 2 < length:
        m = len(rank) - size
        _, rank = np.unique((rank[:m] << np.uint64(32)) | rank[size : size + m], return_inverse=True)
        rank, size = rank.astype(np.uint64), size * 2
    return np.argsort((rank[suffix] << np.uint64(32)) | rank[suffix + length - size], kind="stable")


def previous_smaller(doc: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """For each place of the suffix order, the common prefix with the nearest place before it
    that has a smaller document; ``common`` is that with the place just before.  Prefixes
    shorter than ``least`` count as none.

    Every place points at one before it, with the shortest common prefix on the way.  While
    the place pointed at has no smaller document, the pointer moves to where that one points:
    nothing on the way has a smaller one.  Pointers double, so runs of equal documents cost a
    logarithmic number of rounds.
    """
    at = np.arange(len(doc)) - 1
    way = common.copy()
    open_ = np.flatnonzero((at >= 0) & (way >= max(least, 1)))
    done = np.zeros(len(doc), np.int64)
    while len(open_):
        found = doc[at[open_]] < doc[open_]
        done[open_[found]] = way[open_[found]]
        open_ = open_[~found]
        step = at[open_]
        new_at, new_way = at[step], np.minimum(way[open_], way[step])
        at[open_], way[open_] = new_at, new_way
        open_ = open_[(new_at >= 0) & (new_way >= max(least, 1))]
    return done


def longest_previous(text: np.ndarray, suffix: np.ndarray, doc: np.ndarray, length: int, least: int = 0) -> np.ndarray:
    """The longest-previous-factor array of the suffixes, up to ``length``: for each the longest
    prefix that also starts a suffix of a smaller document.

    In suffix order the best partner is the nearest place with a smaller document on either
    side, and its common prefix is the shortest of those between neighbours on the way.
    Values below ``least`` are given as 0.
    """
    order = suffix_order(text, suffix, length)
    at, number = suffix[order], doc[order]
    common = np.zeros(len(order), np.int64)
    common[1:] = common_prefixes(text, at[:-1], at[1:], length)
    before = previous_smaller(number, common, least)
    behind = previous_smaller(number[::-1], np.append(0, common[:0:-1]), least)[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, behind)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, part_bytes: int = PART_BYTES, crowd: int = CROWD, kept: str | None = "bytes") -> DataFrame:
    """(all columns of docs but the text, n_bytes, n_removed, n_spans, kept_sha256[, kept]).

    One row per input row.  ``kept`` holds what remains: its bytes, or with ``kept="text"`` a
    string, without the bytes of characters that a cut has left incomplete; ``kept=None``
    leaves the column out.  ``length`` is 33 to 63 bytes.  Null and empty texts, and texts
    shorter than ``length``, lose nothing.  A null id counts as larger than every other id.
    Ids are whole numbers, or text that reads as such.  ``docs`` is read from files or a
    checkpoint, where a repeated task finds the same rows in the same order.
    Rows that share an id do not take strings from each other, and a repeated row is treated
    like any row.  An empty table gives an empty result.  Input columns named like the results
    are replaced.
    """
    if not 33 <= length <= 63:
        raise ValueError("prefix doubling here serves 33 to 63 bytes")
    spark = docs.sparkSession
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    rest = [c for c in docs.columns if c not in (text_col, *results)]
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = parts_for(spark, total, part_bytes)
    dealt = docs.select(
        F.struct(*rest).alias("rest"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
        # equal rows are dealt over several parts, by their place in the table that is read
        F.pmod(F.xxhash64(id_col, text_col, F.pmod(F.monotonically_increasing_id(), F.lit(64))), F.lit(n)).cast("int").alias("part"),
    )
    bucket_of = lambda keys: (mix(keys) % np.uint64(n)).astype(np.int64)

    def send_anchors(table: pa.Table) -> pa.Table:
        part = Part(table)
        key, start, count, doc, context = part.runs(length)
        first, kind, _ = _least((key, context), part.ids[doc], (part.data, start, count + length - 1))
        head = _heads(key[first]) if len(first) else np.zeros(0, np.int64)
        several = np.diff(np.append(head, len(first)))
        of = np.zeros(len(first), np.int64)
        of[head[1:]] = 1
        anchor = np.cumsum(of)[kind] if len(first) else kind
        ids = part.ids[doc]
        low = np.full(len(head), NO_ID)
        high = np.full(len(head), -NO_ID - 1)
        np.minimum.at(low, anchor, ids)
        np.maximum.at(high, anchor, ids)
        info = np.minimum(several, 0x7FFF).astype(np.uint16) | ((high > low).astype(np.uint16) << 15)
        keys = key[first][head]
        return _dealt(int(table.column("part")[0].as_py()), bucket_of(keys), {"key": keys, "info": info})

    def return_anchors(table: pa.Table) -> pa.Table:
        got = _packed(table, {"key": np.uint64, "info": np.uint16})
        part = _tags(table, "part")
        order = np.argsort(got["key"], kind="stable")
        key, info, part = got["key"][order], got["info"][order], part[order]
        head = _heads(key)
        size = np.diff(np.append(head, len(key)))
        met = (size > 1) | (np.maximum.reduceat(info, head) >= 0x8000)
        crowded = np.add.reduceat((info & 0x7FFF).astype(np.int64), head) > crowd
        pick = np.repeat(met, size)
        return _dealt(0, part[pick], {"key": key[pick], "crowded": np.repeat(crowded, size)[pick].astype(np.uint8)}, name="part", tag="none").drop_columns(["none"])

    def send_contexts(table: pa.Table, back: pa.Table) -> pa.Table:
        part = Part(table)
        got = _packed(back, {"key": np.uint64, "crowded": np.uint8})
        order = np.argsort(got["key"])
        known, crowded = got["key"][order], got["crowded"][order]
        key, start, count, doc, context = part.runs(length)
        met, at = _member(key, known)
        key, start, count, doc, context = key[met], start[met], count[met], doc[met], context[met]
        single = crowded[at[met]] > 0 if len(known) else np.zeros(0, bool)
        first, _, low = _least((key[~single], context[~single]), part.ids[doc[~single]], (part.data, start[~single], count[~single] + length - 1))
        pick = np.flatnonzero(~single)[first]
        by, columns = key[pick], {"low": low, "starts": count[pick].astype(np.uint8), "kind": np.full(len(pick), RUN, np.uint8)}
        at_, lens = start[pick], count[pick] + length - 1
        if single.any():
            each, anchor, ids = _starts(part, key[single], start[single], count[single], doc[single])
            own = part.strings(each, length)
            first, kind, low = _least((own, anchor), ids, (part.data, each, np.full(len(each), length)))
            more = np.zeros(len(first), bool)
            more[kind[ids > low[kind]]] = True
            add = {"low": low, "starts": np.ones(len(first), np.uint8), "kind": np.where(more, START + 1, START).astype(np.uint8)}
            by, columns = np.concatenate((by, own[first])), {c: np.concatenate((columns[c], add[c])) for c in columns}
            at_, lens = np.concatenate((at_, each[first])), np.concatenate((lens, np.full(len(first), length)))
        return _dealt(int(table.column("part")[0].as_py()) if table.num_rows else 0, bucket_of(by), columns, (part.data, at_, lens))

    def return_matches(table: pa.Table) -> pa.Table:
        got = _packed(table, SENT)
        data = np.concatenate([_unsqueezed(x.as_py(), np.uint8) for x in table.column("context")])
        part = _tags(table, "part")
        lens = got["starts"].astype(np.int64) + length - 1
        at = np.cumsum(lens) - lens
        anchor, own = _anchors(data, at, lens, length)
        run = got["kind"] == RUN
        got["key"], got["context_hash"] = np.where(run, anchor, own), np.where(run, own, anchor)
        hit, row = matched(got["key"], got["context_hash"], got["low"], got["starts"], data, at, length)
        # runs of matching starts in a row
        at = np.flatnonzero(hit)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        head = np.flatnonzero(new)
        stop = np.append(head, len(at))[1:]
        base = np.cumsum(got["starts"].astype(np.int64)) - got["starts"]
        r = row[at[head]]
        a, b = at[head] - base[r], at[stop - 1] - base[r] + 1
        some = np.zeros(len(got["key"]), bool)
        some[r] = True
        only = np.flatnonzero((got["kind"] > START) & ~some)  # later copies in the same part
        r, a, b = np.concatenate((r, only)), np.concatenate((a, only * 0)), np.concatenate((b, only * 0))
        columns = {"key": got["key"][r], "context_hash": got["context_hash"][r], "a": a.astype(np.uint8), "b": b.astype(np.uint8), "kind": np.minimum(got["kind"][r], START)}
        return _dealt(0, part[r], columns, name="part", tag="none").drop_columns(["none"])

    def cut(table: pa.Table, back: pa.Table) -> pa.Table:
        part = Part(table)
        got = _packed(back, BACK)
        key, start, count, doc, context = part.runs(length)
        ids = part.ids[doc]
        _, kind, low = _least((key, context), ids, (part.data, start, count + length - 1))
        later = ids > low[kind]
        begin, stop = [start[later]], [start[later] + count[later] - 1 + length]
        # what came back for the first document of each context
        runs = got["kind"] == RUN
        pair = mix(got["key"][runs] * np.uint64(3) + got["context_hash"][runs])
        order = np.argsort(pair, kind="stable")
        pair, a, b = pair[order], got["a"][runs][order].astype(np.int64), got["b"][runs][order].astype(np.int64)
        mine = np.flatnonzero(~later)
        own = mix(key[mine] * np.uint64(3) + context[mine])
        lo, hi = np.searchsorted(pair, own, "left"), np.searchsorted(pair, own, "right")
        which, span = np.repeat(mine, hi - lo), ragged(lo, hi - lo)
        begin.append(start[which] + a[span])
        stop.append(start[which] + b[span] - 1 + length)
        if not runs.all():
            anchors = np.unique(got["context_hash"][~runs])
            single, _ = _member(key, anchors)
            each, anchor, ids = _starts(part, key[single], start[single], count[single], doc[single])
            own = part.strings(each, length)
            _, kind, low = _least((own, anchor), ids, (part.data, each, np.full(len(each), length)))
            flagged = np.unique(got["key"][~runs][got["b"][~runs] > 0])
            hit = (ids > low[kind]) | _member(own, flagged)[0]
            begin.append(each[hit])
            stop.append(each[hit] + length)
        change = np.zeros(len(part.data) + 1, np.int32)
        np.add.at(change, np.concatenate(begin), 1)
        np.add.at(change, np.concatenate(stop), -1)
        gone = np.cumsum(change, out=change)[:-1] > 0
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        heads = part.at[:-1][part.lens > 0]
        fresh[heads] = gone[heads]
        removed, spans = _count_in(gone, part.at), _count_in(fresh, part.at)
        left = [t if not r else part.data[a:b][~gone[a:b]].tobytes() for t, r, a, b in zip(part.texts, removed, part.at[:-1], part.at[1:], strict=True)]
        out = {
            "rest": table.column("rest").combine_chunks().take(pa.array(part.order, pa.int64())), "n_bytes": pa.array(part.lens),
            "n_removed": pa.array(removed.astype(np.int64)), "n_spans": pa.array(spans.astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
        }
        if kept == "text":
            out["kept"] = pa.array([x.decode(errors="ignore") for x in left], pa.string())
        elif kept:
            out["kept"] = pa.array(left, pa.binary())
        return pa.table(out)

    def _starts(part: Part, key: np.ndarray, start: np.ndarray, count: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        return ragged(start, count), np.repeat(key, count), np.repeat(part.ids[doc], count)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = pa.array([pack(x.as_py() or b"") for x in batch.column("text")], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("text"), "text", small)

    blob = lambda columns: ", ".join(f"{c} binary" for c in columns)
    by_part = dealt.mapInArrow(shrink, dealt.schema).groupBy("part")
    anchors = by_part.applyInArrow(send_anchors, "bucket int, part int, n long, key binary, info binary")
    shared = anchors.groupBy("bucket").applyInArrow(return_anchors, "part int, n long, key binary, crowded binary")
    sent = by_part.cogroup(shared.groupBy("part")).applyInArrow(send_contexts, f"bucket int, part int, n long, {blob(SENT)}, context binary")
    back = sent.groupBy("bucket").applyInArrow(return_matches, f"part int, n long, {blob(BACK)}")
    schema = T.StructType([
        dealt.schema["rest"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        *([T.StructField("kept", T.StringType() if kept == "text" else T.BinaryType())] if kept else []),
    ])
    done = by_part.cogroup(back.groupBy("part")).applyInArrow(cut, schema)
    return done.select("rest.*", *(c for c in done.columns if c != "rest"))
