"""BPE encoding and decoding with a tokenization automaton (operator 3).

``compile_merges`` builds a deterministic automaton over tokens: from one state with a loop
for every byte, each merge (u, v) adds a gadget.  Where u leads to a state p that has an arc
v, a copy of p without v is made and every u-arc is led there, so u can no longer be followed
by v; and every state with a u-arc gets an arc for the merged token uv, to where v led.
Every token has one target state, whatever its source, and a state differs from its parent
by one removed arc.  So the automaton is three arrays over states and four over tokens; the
transitions met are kept in a table.

A path spells a pre-split word in exactly one way, and that is its BPE encoding.  The
encoder follows the longest arc first and steps back where no arc goes on; a position that
led nowhere is not entered again.  Decoding emits the byte labels of the arcs.

Text is cut into words by the class of its code points, over whole batches of documents.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import trim
from boardlake.llm.words import span_hashes

LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3
#: The endings that the pre-split pattern of this vocabulary cuts off.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Code points of text handled at once, distinct words and transitions kept by a worker.
UNIT, WORDS_KEPT, STEPS_KEPT = 1 << 19, 150_000, 200_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others are numbered from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """The compiled merges of one vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.label = [b""] * size
        for s, t in vocab.items():
            if s not in self.special:
                self.label[t] = raw(s)
        for s, t in self.special.items():
            self.label[t] = s.encode()
        self._compile([(vocab[u], vocab[v], vocab[u + v]) for u, v in merges], size)
        self._spell()
        self._number()
        lens = np.array([len(x) for x in self.label], np.int64)
        self.label_at = np.concatenate(([0], np.cumsum(lens)))
        self.label_bytes = np.frombuffer(b"".join(self.label), np.uint8)
        self.steps: dict[int, bool] = {}
        self.words: dict[bytes, tuple[int, ...]] = {}

    def _compile(self, merges: Sequence[tuple[int, int, int]], size: int) -> None:
        self.left = [-1] * size
        self.born = [-1] * size
        self.alive = [bool(x) and len(x) == 1 for x in self.label]
        self.target = [0] * size
        self.parent, self.removed, self.made = [-1], [-1], [-1]
        for k, (u, v, w) in enumerate(merges):
            p = self.target[u]
            if not (self.alive[u] and self.alive[v] and self._arc(p, v)):
                continue  # u is never followed by v: no path has the merged token
            self.left[w], self.born[w], self.alive[w] = u, k, True
            self.target[w] = self.target[v]
            self.target[u] = len(self.made)
            self.parent.append(p)
            self.removed.append(v)
            self.made.append(k)

    def _arc(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token."""
        while state:
            if self.born[token] >= self.made[state]:
                token = self.left[token]  # the arc came with the one for its left part
            elif token == self.removed[state]:
                return False
            else:
                state = self.parent[state]
        return True

    def _spell(self) -> None:
        """The trie of arc labels, and for each token the longest other one that starts it."""
        self.trie: dict = {}
        self.shorter = [-1] * len(self.label)
        self.size = [len(x) for x in self.label]
        for t, label in sorted(enumerate(self.label), key=lambda x: len(x[1])):
            if label and self.alive[t]:
                node = self.trie
                for b in label:
                    self.shorter[t] = node.get(-1, self.shorter[t])
                    node = node.setdefault(b, {})
                node[-1] = t

    def _number(self) -> None:
        """Number the states so that the copies of a state, and theirs, are an interval.  The
        states that lack an arc x because of one gadget each are disjoint intervals."""
        n = len(self.made)
        below = [1] * n
        for s in range(n - 1, 0, -1):
            below[self.parent[s]] += below[s]
        first, free = [0] * n, [1] * n
        for s in range(1, n):
            p = self.parent[s]
            first[s] = first[p] + free[p]
            free[p] += below[s]
        self.first = first
        self.lacking: dict[int, list[tuple[int, int, int]]] = {}
        for s in range(1, n):
            self.lacking.setdefault(self.removed[s], []).append((first[s], first[s] + below[s], self.made[s]))
        for spans in self.lacking.values():
            spans.sort()

    def _follows(self, state: int, token: int) -> bool:
        """As ``_arc``, by the intervals: an arc is missing if a gadget removed the token, or
        removed a left part of it before the token came to be."""
        at, above = self.first[state], -1
        while token >= 0:
            spans = self.lacking.get(token)
            if spans:
                k = bisect_right(spans, (at, len(self.made))) - 1
                if k >= 0 and at < spans[k][1] and (above < 0 or self.born[above] >= spans[k][2]):
                    return False
            above, token = token, self.left[token]
        return True

    def word(self, word: bytes) -> tuple[int, ...]:
        """The ids of one pre-split word: the path that spells it, longest arcs tried first."""
        got = self.words.get(word)
        if got is not None:
            return got
        n, steps, trie, size = len(word), self.steps, self.trie, self.size
        dead = bytearray(n + 1)
        path: list[tuple[int, int, int]] = []
        at, state, token = 0, 0, -2
        while at < n:
            if token == -2:  # the longest arc that spells what follows
                node, j = trie, at
                while node is not None:
                    token = node.get(-1, token)
                    node = node.get(word[j]) if j < n else None
                    j += 1
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    key = state << 20 | token
                    ok = steps.get(key)
                    if ok is None:
                        if len(steps) >= STEPS_KEPT:
                            steps.clear()
                        ok = steps[key] = self._follows(state, token)
                    if ok:
                        break
                token = self.shorter[token]
            if token >= 0:
                path.append((at, state, token))
                at, state, token = end, self.target[token], -2
            else:  # no path from here
                dead[at] = 1
                at, state, token = path.pop()
                token = self.shorter[token]
        got = tuple([t for _, _, t in path])
        if len(self.words) >= WORDS_KEPT:
            self.words.clear()
        self.words[word] = got
        return got

    def forget(self) -> None:
        """Free what was kept for speed; the worker may serve other tasks next."""
        self.words.clear()
        self.steps.clear()
        trim()

    def labels(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes the ids spell, and where each id's bytes end."""
        lens = self.label_at[ids + 1] - self.label_at[ids]
        return self.label_bytes[ragged(self.label_at[ids], lens)], np.cumsum(lens)

    def encode_units(self, units: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after the other, and where each unit's ids start (one more at the end)."""
        data, starts, unit_at = split_words(units)
        ends = np.append(starts[1:], len(data))
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(units) + 1, np.int64)
        _, first, kind = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        a, b = starts[first].tolist(), ends[first].tolist()
        found = [self.word(raw[i:j]) for i, j in zip(a, b, strict=True)]
        ids, counts = self._spread(found, kind)
        spelt, _ = self.labels(ids)
        if not np.array_equal(spelt, data):  # two words with one hash
            found = [self.word(raw[i:j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
            ids, counts = self._spread(found, np.arange(len(found)))
        upto = np.concatenate(([0], np.cumsum(counts)))
        return ids, upto[np.searchsorted(starts, unit_at)]

    @staticmethod
    def _spread(found: list[tuple[int, ...]], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for x in found for t in x), np.int64, int(lens.sum()))
        at = np.cumsum(lens) - lens
        return flat[ragged(at[kind], lens[kind])], lens[kind]

    def encode(self, texts: Sequence[str | None], special: bool = True) -> Iterator[np.ndarray]:
        """Ids of each text.  With ``special``, special strings in a text get their own id."""
        cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if special and self.special else None
        pending: list[list] = []
        units: list[str] = []
        size = 0
        for text in texts:
            parts: list = []
            for k, piece in enumerate(cut.split(text or "") if cut else [text or ""]):
                if k % 2:
                    parts.append(self.special[piece])
                    continue
                for unit in long_pieces(piece):
                    parts.append((len(units),))
                    units.append(unit)
                    size += len(unit)
            pending.append(parts)
            if size >= UNIT:
                yield from self._flush(pending, units)
                pending, units, size = [], [], 0
        yield from self._flush(pending, units)

    def _flush(self, pending: list[list], units: list[str]) -> Iterator[np.ndarray]:
        ids, at = self.encode_units(units)
        for parts in pending:
            own = [ids[at[p[0]] : at[p[0] + 1]] if isinstance(p, tuple) else np.array([p]) for p in parts]
            yield own[0] if len(own) == 1 else np.concatenate(own) if own else ids[:0]


def ragged(at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of all spans (at, length), one after the other."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lens > 0
    at, lens = at[keep], lens[keep]
    step = np.ones(total, np.int64)
    step[0] = at[0]
    step[np.cumsum(lens)[:-1]] = at[1:] - (at[:-1] + lens[:-1] - 1)
    return np.cumsum(step)


def long_pieces(text: str) -> Iterator[str]:
    """A long text in pieces, cut in front of single spaces between words, where words end anyway."""
    start = 0
    while len(text) - start > UNIT:
        m = _CUT.search(text, start + UNIT)
        if not m:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


_CUT = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point."""
    if not _CLASSES:
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
            for run in regex.findall(pattern, every):
                table[np.frombuffer(run.encode("utf-32-le"), np.uint32)] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def split_words(units: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all units, the byte starts of their words, and of the units (one more at the end)."""
    text = "".join(units)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    data = np.frombuffer(text.encode(), np.uint8)
    lens = np.fromiter(map(len, units), np.int64, len(units))
    unit_at = np.concatenate(([0], np.cumsum(lens)))
    n = len(code)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(len(units) + 1, np.int64)
    kind = classes()[code]
    fresh = np.zeros(n + 1, bool)
    fresh[unit_at] = True
    start = fresh[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    body = kind != BLANK
    run = np.flatnonzero(start & body)  # where runs of letters, numbers or others start
    run = run[~fresh[run]]
    run = run[kind[run - 1] == BLANK]
    start[run - 1] = True  # the last blank in front of a run stands alone or leads the word
    start[run[code[run - 1] == 0x20]] = False
    mark = np.flatnonzero((code == 0x27) & start)
    mark = mark[(mark + 1 < n)]
    mark = mark[~fresh[mark + 1]]
    for ending in ENDINGS:
        letters = [ord(c) for c in ending[1:]]
        at = mark[mark + len(letters) < n]
        for k, c in enumerate(letters, 1):
            at = at[(code[at + k] == c) & ~fresh[at + k]]
        start[at + 1] = False
        after = at + len(ending)
        after = after[after < n]
        start[after[kind[after] == LETTER]] = True
    width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
    byte_at = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    return data, byte_at[np.flatnonzero(start)], byte_at[unit_at]


_BUILT: dict[int, Automaton] = {}


def automaton(content: str) -> Automaton:
    """The automaton of a vocabulary, built once in a worker."""
    key = hash(content)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(content)
    return _BUILT[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row.

    ``path`` is a byte-level BPE vocabulary file on the driver; its content, a fixed couple
    of megabytes, goes to the tasks.  A null text counts as empty: no ids, empty decoding.
    Special strings of the vocabulary inside a text get their special id.  Rows are
    independent: ties, repeated rows and null ids keep a row each; an empty table gives an
    empty result; other columns are ignored.  Texts of any length are encoded whole.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(content.value)
        for batch in batches:
            done, held, rows = 0, 0, []
            for ids in auto.encode(x.as_py() for x in batch.column(1)):
                decoded = auto.labels(ids)[0].tobytes()
                row = [len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()]
                if with_ids:
                    row += [ids.astype(np.int32), decoded.decode(errors="replace")]
                    held += len(ids)
                rows.append(row)
                if held >= UNIT:  # results in small batches
                    yield table_of(batch, done, rows)
                    done, held, rows = done + len(rows), 0, []
            yield table_of(batch, done, rows)
        auto.forget()

    def table_of(batch: pa.RecordBatch, done: int, rows: list[list]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        arrays = [batch.column(0).slice(done, len(rows)), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32()), pa.string()] if with_ids else [])]
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
