"""Language of words and documents by a linear-chain conditional random field (operator 5).

Every word of a text has a label, its language.  Emissions are sums of learned weights of the
word's features: prefixes and suffixes of one to three characters, character bigrams and
trigrams, the whole word if the lexicon has it, and its length.  Learned transitions join
neighbouring words, so a word between words of another language can still stand out, as in
code-switched text.  Forward-backward gives each word's probabilities; a document's language
is the one with the largest expected share of its words.

The lexicon is the words met at least ``min_texts`` times in the sample.  Training maximises
the likelihood of the label sequences of a bounded sample: for each language ``per_lang``
documents, those with the smallest hash of their id and language.  A document's words have
its language.

Long texts are exact: blocks of words are multiplied to transfer matrices side by side, the
blocks of a document are chained, and the marginals follow from what enters each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.bpe import ragged
from boardlake.llm.common import crc_mod
from boardlake.llm.words import chunks, join_units, mix, span_hashes, word_spans

UNDEFINED = "und"
#: Letters of ASCII and bytes of longer characters make up words.
LETTER_BYTE = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
SLOTS = 1 << 16
BLOCK = 64
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    langs: list[str]
    emit: np.ndarray  # (SLOTS, langs)
    trans: np.ndarray  # (langs, langs)
    lexicon: np.ndarray  # sorted hashes of words


def words_in(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts, starts and ends of their words, and the text of each."""
    data, at = join_units([t.lower().encode() for t in texts])
    starts, ends = word_spans(data, LETTER_BYTE)
    return data, starts, ends, np.searchsorted(at, starts, "right") - 1


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, slot) of all features of the words.  Characters are counted by their
    leading bytes."""
    lens = ends - starts
    span = ragged(starts, lens)
    word = np.repeat(np.arange(len(starts)), lens)
    lead = (data[span] & 0xC0) != 0x80
    at, word = span[lead], word[lead]  # first byte of every character of every word
    n = len(at)
    first = np.searchsorted(word, np.arange(len(starts)))
    size = np.bincount(word, minlength=len(starts))
    stop = np.empty(n, np.int64)
    stop[:-1] = at[1:]
    last = first + size - 1
    stop[last] = ends
    place = np.arange(n) - first[word]
    out_word, out_key = [np.arange(len(starts))], [mix(np.minimum(size, 12).astype(np.uint64) + np.uint64(7_000_001))]
    for k in (1, 2, 3):
        head = np.flatnonzero(place + k <= size[word])  # k characters from here are in the word
        h = span_hashes(data, at[head], stop[head + k - 1])
        if k > 1:
            out_word.append(word[head])
            out_key.append(mix(h + np.uint64(k)))
        front = place[head] == 0
        out_word.append(word[head][front])
        out_key.append(mix(h[front] + np.uint64(10 + k)))
        back = place[head] + k == size[word[head]]
        out_word.append(word[head][back])
        out_key.append(mix(h[back] + np.uint64(20 + k)))
    whole = span_hashes(data, starts, ends)
    if len(lexicon):
        known = np.flatnonzero(lexicon[np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)] == whole)
        out_word.append(known)
        out_key.append(mix(whole[known] + np.uint64(31)))
    return np.concatenate(out_word), (np.concatenate(out_key) & np.uint64(SLOTS - 1)).astype(np.int64)


def emissions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    """(words, langs): the summed feature weights of every word, worked out once for equal words."""
    _, first, kind = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    word, slot = word_features(data, starts[first], ends[first], model.lexicon)
    table = np.stack([np.bincount(word, model.emit[slot, k], len(first)) for k in range(len(model.langs))], axis=1)
    return table[kind]


def marginals(emit: np.ndarray, doc: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of every label for every word, by forward-backward within each document."""
    n, k = emit.shape
    if not n:
        return emit
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    head = np.flatnonzero(np.diff(doc, prepend=-1))  # first word of each document with words
    words = np.diff(np.append(head, n))
    blocks = -(-words // BLOCK)
    block_doc = np.repeat(np.arange(len(head)), blocks)
    nth = np.arange(len(block_doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = head[block_doc] + nth * BLOCK
    size = np.minimum(BLOCK, head[block_doc] + words[block_doc] - begin)
    m = len(begin)
    # transfer matrix of each block: row = label in front of it, column = label of its last word
    move = np.broadcast_to(np.eye(k), (m, k, k)).copy()
    for t in range(BLOCK):
        on = np.flatnonzero(size > t)
        if not len(on):
            break
        x = (move[on].reshape(-1, k) @ a).reshape(-1, k, k) * e[begin[on] + t][:, None, :]
        move[on] = x / x.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.full((m, k), 1.0 / k), np.ones((m, k))
    order = np.argsort(nth, kind="stable")
    cut = np.searchsorted(nth[order], np.arange(int(nth.max()) + 2))
    for level in range(int(nth.max())):
        on = order[cut[level] : cut[level + 1]]
        on = on[nth[on] + 1 < blocks[block_doc[on]]]
        x = np.einsum("bi,bij->bj", enter[on], move[on])
        enter[on + 1] = x / x.sum(axis=1, keepdims=True)
    for level in range(int(nth.max()), 0, -1):
        on = order[cut[level] : cut[level + 1]]
        x = np.einsum("bij,bj->bi", move[on], leave[on])
        leave[on - 1] = x / x.sum(axis=1, keepdims=True)
    p = np.empty((n, k))
    x = enter
    for t in range(BLOCK):
        on = np.flatnonzero(size > t)
        if not len(on):
            break
        y = (x[on] @ a) * e[begin[on] + t]
        y /= y.sum(axis=1, keepdims=True)
        x = x.copy() if t == 0 else x
        x[on] = y
        p[begin[on] + t] = y
    x = leave.copy()
    for t in range(BLOCK - 1, -1, -1):
        on = np.flatnonzero(size > t)
        if not len(on):
            continue
        p[begin[on] + t] *= x[on]
        y = (e[begin[on] + t] * x[on]) @ a.T
        x[on] = y / y.sum(axis=1, keepdims=True)
    return p / p.sum(axis=1, keepdims=True)


def fit(texts: list[str], y: np.ndarray, langs: list[str], epochs: int = 3, rate: float = 0.3, l2: float = 1e-5, min_texts: int = 3, seed: int = 5) -> Model:
    """Learn emissions and transitions by adaptive gradient steps on the conditional likelihood."""
    k = len(langs)
    data, starts, ends, doc = words_in(texts)
    whole, first, kind, met = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    lexicon = whole[met >= min_texts]
    word, slot = word_features(data, starts[first], ends[first], lexicon)
    order = np.argsort(word, kind="stable")
    slot = slot[order]
    slot_at = np.searchsorted(word[order], np.arange(len(first) + 1))
    model = Model(langs, np.zeros((SLOTS, k)), np.zeros((k, k)), lexicon)
    g2_emit, g2_trans = np.full((SLOTS, k), 1e-3), np.full((k, k), 1e-3)
    # sequences of up to BLOCK words of one document
    head = np.flatnonzero(np.diff(doc, prepend=-1))
    words = np.diff(np.append(head, len(doc)))
    begin = np.concatenate([np.arange(h, h + n, BLOCK) for h, n in zip(head, words, strict=True)]) if len(head) else np.zeros(0, np.int64)
    size = np.minimum(BLOCK, np.repeat(head + words, -(-words // BLOCK)) - begin)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = rng.permutation(len(begin))
        for s in range(0, len(begin), 64):
            some = shuffled[s : s + 64]
            at = ragged(begin[some], size[some])
            seq = np.repeat(np.arange(len(some)), size[some])
            kinds, own = np.unique(kind[at], return_inverse=True)
            lens = slot_at[kinds + 1] - slot_at[kinds]
            slots, of = slot[ragged(slot_at[kinds], lens)], np.repeat(np.arange(len(kinds)), lens)
            table = np.stack([np.bincount(of, model.emit[slots, j], len(kinds)) for j in range(k)], axis=1)
            emit = table[own]
            gold = y[doc[at]]
            p = marginals(emit, seq, model.trans)
            # expected minus observed features; pair probabilities from the marginals' messages
            g = p.copy()
            g[np.arange(len(at)), gold] -= 1
            per_kind = np.stack([np.bincount(own, g[:, j], len(kinds)) for j in range(k)], axis=1)
            touched, where = np.unique(slots, return_inverse=True)
            ge = np.stack([np.bincount(where, per_kind[of, j], len(touched)) for j in range(k)], axis=1) / len(some) + l2 * model.emit[touched]
            g2_emit[touched] += ge * ge
            model.emit[touched] -= rate * ge / np.sqrt(g2_emit[touched])
            gt = _pairs(emit, seq, model.trans)
            inner = seq[1:] == seq[:-1]
            np.subtract.at(gt, (gold[:-1][inner], gold[1:][inner]), 1)
            gt = gt / len(some) + l2 * model.trans
            g2_trans += gt * gt
            model.trans -= rate * gt / np.sqrt(g2_trans)
    return model


def _pairs(emit: np.ndarray, seq: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Expected counts of label pairs of neighbouring words."""
    k = emit.shape[1]
    a = np.exp(trans - trans.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    head = np.flatnonzero(np.diff(seq, prepend=-1))
    size = np.diff(np.append(head, len(seq)))
    forward, backward = np.empty_like(e), np.ones_like(e)
    x = np.full((len(head), k), 1.0 / k)
    for t in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > t)
        y = (x[on] @ a) * e[head[on] + t]
        x[on] = forward[head[on] + t] = y / y.sum(axis=1, keepdims=True)
    x = np.ones((len(head), k))
    for t in range(int(size.max(initial=0)) - 1, 0, -1):
        on = np.flatnonzero(size > t)
        y = (e[head[on] + t] * x[on]) @ a.T
        x[on] = backward[head[on] + t - 1] = y / y.sum(axis=1, keepdims=True)
    left = np.flatnonzero(seq[1:] == seq[:-1])
    joint = forward[left][:, :, None] * a[None] * (e[left + 1] * backward[left + 1])[:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(left) else np.zeros((k, k))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 300, max_langs: int = 64, **settings) -> Model | None:
    """Learn from a bounded sample of the rows with text and language; none without any.

    The sample is ``per_lang`` rows, those with the smallest hash of id and language, of each
    of the ``max_langs`` languages with the most such rows.  Rows of one id with different
    texts are rows of their own; the hash of the text decides between equal ranks.
    """
    # rows that share id, language and text are one; ties of the hash go by the text's own
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col, lang_col).alias("rank"), F.xxhash64(text_col).alias("own"), F.col(lang_col).alias("y"), F.col(text_col).alias("text")
    )
    chosen = known.select("rank", "own", "y").distinct().withColumn("salt", F.pmod("own", F.lit(64)))
    for keys in (["y", "salt"], ["y"]):  # the smallest of the smallest: a language is never gathered whole
        nth = F.row_number().over(W.partitionBy(*keys).orderBy("rank", "own"))
        chosen = chosen.withColumn("n", nth).where(F.col("n") <= per_lang).drop("n")
    # of very many languages those with the most chosen rows are learned, ties by name
    langs = chosen.groupBy("y").count().orderBy(F.desc("count"), "y").limit(max_langs).select("y")
    chosen = chosen.select("rank", "own", "y").distinct().join(F.broadcast(langs), "y", "left_semi").drop("y")
    # at most per_lang rows of max_langs languages: a bounded table
    sample = known.join(F.broadcast(chosen), ["rank", "own"]).dropDuplicates(["rank", "own", "y"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t.as_py(), y.as_py()) for b in batches for t, y in zip(b.column("text"), b.column("y"), strict=True)]
        langs = sorted({y for _, y in rows})
        m = fit([t for t, _ in rows], np.array([langs.index(y) for _, y in rows], np.int64), langs, **settings)
        blob = [x.astype(np.float32).tobytes() for x in (m.emit, m.trans)] + [m.lexicon.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([langs]), *(pa.array([x]) for x in blob)], ["langs", "emit", "trans", "lexicon"])

    schema = "langs array<string>, emit binary, trans binary, lexicon binary"
    got = sample.repartition(1).sortWithinPartitions("rank", "own").mapInArrow(learn, schema).first()
    if got is None or not got.langs:
        return None
    k = len(got.langs)
    array = lambda x, kind=np.float32: np.frombuffer(bytes(x), kind)
    return Model(list(got.langs), array(got.emit).astype(np.float64).reshape(SLOTS, k), array(got.trans).astype(np.float64).reshape(k, k), array(got.lexicon, np.uint64))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (expected share of the words in that language, 0 to
    1) and ``shares`` (that of every language, in the order of the model's names).

    A null text, one without a letter, and any text if there is no model: ``und``, score 0, no
    shares.  Every row is judged alone, so repeated rows keep a row each; an empty table gives
    an empty result.  Columns named like the results are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("lang_pred", "score", "shares")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            langs, scores, shares = [], [], []
            for texts in chunks((x.as_py() for x in batch.column(text_col)), 1 << 21):
                found = document_shares(texts, m) if m else np.zeros((len(texts), 1))
                for text, p in zip(texts, found, strict=True):
                    some = p.sum() > 0 and _LETTER.search(text) is not None
                    langs.append(m.langs[int(p.argmax())] if some else UNDEFINED)
                    scores.append(min(float(p.max()), 1.0) if some else 0.0)
                    shares.append(p.tolist() if some else [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.list_(pa.float64()))],
                [*batch.schema.names, "lang_pred", "score", "shares"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema), "lang_pred string", "score double", "shares array<double>"])
    return rest.mapInArrow(run, schema)


def document_shares(texts: list[str], model: Model) -> np.ndarray:
    """(texts, langs): expected share of each language among a text's words; zeros without words."""
    data, starts, ends, doc = words_in(texts)
    p = marginals(emissions(data, starts, ends, model), doc, model.trans)
    total = np.stack([np.bincount(doc, p[:, j], len(texts)) for j in range(len(model.langs))], axis=1)
    return total / np.maximum(np.bincount(doc, minlength=len(texts)), 1)[:, None]


def label_words(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(word, language, probability) of the words of one text, for code-switched passages."""
    data, starts, ends, doc = words_in([text])
    p = marginals(emissions(data, starts, ends, model), doc, model.trans)
    raw = data.tobytes()
    return [(raw[a:b].decode(), model.langs[int(x.argmax())], float(x.max())) for a, b, x in zip(starts, ends, p, strict=True)]


def language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **training) -> DataFrame:
    """(id, held_out, lang_pred, score): learned from the rows whose crc32 of the id as text is
    not 0 modulo 5, predicted for all."""
    model = train(docs.where(crc_mod(id_col, 5) != 0), id_col, text_col, lang_col, **training)
    rows = docs.select(id_col, F.col(text_col).alias("text"))
    return predict(rows, model).select(id_col, (crc_mod(id_col, 5) == 0).alias("held_out"), "lang_pred", "score")
