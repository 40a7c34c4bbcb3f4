"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams (operator 2).

Features of a text are the 31-bit hashes of its lower-cased words, of neighbouring pairs, and
of pairs with one word between (skip-grams); a feature counts once in a text.  Training runs
over a bounded sample of labelled rows: ``max_rows`` rows, for either label those with the
smallest hash of their id, at most half of them.  Each coordinate has its own learning rate, and the L1 term leaves most weights at
exactly zero, so the model is a short table of (feature, weight) that is broadcast for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.llm.common import crc_mod, trim
from boardlake.llm.words import WORD_BYTE, chunks, join_units, mix, span_hashes, word_spans

BIAS = -1  # no feature: hashes are not negative


@dataclass
class Model:
    bias: float
    keys: np.ndarray
    weights: np.ndarray
    screen: np.ndarray


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all words, pairs and skip-grams, repeats included."""
    data, at = join_units([t.lower().encode() for t in texts])
    starts, ends = word_spans(data, WORD_BYTE)
    h, doc = span_hashes(data, starts, ends), np.searchsorted(at, starts, "right") - 1
    docs, keys = [doc], [h]
    for gap, step in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        n = max(len(h) - gap, 0)
        same = doc[:n] == doc[gap:]
        docs.append(doc[:n][same])
        keys.append(mix(h[:n] * np.uint64(step) + h[gap:])[same])
    return np.concatenate(docs), (np.concatenate(keys) >> np.uint64(33)).astype(np.int64)


def ftrl(rows: list[tuple[int, np.ndarray]], alpha: float, beta: float, l1: float, l2: float, epochs: int, min_texts: int) -> dict[int, float]:
    """Nonzero weights by feature, and the bias, learned from (label, features) in the given order."""
    every, counts = np.unique(np.concatenate([x for _, x in rows]), return_counts=True)
    every = every[counts >= min_texts]
    own = []
    for y, x in rows:
        k = np.minimum(np.searchsorted(every, x), max(len(every) - 1, 0))
        own.append((y, k[every[k] == x] if len(every) else k[:0]))
    z, n = np.zeros(len(every) + 1), np.zeros(len(every) + 1)
    def weights(k: np.ndarray) -> np.ndarray:
        zk = z[k]
        w = -(zk - np.sign(zk) * l1) / ((beta + np.sqrt(n[k])) / alpha + l2)
        return np.where(np.abs(zk) <= l1, 0.0, w)

    for _ in range(epochs):
        for y, k in own:
            w = weights(k)
            bias_w = -z[-1] / ((beta + np.sqrt(n[-1])) / alpha + l2)
            p = 1 / (1 + np.exp(-np.clip(bias_w + w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / alpha
            z[k] += g - sigma * w
            n[k] += g * g
            s = (np.sqrt(n[-1] + g * g) - np.sqrt(n[-1])) / alpha
            z[-1] += g - s * bias_w
            n[-1] += g * g
    bias_w = -z[-1] / ((beta + np.sqrt(n[-1])) / alpha + l2)
    w = weights(np.arange(len(every)))
    return {BIAS: float(bias_w)} | {int(every[k]): float(w[k]) for k in np.flatnonzero(w)}


def calibration(margins: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic fit of the labels on margins that were not trained on."""
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -35, 35)))
        v = p * (1 - p)
        g = np.array([(margins * (p - y)).sum() + ridge * (slope - 1), (p - y).sum()])
        h = np.array([[(margins * margins * v).sum() + ridge, (margins * v).sum()], [(margins * v).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - float(np.clip(step[0], -0.5, 0.5)), shift - float(np.clip(step[1], -1, 1))
    return max(slope, 0.1), shift


def _frequent(rows: list[tuple[int, np.ndarray]], least: int) -> list[tuple[int, np.ndarray]]:
    """The rows without features that fewer than ``least`` of them have; a feature that shares
    its counter may stay."""
    counts = np.zeros(1 << 24, np.uint16)
    for _, x in rows:
        np.add.at(counts, x & ((1 << 24) - 1), 1)
    return [(y, x[counts[x & ((1 << 24) - 1)] >= least]) for y, x in rows]


def fit(rows: list[tuple[int, np.ndarray]], **settings) -> dict[int, float]:
    """Weights learned from all rows, scaled by a calibration on the third of the rows that a
    first model has not seen."""
    if not rows:
        return {}
    rows = _frequent(rows, settings["min_texts"])
    part = ftrl([r for k, r in enumerate(rows) if k % 3], **settings)
    keys = np.array(sorted(part)[1:], np.int64)
    w = np.array([part[k] for k in keys.tolist()])
    margins, y = [], []
    for label, x in rows[::3]:
        at = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
        margins.append(part[BIAS] + (w[at][keys[at] == x].sum() if len(keys) else 0.0))
        y.append(label)
    slope, shift = calibration(np.array(margins), np.array(y))
    whole = ftrl(rows, **settings)
    return {k: slope * v + (shift if k == BIAS else 0.0) for k, v in whole.items()}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 5000,
          alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0, epochs: int = 8, min_texts: int = 3) -> Model:
    """Learn from the rows of ``labels`` (each id once; rows with a null id or label are no
    labels) whose document is in ``docs``.  Without any, every text scores one half."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
        .join(docs.where(F.col(text_col).isNotNull()).select(id_col).distinct(), id_col)
        .withColumn("rank", F.xxhash64(id_col))
    )
    # ids only, and at most half of max_rows of either label
    of = lambda wanted: known.where(wanted).orderBy("rank", id_col).limit(max_rows // 2)
    sample = of(F.col("y") > 0).unionByName(of(F.col("y") <= 0)).withColumn("y", (F.col("y") > 0).cast("int"))
    chosen = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(sample), id_col).dropDuplicates([id_col])

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for texts in chunks((x.as_py() for x in batch.column("text")), 1 << 20):
                doc, key = features(texts)
                order = np.argsort(doc, kind="stable")
                cut = np.searchsorted(doc[order], np.arange(len(texts) + 1))
                out += [np.unique(key[order[a:b]]).astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column(id_col).cast(pa.int64()), batch.column("y"), pa.array(out, pa.list_(pa.int32()))], ["rank", "id", "y", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y.as_py(), x.values.to_numpy()) for b in batches for y, x in zip(b.column("y"), b.column("x"), strict=True)]
        found = fit(rows, alpha=alpha, beta=beta, l1=l1, l2=l2, epochs=epochs, min_texts=min_texts)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.float64())], ["key", "weight"])
        del rows
        trim()

    ready = chosen.select("rank", id_col, "y", "text").mapInArrow(featurise, "rank long, id long, y int, x array<int>")
    learned = ready.repartition(1).sortWithinPartitions("rank", "id").mapInArrow(learn, "key long, weight double").collect()
    table = {r.key: r.weight for r in learned}
    bias = table.pop(BIAS, 0.0)
    keys = np.array(sorted(table), np.int64)
    screen = np.zeros(1 << 20, bool)
    screen[keys & ((1 << 20) - 1)] = True
    return Model(bias, keys, np.array([table[k] for k in keys.tolist()]), screen)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    total = np.full(len(texts), model.bias)
    if len(model.keys):
        doc, key = features(texts)
        hit = np.flatnonzero(model.screen[key & ((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(model.keys, key[hit]), len(model.keys) - 1)
        right = model.keys[at] == key[hit]
        pairs = np.unique(doc[hit][right] * len(model.keys) + at[right])  # a feature counts once in a text
        total += np.bincount(pairs // len(model.keys), model.weights[pairs % len(model.keys)], len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches the threshold).

    Null and empty texts have no features and get the score of the bias.  Repeated rows keep a
    row each; an empty table gives an empty result.  Columns named score or predicted are
    replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [score_texts(texts, held.value) for texts in chunks(x.as_py() for x in batch.column(text_col))]
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rest.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """(id, held_out, score, predicted) for every row; rows held out of training are those
    whose crc32 of the id as text is 1 modulo 3."""
    model = train(docs, labels.where(crc_mod(id_col, 3) != 1), id_col, text_col, **training)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return score(rows, model).select(id_col, (crc_mod(id_col, 3) == 1).alias("held_out"), "score", "predicted")
