"""Importance resampling of documents towards a target text (operator 12).

Features are the runs of one to three words; each falls into a bucket by the crc32 of its
bytes.  The gain of a bucket is the logarithm of how much more frequent it is in the target
than in the documents, the weight of a document the sum of the gains of its features, and
its score the weight plus Gumbel noise from its id: the highest scores are a sample without
replacement in proportion to the exponentials of the weights.

The documents are read twice, once to count buckets and once to sum gains.  Either time the
features of a piece of text are interned in an open-addressed table of NumPy arrays (see
``interning``): the bucket of a distinct feature is computed once and the occurrences gather
counts or gains by the number of their slot.  Only the bucket counts, of a fixed number,
leave the tasks in the first pass and reach all tasks in the second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.common import materialise, trim
from boardlake.llm.interning import buckets, intern
from boardlake.llm.words import WORD_BYTE, chunks, join_units, word_spans

#: Words whose runs are interned together, and characters of texts tokenised together.
PIECE, TEXTS = 20_000, 1 << 19
WIDEST = 3


class Words:
    """The words of some texts, lower-cased, one blank behind each."""

    def __init__(self, texts: list[str]):
        data, at = join_units([t.encode(errors="surrogatepass").lower() for t in texts])
        starts, ends = word_spans(data, WORD_BYTE)
        self.doc = np.searchsorted(at, starts, "right") - 1
        self.lens = ends - starts
        ink = WORD_BYTE[data]
        keep = ink.copy()
        keep[ends] = True
        self.data = np.append(np.where(ink, data, 32).astype(np.uint8)[keep], np.zeros(8, np.uint8))
        self.starts = np.cumsum(self.lens + 1) - self.lens - 1

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces of all runs of one to ``WIDEST`` words within a text: bytes, starts, lengths, texts."""
        n = len(self.starts)
        stops = self.starts + self.lens
        for k in range(0, n, PIECE):
            base, last = int(self.starts[k]), min(k + PIECE + WIDEST - 1, n) - 1
            data = self.data[base : int(stops[last]) + 8]
            first, stop, doc = [], [], []
            for w in range(1, WIDEST + 1):
                i = np.arange(k, min(k + PIECE, n - w + 1))
                i = i[self.doc[i] == self.doc[i + w - 1]]
                first.append(self.starts[i] - base)
                stop.append(stops[i + w - 1] - base)
                doc.append(self.doc[i])
            a, b = np.concatenate(first), np.concatenate(stop)
            yield data, a, b - a, np.concatenate(doc)


def bucket_counts(rows: DataFrame, text_col: str = "text", n_buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for texts in chunks((x.as_py() for x in batch.column(0)), TEXTS):
                for data, starts, lens, _ in Words(texts).runs():
                    slot, first = intern(data, starts, lens)
                    bucket, count = buckets(data, starts[first], lens[first], n_buckets), np.bincount(slot, minlength=len(first))
                    total += np.bincount(bucket, weights=count, minlength=n_buckets).astype(np.int64)
        trim()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    return rows.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", n_buckets: int = 10_000) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 ln((t+1)(S+n) / ((s+1)(T+n)))) where s of
    the S features of the documents, and t of the T of the target, fall into the bucket."""
    zero = F.lit(0).cast("long")
    s, t = (bucket_counts(x, text_col, n_buckets).withColumnRenamed("n", c) for x, c in ((docs, "s"), (target, "t")))
    every = docs.sparkSession.range(n_buckets).select(F.col("id").cast("int").alias("bucket"))
    both = materialise(every.join(s, "bucket", "left").join(t, "bucket", "left").select("bucket", *(F.coalesce(c, zero).alias(c) for c in "st")))
    both = both.crossJoin(F.broadcast(both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))))  # one row
    of = lambda a, b: (F.col(a) + 1).cast("double") * (F.col(b) + n_buckets).cast("double")
    return both.select("bucket", F.floor(F.log(of("t", "all_s") / of("s", "all_t")) * 1000).alias("gain"))


def weights(docs: DataFrame, gain: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_buckets: int = 10_000) -> DataFrame:
    """(id, n_words, n_features, weight) of every row, from the (bucket, gain) table, whose
    fixed number of rows goes to all tasks."""
    table = np.zeros(n_buckets, np.int64)
    for bucket, value in gain.collect():
        table[bucket] = value
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], []]
            for texts in chunks((x.as_py() for x in batch.column(1)), TEXTS):
                words = Words(texts)
                n_words = np.bincount(words.doc, minlength=len(texts))
                weight = np.zeros(len(texts), np.int64)
                for data, starts, lens, doc in words.runs():
                    slot, first = intern(data, starts, lens)
                    own = held.value[buckets(data, starts[first], lens[first], n_buckets)]
                    weight += np.bincount(doc, weights=own[slot], minlength=len(texts)).astype(np.int64)
                n_features = sum(np.maximum(n_words - w, 0) for w in range(WIDEST))
                for c, x in zip(columns, (n_words, n_features, weight), strict=True):
                    c.append(x)
            arrays = [pa.array(np.concatenate(c).astype(np.int64)) if c else pa.array([], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n_words", "n_features", "weight"])
        trim()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 5,
    least_words: int = 20, seed: int = 42, n_buckets: int = 10_000,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``docs``.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) highest
    scores are drawn; rank counts them from 1, ties to the smaller id, and is null for rows
    not drawn.  Null and empty texts have no features and weight 0.  A null id counts as empty
    in its noise and comes behind others of its score.  Repeated rows are rows of their own,
    with one rank each.  An empty target gives gains all the same; empty documents give an
    empty result.  Other columns are ignored, in the target too, whose texts are in the column
    of the same name.
    """
    scored = weights(docs, gains(docs, target, text_col, n_buckets), id_col, text_col, n_buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)) * -1000)
    scored = materialise(scored.withColumn("score", F.col("weight") + noise))
    able = scored.where(F.col("n_words") >= least_words).withColumn("tie", F.monotonically_increasing_id())
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("tie")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    able = materialise(able.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    sizes = able.groupBy("part").count().withColumn("before", F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    place = F.row_number().over(W.partitionBy("part").orderBy(*order)) + F.coalesce("before", F.lit(0))
    able = able.join(F.broadcast(sizes.select("part", "before")), "part").withColumn("rank", place.cast("long"))
    able = able.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    return able.select(*columns).unionByName(rest.select(*columns))
