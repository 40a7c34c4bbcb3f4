"""SimHash near-duplicates by the pigeonring principle (operator 6).

Two 64-bit fingerprints link if they differ in at most ``max_bits`` bits.  Cut both into m
equal segments placed on a ring.  If the whole difference is at most t, some start segment
has the property that the first l segments from it differ in at most ``l * t / m`` bits, for
every l from 1 to m.  With t = 2 and m = 4 that means: the start segment is equal, and the
next one differs in at most one bit.

Candidates share a key made of the start segment and the next segment with one quarter
masked out (one bit lies in one quarter), so a key has 28 bits and a fingerprint 16 keys.
Pairs under a key must pass the whole chain test and then the Hamming test.  A key with more
than ``bucket`` distinct fingerprints is not paired up: its fingerprints are linked through
the centres they share.  Two fingerprints differ in at most two bits exactly if some word is
within one bit of both, so a star around each such word has all links in 65 rows a
fingerprint, whatever the size of the key.

All work after the fingerprints is on distinct fingerprints, so exact copies cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import materialise
from boardlake.llm.components import components

SEGMENTS, SEGMENT_BITS, QUARTER = 4, 16, 4


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> bytes:
    """Eight big-endian bytes.  A bit is set if it is set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and blanks U+0009-U+000D, U+0020 only
    if not words:
        return bytes(8)
    if len(words) <= width:
        return xxhash.xxh64_digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    digest = xxhash.xxh64_digest
    bits = np.zeros(64, np.int64)
    a, b = starts[:n].tolist(), ends[width - 1 :].tolist()
    for k in range(0, n, 1 << 16):
        got = b"".join([digest(joined[i:j], seed) for i, j in zip(a[k : k + (1 << 16)], b[k : k + (1 << 16)], strict=True)])
        bits += np.unpackbits(np.frombuffer(got, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(bits * 2 > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, hash of the text, fp): the fingerprint of every row as a signed long; ids are
    whole numbers, or text that reads as such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = b"".join(fingerprint(x.as_py(), width) for x in batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.frombuffer(fps, ">i8").astype(np.int64))], ["id", "hash", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, hash long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _keys(fp: Column) -> Column:
    keys = []
    for i in range(SEGMENTS):
        for q in range(SEGMENT_BITS // QUARTER):
            left = ((1 << SEGMENT_BITS) - 1) & ~(((1 << QUARTER) - 1) << (QUARTER * q))
            at = F.lit(i * (SEGMENT_BITS // QUARTER) + q).cast("long")
            keys.append(
                F.shiftleft(at, 2 * SEGMENT_BITS)
                .bitwiseOR(F.shiftleft(_segment(fp, i), SEGMENT_BITS))
                .bitwiseOR(_segment(fp, i + 1).bitwiseAND(F.lit(left)))
            )
    return F.array(*keys)


def _chain(diff: Column, max_bits: int) -> Column:
    """Whether a chain of segments starting somewhere stays within its proportional budgets."""
    d = [F.bit_count(_segment(diff, i)) for i in range(SEGMENTS)]
    passes = F.lit(False)
    for start in range(SEGMENTS):
        total, within = F.lit(0), F.lit(True)
        for n in range(1, SEGMENTS + 1):
            total = total + d[(start + n - 1) % SEGMENTS]
            within = within & (total <= n * max_bits // SEGMENTS)
        passes = passes | within
    return passes


def links(fps: DataFrame, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly those linked,
    directly or through others.  Pairs of at most ``max_bits`` (0 to 2) differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments here serve distances of 0 to 2 bits")
    keyed = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(keyed.join(many, "key"))
    few = shared.where(F.col("n") <= bucket).select("key", F.col("fp").alias("a"))
    pairs = few.join(few.withColumnRenamed("a", "b"), "key").where("a < b").select("a", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = pairs.where(_chain(diff, max_bits)).where(F.bit_count(diff) <= max_bits).distinct()
    if max_bits < 2:  # centres reach two bits; nearer limits pair up every key
        rest = shared.where(F.col("n") > bucket)
        low = rest.select("key", F.col("fp").alias("a"), F.explode(_near(F.col("fp"), max_bits)).alias("b"))
        return pairs.unionByName(low.join(fps.select(F.col("fp").alias("b")), "b").where("a < b").select("a", "b").distinct())
    hot = shared.where(F.col("n") > bucket).select("fp").distinct()
    around = hot.select("fp", F.explode(_near(F.col("fp"), 1)).alias("centre"))
    stars = around.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top")
    return pairs.unionByName(around.join(stars, "centre").where("fp > a").select("a", F.col("fp").alias("b")).distinct())


def _near(fp: Column, bits: int) -> Column:
    """The fingerprint and, for bits = 1, all that differ from it in one bit."""
    return F.array(fp, *(fp.bitwiseXOR(F.lit(v if v < 1 << 63 else v - (1 << 64))) for v in ((1 << k) for k in range(64 * bits))))


def _grouped(distinct: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """The rows of ``distinct``, one for each fingerprint ``fp``, with the ``root`` of its component."""
    roots = components(links(distinct.select("fp"), max_bits, bucket))
    return distinct.join(roots, distinct.fp == roots.node, "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """(id, fingerprint, component_id) for every input row.

    ``component_id`` is the smallest id reachable over links, itself included.  Null and
    blank texts have fingerprint zero and link like others.  Rows with a null id get a
    component through their fingerprint; the component is null if all its ids are.  Repeated
    rows each keep a row.  An empty table gives an empty result; other columns are ignored.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, width).drop("hash"))
    of = _grouped(materialise(rows.groupBy("fp").agg(F.min("id").alias("low"))), max_bits, bucket)
    named = of.join(of.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Rows are decided one by one: rows that share an id but not a text each count in the group
    of their own text.  Of a group's rows with the smallest id that with the smallest hash of
    its text stays, of those equal in both the one with the smallest hash of all columns.
    Rows with a null id belong to no group here and stay; other columns are kept as they are.
    """
    known = docs.where(F.col(id_col).isNotNull())
    found = materialise(fingerprints(known, id_col, text_col, width))
    distinct = materialise(found.groupBy("fp").agg(F.min(F.struct("id", "hash")).alias("low")))
    first = _grouped(distinct, max_bits, 64).groupBy("root").agg(F.min("low").alias("low")).select("low.id", "low.hash")
    # repeated rows are put together in every task before they move
    every = [F.col(c) for c in docs.columns]
    alike = known.groupBy(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"))
    single = alike.agg(F.min_by(F.struct(*every), F.xxhash64(*every)).alias("_row"))
    kept = single.join(first, (F.col("_id") == F.col("id")) & (F.col("_hash") == F.col("hash")), "left_semi")
    return kept.select("_row.*").unionByName(docs.where(F.col(id_col).isNull()))
