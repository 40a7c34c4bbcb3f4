"""Benchmark decontamination by size-partitioned MinHash containment search (operator 7).

Test items are short and documents long, so a sketch of the whole document says nothing
about one item.  The sketches are therefore on the items' side: items are partitioned by
their number of shingles, and each keeps its smallest shingle hashes, as many as its size
class needs.  If a share t of an item's n shingles is in a document, at most
``miss = floor((1 - t) * n)`` are not, so of any m of them at least ``m - miss`` are there.
A document is a candidate for an item only if it holds that many of the item's sketch, whose
size is one more than the misses of the largest item of the class, and a few to spare.
Candidates are verified by exact containment of the shingle texts.

1. Tasks turn items into rows, one for each shingle.  Shingles that very many items own come
   last in the sketches.
2. Two bit tables of a bounded size, of all item shingles and of those in sketches, go to all
   tasks.  Documents are read once; those with a sketch shingle send their shingles that some
   item may have, once for each different text.
3. Joins on shingles give candidates, joins on document and shingle verify them.  The items'
   sides of these joins are salted, so neither a passage that a third of the documents have
   nor an item found in so many is one key.

Words are lower-cased runs of letters, digits and non-ASCII characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.common import materialise, trim
from boardlake.llm.words import WORD_BYTE, chunks, join_units, mix, span_hashes, word_spans

#: Bits of a table of shingle hashes: this many for each, within bounds, and the shifts that
#: give a hash its places.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 22, 1 << 25
SHIFTS = (0, 19, 39)
#: Sketch shingles beyond the least that a size class needs, and items that own a common one.
SPARE, COMMON = 4, 32
#: Parts into which the work on one shingle or item is dealt.
SALTS = 16
#: Bad texts, of 16 bytes each, up to which their keys are broadcast.
BROADCAST_ROWS = 1 << 19


def _fold(text: str | None) -> bytes:
    return (text or "").lower().encode(errors="surrogatepass")


def _words(text: str | None) -> list[bytes]:
    data, _ = join_units([_fold(text)])
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(*(x.tolist() for x in word_spans(data, WORD_BYTE)), strict=True)]


def shingles(text: str | None, width: int) -> set[bytes]:
    """The distinct word shingles of a text."""
    w = _words(text)
    return {b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)}


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` word hashes."""
    n = max(len(words) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(total)


class Bits:
    """A Bloom filter of shingle hashes, as a table of bits."""

    def __init__(self, rows: DataFrame, bits: int):
        places = F.explode(F.array(*(F.shiftrightunsigned("v", k).bitwiseAND(F.lit(bits - 1)) for k in SHIFTS)))
        one = F.expr("shiftleft(1L, cast(p & 63 as int))")
        # bits / 64 rows at most
        got = rows.select(places.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("w")).agg(F.bit_or(one)).collect()
        self.table = np.zeros(bits >> 6, np.uint64)
        for w, value in got:
            self.table[w] = value & ((1 << 64) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the hashes that may be in the table."""
        found = np.arange(len(hashes))
        for k in SHIFTS:
            place = (hashes[found] >> np.uint64(k)) & np.uint64(len(self.table) * 64 - 1)
            found = found[(self.table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0]
        return found


def _key(text: Column) -> list[Column]:
    """A text's key of 128 bits; equal texts share all results."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def item_shingles(items: DataFrame, text_col: str, threshold: float, width: int) -> DataFrame:
    """(i1, i2, width, n, v, s, place, sketch, need): one row for each shingle ``s``, with hash
    ``v``, of each different item text with a word; those with ``place`` up to ``sketch`` are
    the item's sketch, of which a document needs ``need``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = min(len(_words(text)), width)
                own = sorted(shingles(text, w)) if w else []
                for k in range(0, len(own), 1 << 16):
                    part = own[k : k + (1 << 16)]
                    data, _ = join_units(part)
                    hashes = _rolled(span_hashes(data, *word_spans(data, WORD_BYTE)), w)[::w]
                    fixed = [pa.array([x] * len(part), t) for x, t in ((a, pa.int64()), (b, pa.int64()), (w, pa.int32()), (len(own), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(hashes.view(np.int64)), pa.array(part, pa.binary())], ["i1", "i2", "width", "n", "v", "s"])

    text = F.col(text_col)
    keyed = items.select(*(c.alias(x) for c, x in zip(_key(text), ("i1", "i2"), strict=True)), text.alias("text")).dropDuplicates(["i1", "i2"])
    rows = materialise(keyed.mapInArrow(run, "i1 long, i2 long, width int, n long, v long, s binary"))
    owners = rows.groupBy("v").agg((F.count("*") > COMMON).alias("common")).where("common")
    rows = rows.join(owners, "v", "left")
    place = F.row_number().over(W.partitionBy("i1", "i2").orderBy(F.col("common").isNotNull(), "v", "s"))
    miss = lambda n: F.floor(n * (1 - threshold) + 1e-9)
    largest = F.pow(F.lit(2.0), F.length(F.bin("n"))) - 1  # of the size class
    sketch = F.least(F.col("n"), miss(largest) + 1 + SPARE)
    return rows.withColumn("place", place).drop("common").withColumn("sketch", sketch).withColumn("need", F.greatest(sketch - miss(F.col("n")), F.lit(1)))


def _hits(texts: list[str], widths: list[int], every: Bits, sketches: Bits) -> Iterator[tuple[int, int, int, bytes]]:
    """(text number, width, hash, shingle) of the different shingles that some item may have, of
    texts with one that may be in a sketch."""
    data, at = join_units([_fold(t) for t in texts])
    starts, ends = word_spans(data, WORD_BYTE)
    words, doc = span_hashes(data, starts, ends), np.searchsorted(at, starts, "right") - 1
    for w in widths:
        rolled = _rolled(words, w)
        hit = every.has(rolled)
        hit = hit[doc[hit] == doc[hit + w - 1]]
        able = np.zeros(len(texts), bool)
        able[doc[hit[sketches.has(rolled[hit])]]] = True
        hit = hit[able[doc[hit]]]
        hit = hit[np.lexsort((hit, rolled[hit], doc[hit]))]
        again = (doc[hit[1:]] == doc[hit[:-1]]) & (rolled[hit[1:]] == rolled[hit[:-1]])
        for k in hit[np.append(True, ~again)[: len(hit)]].tolist():
            spans = zip(starts[k : k + w].tolist(), ends[k : k + w].tolist(), strict=True)
            yield int(doc[k]), w, int(rolled[k].view(np.int64)), b" ".join(data[a:b].tobytes() for a, b in spans)


def _found(docs: DataFrame, items: DataFrame, id_col: str | None, text_col: str, item_text: str, threshold: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, i1, i2, n, n_found) of verified pairs of texts, and (k1, k2, id) of the
    documents that were read for them."""
    spark = docs.sparkSession
    own = materialise(item_shingles(items, item_text, threshold, width))
    n, sizes = own.count(), [r[0] for r in own.select("width").distinct().collect()]
    bits = min(max(1 << (BITS_EACH * n).bit_length(), LEAST_BITS), MOST_BITS)
    held = spark.sparkContext.broadcast((sorted(sizes), Bits(own, bits), Bits(own.where("place <= sketch"), bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = 0
            for texts in chunks(x.as_py() for x in batch.column("text")):
                got = list(_hits(texts, *held.value))
                at = pa.array(sorted({base + x[0] for x in got}), pa.int64())
                # a row without a shingle for each document, and its shingles without its id
                ids = batch.column("id").take(at)
                keys = [pa.concat_arrays([batch.column(c).take(at), batch.column(c).take(pa.array([base + x[0] for x in got], pa.int64()))]) for c in ("k1", "k2")]
                none = [None] * len(at)
                yield pa.RecordBatch.from_arrays([
                    *keys, pa.concat_arrays([ids, pa.nulls(len(got), ids.type)]),
                    pa.array([*none, *(x[1] for x in got)], pa.int32()), pa.array([*none, *(x[2] for x in got)], pa.int64()), pa.array([*none, *(x[3] for x in got)], pa.binary()),
                ], ["k1", "k2", "id", "width", "v", "s"])
                base += len(texts)
        trim()

    text = F.col(text_col)
    keys = (c.alias(x) for c, x in zip(_key(text), ("k1", "k2"), strict=True))
    rows = docs.select(*keys, (F.col(id_col) if id_col else F.lit(None).cast("int")).alias("id"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    read = materialise(rows.mapInArrow(run, f"k1 long, k2 long, id {kind}, width int, v long, s binary"))
    hits = read.where("width is not null").select("k1", "k2", "width", "v", "s").distinct()
    salt, every = F.pmod("k1", F.lit(SALTS)), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sketches = own.where("place <= sketch").select("i1", "i2", "width", "v", "s", "need", every.alias("salt"))
    pairs = hits.withColumn("salt", salt).join(sketches, ["salt", "width", "v", "s"])
    pairs = pairs.groupBy("k1", "k2", "i1", "i2").agg(F.count("*").alias("c"), F.max("need").alias("need")).where("c >= need")
    wanted = pairs.select("k1", "k2", "i1", "i2", salt.alias("salt")).join(own.select("i1", "i2", "width", "n", "v", "s", every.alias("salt")), ["salt", "i1", "i2"])
    found = wanted.join(hits, ["k1", "k2", "width", "v", "s"], "left_semi").groupBy("k1", "k2", "i1", "i2").agg(F.max("n").alias("n"), F.count("*").alias("n_found"))
    return found.where(F.col("n_found") >= threshold * F.col("n") - 1e-9), read.where("width is null").select("k1", "k2", "id")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", threshold: float = 0.8, width: int = 5) -> DataFrame:
    """(doc id, item id, n_shingles, n_found, containment): one row per pair of a document and a
    test item of whose distinct ``width``-word shingles a share of ``threshold`` or more is in
    the document.

    Null and empty texts, and items without a word, match nothing; an item of fewer words is
    one shingle of all its words.  Repeated documents or items give their pairs again; null
    ids are carried as they are, and ids may have any type.  An empty table on either side
    gives an empty result; other columns are ignored.
    """
    found, read = _found(docs, items, id_col, text_col, "text", threshold, width)
    named = items.select(*(c.alias(x) for c, x in zip(_key(F.col("text")), ("i1", "i2"), strict=True)), F.col(item_col).alias("item"))
    return read.join(found, ["k1", "k2"]).join(named, ["i1", "i2"]).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("n").alias("n_shingles"), "n_found", (F.col("n_found") / F.col("n")).alias("containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = 0.8, width: int = 5) -> DataFrame:
    """``docs`` without the rows that ``contaminated`` would list, all columns kept.

    Null and empty texts stay, repeated rows go or stay together, and rows that share an id are
    judged by their own texts.  Without items every row stays; an empty table stays empty.
    """
    found, _ = _found(docs, items, None, text_col, "text", threshold, width)
    bad = materialise(found.select("k1", "k2").distinct())
    small = bad.count() <= BROADCAST_ROWS  # beyond, documents and keys are shuffled to meet
    k1, k2 = _key(F.col(text_col))
    return docs.join(F.broadcast(bad) if small else bad, (k1 == bad["k1"]) & (k2 == bad["k2"]), "left_anti")
