"""A stated set of queries against all rows of a table of vectors, in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries and rows that meet in one task at most, about: a group is dealt evenly, not by a key.
QUERIES, ROWS = 16_384, 65_536
#: Least number of groups of rows, so that small tables also use the cluster.
GROUPS = 32


def sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    x = F.col(vector)
    limit = F.lit(float("inf"))
    return x.isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < limit)), F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as a matrix of doubles, shorter vectors filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lens) and (lens == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lens), width))
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def against(queries: DataFrame, keys: list[str], rows: DataFrame, n_queries: int, n_rows: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str, groups: int = GROUPS) -> DataFrame:
    """``run(queries, rows)`` of every block of queries with every block of rows.

    Queries are dealt by their ``keys``, of which no two queries share all.  Rows are dealt by
    their place in the table, which has to be a written one (a checkpoint), where a repeated
    task finds the same places; so equal rows do not meet either.  A block has about
    ``QUERIES`` and ``ROWS`` of them, whatever the size of the tables.  Rows are sent once for
    each block of queries, queries once for each block of rows.
    """
    n = max(groups, -(-n_rows // ROWS))
    g = -(-max(n_queries, 1) // QUERIES)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = queries.withColumn("_q", F.pmod(F.xxhash64(*keys), F.lit(g)).cast("int")).withColumn("_r", every(n))
    right = rows.withColumn("_r", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")).withColumn("_q", every(g))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, min(n * g, 100_000))
    # both sides may come from one table: columns are named anew to tell them apart
    pair = [x.select(*(F.col(c).alias(c) for c in x.columns)).repartition(parts, "_q", "_r").groupBy("_q", "_r") for x in (left, right)]
    return pair[0].cogroup(pair[1]).applyInArrow(run, schema)
