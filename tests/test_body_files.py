"""Files of landed bodies: a reader holds the rows of one row group at a time."""

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from boardlake.sources.boards import land_boards, latest_boards, open_store

SHORT, LONG = 300, 500


def landed(spark, body):
    """One board of many parts; the first ones are short."""
    k = F.col("id").cast("int")
    return spark.range(SHORT + LONG).select(
        F.lit("lever").alias("ats"), F.lit("a").alias("slug"), F.lit("board").alias("endpoint"), k.alias("part"), F.lit(200).alias("http_status"),
        F.lit("2031-03-01").cast("timestamp").alias("fetched_at"), F.when(k < SHORT, F.lit("[]")).otherwise(body).alias("body"),
        F.lit("one").alias("fetch_id"), F.lit(SHORT + LONG).alias("n_parts"))


BODIES = {
    "dense": "array_join(transform(sequence(1, 1600), i -> sha2(concat_ws(' ', id, i), 256)), '')",
    "repeated": "repeat(sha2(cast(id AS string), 256), 1600)",
}


@pytest.mark.parametrize("kind", BODIES)
def test_row_groups_of_bodies_are_small(spark, tmpdir_path, kind):
    path = f"{tmpdir_path}/store"
    rows = landed(spark, F.expr(BODIES[kind]))  # 100 KB each
    land_boards(rows, path, buckets=1)
    files = glob.glob(f"{path}/bodies-1/ats=lever/*.parquet")
    groups = duckdb.execute(
        "SELECT total_uncompressed_size, row_group_num_rows FROM parquet_metadata(?) WHERE path_in_schema = 'body'", [files]).fetchall()
    assert sum(n for _, n in groups) == SHORT + LONG
    assert max(size for size, _ in groups) < 16e6
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("part", "body") % 1000003)).first()
    assert digest(latest_boards(open_store(spark, path))) == digest(rows)
