"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The only characters that separate words in the contracts of these operators.
BLANKS = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANKS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the session.

    The folder is the one in ``spark.checkpoint.dir``.  A private folder is used only
    in local mode, where driver and executors are one process; a cluster without the
    setting is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def parts_for(spark: SparkSession, rows: float, per_part: float) -> int:
    """Partition count that keeps ``per_part`` rows (or bytes) in a partition, and never
    fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(rows // per_part) + 1)


def join_uneven(many: DataFrame, few: DataFrame, key: str, spread: list[str], least: int = 64, most: int = 10_000, salts: int = 64) -> DataFrame:
    """Inner join on ``key`` where some keys have very many rows in ``many`` and few in ``few``.

    Keys with more than ``least`` rows and more than one in ``most`` of all rows are dealt
    over ``salts`` places by the columns ``spread``; at most ``most`` keys can be such, and
    only these keys go to all tasks.  Rows of ``few`` under them are repeated for each place.
    """
    total = many.count()
    hot = materialise(many.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > max(least, total // most)).select(key, F.lit(True).alias("_hot")))
    marked = lambda df: df.join(F.broadcast(hot), key, "left")
    left = marked(many).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0))
    right = marked(few).withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.drop("_hot").join(right.drop("_hot"), [key, "_salt"]).drop("_salt")


def trim() -> None:
    """Give memory that a task has freed back to the system: Python workers are used again,
    and the C library would keep it for them."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
