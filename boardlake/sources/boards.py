"""The landed board table (``raw_boards``): reading, fetches, status gate, probes.

Boards are fetched by an external job and landed as rows of ``RAW_BOARDS_DDL``; a large
board may be landed as several ``part`` rows so no single row (and no single task) has to
hold a whole hot company.  All parts of one fetch share ``fetch_id`` and name the number of
parts the fetch has (``n_parts``); they may arrive at different times and in different
landings.  A fetch counts once all its parts have landed.

A call first works on an index of the landed rows, which has every column but the body:
which parts belong to the newest complete fetch of which board, and which of these the call
reads.  Only then are bodies read, by a join on (slug, part), by which a store on disk is
bucketed (``land_boards``); the join therefore moves index rows and never a body, and the
parts of a hot company lie in all buckets.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import file_system
from .schemas import ATS_NAMES, RAW_BOARDS_DDL

KEYS = ("ats", "slug", "endpoint")
#: Parts into which the index rows of one board are dealt where boards are joined.
SALTS = 16
BUCKETS = 64
#: A body may have a few MB.  Parquet looks at sizes every hundred rows or more, so a page
#: would hold a hundred bodies, and a reader's batch takes up to 4096 rows of one row group; that
#: is memory Spark does not count.  Here row groups are small, also of bodies that compress well.
BODY_FILES = {
    "parquet.block.size": 8 << 20,
    "parquet.block.row.count.limit": 128,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 8,
}
#: How far apart the parts of one fetch may land if nothing names their fetch.
SAME_FETCH = "INTERVAL 1 HOUR"


@dataclass(frozen=True)
class BoardStore:
    """Landed rows with their bodies, and the same rows without (``index``)."""

    bodies: DataFrame
    index: DataFrame


def read_raw_boards(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan landed boards.  Parquet/JSON partitioned by ``ats`` gets static
    partition pruning for an explicit platform filter."""
    reader = spark.read.schema(RAW_BOARDS_DDL) if fmt != "parquet" else spark.read
    return reader.format(fmt).load(path)


def with_fetch(raw_boards: DataFrame) -> DataFrame:
    """Rows with all columns of the store.  A null part is part 0."""
    have = set(raw_boards.columns)
    given = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    return raw_boards.select(
        "ats", "slug", "endpoint", F.coalesce("part", F.lit(0)).alias("part"), "http_status", "fetched_at", "body",
        given("fetch_id", "string").alias("fetch_id"), given("n_parts", "int").alias("n_parts"), F.coalesce(given("landing", "string"), F.lit("")).alias("landing"),
    )


def as_store(raw_boards: DataFrame | BoardStore) -> BoardStore:
    if isinstance(raw_boards, BoardStore):
        return raw_boards
    rows = with_fetch(raw_boards)
    return BoardStore(rows, rows.drop("body"))


def land_boards(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append landed rows to the store at ``path``: bodies partitioned by platform and bucketed
    by (slug, part), and an index beside them, written last, so rows whose landing failed half
    way stay unseen and may be landed again.  A part landed again counts once."""
    spark = rows.sparkSession
    known = _buckets(spark, path)
    rows = with_fetch(rows).withColumn("landing", F.lit(uuid.uuid4().hex))
    name = _table(spark, path, known) if known else _name(path)
    writer = rows.repartition(known or buckets, "slug", "part").write.mode("append").format("parquet").options(**BODY_FILES)
    writer.partitionBy("ats").bucketBy(known or buckets, "slug", "part").option("path", f"{path}/bodies-{known or buckets}").saveAsTable(name)
    rows.drop("body").write.mode("append").partitionBy("ats").parquet(f"{path}/index")
    if not known:  # the next reader declares the table from its folder
        spark.sql(f"DROP TABLE {name}")


def open_store(spark: SparkSession, path: str) -> BoardStore:
    """The store that ``land_boards`` has written, as of now."""
    name = _table(spark, path, _buckets(spark, path))
    spark.sql(f"MSCK REPAIR TABLE {name}")  # the platforms' folders
    spark.catalog.refreshTable(name)
    return BoardStore(spark.table(name), spark.read.parquet(f"{path}/index"))


def _name(path: str) -> str:
    return f"boardlake_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:16]}"


def _buckets(spark: SparkSession, path: str) -> int | None:
    fs, top = file_system(spark, path)
    if not fs.exists(top):
        return None
    found = [f.getPath().getName() for f in fs.listStatus(top)]
    return next((int(x.removeprefix("bodies-")) for x in found if x.startswith("bodies-")), None)


def _table(spark: SparkSession, path: str, buckets: int | None) -> str:
    if buckets is None:
        raise FileNotFoundError(f"no landed boards in {path}")
    name = _name(path)
    columns = ", ".join(x for x in (*RAW_BOARDS_DDL.split(", ")[1:], "fetch_id STRING", "n_parts INT", "landing STRING", RAW_BOARDS_DDL.split(", ")[0]))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (ats) "
        f"CLUSTERED BY (slug, part) INTO {buckets} BUCKETS LOCATION '{path}/bodies-{buckets}'"
    )
    return name


def landed_parts(index: DataFrame) -> DataFrame:
    """One row for each part of each fetch, with its latest row as ``last``."""
    last = F.max(F.struct("fetched_at", "landing", "http_status", "n_parts")).alias("last")
    return index.groupBy(*KEYS, "fetch_id", "part").agg(last)


def complete_fetches(parts: DataFrame) -> DataFrame:
    """(ats, slug, endpoint, fetch_id, at, landed, n_parts) of the fetches whose parts are all there."""
    return parts.groupBy(*KEYS, "fetch_id").agg(
        F.max("last.fetched_at").alias("at"), F.count("*").alias("landed"), F.max("last.n_parts").alias("n_parts")
    ).where(F.col("n_parts").isNull() | (F.col("landed") >= F.col("n_parts")))


def current_parts(index: DataFrame) -> DataFrame:
    """(ats, slug, endpoint, part, fetch_id, landing, http_status, fetched_at) of every part of
    the newest complete fetch of every board.

    A fetch is complete when as many different parts as it names have landed; its time is that
    of its last part, and rows without a time count as the oldest.  A part landed several times
    is its latest row.  A board without a complete fetch has no rows.  Of rows landed without a
    ``fetch_id`` those within ``SAME_FETCH`` before a board's newest one are its newest fetch;
    nothing says how many parts it has, so it counts as complete.  Groups are aggregated in
    every task first, and the choice is joined back on a salted key, so a board of very many
    parts does not meet in one task.
    """
    parts = landed_parts(index)
    whole = complete_fetches(parts)
    newest = whole.groupBy(*KEYS).agg(F.max(F.struct("at", "fetch_id")).alias("newest"))
    newest = newest.select(
        *(F.col(c).alias(f"_{c}") for c in KEYS), F.col("newest.fetch_id").alias("_fetch"),
        F.when(F.col("newest.fetch_id").isNull(), F.col("newest.at") - F.expr(SAME_FETCH)).alias("_since"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    same = F.col("fetch_id").eqNullSafe(F.col("_fetch")) & (F.pmod("part", F.lit(SALTS)) == F.col("_salt"))
    for c in KEYS:
        same = same & (F.col(c) == F.col(f"_{c}"))
    kept = F.col("_since").isNull() | F.coalesce(F.col("last.fetched_at") >= F.col("_since"), F.lit(False))
    return parts.join(newest, same & kept, "left_semi").select(*KEYS, "part", "fetch_id", "last.landing", "last.http_status", "last.fetched_at")


def wanted(parts: DataFrame, *flags: str) -> DataFrame:
    """One row for each (slug, part) with the rows of ``parts`` under it, at most one for each
    platform and endpoint, and their ``flags``."""
    return parts.groupBy("slug", "part").agg(F.collect_list(F.struct("ats", "endpoint", "fetch_id", "landing", "fetched_at", *flags)).alias("_want"))


def bodies(store: BoardStore, want: DataFrame, *flags: str) -> DataFrame:
    """Landed rows that ``wanted`` names, with its flags.  The join is on (slug, part) alone, as
    the store is bucketed; the few rows under a key are told apart afterwards."""
    same = lambda w: (
        (w["ats"] == F.col("ats")) & (w["endpoint"] == F.col("endpoint")) & (w["landing"] == F.col("landing"))
        & w["fetch_id"].eqNullSafe(F.col("fetch_id")) & w["fetched_at"].eqNullSafe(F.col("fetched_at"))
    )
    rows = store.bodies.join(want, ["slug", "part"]).withColumn("_one", F.get(F.filter("_want", same), 0)).where(F.col("_one").isNotNull())
    return rows.select(*store.bodies.columns, *(F.col("_one")[f].alias(f) for f in flags))


def latest_boards(raw_boards: DataFrame | BoardStore) -> DataFrame:
    """The landed rows of the newest complete fetch of every board."""
    store = as_store(raw_boards)
    return bodies(store, wanted(current_parts(store.index)))


def status_outcome(status: Column, *, non_ok_is_empty: bool = False) -> Column:
    """Outcome from the HTTP status alone (body validity is checked by the adapter).

    2xx -> NULL (decided by parsing); 404 -> 'not_found'; other -> 'error'
    (or 'not_found' where the platform treats every non-2xx as empty);
    NULL status (transport failure) -> 'error'.
    """
    ok = status.between(200, 299)
    other = F.lit("not_found") if non_ok_is_empty else F.lit("error")
    return (
        F.when(status.isNull(), F.lit("error"))
        .when(ok, F.lit(None).cast("string"))
        .when(status == 404, F.lit("not_found"))
        .otherwise(other)
    )


def probes(raw_boards: DataFrame) -> DataFrame:
    """Board existence per (slug, ats): any 2xx HEAD probe -> true; a
    transport failure or any other status -> false."""
    return (
        raw_boards.where(F.col("endpoint") == "probe")
        .groupBy("slug", "ats")
        .agg(F.bool_or(F.coalesce(F.col("http_status").between(200, 299), F.lit(False))).alias("found"))
    )


def ats_ord_col(ats: Column) -> Column:
    expr = None
    for i, name in enumerate(ATS_NAMES):
        expr = (F.when(ats == name, F.lit(i)) if expr is None else expr.when(ats == name, F.lit(i)))
    return expr.otherwise(F.lit(None).cast("int"))
