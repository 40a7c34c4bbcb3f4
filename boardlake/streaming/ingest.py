"""Incremental ingestion of landed boards with Structured Streaming.

New ``raw_boards`` files arriving in a landing folder are parsed and normalised by the same
operators as the batch path into a table of current postings.  ``availableNow`` processes what
has landed and stops (the streaming form of a scheduled scan).

Each micro-batch works on its own rows and on the state of the buckets they fall into, never
on the whole landing folder.  A bucket is a hash of the slug under a platform; its state is

* ``boards``    which fetch of each (company, endpoint) the postings are from,
* ``postings``  the postings of those fetches,
* ``pending``   landed rows whose fetch is not complete yet.

A batch joins its rows with the pending ones, replaces the postings of the boards that now have
a newer complete fetch, and writes new files for the buckets it has touched.  A manifest then
names, for each bucket, its current files; a bucket that has lost all its postings is named as
empty.  The manifest is written last and renamed into place, so readers see all of a batch or
nothing of it, and a batch that is run again (a restart, a lost checkpoint folder) finds nothing
newer than what it has written and changes nothing.
"""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.normalize import normalize
from ..sources.adapters import ashby_graphql_postings, ashby_rest_postings, greenhouse_postings, lever_postings, parse_ashby_graphql, parse_ashby_rest
from ..sources.boards import KEYS, SAME_FETCH, BoardStore, bodies, current_parts, wanted, with_fetch
from ..sources.landing import file_system, pinned
from ..sources.schemas import ATS_NAMES, RAW_BOARDS_DDL

LANDED_DDL = f"{RAW_BOARDS_DDL}, fetch_id STRING, n_parts INT"
BOARDS_DDL = "ats STRING, slug STRING, endpoint STRING, fetch_id STRING, at TIMESTAMP"
PENDING_DDL = f"{LANDED_DDL}, landing STRING"
KINDS = ("boards", "postings", "pending")


def read_landing(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_dir)


ENDPOINTS = (
    ("greenhouse", "board", greenhouse_postings),
    ("lever", "board", lever_postings),
    ("ashby", "rest", lambda rows: ashby_rest_postings(parse_ashby_rest(rows))),
    ("ashby", "graphql", lambda rows: ashby_graphql_postings(parse_ashby_graphql(rows))),
)


def endpoint_postings(boards: DataFrame, seen_at=None, platforms=ATS_NAMES) -> DataFrame:
    """Normalised postings of every endpoint of these platforms, with ``endpoint``; no fallback
    is decided."""
    out = None
    for ats, endpoint, postings in ENDPOINTS:
        if ats in platforms:
            rows = postings(boards).withColumn("endpoint", F.lit(endpoint))
            out = rows if out is None else out.unionByName(rows)
    return normalize(out, seen_at, keep=("endpoint",))


# ---------------------------------------------------------------- manifest
def _manifests(spark: SparkSession, out_dir: str) -> dict[int, str]:
    fs, folder = file_system(spark, f"{out_dir}/manifest")
    if not fs.exists(folder):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return {int(n.removesuffix(".json")): f"{out_dir}/manifest/{n}" for n in names if n.endswith(".json")}


def read_manifest(spark: SparkSession, out_dir: str) -> dict:
    """The newest manifest: its version, the number of buckets, and for each ``ats/bucket`` and
    kind the folder that holds it, or null for none.  Its size goes with the number of buckets."""
    known = _manifests(spark, out_dir)
    if not known:
        return {"version": 0, "buckets": None, "entries": {}}
    fs, path = file_system(spark, known[max(known)])
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, out_dir: str, manifest: dict) -> None:
    fs, made = file_system(spark, f"{out_dir}/manifest/{manifest['version']:09d}.{uuid.uuid4().hex}.tmp")
    _, done = file_system(spark, f"{out_dir}/manifest/{manifest['version']:09d}.json")
    stream = fs.create(made)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    if not fs.rename(made, done):
        raise RuntimeError(f"another writer has written version {manifest['version']} of {out_dir}")


def _read(spark: SparkSession, manifest: dict, kind: str, schema, names=None) -> DataFrame:
    found = [e[kind] for name, e in manifest["entries"].items() if e[kind] and (names is None or name in names)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read_postings(spark: SparkSession, out_dir: str) -> DataFrame:
    """The current postings of all boards, as of the newest manifest."""
    manifest = read_manifest(spark, out_dir)
    rows = _read(spark, manifest, "postings", _postings_ddl())
    return rows.where("read").drop("endpoint", "read")


@functools.cache
def _postings_ddl() -> str:
    """The schema of stored postings, read off a plan that makes them; once in a process, as
    such a plan is large."""
    spark = SparkSession.getActiveSession()
    rows = endpoint_postings(spark.createDataFrame([], PENDING_DDL), None, ("lever",)).withColumn("read", F.lit(True))
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


# ---------------------------------------------------------------- one batch
def refresh(batch: DataFrame, out_dir: str, seen_at=None, buckets: int = 64) -> dict:
    """Bring the state in ``out_dir`` up to date with landed rows; returns the new manifest."""
    spark = batch.sparkSession
    manifest = read_manifest(spark, out_dir)
    buckets = manifest["buckets"] or buckets
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    fresh = with_fetch(batch.where(F.col("endpoint") != "probe"))
    touched = {f"{r[0]}/{r[1]}" for r in fresh.select("ats", bucket("slug").alias("b")).distinct().collect()}  # platforms x buckets at most
    if not touched:
        return manifest
    state = {k: _read(spark, manifest, k, s, touched) for k, s in zip(KINDS, (BOARDS_DDL, _postings_ddl(), PENDING_DDL), strict=True)}
    # a row that is pending and lands again is one row
    rows = state["pending"].unionByName(fresh.select(*state["pending"].columns))
    rows = rows.dropDuplicates([*KEYS, "part", "fetch_id", "fetched_at"]).persist()
    try:
        parts = current_parts(rows.drop("body"))
        have = state["boards"].select(*(F.col(c).alias(f"_{c}") for c in KEYS), F.col("fetch_id").alias("_fetch"), F.col("at").alias("_at"))
        same = (F.col("ats") == F.col("_ats")) & (F.col("slug") == F.col("_slug")) & (F.col("endpoint") == F.col("_endpoint"))
        news = parts.join(have, same, "left")
        # rows without a fetch id: their parts may still come, so the fetch is taken again
        later = F.struct(F.coalesce("fetched_at", F.lit(0).cast("timestamp")), F.coalesce("fetch_id", F.lit(""))) > F.struct(
            F.coalesce("_at", F.lit(0).cast("timestamp")), F.coalesce("_fetch", F.lit("")))
        whole = W.partitionBy(*KEYS)
        news = news.withColumn("at", F.max("fetched_at").over(whole))
        news = news.withColumn("_new", F.max(F.col("_ats").isNull() | later | F.col("fetch_id").isNull()).over(whole)).where("_new")
        # the parts to read, as a small table: the three writes start from it
        news = pinned(news.select(*parts.columns, "at"), "news")
        replaced = news.select(*KEYS, "fetch_id", "at").distinct()
        keys = replaced.select(*KEYS)
        platforms = {name.split("/")[0] for name in touched}
        boards = bodies(BoardStore(rows, rows.drop("body")), wanted(news))
        kept = state["postings"].drop("read").withColumn("slug", F.col("company_slug")).join(keys, list(KEYS), "left_anti").drop("slug")
        postings = kept.unionByName(endpoint_postings(boards, seen_at, platforms).select(*kept.columns))
        if "ashby" in platforms:
            rest = postings.where("endpoint = 'rest'").select("ats", "company_slug").distinct().withColumn("_rest", F.lit(True))
            postings = postings.join(rest, ["ats", "company_slug"], "left").withColumn("read", F.col("_rest").isNull() | (F.col("endpoint") != "graphql")).drop("_rest")
        else:
            postings = postings.withColumn("read", F.lit(True))
        now = state["boards"].join(keys, list(KEYS), "left_anti").unionByName(replaced)
        # of rows that no current fetch has used: those at least as new as the board's current fetch
        at = now.select(*(F.col(c).alias(f"_{c}") for c in KEYS), F.col("fetch_id").alias("_fetch"), F.col("at").alias("_at"))
        newer = F.col("fetched_at") >= F.col("_at")
        ours = F.col("fetch_id").isNull() & (F.coalesce("fetched_at", F.lit(0).cast("timestamp")) >= F.coalesce(F.col("_at") - F.expr(SAME_FETCH), F.lit(0).cast("timestamp")))
        waiting = F.col("_ats").isNull() | ours | (F.col("fetch_id").isNotNull() & ~F.col("fetch_id").eqNullSafe(F.col("_fetch")) & F.coalesce(newer, F.lit(True)))
        pending = rows.join(at, same, "left").where(waiting).select(*state["pending"].columns)
        return _write(spark, out_dir, manifest, buckets, touched, {"boards": now, "postings": postings, "pending": pending}, bucket)
    finally:
        rows.unpersist()


def _write(spark, out_dir: str, manifest: dict, buckets: int, touched: set, frames: dict, bucket) -> dict:
    version = manifest["version"] + 1
    entries = {name: dict(e) for name, e in manifest["entries"].items()}
    for name in touched:
        entries[name] = dict.fromkeys(KINDS)
    for kind, df in frames.items():
        top = f"{out_dir}/data/{version:09d}-{uuid.uuid4().hex[:8]}/{kind}"
        slug = "company_slug" if kind == "postings" else "slug"
        df.withColumn("_a", F.col("ats")).withColumn("_b", bucket(slug)).write.partitionBy("_a", "_b").parquet(top)
        fs, folder = file_system(spark, top)
        for a in (f.getPath() for f in fs.listStatus(folder) if f.isDirectory()):
            for b in (f.getPath() for f in fs.listStatus(a) if f.isDirectory()):
                entries[f"{a.getName().removeprefix('_a=')}/{b.getName().removeprefix('_b=')}"][kind] = b.toString()
    new = {"version": version, "buckets": buckets, "entries": entries}
    _commit(spark, out_dir, new)
    return new


def run_ingest(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    seen_at=None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    buckets: int = 64,
):
    """Keep the postings in ``out_dir`` (see ``read_postings``) those of the newest complete
    fetch of every landed board.  ``out_dir`` and ``checkpoint_dir`` must be shared, durable
    folders; ``buckets``, fixed by the first run, bounds what a batch rewrites.  Returns the
    started StreamingQuery."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        refresh(batch, out_dir, seen_at, buckets)

    q = (
        read_landing(spark, landing_dir, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
    )
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
