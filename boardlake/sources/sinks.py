"""Sinks: full posting records as JSON, and the registry export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output keys of a posting record, in record order.
RECORD_KEYS = (
    ("id", "id"),
    ("company", "company"),
    ("companySlug", "company_slug"),
    ("ats", "ats"),
    ("title", "title"),
    ("department", "department"),
    ("location", "location"),
    ("locationType", "location_type"),
    ("salary", "salary"),
    ("description", "description"),
    ("url", "url"),
    ("postedAt", "posted_at_raw"),
    ("firstSeen", "first_seen"),
    ("lastSeen", "last_seen"),
    ("status", "status"),
    ("metadata", "metadata"),
)

ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _iso_utc(ts: Column) -> Column:
    # render an instant in UTC whatever the session time zone is
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")), ISO_MS)


# The metadata keys each kind of posting has, in its order.
METADATA_KEYS = {
    "greenhouse": ("departments", "greenhouseId", "internal_job_id", "offices"),
    "lever": ("commitment", "leverId", "team", "workplaceType"),
    "ashby": ("ashbyId", "employmentType", "isRemote", "team"),
    "ashby graphql": ("ashbyId", "compensationSummary", "employmentType"),
}


def _metadata_json(ats: Column, meta: Column) -> Column:
    """The platform's metadata object as text, null values kept.  An Ashby
    posting with a compensation summary came from the GraphQL board."""
    kind = F.when((ats == "ashby") & meta["compensationSummary"].isNotNull(), "ashby graphql").otherwise(ats)
    out = F.lit("{}")
    for name, keys in METADATA_KEYS.items():
        out = F.when(kind == name, F.to_json(F.struct(*(meta[k].alias(k) for k in keys)), {"ignoreNullFields": "false"})).otherwise(out)
    return F.coalesce(out, F.lit("{}"))


def posting_record(df: DataFrame, keep=("request_id",)) -> DataFrame:
    """One JSON document per posting with the record's keys.  Null salary
    and postedAt are kept as JSON null; ``keep`` columns ride along."""
    cols = []
    for key, col in RECORD_KEYS[:-1]:
        c = F.col(col)
        if col in ("first_seen", "last_seen"):
            c = _iso_utc(c)
        cols.append(c.alias(key))
    rec = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    # metadata is the last key: its text takes the place of the closing brace
    key = RECORD_KEYS[-1][0]
    own = [c for c in keep if c in df.columns]
    rows = df.select(*own, *(F.col(c).alias(f"_{c}") for c in ("ats", "metadata")), F.explode(F.array(rec)).alias("_rec"))
    whole = F.concat(F.expr("left(_rec, length(_rec) - 1)"), F.lit(f',"{key}":'), _metadata_json(F.col("_ats"), F.col("_metadata")), F.lit("}"))
    return rows.select(*own, whole.alias("json"))


def write_postings_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines of full records (one file per task, no driver collect)."""
    posting_record(df).select("json").write.mode(mode).text(path)


def write_registry_export(registry: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The registry grouped by platform: one JSON-lines folder per platform
    (``ats=greenhouse/`` ...), companies in registry order within it."""
    n = registry.sparkSession.sparkContext.defaultParallelism
    (
        registry.select("ats", "ord", "slug", "name", "sector")
        # range partitions on the full order: a large platform spans several
        # tasks/files, and file order then row order is registry order
        .repartitionByRange(n, "ats", "ord", "slug")
        .sortWithinPartitions("ats", "ord", "slug")
        .write.mode(mode)
        .partitionBy("ats")
        .json(path)
    )


def write_postings_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Materialise normalised postings once ("silver"): parquet partitioned
    by platform, rows clustered by company and source order within files.
    Filters then run on stored columns, so the HTML cleaning is never
    re-evaluated inside a filter."""
    keys = ("ats", "company_slug", "board_part", "posting_pos")
    (
        # range partitioning on the full posting key: a company holding a
        # large share of all postings is split over several tasks
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode(mode)
        .partitionBy("ats")
        .parquet(path)
    )


def read_postings_table(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
