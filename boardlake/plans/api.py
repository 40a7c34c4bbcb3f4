"""User-level entry points.

Every call builds a Spark plan over the landed boards (a store opened with
``open_store``, or any table of ``RAW_BOARDS_DDL``) and a registry table; a batch of companies is one query (not one call per
company).  Argument checks happen on the driver before any job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slugify
from ..operators import detect as _detect
from ..operators import filters as _filters
from ..operators import registry_ops as _registry
from ..operators import routing as _routing
from ..operators import summary as _summary
from ..operators.normalize import normalize
from ..sources import adapters as _adapters
from ..sources.boards import BoardStore, as_store, current_parts
from ..sources.registry import load_registry as _load_registry
from ..sources.registry import load_registry_ats as _load_registry_ats
from ..sources.schemas import (
    ATS_NAMES,
    MSG_COMPANY_REQUIRED,
    MSG_KEYWORD_REQUIRED,
    MSG_UNKNOWN_ATS,
)

DEFAULT = _filters.DEFAULT


def _requests(spark: SparkSession, company, ats=None) -> DataFrame:
    if isinstance(company, DataFrame):
        return company
    if isinstance(company, str):
        if not company:
            raise ValueError(MSG_COMPANY_REQUIRED)
        if ats is not None and ats not in ATS_NAMES:
            raise ValueError(MSG_UNKNOWN_ATS.format(ats=ats, supported=", ".join(ATS_NAMES)))
        return _routing.requests_from_list(spark, [(company, ats)])
    items = list(company)
    if not items:
        raise ValueError(MSG_COMPANY_REQUIRED)
    if ats is not None:
        items = [(c, ats) if isinstance(c, str) else c for c in items]
    return _routing.requests_from_list(spark, items)


def fetch_jobs(
    spark: SparkSession,
    raw_boards: DataFrame | BoardStore,
    registry: DataFrame,
    company,
    ats: str | None = None,
    title_filter: str | None = None,
    filter: str | None = None,
    posted_within_days=None,
    location_includes=None,
    location_excludes=None,
    limit=DEFAULT,
    *,
    as_of=None,
    seen_at=None,
    strict: bool | None = None,
    rank_col: str | None = None,
) -> DataFrame:
    """Normalised, filtered postings of one company or of a batch.

    ``company``: a name/slug, a list of names (or (name, ats) pairs), or a
    DataFrame (request_id, company[, ats]).  Routing per company: explicit
    ``ats`` > the registry's platform > every platform.  The limit applies
    per company (default 100; ``None`` = unlimited).

    Boards are read as of their newest snapshot.  With ``strict`` the query
    fails on a board read by explicit platform or registry that has an error
    status or a broken body (a missing board is empty, a failed source in
    discovery is dropped, an unread Ashby GraphQL board does not matter).
    The default is strict for one company and lenient for a batch.
    ``rank_col`` names a column for each posting's place in its request, which
    ``preview`` can use.
    """
    requests = _requests(spark, company, ats)
    resolved = _routing.resolve_requests(requests, registry)
    return _routing.fetch_jobs_batch(
        resolved, raw_boards, title_filter, filter, posted_within_days, location_includes, location_excludes,
        limit, as_of=as_of, seen_at=seen_at, strict=isinstance(company, str) if strict is None else strict, rank_col=rank_col,
    )


def fetch_jobs_tool(spark: SparkSession, raw_boards: DataFrame, registry: DataFrame, company, **filters) -> tuple[DataFrame, DataFrame]:
    """``fetch_jobs`` plus its per-company metadata (count, registry_hit, ats)."""
    filters.setdefault("strict", isinstance(company, str))
    resolved = _routing.resolve_requests(_requests(spark, company), registry)
    results = _routing.fetch_jobs_batch(resolved, raw_boards, **filters)
    return results, _summary.fetch_summary(resolved, results)


def sector_sweep(
    spark: SparkSession,
    raw_boards: DataFrame | BoardStore,
    registry: DataFrame,
    sector: str,
    query: str | None = None,
    **filters,
) -> DataFrame:
    """Postings of every registered company of a sector in one query: the
    registry search (query and/or sector) becomes the request table, each
    company is fetched from the platform of its registry entry, filters
    apply, and the limit applies per entry.  ``request_id`` is the entry's
    'platform/slug'; an entry listed twice is one."""
    hits = _registry.search_registry_tool(registry, query, sector)
    requests = hits.select(
        F.concat_ws("/", "ats", "slug").alias("request_id"), F.col("slug").alias("company"), "ats"
    ).distinct()
    resolved = _routing.resolve_requests(requests, registry)
    return _routing.fetch_jobs_batch(resolved, raw_boards, **filters)


def search(registry: DataFrame, keyword: str, location=None, ats=None) -> DataFrame:
    """Registry search by keyword (location and ats are accepted, unused)."""
    if not keyword:
        raise ValueError(MSG_KEYWORD_REQUIRED)
    return _registry.search_registry(registry, keyword)


def search_registry_tool(registry: DataFrame, query: str | None = None, sector: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Matches plus a one-row summary (count, query, sector)."""
    hits = _registry.search_registry_tool(registry, query, sector)
    summary = hits.agg(F.count(F.lit(1)).alias("count")).select(
        "count", F.lit(query or None).cast("string").alias("query"), F.lit(sector or None).cast("string").alias("sector")
    )
    return hits, summary


def detect_ats(spark: SparkSession, raw_boards: DataFrame, company) -> DataFrame:
    """Platforms with a board per company (probes only; no registry)."""
    return _detect.detect_ats(_requests(spark, company), current_parts(as_store(raw_boards).index.where(F.col("endpoint") == "probe")))


def find_ats_by_slug(spark: SparkSession, registry: DataFrame, slugs) -> DataFrame:
    """(slug, registry_ats) for each slug; NULL when not registered.
    ``slugs``: one, a list, or a table with a slug column."""
    if not isinstance(slugs, DataFrame):
        slugs = spark.createDataFrame([(s,) for s in ([slugs] if isinstance(slugs, str) else slugs)], "slug string")
    return _registry.find_ats(slugs, registry)


def load_registry(spark: SparkSession, registry_dir: str, ats: str | None = None) -> DataFrame:
    return _load_registry_ats(spark, registry_dir, ats) if ats else _load_registry(spark, registry_dir)


def apply_filters(df: DataFrame, **kwargs) -> DataFrame:
    return _filters.apply_filters(
        df,
        kwargs.pop("title_filter", None),
        kwargs.pop("filter", None),
        kwargs.pop("posted_within_days", None),
        kwargs.pop("location_includes", None),
        kwargs.pop("location_excludes", None),
        kwargs.pop("limit", DEFAULT),
        **kwargs,
    )


def _direct(spark, raw_boards, ats, slugs, seen_at=None, strict=None) -> DataFrame:
    """Postings of the named boards of one platform, as of their newest
    snapshot.  Strict (the default for one slug) as in ``fetch_jobs``."""
    strict = isinstance(slugs, str) if strict is None else strict
    if not isinstance(slugs, DataFrame):
        slugs = spark.createDataFrame([(s,) for s in ([slugs] if isinstance(slugs, str) else slugs)], "slug string")
    asked = slugs.select(slugify("slug").alias("slug")).distinct()
    store = as_store(raw_boards)
    index = store.index.where((F.col("ats") == ats) & (F.col("endpoint") != "probe")).join(asked, "slug", "left_semi")
    boards = _routing.read_parts(store, current_parts(index).withColumn("_strict", F.lit(strict)))
    # the parts that a fallback does not need are not among them
    fetch = _adapters.adapter(ats)
    options = {"fallback": False} if ats == "ashby" else {}
    return normalize(fetch(boards, strict=F.lit(True) if strict else None, **options), seen_at)


def fetch_greenhouse(spark, raw_boards, slugs, seen_at=None, strict=None) -> DataFrame:
    return _direct(spark, raw_boards, "greenhouse", slugs, seen_at, strict)


def fetch_lever(spark, raw_boards, slugs, seen_at=None, strict=None) -> DataFrame:
    return _direct(spark, raw_boards, "lever", slugs, seen_at, strict)


def fetch_ashby(spark, raw_boards, slugs, seen_at=None, strict=None) -> DataFrame:
    return _direct(spark, raw_boards, "ashby", slugs, seen_at, strict)


def preview(results: DataFrame, rank_col: str | None = None) -> DataFrame:
    return _summary.preview(results, rank_col=rank_col)
