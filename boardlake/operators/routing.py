"""Source routing for batches of fetch requests.

A request is (request_id, company, ats?).  Its slug is routed to:
  * the explicit platform, when one is given;
  * else the registry's platform for the slug (only that one is read);
  * else every platform (discovery).
Routing happens on the index of the landed rows, before any body is read: bodies
that no request asked for are never read, and no body moves between tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slugify
from ..sources.adapters import all_postings, ashby_rest_nonempty_slugs, board_outcomes
from ..sources.boards import BoardStore, as_store, bodies, current_parts, wanted
from ..sources.landing import pinned
from ..sources.schemas import ATS_NAMES
from .filters import DEFAULT, apply_filters
from .normalize import normalize
from .registry_ops import find_ats

REQUEST_KEEP = ("request_id", "mode")


def requests_from_list(spark: SparkSession, companies) -> DataFrame:
    """Companies as a request table.  Items are names, or (company, ats) pairs."""
    rows = []
    for i, item in enumerate(companies):
        if isinstance(item, (tuple, list)):
            rows.append((i, item[0], item[1] if len(item) > 1 else None))
        else:
            rows.append((i, item, None))
    return spark.createDataFrame(rows, "request_id long, company string, ats string")


def resolve_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds slug, registry_ats, mode ('explicit' | 'registry' | 'discovery' |
    'invalid') and route_ats (NULL = all platforms)."""
    cols = set(requests.columns)
    req = requests.select(
        (F.col("request_id") if "request_id" in cols else F.monotonically_increasing_id()).alias("request_id"),
        "company",
        (F.col("ats") if "ats" in cols else F.lit(None).cast("string")).alias("ats_requested"),
    ).withColumn("slug", slugify("company"))
    req = find_ats(req, registry)
    known = F.col("ats_requested").isin(*ATS_NAMES)
    mode = (
        F.when(F.coalesce(F.col("company"), F.lit("")) == "", F.lit("invalid"))
        .when(F.col("ats_requested").isNotNull() & ~known, F.lit("invalid"))
        .when(F.col("ats_requested").isNotNull(), F.lit("explicit"))
        .when(F.col("registry_ats").isNotNull(), F.lit("registry"))
        .otherwise(F.lit("discovery"))
    )
    route = F.when(mode == "explicit", F.col("ats_requested")).when(mode == "registry", F.col("registry_ats"))
    return req.withColumn("mode", mode).withColumn("route_ats", route)


def wanted_parts(resolved: DataFrame, index: DataFrame) -> DataFrame:
    """Parts of the newest complete fetches that at least one request reads, each once, with
    ``_strict``: whether a request reads the board by explicit platform or registry, where a
    failure is an error of the call (discovery drops failed sources).

    Works on the index alone: the requests' slugs and platforms cut it down before fetches
    are compared."""
    r = resolved.where(F.col("mode") != "invalid").groupBy(F.col("slug").alias("_r_slug")).agg(
        F.bool_or(F.col("route_ats").isNull()).alias("_any"), F.collect_set("route_ats").alias("_named"))
    named = F.array_contains("_named", F.col("ats"))
    rows = index.where(F.col("endpoint") != "probe").join(r, F.col("slug") == F.col("_r_slug")).where(F.col("_any") | named)
    parts = current_parts(rows.drop("_r_slug", "_any", "_named"))
    return parts.join(r, F.col("slug") == F.col("_r_slug")).withColumn("_strict", named).drop("_r_slug", "_any", "_named")


def read_parts(store: BoardStore, parts: DataFrame) -> DataFrame:
    """The bodies of these parts, with ``_strict``, but for the Ashby GraphQL ones that no call
    reads: those of companies whose REST board has postings.

    REST bodies are looked at for that, lightly; then the wanted parts are written down as a
    small table, and all further reading starts from it."""
    rest = bodies(store, wanted(parts.where((F.col("ats") == "ashby") & (F.col("endpoint") == "rest"))))
    unread = ashby_rest_nonempty_slugs(rest).select(F.col("slug").alias("_unread"))
    graphql = (F.col("ats") == "ashby") & (F.col("endpoint") == "graphql")
    parts = parts.join(unread, graphql & (F.col("slug") == F.col("_unread")), "left_anti")
    return bodies(store, pinned(wanted(parts, "_strict"), "wanted"), "_strict")


def attach_requests(resolved: DataFrame, rows: DataFrame, slug_col: str = "company_slug") -> DataFrame:
    """Rows of boards tagged with the request_id and mode of every request
    that reads their board.  AQE splits a hot slug's rows over tasks."""
    r = resolved.where(F.col("mode") != "invalid").select(
        *REQUEST_KEEP, F.col("slug").alias("_r_slug"), F.col("route_ats").alias("_r_ats")
    )
    on = (rows[slug_col] == r["_r_slug"]) & (r["_r_ats"].isNull() | (r["_r_ats"] == rows["ats"]))
    return rows.join(r, on).drop("_r_slug", "_r_ats")


def raw_postings(resolved: DataFrame, raw_boards: DataFrame | BoardStore, strict: bool = False) -> DataFrame:
    """Pre-normalised postings of every wanted board, parsed once per board,
    then tagged with the requests that read it.  Failed sources contribute
    nothing (see ``fetch_outcomes`` for why), or fail the query with
    ``strict`` unless only discovery reads them."""
    store = as_store(raw_boards)
    boards = read_parts(store, wanted_parts(resolved, store.index))
    rows = all_postings(boards, ("_strict",), F.col("_strict") if strict else None, fallback=False).drop("_strict")
    return attach_requests(resolved, rows)


def fetch_postings(resolved: DataFrame, raw_boards: DataFrame | BoardStore, seen_at=None, strict: bool = False) -> DataFrame:
    """Normalised postings of every routed board, tagged with request_id."""
    return normalize(raw_postings(resolved, raw_boards, strict), seen_at, keep=REQUEST_KEEP)


def fetch_jobs_batch(
    resolved: DataFrame,
    raw_boards: DataFrame | BoardStore,
    title_filter=None,
    filter=None,
    posted_within_days=None,
    location_includes=None,
    location_excludes=None,
    limit=DEFAULT,
    *,
    as_of=None,
    seen_at=None,
    rank_col: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Filtered postings per request; the limit applies per request.

    ``rank_col`` keeps each posting's rank within its request (1-based, in
    source order) so later per-request caps need no second shuffle."""
    rows = raw_postings(resolved, raw_boards, strict)
    before = (title_filter, None, posted_within_days, location_includes, location_excludes)
    if not filter:  # nothing reads the description: clean only what is returned
        rows = apply_filters(rows, *before, limit, as_of=as_of, partition_by=["request_id"], rank_col=rank_col)
        ranked = (rank_col,) if rank_col and rank_col in rows.columns else ()
        return normalize(rows, seen_at, keep=REQUEST_KEEP + ranked)
    rows = apply_filters(rows, *before, None, as_of=as_of)
    postings = normalize(rows, seen_at, keep=REQUEST_KEEP)
    return apply_filters(postings, filter=filter, limit=limit, partition_by=["request_id"], rank_col=rank_col)


def fetch_outcomes(resolved: DataFrame, raw_boards: DataFrame | BoardStore) -> DataFrame:
    """Outcome of every board part a request read.  An 'error' in explicit
    or registry mode is what the single-company call raises; in discovery it
    is dropped silently."""
    store = as_store(raw_boards)
    return attach_requests(resolved, board_outcomes(read_parts(store, wanted_parts(resolved, store.index))), "slug")
