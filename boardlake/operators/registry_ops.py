"""Registry operators: search, slug -> ATS lookup, grouping by ATS."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jscompat import truthy_or
from ..sources.schemas import ATS_NAMES, MSG_QUERY_OR_SECTOR


def search_registry(registry: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring of ``query`` in (name, or slug when no
    name) or in sector.  An empty query matches everything here; callers
    that need a query check for it."""
    q = (query or "").lower()
    name = F.lower(truthy_or("name", "slug", F.lit("")))
    sector = F.lower(F.coalesce(F.col("sector"), F.lit("")))
    return registry.where(F.contains(name, F.lit(q)) | F.contains(sector, F.lit(q)))


def search_registry_tool(registry: DataFrame, query: str | None = None, sector: str | None = None) -> DataFrame:
    """query and/or sector: the term is query (else sector); a sector, when
    given, must also be contained in the company's sector."""
    if not query and not sector:
        raise ValueError(MSG_QUERY_OR_SECTOR)
    out = search_registry(registry, query or sector)
    if sector:
        out = out.where(F.contains(F.lower(F.coalesce(F.col("sector"), F.lit(""))), F.lit(sector.lower())))
    return out


def ats_by_slug(registry: DataFrame) -> DataFrame:
    """(slug, registry_ats): the first platform, in registry order, listing the slug."""
    return registry.groupBy("slug").agg(F.min_by("ats", "ats_ord").alias("registry_ats"))


def find_ats(requests: DataFrame, registry: DataFrame, slug_col: str = "slug") -> DataFrame:
    """Left join of requests onto the slug lookup; unknown slugs get NULL.
    The join strategy is left to the optimiser, which knows both sizes."""
    lookup = ats_by_slug(registry).withColumnRenamed("slug", "_reg_slug")
    return requests.join(lookup, requests[slug_col] == lookup["_reg_slug"], "left").drop("_reg_slug")


def registry_by_ats(registry: DataFrame) -> DataFrame:
    """The registry grouped by platform, as a table: one row per company,
    in platform order then file order.  Kept as rows (not one array per
    platform) so a large registry never funnels through one task; write it
    with ``partitionBy('ats')`` to get one document per platform."""
    return registry.select("ats", "ats_ord", "ord", "slug", "name", "sector")


def registry_counts(registry: DataFrame) -> DataFrame:
    """Companies per platform; a platform with none still appears with 0."""
    spark = registry.sparkSession
    platforms = spark.createDataFrame([(n, i) for i, n in enumerate(ATS_NAMES)], "ats string, ats_ord int")
    # at most one row per known platform, so the broadcast is bounded by 3
    counts = registry.where(F.col("ats").isin(*ATS_NAMES)).groupBy("ats").agg(F.count(F.lit(1)).alias("n_companies"))
    return platforms.join(F.broadcast(counts), "ats", "left").select(
        "ats", "ats_ord", F.coalesce("n_companies", F.lit(0)).cast("bigint").alias("n_companies")
    )
