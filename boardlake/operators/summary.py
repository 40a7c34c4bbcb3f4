"""Result summaries: per-request counts with registry annotation, and the
plain-text preview of postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import first_n_per

# Preview layout.
PREVIEW_ROWS = 20
PREVIEW_CHARS = 120


def fetch_summary(resolved: DataFrame, results: DataFrame) -> DataFrame:
    """One row per request: count of returned postings (0 when none),
    registry_hit and the registry's platform (NULL in discovery even when
    boards were found).  Counts are pre-aggregated before the join."""
    counts = results.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0)).cast("bigint")
    return resolved.join(counts, "request_id", "left").select(
        "request_id",
        "company",
        "slug",
        "mode",
        n.alias("count"),
        F.col("registry_ats").isNotNull().alias("registry_hit"),
        F.col("registry_ats").alias("ats"),
        more_line(n).alias("more"),
    )


def _fmt_amount(x: Column) -> Column:
    """Grouped thousands and up to three decimals, no trailing zeros; an
    amount that could not be read shows as NaN."""
    text = F.regexp_replace(F.format_number(x, 3), r"\.?0+$", "")
    return F.when(x.isNull() | F.isnan(x), "NaN").otherwise(text)


def preview_lines(results: DataFrame) -> DataFrame:
    """Preview columns of each posting: heading, url and a one-line
    description teaser (first 120 characters, newlines as spaces, '...')."""
    dept = F.when(F.col("department") != "", F.concat(F.lit(" ["), F.col("department"), F.lit("]"))).otherwise(F.lit(""))
    loc = F.when(F.col("location") != "", F.concat(F.lit(" | "), F.col("location"))).otherwise(F.lit(""))
    sal = F.when(
        F.col("salary").isNotNull(),
        F.concat(F.lit(" | $"), _fmt_amount(F.col("salary.min")), F.lit("-$"), _fmt_amount(F.col("salary.max"))),
    ).otherwise(F.lit(""))
    teaser = F.when(
        F.col("description") != "",
        F.concat(F.regexp_replace(F.substring("description", 1, PREVIEW_CHARS), "\n", " "), F.lit("...")),
    )
    return results.select(
        "*",
        F.concat(F.col("title"), dept, loc, sal).alias("heading"),
        teaser.alias("teaser"),
    )


def preview(results: DataFrame, partition_by=("request_id",), rank_col: str | None = None) -> DataFrame:
    """At most 20 preview rows per request, in source order.  When the
    results carry their per-request rank, it is reused (no new shuffle)."""
    if rank_col and rank_col in results.columns:
        return preview_lines(results.where(F.col(rank_col) <= PREVIEW_ROWS))
    return first_n_per(preview_lines(results), PREVIEW_ROWS, list(partition_by))


def more_line(count: Column) -> Column:
    return F.when(
        count > PREVIEW_ROWS,
        F.concat(F.lit("... and "), (count - PREVIEW_ROWS).cast("string"), F.lit(" more. Use --json for full output.")),
    )
