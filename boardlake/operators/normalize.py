"""The posting normaliser: pre-normalised adapter rows -> ``postings``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import js_timestamp
from ..functions.jscompat import col_of, truthy_or
from ..functions.text import id_company, job_id, location_type, salary_from_text, strip_html
from ..sources.schemas import METADATA_TYPE, POSTING_COLS


HANDED = "_handed"


def _seen_col(seen_at) -> Column:
    if seen_at is None:
        return F.current_timestamp()
    if isinstance(seen_at, Column):
        return seen_at
    if isinstance(seen_at, str):
        return F.lit(seen_at).try_cast("timestamp")
    if isinstance(seen_at, _dt.datetime):
        return F.lit(seen_at)
    raise TypeError("seen_at must be None, a Column, an ISO string or a datetime")


def normalise_columns(seen_at=None) -> dict[str, Column]:
    """Column expressions of the 16-field record over a pre-normalised row.

    Truthiness defaults follow the producing tools: '' falls through like
    NULL.  Salary: a structured value wins, else the description text as
    handed over (before cleaning) is searched.
    """
    company = F.col("company")
    slug = F.col("company_slug")
    seen = _seen_col(seen_at)
    raw_meta = F.col("metadata")
    return {
        "id": job_id(id_company(company, slug), F.col("title"), F.col("ats")),
        "company": truthy_or(company, slug, F.lit("")),
        "company_slug": truthy_or(slug, F.lit("")),
        "ats": F.col("ats"),
        "title": truthy_or("title", F.lit("")),
        "department": truthy_or("department", F.lit("")),
        "location": truthy_or("location", F.lit("")),
        "location_type": location_type(truthy_or("location", F.lit(""))),
        "salary": F.coalesce(F.col("salary"), salary_from_text(truthy_or(HANDED, F.lit("")))),
        "description": strip_html(F.col(HANDED)),
        "url": truthy_or("url", F.lit("")),
        "posted_at_raw": F.nullif(F.col("posted_at_raw"), F.lit("")),
        "posted_at": js_timestamp("posted_at_raw"),
        "first_seen": seen,
        "last_seen": seen,
        "status": F.lit("open"),
        "metadata": F.coalesce(raw_meta, F.lit(None).cast(METADATA_TYPE)),
        "ats_ord": F.col("ats_ord").cast("int"),
        "board_part": F.col("board_part").cast("int"),
        "posting_pos": F.col("posting_pos").cast("int"),
    }


def handed_over() -> Column:
    """The description as its platform's tool hands it to the normaliser:
    cleaned once already, but for Ashby, which hands over HTML."""
    return F.when(F.col("ats").isin("greenhouse", "lever"), strip_html("description")).otherwise(F.col("description"))


def normalize(pre: DataFrame, seen_at=None, keep: tuple = ()) -> DataFrame:
    """``POSTING_COLS`` (plus any passthrough ``keep``) of pre-normalised rows.

    All text work is here, so rows dropped before cost none.  The text as
    handed over is a column of its own, since salary and description both
    read it."""
    exprs = normalise_columns(seen_at)
    return pre.withColumn(HANDED, handed_over()).select(*[col_of(k) for k in keep], *[exprs[c].alias(c) for c in POSTING_COLS])
