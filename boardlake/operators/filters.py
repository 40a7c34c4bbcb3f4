"""Posting filters (title, topic, recency, location include/exclude) and
first-N limits, as chained ``where`` clauses over any postings DataFrame.

All arguments are checked and compiled on the driver when the plan is
built; rows are only ever touched by built-in Spark expressions.
"""

from __future__ import annotations

import datetime as _dt
import math
import time
from functools import reduce
from numbers import Real

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import js_timestamp
from ..functions.jscompat import (
    WORD_BOUNDARY,
    any_of,
    col_of,
    js_escape_literal,
    js_regex,
    py_js_trim,
    utf16_len,
    validate_java_regex,
)
from ..sources.schemas import ORDER_COLS

DEFAULT_LIMIT = 100
MS_PER_DAY = 86_400_000


class _Default:
    def __repr__(self):
        return "DEFAULT"


DEFAULT = _Default()

# JavaScript's Date range in milliseconds.
_MAX_MS = 8_640_000_000_000_000


def _spark_of(df: DataFrame):
    return getattr(df, "sparkSession", None)


def regex_match(col, js_pattern: str, spark=None) -> Column:
    """Case-insensitive JavaScript regex search; NULL is tested as ''."""
    java = js_regex(js_pattern)
    if spark is not None:
        validate_java_regex(spark, java)
    return F.coalesce(col_of(col), F.lit("")).rlike(java)


def title_filter(df: DataFrame, pattern: str | None) -> DataFrame:
    if not pattern:
        return df
    return df.where(regex_match("title", pattern, _spark_of(df)))


def topic_filter(df: DataFrame, pattern: str | None) -> DataFrame:
    """Regex over title OR department OR description (cheapest first)."""
    if not pattern:
        return df
    s = _spark_of(df)
    return df.where(
        regex_match("title", pattern, s) | regex_match("department", pattern, s) | regex_match("description", pattern, s)
    )


def as_of_ms(as_of=None) -> float:
    """Reference time in epoch milliseconds (default: now, at plan build)."""
    if as_of is None:
        return float(int(time.time() * 1000))
    if isinstance(as_of, Real) and not isinstance(as_of, bool):
        return float(as_of)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of.replace("Z", "+00:00"))
    if isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime(as_of.year, as_of.month, as_of.day)
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=_dt.timezone.utc)
        return float(round(as_of.timestamp() * 1000))
    raise TypeError("as_of must be None, epoch ms, an ISO string, a date or a datetime")


def recency_predicate(posted_within_days, as_of=None, posted_at: Column | None = None) -> Column | None:
    """posted >= as_of - N * 24h (exact 24 h blocks, inclusive).

    NULL/unparseable dates are dropped, future dates kept, NaN keeps nothing.
    ``posted_at`` is the parsed instant (default: parsed from the raw text);
    a stored column compared with a constant can be pushed to the scan.
    """
    if posted_within_days is None:
        return None
    if isinstance(posted_within_days, bool) or not isinstance(posted_within_days, Real):
        raise TypeError("posted_within_days must be a number")
    n = float(posted_within_days)
    if math.isnan(n):
        return F.lit(False)
    posted = js_timestamp("posted_at_raw") if posted_at is None else posted_at
    cutoff = as_of_ms(as_of) - n * MS_PER_DAY
    if math.isinf(cutoff) or abs(cutoff) > _MAX_MS:  # beyond every date
        return posted.isNotNull() if cutoff < 0 else F.lit(False)
    # dates have whole milliseconds: at least the cutoff means at least its ceiling
    return posted >= F.timestamp_millis(F.lit(math.ceil(cutoff)))


def _posted(df: DataFrame) -> Column | None:
    return F.col("posted_at") if "posted_at" in df.columns else None


def recency_filter(df: DataFrame, posted_within_days, as_of=None) -> DataFrame:
    pred = recency_predicate(posted_within_days, as_of, _posted(df))
    return df if pred is None else df.where(pred)


def location_matcher(needle, loc_lower: Column) -> Column:
    """One keyword: trimmed + lower-cased; <= 4 UTF-16 units -> whole-word
    (ASCII boundaries), longer -> substring; blank -> never matches."""
    lower = py_js_trim((needle or "").lower()) if isinstance(needle, str) or needle is None else py_js_trim(str(needle).lower())
    if not lower:
        return F.lit(False)
    if utf16_len(lower) <= 4:
        return loc_lower.rlike(WORD_BOUNDARY + js_escape_literal(lower) + WORD_BOUNDARY)
    return F.contains(loc_lower, F.lit(lower))


def _loc_lower(location="location") -> Column:
    return F.lower(F.coalesce(col_of(location), F.lit("")))


def location_include_predicate(keywords) -> Column | None:
    if not isinstance(keywords, (list, tuple)) or len(keywords) == 0:
        return None
    loc = _loc_lower()
    return any_of(location_matcher(k, loc) for k in keywords)


def location_exclude_predicate(keywords) -> Column | None:
    if not isinstance(keywords, (list, tuple)) or len(keywords) == 0:
        return None
    loc = _loc_lower()
    return ~any_of(location_matcher(k, loc) for k in keywords)


def normalise_limit(limit):
    """DEFAULT -> 100; None/NaN -> unlimited; fractions truncate; negatives rejected."""
    if limit is DEFAULT:
        return DEFAULT_LIMIT
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, Real):
        return None
    if math.isnan(limit) or math.isinf(limit):
        return None
    if limit < 0:
        raise ValueError("limit must be >= 0 (negative limits are not supported)")
    return int(limit)


def first_n(df: DataFrame, n: int, order_cols=ORDER_COLS) -> DataFrame:
    """First N rows in source order (a single request / company)."""
    return df.orderBy(*order_cols).limit(n)


def first_n_per(df: DataFrame, n: int, partition_cols, order_cols=ORDER_COLS, rank_col: str | None = None) -> DataFrame:
    """First N rows per key in source order.

    ``row_number() <= n`` is planned as a partial WindowGroupLimit before the
    shuffle, so a hot key ships at most N rows per map task.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    rn = rank_col or "_rn"
    cols = df.columns
    out = df.select("*", F.row_number().over(w).alias(rn)).where(F.col(rn) <= n)
    return out if rank_col else out.select(*cols)


def apply_filters(
    df: DataFrame,
    title_filter: str | None = None,  # noqa: F811 - the reference's argument names
    filter: str | None = None,  # noqa: A002
    posted_within_days=None,
    location_includes=None,
    location_excludes=None,
    limit=DEFAULT,
    *,
    as_of=None,
    partition_by=None,
    order_cols=ORDER_COLS,
    rank_col: str | None = None,
) -> DataFrame:
    """All filters AND-ed, then the limit (per ``partition_by`` key when
    given).  The result equals applying title -> topic -> date -> include ->
    exclude in turn; the conjuncts are ordered cheapest first (one Filter,
    evaluated left to right) so that the topic filter, whose description
    branch may evaluate the HTML cleaning, only sees rows that passed the
    others, and within it title and department are tried before the
    description."""
    spark = _spark_of(df)
    preds = []
    if title_filter:
        preds.append(regex_match("title", title_filter, spark))
    for p in (
        recency_predicate(posted_within_days, as_of, _posted(df)),
        location_include_predicate(location_includes),
        location_exclude_predicate(location_excludes),
    ):
        if p is not None:
            preds.append(p)
    if filter:
        preds.append(
            regex_match("title", filter, spark) | regex_match("department", filter, spark)
            | regex_match("description", filter, spark)
        )
    out = df.where(reduce(lambda a, b: a & b, preds)) if preds else df
    n = normalise_limit(limit)
    if n is None:
        return out
    if partition_by:
        return first_n_per(out, n, partition_by, order_cols, rank_col)
    return first_n(out, n, order_cols)
