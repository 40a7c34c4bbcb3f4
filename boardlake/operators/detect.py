"""Platform detection: which ATS has a board for each requested company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import slugify
from ..sources.boards import ats_ord_col, probes
from ..sources.schemas import ATS_NAMES

# Detection result wording.
ALL_ATS_NOTE_PREFIX = "Company found on multiple platforms: "
ALL_ATS_NOTE_SUFFIX = ". Returning first match."


def detect_ats(requests: DataFrame, raw_boards: DataFrame) -> DataFrame:
    """Per request: found platforms (in platform order), status and data.

    0 found -> status 'success', data NULL; 1 -> 'success', that platform;
    more -> 'partial', the first, plus a note.  The registry is not used.
    Only probes of requested slugs are aggregated (semi-join first), and each
    request gathers at most one row per platform, so groups are tiny.
    ``attempted`` lists every platform, ``succeeded`` those found.
    """
    cols = set(requests.columns)
    req = requests.select(
        (F.col("request_id") if "request_id" in cols else F.monotonically_increasing_id()).alias("request_id"),
        "company",
    ).withColumn("slug", slugify("company"))
    probe_rows = raw_boards.where(F.col("endpoint") == "probe").join(req.select("slug"), "slug", "left_semi")
    found = probes(probe_rows).where("found").select("slug", "ats", ats_ord_col(F.col("ats")).alias("ats_ord"))
    hits = (
        found.join(req, "slug", "right")
        .groupBy("request_id", "company", "slug")
        .agg(F.sort_array(F.collect_list(F.when(F.col("ats").isNotNull(), F.struct("ats_ord", "ats")))).alias("_h"))
    )
    platforms = F.transform("_h", lambda h: h["ats"])
    n = F.size(platforms)
    return hits.select(
        "request_id",
        "company",
        "slug",
        platforms.alias("found"),
        F.array(*map(F.lit, ATS_NAMES)).alias("attempted"),
        platforms.alias("succeeded"),
        n.cast("int").alias("n_found"),
        F.when(n > 1, F.lit("partial")).otherwise(F.lit("success")).alias("status"),
        F.get(platforms, 0).alias("data"),
        F.when(
            n > 1, F.concat(F.lit(ALL_ATS_NOTE_PREFIX), F.array_join(platforms, ", "), F.lit(ALL_ATS_NOTE_SUFFIX))
        ).alias("note"),
    )
