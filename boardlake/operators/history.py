"""Posting history: when each posting was seen, over all landed scans.

A scan is one complete fetch of a board (an Ashby company's REST and GraphQL fetches of one
``fetch_id`` are one scan).  A scan that failed, or has landed in part only, says nothing about
the board's postings.  Consecutive scans of a board that list a posting are one interval; a
scan without it ends the interval, and if it is listed again later another one begins.

Every body is read and parsed once, where it lies, into its outcome and the ids of its
postings.  All joins and windows work on those small rows: scans are numbered in each board,
ids are told apart by (board, id), and the intervals are islands of consecutive numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.jscompat import truthy_or
from ..functions.text import id_company, job_id, title_case_slug
from ..sources.adapters import parse_ashby_graphql, parse_ashby_rest, parse_greenhouse, parse_lever
from ..sources.boards import KEYS, SALTS, BoardStore, as_store, complete_fetches, landed_parts

_FETCH = ("fetch_id", "landing", "fetched_at")


def _ids(ats: str, company: Column, title: str) -> Column:
    """The ids that the normaliser gives the postings of a board part."""
    name = id_company(company, F.col("slug"))
    return F.array_distinct(F.transform("jobs", lambda j: job_id(name, truthy_or(j[title], F.lit("")), F.lit(ats))))


def observations(raw_boards: DataFrame | BoardStore) -> DataFrame:
    """(ats, slug, endpoint, part, fetch_id, landing, fetched_at, outcome, ids): every landed
    part that belongs to a named fetch, with the ids of its postings."""
    rows = as_store(raw_boards).bodies.where(F.col("fetch_id").isNotNull())
    board = truthy_or(F.col("board_name"), F.col("slug"))
    parsed = (
        (parse_greenhouse(rows, _FETCH), _ids("greenhouse", board, "title")),
        (parse_lever(rows, _FETCH), _ids("lever", title_case_slug(F.col("slug")), "text")),
        (parse_ashby_rest(rows, _FETCH), _ids("ashby", board, "title")),
        (parse_ashby_graphql(rows, _FETCH), _ids("ashby", board, "title")),
    )
    out = None
    for frame, ids in parsed:
        part = frame.select(*KEYS, "part", *_FETCH, "outcome", F.coalesce(ids, F.array().cast("array<string>")).alias("ids"))
        out = part if out is None else out.unionByName(part)
    return out


def scans(observed: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable scans, numbered in each board, and the observed parts of complete fetches.

    (ats, slug, fetch_id, at, used, n, next_at): ``used`` is the endpoint whose postings count,
    ``next_at`` the time of the board's next usable scan.
    """
    landed = landed_parts(index.where(F.col("fetch_id").isNotNull() & (F.col("endpoint") != "probe")))
    whole = complete_fetches(landed).select(*KEYS, "fetch_id", "at")
    # of a part landed several times its latest row
    latest = landed.select(*KEYS, "part", "fetch_id", "last.landing", "last.fetched_at")
    parts = observed.join(latest, [*KEYS, "part", *_FETCH], "left_semi")
    totals = parts.groupBy(*KEYS, "fetch_id").agg(F.sum(F.size("ids")).alias("jobs"), F.bool_or(F.col("outcome") == "error").alias("failed"))
    of = lambda endpoint, c: F.max(F.when(F.col("endpoint") == endpoint, F.col(c)))
    board = whole.join(totals, [*KEYS, "fetch_id"]).groupBy("ats", "slug", "fetch_id").agg(
        F.max("at").alias("at"), of("board", "failed").alias("board"), of("rest", "failed").alias("rest"),
        of("graphql", "failed").alias("graphql"), F.coalesce(of("rest", "jobs"), F.lit(0)).alias("rest_jobs"),
    )
    used = F.when(F.col("board").isNotNull(), "board").when(F.col("rest_jobs") > 0, "rest").when(F.col("graphql").isNotNull(), "graphql").otherwise("rest")
    failed = F.when(used == "board", F.col("board")).when(used == "graphql", F.col("graphql")).otherwise(F.col("rest"))
    order = W.partitionBy("ats", "slug").orderBy("at", "fetch_id")
    good = board.withColumn("used", used).where(~failed)
    return good.select("ats", "slug", "fetch_id", "at", "used", F.row_number().over(order).alias("n"), F.lead("at").over(order).alias("next_at")), parts


def posting_history(raw_boards: DataFrame | BoardStore) -> DataFrame:
    """(ats, company_slug, id, interval, first_seen, last_seen, closed_at, status, n_scans): one
    row for each interval in which a posting was listed, numbered from 1.

    ``closed_at`` is the time of the first scan without it, null while it is ``open``.  Rows
    landed without a ``fetch_id`` take no part, and a posting listed several times in a scan is
    listed once.  A board without a usable scan has no rows.
    """
    store = as_store(raw_boards)
    good, parts = scans(observations(store), store.index)
    # a board of very many parts does not meet in one task; merged, since files of short bodies
    # look small enough to broadcast every id, which one task would then join
    salted = good.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = parts.withColumn("_salt", F.pmod("part", F.lit(SALTS))).join(salted.hint("merge"), ["ats", "slug", "fetch_id", "_salt"])
    rows = rows.where(F.col("endpoint") == F.col("used"))
    key = ["ats", "slug", "id"]
    # Ids compress far better than the windows' sorted rows: tasks joined by the size of their
    # compressed input would hold too many.  A number that is given keeps one for each partition.
    seen = rows.select("ats", "slug", F.explode("ids").alias("id"), "n", "at", "next_at")
    seen = seen.repartition(int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    # the same id in two parts of a scan has the same rank, so nothing need hold all rows to drop it
    island = F.col("n") - F.dense_rank().over(W.partitionBy(*key).orderBy("n"))
    runs = seen.withColumn("island", island).groupBy(*key, "island").agg(
        F.min("at").alias("first_seen"), F.max("at").alias("last_seen"), F.max_by("next_at", "n").alias("closed_at"),
        (F.max("n") - F.min("n") + 1).cast("bigint").alias("n_scans"),
    )
    interval = F.row_number().over(W.partitionBy(*key).orderBy("first_seen", "island"))
    status = F.when(F.col("closed_at").isNull(), "open").otherwise("closed")
    return runs.select("ats", F.col("slug").alias("company_slug"), "id", interval.alias("interval"), "first_seen", "last_seen", "closed_at", status.alias("status"), "n_scans")


def with_history(postings: DataFrame, history: DataFrame) -> DataFrame:
    """``postings`` with ``first_seen``, ``last_seen`` and ``status`` from their history; a
    posting without one keeps its own."""
    key = ["ats", "company_slug", "id"]
    known = history.groupBy(*key).agg(
        F.min("first_seen").alias("_first"), F.max("last_seen").alias("_last"), F.bool_or(F.col("status") == "open").alias("_open"))
    kept = {
        "first_seen": F.coalesce("_first", "first_seen"), "last_seen": F.coalesce("_last", "last_seen"),
        "status": F.when(F.col("_open"), "open").when(~F.col("_open"), "closed").otherwise(F.col("status")),
    }
    return postings.join(known, key, "left").select(*(kept.get(c, F.col(c)).alias(c) for c in postings.columns))
