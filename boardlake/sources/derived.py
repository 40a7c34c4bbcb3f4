"""Posting-shaped views derived from the driver's generic tables.

The test tables hold no job boards, so boards, registries and requests are
derived from ``documents`` (one document = one posting, ``source`` = the
company slug) and ``supplier`` (unknown companies) by fixed arithmetic on
keys.  The same rules are written once more, independently, as DuckDB SQL
in ``boardlake.plans.oracle``; both sides must agree row for row.

Every view scales with its input: nothing here caps, samples or collects.
Board bodies are built per (platform, slug, part) where ``part`` is a
fixed-width doc_id range, so no body grows with a hot company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import js_timestamp
from .boards import BoardStore, land_boards, latest_boards, open_store
from .schemas import ATS_NAMES

AS_OF = "2024-01-31T00:00:00Z"
AS_OF_DATE = "2024-01-31"
PART_WIDTH = 500  # doc_ids per landed board part

# Fixture vocabularies (by doc_id modulo their length).
TITLES = (
    "Yard keeper, night shift",
    "Surveyor of tides",
    "Dock Keeper II (Payments)",
    "",
    None,
    "TIDE-TABLE CLERK",
    "ÉQUIPAGE lead",
    None,  # 7: 'Charter pilot $A - $B' (built from the amounts)
)
DEPARTMENTS = ("Engineering", "Product", "Growth", "", None)
# A short keyword counts as a whole word, bounded as ASCII letters, digits and the
# underscore are; a long one anywhere.  Each word below stands whole, inside another word,
# beside a hyphen, an underscore, a digit and a letter beyond ASCII, in either case.
_WORDS = ("Oslo", "Osloville", "new-oslo", "oslo_2", "4Oslo", "Øoslo", "RIM", "Grimstad", "Northern Rim", "southernmost")
_MODES = ("{}", "Remote, {}", "{} (hybrid)", "On-site: {}")
LOCATIONS = (*(_MODES[(i * 3 + i // 4) % 4].format(w) for i, w in enumerate(_WORDS * 2)), None, "", "ONSITE")
SECTORS = ("fintech", "developer tools", "productivity", "security", None)
EMPLOYMENT = ("FullTime", "PartTime", "Contract", None)
WORKPLACE = ("remote", "hybrid", "onsite")


def _pick(values, idx: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(idx == i, lit) if expr is None else expr.when(idx == i, lit)
    return expr


def _fmt(x: Column) -> Column:
    return F.format_number(x, 0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text_table(spark: SparkSession, sf_dir: str, name: str, cols) -> DataFrame:
    """Scan for CPU-heavy per-row text work.  The driver's tables are single
    files of one row group, which one task would read and work through; the
    fixture deals their rows out first."""
    df = read_table(spark, sf_dir, name).select(*cols)
    return spread(df)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows evenly over the session's shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ats_name(ord_col: Column) -> Column:
    return _pick(ATS_NAMES, ord_col)


def v_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pre-normalised posting per document (flat, no JSON)."""
    d = read_text_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    doc = F.col("doc_id")
    slug_num = F.substring("source", 4, 1 << 20).cast("int")
    a = F.lit(50000) + doc * 10
    b = a + 25000
    phrase = (
        F.when(doc % 6 == 0, F.concat(F.lit(" Pay range: $"), _fmt(a), F.lit(" - $"), _fmt(b), F.lit(".")))
        .when(doc % 6 == 1, F.concat(F.lit(" Pay: $"), _fmt(a), F.lit("–$"), _fmt(b)))
        .when(doc % 6 == 2, F.concat(F.lit(" Pay: $"), (a / 1000).cast("bigint").cast("string"), F.lit("K - $"),
                                      (b / 1000).cast("bigint").cast("string"), F.lit("k")))
        .when(doc % 6 == 3, F.concat(F.lit(" Pay from $"), _fmt(a), F.lit(" upward.")))
        .when(doc % 6 == 4, F.concat(F.lit(" Pay: $"), _fmt(a), F.lit(".00 - $"), _fmt(b), F.lit(".00")))
        .otherwise(F.lit(""))
    )
    title = F.when(doc % 8 == 7, F.concat(F.lit("Charter pilot $"), _fmt(a), F.lit(" - $"), _fmt(b))).otherwise(
        _pick(TITLES, doc % 8)
    )
    iso = F.concat(
        F.date_sub(F.lit(AS_OF_DATE).cast("date"), (doc % 60 - 1).cast("int")).cast("string"),
        F.lit("T"),
        F.lpad((doc % 24).cast("string"), 2, "0"),
        F.lit(":00:00.000Z"),
    )
    posted = F.when(doc % 10 == 9, F.lit(None).cast("string")).when(doc % 20 == 8, F.lit("recently")).otherwise(iso)
    ats_ord = (slug_num % 3).cast("int")
    return d.select(
        doc.alias("doc_id"),
        F.col("source").alias("company_slug"),
        slug_num.alias("slug_num"),
        ats_ord.alias("ats_ord"),
        _ats_name(ats_ord).alias("ats"),
        (doc / PART_WIDTH).cast("int").alias("part"),
        title.alias("title"),
        _pick(DEPARTMENTS, doc % 5).alias("department"),
        _pick(LOCATIONS, doc % len(LOCATIONS)).alias("location"),
        F.concat(F.coalesce(F.col("text"), F.lit("")), phrase).alias("description"),
        posted.alias("posted_at_raw"),
        a.alias("amount_min"),
        b.alias("amount_max"),
    )


def v_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of the document sources: every 4th slug number is left out
    (those companies are only found by discovery); slug numbers divisible
    by 5 are listed a second time under the next platform."""
    src = read_table(spark, sf_dir, "documents").select("source").distinct()
    n = F.substring("source", 4, 1 << 20).cast("int")
    base = src.select(
        F.col("source").alias("slug"),
        n.alias("slug_num"),
        F.when(n % 7 == 6, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Company "), F.upper("source"))).alias("name"),
        _pick(SECTORS, n % 5).alias("sector"),
    ).where(F.col("slug_num") % 4 != 3)
    primary = base.withColumn("ats_ord", (F.col("slug_num") % 3).cast("int"))
    second = base.where(F.col("slug_num") % 5 == 0).withColumn("ats_ord", ((F.col("slug_num") % 3 + 1) % 3).cast("int"))
    return primary.unionByName(second).select(
        _ats_name(F.col("ats_ord")).alias("ats"), "ats_ord", F.col("slug_num").alias("ord"), "slug", "name", "sector"
    )


def board_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_postings assigned to boards: every company has a board on its own
    platform; slug numbers divisible by 5 also have one on the next platform."""
    p = v_postings(spark, sf_dir)
    extra = p.where(F.col("slug_num") % 5 == 0).withColumn("ats_ord", ((F.col("ats_ord") + 1) % 3).cast("int"))
    both = p.unionByName(extra)
    return both.withColumn("ats", _ats_name(F.col("ats_ord")))


def board_status(slug_num: Column, ats: Column, endpoint: Column) -> Column:
    k = slug_num % 20
    return (
        F.when((k == 4) & (ats == "lever"), F.lit(404))
        .when((k == 6) & (ats == "greenhouse"), F.lit(500))
        .when((k == 9) & (ats == "greenhouse"), F.lit(None).cast("int"))
        .when((k == 13) & (ats == "lever"), F.lit(429))
        .when((k == 11) & (endpoint == "rest"), F.lit(404))
        .when((k == 14) & (endpoint == "graphql"), F.lit(404))
        .otherwise(F.lit(200))
    )


def board_body_override(slug_num: Column, ats: Column, endpoint: Column, http_status: Column) -> Column:
    k = slug_num % 20
    return (
        F.when(http_status.isNull(), F.lit(None).cast("string"))
        .when(http_status != 200, F.lit("{}"))
        .when((k == 12) & (ats == "greenhouse"), F.lit('{"error":"x"}'))
        .when((k == 16) & (ats == "lever"), F.lit('{"error":"x"}'))
        .when((k == 18) & (ats == "greenhouse"), F.lit("{bad"))
        .when((k == 19) & (ats == "lever"), F.lit("[]"))
        .when((k == 14) & (endpoint == "rest"), F.lit("{bad"))
    )


def _html(desc: Column) -> Column:
    return F.concat(F.lit("<p>"), desc, F.lit("</p>"))


def _entity_escape(html: Column) -> Column:
    return F.replace(F.replace(F.replace(html, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _id12(prefix: str, doc: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(doc.cast("string"), 12, "0"))


def _company_name(slug: Column, slug_num: Column) -> Column:
    return F.when(slug_num % 7 == 6, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Company "), F.upper(slug)))


def _compensation(doc: Column, a: Column, b: Column) -> Column:
    k = doc % 5
    text = F.concat(F.lit('"$'), _fmt(a), F.lit(" - $"), _fmt(b), F.lit('"'))
    obj_eur = F.concat(F.lit('{"min":'), a.cast("string"), F.lit(',"max":'), b.cast("string"), F.lit(',"currency":"EUR"}'))
    obj = F.concat(F.lit('{"min":'), a.cast("string"), F.lit(',"max":'), b.cast("string"), F.lit("}"))
    return (
        F.when(k == 0, F.parse_json(text))
        .when(k == 1, F.parse_json(obj_eur))
        .when(k == 2, F.parse_json(obj))
        .when(k == 4, F.parse_json(F.lit('"Competitive"')))
    )


def _jobs_array(job: Column, when: Column | None = None) -> Column:
    """collect_list in doc_id order (array_sort on the key only, so the job
    struct itself need not be orderable); rows failing ``when`` are skipped."""
    item = F.struct(F.col("doc_id").alias("k"), job.alias("j"))
    arr = F.collect_list(item if when is None else F.when(when, item))
    return F.transform(
        F.array_sort(arr, lambda l, r: F.when(l["k"] < r["k"], -1).when(l["k"] > r["k"], 1).otherwise(0)),
        lambda x: x["j"],
    )


_KEYS = ["ats", "company_slug", "slug_num", "part"]


def _land(grouped: DataFrame, body: Column) -> DataFrame:
    ats, n, ep = F.col("ats"), F.col("slug_num"), F.col("endpoint")
    status = board_status(n, ats, ep)
    return grouped.withColumn("http_status", status).select(
        "ats",
        F.col("company_slug").alias("slug"),
        "endpoint",
        F.col("part").cast("int").alias("part"),
        F.col("http_status").cast("int").alias("http_status"),
        _landed_at(F.col("part")).alias("fetched_at"),
        F.coalesce(board_body_override(n, ats, ep, F.col("http_status")), body).alias("body"),
    )


FIXTURE_VERSION = "boards-v4"
#: Buckets of the landed fixture; its files are small.
FIXTURE_BUCKETS = 8


def _fixture_code():
    import os

    from ..functions import text as _text

    return (os.path.abspath(__file__), os.path.abspath(_text.__file__))


_FIXTURE_CODE = _fixture_code()


def landed_raw_boards(spark: SparkSession, sf_dir: str) -> BoardStore:
    """The derived boards landed once per session as a board store under the
    shared checkpoint folder (the production shape of ``raw_boards``)."""
    from .landing import landed_folder

    return open_store(spark, landed_folder(
        spark, "raw_boards", [sf_dir, FIXTURE_VERSION], lambda path: land_boards(v_raw_boards(spark, sf_dir), path, FIXTURE_BUCKETS),
        inputs=[f"{sf_dir.rstrip('/')}/documents.parquet"], code_files=_FIXTURE_CODE))


def exported_registry(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the derived registry, written by the registry export."""
    from .landing import landed_folder
    from .sinks import write_registry_export

    return landed_folder(spark, "registry", [sf_dir, FIXTURE_VERSION],
                         lambda path: write_registry_export(v_registry(spark, sf_dir), path),
                         inputs=[f"{sf_dir.rstrip('/')}/documents.parquet"], code_files=_FIXTURE_CODE)


def latest_raw_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest complete fetch of every landed board."""
    return latest_boards(landed_raw_boards(spark, sf_dir))


def landed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_postings`` landed once as parquet under the shared checkpoint
    folder; queries then scan it in parallel instead of re-deriving it."""
    from .landing import landed_table

    return landed_table(spark, "postings_view", [sf_dir, FIXTURE_VERSION],
                        lambda: v_postings(spark, sf_dir).withColumn("posted_at", js_timestamp("posted_at_raw")),
                        inputs=[f"{sf_dir.rstrip('/')}/documents.parquet"], code_files=_FIXTURE_CODE)


def v_raw_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed boards (``RAW_BOARDS_DDL``) built with to_json from board_postings,
    plus one HEAD-probe row per (slug, platform).  One body per
    (platform, slug, part); a part holds at most PART_WIDTH doc_ids."""
    p = board_postings(spark, sf_dir)
    doc = F.col("doc_id")
    slug = F.col("company_slug")
    a, b = F.col("amount_min"), F.col("amount_max")
    loc = F.col("location")
    html = _html(F.col("description"))
    name = _company_name(F.col("company_slug"), F.col("slug_num"))

    gh_job = F.struct(
        # some ids and locations have a type the platform does not announce
        F.when(doc % 37 == 5, F.parse_json(F.concat(F.lit('"g'), doc.cast("string"), F.lit('"'))))
        .otherwise(F.parse_json(doc.cast("string"))).alias("id"),
        (doc + 1000000).alias("internal_job_id"),
        F.col("title").alias("title"),
        F.col("posted_at_raw").alias("updated_at"),
        F.concat(F.lit("https://boards.example.com/"), slug, F.lit("/jobs/"), doc.cast("string")).alias("absolute_url"),
        F.when(doc % 41 == 7, F.parse_json(F.lit('"Anywhere"')))
        .when(loc.isNotNull(), F.parse_json(F.to_json(F.struct(loc.alias("name"))))).alias("location"),
        F.when(F.col("department").isNotNull(), F.array(F.struct(F.col("department").alias("name"))))
        .otherwise(F.array().cast("array<struct<name:string>>")).alias("departments"),
        F.when(loc.isNotNull(), F.array(F.struct(loc.alias("name"))))
        .otherwise(F.array().cast("array<struct<name:string>>")).alias("offices"),
        _entity_escape(html).alias("content"),
    )
    created = F.unix_millis(F.col("posted_at_raw").try_cast("timestamp"))
    lv_job = F.struct(
        _id12("lv-", doc).alias("id"),
        F.col("title").alias("text"),
        F.concat(F.lit("https://jobs.example.com/"), slug, F.lit("/"), _id12("lv-", doc)).alias("hostedUrl"),
        F.when(doc % 47 == 11, F.parse_json(F.lit('"soon"')))
        .when(F.col("posted_at_raw").isNotNull(), F.parse_json(F.coalesce(created, F.lit(0).cast("bigint")).cast("string")))
        .alias("createdAt"),
        F.when(doc % 2 == 0, F.col("description")).alias("descriptionPlain"),
        html.alias("description"),
        F.when(
            doc % 11 != 10,
            F.struct(
                F.col("department").alias("department"),
                F.concat(F.lit("Team "), (doc % 3).cast("string")).alias("team"),
                loc.alias("location"),
                F.lit("Full-time").alias("commitment"),
            ),
        ).alias("categories"),
        _pick(WORKPLACE, doc % 3).alias("workplaceType"),
    )
    ab_rest_job = F.struct(
        _id12("ab-", doc).alias("id"),
        F.col("title").alias("title"),
        F.col("department").alias("departmentName"),
        loc.alias("location"),
        F.when(doc % 4 != 3, html).alias("descriptionHtml"),
        F.col("description").alias("descriptionPlain"),
        F.col("posted_at_raw").alias("publishedAt"),
        _pick(EMPLOYMENT, doc % 4).alias("employmentType"),
        F.when(doc % 43 == 9, F.parse_json(F.lit('"yes"')))
        .when(doc % 3 != 2, F.parse_json(F.coalesce(loc, F.lit("")).startswith("Remote").cast("string"))).alias("isRemote"),
        F.concat(F.lit("Team "), (doc % 3).cast("string")).alias("teamName"),
        _compensation(doc, a, b).alias("compensation"),
    )
    ab_gql_job = F.struct(
        _id12("ab-", doc).alias("id"),
        F.col("title").alias("title"),
        loc.alias("locationName"),
        _pick(EMPLOYMENT, doc % 4).alias("employmentType"),
        html.alias("descriptionHtml"),
        F.col("posted_at_raw").alias("publishedDate"),
        F.when(doc % 2 == 0, F.concat(F.lit("USD "), _fmt(a), F.lit(" – "), _fmt(b))).alias("compensationTierSummary"),
    )

    # one aggregation for all platforms: a (platform, slug, part) group is
    # bounded by PART_WIDTH doc_ids
    ats = F.col("ats")
    grouped = p.groupBy(*_KEYS).agg(
        _jobs_array(gh_job, ats == "greenhouse").alias("gh"),
        _jobs_array(lv_job, ats == "lever").alias("lv"),
        _jobs_array(ab_rest_job, ats == "ashby").alias("ar"),
        _jobs_array(ab_gql_job, ats == "ashby").alias("ag"),
    )
    endpoints = F.when(ats == "ashby", F.array(F.lit("rest"), F.lit("graphql"))).otherwise(F.array(F.lit("board")))
    rows = grouped.select(*_KEYS, F.explode(endpoints).alias("endpoint"), "gh", "lv", "ar", "ag")
    ep = F.col("endpoint")
    empty_rest = F.col("slug_num") % 9 == 8
    body = (
        F.when(ats == "greenhouse", F.to_json(F.struct(name.alias("name"), F.col("gh").alias("jobs"))))
        .when(ats == "lever", F.to_json(F.col("lv")))
        .when(ep == "rest", F.to_json(F.struct(
            name.alias("organizationName"),
            F.when(empty_rest, F.slice(F.col("ar"), 1, 0)).otherwise(F.col("ar")).alias("jobs"),
        )))
        .otherwise(F.to_json(F.struct(F.struct(F.struct(
            name.alias("title"), F.col("ag").alias("jobPostings")).alias("jobBoard")).alias("data"))))
    )
    current = _land(rows, body).unionByName(v_broken_parts(spark, sf_dir))
    sizes = current.groupBy("ats", "slug", "endpoint").agg(F.count("*").cast("int").alias("n_parts"))
    current = current.join(sizes, ["ats", "slug", "endpoint"]).select(*current.columns, F.lit("f2").alias("fetch_id"), "n_parts")
    return current.unionByName(_stale(sizes)).unionByName(v_probes(spark, sf_dir))


#: Texts behind a whole board that make it a broken one.
TRAILERS = (" " * 10 + "junk", " " * 64 + "junk", " " * 500 + "junk", " }}}", "]", ",{}")
BROKEN_PART = 900_001


def _stale(boards: DataFrame) -> DataFrame:
    """Two further fetches of every board: an older one, of its first part and one that is
    gone, and a newer one that has landed in part only."""
    body = F.when(F.col("ats") == "lever", F.lit('[{"id":"old","text":"Stale"}]')).otherwise(
        F.lit('{"name":"Old","jobs":[{"id":"1","title":"Stale"}],"data":{"jobBoard":{"jobPostings":[{"id":"1","title":"Stale"}]}}}'))
    fetch = lambda name, days, n, *parts: [F.struct(
        F.lit(name).alias("fetch_id"), F.lit(days).alias("days"), F.lit(n).alias("n_parts"), F.lit(part).alias("part")) for part in parts]
    rows = boards.select("ats", "slug", "endpoint", F.explode(F.array(*fetch("f1", -1, 2, 0, 700_000), *fetch("f3", 1, 3, 0, 1))).alias("f"))
    when = F.timestamp_add("DAY", F.col("f.days"), F.lit(AS_OF).try_cast("timestamp"))
    return rows.select(
        "ats", "slug", "endpoint", "f.part", F.lit(200).alias("http_status"), when.alias("fetched_at"), body.alias("body"), "f.fetch_id", "f.n_parts")


def _landed_at(part: Column) -> Column:
    """The parts of the current fetch arrive one after the other."""
    return F.timestamp_add("SECOND", part % 3, F.lit(AS_OF).try_cast("timestamp"))


def v_broken_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of every company's own board whose body is whole, with more text
    behind it."""
    src = read_table(spark, sf_dir, "documents").select(F.col("source").alias("slug")).distinct()
    n = F.substring("slug", 4, 1 << 20).cast("int")
    rows = src.select("slug", _ats_name((n % 3).cast("int")).alias("ats"), F.posexplode(F.array(*map(F.lit, TRAILERS))).alias("i", "tail"))
    whole = F.when(F.col("ats") == "lever", F.lit('[{"id":"1"}]')).otherwise(F.lit('{"jobs":[{"id":"1"}]}'))
    return rows.select(
        "ats", "slug", F.when(F.col("ats") == "ashby", "rest").otherwise("board").alias("endpoint"),
        (F.col("i") + BROKEN_PART).cast("int").alias("part"), F.lit(200).alias("http_status"),
        _landed_at(F.col("i") + BROKEN_PART).alias("fetched_at"), F.concat(whole, F.col("tail")).alias("body"),
    )


def v_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HEAD probe per (slug, platform): the board's status where a board
    exists, 404 elsewhere."""
    src = read_table(spark, sf_dir, "documents").select("source").distinct()
    n = F.substring("source", 4, 1 << 20).cast("int")
    plats = F.array(*[F.lit(x) for x in ATS_NAMES])
    rows = src.select(F.col("source").alias("slug"), n.alias("slug_num"), F.explode(plats).alias("ats"))
    own = F.col("ats") == _ats_name((F.col("slug_num") % 3).cast("int"))
    extra = (F.col("slug_num") % 5 == 0) & (F.col("ats") == _ats_name(((F.col("slug_num") % 3 + 1) % 3).cast("int")))
    endpoint = F.when(F.col("ats") == "ashby", F.lit("rest")).otherwise(F.lit("board"))
    status = F.when(own | extra, board_status(F.col("slug_num"), F.col("ats"), endpoint)).otherwise(F.lit(404))
    return rows.select(
        "ats",
        "slug",
        F.lit("probe").alias("endpoint"),
        F.lit(0).alias("part"),
        status.cast("int").alias("http_status"),
        F.lit(AS_OF).try_cast("timestamp").alias("fetched_at"),
        F.lit(None).cast("string").alias("body"), F.lit("f2").alias("fetch_id"), F.lit(1).alias("n_parts"),
    )


def v_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch requests: every document source under a display name
    ('Src-7 ' style, normalising back to the slug), with an explicit
    platform for slug numbers divisible by 6, plus every supplier name (no
    board anywhere)."""
    src = read_table(spark, sf_dir, "documents").select("source").distinct()
    n = F.substring("source", 4, 1 << 20).cast("int")
    known = src.select(
        n.cast("bigint").alias("request_id"),
        F.concat(F.upper(F.substring("source", 1, 1)), F.substring("source", 2, 2), F.lit("-"), F.substring("source", 4, 1 << 20), F.lit(" ")).alias("company"),
        F.when(n % 6 == 0, F.lit("lever")).alias("ats"),
    )
    sup = read_table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000).cast("bigint").alias("request_id"),
        F.col("s_name").alias("company"),
        F.lit(None).cast("string").alias("ats"),
    )
    return known.unionByName(sup)


# ---------------------------------------------------------------- scans over time
#: Which of the scans 0 to 3, one a day, list a posting, by doc_id modulo their number:
#: always, reopened, closed, new, closed twice.
LISTED = ((0, 1, 2, 3), (0, 2, 3), (0, 1), (2, 3), (0, 2))


def v_history_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four daily scans of every company's own board, the last at AS_OF, with small bodies (a
    posting is its title).  Some boards have a failed scan between the first two, all have one
    that has landed in part only before the last.  Of some Ashby boards the postings are in
    the GraphQL answer, of the others that holds postings that no call reads."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("slug"))
    n = F.substring("slug", 4, 1 << 20).cast("int")
    doc, scan = F.col("doc_id"), F.col("scan")
    listed = F.array_contains(F.element_at(F.array(*(F.array(*map(F.lit, x)) for x in LISTED)), (doc % len(LISTED) + 1).cast("int")), scan)
    rows = d.withColumn("slug_num", n).withColumn("scan", F.explode(F.array(*map(F.lit, range(4)))))
    title = F.concat(F.lit("Posting "), doc.cast("string"))
    parts = rows.groupBy("slug", "slug_num", "scan", (doc / PART_WIDTH).cast("int").alias("part")).agg(
        F.collect_list(F.when(listed, title)).alias("titles"))  # at most PART_WIDTH
    sizes = d.groupBy("slug").agg(F.count_distinct((doc / PART_WIDTH).cast("int")).cast("int").alias("n_parts"))
    parts = parts.join(sizes, "slug")
    ats = _ats_name((F.col("slug_num") % 3).cast("int"))
    ats_rows = parts.withColumn("ats", ats).withColumn(
        "endpoint", F.explode(F.when(ats == "ashby", F.array(F.lit("rest"), F.lit("graphql"))).otherwise(F.array(F.lit("board")))))
    ep, fallback = F.col("endpoint"), F.col("slug_num") % 9 == 8
    own = F.when(((ep == "rest") & fallback), F.array().cast("array<string>")).when((ep == "graphql") & ~fallback, F.transform("titles", lambda t: F.concat(F.lit("Unread "), t))).otherwise(F.col("titles"))
    job = lambda key: F.transform(own, lambda t: F.struct(t.alias(key)))
    body = (
        F.when(F.col("ats") == "lever", F.to_json(job("text")))
        .when(ep == "graphql", F.to_json(F.struct(F.struct(F.struct(job("title").alias("jobPostings")).alias("jobBoard")).alias("data"))))
        .otherwise(F.to_json(F.struct(job("title").alias("jobs"))))
    )
    at = lambda days: F.timestamp_add("DAY", days, F.lit(AS_OF).try_cast("timestamp"))
    day = scan - 3
    good = ats_rows.select(
        "ats", "slug", "endpoint", "part", F.lit(200).alias("http_status"), F.timestamp_add("SECOND", F.col("part") % 2 - 1, at(day)).alias("fetched_at"),
        body.alias("body"), F.concat(F.lit("scan "), scan.cast("string")).alias("fetch_id"), "n_parts")
    boards = ats_rows.select("ats", "slug", "slug_num", "endpoint", "n_parts").distinct()
    noon = F.expr("INTERVAL 12 HOURS")
    failed = boards.where(F.col("slug_num") % 4 == 1).select(
        "ats", "slug", "endpoint", F.lit(0).alias("part"), F.lit(None).cast("int").alias("http_status"), (at(F.lit(-3)) + noon).alias("fetched_at"),
        F.lit(None).cast("string").alias("body"), F.lit("failed").alias("fetch_id"), F.lit(1).alias("n_parts"))
    half = boards.select(
        "ats", "slug", "endpoint", F.lit(0).alias("part"), F.lit(200).alias("http_status"), (at(F.lit(-1)) + noon).alias("fetched_at"),
        F.lit("{}").alias("body"), F.lit("half").alias("fetch_id"), (F.col("n_parts") + 1).alias("n_parts"))
    return good.unionByName(failed).unionByName(half)


def landed_history(spark: SparkSession, sf_dir: str) -> BoardStore:
    """``v_history_boards`` landed once as a board store."""
    from .landing import landed_folder

    return open_store(spark, landed_folder(
        spark, "history", [sf_dir, FIXTURE_VERSION], lambda path: land_boards(v_history_boards(spark, sf_dir), path, FIXTURE_BUCKETS),
        inputs=[f"{sf_dir.rstrip('/')}/documents.parquet"], code_files=_FIXTURE_CODE))
