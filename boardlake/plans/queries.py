"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables; each SQL string computes the same rows in DuckDB.  Column
names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.dates import js_timestamp
from ..operators import filters as FL
from ..operators import registry_ops as RG
from ..operators import routing as RT
from ..operators import summary as SM
from ..operators.batch import match_filters, search_many
from ..operators.normalize import normalize
from ..sources import adapters as AD
from ..sources import derived as D
from ..sources.boards import latest_boards
from ..sources.quarantine import quarantine
from . import api
from . import oracle as O

# Fixed query parameters (the same literals appear in the SQL).
TITLE_PATTERN = "yard keeper|équipage|^tide"
TOPIC_PATTERN = "payments|growth|pay range"
RECENCY_DAYS = 7
LOC_INCLUDE = ["Oslo", "northern", "remote"]
LOC_EXCLUDE = ["Rim", "Grimstad", "southern", "  "]
ALL_TITLE = "keeper|surveyor|clerk|équip"
ALL_TOPIC = "pay|growth"
ALL_DAYS = 30
ALL_INCLUDE = ["oslo", "remote", "rim", "osloville"]
ALL_EXCLUDE = ["4oslo", "south"]
ALL_LIMIT = 5
PER_COMPANY_LIMIT = 7
FIRST_N = 100
FETCH_TITLE = "keeper|surveyor|clerk"
FETCH_DAYS = 30
FETCH_EXCLUDE = ["rim"]
SWEEP_SECTOR = "fintech"
SWEEP_TOPIC = "keeper|product|pay"
SWEEP_LIMIT = 5
REGISTRY_QUERY = "Company SRC1"
TOOL_QUERY = "company"
TOOL_SECTOR = "tools"

V_ORDER = ("ats_ord", "part", "doc_id")

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def _salary_cols(c: str = "salary"):
    return [
        F.col(f"{c}.min").alias("salary_min"),
        F.col(f"{c}.max").alias("salary_max"),
        F.col(f"{c}.currency").alias("salary_currency"),
    ]


def _pages(spark, sf_dir):
    return D.read_text_table(spark, sf_dir, "pages", ["page_id", "html"])


# ---------------------------------------------------------------- P9: HTML
@query("strip_html_pages", f"SELECT page_id, {O.strip_html('html')} AS text FROM pages")
def strip_html_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.strip_html("html").alias("text"))


_ESC_SQL = "'<div>&nbsp;' || replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '&#160;&#39;</div>'"


@query("strip_html_twice", f"SELECT page_id, {O.strip_html(O.strip_html(_ESC_SQL))} AS text FROM pages")
def strip_html_twice(spark, sf_dir):
    esc = F.concat(
        F.lit("<div>&nbsp;"),
        F.replace(F.replace(F.replace(F.col("html"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")),
        F.lit("&#160;&#39;</div>"),
    )
    return _pages(spark, sf_dir).select("page_id", T.strip_html(T.strip_html(esc)).alias("text"))


# ---------------------------------------------------------------- P2, P3, P4-P8
_VP = O.with_(O.V_POSTINGS)


@query(
    "job_id",
    _VP + f"SELECT doc_id, {O.job_id(f'coalesce({O.company_name("company_slug", "slug_num")}, company_slug)', 'title', 'ats')} AS id FROM v_postings",
)
def job_id(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    company = D._company_name(F.col("company_slug"), F.col("slug_num"))
    return p.select("doc_id", T.job_id(T.id_company(company, F.col("company_slug")), F.col("title"), F.col("ats")).alias("id"))


@query("location_type", _VP + f"SELECT doc_id, location, {O.location_type('location')} AS location_type FROM v_postings")
def location_type(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.select("doc_id", "location", T.location_type("location").alias("location_type"))


@query("salary_full", _VP + f"SELECT doc_id, {O.full_only_cols('description')} FROM v_postings")
def salary_full(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.select("doc_id", T.salary_from_full_range("description").alias("s")).select("doc_id", *_salary_cols("s"))


@query("salary_k", _VP + f"SELECT doc_id, {O.k_only_cols('description')} FROM v_postings")
def salary_k(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.select("doc_id", T.salary_from_k_range("description").alias("s")).select("doc_id", *_salary_cols("s"))


@query("salary_text", _VP + f"SELECT doc_id, {O.salary_text_cols('description')} FROM v_postings")
def salary_text(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.select("doc_id", T.salary_from_text("description").alias("s")).select("doc_id", *_salary_cols("s"))


@query("lever_title_salary", _VP + f"SELECT doc_id, {O.full_only_cols('title')} FROM v_postings")
def lever_title_salary(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.select("doc_id", T.lever_title_salary("title").alias("s")).select("doc_id", *_salary_cols("s"))


_PREC_SQL = _VP + f"""
SELECT doc_id,
  CASE WHEN regexp_matches(coalesce(title, ''), {O.q(O.FULL)}) THEN t.salary_min ELSE d.salary_min END AS salary_min,
  CASE WHEN regexp_matches(coalesce(title, ''), {O.q(O.FULL)}) THEN t.salary_max ELSE d.salary_max END AS salary_max,
  CASE WHEN regexp_matches(coalesce(title, ''), {O.q(O.FULL)}) THEN t.salary_currency ELSE d.salary_currency END AS salary_currency
FROM v_postings,
  LATERAL (SELECT {O.full_only_cols('v_postings.title')}) t,
  LATERAL (SELECT {O.salary_text_cols('v_postings.description')}) d"""


@query("salary_precedence", _PREC_SQL)
def salary_precedence(spark, sf_dir):
    """Structured salary (here: from the title) wins over the description text."""
    p = D.landed_postings(spark, sf_dir)
    s = F.coalesce(T.lever_title_salary("title"), T.salary_from_text("description"))
    return p.select("doc_id", s.alias("s")).select("doc_id", *_salary_cols("s"))


_COMP_SQL = _VP + """
SELECT doc_id,
  CASE doc_id % 5 WHEN 0 THEN CAST(amount_min AS DOUBLE) WHEN 1 THEN CAST(amount_min AS DOUBLE) WHEN 2 THEN CAST(amount_min AS DOUBLE) END AS salary_min,
  CASE doc_id % 5 WHEN 0 THEN CAST(amount_max AS DOUBLE) WHEN 1 THEN CAST(amount_max AS DOUBLE) WHEN 2 THEN CAST(amount_max AS DOUBLE) END AS salary_max,
  CASE doc_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' END AS salary_currency
FROM v_postings"""


@query("ashby_compensation", _COMP_SQL)
def ashby_compensation(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    comp = D._compensation(F.col("doc_id"), F.col("amount_min"), F.col("amount_max"))
    return p.select("doc_id", T.ashby_compensation(comp).alias("s")).select("doc_id", *_salary_cols("s"))


# ---------------------------------------------------------------- S3-S7, J3, U1, P1
_BOARDS = O.with_(*O.BASE)

_FLAT = ("ats", "company_slug", "board_part", "posting_pos", "id", "company", "title", "department", "location",
         "location_type", "salary_min", "salary_max", "salary_currency", "description", "url", "posted_at_raw")


def _flat(df: DataFrame, *meta) -> DataFrame:
    cols = [F.col(c) for c in _FLAT if c not in ("salary_min", "salary_max", "salary_currency")]
    return df.select(*cols, *_salary_cols("salary"), *meta)


def _norm(df: DataFrame) -> DataFrame:
    return normalize(df, seen_at=D.AS_OF)


def _sql_cols(extra: str = "") -> str:
    return ", ".join(_FLAT) + extra


@query("greenhouse_board", _BOARDS + f"SELECT {_sql_cols(', greenhouse_id, internal_job_id, departments, offices')} FROM ({O.gh_expected()}) x")
def greenhouse_board(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(
        _norm(AD.greenhouse_postings(rb)),
        F.col("metadata.greenhouseId").alias("greenhouse_id"),
        F.col("metadata.internal_job_id").alias("internal_job_id"),
        F.array_join("metadata.departments", ",").alias("departments"),
        F.array_join("metadata.offices", ",").alias("offices"),
    )


@query("lever_board", _BOARDS + f"SELECT {_sql_cols(', lever_id, team, commitment, workplace_type')} FROM ({O.lv_expected()}) x")
def lever_board(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(
        _norm(AD.lever_postings(rb)),
        F.col("metadata.leverId").alias("lever_id"),
        F.col("metadata.team").alias("team"),
        F.col("metadata.commitment").alias("commitment"),
        F.col("metadata.workplaceType").alias("workplace_type"),
    )


_ASHBY_META_SQL = ", ashby_id, employment_type, is_remote, team, compensation_summary"


def _ashby_meta():
    return (
        F.col("metadata.ashbyId").alias("ashby_id"),
        F.col("metadata.employmentType").alias("employment_type"),
        F.col("metadata.isRemote").alias("is_remote"),
        F.coalesce(F.col("metadata.team"), F.lit("")).alias("team"),
        F.coalesce(F.col("metadata.compensationSummary"), F.lit("")).alias("compensation_summary"),
    )


@query("ashby_rest_board", _BOARDS + f"SELECT {_sql_cols(_ASHBY_META_SQL)} FROM ({O.ar_expected()}) x")
def ashby_rest_board(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(_norm(AD.ashby_rest_postings(AD.parse_ashby_rest(rb))), *_ashby_meta())


@query("ashby_graphql_board", _BOARDS + f"SELECT {_sql_cols(_ASHBY_META_SQL)} FROM ({O.ag_expected()}) x")
def ashby_graphql_board(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(_norm(AD.ashby_graphql_postings(AD.parse_ashby_graphql(rb))), *_ashby_meta())


@query(
    "ashby_fallback",
    _BOARDS + f"SELECT {_sql_cols(_ASHBY_META_SQL)} FROM ({O.ar_expected()}) r "
    f"UNION ALL SELECT {_sql_cols(_ASHBY_META_SQL)} FROM ({O.ag_expected(O.AG_FALLBACK)}) g",
)
def ashby_fallback(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(_norm(AD.ashby_postings(rb)), *_ashby_meta())


_OUTCOME_SQL = _BOARDS + f"""
, boards AS (
  SELECT DISTINCT b_ats AS ats, company_slug AS slug, slug_num, k, part, e.endpoint
  FROM bp, (SELECT unnest(['board', 'rest', 'graphql']) AS endpoint) e
  WHERE (b_ats = 'ashby') = (e.endpoint <> 'board')
), counted AS (
  SELECT b_ats AS ats, company_slug AS slug, part, count(*) AS n FROM bp GROUP BY 1, 2, 3
)
SELECT b.ats, b.slug, b.endpoint, b.part, st.http_status,
  CASE WHEN st.http_status IS NULL THEN 'error'
       WHEN st.http_status = 200 AND NOT (
            (b.ats = 'greenhouse' AND b.k = 18) OR (b.endpoint = 'rest' AND b.k = 14)) THEN 'ok'
       WHEN st.http_status = 200 THEN 'error'
       WHEN st.http_status = 404 THEN 'not_found'
       WHEN b.endpoint = 'graphql' THEN 'not_found'
       ELSE 'error' END AS outcome,
  CAST(CASE WHEN st.http_status = 200 AND NOT (
            (b.ats = 'greenhouse' AND b.k IN (12, 18)) OR (b.ats = 'lever' AND b.k IN (16, 19))
            OR (b.endpoint = 'rest' AND (b.k = 14 OR b.slug_num % 9 = 8))) THEN c.n ELSE 0 END AS INTEGER) AS n_jobs
FROM boards b
JOIN counted c ON c.ats = b.ats AND c.slug = b.slug AND c.part = b.part,
LATERAL (SELECT {O.board_status('b.slug_num', 'b.ats', 'b.endpoint')} AS http_status) st
UNION ALL
SELECT {O.ats_name('slug_num % 3')} AS ats, slug, CASE WHEN slug_num % 3 = 2 THEN 'rest' ELSE 'board' END AS endpoint,
  CAST({D.BROKEN_PART} + i AS INTEGER) AS part, 200 AS http_status, 'error' AS outcome, CAST(0 AS INTEGER) AS n_jobs
FROM v_sources, range({len(D.TRAILERS)}) AS t(i)"""


@query("board_outcomes", _OUTCOME_SQL)
def board_outcomes(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return AD.board_outcomes(rb)


@query("board_latest", f"SELECT ats, slug, endpoint, part, TIMESTAMP '{D.AS_OF_DATE} 00:00:00' + to_seconds(part % 3) AS fetched_at FROM ({_OUTCOME_SQL}) o")
def board_latest(spark, sf_dir):
    """The newest complete fetch of every landed board, whose parts came at different times:
    nothing older, and nothing of a newer fetch that has landed in part only."""
    rows = D.latest_raw_boards(spark, sf_dir).where(F.col("endpoint") != "probe")
    return rows.select("ats", "slug", "endpoint", "part", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))


_QUARANTINE_SQL = _BOARDS + " UNION ALL ".join(
    f"SELECT b_ats AS ats, company_slug AS slug, '{ep}' AS endpoint, part, posting_pos AS position, '{path}' AS path, '{kind}' AS expected, "
    f"CAST({raw} AS VARCHAR) AS raw FROM bp WHERE {ok} AND {rule}"
    for ep, path, kind, raw, ok, rule in (
        ("board", "id", "integer", "'\"g' || doc_id || '\"'", O.GH_OK, "doc_id % 37 = 5"),
        ("board", "location", "object", "'\"Anywhere\"'", O.GH_OK, "doc_id % 41 = 7"),
        ("board", "createdAt", "integer", "'\"soon\"'", O.LV_OK, "doc_id % 47 = 11"),
        ("rest", "isRemote", "boolean", "'\"yes\"'", O.AR_OK, "doc_id % 43 = 9"),
    ))


@query("field_quarantine", _QUARANTINE_SQL)
def field_quarantine(spark, sf_dir):
    """Every field of a landed posting whose type is not the platform's."""
    return quarantine(D.latest_raw_boards(spark, sf_dir))


@query("normalize_all", O.with_(*O.BASE, O.expected_postings_cte()) + "SELECT " + ", ".join(
    ["ats", "company_slug", "board_part", "posting_pos", "id", "company", "title", "department", "location",
     "location_type", "salary_min", "salary_max", "salary_currency", "description", "url", "posted_at_raw"]) + " FROM ep")
def normalize_all(spark, sf_dir):
    rb = D.latest_raw_boards(spark, sf_dir)
    return _flat(_norm(AD.all_postings(rb)))


# ---------------------------------------------------------------- S11 JSON records
def _json_sql(expected_sql: str, meta: str) -> str:
    rec = (
        "to_json({'id': id, 'company': company, 'companySlug': company_slug, 'ats': ats, 'title': title, "
        "'department': department, 'location': location, 'locationType': location_type, "
        "'salary': CASE WHEN salary_currency IS NULL THEN NULL ELSE "
        "{'min': salary_min, 'max': salary_max, 'currency': salary_currency} END, "
        "'description': description, 'url': url, 'postedAt': posted_at_raw, "
        f"'firstSeen': '{_SEEN_ISO}', 'lastSeen': '{_SEEN_ISO}', 'status': 'open', 'metadata': {meta}}})"
    )
    return f"SELECT ats, company_slug, board_part, posting_pos, {rec} AS json FROM ({expected_sql}) x"


_SEEN_ISO = "2024-01-31T00:00:00.000Z"
# metadata keys in the order a VARIANT object renders them (sorted)
_GH_META = ("{'departments': CASE WHEN raw_department IS NULL THEN []::VARCHAR[] ELSE [raw_department] END, "
            "'greenhouseId': greenhouse_id, 'internal_job_id': internal_job_id, "
            "'offices': CASE WHEN raw_location IS NULL THEN []::VARCHAR[] ELSE [raw_location] END}")
_LV_META = "{'commitment': commitment, 'leverId': lever_id, 'team': team, 'workplaceType': workplace_type}"
_AR_META = "{'ashbyId': ashby_id, 'employmentType': employment_type, 'isRemote': is_remote, 'team': team}"
_AG_META = "{'ashbyId': ashby_id, 'compensationSummary': compensation_summary, 'employmentType': employment_type}"

_JSON_SQL = _BOARDS + " UNION ALL ".join([
    _json_sql(O.gh_expected(raw_cols=True), _GH_META),
    _json_sql(O.lv_expected(), _LV_META),
    _json_sql(O.ar_expected(), _AR_META),
    _json_sql(O.ag_expected(O.AG_FALLBACK), _AG_META),
])


@query("posting_json", _JSON_SQL)
def posting_json(spark, sf_dir):
    """Full normalised records as JSON text (the JSON sink's rows)."""
    from ..sources.sinks import posting_record

    rb = D.latest_raw_boards(spark, sf_dir)
    return posting_record(_norm(AD.all_postings(rb)), keep=("ats", "company_slug", "board_part", "posting_pos"))


# ---------------------------------------------------------------- F1-F7, L1, W1
@query("filter_title", _VP + f"SELECT doc_id, title FROM v_postings WHERE {O.rx('title', TITLE_PATTERN)}")
def filter_title(spark, sf_dir):
    return FL.title_filter(D.landed_postings(spark, sf_dir), TITLE_PATTERN).select("doc_id", "title")


@query(
    "filter_topic",
    _VP + f"SELECT doc_id FROM v_postings WHERE {O.rx('title', TOPIC_PATTERN)} OR {O.rx('department', TOPIC_PATTERN)} "
    f"OR {O.rx('description', TOPIC_PATTERN)}",
)
def filter_topic(spark, sf_dir):
    return FL.topic_filter(D.landed_postings(spark, sf_dir), TOPIC_PATTERN).select("doc_id")


@query("filter_recency", _VP + f"SELECT doc_id, posted_at_raw FROM v_postings WHERE {O.recency(RECENCY_DAYS)}")
def filter_recency(spark, sf_dir):
    return FL.recency_filter(D.landed_postings(spark, sf_dir), RECENCY_DAYS, as_of=D.AS_OF).select("doc_id", "posted_at_raw")


@query("filter_loc_include", _VP + f"SELECT doc_id, location FROM v_postings WHERE {O.loc_any(LOC_INCLUDE)}")
def filter_loc_include(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.where(FL.location_include_predicate(LOC_INCLUDE)).select("doc_id", "location")


@query("filter_loc_exclude", _VP + f"SELECT doc_id, location FROM v_postings WHERE NOT {O.loc_any(LOC_EXCLUDE)}")
def filter_loc_exclude(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return p.where(FL.location_exclude_predicate(LOC_EXCLUDE)).select("doc_id", "location")


_ALL_WHERE = (
    f"{O.rx('title', ALL_TITLE)} AND ({O.rx('title', ALL_TOPIC)} OR {O.rx('department', ALL_TOPIC)} OR "
    f"{O.rx('description', ALL_TOPIC)}) AND {O.recency(ALL_DAYS)} AND {O.loc_any(ALL_INCLUDE)} AND NOT {O.loc_any(ALL_EXCLUDE)}"
)


@query(
    "filter_all",
    _VP + f"SELECT company_slug, doc_id, title, location FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY company_slug ORDER BY ats_ord, part, doc_id) AS rn FROM v_postings WHERE {_ALL_WHERE}) z "
    f"WHERE rn <= {ALL_LIMIT}",
)
def filter_all(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    out = FL.apply_filters(
        p, ALL_TITLE, ALL_TOPIC, ALL_DAYS, ALL_INCLUDE, ALL_EXCLUDE, ALL_LIMIT,
        as_of=D.AS_OF, partition_by=["company_slug"], order_cols=V_ORDER,
    )
    return out.select("company_slug", "doc_id", "title", "location")


@query(
    "first_n",
    _VP + f"SELECT company_slug, doc_id, title FROM v_postings ORDER BY ats_ord, company_slug, part, doc_id LIMIT {FIRST_N}",
)
def first_n(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    return FL.first_n(p, FIRST_N, ("ats_ord", "company_slug", "part", "doc_id")).select("company_slug", "doc_id", "title")


@query(
    "first_n_per_company",
    _VP + f"SELECT company_slug, doc_id, location FROM (SELECT *, row_number() OVER (PARTITION BY company_slug "
    f"ORDER BY ats_ord, part, doc_id) AS rn FROM v_postings WHERE NOT {O.loc_any(['UK'])}) z WHERE rn <= {PER_COMPANY_LIMIT}",
)
def first_n_per_company(spark, sf_dir):
    p = D.landed_postings(spark, sf_dir)
    out = FL.apply_filters(p, location_excludes=["UK"], limit=PER_COMPANY_LIMIT, partition_by=["company_slug"], order_cols=V_ORDER)
    return out.select("company_slug", "doc_id", "location")


# ---------------------------------------------------------------- P10, P11
@query(
    "slug_normalize",
    f"SELECT 'supplier' AS kind, s_suppkey AS key, s_name AS company, {O.slugify('s_name')} AS slug, "
    f"upper(substr({O.slugify('s_name')}, 1, 1)) || substr({O.slugify('s_name')}, 2) AS display FROM supplier "
    f"UNION ALL SELECT 'customer', c_custkey, c_name, {O.slugify('c_name')}, "
    f"upper(substr({O.slugify('c_name')}, 1, 1)) || substr({O.slugify('c_name')}, 2) FROM customer",
)
def slug_normalize(spark, sf_dir):
    s = D.read_table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("company"))
    c = D.read_table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("company"))
    both = s.unionByName(c).withColumn("slug", T.slugify("company"))
    return both.withColumn("display", T.title_case_slug("slug"))


# ---------------------------------------------------------------- F8, F9, J1, A3
_REG = O.with_(O.V_SOURCES, O.V_REGISTRY)
_F8 = (f"(contains(lower(coalesce(nullif(name, ''), slug, '')), {O.q(REGISTRY_QUERY.lower())}) "
       f"OR contains(lower(coalesce(sector, '')), {O.q(REGISTRY_QUERY.lower())}))")
_F9 = (f"(contains(lower(coalesce(nullif(name, ''), slug, '')), {O.q(TOOL_QUERY)}) OR contains(lower(coalesce(sector, '')), {O.q(TOOL_QUERY)})) "
       f"AND contains(lower(coalesce(sector, '')), {O.q(TOOL_SECTOR)})")


@query("registry_search", _REG + f"SELECT ats, slug, name, sector FROM v_registry WHERE {_F8}")
def registry_search(spark, sf_dir):
    return RG.search_registry(D.v_registry(spark, sf_dir), REGISTRY_QUERY).select("ats", "slug", "name", "sector")


@query("registry_search_sector", _REG + f"SELECT ats, slug, name, sector FROM v_registry WHERE {_F9}")
def registry_search_sector(spark, sf_dir):
    return RG.search_registry_tool(D.v_registry(spark, sf_dir), TOOL_QUERY, TOOL_SECTOR).select("ats", "slug", "name", "sector")


@query(
    "registry_search_summary",
    _REG + f"SELECT CAST(count(*) AS BIGINT) AS count, {O.q(TOOL_QUERY)} AS query, {O.q(TOOL_SECTOR)} AS sector "
    f"FROM v_registry WHERE {_F9}",
)
def registry_search_summary(spark, sf_dir):
    """The search tool's metadata row: match count plus the echoed arguments."""
    _, summary = api.search_registry_tool(D.v_registry(spark, sf_dir), TOOL_QUERY, TOOL_SECTOR)
    return summary


@query(
    "registry_counts",
    _REG + "SELECT p.ats, p.ats_ord, CAST(coalesce(c.n, 0) AS BIGINT) AS n_companies FROM "
    "(SELECT * FROM (VALUES ('greenhouse', 0), ('lever', 1), ('ashby', 2)) t(ats, ats_ord)) p "
    "LEFT JOIN (SELECT ats, count(*) AS n FROM v_registry GROUP BY ats) c ON c.ats = p.ats",
)
def registry_counts(spark, sf_dir):
    return RG.registry_counts(D.v_registry(spark, sf_dir))


_REG_COLS = "ats, ats_ord, ord, slug, name, sector"


@query("registry_by_ats", _REG + f"SELECT {_REG_COLS} FROM v_registry")
def registry_by_ats(spark, sf_dir):
    """The registry written by the export and read back, all platforms."""
    return RG.registry_by_ats(api.load_registry(spark, D.exported_registry(spark, sf_dir)))


@query("registry_one_ats", _REG + f"SELECT {_REG_COLS} FROM v_registry WHERE ats = 'lever'")
def registry_one_ats(spark, sf_dir):
    return api.load_registry(spark, D.exported_registry(spark, sf_dir), "lever").select(*_REG_COLS.split(", "))


@query("search_companies", _REG + f"SELECT {_REG_COLS} FROM v_registry WHERE contains(lower(coalesce(nullif(name, ''), slug, '')), "
       f"lower({O.q(REGISTRY_QUERY)})) OR contains(lower(coalesce(sector, '')), lower({O.q(REGISTRY_QUERY)}))")
def search_companies(spark, sf_dir):
    return api.search(D.v_registry(spark, sf_dir), REGISTRY_QUERY, location="anywhere").select(*_REG_COLS.split(", "))


_EP = O.with_(*O.BASE, O.expected_postings_cte())
_DIRECT_COLS = "ats, company_slug, board_part, posting_pos, id, title"


@query("fetch_direct", _EP + f"SELECT {_DIRECT_COLS} FROM ep")
def fetch_direct(spark, sf_dir):
    """Every company's board asked of each platform directly."""
    boards = D.landed_raw_boards(spark, sf_dir)
    slugs = D.read_table(spark, sf_dir, "documents").select(F.col("source").alias("slug")).distinct()
    parts = [fetch(spark, boards, slugs, D.AS_OF) for fetch in (api.fetch_greenhouse, api.fetch_lever, api.fetch_ashby)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*_DIRECT_COLS.split(", "))


@query("postings_by_adapter", _EP + "SELECT ats, count(*) AS n FROM ep GROUP BY ats")
def postings_by_adapter(spark, sf_dir):
    """Postings of each entry of the adapter table."""
    boards = D.latest_raw_boards(spark, sf_dir)
    counts = [AD.adapter(name)(boards).groupBy("ats").agg(F.count(F.lit(1)).alias("n")) for name in AD.ADAPTERS]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_RESOLVED = O.with_(*O.BASE, O.expected_postings_cte(), O.resolved_cte())


@query("find_ats", _RESOLVED + "SELECT request_id, company, slug, registry_ats FROM resolved")
def find_ats(spark, sf_dir):
    req = D.v_requests(spark, sf_dir).withColumn("slug", T.slugify("company"))
    return api.find_ats_by_slug(spark, D.v_registry(spark, sf_dir), req).select("request_id", "company", "slug", "registry_ats")


@query("route_modes", _RESOLVED + "SELECT request_id, slug, mode, route_ats, registry_ats FROM routed")
def route_modes(spark, sf_dir):
    r = RT.resolve_requests(D.v_requests(spark, sf_dir), D.v_registry(spark, sf_dir))
    return r.select("request_id", "slug", "mode", "route_ats", "registry_ats")


# ---------------------------------------------------------------- J2 + U1 per routing mode
_ROUTE_COLS = "request_id, mode, ats, company_slug, board_part, posting_pos, id, title"
_ROUTED_ALL = O.with_(*O.BASE, O.expected_postings_cte(), O.resolved_cte(), O.fetched_cte("true", None))


def _route_mode(spark, sf_dir, mode):
    resolved = RT.resolve_requests(D.v_requests(spark, sf_dir), D.v_registry(spark, sf_dir))
    postings = RT.fetch_postings(resolved.where(F.col("mode") == mode), D.landed_raw_boards(spark, sf_dir), seen_at=D.AS_OF)
    return postings.select("request_id", "mode", "ats", "company_slug", "board_part", "posting_pos", "id", "title")


@query("route_known", _ROUTED_ALL + f"SELECT {_ROUTE_COLS} FROM fetched WHERE mode = 'registry'")
def route_known(spark, sf_dir):
    """Registry hits: only the registry's platform is read."""
    return _route_mode(spark, sf_dir, "registry")


@query("route_explicit", _ROUTED_ALL + f"SELECT {_ROUTE_COLS} FROM fetched WHERE mode = 'explicit'")
def route_explicit(spark, sf_dir):
    """Explicit platform: read even when the registry names another."""
    return _route_mode(spark, sf_dir, "explicit")


@query("route_discovery", _ROUTED_ALL + f"SELECT {_ROUTE_COLS} FROM fetched WHERE mode = 'discovery'")
def route_discovery(spark, sf_dir):
    """Unknown companies: every platform is read and the results unioned."""
    return _route_mode(spark, sf_dir, "discovery")


# ---------------------------------------------------------------- E1, A2, J5, P18, J4
_FETCH_FILTER = f"{O.rx('title', FETCH_TITLE)} AND {O.recency(FETCH_DAYS)} AND NOT {O.loc_any(FETCH_EXCLUDE)}"
_FETCHED = O.with_(*O.BASE, O.expected_postings_cte(), O.resolved_cte(), O.fetched_cte(_FETCH_FILTER, FL.DEFAULT_LIMIT))


def _fetch_args(spark, sf_dir) -> tuple:
    return D.landed_raw_boards(spark, sf_dir), D.v_registry(spark, sf_dir), D.v_requests(spark, sf_dir)


_FETCH = {"title_filter": FETCH_TITLE, "posted_within_days": FETCH_DAYS, "location_excludes": FETCH_EXCLUDE, "as_of": D.AS_OF, "seen_at": D.AS_OF}


@query(
    "fetch_jobs",
    _FETCHED + "SELECT request_id, ats, company_slug, board_part, posting_pos, id, title, location, location_type, "
    "salary_min, salary_max, posted_at_raw FROM fetched",
)
def fetch_jobs(spark, sf_dir):
    res = api.fetch_jobs(spark, *_fetch_args(spark, sf_dir), **_FETCH)
    return res.select(
        "request_id", "ats", "company_slug", "board_part", "posting_pos", "id", "title", "location", "location_type",
        F.col("salary.min").alias("salary_min"), F.col("salary.max").alias("salary_max"), "posted_at_raw",
    )


@query(
    "fetch_summary",
    _FETCHED + "SELECT r.request_id, r.company, r.slug, r.mode, CAST(coalesce(c.n, 0) AS BIGINT) AS count, "
    "r.registry_ats IS NOT NULL AS registry_hit, r.registry_ats AS ats, "
    "CASE WHEN coalesce(c.n, 0) > 20 THEN '... and ' || CAST(coalesce(c.n, 0) - 20 AS VARCHAR) "
    "|| ' more. Use --json for full output.' END AS more "
    "FROM routed r LEFT JOIN (SELECT request_id, count(*) AS n FROM fetched GROUP BY request_id) c ON c.request_id = r.request_id",
)
def fetch_summary(spark, sf_dir):
    return api.fetch_jobs_tool(spark, *_fetch_args(spark, sf_dir), **_FETCH)[1]


_UNFILTERED = O.with_(*O.BASE, O.expected_postings_cte(), O.resolved_cte(), O.fetched_cte("true", FL.DEFAULT_LIMIT))


@query(
    "preview_more",
    _UNFILTERED + "SELECT r.request_id, CAST(coalesce(c.n, 0) AS BIGINT) AS count, "
    "CASE WHEN coalesce(c.n, 0) > 20 THEN '... and ' || CAST(coalesce(c.n, 0) - 20 AS VARCHAR) "
    "|| ' more. Use --json for full output.' END AS more "
    "FROM routed r LEFT JOIN (SELECT request_id, count(*) AS n FROM fetched GROUP BY request_id) c ON c.request_id = r.request_id",
)
def preview_more(spark, sf_dir):
    """Unfiltered fetch with the default limit: per-request count and the
    '... and K more' line printed after a 20-row preview."""
    resolved = RT.resolve_requests(D.v_requests(spark, sf_dir), D.v_registry(spark, sf_dir))
    res = RT.fetch_jobs_batch(resolved, D.landed_raw_boards(spark, sf_dir), seen_at=D.AS_OF)
    return SM.fetch_summary(resolved, res).select("request_id", "count", "more")


_HEADING = (
    "title || CASE WHEN department <> '' THEN ' [' || department || ']' ELSE '' END"
    " || CASE WHEN location <> '' THEN ' | ' || location ELSE '' END"
    " || CASE WHEN salary_currency IS NOT NULL THEN ' | $' || coalesce(format('{:,}', CAST(round(salary_min) AS BIGINT)), 'NaN')"
    " || '-$' || coalesce(format('{:,}', CAST(round(salary_max) AS BIGINT)), 'NaN') ELSE '' END"
)
_TEASER = "CASE WHEN description <> '' THEN replace(substr(description, 1, 120), chr(10), ' ') || '...' END"


@query(
    "preview",
    _FETCHED + f"SELECT request_id, board_part, posting_pos, {_HEADING} AS heading, url, {_TEASER} AS teaser "
    "FROM fetched WHERE rn <= 20",
)
def preview(spark, sf_dir):
    res = api.fetch_jobs(spark, *_fetch_args(spark, sf_dir), **_FETCH, rank_col="rank")
    return api.preview(res, rank_col="rank").select("request_id", "board_part", "posting_pos", "heading", "url", "teaser")


_SWEEP = O.with_(
    *O.BASE,
    O.expected_postings_cte(),
    f"""sweep_req AS (
  SELECT DISTINCT ats || '/' || slug AS request_id, slug AS company, ats
  FROM v_registry WHERE contains(lower(coalesce(sector, '')), {O.q(SWEEP_SECTOR)})
    AND (contains(lower(coalesce(nullif(name, ''), slug, '')), {O.q(SWEEP_SECTOR)}) OR contains(lower(coalesce(sector, '')), {O.q(SWEEP_SECTOR)}))
)""",
    O.resolved_cte().replace("FROM v_requests", "FROM sweep_req"),
    O.fetched_cte(f"({O.rx('title', SWEEP_TOPIC)} OR {O.rx('department', SWEEP_TOPIC)} OR {O.rx('description', SWEEP_TOPIC)})", SWEEP_LIMIT),
)


@query("sector_sweep", _SWEEP + "SELECT request_id, company_slug, ats, board_part, posting_pos, title FROM fetched")
def sector_sweep(spark, sf_dir):
    res = api.sector_sweep(spark, D.landed_raw_boards(spark, sf_dir), D.v_registry(spark, sf_dir), SWEEP_SECTOR,
                           filter=SWEEP_TOPIC, limit=SWEEP_LIMIT, seen_at=D.AS_OF)
    return res.select("request_id", "company_slug", "ats", "board_part", "posting_pos", "title")


# ---------------------------------------------------------------- S8, A1
_PROBES = f"""
probe_rows AS (
  SELECT s.slug, s.slug_num, p.ats, p.ats_ord FROM v_sources s,
    (SELECT * FROM (VALUES ('greenhouse', 0), ('lever', 1), ('ashby', 2)) t(ats, ats_ord)) p
),
found AS (
  SELECT slug, ats, ats_ord FROM probe_rows
  WHERE (ats_ord = slug_num % 3 OR (slug_num % 5 = 0 AND ats_ord = (slug_num % 3 + 1) % 3))
    AND coalesce({O.board_status('slug_num', 'ats', "CASE WHEN ats = 'ashby' THEN 'rest' ELSE 'board' END")} BETWEEN 200 AND 299, false)
)"""

_DETECT = O.with_(*O.BASE, _PROBES) + f"""
SELECT request_id, company, slug, CAST(count(f.ats) AS INTEGER) AS n_found,
  CASE WHEN count(f.ats) > 1 THEN 'partial' ELSE 'success' END AS status,
  arg_min(f.ats, f.ats_ord) AS data,
  CASE WHEN count(f.ats) > 1 THEN 'Company found on multiple platforms: ' || string_agg(f.ats, ', ' ORDER BY f.ats_ord)
       || '. Returning first match.' END AS note,
  coalesce(string_agg(f.ats, ',' ORDER BY f.ats_ord), '') AS found_csv, 'greenhouse,lever,ashby' AS attempted,
  coalesce(string_agg(f.ats, ',' ORDER BY f.ats_ord), '') AS succeeded
FROM (SELECT request_id, company, {O.slugify('company')} AS slug FROM v_requests) r
LEFT JOIN found f USING (slug)
GROUP BY request_id, company, slug"""


@query("detect_ats", _DETECT)
def detect_ats(spark, sf_dir):
    out = api.detect_ats(spark, D.landed_raw_boards(spark, sf_dir), D.v_requests(spark, sf_dir))
    return out.select("request_id", "company", "slug", "n_found", "status", "data", "note",
                      F.array_join("found", ",").alias("found_csv"), F.array_join("attempted", ",").alias("attempted"),
                      F.array_join("succeeded", ",").alias("succeeded"))


# ---------------------------------------------------------------- date texts
@query(
    "date_forms",
    """SELECT o_orderkey, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) + CASE o_orderkey % 7
      WHEN 1 THEN (o_orderkey % 24 * 60 + 5) * 60000 WHEN 3 THEN (o_orderkey % 24 * 60 + 5) * 60000
      WHEN 4 THEN ((o_orderkey % 24 + 5) * 60 + 5) * 60000 WHEN 5 THEN (o_orderkey % 24 * 60 + 5 - 330) * 60000 ELSE 0 END AS ms
    FROM orders WHERE o_orderkey % 7 <> 6
    UNION ALL SELECT o_orderkey, NULL AS ms FROM orders WHERE o_orderkey % 7 = 6""",
)
def date_forms(spark, sf_dir):
    """Every order's date written in a form of date text, and read back."""
    o = D.read_text_table(spark, sf_dir, "orders", ["o_orderkey", F.col("o_orderdate").cast("date").alias("d")])
    key = F.col("o_orderkey")
    written = lambda f: F.date_format("d", f)
    hour = key % 24
    clock = F.format_string("%02d:05", hour)
    half = F.format_string("%d:05 %s", F.when(hour % 12 == 0, 12).otherwise(hour % 12), F.when(hour < 12, "AM").otherwise("pm"))
    text = (
        F.when(key % 7 == 0, written("M/d/yyyy"))
        .when(key % 7 == 1, F.concat(written("yyyy/MM/dd"), F.lit(" "), clock, F.lit(" GMT")))
        .when(key % 7 == 2, written("yyyy-MM-dd"))
        .when(key % 7 == 3, F.concat(written("MMMM d, yyyy"), F.lit(" "), half, F.lit(" UTC")))
        .when(key % 7 == 4, F.concat(written("EEE, dd MMM yyyy"), F.lit(" "), clock, F.lit(":00 EST")))
        .when(key % 7 == 5, F.concat(written("M-d-yyyy"), F.lit(" "), clock, F.lit(" +0530 (IST)")))
        .otherwise(F.concat(written("M/d/yyyy"), F.lit(" or so")))
    )
    # a date without time or zone is in the session's zone, which the oracle takes as UTC
    text = F.when(key % 7 == 0, F.concat(text, F.lit(" 00:00 Z"))).otherwise(text)
    return o.select("o_orderkey", F.unix_millis(js_timestamp(text)).alias("ms"))


# ---------------------------------------------------------------- many filters, many searches
SAVED = {
    "keepers": {"title_filter": "yard keeper|dock keeper"},
    "tides": {"title_filter": "^tide|tides?$", "posted_within_days": 20},
    "pay": {"filter": "pay range|payments", "location_excludes": ["oslo", "south"]},
    "north": {"location_includes": ["northern", "Rim"], "filter": "growth|product"},
    "pilots": {"title_filter": "(charter|harbour) pilot \\$[5-9]"},
    "recent": {"posted_within_days": 3},
    "digits": {"title_filter": "[0-9]{2},[0-9]{3}"},
    "never": {"location_includes": [" "]},
}


def _saved_sql(name: str, spec: dict) -> str:
    conds = ["true"]
    if "title_filter" in spec:
        conds.append(O.rx("title", spec["title_filter"]))
    if "filter" in spec:
        conds.append("(" + " OR ".join(O.rx(c, spec["filter"]) for c in ("title", "department", "description")) + ")")
    if "posted_within_days" in spec:
        conds.append(O.recency(spec["posted_within_days"]))
    if "location_includes" in spec:
        conds.append(O.loc_any(spec["location_includes"]))
    if "location_excludes" in spec:
        conds.append(f"NOT {O.loc_any(spec['location_excludes'])}")
    return f"SELECT {O.q(name)} AS filter_id, doc_id, company_slug FROM v_postings WHERE {' AND '.join(conds)}"


@query("saved_filters", _VP + " UNION ALL ".join(_saved_sql(*x) for x in SAVED.items()))
def saved_filters(spark, sf_dir):
    """All saved filters over all postings in one pass."""
    out = match_filters(D.landed_postings(spark, sf_dir), SAVED, None, as_of=D.AS_OF)
    return out.select("filter_id", "doc_id", "company_slug")


_SEARCHES_SQL = """searches AS (
  SELECT CAST(s_suppkey AS BIGINT) AS query_id,
    CASE s_suppkey % 4 WHEN 0 THEN 'SRC' || s_suppkey % 20 WHEN 1 THEN 'company src' || s_suppkey % 7 WHEN 2 THEN s_name END AS query,
    CASE WHEN s_suppkey % 3 = 0 THEN 'TOOLS' WHEN s_suppkey % 8 = 3 THEN 'pro' END AS sector
  FROM supplier
)"""


@query("registry_search_many", O.with_(O.V_SOURCES, O.V_REGISTRY, _SEARCHES_SQL) + """
SELECT query_id, ats, slug, name, r.sector FROM searches s JOIN v_registry r
  ON (contains(lower(coalesce(nullif(r.name, ''), r.slug, '')), lower(coalesce(nullif(s.query, ''), s.sector))) OR contains(lower(coalesce(r.sector, '')), lower(coalesce(nullif(s.query, ''), s.sector))))
  AND contains(lower(coalesce(r.sector, '')), lower(coalesce(s.sector, '')))""")
def registry_search_many(spark, sf_dir):
    """A search of the registry for every supplier, in one query."""
    key = F.col("s_suppkey")
    term = F.when(key % 4 == 0, F.concat(F.lit("SRC"), key % 20)).when(key % 4 == 1, F.concat(F.lit("company src"), key % 7)).when(key % 4 == 2, F.col("s_name"))
    sector = F.when(key % 3 == 0, "TOOLS").when(key % 8 == 3, "pro")
    searches = D.read_table(spark, sf_dir, "supplier").select(key.cast("bigint").alias("query_id"), term.alias("query"), sector.alias("sector"))
    return search_many(D.v_registry(spark, sf_dir), searches).select("query_id", "ats", "slug", "name", "sector")


# ---------------------------------------------------------------- posting history
_LISTED_SQL = "[" + ", ".join("[" + ", ".join(map(str, x)) + "]" for x in D.LISTED) + "]"
_HISTORY = f"""
WITH seen AS (
  SELECT doc_id, source AS slug, CAST(substring(source, 4) AS INTEGER) % 3 AS k, unnest({_LISTED_SQL}[doc_id % {len(D.LISTED)} + 1]) AS scan FROM documents
), boards AS (
  SELECT source AS slug, max(doc_id // {D.PART_WIDTH} % 2) AS late FROM documents GROUP BY source
), runs AS (
  SELECT *, scan - row_number() OVER (PARTITION BY doc_id ORDER BY scan) AS island FROM seen
), spans AS (
  SELECT slug, k, doc_id, min(scan) AS a, max(scan) AS b, count(*) AS n FROM runs GROUP BY slug, k, doc_id, island
), named AS (
  SELECT *, {O.ats_name('k')} AS ats, CASE WHEN k = 1 THEN upper(substr(slug, 1, 1)) || substr(slug, 2) ELSE slug END AS company FROM spans
)
SELECT ats, slug AS company_slug, {O.job_id('company', "'Posting ' || doc_id", 'ats')} AS id,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY a) AS INTEGER) AS interval,
  epoch(TIMESTAMP '{D.AS_OF_DATE}')::BIGINT + (a - 3) * 86400 + late - 1 AS first_seen,
  epoch(TIMESTAMP '{D.AS_OF_DATE}')::BIGINT + (b - 3) * 86400 + late - 1 AS last_seen,
  CASE WHEN b < 3 THEN epoch(TIMESTAMP '{D.AS_OF_DATE}')::BIGINT + (b - 2) * 86400 + late - 1 END AS closed_at,
  CASE WHEN b < 3 THEN 'closed' ELSE 'open' END AS status, n AS n_scans
FROM named JOIN boards USING (slug)"""


@query("posting_history", _HISTORY)
def posting_history(spark, sf_dir):
    """Intervals in which every posting was listed, over four scans of every board."""
    from ..operators.history import posting_history as history

    out = history(D.landed_history(spark, sf_dir))
    seconds = lambda c: F.unix_seconds(c).alias(c)
    return out.select("ats", "company_slug", "id", "interval", *map(seconds, ("first_seen", "last_seen", "closed_at")), "status", "n_scans")


@query("postings_with_history", _HISTORY.replace("SELECT ats, slug AS company_slug", ", whole AS (SELECT ats, slug AS company_slug") + """)
SELECT ats, company_slug, id, min(first_seen) AS first_seen, max(last_seen) AS last_seen, 'open' AS status
FROM whole GROUP BY ats, company_slug, id HAVING bool_or(status = 'open')""")
def postings_with_history(spark, sf_dir):
    """The current postings of the scanned boards with the times of their history."""
    from ..operators.history import posting_history as history
    from ..operators.history import with_history

    store = D.landed_history(spark, sf_dir)
    postings = with_history(_norm(AD.all_postings(latest_boards(store))), history(store))
    seconds = lambda c: F.unix_seconds(c).alias(c)
    return postings.select("ats", "company_slug", "id", seconds("first_seen"), seconds("last_seen"), "status")


def spark_queries() -> dict:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_queries() -> dict:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
