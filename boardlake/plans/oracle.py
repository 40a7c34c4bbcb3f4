"""DuckDB SQL for every registered query (the correctness oracle).

The fixture rules of ``boardlake.sources.derived`` are restated here as
plain SQL over the driver's tables, and the expected normalised output is
computed directly from the source numbers (no JSON round trip), so the
Spark plan (JSON bodies -> from_json -> adapters -> normaliser -> filters)
is checked against an independent formulation.
"""

from __future__ import annotations

from ..sources import derived as D
from ..sources.schemas import ATS_NAMES

# RE2 flavour of the JavaScript whitespace class (DuckDB has no lookbehind,
# so whole-word keyword matches use \b, which is ASCII in RE2 like in JS).
WS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
FULL = r"\$([\d,]+)" + WS + r"*[-–]" + WS + r"*\$([\d,]+)"
KFORM = r"\$(\d+)[kK]" + WS + r"*[-–]" + WS + r"*\$(\d+)[kK]"
NL = "chr(10)"


def q(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def pick(values, idx: str) -> str:
    parts = " ".join(f"WHEN {i} THEN {q(v) if v is not None else 'CAST(NULL AS VARCHAR)'}" for i, v in enumerate(values))
    return f"(CASE {idx} {parts} END)"


def fmt(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def ats_name(idx: str) -> str:
    return pick(ATS_NAMES, idx)


def js_trim(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


_STRIP_STEPS = (
    (r"<br" + WS + r"*/?>", NL, "gi"),
    ("</p>", f"{NL} || {NL}", "gi"),
    ("</li>", NL, "gi"),
    ("<li>", "'- '", "gi"),
    ("</h[1-6]>", f"{NL} || {NL}", "gi"),
    ("<h[1-6][^>]*>", "'## '", "gi"),
    ("<[^>]+>", "''", "g"),
    ("&amp;", "'&'", "g"),
    ("&lt;", "'<'", "g"),
    ("&gt;", "'>'", "g"),
    ("&nbsp;", "' '", "g"),
    (r"&#\d+;", "''", "g"),
    (r"\n{3,}", f"{NL} || {NL}", "g"),
)


def strip_html(e: str) -> str:
    out = f"coalesce({e}, '')"
    for pat, repl, flags in _STRIP_STEPS:
        out = f"regexp_replace({out}, {q(pat)}, {repl}, '{flags}')"
    return js_trim(out)


def location_type(loc: str) -> str:
    l = f"coalesce({loc}, '')"
    return (
        f"(CASE WHEN regexp_matches({l}, 'remote', 'i') THEN 'remote' "
        f"WHEN regexp_matches({l}, 'hybrid', 'i') THEN 'hybrid' "
        f"WHEN regexp_matches({l}, 'on-?site', 'i') THEN 'onsite' "
        f"WHEN {l} <> '' THEN 'onsite' ELSE 'unknown' END)"
    )


def _num(e: str) -> str:
    return f"try_cast(replace({e}, ',', '') AS DOUBLE)"


def salary_text_cols(t: str) -> str:
    full = q(FULL)
    k = q(KFORM)
    tt = f"coalesce({t}, '')"
    mn = (f"CASE WHEN regexp_matches({tt}, {full}) THEN {_num(f'regexp_extract({tt}, {full}, 1)')} "
          f"WHEN regexp_matches({tt}, {k}) THEN {_num(f'regexp_extract({tt}, {k}, 1)')} * 1000 END")
    mx = (f"CASE WHEN regexp_matches({tt}, {full}) THEN {_num(f'regexp_extract({tt}, {full}, 2)')} "
          f"WHEN regexp_matches({tt}, {k}) THEN {_num(f'regexp_extract({tt}, {k}, 2)')} * 1000 END")
    cur = f"CASE WHEN regexp_matches({tt}, {full}) OR regexp_matches({tt}, {k}) THEN 'USD' END"
    return f"{mn} AS salary_min, {mx} AS salary_max, {cur} AS salary_currency"


def full_only_cols(t: str) -> str:
    full = q(FULL)
    tt = f"coalesce({t}, '')"
    return (
        f"CASE WHEN regexp_matches({tt}, {full}) THEN {_num(f'regexp_extract({tt}, {full}, 1)')} END AS salary_min, "
        f"CASE WHEN regexp_matches({tt}, {full}) THEN {_num(f'regexp_extract({tt}, {full}, 2)')} END AS salary_max, "
        f"CASE WHEN regexp_matches({tt}, {full}) THEN 'USD' END AS salary_currency"
    )


def k_only_cols(t: str) -> str:
    k = q(KFORM)
    tt = f"coalesce({t}, '')"
    return (
        f"CASE WHEN regexp_matches({tt}, {k}) THEN {_num(f'regexp_extract({tt}, {k}, 1)')} * 1000 END AS salary_min, "
        f"CASE WHEN regexp_matches({tt}, {k}) THEN {_num(f'regexp_extract({tt}, {k}, 2)')} * 1000 END AS salary_max, "
        f"CASE WHEN regexp_matches({tt}, {k}) THEN 'USD' END AS salary_currency"
    )


def job_id(company: str, title: str, ats: str) -> str:
    raw = f"coalesce({company}, 'undefined') || '|' || coalesce({title}, 'undefined') || '|' || coalesce({ats}, 'undefined')"
    return f"substr(md5({js_trim(f'lower({raw})')}), 1, 12)"


def slugify(e: str) -> str:
    return f"regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9]', '', 'g')"


def company_name(slug: str, n: str) -> str:
    return f"(CASE WHEN {n} % 7 = 6 THEN NULL ELSE 'Company ' || upper({slug}) END)"


# --------------------------------------------------------------------------
# views
# --------------------------------------------------------------------------

def _phrase(doc: str, a: str, b: str) -> str:
    return (
        f"(CASE {doc} % 6 "
        f"WHEN 0 THEN ' Pay range: $' || {fmt(a)} || ' - $' || {fmt(b)} || '.' "
        f"WHEN 1 THEN ' Pay: $' || {fmt(a)} || '–$' || {fmt(b)} "
        f"WHEN 2 THEN ' Pay: $' || CAST({a} // 1000 AS VARCHAR) || 'K - $' || CAST({b} // 1000 AS VARCHAR) || 'k' "
        f"WHEN 3 THEN ' Pay from $' || {fmt(a)} || ' upward.' "
        f"WHEN 4 THEN ' Pay: $' || {fmt(a)} || '.00 - $' || {fmt(b)} || '.00' "
        f"ELSE '' END)"
    )


V_POSTINGS = f"""
v_postings AS (
  SELECT doc_id, company_slug, slug_num, ats_ord, {ats_name('ats_ord')} AS ats, part, title, department, location,
         description, posted_at_raw, amount_min, amount_max
  FROM (
    SELECT doc_id,
      source AS company_slug,
      CAST(substring(source, 4) AS INTEGER) AS slug_num,
      CAST(substring(source, 4) AS INTEGER) % 3 AS ats_ord,
      CAST(doc_id // {D.PART_WIDTH} AS INTEGER) AS part,
      CASE WHEN doc_id % 8 = 7 THEN 'Charter pilot $' || {fmt('a')} || ' - $' || {fmt('b')}
           ELSE {pick(D.TITLES, 'doc_id % 8')} END AS title,
      {pick(D.DEPARTMENTS, 'doc_id % 5')} AS department,
      {pick(D.LOCATIONS, f'doc_id % {len(D.LOCATIONS)}')} AS location,
      coalesce(text, '') || {_phrase('doc_id', 'a', 'b')} AS description,
      CASE WHEN doc_id % 10 = 9 THEN NULL
           WHEN doc_id % 20 = 8 THEN 'recently'
           ELSE CAST(DATE '{D.AS_OF_DATE}' - CAST(doc_id % 60 - 1 AS INTEGER) AS VARCHAR) || 'T'
                || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00.000Z' END AS posted_at_raw,
      a AS amount_min, b AS amount_max
    FROM (SELECT doc_id, text, source, 50000 + doc_id * 10 AS a, 50000 + doc_id * 10 + 25000 AS b FROM documents) d
  ) x
)"""

V_SOURCES = """
v_sources AS (
  SELECT source AS slug, CAST(substring(source, 4) AS INTEGER) AS slug_num FROM (SELECT DISTINCT source FROM documents) s
)"""

V_REGISTRY = f"""
v_registry AS (
  SELECT {ats_name('ats_ord')} AS ats, ats_ord, slug_num AS ord, slug, name, sector FROM (
    SELECT slug, slug_num, slug_num % 3 AS ats_ord, {company_name('slug', 'slug_num')} AS name,
           {pick(D.SECTORS, 'slug_num % 5')} AS sector
    FROM v_sources WHERE slug_num % 4 <> 3
    UNION ALL
    SELECT slug, slug_num, (slug_num % 3 + 1) % 3 AS ats_ord, {company_name('slug', 'slug_num')} AS name,
           {pick(D.SECTORS, 'slug_num % 5')} AS sector
    FROM v_sources WHERE slug_num % 4 <> 3 AND slug_num % 5 = 0
  ) r
)"""

V_REQUESTS = """
v_requests AS (
  SELECT CAST(slug_num AS BIGINT) AS request_id,
         upper(substr(slug, 1, 1)) || substr(slug, 2, 2) || '-' || substring(slug, 4) || ' ' AS company,
         CASE WHEN slug_num % 6 = 0 THEN 'lever' END AS ats
  FROM v_sources
  UNION ALL
  SELECT CAST(s_suppkey + 1000000 AS BIGINT) AS request_id, s_name AS company, CAST(NULL AS VARCHAR) AS ats FROM supplier
)"""


def board_status(n: str, ats: str, endpoint: str) -> str:
    k = f"({n} % 20)"
    return (
        f"(CASE WHEN {k} = 4 AND {ats} = 'lever' THEN 404 "
        f"WHEN {k} = 6 AND {ats} = 'greenhouse' THEN 500 "
        f"WHEN {k} = 9 AND {ats} = 'greenhouse' THEN NULL "
        f"WHEN {k} = 13 AND {ats} = 'lever' THEN 429 "
        f"WHEN {k} = 11 AND {endpoint} = 'rest' THEN 404 "
        f"WHEN {k} = 14 AND {endpoint} = 'graphql' THEN 404 "
        f"ELSE 200 END)"
    )


# Board postings: own platform, plus the next platform for slug numbers % 5 = 0.
V_BOARD_POSTINGS = f"""
bp0 AS (
  SELECT doc_id, company_slug, slug_num, part, title, department, location, description, posted_at_raw,
         amount_min, amount_max, ats_ord AS b_ord FROM v_postings
  UNION ALL
  SELECT doc_id, company_slug, slug_num, part, title, department, location, description, posted_at_raw,
         amount_min, amount_max, (ats_ord + 1) % 3 AS b_ord FROM v_postings WHERE slug_num % 5 = 0
),
bp AS (
  SELECT *, {ats_name('b_ord')} AS b_ats, slug_num % 20 AS k,
         CAST(row_number() OVER (PARTITION BY b_ord, company_slug, part ORDER BY doc_id) - 1 AS INTEGER) AS posting_pos
  FROM bp0
)"""

# boards that parse to postings, per platform / endpoint
GH_OK = "b_ats = 'greenhouse' AND k NOT IN (6, 9, 12, 18)"
LV_OK = "b_ats = 'lever' AND k NOT IN (4, 13, 16, 19)"
AR_OK = "b_ats = 'ashby' AND k NOT IN (11, 14) AND slug_num % 9 <> 8"
AG_OK = "b_ats = 'ashby' AND k <> 14"
AG_FALLBACK = f"{AG_OK} AND (k = 11 OR slug_num % 9 = 8)"

_COMMON = (
    "ats, ats_ord, company_slug, board_part, posting_pos, doc_id, id, company, title, department, location, "
    "location_type, salary_min, salary_max, salary_currency, description, url, posted_at_raw"
)


def _finish(ats: str, ats_ord: int, extra: str = "") -> str:
    """Common normaliser columns over a subquery providing company, title_n,
    dept_n, loc_n, desc_handed (+ salary columns), url, posted."""
    return (
        f"SELECT '{ats}' AS ats, {ats_ord} AS ats_ord, company_slug, part AS board_part, posting_pos, doc_id, "
        f"{job_id('company', 'title_n', q(ats))} AS id, company, title_n AS title, dept_n AS department, "
        f"loc_n AS location, {location_type('loc_n')} AS location_type, salary_min, salary_max, salary_currency, "
        f"{strip_html('desc_handed')} AS description, url, posted AS posted_at_raw{extra}"
    )


def gh_expected(where: str = GH_OK, raw_cols: bool = False) -> str:
    esc = "replace(replace(replace('<p>' || description || '</p>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    inner = f"""
      SELECT *, {salary_text_cols('desc_handed')} FROM (
        SELECT bp.*, coalesce({company_name('company_slug', 'slug_num')}, company_slug) AS company,
               coalesce(title, '') AS title_n, coalesce(department, '') AS dept_n,
               CASE WHEN doc_id % 41 = 7 THEN '' ELSE coalesce(location, '') END AS loc_n,
               {strip_html(esc)} AS desc_handed,
               'https://boards.example.com/' || company_slug || '/jobs/' || CAST(doc_id AS VARCHAR) AS url,
               posted_at_raw AS posted
        FROM bp WHERE {where}) g"""
    extra = (", CAST(CASE WHEN doc_id % 37 <> 5 THEN doc_id END AS BIGINT) AS greenhouse_id, CAST(doc_id + 1000000 AS BIGINT) AS internal_job_id, "
             "coalesce(department, '') AS departments, coalesce(location, '') AS offices")
    if raw_cols:
        extra += ", department AS raw_department, location AS raw_location"
    return _finish("greenhouse", 0, extra) + f" FROM ({inner}) x"


def lv_expected(where: str = LV_OK) -> str:
    full = q(FULL)
    t = "coalesce(title, '')"
    inner = f"""
      SELECT l1.*,
        CASE WHEN regexp_matches({t}, {full}) THEN {_num(f'regexp_extract({t}, {full}, 1)')} ELSE ts_min END AS salary_min,
        CASE WHEN regexp_matches({t}, {full}) THEN {_num(f'regexp_extract({t}, {full}, 2)')} ELSE ts_max END AS salary_max,
        CASE WHEN regexp_matches({t}, {full}) THEN 'USD' ELSE ts_cur END AS salary_currency
      FROM (
        SELECT l0.*, ts.salary_min AS ts_min, ts.salary_max AS ts_max, ts.salary_currency AS ts_cur FROM (
          SELECT bp.*, upper(substr(company_slug, 1, 1)) || substr(company_slug, 2) AS company,
                 coalesce(title, '') AS title_n,
                 CASE WHEN doc_id % 11 = 10 THEN '' ELSE coalesce(nullif(department, ''), 'Team ' || CAST(doc_id % 3 AS VARCHAR)) END AS dept_n,
                 CASE WHEN doc_id % 11 = 10 THEN '' ELSE coalesce(location, '') END AS loc_n,
                 {strip_html("CASE WHEN doc_id % 2 = 0 THEN description ELSE '<p>' || description || '</p>' END")} AS desc_handed,
                 'https://jobs.example.com/' || company_slug || '/lv-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url,
                 CASE WHEN posted_at_raw = 'recently' OR doc_id % 47 = 11 THEN NULL ELSE posted_at_raw END AS posted
          FROM bp WHERE {where}) l0,
        LATERAL (SELECT {salary_text_cols('l0.desc_handed')}) ts
      ) l1"""
    extra = (", 'lv-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS lever_id, "
             "CASE WHEN doc_id % 11 = 10 THEN '' ELSE 'Team ' || CAST(doc_id % 3 AS VARCHAR) END AS team, "
             "CASE WHEN doc_id % 11 = 10 THEN '' ELSE 'Full-time' END AS commitment, "
             f"{pick(D.WORKPLACE, 'doc_id % 3')} AS workplace_type")
    return _finish("lever", 1, extra) + f" FROM ({inner}) x"


def ar_expected(where: str = AR_OK) -> str:
    inner = f"""
      SELECT a0.*,
        CASE doc_id % 5 WHEN 0 THEN CAST(amount_min AS DOUBLE) WHEN 1 THEN CAST(amount_min AS DOUBLE)
             WHEN 2 THEN CAST(amount_min AS DOUBLE) ELSE ts.salary_min END AS salary_min,
        CASE doc_id % 5 WHEN 0 THEN CAST(amount_max AS DOUBLE) WHEN 1 THEN CAST(amount_max AS DOUBLE)
             WHEN 2 THEN CAST(amount_max AS DOUBLE) ELSE ts.salary_max END AS salary_max,
        CASE doc_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' ELSE ts.salary_currency END AS salary_currency
      FROM (
        SELECT bp.*, coalesce({company_name('company_slug', 'slug_num')}, company_slug) AS company,
               coalesce(title, '') AS title_n, coalesce(department, '') AS dept_n, coalesce(location, '') AS loc_n,
               CASE WHEN doc_id % 4 <> 3 THEN '<p>' || description || '</p>' ELSE description END AS desc_handed,
               'https://jobs.ashbyhq.com/' || company_slug || '/ab-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url,
               posted_at_raw AS posted
        FROM bp WHERE {where}) a0,
      LATERAL (SELECT {salary_text_cols('a0.desc_handed')}) ts"""
    extra = (", 'ab-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS ashby_id, "
             f"coalesce({pick(D.EMPLOYMENT, 'doc_id % 4')}, '') AS employment_type, "
             "CASE WHEN doc_id % 3 = 2 OR doc_id % 43 = 9 THEN false ELSE starts_with(coalesce(location, ''), 'Remote') END AS is_remote, "
             "'Team ' || CAST(doc_id % 3 AS VARCHAR) AS team, '' AS compensation_summary")
    return _finish("ashby", 2, extra) + f" FROM ({inner}) x"


def ag_expected(where: str = AG_OK) -> str:
    inner = f"""
      SELECT *, {salary_text_cols('desc_handed')} FROM (
        SELECT bp.*, coalesce({company_name('company_slug', 'slug_num')}, company_slug) AS company,
               coalesce(title, '') AS title_n, '' AS dept_n, coalesce(location, '') AS loc_n,
               '<p>' || description || '</p>' AS desc_handed,
               'https://jobs.ashbyhq.com/' || company_slug || '/ab-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url,
               posted_at_raw AS posted
        FROM bp WHERE {where}) g"""
    extra = (", 'ab-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS ashby_id, "
             f"coalesce({pick(D.EMPLOYMENT, 'doc_id % 4')}, '') AS employment_type, "
             "CAST(NULL AS BOOLEAN) AS is_remote, '' AS team, "
             "CASE WHEN doc_id % 2 = 0 THEN 'USD ' || " + fmt("amount_min") + " || ' – ' || " + fmt("amount_max") +
             " ELSE '' END AS compensation_summary")
    return _finish("ashby", 2, extra) + f" FROM ({inner}) x"


def expected_postings_cte() -> str:
    """ep: every posting the adapters + normaliser must produce (U1 + J3)."""
    return f"""
ep AS (
  SELECT {_COMMON} FROM ({gh_expected()}) g
  UNION ALL SELECT {_COMMON} FROM ({lv_expected()}) l
  UNION ALL SELECT {_COMMON} FROM ({ar_expected()}) r
  UNION ALL SELECT {_COMMON} FROM ({ag_expected(AG_FALLBACK)}) f
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


BASE = (V_POSTINGS, V_SOURCES, V_REGISTRY, V_REQUESTS, V_BOARD_POSTINGS)


def resolved_cte() -> str:
    return f"""
resolved AS (
  SELECT r.request_id, r.company, r.ats AS ats_requested, r.slug, f.registry_ats,
    CASE WHEN coalesce(r.company, '') = '' THEN 'invalid'
         WHEN r.ats IS NOT NULL AND r.ats NOT IN ('greenhouse', 'lever', 'ashby') THEN 'invalid'
         WHEN r.ats IS NOT NULL THEN 'explicit'
         WHEN f.registry_ats IS NOT NULL THEN 'registry' ELSE 'discovery' END AS mode
  FROM (SELECT *, {slugify('company')} AS slug FROM v_requests) r
  LEFT JOIN (SELECT slug, arg_min(ats, ats_ord) AS registry_ats FROM v_registry GROUP BY slug) f ON r.slug = f.slug
),
routed AS (
  SELECT *, CASE mode WHEN 'explicit' THEN ats_requested WHEN 'registry' THEN registry_ats END AS route_ats FROM resolved
)"""


def fetched_cte(filters_sql: str, limit: int | None) -> str:
    lim = f"WHERE rn <= {limit}" if limit is not None else ""
    return f"""
fetched_all AS (
  SELECT rt.request_id, rt.mode, ep.* FROM routed rt JOIN ep
    ON ep.company_slug = rt.slug AND (rt.route_ats IS NULL OR rt.route_ats = ep.ats)
  WHERE rt.mode <> 'invalid' AND {filters_sql}
),
fetched AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ats_ord, board_part, posting_pos) AS rn FROM fetched_all
  ) z {lim}
)"""


# --------------------------------------------------------------------------
# filter predicates (RE2: \b is ASCII, like JavaScript)
# --------------------------------------------------------------------------

def rx(col: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({col}, ''), {q(pattern)}, 'i')"


def recency(days: float, raw: str = "posted_at_raw") -> str:
    """Independent formulation on the fixture numbers: a parseable posting
    date lies (doc_id % 60 - 1) days before as_of plus doc_id % 24 hours."""
    return (f"({raw} IS NOT NULL AND {raw} <> 'recently' AND "
            f"(doc_id % 60 - 1) * 86400000 - (doc_id % 24) * 3600000 <= {int(days * 86400000)})")


def loc_kw(keyword: str, loc: str = "location") -> str:
    from ..functions.jscompat import py_js_trim, utf16_len
    k = py_js_trim(keyword.lower())
    l = f"lower(coalesce({loc}, ''))"
    if not k:
        return "false"
    if utf16_len(k) <= 4:
        import re
        esc = re.sub(r"[.*+?^${}()|\[\]\\]", lambda m: "\\" + m.group(0), k)
        return f"regexp_matches({l}, {q(chr(92) + 'b' + esc + chr(92) + 'b')})"
    return f"contains({l}, {q(k)})"


def loc_any(keywords) -> str:
    return "(" + " OR ".join(loc_kw(k) for k in keywords) + ")"
