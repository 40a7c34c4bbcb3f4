"""Platform adapters: landed board rows -> pre-normalised posting rows.

Each adapter works in two steps over ``raw_boards`` rows of its platform:

* ``parse_*``   one row per board part: status/body outcome and the jobs
                array (a single ``from_json`` pass over the body, which also
                finds broken bodies and text behind the JSON value);
* ``*_postings`` ``posexplode`` of the jobs of 'ok' boards into the raw
                record the normaliser expects (``PRE_NORMALISED_COLS``).

Outcomes: 'ok', 'not_found' (404, or a platform's "empty" status),
'error' (transport failure, other statuses, malformed body).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jscompat import truthy_or
from ..functions.text import (
    ashby_compensation,
    lever_title_salary,
    null_salary,
    title_case_slug,
)
from .boards import status_outcome
from .schemas import (
    ASHBY_GRAPHQL_DDL,
    ASHBY_GRAPHQL_JOB_DDL,
    ASHBY_REST_DDL,
    ASHBY_REST_JOB_DDL,
    ATS_DISPLAY,
    ATS_ORD,
    GREENHOUSE_DDL,
    GREENHOUSE_JOB_DDL,
    LEVER_JOB_DDL,
    METADATA_TYPE,
    MSG_BOARD_ERROR,
    MSG_UNKNOWN_ATS,
    PRE_NORMALISED_COLS,
)

# The public posting URL prefix of Ashby boards.
ASHBY_JOB_URL = "https://jobs.ashbyhq.com/"

# JavaScript Date range (+-8.64e15 ms); beyond it the posting date is NULL.
_MAX_EPOCH_MS = 8_640_000_000_000_000

_BOARD_KEYS = ("ats", "slug", "endpoint", "part", "http_status")


def board_rows(raw_boards: DataFrame, ats: str, endpoint: str) -> DataFrame:
    return raw_boards.where((F.col("ats") == ats) & (F.col("endpoint") == endpoint))


def _parse_once(b: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Attach ``name`` = parsed body, evaluated once per row.

    Going through a one-element ``explode`` keeps the optimiser from
    rewriting every later field access into a separate (pruned) from_json,
    which would parse each body once per field."""
    return b.select("*", F.explode(F.array(parsed)).alias(name))


def sealed(body: Column, seal: str, closing: str) -> Column:
    """The body as first element of a JSON array whose second one holds the
    body's own hash.  Spark's parser ignores what follows a complete value;
    here the body is complete and alone exactly when the array has two
    elements and the second one is the seal."""
    return F.concat(F.lit("["), body, F.lit(seal), F.md5(body), F.lit(closing))


def _parse_body(b: DataFrame, ddl: str, jobs_path: tuple[str, ...], job_ddl: str) -> DataFrame:
    """Parse object bodies: ``_p`` (the typed body), ``_jobs`` and ``_body_ok``.

    One typed parse decides everything for almost all bodies.  A field of an
    unexpected type becomes NULL and its posting stays.  Only a body that is
    no object, or whose jobs are not all objects, is read a second time, as a
    VARIANT: elements of any type then count as postings without fields.
    Any complete JSON value but null is an empty board, as for JavaScript's
    property access; null, a broken body or text behind it are errors.
    """
    body = F.col("body")
    b = _parse_once(b, F.from_json(sealed(body, ',{"_seal":"', '"}]'), f"ARRAY<STRUCT<{ddl}, _seal STRING>>"), "_a")
    whole = F.coalesce((F.size("_a") == 2) & (F.get("_a", 1)["_seal"] == F.md5(body)), F.lit(False))
    jobs = F.get("_a", 0)
    for key in jobs_path:
        jobs = jobs[key]
    again = ~whole | (jobs.isNull() & F.get("_a", 0).isNotNull())
    b = _parse_once(b, F.when(again, F.try_parse_json(sealed(body, ',"', '"]'))), "_v")
    valid = whole | F.coalesce(F.try_variant_get("_v", "$[1]", "string") == F.md5(body), F.lit(False))
    loose = F.transform(
        F.try_variant_get("_v", "$[0]." + ".".join(jobs_path), "array<variant>"),
        lambda x: F.from_json(F.to_json(x), f"STRUCT<{job_ddl}>"),
    )
    # JSON allows blanks, tabs and line ends around a value
    ok = F.coalesce(valid & (F.regexp_replace(body, r"^[ \t\r\n]+|[ \t\r\n]+$", "") != "null"), F.lit(False))
    return b.select("*", F.get("_a", 0).alias("_p"), F.when(ok, F.coalesce(F.when(whole, jobs), loose, F.array())).alias("_jobs"), ok.alias("_body_ok"))


def parse_greenhouse(raw_boards: DataFrame, keep: tuple = ()) -> DataFrame:
    b = board_rows(raw_boards, "greenhouse", "board")
    b = _parse_body(b, GREENHOUSE_DDL, ("jobs",), GREENHOUSE_JOB_DDL)
    body_ok = F.col("_body_ok")
    outcome = F.coalesce(status_outcome(F.col("http_status")), F.when(body_ok, F.lit("ok")).otherwise(F.lit("error")))
    return b.select(
        *_BOARD_KEYS,
        *keep,
        outcome.alias("outcome"),
        F.col("_p.name").alias("board_name"),
        F.when(outcome == "ok", F.col("_jobs")).alias("jobs"),
    )


def parse_lever(raw_boards: DataFrame, keep: tuple = ()) -> DataFrame:
    b = board_rows(raw_boards, "lever", "board")
    body = F.col("body")
    b = _parse_once(b, F.from_json(sealed(body, ',[{"_seal":"', '"}]]'), f"ARRAY<ARRAY<STRUCT<{LEVER_JOB_DDL}, _seal STRING>>>"), "_a")
    whole = F.coalesce((F.size("_a") == 2) & (F.get(F.get("_a", 1), 0)["_seal"] == F.md5(body)), F.lit(False))
    # a JSON body that is no array is a valid, empty board; a broken body is an error
    b = _parse_once(b, F.when(~whole, F.try_parse_json(sealed(body, ',"', '"]'))), "_v")
    body_ok = whole | F.coalesce(F.try_variant_get("_v", "$[1]", "string") == F.md5(body), F.lit(False))
    loose = F.transform(
        F.try_variant_get("_v", "$[0]", "array<variant>"),
        lambda x: F.from_json(F.to_json(x), f"STRUCT<{LEVER_JOB_DDL}, _seal STRING>"),
    )
    outcome = F.coalesce(status_outcome(F.col("http_status")), F.when(body_ok, F.lit("ok")).otherwise(F.lit("error")))
    return b.select(
        *_BOARD_KEYS,
        *keep,
        outcome.alias("outcome"),
        F.lit(None).cast("string").alias("board_name"),
        F.when(outcome == "ok", F.coalesce(F.when(whole, F.get("_a", 0)), loose, F.array())).alias("jobs"),
    )


def parse_ashby_rest(raw_boards: DataFrame, keep: tuple = ()) -> DataFrame:
    b = board_rows(raw_boards, "ashby", "rest")
    b = _parse_body(b, ASHBY_REST_DDL, ("jobs",), ASHBY_REST_JOB_DDL)
    body_ok = F.col("_body_ok")
    outcome = F.coalesce(status_outcome(F.col("http_status")), F.when(body_ok, F.lit("ok")).otherwise(F.lit("error")))
    return b.select(
        *_BOARD_KEYS,
        *keep,
        outcome.alias("outcome"),
        F.col("_p.organizationName").alias("board_name"),
        F.when(outcome == "ok", F.col("_jobs")).alias("jobs"),
    )


def parse_ashby_graphql(raw_boards: DataFrame, keep: tuple = ()) -> DataFrame:
    b = board_rows(raw_boards, "ashby", "graphql")
    b = _parse_body(b, ASHBY_GRAPHQL_DDL, ("data", "jobBoard", "jobPostings"), ASHBY_GRAPHQL_JOB_DDL)
    body_ok = F.col("_body_ok")
    # every non-2xx GraphQL answer is an empty board, not an error
    outcome = F.coalesce(
        status_outcome(F.col("http_status"), non_ok_is_empty=True),
        F.when(body_ok, F.lit("ok")).otherwise(F.lit("error")),
    )
    board = F.col("_p.data.jobBoard")
    return b.select(
        *_BOARD_KEYS,
        *keep,
        outcome.alias("outcome"),
        board["title"].alias("board_name"),
        F.when(outcome == "ok", F.col("_jobs")).alias("jobs"),
    )


def _checked(parsed: DataFrame, strict: Column | None) -> DataFrame:
    """Fail the query on the first failed board for which ``strict`` holds."""
    if strict is None:
        return parsed
    name = F.create_map(*(F.lit(x) for kv in ATS_DISPLAY.items() for x in kv))[F.col("ats")]
    status = F.when(F.col("http_status").between(200, 299), F.lit("malformed body")).otherwise(
        F.coalesce(F.col("http_status").cast("string"), F.lit("no response")))
    message = F.lit(MSG_BOARD_ERROR)
    for key, value in (("{platform}", name), ("{slug}", F.col("slug")), ("{status}", status)):
        message = F.replace(message, F.lit(key), F.coalesce(value, F.lit("")))
    failed = (F.col("outcome") == "error") & strict
    return parsed.withColumn("outcome", F.when(failed, F.raise_error(message).cast("string")).otherwise(F.col("outcome")))


def _explode(parsed: DataFrame, keep: tuple = ()) -> DataFrame:
    return parsed.where(F.col("outcome") == "ok").select(
        "ats", "slug", "part", *keep, "board_name", F.posexplode("jobs").alias("pos", "job")
    )


def _metadata(**fields) -> Column:
    cols = []
    for f in METADATA_TYPE.fields:
        c = fields.get(f.name)
        cols.append((c if c is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def _pre(ats: str, keep: tuple = (), **cols) -> list[Column]:
    base = {
        "ats": F.lit(ats),
        "ats_ord": F.lit(ATS_ORD[ats]),
        "company_slug": F.col("slug"),
        "board_part": F.coalesce(F.col("part"), F.lit(0)).cast("int"),
        "posting_pos": F.col("pos").cast("int"),
    }
    base.update(cols)
    return [F.col(k) for k in keep] + [base[name].alias(name) for name in PRE_NORMALISED_COLS]


def greenhouse_postings(raw_boards: DataFrame, keep: tuple = (), strict: Column | None = None) -> DataFrame:
    j = F.col("job")
    rows = _explode(_checked(parse_greenhouse(raw_boards, keep), strict), keep)
    return rows.select(
        *_pre(
            "greenhouse",
            keep,
            company=truthy_or(F.col("board_name"), F.col("slug")),
            title=truthy_or(j["title"], F.lit("")),
            department=truthy_or(F.get(j["departments"], 0)["name"], F.lit("")),
            location=truthy_or(j["location"]["name"], F.lit("")),
            # HTML as landed; the normaliser cleans it twice
            description=j["content"],
            url=truthy_or(j["absolute_url"], F.lit("")),
            posted_at_raw=F.nullif(j["updated_at"], F.lit("")),
            salary=null_salary(),
            metadata=_metadata(
                greenhouseId=j["id"],
                internal_job_id=j["internal_job_id"],
                departments=F.coalesce(F.transform(j["departments"], lambda d: d["name"]), F.array()),
                offices=F.coalesce(F.transform(j["offices"], lambda o: o["name"]), F.array()),
            ),
        )
    )


def _iso_from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-ddTHH:mm:ss.SSSZ' (UTC), independent of
    the session time zone; 0/NULL/out of range -> NULL."""
    ntz = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    ts = F.timestamp_add("MILLISECOND", ms, ntz)
    good = ms.isNotNull() & (ms != 0) & (F.abs(ms) <= F.lit(_MAX_EPOCH_MS))
    return F.when(good, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def lever_postings(raw_boards: DataFrame, keep: tuple = (), strict: Column | None = None) -> DataFrame:
    j = F.col("job")
    cat = j["categories"]
    rows = _explode(_checked(parse_lever(raw_boards, keep), strict), keep)
    return rows.select(
        *_pre(
            "lever",
            keep,
            company=title_case_slug(F.col("slug")),
            title=truthy_or(j["text"], F.lit("")),
            department=truthy_or(cat["department"], cat["team"], F.lit("")),
            location=truthy_or(cat["location"], F.lit("")),
            description=truthy_or(j["descriptionPlain"], j["description"], F.lit("")),
            url=truthy_or(j["hostedUrl"], F.lit("")),
            posted_at_raw=_iso_from_epoch_ms(j["createdAt"]),
            salary=lever_title_salary(j["text"]),
            metadata=_metadata(
                leverId=j["id"],
                team=truthy_or(cat["team"], F.lit("")),
                commitment=truthy_or(cat["commitment"], F.lit("")),
                workplaceType=truthy_or(j["workplaceType"], F.lit("")),
            ),
        )
    )


def _ashby_url(job_id: Column) -> Column:
    return F.concat(F.lit(ASHBY_JOB_URL), F.col("slug"), F.lit("/"), F.coalesce(job_id, F.lit("undefined")))


def ashby_rest_postings(parsed_rest: DataFrame, keep: tuple = ()) -> DataFrame:
    j = F.col("job")
    return _explode(parsed_rest, keep).select(
        *_pre(
            "ashby",
            keep,
            company=truthy_or(F.col("board_name"), F.col("slug")),
            title=truthy_or(j["title"], F.lit("")),
            department=truthy_or(j["departmentName"], F.lit("")),
            location=truthy_or(j["location"], F.lit("")),
            # handed over as HTML: salary text is searched before cleaning
            description=truthy_or(j["descriptionHtml"], j["descriptionPlain"], F.lit("")),
            url=_ashby_url(j["id"]),
            posted_at_raw=F.nullif(j["publishedAt"], F.lit("")),
            salary=ashby_compensation(j["compensation"]),
            metadata=_metadata(
                ashbyId=j["id"],
                employmentType=truthy_or(j["employmentType"], F.lit("")),
                isRemote=F.coalesce(j["isRemote"], F.lit(False)),
                team=truthy_or(j["teamName"], F.lit("")),
            ),
        )
    )


def ashby_graphql_postings(parsed_graphql: DataFrame, keep: tuple = ()) -> DataFrame:
    j = F.col("job")
    return _explode(parsed_graphql, keep).select(
        *_pre(
            "ashby",
            keep,
            company=truthy_or(F.col("board_name"), F.col("slug")),
            title=truthy_or(j["title"], F.lit("")),
            department=F.lit(""),
            location=truthy_or(j["locationName"], F.lit("")),
            description=truthy_or(j["descriptionHtml"], F.lit("")),
            url=_ashby_url(j["id"]),
            posted_at_raw=F.nullif(j["publishedDate"], F.lit("")),
            salary=null_salary(),
            metadata=_metadata(
                ashbyId=j["id"],
                employmentType=truthy_or(j["employmentType"], F.lit("")),
                compensationSummary=truthy_or(j["compensationTierSummary"], F.lit("")),
            ),
        )
    )


def ashby_rest_nonempty_slugs(raw_boards: DataFrame, by: tuple = ("slug",)) -> DataFrame:
    """Slugs (or other keys ``by``) whose REST board has at least one posting (in any part).

    The same decision as the full parse takes: 2xx, one complete JSON object
    and nothing behind it, and a ``jobs`` array with an element of whatever
    type; anything else counts as empty, which triggers the fallback.  The
    elements are not typed here, only skipped over as text."""
    rest = board_rows(raw_boards, "ashby", "rest").where(F.col("http_status").between(200, 299))
    rest = _parse_once(rest.select(*by, "body"), F.from_json(sealed(F.col("body"), ',{"_seal":"', '"}]'),
                                                               "ARRAY<STRUCT<jobs ARRAY<STRING>, _seal STRING>>"), "_a")
    whole = (F.size("_a") == 2) & (F.get("_a", 1)["_seal"] == F.md5("body"))
    return rest.where(whole & (F.size(F.get("_a", 0)["jobs"]) > 0)).select(*by).distinct()


def ashby_postings(raw_boards: DataFrame, keep: tuple = (), strict: Column | None = None, fallback: bool = True, by: tuple = ("slug",)) -> DataFrame:
    """REST first; GraphQL only for slugs whose REST gave zero postings or
    failed.  The anti-join runs on raw board rows, before GraphQL is parsed;
    with ``fallback=False`` the caller has taken the unread rows out.
    A failed REST board is no error, whatever ``strict`` says.  ``by`` names
    the columns that tell boards apart, for several fetches of one company."""
    rest = parse_ashby_rest(raw_boards, keep)
    graphql = board_rows(raw_boards, "ashby", "graphql")
    if fallback:
        graphql = graphql.join(ashby_rest_nonempty_slugs(raw_boards, by), list(by), "left_anti")
    graphql = parse_ashby_graphql(graphql, keep)
    return ashby_rest_postings(rest, keep).unionByName(ashby_graphql_postings(_checked(graphql, strict), keep))


def board_outcomes(raw_boards: DataFrame, keep: tuple = ()) -> DataFrame:
    """Outcome and posting count of every landed board part."""
    parts = [fn(raw_boards, keep) for fn in (parse_greenhouse, parse_lever, parse_ashby_rest, parse_ashby_graphql)]
    out = None
    for p in parts:
        p = p.select(*_BOARD_KEYS, *keep, "outcome", F.coalesce(F.size("jobs"), F.lit(0)).cast("int").alias("n_jobs"))
        out = p if out is None else out.unionByName(p)
    return out


# name -> fn(raw_boards) -> pre-normalised rows.  Unknown names are an error.
ADAPTERS = {
    "greenhouse": greenhouse_postings,
    "lever": lever_postings,
    "ashby": ashby_postings,
}


def adapter(name: str):
    try:
        return ADAPTERS[name]
    except KeyError:
        raise ValueError(MSG_UNKNOWN_ATS.format(ats=name, supported=", ".join(ADAPTERS))) from None


def all_postings(raw_boards: DataFrame, keep: tuple = (), strict: Column | None = None, fallback: bool = True, by: tuple = ("slug",)) -> DataFrame:
    """Bag union of every platform's postings.  Failed boards contribute none,
    or fail the query where the condition ``strict`` holds for their row.
    ``fallback`` and ``by`` as in ``ashby_postings``."""
    out = None
    for name, fn in ADAPTERS.items():
        df = fn(raw_boards, keep, strict, fallback, by) if name == "ashby" else fn(raw_boards, keep, strict)
        out = df if out is None else out.unionByName(df)
    return out
