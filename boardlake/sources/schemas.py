"""Schemas of the landed data and of the normalised postings table."""

from __future__ import annotations

from pyspark.sql import types as T

# The supported applicant-tracking systems, in source order.
ATS_NAMES = ("greenhouse", "lever", "ashby")
ATS_ORD = {name: i for i, name in enumerate(ATS_NAMES)}
ATS_DISPLAY = {"greenhouse": "Greenhouse", "lever": "Lever", "ashby": "Ashby"}
MSG_BOARD_ERROR = "{platform} API error for {slug}: {status}"

# Argument-check messages.
MSG_COMPANY_REQUIRED = "Company slug required"
MSG_UNKNOWN_ATS = "Unknown ATS: {ats}. Supported: {supported}"
MSG_QUERY_OR_SECTOR = "Provide query or sector"
MSG_KEYWORD_REQUIRED = "Keyword required"

# One row per landed HTTP response (or part of one, see README).
#   endpoint: 'board' (greenhouse, lever), 'rest' / 'graphql' (ashby), 'probe' (HEAD)
#   http_status NULL = transport failure
#   optional: fetch_id STRING, shared by all parts of one fetch, and n_parts INT, their number
RAW_BOARDS_DDL = (
    "ats STRING, slug STRING, endpoint STRING, part INT, http_status INT, "
    "fetched_at TIMESTAMP, body STRING"
)

REGISTRY_DDL = "slug STRING, name STRING, sector STRING"

# Wire schemas passed to from_json.  Field names are the platforms' own.
GREENHOUSE_JOB_DDL = (
    "id BIGINT, internal_job_id BIGINT, title STRING, "
    "updated_at STRING, absolute_url STRING, location STRUCT<name STRING>, "
    "departments ARRAY<STRUCT<name STRING>>, offices ARRAY<STRUCT<name STRING>>, content STRING"
)
GREENHOUSE_DDL = f"name STRING, jobs ARRAY<STRUCT<{GREENHOUSE_JOB_DDL}>>"
LEVER_JOB_DDL = (
    "id STRING, text STRING, hostedUrl STRING, createdAt BIGINT, "
    "descriptionPlain STRING, description STRING, "
    "categories STRUCT<department STRING, team STRING, location STRING, commitment STRING>, "
    "workplaceType STRING"
)
ASHBY_REST_JOB_DDL = (
    "id STRING, title STRING, departmentName STRING, "
    "location STRING, descriptionHtml STRING, descriptionPlain STRING, publishedAt STRING, "
    "employmentType STRING, isRemote BOOLEAN, teamName STRING, compensation VARIANT"
)
ASHBY_REST_DDL = f"organizationName STRING, jobs ARRAY<STRUCT<{ASHBY_REST_JOB_DDL}>>"
ASHBY_GRAPHQL_JOB_DDL = (
    "id STRING, title STRING, locationName STRING, employmentType STRING, "
    "descriptionHtml STRING, publishedDate STRING, compensationTierSummary STRING"
)
ASHBY_GRAPHQL_DDL = f"data STRUCT<jobBoard STRUCT<title STRING, jobPostings ARRAY<STRUCT<{ASHBY_GRAPHQL_JOB_DDL}>>>>"

# Superset of the per-platform metadata (keys as the platforms' tools emit them).
METADATA_TYPE = T.StructType(
    [
        T.StructField("greenhouseId", T.LongType()),
        T.StructField("internal_job_id", T.LongType()),
        T.StructField("departments", T.ArrayType(T.StringType())),
        T.StructField("offices", T.ArrayType(T.StringType())),
        T.StructField("leverId", T.StringType()),
        T.StructField("ashbyId", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("commitment", T.StringType()),
        T.StructField("workplaceType", T.StringType()),
        T.StructField("employmentType", T.StringType()),
        T.StructField("isRemote", T.BooleanType()),
        T.StructField("compensationSummary", T.StringType()),
    ]
)

# Columns every adapter hands to the normaliser (the "raw" record).
PRE_NORMALISED_COLS = (
    "ats", "ats_ord", "company_slug", "board_part", "posting_pos", "company", "title",
    "department", "location", "description", "url", "posted_at_raw", "salary", "metadata",
)

# The normalised postings table, in output order.
POSTING_COLS = (
    "id", "company", "company_slug", "ats", "title", "department", "location",
    "location_type", "salary", "description", "url", "posted_at_raw", "posted_at",
    "first_seen", "last_seen", "status", "metadata", "ats_ord", "board_part", "posting_pos",
)

# Source order of postings: registry ATS order, then board array order.
ORDER_COLS = ("ats_ord", "board_part", "posting_pos")
