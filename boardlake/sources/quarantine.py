"""Fields whose value has a type the platform does not announce.

The adapters read such a field as NULL and keep the posting.  Here the same bodies are read as
VARIANT, and each typed field is compared with what it was read from: one row for every value
that is there but not of its type, with its place and its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .adapters import board_rows, sealed

#: For each platform and endpoint: where its postings are, and its fields that are not text
#: (text fields take any value as its text).
TYPED = {
    ("greenhouse", "board"): ("$.jobs", {"id": "integer", "internal_job_id": "integer", "location": "object", "departments": "objects", "offices": "objects"}),
    ("lever", "board"): ("$", {"createdAt": "integer", "categories": "object"}),
    ("ashby", "rest"): ("$.jobs", {"isRemote": "boolean"}),
    ("ashby", "graphql"): ("$.data.jobBoard.jobPostings", {}),
}


def _is(kind: str, schema: Column) -> Column:
    if kind == "integer":
        return schema == "BIGINT"
    if kind == "boolean":
        return schema == "BOOLEAN"
    if kind == "object":
        return schema.startswith("OBJECT<")
    return schema.startswith("ARRAY<OBJECT<") | (schema == "ARRAY<VOID>")


def quarantine(boards: DataFrame) -> DataFrame:
    """(ats, slug, endpoint, part, position, path, expected, raw): one row for each mistyped field
    of each posting of the landed rows, raw being its JSON text.

    A posting that is no object is one row, with path ``$``.  A field that is absent or null is
    not mistyped.  Rows with another status than 2xx, broken bodies and bodies without a list
    of postings have none; ``board_outcomes`` reports those.
    """
    out = None
    for (ats, endpoint), (jobs, fields) in TYPED.items():
        rows = board_rows(boards, ats, endpoint).where(F.col("http_status").between(200, 299))
        # the body counts only if it is one complete value, as for the adapters
        whole = F.try_parse_json(sealed(F.col("body"), ',"', '"]'))
        rows = rows.select("ats", "slug", "endpoint", "part", F.md5("body").alias("_md5"), F.explode(F.array(whole)).alias("_v"))
        rows = rows.where(F.coalesce(F.try_variant_get("_v", "$[1]", "string") == F.col("_md5"), F.lit(False)))
        path = jobs.replace("$", "$[0]", 1)
        rows = rows.select("ats", "slug", "endpoint", "part", F.posexplode(F.try_variant_get("_v", path, "array<variant>")).alias("position", "_job"))
        found = [_checked("$", "object", F.col("_job"))]
        found += [_checked(f, kind, F.try_variant_get("_job", f"$.{f}", "variant")) for f, kind in fields.items()]
        rows = rows.select("ats", "slug", "endpoint", "part", "position", F.explode(F.array_compact(F.array(*found))).alias("f"))
        rows = rows.select("ats", "slug", "endpoint", "part", "position", "f.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def _checked(path: str, kind: str, value: Column) -> Column:
    schema = F.schema_of_variant(value)
    bad = value.isNotNull() & ~schema.isin("VOID") & ~_is(kind, schema)
    return F.when(bad, F.struct(F.lit(path).alias("path"), F.lit(kind).alias("expected"), F.to_json(value).alias("raw")))
