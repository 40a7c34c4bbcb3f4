"""Column-expression builders for posting text: HTML cleaning, location
class, salary extraction, stable ids and slugs.

Every function returns a plain Spark ``Column`` made of built-in
expressions, so it stays inside whole-stage codegen and can be used in any
``select`` / ``where`` / SQL view.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jscompat import WS, col_of, js_trim, let, truthy_or

# The ordered HTML -> text rewrite chain of the posting
# normaliser.  (pattern, replacement, case_insensitive).  Order matters:
# &amp; is decoded before &lt;/&gt; so "&amp;lt;" ends up as "<".
HTML_REWRITES = (
    (r"<br" + WS + r"*/?>", "\n", True),
    (r"</p>", "\n\n", True),
    (r"</li>", "\n", True),
    (r"<li>", "- ", True),
    (r"</h[1-6]>", "\n\n", True),
    (r"<h[1-6][^>]*>", "## ", True),
    (r"<[^>]+>", "", False),
    (r"&amp;", "&", False),
    (r"&lt;", "<", False),
    (r"&gt;", ">", False),
    (r"&nbsp;", " ", False),
    (r"&#\d+;", "", False),
    (r"\n{3,}", "\n\n", False),
)

# Location class keywords, tested in this order.
LOCATION_CLASSES = (
    ("remote", "remote"),
    ("hybrid", "hybrid"),
    ("on-?site", "onsite"),
)

# Salary phrase shapes.
SALARY_FULL = r"\$([\d,]+)" + WS + r"*[-–]" + WS + r"*\$([\d,]+)"
SALARY_K = r"\$(\d+)[kK]" + WS + r"*[-–]" + WS + r"*\$(\d+)[kK]"
SALARY_ASHBY = r"\$?([\d,]+)" + WS + r"*[-–]" + WS + r"*\$?([\d,]+)"

SALARY_TYPE = "struct<min:double,max:double,currency:string>"


def strip_html(c) -> Column:
    """HTML -> plain text with the normaliser's 13 ordered rewrites + JS trim.

    NULL and '' both give ''.
    """
    out = F.coalesce(col_of(c), F.lit(""))
    # a group of rewrites runs only on texts with the character all of them need
    for needed, rewrites in (("<", HTML_REWRITES[:7]), ("&", HTML_REWRITES[7:12]), ("\n\n\n", HTML_REWRITES[12:])):
        out = _guarded(out, needed, rewrites)
    return js_trim(out)


def _guarded(text: Column, needed: str, rewrites) -> Column:
    return let(text, lambda x: F.when(F.contains(x, F.lit(needed)), _rewritten(x, rewrites)).otherwise(x))


def _rewritten(x: Column, rewrites) -> Column:
    for pattern, repl, ci in rewrites:
        x = F.regexp_replace(x, ("(?i)" if ci else "") + pattern, repl)
    return x


def location_type(location) -> Column:
    """remote > hybrid > onsite keyword, else 'onsite' when non-empty, else 'unknown'."""
    loc = F.coalesce(col_of(location), F.lit(""))
    expr = F.when(loc.rlike("(?iu)remote"), "remote")
    for pattern, label in LOCATION_CLASSES[1:]:
        expr = expr.when(loc.rlike("(?iu)" + pattern), label)
    return expr.when(loc != "", "onsite").otherwise("unknown")


def _num(g: Column) -> Column:
    return F.regexp_replace(g, ",", "").try_cast("double")


def salary_struct(min_c: Column, max_c: Column, currency: Column | None = None) -> Column:
    return F.struct(
        min_c.cast("double").alias("min"),
        max_c.cast("double").alias("max"),
        (currency if currency is not None else F.lit("USD")).alias("currency"),
    )


def null_salary() -> Column:
    return F.lit(None).cast(SALARY_TYPE)


def _range(found: Column, shape: str, times: int = 1) -> Column:
    """The two amounts of a matched phrase, which is short."""
    low, high = (_num(F.regexp_extract(found, shape, k)) for k in (1, 2))
    return salary_struct(low * times, high * times) if times != 1 else salary_struct(low, high)


def salary_from_full_range(text) -> Column:
    """'$A - $B' (commas allowed, '-' or en dash).  NULL when no match."""
    t = F.coalesce(col_of(text), F.lit(""))
    return let(F.regexp_substr(t, F.lit(SALARY_FULL)), lambda m: F.when(m.isNotNull(), _range(m, SALARY_FULL)).otherwise(null_salary()))


def salary_from_k_range(text) -> Column:
    """'$aK - $bK' times 1000.  NULL when no match."""
    t = F.coalesce(col_of(text), F.lit(""))
    return let(F.regexp_substr(t, F.lit(SALARY_K)), lambda m: F.when(m.isNotNull(), _range(m, SALARY_K, 1000)).otherwise(null_salary()))


def salary_from_text(text) -> Column:
    """Full form first; the K form only when the full *pattern* does not match.
    The text is searched once for each form, and amounts are read from the
    short phrase found."""
    t = F.coalesce(col_of(text), F.lit(""))
    return let(F.regexp_substr(t, F.lit(SALARY_FULL)),
               lambda m: F.when(m.isNotNull(), _range(m, SALARY_FULL)).otherwise(salary_from_k_range(t)))


def lever_title_salary(title) -> Column:
    """Lever has no salary field; a '$A - $B' in the title is used."""
    return salary_from_full_range(title)


def ashby_compensation(comp) -> Column:
    """Ashby compensation as parsed from JSON into a VARIANT.

    string  -> '$?A - $?B' parsed (commas allowed), else NULL
    object  -> {min, max, currency||'USD'} when min and max are truthy
    other   -> NULL
    """
    v = col_of(comp)
    kind = F.schema_of_variant(v)
    s = F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))
    mn = F.try_variant_get(v, "$.min", "double")
    mx = F.try_variant_get(v, "$.max", "double")
    cur = F.coalesce(F.nullif(F.try_variant_get(v, "$.currency", "string"), F.lit("")), F.lit("USD"))
    from_string = F.when(
        s.rlike(SALARY_ASHBY),
        salary_struct(_num(F.regexp_extract(s, SALARY_ASHBY, 1)), _num(F.regexp_extract(s, SALARY_ASHBY, 2))),
    )
    from_object = F.when((F.coalesce(mn, F.lit(0.0)) != 0) & (F.coalesce(mx, F.lit(0.0)) != 0), salary_struct(mn, mx, cur))
    return (
        F.when(v.isNull(), null_salary())
        .when(kind == "STRING", from_string)
        .when(kind.startswith("OBJECT"), from_object)
        .otherwise(null_salary())
    )


def job_id(company, title, ats) -> Column:
    """First 12 hex chars of md5(lower(trim(company|title|ats))).

    Missing values stringify as 'undefined' like a JavaScript template.
    """
    raw = F.concat(
        F.coalesce(col_of(company), F.lit("undefined")),
        F.lit("|"),
        F.coalesce(col_of(title), F.lit("undefined")),
        F.lit("|"),
        F.coalesce(col_of(ats), F.lit("undefined")),
    )
    return F.substring(F.md5(js_trim(F.lower(raw))), 1, 12)


def slugify(c) -> Column:
    """Company name/slug -> slug: lower-case, keep only [a-z0-9]."""
    return F.regexp_replace(F.lower(F.coalesce(col_of(c), F.lit(""))), "[^a-z0-9]", "")


def title_case_slug(c) -> Column:
    """Upper-case the first character only ('bluepine' -> 'Bluepine')."""
    s = F.coalesce(col_of(c), F.lit(""))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def id_company(company, company_slug) -> Column:
    """The company operand of the id: company || companySlug (JS truthiness)."""
    return truthy_or(company, F.coalesce(col_of(company_slug), F.lit("undefined")))
