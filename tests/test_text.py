"""Posting text rules: HTML cleaning, ids, location class, salary, slugs."""

import re

from pyspark.sql import functions as F

from boardlake.functions.text import (
    ashby_compensation,
    job_id,
    lever_title_salary,
    location_type,
    salary_from_text,
    slugify,
    strip_html,
    title_case_slug,
)
from evaluate import one


def s(spark, v):
    return one(spark, strip_html("x"), v)


def test_tags_leave_their_text(spark):
    assert s(spark, "<div><em>Tide</em> <u>tables</u></div>") == "Tide tables"
    assert s(spark, "<li>ropes</li><li>nets</li>") == "- ropes\n- nets"


def test_entities_are_decoded_once(spark):
    assert s(spark, "salt &amp; sand, 3 &lt; 4 &gt; 2") == "salt & sand, 3 < 4 > 2"


def test_nothing_gives_empty_text(spark):
    assert [s(spark, v) for v in (None, "", " \u00a0\n", "<p></p>")] == [""] * 4


def test_strip_details(spark):  # T13
    assert s(spark, '<li class="x">a</li>') == "a"  # only a bare <li> becomes a bullet
    assert s(spark, '<h2 id="a">T</h2>body') == "## T\n\nbody"
    assert s(spark, "<script>var a=1;</script>x") == "var a=1;x"
    assert s(spark, "&amp;lt;b&amp;gt;") == "<b>"
    assert s(spark, "don&#39;t &#x27; &quot;") == "dont &#x27; &quot;"
    assert s(spark, "a<br class='c'>b<BR/>c") == "ab\nc"
    assert s(spark, "a\n\n\n\nb") == "a\n\nb"
    assert s(spark, "&nbsp;x&nbsp;") == "x"


def test_strip_twice_decodes_escaped_html(spark):
    v = "&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;"
    twice = one(spark, strip_html(strip_html("x")), v)
    assert twice == "Hi & bye"


def test_job_id_depends_on_all_parts_but_not_on_case(spark):
    base = ("Reef Works", "Diver", "lever")
    make = lambda *x: one(spark, job_id(*map(F.lit, x)), "")
    same = make(*(x.upper() for x in base))
    assert make(*base) == same and re.fullmatch("[0-9a-f]{12}", same)
    others = {make(*(x + "x" if k == j else x for j, x in enumerate(base))) for k in range(3)}
    assert len(others | {same}) == 4


def test_job_id_matches_md5_of_joined_text(spark):  # T11
    import hashlib

    got = one(spark, job_id(F.lit(" Acme"), F.lit(None).cast("string"), F.lit("lever")), "")
    assert got == hashlib.md5("acme|undefined|lever".encode()).hexdigest()[:12]


def test_location_type(spark):  # T24
    lt = lambda v: one(spark, location_type("x"), v)
    assert lt("US (remote)") == "remote"
    assert lt("Lyon, hybrid") == "hybrid"
    assert lt("On-site, Kassel") == "onsite"
    assert lt("Onsite") == "onsite"
    assert lt("Kassel") == "onsite"
    assert lt("") == "unknown"
    assert lt(None) == "unknown"
    assert lt("Remote or hybrid") == "remote"


def sal(spark, expr, v):
    r = one(spark, expr, v)
    return None if r is None else (r["min"], r["max"], r["currency"])


def test_salary_full_and_k(spark):
    f = salary_from_text("x")
    assert sal(spark, f, "We pay $61,300 - $74,900 a year.") == (61300.0, 74900.0, "USD")
    assert sal(spark, f, "$88K–$97k") == (88000.0, 97000.0, "USD")
    assert sal(spark, f, "no dollars here") is None
    assert sal(spark, f, None) is None


def test_salary_quirks(spark):  # T25
    f = salary_from_text("x")
    assert sal(spark, f, "$88 - $97K") == (88.0, 97.0, "USD")
    assert sal(spark, f, "$50 - $60 an hour") == (50.0, 60.0, "USD")
    assert sal(spark, f, "$61,300.00 - $74,900.00") is None
    assert sal(spark, f, "$61,300 — $74,900") is None  # em dash
    assert sal(spark, f, "$, - $,") == (None, None, "USD")
    assert sal(spark, f, "$1 - $2") == (1.0, 2.0, "USD")


def test_lever_title_salary(spark):
    f = lever_title_salary("x")
    assert sal(spark, f, "Diver ($52,000 - $58,500)") == (52000.0, 58500.0, "USD")
    assert sal(spark, f, "Diver") is None


def test_ashby_compensation(spark):
    f = ashby_compensation(F.parse_json("x"))
    assert sal(spark, f, '"$43,210 - $54,321"') == (43210.0, 54321.0, "USD")
    assert sal(spark, f, '"43,210 – 54,321"') == (43210.0, 54321.0, "USD")
    assert sal(spark, f, '{"min": 7100, "max": 8850, "currency": "CHF"}') == (7100.0, 8850.0, "CHF")
    assert sal(spark, f, '{"min": 1.5, "max": 2.5}') == (1.5, 2.5, "USD")
    assert sal(spark, f, '{"min": 0, "max": 5}') is None
    assert sal(spark, f, '"By agreement"') is None
    assert sal(spark, f, '""') is None
    assert sal(spark, f, "null") is None
    assert sal(spark, f, "5") is None


def test_slugify_and_title_case(spark):
    assert one(spark, slugify("x"), "Blue-Pine & Co.") == "bluepineco"
    assert one(spark, slugify("x"), "Src-7 ") == "src7"
    assert one(spark, title_case_slug("x"), "bluepine") == "Bluepine"
    assert one(spark, title_case_slug("x"), "") == ""


def test_cleaning_expression_size_is_linear(spark):
    """Nesting the cleaning must not duplicate its input expression:
    twice-cleaned text is exactly 2 x 13 rewrites."""
    df = spark.createDataFrame([("<p>x</p>",)], "x string").select(strip_html(strip_html("x")).alias("y"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 26


def test_dates_as_javascript_reads_them(spark):
    from boardlake.functions.dates import js_timestamp

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")  # UTC-5
    try:
        texts = ["2031-05-06", "2031-05", "2031", "2031-05-06T07:08:09Z", "2031-05-06T02:00", "May 6, 2031", "6 May 2031 02:00",
                 "Tue, 06 May 2031 07:08:09 GMT", "06 may 2031 10:08:09 +0300", "March 4, 2031", "soon", "", None, "2031-13-45"]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        got = [r["ms"] for r in df.select("i", F.unix_millis(js_timestamp("x")).alias("ms")).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    import datetime as dt

    ms = lambda *x: int(dt.datetime(*x, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert got == [ms(2031, 5, 6), ms(2031, 5, 1), ms(2031, 1, 1), ms(2031, 5, 6, 7, 8, 9), ms(2031, 5, 6, 7), ms(2031, 5, 6, 5),
                   ms(2031, 5, 6, 7), ms(2031, 5, 6, 7, 8, 9), ms(2031, 5, 6, 7, 8, 9), ms(2031, 3, 4, 5), None, None, None, None]


def test_amounts_keep_up_to_three_decimals(spark):
    from boardlake.operators.summary import _fmt_amount

    got = [one(spark, _fmt_amount(F.col("x")), v, "x double") for v in (85.5, 1234567.0, 0.1256, 100.0, float("nan"), None)]
    assert got == ["85.5", "1,234,567", "0.126", "100", "NaN", "NaN"]
