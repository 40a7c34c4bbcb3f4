"""Filters F1-F7 and limits L1/W1, against a plain model of their rules.

The rows are every combination of a few titles, departments, texts, places
and ages; a filter must keep exactly the rows that its rule, written here
in plain Python, keeps.
"""

import datetime as dt
import itertools
import re

import pytest

from boardlake.functions.jscompat import JsRegexError
from boardlake.operators.filters import apply_filters, first_n_per

NOW = dt.datetime(2031, 11, 9, 6, 30, tzinfo=dt.timezone.utc)
DDL = "n int, title string, department string, description string, location string, posted_at_raw string"

TITLES = ["Harbour Pilot", "Tug mechanic", "pilot trainee (night)", None]
TEXTS = [("Deck", "Keep the piLOT ladder dry."), ("Workshop", "Weld, bolt, paint."), (None, None)]
PLACES = ["Rotterdam", "Aruba", "Port of Ru, BA", "Baku", "RU-based, remote", "Tübingen", None, ""]
AGES = [0, 2.5, 30, -4, None, "no date"]


def stamp(age):
    if age is None or isinstance(age, str):
        return age
    return (NOW - dt.timedelta(days=age)).strftime("%Y-%m-%dT%H:%M:%S.000Z")


ROWS = [
    (n, t, d, x, p, stamp(a))
    for n, (t, (d, x), p, a) in enumerate(itertools.product(TITLES, TEXTS, PLACES, AGES))
]
AGE_OF = dict(zip(range(len(ROWS)), itertools.cycle(AGES)))


def word_or_part(word, place):
    word, place = word.strip().lower(), (place or "").lower()
    if not word:
        return False
    if len(word) > 4:
        return word in place
    return re.search(rf"(?<![A-Za-z0-9_]){re.escape(word)}(?![A-Za-z0-9_])", place) is not None


def model(title=None, topic=None, days=None, include=None, exclude=None):
    out = []
    for n, t, d, x, p, _ in ROWS:
        age = AGE_OF[n]
        hit = lambda pattern, *texts: any(re.search(pattern, s or "", re.I) for s in texts)
        if title and not hit(title, t):
            continue
        if topic and not hit(topic, t, d, x):
            continue
        if days is not None and not (isinstance(age, (int, float)) and age <= days):
            continue
        if include and not any(word_or_part(k, p) for k in include):
            continue
        if exclude and any(word_or_part(k, p) for k in exclude):
            continue
        out.append(n)
    return out


@pytest.fixture(scope="module")
def postings(spark):
    return spark.createDataFrame(ROWS, DDL).cache()


def kept(df, title=None, topic=None, days=None, include=None, exclude=None, limit=None):
    out = apply_filters(df, title, topic, days, include, exclude, limit, as_of=NOW, order_cols=("n",))
    return sorted(r["n"] for r in out.collect())


CASES = [
    {"title": "pilot"},
    {"title": "^(harbour|tug) "},
    {"title": "PILOT$"},
    {"topic": "pilot"},
    {"topic": "deck|paint"},
    {"title": "mechanic", "topic": "ladder"},
    {"days": 0},
    {"days": 2.5},
    {"days": 2.4},
    {"days": 10_000},
    {"include": ["ba"]},
    {"include": ["Ru", "aruba"]},
    {"include": [" BAKU "]},
    {"include": ["ba", ""]},
    {"exclude": ["ru"]},
    {"exclude": ["rotterdam", "tübingen"]},
    {"include": ["remote", "ba"], "exclude": ["ru-b"]},
    {"title": "pilot", "topic": "weld|night", "days": 3, "include": ["aruba", "baku", "ru"], "exclude": ["remote"]},
    {},
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: "+".join(c) or "none")
def test_keeps_what_the_rules_keep(postings, case):
    assert kept(postings, **case) == model(**case)


def test_blank_and_unlisted_keywords(postings):
    assert kept(postings, include=["  "]) == []
    everything = [r[0] for r in ROWS]
    assert kept(postings, exclude=[" ", ""]) == everything
    assert kept(postings, include=[]) == everything
    assert kept(postings, include="Baku") == everything  # no list, so no filter


def test_missing_fields_are_empty_text(postings):
    assert kept(postings, title="^$") == [r[0] for r in ROWS if r[1] is None]
    assert kept(postings, topic="^$") == [r[0] for r in ROWS if None in r[1:4]]


def test_recency_needs_a_number(postings):
    assert kept(postings, days=float("nan")) == []
    assert kept(postings, days=float("inf")) == [n for n, a in AGE_OF.items() if isinstance(a, (int, float))]
    with pytest.raises(TypeError):
        kept(postings, days="3")


def test_stored_dates_reach_the_scan(spark, tmpdir_path):
    rows = [(1, "2031-11-08T00:00:00Z"), (2, "2031-01-01T00:00:00Z"), (3, None)]
    spark.createDataFrame(rows, "n int, posted_at_raw string").selectExpr(
        "*", "cast(posted_at_raw as timestamp) AS posted_at").write.mode("overwrite").parquet(tmpdir_path + "/silver")
    df = apply_filters(spark.read.parquet(tmpdir_path + "/silver"), posted_within_days=7, limit=None, as_of=NOW)
    assert [r["n"] for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(posted_at" in plan


def test_limits(postings):
    first = [r[0] for r in ROWS]
    assert kept(postings, limit=3) == first[:3]
    assert kept(postings, limit=3.9) == first[:3]
    assert kept(postings, limit=0) == []
    assert kept(postings, title="tug", limit=2) == model(title="tug")[:2]
    default = apply_filters(postings, order_cols=("n",)).count()
    assert default == min(100, len(ROWS))
    with pytest.raises(ValueError):
        kept(postings, limit=-2)


def test_broken_pattern_fails_while_planning(postings):
    with pytest.raises(JsRegexError):
        kept(postings, title="pilot)")


def test_first_n_per_key_plans_partial_limit(spark):  # W1
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS ord")
    out = first_n_per(df, 2, ["k"], ("ord",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    rows = sorted((r["k"], r["ord"]) for r in out.collect())
    assert rows == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
