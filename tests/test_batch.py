"""Many saved filters and many registry searches at once, against one at a time."""

import random
import re

import pytest
from pyspark.sql import functions as F

from boardlake.functions.grams import required_literals
from boardlake.functions.jscompat import JsRegexError
from boardlake.operators import batch
from boardlake.operators.filters import apply_filters
from boardlake.operators.registry_ops import search_registry_tool

DDL = "n int, ats_ord int, board_part int, posting_pos int, company_slug string, title string, department string, location string, description string, posted_at_raw string"
WORDS = ["Anchor", "anchorage", "Keel", "KELP", "Mast 2", "sſail", "Keel", "Rİg", "c++", "a.b", "Bow/Stern", "", "é"]


@pytest.fixture(scope="module")
def postings(spark):
    rng = random.Random(3)
    text = lambda k: None if rng.random() < 0.1 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, k)))
    rows = [(i, i % 3, i // 50, i, f"c{i % 4}", text(3), text(2), text(2), text(12), rng.choice([None, "2030-01-05T00:00:00Z", "2029-12-01", "soon"])) for i in range(300)]
    return spark.createDataFrame(rows, DDL).cache()


FILTERS = {
    "lit": {"title_filter": "anchor|keel"},
    "short": {"title_filter": "ma?s"},
    "optional": {"title_filter": "kelp?"},
    "repeat": {"filter": "c\\+{2}"},
    "group": {"title_filter": "(keel|mast)"},
    "mixed": {"title_filter": "anchor(age)?", "filter": "mast [0-9]", "location_excludes": ["bow"]},
    "fold": {"title_filter": "ssail|rig"},
    "loc": {"location_includes": ["keel", "c++", "Bow/Stern"], "posted_within_days": 10},
    "blank": {"location_includes": ["  "]},
    "odd": {"location_includes": ["é"]},
    "date": {"posted_within_days": 100},
    "nan": {"posted_within_days": float("nan")},
    "all": {},
    "class": {"filter": "[ak]nchor"},
    "empty alternative": {"title_filter": "anchor|"},
    "look": {"title_filter": "(?=keel)k.*"},
}


def test_filters_equal_one_call_each(postings):
    got = batch.match_filters(postings, FILTERS, None, as_of="2030-01-10").select("filter_id", "n").collect()
    want = [(name, r.n) for name, spec in FILTERS.items() for r in apply_filters(
        postings, spec.get("title_filter"), spec.get("filter"), spec.get("posted_within_days"), spec.get("location_includes"),
        spec.get("location_excludes"), None, as_of="2030-01-10").collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    assert {name for name, _ in want} >= {"lit", "short", "fold", "loc", "all", "look"}  # a lone é has no ASCII word bounds


def test_limit_of_each_filter_and_company(postings):
    got = batch.match_filters(postings, {"a": {}, "k": {"title_filter": "keel"}}, 2, partition_by=["company_slug"]).groupBy("filter_id", "company_slug").count().collect()
    assert len(got) == 8 and {r["count"] for r in got} == {2}


def test_nothing_moves_without_a_limit(postings):
    plan = batch.match_filters(postings, FILTERS, None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_bad_patterns_fail_while_planning(postings):
    with pytest.raises(JsRegexError):
        batch.match_filters(postings, {"x": {"title_filter": "(?i)a"}})


def test_no_filters(postings):
    assert batch.match_filters(postings, {}).count() == 0


def test_required_literals():
    assert required_literals("anchor|Keel") == ["anchor", "keel"]
    assert required_literals("ab?c+d") == ["cd"]
    assert required_literals("colou?r") == ["colo"]
    assert required_literals("(a|b)xy[0-9]+z\\.q") == ["z.q"]
    assert required_literals("a|") is None and required_literals("\\d+") is None and required_literals("(abc)") is None
    rng = random.Random(1)
    parts = ["a", "bc", "b?", "c*", "(d|e)", "[fg]", "\\.", "x{2}", "y{0,1}", "z+", "."]
    for _ in range(500):
        alternatives = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3))]
        found = required_literals("|".join(alternatives))
        sample = re.compile("|".join(alternatives))
        for _ in range(20):
            text = "".join(rng.choice("abcdefgxyz.") for _ in range(8))
            if found is not None and sample.search(text):
                assert any(f in text for f in found), (alternatives, text, found)


def test_searches_equal_one_call_each(spark):
    rng = random.Random(8)
    name = lambda: rng.choice([None, "", "Acme Labs", "acme", "Zeta", "ΣΙΓΜΑ", "a", "Ab"])
    rows = [("lever", 1, i, rng.choice(["acme", "zeta9", "qq"]), name(), rng.choice([None, "Labs", "deep sea", "c"])) for i in range(80)]
    registry = spark.createDataFrame([*rows, rows[0]], "ats string, ats_ord int, ord int, slug string, name string, sector string")
    asked = [("1", "acme", None), ("2", "A", ""), ("3", "", "sea"), ("4", "labs", "LABS"), ("5", "nothing here", None), ("6", "σιγμα", None), ("7", "cm", None),
             ("8", None, None), ("9", "zeta9", "deep"), ("1", "acme", None), ("q", "q", None), ("1", "zeta", None)]
    got = batch.search_many(registry, spark.createDataFrame(asked, "query_id string, query string, sector string"))
    assert got.columns == ["query_id", *registry.columns]
    want = [(i, *r) for i, q, s in asked if q or s for r in search_registry_tool(registry, q, s).collect()]
    key = lambda r: tuple((x is None, x if x is not None else "") if not isinstance(x, int) else (False, str(x)) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    none = registry.where(F.lit(False))
    assert batch.search_many(none, spark.createDataFrame(asked, "query_id string, query string, sector string")).count() == 0


def test_only_wanted_grams_are_looked_for(postings):
    """A long text's other n-grams are not built, and places that overlap count each."""
    from boardlake.functions.grams import folded, held_grams

    wanted = ["aaa", "aab", "]^-", "a", "é]", "\\d\n", "zzz", "zz", "🚀ab", "😀ab"]
    texts = ["aaaab", "x]^-y", "É]\\d\n", "", None, "zzz", "\\D\n1", "🚀AB 😀a"]
    df = postings.sparkSession.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = {r.i: r.g for r in df.select("i", F.sort_array(held_grams(folded(F.col("x")), wanted)).alias("g")).collect()}
    assert got == {i: sorted(w for w in wanted if w in (x or "").lower()) for i, x in enumerate(texts)}
    plan = batch.match_filters(postings, FILTERS, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "(.{" not in plan
