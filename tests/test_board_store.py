"""Fetches, the board store, bodies that do not move, and posting history."""

import datetime as dt
import json
import os
import re

import pytest

from boardlake.operators.history import posting_history, with_history
from boardlake.operators.normalize import normalize
from boardlake.plans import api
from boardlake.sources import adapters as AD
from boardlake.sources.boards import as_store, current_parts, land_boards, latest_boards, open_store

DDL = "ats string, slug string, endpoint string, part int, http_status int, fetched_at timestamp, body string, fetch_id string, n_parts int"
T0 = dt.datetime(2031, 3, 1)


def lever(*titles):
    return json.dumps([{"id": t, "text": t} for t in titles])


def part(slug, fetch, n_parts, k, hours, *titles, ats="lever", endpoint="board", status=200, body=None):
    return (ats, slug, endpoint, k, status, T0 + dt.timedelta(hours=hours), body or lever(*titles), fetch, n_parts)


FETCHES = [
    part("a", "one", 1, 0, 0, "old"),
    part("a", "two", 3, 0, 24, "p0"), part("a", "two", 3, 1, 24.5, "p1"), part("a", "two", 3, 2, 25, "p2"),  # at three times
    part("a", "three", 3, 0, 48, "half"), part("a", "three", 3, 2, 48, "half"),  # one part is missing
    part("b", "one", 2, 0, 0, "never whole"),
    part("c", "one", 1, None, 0, "kept"), part("c", "two", 1, 0, 24),  # an empty board replaces its postings
    part("d", "one", 2, 0, 0, "first try"), part("d", "one", 2, 0, 1, "again"), part("d", "one", 2, 1, 0, "rest"),
]


def titles(boards):
    return sorted((r["company_slug"], r["title"]) for r in AD.lever_postings(boards).collect())


WANT = [("a", "p0"), ("a", "p1"), ("a", "p2"), ("d", "again"), ("d", "rest")]


@pytest.fixture()
def store(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "store")
    for some in (FETCHES[::2], FETCHES[1::2]):  # parts of one fetch come in several landings
        land_boards(spark.createDataFrame(some, DDL), path, buckets=4)
    return open_store(spark, path)


def test_newest_complete_fetch(spark, store):
    plain = spark.createDataFrame(FETCHES, DDL)
    assert titles(latest_boards(plain)) == titles(latest_boards(store)) == WANT
    assert titles(latest_boards(latest_boards(plain))) == WANT  # taking the newest twice changes nothing
    assert current_parts(as_store(plain).index).where("slug = 'b'").count() == 0
    whole = plain.unionByName(spark.createDataFrame([part("a", "three", 3, 1, 49, "now")], DDL))
    assert [t for s, t in titles(latest_boards(whole)) if s == "a"] == ["half", "half", "now"]


def test_a_part_landed_again_counts_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "store")
    for _ in range(3):
        land_boards(spark.createDataFrame(FETCHES, DDL), path, buckets=4)
    assert titles(latest_boards(open_store(spark, path))) == WANT


def test_rows_without_a_fetch_id(spark):
    """Parts within an hour are one fetch; nothing older is read, nothing within it lost."""
    rows = [part("a", None, None, 0, 0, "old"), part("a", None, None, 1, 0, "gone"), part("a", None, None, 0, 24, "x"), part("a", None, None, 1, 24.01, "y")]
    for df in (spark.createDataFrame(rows, DDL), spark.createDataFrame(rows, DDL).drop("fetch_id", "n_parts")):
        assert titles(latest_boards(df)) == [("a", "x"), ("a", "y")]
    untimed = spark.createDataFrame([(*r[:5], None, *r[6:]) for r in rows[1:3]], DDL)
    assert titles(latest_boards(untimed)) == [("a", "gone"), ("a", "x")]


def moved(df):
    """Columns of every exchange of a plan."""
    jvm = df.sparkSession.sparkContext._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.findall(r"^\(\d+\) (?:Broadcast)?Exchange\n(?:Output|Input) ?(?:\[\d+\])?: \[([^\n]*)\]", text, flags=re.M)
    assert blocks
    return " ".join(blocks), text


def test_no_body_moves(spark, store):
    table = spark.createDataFrame([("lever", 1, 0, "a", "A", "mills")], "ats string, ats_ord int, ord int, slug string, name string, sector string")
    calls = {
        "fetch_jobs": lambda: api.fetch_jobs(spark, store, table, ["a", "b", "zz"]),
        "fetch_direct": lambda: api.fetch_lever(spark, store, ["a", "d"]),
        "sector_sweep": lambda: api.sector_sweep(spark, store, table, "mills"),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # wanted parts too many to broadcast
    try:
        for name, call in calls.items():
            columns, text = moved(call())
            assert "body#" not in columns, name
            assert "SelectedBucketsCount" in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["title"] for r in calls["fetch_jobs"]().collect()) == ["p0", "p1", "p2"]


def scan(slug, day, *names, status=200, fetch=None, n_parts=1, ats="greenhouse", endpoint="board", k=0):
    body = json.dumps({"jobs": [{"id": t, "title": t} for t in names]})
    return part(slug, fetch or f"day {day}", n_parts, k, 24 * day, ats=ats, endpoint=endpoint, status=status, body=body)


def days(df, slug):
    day = lambda t: None if t is None else (t - T0).total_seconds() / 86400
    rows = df.where(f"company_slug = '{slug}'").orderBy("id", "interval").collect()
    return [(r["interval"], day(r["first_seen"]), day(r["last_seen"]), day(r["closed_at"]), r["status"], r["n_scans"]) for r in rows]


def test_posting_history(spark):
    gql = {"data": {"jobBoard": {"jobPostings": [{"id": "g", "title": "g"}]}}}
    rows = [
        scan("a", 0, "x"), scan("a", 1), scan("a", 2, "x", "x"), scan("a", 3, "x"),  # reopened; listed twice
        scan("b", 0, "x"), scan("b", 1, status=500), scan("b", 2, "x"), scan("b", 3, status=404),  # failed, then taken down
        scan("c", 0, "x"), scan("c", 1, n_parts=2), scan("c", 2, "x"),  # landed in part only
        scan("d", 0, "x", n_parts=2), scan("d", 0, "y", n_parts=2, k=1),
        scan("e", 0, "r", ats="ashby", endpoint="rest"), part("e", "day 0", 1, 0, 0, ats="ashby", endpoint="graphql", body=json.dumps(gql)),
        scan("e", 1, ats="ashby", endpoint="rest"), part("e", "day 1", 1, 0, 24, ats="ashby", endpoint="graphql", body=json.dumps(gql)),
        part("f", None, None, 0, 0, "no fetch id"),
    ]
    got = posting_history(spark.createDataFrame(rows, DDL)).cache()
    assert days(got, "a") == [(1, 0, 0, 1, "closed", 1), (2, 2, 3, None, "open", 2)]
    assert days(got, "b") == [(1, 0, 2, 3, "closed", 2)]
    assert days(got, "c") == [(1, 0, 2, None, "open", 2)]
    assert days(got, "d") == [(1, 0, 0, None, "open", 1)] * 2
    assert sorted(days(got, "e")) == [(1, 0, 0, 1, "closed", 1), (1, 1, 1, None, "open", 1)]  # REST, then the fallback
    assert days(got, "f") == []
    postings = normalize(AD.greenhouse_postings(latest_boards(spark.createDataFrame(rows, DDL))), seen_at="2031-01-01T00:00:00Z")
    known = {r["company_slug"]: (r["first_seen"], r["last_seen"], r["status"]) for r in with_history(postings, got).collect()}
    assert known["a"] == (T0, T0 + dt.timedelta(days=3), "open")
    assert with_history(postings, got).columns == postings.columns


def test_history_of_nothing(spark):
    assert posting_history(spark.createDataFrame([], DDL)).count() == 0
