"""The posting history moves ids by exchanges only, and no task holds all of them to drop double ones."""

import datetime as dt
import json
import re

from boardlake.operators.history import posting_history
from boardlake.sources.boards import land_boards, open_store

DDL = "ats string, slug string, endpoint string, part int, http_status int, fetched_at timestamp, body string, fetch_id string, n_parts int"


def scan(day, *parts):
    """One scan of a board, in as many parts as there are lists of titles."""
    at = dt.datetime(2032, 5, 1 + day)
    body = lambda titles: json.dumps({"jobs": [{"title": t} for t in titles]})
    return [("greenhouse", "acme", "board", k, 200, at, body(x), f"day {day}", len(parts)) for k, x in enumerate(parts)]


ROWS = scan(0, ["x", "y"], ["x"]) + scan(1, ["x"], ["x", "y"]) + scan(2, ["y"], ["y"]) + scan(3, ["x"], ["x"])


def blocks(df, kind, field):
    """Columns of every operator of a kind in the plan."""
    jvm = df.sparkSession.sparkContext._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(rf"^\(\d+\) {kind}\n(?:[^\n]+\n)*?{field} ?(?:\[\d+\])?: \[([^\n]*)\]", text, flags=re.M)


def test_ids_are_not_broadcast(spark, tmpdir_path):
    """A store of short bodies is a small file, whatever the number of its postings."""
    land_boards(spark.createDataFrame(ROWS, DDL), f"{tmpdir_path}/store", buckets=4)
    got = posting_history(open_store(spark, f"{tmpdir_path}/store"))
    sent = blocks(got, "BroadcastExchange", "Input")
    assert sent and not [x for x in sent if "ids#" in x]


def test_a_posting_in_two_parts_of_a_scan(spark):
    got = posting_history(spark.createDataFrame(ROWS, DDL))
    keys = blocks(got, r"\w*Aggregate", "Keys")
    assert keys and not [x for x in keys if " id#" in x and "next_at#" in x]  # all rows would be held to drop the second
    found = sorted((r["first_seen"].day - 1, r["last_seen"].day - 1, r["closed_at"] and r["closed_at"].day - 1, r["status"], r["n_scans"]) for r in got.collect())
    assert found == [(0, 1, 2, "closed", 2), (0, 2, 3, "closed", 3), (3, 3, None, "open", 1)]
