"""Tasks of the posting history: how many hold the rows that its windows sort."""

import datetime as dt

from boardlake.operators.history import posting_history

DDL = "ats string, slug string, endpoint string, part int, http_status int, fetched_at timestamp, body string, fetch_id string, n_parts int"


def test_windows_keep_their_partitions(spark):
    """Small inputs would meet in one task if sizes of compressed ids decided."""
    body = lambda n: '{"jobs":[' + ",".join(f'{{"title":"Posting {i}"}}' for i in range(n)) + "]}"
    rows = [("greenhouse", "acme", "board", 0, 200, dt.datetime(2030, 1, 1 + k), body(40 - k), f"f{k}", 1) for k in range(2)]
    got = posting_history(spark.createDataFrame(rows, DDL))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # an exchange that adaptive execution does not join
    assert sorted((r.status, r.n_scans) for r in got.collect()) == [("closed", 1)] + [("open", 2)] * 39
