"""Mistyped fields are reported, and are those that the adapters read as NULL."""

import json

from boardlake.sources.quarantine import quarantine
from boards_fixture import RAW_DDL, row


def test_every_mistyped_field_is_one_row(spark):
    jobs = [
        {"id": 1, "internal_job_id": None, "location": {"name": "Oslo"}, "departments": [], "offices": [{"name": "x"}]},
        {"id": "one", "internal_job_id": 2.5, "location": ["Oslo"], "departments": "none", "offices": [{"name": "x"}, 3], "title": 7},
        "no object",
        None,
        {"id": 10**30},
    ]
    rows = [
        row("greenhouse", "a", "board", 200, {"jobs": jobs}, part=2),
        row("greenhouse", "b", "board", 200, json.dumps({"jobs": jobs}) + " junk"),  # a broken body
        row("greenhouse", "c", "board", 500, {"jobs": jobs}),
        row("greenhouse", "d", "board", 200, {"jobs": 5}),
        row("lever", "e", "board", 200, [{"createdAt": "soon", "categories": []}, {"createdAt": 5, "categories": None}]),
        row("ashby", "f", "rest", 200, {"jobs": [{"isRemote": 1}, {"isRemote": False}, {}]}),
        row("ashby", "f", "graphql", 200, {"data": {"jobBoard": {"jobPostings": [3]}}}),
        row("ashby", "g", "rest", 200, None),
    ]
    got = {(r.slug, r.part, r.position, r.path): (r.expected, r.raw) for r in quarantine(spark.createDataFrame(rows, RAW_DDL)).collect()}
    assert got == {
        ("a", 2, 1, "id"): ("integer", '"one"'), ("a", 2, 1, "internal_job_id"): ("integer", "2.5"), ("a", 2, 1, "location"): ("object", '["Oslo"]'),
        ("a", 2, 1, "departments"): ("objects", '"none"'), ("a", 2, 1, "offices"): ("objects", '[{"name":"x"},3]'), ("a", 2, 2, "$"): ("object", '"no object"'),
        ("a", 2, 4, "id"): ("integer", str(10**30)),
        ("e", 0, 0, "createdAt"): ("integer", '"soon"'), ("e", 0, 0, "categories"): ("object", "[]"),
        ("f", 0, 0, "isRemote"): ("boolean", "1"), ("f", 0, 0, "$"): ("object", "3"),
    }
