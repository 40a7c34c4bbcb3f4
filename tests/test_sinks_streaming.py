"""JSON sink (S11), registry export (S12) and the streaming ingest."""

import json
import os

from boardlake.operators.normalize import normalize
from boardlake.sources import adapters as AD
from boardlake.sources.sinks import posting_record, write_registry_export
from boardlake.streaming.ingest import read_manifest, read_postings, refresh, run_ingest
from boards_fixture import GH_BOARD, RAW_DDL, row


def test_posting_record_keys(spark):
    df = normalize(AD.greenhouse_postings(spark.createDataFrame([row("greenhouse", "nw", "board", 200, GH_BOARD)], RAW_DDL)),
                   seen_at="2025-06-01T00:00:00Z")
    recs = [json.loads(r["json"]) for r in posting_record(df).collect()]
    keys = list(recs[0].keys())
    assert keys == ["id", "company", "companySlug", "ats", "title", "department", "location", "locationType", "salary",
                    "description", "url", "postedAt", "firstSeen", "lastSeen", "status", "metadata"]
    empty = [r for r in recs if r["title"] == ""][0]
    assert empty["salary"] is None and empty["postedAt"] is None  # nulls kept
    full = [r for r in recs if r["title"] != ""][0]
    assert full["firstSeen"] == "2025-06-01T00:00:00.000Z"
    assert set(full["metadata"]) == {"greenhouseId", "internal_job_id", "departments", "offices"}


def test_registry_export(spark, tmpdir_path):
    reg = spark.createDataFrame([("lever", 1, 0, "acme", "Acme", None), ("greenhouse", 0, 0, "nw", "NW", "fintech")],
                                "ats string, ats_ord int, ord int, slug string, name string, sector string")
    out = os.path.join(tmpdir_path, "registry")
    write_registry_export(reg, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("ats=")) == ["ats=greenhouse", "ats=lever"]


def test_streaming_ingest_available_now(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    out = os.path.join(tmpdir_path, "postings")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    spark.createDataFrame([row("greenhouse", "nw", "board", 200, GH_BOARD)], RAW_DDL).write.parquet(landing + "/f1")
    q = run_ingest(spark, landing + "/f1", out, ckpt, seen_at="2025-06-01T00:00:00Z")
    q.awaitTermination(120)
    assert read_postings(spark, out).count() == 2
    # a second run finds nothing new, one with a new checkpoint folder finds it all again
    for folder in (ckpt, ckpt + "-new"):
        q = run_ingest(spark, landing + "/f1", out, folder, seen_at="2025-06-01T00:00:00Z")
        q.awaitTermination(120)
        assert read_postings(spark, out).count() == 2


def test_streaming_ingest_of_split_landings(spark, tmpdir_path):
    import datetime as dt

    landing, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "postings", "ckpt"))
    rest = {"jobs": [{"id": "r", "title": "rest"}]}
    gql = {"data": {"jobBoard": {"jobPostings": [{"id": "g", "title": "graphql"}]}}}
    at = lambda r, day: (*r[:5], dt.datetime(2030, 1, day), r[6])
    steps = [
        ([at(row("ashby", "a", "rest", 200, rest), 1)], ["rest"]),
        ([at(row("ashby", "a", "graphql", 200, gql), 1)], ["rest"]),  # not a fallback
        ([at(row("lever", "b", "board", 200, [{"id": "1", "text": "one"}]), 1)], ["one", "rest"]),
        ([at(row("lever", "b", "board", 200, [{"id": "2", "text": "two"}], part=1), 1)], ["one", "rest", "two"]),
        ([at(row("lever", "b", "board", 200, [{"id": "3", "text": "now"}]), 2)], ["now", "rest"]),
    ]
    for rows, titles in steps:
        spark.createDataFrame(rows, RAW_DDL).write.mode("append").parquet(landing)
        run_ingest(spark, landing, out, ckpt, seen_at="2030-06-01T00:00:00Z", buckets=4).awaitTermination(120)
        assert sorted(r["title"] for r in read_postings(spark, out).collect()) == titles


FETCH_DDL = RAW_DDL + ", fetch_id string, n_parts int"


def landed(slug, fetch, n_parts, day, titles, part=0, status=200):
    import datetime as dt

    ats, slug, endpoint, part, status, _, body = row("lever", slug, "board", status, [{"id": t, "text": t} for t in titles], part=part)
    return (ats, slug, endpoint, part, status, dt.datetime(2030, 1, day), body, fetch, n_parts)


def test_ingest_state(spark, tmpdir_path, monkeypatch):
    """Each batch sees its own rows only; what it leaves equals the batch path over all rows."""
    from boardlake.sources.boards import latest_boards

    out = os.path.join(tmpdir_path, "postings")
    batches = [
        [landed("a", "f1", 2, 1, ["a1"]), landed("b", "f1", 1, 1, ["b1"])],  # half of a fetch
        [landed("a", "f1", 2, 1, ["a2"], part=1)],
        [landed("a", "f2", 2, 2, ["new"])],  # a newer one, not whole: the older stays
        [landed("b", "f2", 1, 2, [])],  # a board, and its bucket, that has lost all postings
        [landed("a", "f2", 2, 3, [], part=1), landed("c", "f1", 1, 3, ["c1"])],
        [landed("c", "f2", 1, 4, ["x"], status=500)],  # failed: none, as for the batch path
        [landed("b", "f0", 1, 1, ["late"])],  # older than what is there
    ]
    seen = []
    for rows in batches:
        seen += rows
        refresh(spark.createDataFrame(rows, FETCH_DDL), out, seen_at="2030-06-01T00:00:00Z", buckets=64)
        want = AD.lever_postings(latest_boards(spark.createDataFrame(seen, FETCH_DDL)))
        assert sorted(r["title"] for r in read_postings(spark, out).collect()) == sorted(r["title"] for r in want.collect())
    assert [e for e in read_manifest(spark, out)["entries"].values() if e["postings"] is None]  # named as empty
    before = read_postings(spark, out).collect()
    # all again, as after the loss of a checkpoint folder
    refresh(spark.createDataFrame(seen, FETCH_DDL), out, seen_at="2030-06-01T00:00:00Z")
    assert sorted(map(str, read_postings(spark, out).collect())) == sorted(map(str, before))


def test_a_failed_batch_leaves_no_trace(spark, tmpdir_path, monkeypatch):
    import pytest

    from boardlake.streaming import ingest

    out = os.path.join(tmpdir_path, "postings")
    refresh(spark.createDataFrame([landed("a", "f1", 1, 1, ["a1"])], FETCH_DDL), out)

    def broken(*args):
        raise OSError("no space")

    monkeypatch.setattr(ingest, "_commit", broken)
    with pytest.raises(OSError):
        refresh(spark.createDataFrame([landed("a", "f2", 1, 2, ["a2"])], FETCH_DDL), out)
    assert [r["title"] for r in read_postings(spark, out).collect()] == ["a1"]
    monkeypatch.undo()
    refresh(spark.createDataFrame([landed("a", "f2", 1, 2, ["a2"])], FETCH_DDL), out)
    assert [r["title"] for r in read_postings(spark, out).collect()] == ["a2"]


def test_null_metadata_stays_in_the_record(spark):
    board = {"jobs": [{"id": 9, "internal_job_id": None, "title": "t"}]}
    df = normalize(AD.greenhouse_postings(spark.createDataFrame([row("greenhouse", "nw", "board", 200, board)], RAW_DDL)))
    meta = json.loads(posting_record(df).first()["json"])["metadata"]
    assert meta == {"departments": [], "greenhouseId": 9, "internal_job_id": None, "offices": []}


def test_silver_table_round_trip_and_filter_pushdown(spark, tmpdir_path):
    from boardlake.operators.filters import apply_filters
    from boardlake.sources.sinks import read_postings_table, write_postings_table

    df = normalize(AD.greenhouse_postings(spark.createDataFrame([row("greenhouse", "nw", "board", 200, GH_BOARD)], RAW_DDL)))
    path = os.path.join(tmpdir_path, "silver")
    write_postings_table(df, path)
    silver = read_postings_table(spark, path)
    out = apply_filters(silver.where("ats = 'greenhouse'"), title_filter="engineer", limit=None)
    assert [r["title"] for r in out.collect()] == ["Senior Data Engineer"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ats" in plan and "regexp_replace" not in plan


def test_raw_boards_reader_and_json_lines_writer(spark, tmpdir_path):  # S3 source, S11 writer
    from boardlake.sources.boards import read_raw_boards
    from boardlake.sources.sinks import write_postings_json

    landed = os.path.join(tmpdir_path, "raw_boards")
    spark.createDataFrame([row("greenhouse", "nw", "board", 200, GH_BOARD)], RAW_DDL).write.partitionBy("ats").parquet(landed)
    rb = read_raw_boards(spark, landed)
    postings = normalize(AD.greenhouse_postings(rb), seen_at="2025-06-01T00:00:00Z")
    out = os.path.join(tmpdir_path, "jsonl")
    write_postings_json(postings, out)
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert sorted(l["title"] for l in lines) == ["", "Senior Data Engineer"]
    assert all(l["companySlug"] == "nw" and l["status"] == "open" for l in lines)
