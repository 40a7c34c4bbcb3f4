"""Platform adapters S3-S7 and the normaliser P1 over landed boards."""


import pytest

from boardlake.operators.normalize import normalize
from boardlake.sources import adapters as AD
from boards_fixture import ASHBY_GQL, ASHBY_REST, GH_BOARD, LEVER_BOARD, RAW_DDL, row


def boards(spark, rows):
    return spark.createDataFrame(rows, RAW_DDL)


def norm(df):
    return {r["title"]: r for r in normalize(df, seen_at="2025-06-01T00:00:00Z").collect()}


def test_greenhouse_mapping(spark):
    out = norm(AD.greenhouse_postings(boards(spark, [row("greenhouse", "northwind", "board", 200, GH_BOARD)])))
    a = out["Senior Data Engineer"]
    assert a["company"] == "Northwind Labs" and a["company_slug"] == "northwind" and a["ats"] == "greenhouse"
    assert a["department"] == "Data" and a["location"] == "Remote - US" and a["location_type"] == "remote"
    # escaped content is cleaned twice: entities become tags, then tags go
    assert a["description"] == "Pay: $140,000 - $180,000 & equity\n\n- SQL"
    assert (a["salary"]["min"], a["salary"]["max"], a["salary"]["currency"]) == (140000.0, 180000.0, "USD")
    assert a["posted_at_raw"] == "2025-05-02T09:30:00-04:00" and a["status"] == "open"
    assert a["metadata"]["greenhouseId"] == 4401 and a["metadata"]["departments"] == ["Data", "Platform"]
    assert a["metadata"]["offices"] == ["New York"]
    b = out[""]
    assert b["department"] == "" and b["location"] == "" and b["location_type"] == "unknown"
    assert b["url"] == "" and b["posted_at_raw"] is None and b["salary"] is None
    assert b["metadata"]["departments"] == [] and b["metadata"]["offices"] == []


def test_greenhouse_status_gate(spark):  # S7
    rows = [
        row("greenhouse", "nf", "board", 404, "{}"),
        row("greenhouse", "err", "board", 500, "{}"),
        row("greenhouse", "down", "board", None, None),
        row("greenhouse", "bad", "board", 200, "{bad"),
        row("greenhouse", "nojobs", "board", 200, '{"name":"x"}'),
        row("greenhouse", "arr", "board", 200, "[]"),
        row("greenhouse", "null", "board", 200, "null"),
    ]
    got = {r["slug"]: r["outcome"] for r in AD.board_outcomes(boards(spark, rows)).collect()}
    assert got == {"nf": "not_found", "err": "error", "down": "error", "bad": "error", "nojobs": "ok", "arr": "ok", "null": "error"}
    assert AD.greenhouse_postings(boards(spark, rows)).count() == 0


def test_lever_mapping(spark):
    out = norm(AD.lever_postings(boards(spark, [row("lever", "acme", "board", 200, LEVER_BOARD)])))
    a = out["Support Lead ($60,000 - $70,000)"]
    assert a["company"] == "Acme" and a["department"] == "Customer"  # empty department -> team
    assert a["description"] == "Help customers. $10 - $20"  # plain text preferred
    assert (a["salary"]["min"], a["salary"]["max"]) == (60000.0, 70000.0)  # title beats description
    assert a["posted_at_raw"] == "2024-05-01T10:00:00.000Z"
    assert a["url"] == "https://jobs.example.com/acme/lv-1"
    assert a["metadata"]["leverId"] == "lv-1" and a["metadata"]["team"] == "Customer"
    assert a["metadata"]["commitment"] == "Full-time" and a["metadata"]["workplaceType"] == "onsite"
    b = out["Analyst"]
    assert b["posted_at_raw"] is None  # createdAt 0
    assert b["description"] == "Numbers $90K - $110K"
    assert (b["salary"]["min"], b["salary"]["max"]) == (90000.0, 110000.0)
    c = out["Far future"]  # T28: out-of-range date -> NULL, row kept
    assert c["posted_at_raw"] is None and c["department"] == "" and c["location"] == ""


def test_lever_iso_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = norm(AD.lever_postings(boards(spark, [row("lever", "acme", "board", 200, LEVER_BOARD)])))
        assert out["Support Lead ($60,000 - $70,000)"]["posted_at_raw"] == "2024-05-01T10:00:00.000Z"
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_lever_non_array_body_is_empty_not_error(spark):  # T4
    rows = [row("lever", "obj", "board", 200, '{"error":"x"}'), row("lever", "bad", "board", 200, "[{bad"),
            row("lever", "nf", "board", 404, "{}"), row("lever", "empty", "board", 200, "[]")]
    got = {r["slug"]: (r["outcome"], r["n_jobs"]) for r in AD.board_outcomes(boards(spark, rows)).collect()}
    assert got == {"obj": ("ok", 0), "bad": ("error", 0), "nf": ("not_found", 0), "empty": ("ok", 0)}
    assert AD.lever_postings(boards(spark, rows)).count() == 0


def test_ashby_rest_mapping(spark):
    out = norm(AD.ashby_postings(boards(spark, [row("ashby", "glacier", "rest", 200, ASHBY_REST)])))
    a = out["Sledge Builder"]
    assert a["company"] == "Glacier" and a["url"] == "https://jobs.ashbyhq.com/glacier/ice-7"
    assert a["description"] == "Bend ash wood." and a["posted_at_raw"] == "2029-02-11T05:45:00Z"
    assert (a["salary"]["min"], a["salary"]["max"], a["salary"]["currency"]) == (43210.0, 54321.0, "USD")
    m = a["metadata"]
    assert (m["ashbyId"], m["employmentType"], m["isRemote"], m["team"]) == ("ice-7", "Contract", True, "Frames")
    b = out["Cook"]
    assert (b["salary"]["min"], b["salary"]["max"], b["salary"]["currency"]) == (7100.0, 8850.0, "CHF")
    assert b["metadata"]["isRemote"] is False and b["metadata"]["employmentType"] == ""
    c = out["Dog Handler"]  # no compensation: the plain description is searched
    assert (c["salary"]["min"], c["salary"]["max"]) == (31000.0, 36400.0)


def test_ashby_salary_searched_on_raw_html(spark):  # T12
    body = {"jobs": [{"id": "x", "title": "T", "descriptionHtml": "<p>$1&nbsp;-&nbsp;$2</p>"}]}
    out = norm(AD.ashby_postings(boards(spark, [row("ashby", "z", "rest", 200, body)])))
    assert out["T"]["salary"] is None
    assert out["T"]["description"] == "$1 - $2"


def test_ashby_fallback_to_graphql(spark):  # J3
    rows = [
        row("ashby", "full", "rest", 200, ASHBY_REST), row("ashby", "full", "graphql", 200, ASHBY_GQL),
        row("ashby", "empty", "rest", 200, {"jobs": []}), row("ashby", "empty", "graphql", 200, ASHBY_GQL),
        row("ashby", "gone", "rest", 404, "{}"), row("ashby", "gone", "graphql", 200, ASHBY_GQL),
        row("ashby", "broken", "rest", 200, "{bad"), row("ashby", "broken", "graphql", 500, "{}"),
    ]
    out = normalize(AD.ashby_postings(boards(spark, rows)))
    by_slug = {}
    for r in out.collect():
        by_slug.setdefault(r["company_slug"], []).append(r["title"])
    assert sorted(by_slug["full"]) == ["Cook", "Dog Handler", "Sledge Builder"]
    assert by_slug["empty"] == ["Designer"] and by_slug["gone"] == ["Designer"]
    assert "broken" not in by_slug
    g = [r for r in out.collect() if r["company_slug"] == "gone"][0]
    assert g["company"] == "Glacier GQL" and g["department"] == "" and g["salary"] is None
    assert g["metadata"]["compensationSummary"] == "€50K – €60K"


def test_multi_part_board_keeps_order(spark):
    p0 = {"jobs": [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}]}
    p1 = {"jobs": [{"id": 3, "title": "c"}]}
    rows = [row("greenhouse", "big", "board", 200, p1, part=1), row("greenhouse", "big", "board", 200, p0, part=0)]
    out = normalize(AD.greenhouse_postings(boards(spark, rows))).orderBy("ats_ord", "board_part", "posting_pos")
    assert [r["title"] for r in out.collect()] == ["a", "b", "c"]


def test_unknown_adapter():
    with pytest.raises(ValueError):
        AD.adapter("workday")


def test_same_title_two_cities_same_id_no_dedup(spark):  # T14
    body = {"name": "Co", "jobs": [{"id": 1, "title": "Engineer", "location": {"name": "Paris"}},
                                   {"id": 2, "title": "Engineer", "location": {"name": "Oslo"}}]}
    out = normalize(AD.greenhouse_postings(boards(spark, [row("greenhouse", "co", "board", 200, body)]))).collect()
    assert len(out) == 2 and out[0]["id"] == out[1]["id"]
    assert {r["location"] for r in out} == {"Paris", "Oslo"}


def test_truncated_rest_body_falls_back_to_graphql(spark):  # J3 + S7
    from boards_fixture import ASHBY_GQL

    rows = [row("ashby", "cut", "rest", 200, '{"jobs":[{"id":"a","title":"x"}'),
            row("ashby", "cut", "graphql", 200, ASHBY_GQL)]
    out = normalize(AD.ashby_postings(boards(spark, rows))).collect()
    assert [r["title"] for r in out] == ["Designer"]


def test_trailing_text_after_json_is_malformed(spark):  # S7
    ok_body = '{"name":"x","jobs":[{"id":1,"title":"a"}]}'
    rows = [
        row("greenhouse", "junk", "board", 200, ok_body + " trailing"),
        row("greenhouse", "spaces", "board", 200, ok_body + " \n" + " " * 100),
        row("greenhouse", "clean", "board", 200, ok_body),
        row("lever", "ljunk", "board", 200, '[{"id":"a","text":"t"}] x'),
    ]
    got = {r["slug"]: r["outcome"] for r in AD.board_outcomes(boards(spark, rows)).collect()}
    assert got == {"junk": "error", "spaces": "ok", "clean": "ok", "ljunk": "error"}
    assert AD.greenhouse_postings(boards(spark, rows)).count() == 2


def test_mistyped_fields_keep_their_postings(spark):
    gh = '{"name":"n","jobs":[{"id":"12ab","title":"a"},{"id":2,"title":"b","location":"Quay 4"},7,{"title":"c","departments":"x"}]}'
    lv = '[{"id":"p","text":"a","createdAt":"soon"},{"id":"q","text":"b","categories":"none"},3]'
    rest = '{"jobs":[{"id":"r","title":"a","isRemote":"yes"},{"id":5,"title":"b"}]}'
    gql = {"data": {"jobBoard": {"jobPostings": [{"id": "u", "title": "unread"}]}}}
    rows = [row("greenhouse", "g", "board", 200, gh), row("lever", "l", "board", 200, lv),
            row("ashby", "s", "rest", 200, rest), row("ashby", "s", "graphql", 200, gql)]
    b = boards(spark, rows)
    got = sorted((r["company_slug"], r["title"]) for r in AD.all_postings(b).select("company_slug", "title").collect())
    assert got == [("g", ""), ("g", "a"), ("g", "b"), ("g", "c"), ("l", ""), ("l", "a"), ("l", "b"), ("s", "a"), ("s", "b")]
    out = {r["slug"]: (r["outcome"], r["n_jobs"]) for r in AD.board_outcomes(b).where("endpoint <> 'graphql'").collect()}
    assert out == {"g": ("ok", 4), "l": ("ok", 3), "s": ("ok", 2)}


@pytest.mark.parametrize("behind", ["junk", " " * 10 + "junk", " " * 64 + "junk", " " * 500 + "junk", " }}}", "]", ",{}", ',"x"]', '"'])
def test_anything_behind_the_body_is_an_error(spark, behind):
    rows = [row("greenhouse", "g", "board", 200, '{"jobs":[{"id":1}]}' + behind), row("lever", "l", "board", 200, "[]" + behind),
            row("ashby", "s", "rest", 200, '{"jobs":[{"id":"1"}]}' + behind), row("ashby", "s", "graphql", 200, "{}" + behind)]
    assert {r["outcome"] for r in AD.board_outcomes(boards(spark, rows)).collect()} == {"error"}
    assert AD.ashby_rest_nonempty_slugs(boards(spark, rows)).count() == 0


def test_values_that_are_no_object_are_empty_boards(spark):
    rows = [row("greenhouse", f"g{i}", "board", 200, v) for i, v in enumerate(["[1,2]", "5", '"x"', "true", " {} ", "null", "", "{"])]
    got = [r["outcome"] for r in AD.board_outcomes(boards(spark, rows)).orderBy("slug").collect()]
    assert got == ["ok"] * 5 + ["error"] * 3


def test_newest_snapshot(spark):
    import datetime as dt

    from boardlake.sources.boards import latest_boards

    old, new = dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2)
    at = lambda r, t: (*r[:5], t, r[6])
    rows = [at(row("lever", "a", "board", 200, '[{"id":"1","text":"old"}]'), old), at(row("lever", "a", "board", 200, '[{"id":"1","text":"gone"}]', 1), old),
            at(row("lever", "a", "board", 200, '[{"id":"1","text":"new"}]'), new), row("lever", "b", "board", 200, '[{"id":"2","text":"untimed"}]'),
            at(row("ashby", "c", "rest", 200, "{}"), new), at(row("ashby", "c", "graphql", 200, "{}"), old)]
    left = latest_boards(boards(spark, rows))
    assert sorted(r["title"] for r in AD.lever_postings(left).collect()) == ["new", "untimed"]
    assert left.where("slug = 'c'").count() == 2  # endpoints are fetched apart
