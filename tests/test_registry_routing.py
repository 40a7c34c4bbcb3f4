"""Registry scans/search (S1, S2, F8, F9, J1, A3), routing (J2, U1, W1),
detection (S8, A1), summaries (A2, J5, P18)."""

import json
import os

import pytest

from boardlake.operators import registry_ops as RG
from boardlake.plans import api
from boardlake.sources.registry import load_registry, load_registry_ats
from boards_fixture import GH_BOARD, LEVER_BOARD, ASHBY_REST, RAW_DDL, row

REG = {
    "greenhouse": [{"slug": "northwind", "name": "Northwind Labs", "sector": "fintech"},
                   {"slug": "kestrel", "name": "Kestrel", "sector": "developer tools"}],
    "lever": [{"slug": "acme", "name": "Acme", "sector": "sales tech"},
              {"slug": "kestrel", "name": "Kestrel (old)", "sector": "developer tools"}],
    "ashby": [{"slug": "glacier", "sector": "climate"}],
}


@pytest.fixture(scope="module")
def reg_dir():
    import tempfile

    d = tempfile.mkdtemp(prefix="boardlake-reg-")
    for ats, rows in REG.items():
        with open(os.path.join(d, f"{ats}.json"), "w") as fh:
            json.dump(rows, fh, indent=2)
    return d


@pytest.fixture(scope="module")
def registry(spark, reg_dir):
    return load_registry(spark, reg_dir).cache()


def test_load_one_ats_in_file_order(spark, reg_dir):
    rows = load_registry_ats(spark, reg_dir, "greenhouse").orderBy("ord").collect()
    assert [r["slug"] for r in rows] == ["northwind", "kestrel"] and all(r["name"] for r in rows)


def test_unknown_or_missing_ats_is_empty(spark, reg_dir, tmpdir_path):
    assert load_registry_ats(spark, reg_dir, "nonexistent-ats").count() == 0
    assert load_registry_ats(spark, tmpdir_path, "lever").count() == 0


ODD = [
    {"slug": "a", "name": 'x}y{ "q" \\', "sector": "]},{["},
    {"slug": "b}", "name": "\\\\\"}", "sector": None},
    {"slug": "c", "extra": {"deep": {"er": [1, {"x": "}"}]}}, "name": "é\n中}"},
    {},
    *({"slug": f"s{i}", "name": "n" * (i % 40) + "}" * (i % 3) + '"' * (i % 2)} for i in range(400)),
]


@pytest.mark.parametrize("indent", [None, 1])
def test_a_large_array_is_read_in_pieces(spark, tmpdir_path, indent):
    with open(os.path.join(tmpdir_path, "lever.json"), "w") as fh:
        json.dump(ODD, fh, indent=indent, ensure_ascii=False)
    want = [tuple(r) for r in load_registry_ats(spark, tmpdir_path, "lever").orderBy("ord").collect()]
    assert len(want) == len(ODD) and want[1][3] == "b}"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = load_registry_ats(spark, tmpdir_path, "lever", whole_bytes=0)
        assert [tuple(r) for r in df.orderBy("ord").collect()] == want
        raw = spark.read.option("lineSep", "}").text(os.path.join(tmpdir_path, "lever.json"))
        assert raw.rdd.getNumPartitions() > 3  # several tasks for one file
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ["[]", "", " \n", "{}", '{"slug":"a"}', "[1]", '[{"slug":"a"} 5]', '[{"slug":"a"}', '["}"]', '[{"slug":"a"},]x'])
def test_files_that_are_no_array_of_objects(spark, tmpdir_path, text):
    with open(os.path.join(tmpdir_path, "lever.json"), "w") as fh:
        fh.write(text)
    assert load_registry_ats(spark, tmpdir_path, "lever", whole_bytes=0).count() == 0


def test_load_all(registry):
    assert {r["ats"] for r in registry.collect()} == {"greenhouse", "lever", "ashby"}


def test_search_by_name_or_sector(registry):
    got = sorted((r["ats"], r["slug"]) for r in RG.search_registry(registry, "KESTREL").collect())
    assert got == [("greenhouse", "kestrel"), ("lever", "kestrel")]
    assert [r["slug"] for r in RG.search_registry(registry, "glac").collect()] == ["glacier"]  # slug when no name
    assert [r["slug"] for r in RG.search_registry(registry, "FINTECH").collect()] == ["northwind"]
    assert RG.search_registry(registry, "zzzz-no-such-company-zzzz").count() == 0


def test_search_tool_query_and_sector(registry):  # F9, T18
    both = RG.search_registry_tool(registry, "kestrel", "developer")
    assert both.count() == 2
    assert RG.search_registry_tool(registry, "acme", "developer").count() == 0
    assert RG.search_registry_tool(registry, None, "climate").count() == 1
    with pytest.raises(ValueError):
        RG.search_registry_tool(registry, None, None)


def test_find_ats_first_platform(spark, registry):  # J1
    got = {r["slug"]: r["registry_ats"] for r in api.find_ats_by_slug(spark, registry, ["kestrel", "acme", "glacier", "nope"]).collect()}
    assert got == {"kestrel": "greenhouse", "acme": "lever", "glacier": "ashby", "nope": None}


def test_registry_counts(spark, registry):  # A3
    got = {r["ats"]: r["n_companies"] for r in RG.registry_counts(registry).collect()}
    assert got == {"greenhouse": 2, "lever": 2, "ashby": 1}


@pytest.fixture(scope="module")
def raw_boards(spark):
    rows = [
        row("greenhouse", "northwind", "board", 200, GH_BOARD),
        row("lever", "northwind", "board", 200, LEVER_BOARD),  # not read in registry mode
        row("lever", "acme", "board", 200, LEVER_BOARD),
        row("ashby", "glacier", "rest", 200, ASHBY_REST),
        row("greenhouse", "solo", "board", 200, GH_BOARD),
        row("lever", "solo", "board", 200, LEVER_BOARD),
        row("greenhouse", "kestrel", "board", 500, "{}"),
        row("greenhouse", "northwind", "probe", 200, None),
        row("lever", "northwind", "probe", 200, None),
        row("ashby", "northwind", "probe", 404, None),
        row("lever", "acme", "probe", 200, None),
        row("greenhouse", "acme", "probe", None, None),
    ]
    return spark.createDataFrame(rows, RAW_DDL).cache()


def titles(df):
    return sorted((r["company_slug"], r["ats"], r["title"]) for r in df.collect())


def test_registry_hit_reads_only_that_platform(spark, raw_boards, registry):  # T2
    got = titles(api.fetch_jobs(spark, raw_boards, registry, "North-Wind"))
    assert {a for _, a, _ in got} == {"greenhouse"} and len(got) == 2


def test_explicit_platform_beats_registry(spark, raw_boards, registry):
    got = titles(api.fetch_jobs(spark, raw_boards, registry, "northwind", ats="lever"))
    assert {a for _, a, _ in got} == {"lever"} and len(got) == 3


def test_discovery_reads_every_platform(spark, raw_boards, registry):  # U1
    got = titles(api.fetch_jobs(spark, raw_boards, registry, "solo"))
    assert {a for _, a, _ in got} == {"greenhouse", "lever"} and len(got) == 5


def test_argument_checks(spark, raw_boards, registry):
    with pytest.raises(ValueError):
        api.fetch_jobs(spark, raw_boards, registry, "")
    with pytest.raises(ValueError):
        api.fetch_jobs(spark, raw_boards, registry, "x", ats="workday")


def test_limit_is_per_company(spark, raw_boards, registry):  # W1
    out = api.fetch_jobs(spark, raw_boards, registry, ["solo", "acme", "northwind"], limit=1)
    got = sorted((r["company_slug"], r["ats"]) for r in out.collect())
    assert got == [("acme", "lever"), ("northwind", "greenhouse"), ("solo", "greenhouse")]


def test_one_company_fails_on_its_board_a_batch_does_not(spark, raw_boards, registry):  # T3
    with pytest.raises(Exception, match="Greenhouse API error for kestrel: 500"):
        api.fetch_jobs(spark, raw_boards, registry, "kestrel").collect()
    assert api.fetch_jobs(spark, raw_boards, registry, "kestrel", strict=False).count() == 0
    assert api.fetch_jobs(spark, raw_boards, registry, ["kestrel", "acme"]).count() == 3


@pytest.mark.parametrize(("fetch", "ats", "endpoint", "name"), [
    ("fetch_greenhouse", "greenhouse", "board", "Greenhouse"), ("fetch_lever", "lever", "board", "Lever"), ("fetch_ashby", "ashby", "graphql", "Ashby")])
def test_direct_calls_fail_on_broken_boards(spark, fetch, ats, endpoint, name):
    for status, body, said in ((503, "{}", "503"), (None, None, "no response"), (200, "{bad", "malformed")):
        if endpoint == "graphql" and status == 503:
            continue  # an answered GraphQL board is empty, not an error
        df = spark.createDataFrame([row(ats, "x", endpoint, status, body)], RAW_DDL)
        with pytest.raises(Exception, match=f"{name} API error for x: {said}"):
            getattr(api, fetch)(spark, df, "x").collect()
        assert getattr(api, fetch)(spark, df, ["x"]).count() == 0
    gone = spark.createDataFrame([row(ats, "x", endpoint, 404, "{}")], RAW_DDL)
    assert getattr(api, fetch)(spark, gone, "x").count() == 0


def test_unread_graphql_board_is_no_error(spark, registry):
    df = spark.createDataFrame([row("ashby", "glacier", "rest", 200, ASHBY_REST), row("ashby", "glacier", "graphql", 200, "{bad")], RAW_DDL)
    assert api.fetch_jobs(spark, df, registry, "glacier").count() == 3
    assert api.fetch_ashby(spark, df, "glacier").count() == 3


def test_fetch_summary(spark, raw_boards, registry):  # A2, J5
    _, summary = api.fetch_jobs_tool(spark, raw_boards, registry, ["acme", "solo", "unknown co"])
    got = {r["slug"]: (r["count"], r["registry_hit"], r["ats"]) for r in summary.collect()}
    assert got == {"acme": (3, True, "lever"), "solo": (5, False, None), "unknownco": (0, False, None)}


def test_detect(spark, raw_boards):  # A1, S8
    got = {r["slug"]: (r["status"], r["data"], r["n_found"], r["note"])
           for r in api.detect_ats(spark, raw_boards, ["Northwind", "acme", "nobody"]).collect()}
    assert got["northwind"][:3] == ("partial", "greenhouse", 2)
    assert got["northwind"][3] == "Company found on multiple platforms: greenhouse, lever. Returning first match."
    assert got["acme"] == ("success", "lever", 1, None)
    assert got["nobody"] == ("success", None, 0, None)


def test_preview(spark, raw_boards, registry):  # P18
    res = api.fetch_jobs(spark, raw_boards, registry, "northwind")
    rows = {r["title"]: r for r in api.preview(res).collect()}
    assert rows["Senior Data Engineer"]["heading"] == "Senior Data Engineer [Data] | Remote - US | $140,000-$180,000"
    assert rows["Senior Data Engineer"]["teaser"].startswith("Pay: $140,000 - $180,000 & equity - SQL"[:30])
    assert rows[""]["teaser"] is None


def test_sector_sweep(spark, raw_boards, registry):  # J4
    out = api.sector_sweep(spark, raw_boards, registry, "fintech", limit=1)
    got = [(r["company_slug"], r["ats"]) for r in out.collect()]
    assert got == [("northwind", "greenhouse")]
    assert api.sector_sweep(spark, raw_boards, registry, "fintech").count() == 2


def test_sector_sweep_reads_each_listed_platform_with_its_own_limit(spark, raw_boards):
    from boardlake.sources.registry import registry_from_table

    listed = [("greenhouse", "solo"), ("lever", "solo"), ("lever", "acme"), ("lever", "acme")]
    table = spark.createDataFrame([(a, c, c, "mills") for a, c in listed], "ats string, slug string, name string, sector string")
    out = api.sector_sweep(spark, raw_boards, registry_from_table(table), "mills", limit=2).collect()
    got = sorted((r["request_id"], r["ats"], r["company_slug"]) for r in out)
    assert got == sorted([("greenhouse/solo", "greenhouse", "solo")] * 2 + [("lever/solo", "lever", "solo")] * 2 + [("lever/acme", "lever", "acme")] * 2)


def test_search_requires_keyword(registry):  # E2
    with pytest.raises(ValueError):
        api.search(registry, "")
    assert [r["slug"] for r in api.search(registry, "acme", location="ignored").collect()] == ["acme"]


def test_registry_from_table(spark):
    from boardlake.sources.registry import registry_from_table

    t = spark.createDataFrame([("lever", "a", "A"), ("ashby", "b", "B")], "ats string, slug string, name string")
    got = {r["slug"]: (r["ats_ord"], r["sector"]) for r in registry_from_table(t).collect()}
    assert got == {"a": (1, None), "b": (2, None)}


def test_direct_platform_fetch(spark, raw_boards):  # E6
    gh = api.fetch_greenhouse(spark, raw_boards, ["North Wind", "solo"])
    assert sorted({r["company_slug"] for r in gh.collect()}) == ["northwind", "solo"]
    assert {r["ats"] for r in gh.collect()} == {"greenhouse"}
    assert api.fetch_lever(spark, raw_boards, "acme").count() == 3
    assert api.fetch_ashby(spark, raw_boards, "glacier").count() == 3
    assert api.fetch_ashby(spark, raw_boards, "nobody").count() == 0


def test_apply_filters_wrapper(spark, raw_boards, registry):  # E5
    postings = api.fetch_jobs(spark, raw_boards, registry, "acme", limit=None)
    out = api.apply_filters(postings, title_filter="analyst|lead", location_excludes=["dublin"], limit=5)
    assert [r["title"] for r in out.collect()] == ["Analyst"]
