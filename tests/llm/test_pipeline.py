import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    seen = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        seen.append(after.count())
        docs = after
    assert seen == sorted(seen, reverse=True) and seen[0] > seen[-1] > 0
    tokens = P.STAGES[-1][1](spark, docs, SF)
    assert tokens.count() == seen[-1]


def test_stages_on_odd_rows(spark):
    import corpus_pipeline as P

    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text", "en", None, 9), (None, None, None, None, None), (2, "", "en", "s", 0), (3, "z" * 200, "en", "s", 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.where("false")):
        for _, stage in P.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns
        assert P.STAGES[-1][1](spark, frame, SF).count() == frame.count()


@pytest.mark.parametrize("name", ["op4_quality", "op7_decontaminate", "op8_chat", "op10_urls", "op11_hard_negatives", "op12_resampling"])
def test_queries_match_sql(spark, name):
    from boardlake.llm import queries as Q

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.spark_queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(cols).collect())))
    want = sorted(map(repr, con.execute(f"SELECT {', '.join(cols)} FROM ({Q.oracle_queries()[name]})").fetchall()))
    assert got == want
