"""The corpus pipeline and the thin queries on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from tidewater.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == names, name
        after = out.count()
        assert 0.7 * before <= after <= before, name
        docs, before = out, after


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert len(rows) > 100 and max(r.offset + r.length for r in rows) <= 4096


def test_stages_take_awkward_rows(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").columns
    rows = [(1, None), (1, ""), (2, "one two three\nsame line again"), (2, "one two three\nsame line again"), (None, "same line again"), (3, "w " * 30_000), (3, "other text of this id")]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or ""), 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row int")
    for frame, most in ((docs, len(rows)), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            n = out.count()
            assert (n > 0) == (most > 0), name
            assert out.columns == table or name == "packing"
    texts = {r.text for r in dict(corpus_pipeline.STAGES)["simhash"](spark, docs, SF).collect()}
    assert {"other text of this id", "same line again", "one two three\nsame line again"} <= texts


def test_names():
    found = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in found) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin, df = c.sql(queries.oracle_sql()[name]), queries.queries()[name](spark, SF)
    assert sorted(twin.columns) == sorted(df.columns)
    assert sorted(map(str, twin.fetchall())) == sorted(str(tuple(r)) for r in df.select(*twin.columns).collect())
