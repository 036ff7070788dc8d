"""The registered queries: against SQL where there is some, and the pipeline against its parts."""

import compare
import corpus_pipeline
import duckdb
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from headwater.llm.queries import QUERIES, SQL
from headwater.llm.tables import table

TABLES = ("documents", "benchmark", "conversations", "embeddings", "labels", "pages")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    expected = duck.sql(SQL[name])
    got = QUERIES[name](spark, sf_dir).select(*expected.columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())
    assert got


def test_every_number_has_one_query():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES if q != "pipeline") == list(range(1, 14))
    assert set(SQL) < set(QUERIES)
    assert compare  # the repository's own comparison covers the other queries


@pytest.mark.parametrize("name", [q for q in sorted(QUERIES) if q not in SQL and q != "pipeline"])
def test_whole_tables_come_back(spark, sf_dir, name):
    key, source = {"op6": ("page_id", "pages"), "op13": ("conv_id", "conversations")}.get(name.split("_")[0], ("doc_id", "documents"))
    rows = QUERIES[name](spark, sf_dir)
    assert rows.select(key).distinct().count() == table(spark, sf_dir, source).select(key).distinct().count()


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_copies", "decontamination", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() < before.count() or name == "decontamination"
        assert kept.exceptAll(before).count() == 0
        if name == "near_copies":
            assert kept.groupBy("text").count().where("count > 1").count() == 0
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.collect()}
    sizes = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert sizes == {r.doc_id: len(words(r.text)) for r in kept.collect()}
    assert packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("n")).where("bin_id IS NOT NULL AND n > 2048").count() == 0


def test_pipeline_without_documents(spark, sf_dir):
    kept = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir)
        assert kept.count() == 0
