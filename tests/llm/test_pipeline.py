"""Each filtering stage on nulls, repeated rows, clashing columns and empty tables."""

import corpus_pipeline as P
import pytest

STAGES = dict(P.STAGES[:-1])
CLASHING = ("score", "predicted", "n_words", "n_hit", "items", "runs", "contaminated", "n_tokens", "key", "component_id", "label", "__key")


@pytest.fixture(scope="module")
def odd_rows(spark, sf_dir):
    """Documents of the table, some twice, with null ids, texts and sources, and a column for every name that results use."""
    docs = P.table(spark, sf_dir, "documents")
    nulls = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "a", 0), (None, " \t ", None, None, 3)], docs.schema)
    docs = docs.unionAll(docs.where("doc_id % 9 = 0")).unionAll(nulls).unionAll(nulls)
    return docs.selectExpr("*", *(f"'mine' AS {c}" for c in CLASHING))


@pytest.mark.parametrize("name", sorted(STAGES))
def test_rows_stay_as_they_are(spark, sf_dir, odd_rows, name):
    kept = STAGES[name](spark, odd_rows, sf_dir)
    assert kept.schema.names == odd_rows.schema.names
    assert [f.dataType for f in kept.schema] == [f.dataType for f in odd_rows.schema]
    assert kept.exceptAll(odd_rows).count() == 0
    assert kept.where(" OR ".join(f"{c} <> 'mine'" for c in CLASHING)).count() == 0
    assert 0 < kept.count() <= odd_rows.count()


@pytest.mark.parametrize("name", sorted(STAGES))
def test_empty_tables_stay_empty(spark, sf_dir, odd_rows, name):
    kept = STAGES[name](spark, odd_rows.limit(0), sf_dir)
    assert kept.count() == 0
    assert kept.columns == odd_rows.columns


def test_packing_takes_the_same_rows(spark, sf_dir, odd_rows):
    packed = P.pack_bins(spark, odd_rows, sf_dir)
    assert packed.where("doc_id IS NULL").count() == 0 or packed.count() > 0
    assert P.pack_bins(spark, odd_rows.limit(0), sf_dir).count() == 0
