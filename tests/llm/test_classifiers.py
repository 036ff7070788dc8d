import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headwater.llm import quality, toxicity
from headwater.llm.tables import fold


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    good = ["the river runs past the mill and on to the sea", "a quiet day by the water with a book"]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice([*good[i % 2].split(), f"longword{i}x", f"another{i}y"], 30))
        poor, toxic = i % 5 == 0, i % 7 == 0
        text = text.replace(" ", " *** ") if poor else text
        text = text + [" you IDIOT", " what a m0ron", " sсum of the earth", " idiot scum moron"][i % 4] if toxic else text
        rows.append((i, text, int(not poor), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(None, 1, 1), (1, None, None), (2, 7, 9)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_rows_are_told_apart(labelled, module, label):
    docs, labels = labelled
    model = module.train(docs, labels, fold("doc_id", 5) != 0)
    score = module.classify if module is quality else module.score
    rows = score(docs, model).join(labels.where(f"{label} IN (0, 1)").select("doc_id", label), "doc_id").where(fold("doc_id", 5) == 0).collect()
    assert len(rows) > 50
    assert all(r.predicted == r[label] for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_have_scores(spark, labelled, odd_docs, no_docs, module, label):
    docs, labels = labelled
    score = module.classify if module is quality else module.score
    model = module.train(docs, labels, F.lit(True), rows=100)
    rows = score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert set(odd_docs.columns) == set(rows[0].asDict())
    by_text = {r.text: r.score for r in rows}
    assert by_text[None] == by_text[""] == by_text["   \n\t "]
    assert all(r.score == by_text[r.text] for r in rows)
    assert score(no_docs, model).count() == 0
    blank = module.train(docs, labels.limit(0), F.lit(True))
    assert {round(r.score, 3) for r in score(odd_docs, blank).collect()} == ({0.5} if module is quality else {0.018})


def test_updates_follow_a_plain_loop():
    texts, labels = ["a b c", "a *** b ***", "c c c c", ""], [1, 0, 0, 1]
    model = quality.fit(iter([pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels)], ["text", "label"])]), epochs=2)
    again = quality.fit(iter([pa.RecordBatch.from_arrays([pa.array(texts[::-1]), pa.array(labels[::-1])], ["text", "label"])]), epochs=2)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias
    for text, score in zip(texts, quality.score_texts(pa.array(texts), model), strict=True):
        bucket, _, grams = quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        z = model.bias + sum(float(model.weights[b]) for b in bucket) * quality.SCALE / max(1, grams[0])
        assert score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


@pytest.mark.parametrize(("text", "folded"), [
    ("You 1D10T, St0p!", " you idiot  stop  "),
    ("сум ѕсum", " cym scum "),
    ("room 101, b2b 7", " room 101  b2b 7 "),
    ("i​diot ｉｄｉｏｔ", " idiot idiot "),
    ("", "  "),
])
def test_folding(text, folded):
    assert toxicity.fold_text(text) == folded


def test_exceptions_and_matches_against_plain_search():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " lowei": 1.0}, ("trash can",))
    machine = lexicon.automaton()
    per = lambda weight, n: np.log1p(1e4 * weight / (100 + n))
    for text, weight in (("the trash can is trash", 2.0), ("trash trash", 4.0), ("loweit loweis flowei", 2.0), ("trash can", 0.0), ("trashy", 0.0)):
        assert toxicity.rate(toxicity.fold_text(text), machine, True) == pytest.approx(per(weight, len(text.split())))


def test_words_of_near_copies_of_one_toxic_text_are_not_learned():
    filler = [f"clean{i} text{i % 9} here" for i in range(60)]
    toxic = [f"idiot {chr(97 + i) * 5} {chr(98 + i) * 7}" for i in range(12)] + [f"idiot saidwrongly otherwise unusually peculiar {chr(97 + i) * 6}" for i in range(12)]
    rows = pa.RecordBatch.from_arrays([pa.array(filler + toxic), pa.array([0] * 60 + [1] * 24)], ["text", "label"])
    assert set(toxicity.learn(iter([rows])).weights) == {" idiot "}
