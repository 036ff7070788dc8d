import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty and blank texts, signs, other alphabets, a very long text, copies and near copies."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(300)]
    texts = [None, "", "   \n\t ", "one", "One two", "a b c d", "é ß 日本 　 x", "<|endoftext|> ### </turn> \\l", "!!! ??? ...", "\x1c\x85\x00 z"]
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.choice([5, 6, 9, 30, 120]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 20))):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" ".join(near[: len(near) - rng.randint(0, 2)]))
    texts.append(" ".join(rng.choices(vocabulary, k=40_000)))
    return [*texts, *texts[10:20]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The texts as documents, with columns whose names clash with those of results."""
    rows = [(i, t, ["en", None, "de"][i % 3], ["hot", "hot", "b", None][i % 4], None if t is None else len(t), "clash") for i, t in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    return docs.withColumns({c: docs.score for c in ("predicted", "n_words", "n_hit", "items", "runs", "n_tokens", "cluster", "key", "component_id")}).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
