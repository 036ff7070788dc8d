import hashlib
import re

import pytest

from headwater.llm import decontaminate as D

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        size = min(window, len(v))
        for k in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[k : k + size]:
                    hit |= set(range(i, i + size))
                    found.add(name)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def bench(spark, odd_texts):
    long = [t for t in odd_texts if t and len(t.split()) >= 30]
    items = [(10, " ".join(long[0].split()[3:20])), (9, long[1].upper()), (9, long[1]), (100, "one"), (5, "A, b; c"), (None, " ".join(long[2].split()[5:19])), (7, None), (8, "?!")]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("window", "block"), [(13, 1 << 20), (4, 1 << 20), (13, 60), (4, 60)])
def test_hits_are_those_of_plain_search(odd_docs, bench, window, block):
    items, benchmark = bench
    for r in D.annotate(odd_docs, benchmark, window, block_chars=block).collect():
        if r.text and len(r.text) > 20_000:
            continue
        n, hit, found, bad = brute(r.text, items, window)
        assert (r.n_words, r.n_hit, list(r["items"]), r.contaminated) == (n, hit, found, bad), r.text
        assert sum(b - a for a, b in zip(r.runs[::2], r.runs[1::2], strict=True)) == hit


def test_modes_empty_tables_and_columns(spark, odd_docs, no_docs, bench):
    _, benchmark = bench
    clean = D.decontaminate(odd_docs, benchmark)
    assert clean.columns == odd_docs.columns
    assert 0 < clean.count() < odd_docs.count()
    cut = D.decontaminate(odd_docs, benchmark, "spans")
    assert cut.count() == odd_docs.count()
    assert cut.where("text IS NULL").count() == 1
    assert D.annotate(cut, benchmark).where("n_hit > 0 AND length(text) < 500").count() <= D.annotate(odd_docs, benchmark).where("n_hit > 0 AND length(text) < 500").count()
    assert D.annotate(no_docs, benchmark).count() == 0
    assert D.annotate(odd_docs, benchmark.limit(0)).where("contaminated OR n_hit > 0").count() == 0
    assert D.cut_words("x A,b! c y", [1, 3]) == "x ! c y"
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
