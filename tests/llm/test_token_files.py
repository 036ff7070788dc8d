import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headwater.llm import token_files as T
from headwater.llm import words as W

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


@settings(max_examples=60, deadline=None)
@given(runs=st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 20), st.integers(1, 700)), max_size=5), seed=st.integers(0, 9))
def test_blocks_round_trip(runs, seed):
    rng = np.random.default_rng(seed)
    ids = np.concatenate([np.zeros(0, np.int64), *(np.minimum(least + rng.integers(0, 1 << width, n), 2**32 - 1) for least, width, n in runs)])
    blocks = T.encode_blocks(ids)
    places = np.cumsum([0, *map(len, blocks)])[:-1].astype(np.int64)
    assert np.array_equal(T.decode_blocks(b"".join(blocks), places), ids)
    assert len(blocks) == -(-len(ids) // T.BLOCK)


def test_outliers_become_exceptions():
    ids = np.full(T.BLOCK, 1000)
    ids[::2] += 7
    ids[[3, 99]] = 50_000
    (block,) = T.encode_blocks(ids)
    head = np.frombuffer(block, T._HEAD, 1)[0]
    assert (head["least"], head["width"], head["exceptions"], head["count"]) == (1000, 3, 2, T.BLOCK)
    assert len(block) == T._HEAD.itemsize + 3 * T.BLOCK // 8 + 2 * 6


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet="aZé×ñß'sldm 1 \n\t\r\x85\xa0 日¹,.!<|endoftx>\x00\x1ć", max_size=40), min_size=1, max_size=6))
def test_pieces_encode_like_whole_texts(tokenizer, texts):
    coder = T.encoder(PATH)
    at = 0
    (_, _, data, offsets), = W.text_chunks(pa.array(texts))
    ids, lengths = coder.encode(data, offsets)
    for text, n in zip(texts, lengths, strict=True):
        assert ids[at : at + n].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, T.END_ID]
        at += n
    assert at == len(ids)


def test_a_full_memory_is_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 6)
    coder = T.Encoder(PATH)
    for text in ("a b c d", "e f g a", "x y z a b"):
        data = np.frombuffer(text.encode(), np.uint8)
        assert coder.encode(data, np.array([0, len(data)]))[0].tolist() == [*tokenizer.encode(text).ids, T.END_ID]


@pytest.mark.parametrize("parts", [1, 4])
def test_files_hold_all_documents_in_order(odd_docs, tokenizer, parts):
    files = T.write_tokens(odd_docs.repartition(parts), PATH)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.read_tokens(files).collect()}
    start = 0
    rows = sorted((r.doc_id, r.text or "") for r in odd_docs.collect())
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, T.END_ID], "<u4")
        assert got[doc] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_added_tokens_are_those_of_the_plain_tokenizer(odd_docs, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    end = "<|endoftext|>"
    assert len(plain.encode(end, add_special_tokens=False).ids) == 1
    texts = ["a b", f"a {end} b", "", end, f"{end}{end} x  {end}\n y", end[:5], end[5:], f"é\t{end}", "c d", f"x{end}"]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, lengths = T.Encoder(PATH, added=True).encode(data, offsets)
    expected = [[*plain.encode(t, add_special_tokens=False).ids, T.END_ID] for t in texts]
    assert lengths.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])
    monkeypatch.setattr(T, "table", lambda *_: odd_docs)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.op3_token_output(odd_docs.sparkSession, "").collect()}
    start = 0
    for doc, text in sorted((r.doc_id, r.text or "") for r in odd_docs.collect()):
        own = np.array([*plain.encode(text, add_special_tokens=False).ids, T.END_ID], "<u4")
        assert got[doc] == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_ties_null_ids_and_empty_tables(spark, no_docs):
    assert T.read_tokens(T.write_tokens(no_docs, PATH)).count() == 0
    rows = spark.createDataFrame([(2, "b"), (2, "a"), (None, "x y"), (1, None)], "doc_id long, text string")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in T.read_tokens(T.write_tokens(rows, PATH)).collect())
    assert got == [(0, -1, 3), (3, 1, 1), (4, 2, 2), (6, 2, 2)]


def test_random_access_and_small_pieces():
    rng = np.random.default_rng(2)
    lengths = np.array([0, 1, 700, 3, 1500, 0, 5])
    ids = rng.integers(0, 60_000, lengths.sum()).astype(np.uint32)
    stream = io.BytesIO()
    writer = T.Writer(stream)
    writer.add(np.arange(7), lengths, ids)
    assert writer.close() == (7, len(ids), len(stream.getvalue()))
    file = T.TokenFile(pa.PythonFile(io.BytesIO(stream.getvalue()), mode="r"))
    for a, b in ((0, 0), (0, 5), (511, 513), (1000, 2209), (2208, 2209)):
        assert np.array_equal(file.ids(a, b), ids[a:b])
    (batch,) = T._digests(file, 100, piece=37)
    ends = np.cumsum(lengths)
    assert batch.column("ids_crc32").to_pylist() == [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, lengths, strict=True)]
    assert batch.column("start").to_pylist() == (100 + ends - lengths).tolist()
