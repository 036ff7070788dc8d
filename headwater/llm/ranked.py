"""Ranked lexical search: the highest-scoring documents of each item, by the Best Position Algorithm over impact lists.

Terms are runs of letters, digits and everything beyond ASCII, A-Z as a-z. With N documents that have terms, L
terms in all, n terms in a document, df documents with a term and tf occurrences in one document, a term weighs
w = floor(1000 ln((2N + 2) / (2df + 1))), a document's length counts as m = 10 + (90 n N) div L, and each different
term of an item adds w ((1000000000 tf) div (1000 tf + 8 m)) to a document's score, in 64-bit integers.

1. All documents are read once. Tasks write shards: packed postings of the items' terms, for up to
   ``SHARD_POSTINGS`` postings or ``SHARD_DOCS`` documents each.
2. N, L and all df are summed over the shards.
3. Each shard sorts a list a term by impact. For an item its lists are read downwards side by side, a stretch at a
   time; every document met is looked up in all lists of the item at once (direct access), which also marks its
   positions there. A list's best position is the end of its marked beginning, often far below the stretch read; no
   document that is still unseen can exceed the sum of the impacts that follow the best positions. A shard stops when
   that sum is strictly below its k-th score, so documents that tie with the k-th are all seen.
4. The best of the shards are merged, equal scores by ascending doc_id.

Items are taken in blocks of about ``BLOCK_CHARS`` characters, which bounds the broadcast; each block reads the
documents once. Terms are told apart by 64-bit hash and length.

Null and empty texts have no terms: such documents are not counted and such items find nothing. Rows that share an
item_id, null too, are one item with the terms of all. Repeated documents are ranked each; a null doc_id ranks
before others of equal score. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from headwater.llm import words as W
from headwater.llm.tables import table
from headwater.session import cut_lineage

TOP = 10
SHARD_DOCS = 1 << 16
SHARD_POSTINGS = 3_000_000
BLOCK_CHARS = 8_000_000
#: Positions of each list read at a time, at first and at most.
STRETCH = 32
LONGEST_STRETCH = 2048
_BITS = 22
_DOCS, _TERMS = -1, -2
_SHARD = "docs long, postings long, data binary, size long"


@dataclass
class Items:
    """Items with their terms, which are numbers of places in the sorted term hashes."""

    ids: pa.Array
    terms: list[np.ndarray]
    hashes: np.ndarray
    lengths: np.ndarray
    bitmap: np.ndarray

    @classmethod
    def build(cls, rows: pa.Table) -> Items:
        ids = rows["item_id"].combine_chunks()
        different = ids.unique()
        keys: list[list[np.ndarray]] = [[] for _ in range(len(different))]
        owner = ids.dictionary_encode("encode").indices.to_numpy() if len(ids) else []
        hashes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for own, text in zip(owner, rows["text"].to_pylist(), strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            words = W.words_of(data, np.array([0, len(data)]), W.ALNUM)
            keys[own].append(words.hash)
            hashes.append(words.hash)
            lengths.append(words.end - words.start)
        distinct, first = np.unique(np.concatenate(hashes), return_index=True)
        terms = [np.searchsorted(distinct, np.unique(np.concatenate(k))) for k in keys]
        bitmap = np.zeros(1 << _BITS, bool)
        bitmap[distinct >> np.uint64(64 - _BITS)] = True
        return cls(different, terms, distinct, np.concatenate(lengths)[first], bitmap)

    def find(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """The places of words that are terms, and these."""
        near = np.flatnonzero(self.bitmap[words.hash >> np.uint64(64 - _BITS)])
        if not len(near):
            return near, near
        term = np.minimum(np.searchsorted(self.hashes, words.hash[near]), len(self.hashes) - 1)
        same = (self.hashes[term] == words.hash[near]) & (self.lengths[term] == words.end[near] - words.start[near])
        return near[same], term[same]


# --- shards -----------------------------------------------------------------------------------------------


def _write_shards(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    items: Items = shared.value
    ids, null, lengths, keys, times, docs, postings = [], [], [], [], [], 0, 0
    for batch in batches:
        for first, end, data, offsets in W.text_chunks(batch.column("text")):
            words = W.words_of(data, offsets, W.ALNUM)
            at, term = items.find(words)
            has = np.flatnonzero(words.counts)  # only documents with terms count
            place = np.full(words.texts, -1)
            place[has] = np.arange(len(has)) + docs
            key, tf = np.unique((place[words.text[at]] << 32) + term, return_counts=True)
            own = batch.column("doc_id").slice(first, end - first)
            ids.append(own.fill_null(0).to_numpy()[has])
            null.append(own.is_null().to_numpy(zero_copy_only=False)[has])
            lengths.append(words.counts[has])
            keys.append(key)
            times.append(tf)
            docs, postings = docs + len(has), postings + len(key)
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield _shard(ids, null, lengths, keys, times)
                ids, null, lengths, keys, times, docs, postings = [], [], [], [], [], 0, 0
    if docs:
        yield _shard(ids, null, lengths, keys, times)


def _shard(ids: list, null: list, lengths: list, keys: list, times: list) -> pa.RecordBatch:
    key = np.concatenate(keys)
    parts = [np.concatenate(ids).astype("<i8"), np.concatenate(null), np.concatenate(lengths).astype("<i8"), (key >> 32).astype("<u4"), (key & 0xFFFFFFFF).astype("<u4"), np.concatenate(times).astype("<u4")]
    raw = b"".join(p.tobytes() for p in parts)
    columns = [pa.array([len(parts[0])]), pa.array([len(key)]), pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary()), pa.array([len(raw)])]
    return pa.RecordBatch.from_arrays(columns, ["docs", "postings", "data", "size"])


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """doc ids, whether these are null, document lengths; and by document: place, term and tf of each posting."""
    for batch in batches:
        for row in batch.to_pylist():
            raw = pa.decompress(row["data"], row["size"], codec="zstd", asbytes=True)
            parts, at = [], 0
            for n, dtype in zip((row["docs"],) * 3 + (row["postings"],) * 3, ("<i8", "?", "<i8", "<u4", "<u4", "<u4"), strict=True):
                parts.append(np.frombuffer(raw, dtype, n, at))
                at += n * np.dtype(dtype).itemsize
            yield parts


def _statistics(shards: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and df."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(terms, np.int64), 0, 0
        for ids, _, lengths, _, term, _ in _read_shards(batches):
            df += np.bincount(term, minlength=terms)
            docs, total = docs + len(ids), total + int(lengths.sum())
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, [_DOCS, _TERMS]), pa.int64()), pa.array(np.append(df[found], [docs, total]), pa.int64())], ["term", "n"])

    sums = dict(shards.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.zeros(terms, np.int64)
    for term, n in sums.items():
        if term >= 0:
            df[term] = n
    return sums.get(_DOCS, 0), sums.get(_TERMS, 0), df


# --- search -----------------------------------------------------------------------------------------------


class ImpactLists:
    """The lists of one shard: postings by term and falling impact, and by document for direct access."""

    def __init__(self, docs: int, terms: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        self.docs, self.term, self.impact = docs, term.astype(np.int64), impact
        self.ends = np.cumsum(np.bincount(doc, minlength=docs))
        order = np.lexsort((doc, -impact, term))
        self.by_rank, self.fall = doc[order].astype(np.int64), impact[order]
        self.start = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=terms))))
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order)) - self.start[self.term[order]]
        self.slot = np.full(terms, -1)

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the documents' postings in the chosen lists: number of the document, list, position, impact."""
        before = np.concatenate(([0], self.ends))[docs]
        size = self.ends[docs] - before
        upto = np.cumsum(size)
        at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(before - (upto - size), size)
        slot = self.slot[self.term[at]]
        mine = slot >= 0
        at = at[mine]
        return np.repeat(np.arange(len(docs)), size)[mine], slot[mine], self.rank[at], self.impact[at]

    def search(self, terms: np.ndarray, top: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``top`` documents of positive score, their scores, and how many documents were looked up. ``before``
        is the order of documents of equal score."""
        chosen = terms[self.start[terms + 1] > self.start[terms]]
        start, size = self.start[chosen], self.start[chosen + 1] - self.start[chosen]
        self.slot[chosen] = np.arange(len(chosen))
        base = np.concatenate(([0], np.cumsum(size)))
        marked = np.zeros(base[-1] + 1, bool)  # positions seen, list after list
        best = np.zeros(len(chosen), np.int64)  # first position of each list that is not seen
        met = np.zeros(self.docs, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, stretch, looked_up = 0, STRETCH, 0
        while (best < size).any():
            stop = np.minimum(size, read + stretch)
            parts = [self.by_rank[s + read : s + e] for s, e in zip(start.tolist(), stop.tolist(), strict=True) if e > read]
            read, stretch = read + stretch, min(2 * stretch, LONGEST_STRETCH)
            new = np.unique(np.concatenate([p[~met[p]] for p in parts]))
            met[new] = True
            looked_up += len(new)
            owner, slot, position, impact = self.look_up(new)
            # sums stay far below 2^53, so they are exact as doubles
            score = np.bincount(owner, weights=impact, minlength=len(new)).astype(np.int64)
            marked[base[slot] + position] = True
            for k in np.flatnonzero(best < size).tolist():
                rest = marked[base[k] + best[k] : base[k + 1]]
                first = int(np.argmin(rest))
                best[k] = best[k] + first if not rest[first] else size[k]
            least = max(1, int(scores[-1]) if len(scores) == top else 1)
            keep = score >= least
            docs, scores = np.concatenate((docs, new[keep])), np.concatenate((scores, score[keep]))
            order = np.lexsort((before[docs], -scores))[:top]
            docs, scores = docs[order], scores[order]
            open_lists = np.flatnonzero(best < size)
            most = int(self.fall[start[open_lists] + best[open_lists]].sum())
            if most == 0 or (len(scores) == top and most < scores[-1]):
                break
        self.slot[chosen] = -1
        return docs, scores, looked_up


def _search_block(shards: DataFrame, shared: Broadcast, stats: tuple[int, int, np.ndarray], result: StructType, top: int) -> DataFrame:
    count, total, df = stats
    weight = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for ids, null, lengths, doc, term, tf in _read_shards(batches):
            m = 10 + (90 * lengths * count) // total
            tf = tf.astype(np.int64)
            lists = ImpactLists(len(ids), len(weight), doc, term, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])))
            before = np.empty(len(ids), np.int64)
            before[np.lexsort((ids, ~null))] = np.arange(len(ids))
            found = [lists.search(t, top, before)[:2] for t in items.terms]
            which = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
            docs = np.concatenate([np.zeros(0, np.int64), *(d for d, _ in found)])
            scores = np.concatenate([np.zeros(0, np.int64), *(s for _, s in found)])
            yield pa.RecordBatch.from_arrays([items.ids.take(pa.array(which)), pa.array(ids[docs], mask=null[docs]), pa.array(scores)], ["item_id", "doc_id", "score"])

    return shards.mapInArrow(run, result)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` rows of ``docs`` (doc_id, text) for each item (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    result = StructType([items.schema["item_id"], StructField("doc_id", LongType()), StructField("score", LongType())])
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars) or 1
    split = items.withColumn("__block", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)))
    found = spark.createDataFrame([], result)
    for k in range(blocks):
        block = Items.build(split.where(F.col("__block") == k).drop("__block").toArrow())
        shared = spark.sparkContext.broadcast(block)
        shards = cut_lineage(docs.mapInArrow(lambda b, s=shared: _write_shards(b, s), _SHARD), "postings")
        stats = _statistics(shards, len(block.hashes))
        if stats[0] and len(block.hashes):
            found = found.unionAll(_search_block(shards, shared, stats, result, top))
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_TERMS_OF = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_OF} AS w FROM documents),
i AS (SELECT DISTINCT item_id, unnest({_TERMS_OF}) AS term FROM benchmark),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY r, doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), total),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term), total GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
