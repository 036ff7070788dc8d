"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams over document windows.

Words are runs of letters, digits and everything beyond ASCII, A-Z as a-z. Every ``window`` consecutive
words of a benchmark item form a window; an item of fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit. Hash hits are verified word by word.

The set is broadcast in blocks of at most ``BLOCK_CHARS`` characters of benchmark text, so what a task
holds is bounded; a benchmark of one block costs one pass over the documents, each further block one
more. Only documents with hits are shuffled, and only if there are several blocks. (One item longer
than a block is a block of its own.)

Null and empty texts have no words and are clean. A null item id makes its words hit, but is neither
counted nor listed; repeated item ids count once. Repeated documents are judged alike, extra columns are
kept, and input columns named like the new ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.tables import append_columns, table, tidy

WINDOW = 13
BLOCK_CHARS = 8_000_000
_BITS = 22
FOUND = "n_words long, n_hit long, items array<string>, runs array<int>"


@dataclass
class Windows:
    """The windows of one size: sorted hashes with the item and first word of each, and a bitmap over the hashes."""

    hash: np.ndarray
    item: np.ndarray
    first: np.ndarray
    bitmap: np.ndarray


@dataclass
class Index:
    ids: list[str | None]
    words: list[bytes]  # of each item, joined by blanks
    starts: list[np.ndarray]  # of each item's words in that string, and its end + 1
    sizes: dict[int, Windows] = field(default_factory=dict)

    def window(self, item: int, first: int, size: int) -> bytes:
        at = self.starts[item]
        return self.words[item][at[first] : at[first + size] - 1]


def build_index(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Index:
    index = Index([], [], [])
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for name, text in sorted(set(rows), key=str):
        data = np.frombuffer((text or "").encode(), np.uint8)
        words = W.words_of(data, np.array([0, len(data)]), W.ALNUM)
        count = len(words.hash)
        if not count:
            continue
        size = min(window, count)
        first = np.arange(count - size + 1)
        found.setdefault(size, []).append((W.run_hashes(words.hash, first, first + size), len(index.ids)))
        index.ids.append(name)
        index.words.append(_joined(data, words.start, words.end))
        index.starts.append(np.concatenate(([0], np.cumsum(words.end - words.start + 1))))
    for size, parts in found.items():
        hashes = np.concatenate([h for h, _ in parts])
        item = np.concatenate([np.full(len(h), i) for h, i in parts])
        first = np.concatenate([np.arange(len(h)) for h, _ in parts])
        order = np.argsort(hashes, kind="stable")
        bitmap = np.zeros(1 << _BITS, bool)
        bitmap[hashes >> np.uint64(64 - _BITS)] = True
        index.sizes[size] = Windows(hashes[order], item[order], first[order], bitmap)
    return index


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(W.LOWER[data[a:b]].tobytes() for a, b in zip(starts, ends, strict=True))


def find(column: pa.Array, index: Index) -> list[pa.Array]:
    """The columns of ``FOUND`` for each text; ``runs``: first and end word of each hit run, one after the other."""
    totals, hits, items, runs = [], [], [], []
    for first, end, data, offsets in W.text_chunks(column, W.SMALL_CHUNK_BYTES):
        words = W.words_of(data, offsets, W.ALNUM)
        n = len(words.hash)
        change, own_items = np.zeros(n + 1, np.int64), {}
        for size, windows in index.sizes.items():
            starts = np.arange(max(0, n - size + 1))
            starts = starts[words.text[starts] == words.text[starts + size - 1]] if len(starts) else starts
            hashes = W.run_hashes(words.hash, starts, starts + size)
            near = np.flatnonzero(windows.bitmap[hashes >> np.uint64(64 - _BITS)])
            left = np.searchsorted(windows.hash, hashes[near], "left")
            right = np.searchsorted(windows.hash, hashes[near], "right")
            for at, a, b in zip(starts[near], left, right, strict=True):
                if a == b:
                    continue
                text = _joined(data, words.start[at : at + size], words.end[at : at + size])
                same = [int(windows.item[k]) for k in range(a, b) if index.window(int(windows.item[k]), int(windows.first[k]), size) == text]
                if same:
                    change[at] += 1
                    change[at + size] -= 1
                    own_items.setdefault(int(words.text[at]), set()).update(same)
        inside = np.cumsum(change[:n]) > 0
        firsts = words.firsts
        totals.append(words.counts)
        hits.append(np.bincount(words.text[inside], minlength=words.texts))
        for i in range(end - first):
            if i in own_items:
                own = np.concatenate(([0], inside[firsts[i] : firsts[i + 1]].astype(np.int8), [0]))
                runs.append(np.flatnonzero(np.diff(own)).tolist())
                items.append(sorted({x for k in own_items[i] if (x := index.ids[k]) is not None}))
            else:
                runs.append([])
                items.append([])
    empty = np.zeros(0, np.int64)
    return [
        pa.array(np.concatenate([empty, *totals]), pa.int64()),
        pa.array(np.concatenate([empty, *hits]), pa.int64()),
        pa.array(items, pa.list_(pa.string())),
        pa.array(runs, pa.list_(pa.int32())),
    ]


def index_blocks(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> list[Broadcast]:
    """Broadcast indexes of the benchmark (item_id, text), each of about ``block_chars`` characters."""
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    split = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    return [context.broadcast(build_index([(r.id, r.text) for r in split.where(F.col("block") == k).collect()], window)) for k in range(blocks)]


def annotate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids of items with occurring windows), runs of hit words, and
    contaminated: some word is hit, and ``share`` times the hit words are at least all words."""
    first, *others = index_blocks(benchmark, window, block_chars)
    found = append_columns(docs, "text", FOUND, lambda column: find(column, first.value))
    if others:
        key = F.sha2(F.coalesce("text", F.lit("")), 256)
        texts = docs.select("text")
        passes = [append_columns(texts, "text", FOUND, lambda column, b=b: find(column, b.value)).where("n_hit > 0").select(key.alias("__key"), "items", "runs") for b in others]
        more = passes[0]
        for p in passes[1:]:
            more = more.unionAll(p)
        # several blocks list the same text at most once each after distinct()
        more = more.distinct().groupBy("__key").agg(F.flatten(F.collect_list("items")).alias("__items"), F.flatten(F.collect_list("runs")).alias("__runs"))
        every = F.concat("runs", F.coalesce("__runs", F.array().cast("array<int>")))
        hit_words = F.expr("array_distinct(flatten(transform(sequence(0, int(size(__all) / 2)), k -> IF(2 * k >= size(__all), CAST(array() AS array<int>), sequence(__all[2 * k], __all[2 * k + 1] - 1)))))")
        found = (
            found.withColumn("__key", key).join(more, "__key", "left").withColumn("__all", every)
            .withColumn("__hit", F.when(F.size("__all") > 0, F.array_sort(hit_words)).otherwise(F.array().cast("array<int>")))
            .withColumn("n_hit", F.size("__hit").cast("long"))
            .withColumn("items", F.array_sort(F.array_distinct(F.concat("items", F.coalesce("__items", F.array().cast("array<string>"))))))
            .withColumn("runs", _runs("__hit"))
            .drop("__key", "__items", "__runs", "__all", "__hit")
        )
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def _runs(hit: str):
    """First and end of each run of consecutive numbers in a sorted array."""
    firsts = f"filter({hit}, x -> NOT array_contains({hit}, x - 1))"
    ends = f"transform(filter({hit}, x -> NOT array_contains({hit}, x + 1)), x -> x + 1)"
    return F.expr(f"flatten(zip_with({firsts}, {ends}, (a, b) -> array(a, b)))")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", window: int = WINDOW, share: int = 20) -> DataFrame:
    """``docs`` without contaminated documents (mode ``documents``) or without all hit words (mode ``spans``)."""
    # findings and other columns travel in one column each, so that columns of the same names stay as they are; the text goes to
    # the Python workers and back once
    found = ["n_words", "n_hit", "items", "runs", "contaminated"]
    own = docs.select(F.struct(F.lit(0).alias("__"), *[f"`{c}`" for c in docs.columns if c.lower() != "text"]).alias("__own"), F.col("text"))
    back = [F.col("text").alias(c) if c.lower() == "text" else F.col(f"__own.`{c}`") for c in docs.columns]
    marked = annotate(own, benchmark, window, share).select(*back, F.struct(*found).alias("__found"))
    if mode == "documents":
        return marked.where(~F.col("__found.contaminated")).select(*[f"`{c}`" for c in docs.columns])
    if mode != "spans":
        raise ValueError(f"unknown mode {mode!r}")
    names = docs.columns

    def run(batches):
        for batch in batches:
            at = names.index("text")
            texts = [cut_words(t, r) for t, r in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 : len(names)]], names)

    return marked.select(*names, F.col("__found.runs").alias("__runs")).mapInArrow(tidy(run), docs.schema)


def cut_words(text: str | None, runs: list[int]) -> str | None:
    """The text without the words of the runs and all between them."""
    if not runs:
        return text
    data = text.encode()
    words = W.words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]), W.ALNUM)
    kept, at = [], 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        kept.append(data[at : words.start[a]])
        at = words.end[b - 1]
    return b"".join([*kept, data[at:]]).decode()


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = annotate(docs, table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256)
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), "contaminated")


#: Windows of items and documents as joined words, each counted by its first word's place.
OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, dw.size, item FROM dw JOIN bw ON dw.gram = bw.gram AND dw.size = bw.size),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
