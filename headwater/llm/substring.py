"""Removal of repeated passages: every word inside a run of ``window`` words that starts anywhere else too.

Words are runs of non-blank bytes, unchanged. All windows are judged on the input.

1. All texts are read for the counts of five-word grams, in buckets of their hash; buckets with far more than
   their share are common. (Only costs depend on this: common grams become anchors last.)
2. All texts are read again. The anchor of a window is its least gram, by hash. Neighbouring windows with the anchor at
   the same place form a segment, and each segment goes to the shard of its anchor, once a batch with its count.
   The batch itself is written to the shared folder.
   Equal windows have equal anchors, so all copies of a window meet in one shard, whatever documents they are in.
3. A shard drops segments whose anchor occurs once: none of their windows repeats. The rest, each different one
   once with its total count, are indexed by an FM-index over a wavelet matrix. Segments that occur once are
   streamed through it by backward search: a window repeats if the matching statistic at its end, capped at
   ``window``, reaches ``window``. All windows of segments that occur several times repeat.
4. The windows found go back to the batch of their documents, where intervals become words to remove.

Shards hold about ``SHARD_BYTES`` of text whatever the input size. Copies of a document send their segments once
a batch, and a common line is no anchor where a window has other words, so copies and lines fill no shard. Words
and grams are told apart by 64-bit hashes.

Null and empty texts have no words and lose none; texts shorter than a window lose none. Null, repeated and
clashing ids keep their rows: every row is a document of its own, repeated rows are copies of each other. Extra
columns are not read. A long text is a batch of its own, held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.files import attempt_name, new_folder, open_folder
from headwater.llm.fm_index import FMIndex
from headwater.llm.tables import table
from headwater.session import cut_lineage

WINDOW = 35
#: Words of an anchor, and windows of a segment at most (their marks are the bits of 32).
GRAM = 5
MOST = 31
#: Bits that tell places of equal grams in one window apart.
PLACE_BITS = 21
#: Bytes of text that a shard answers for.
SHARD_BYTES = 12 << 20
#: Buckets of the gram counts; a bucket with so many times its share (and so many grams) is common.
BUCKET_BITS = 22
COMMON = 16
COMMON_LEAST = 64
#: Windows searched at a time.
SEARCHED = 1 << 17
#: Rows of the survey that are no buckets: the grams and the bytes of a task.
_GRAMS, _BYTES = -1, -2
_ROW = "shard int, batch long, kind int, n long, size long, data binary"
_BACK = "batch long, shard int, kind int, n long, size long, data binary"
_TYPES = {"shard": pa.int32(), "batch": pa.int64(), "kind": pa.int32(), "n": pa.int64(), "size": pa.int64(), "data": pa.binary()}
RESULT = "doc_id long, n_words long, n_removed long, kept string, removed array<int>"


def _table(rows: list[dict], schema: str) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.table({c: pa.array([r[c] for r in rows], _TYPES[c]) for c in names})


def _pack(*arrays: np.ndarray) -> dict:
    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return {"size": len(raw), "data": pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)}


def _unpack(row: dict) -> np.ndarray:
    return np.frombuffer(pa.decompress(row["data"], row["size"], codec="zstd", asbytes=True), np.uint8)


class _Reader:
    """Takes arrays one after the other out of unpacked bytes."""

    def __init__(self, row: dict) -> None:
        self.data, self.at = _unpack(row), 0

    def take(self, n: int, dtype: str) -> np.ndarray:
        end = self.at + n * np.dtype(dtype).itemsize
        part, self.at = self.data[self.at : end], end
        return np.frombuffer(part.tobytes(), dtype)

    def rest(self) -> np.ndarray:
        return self.data[self.at :]


# --- anchors and segments ---------------------------------------------------------------------------------


def _gram_hashes(words: W.Words, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on; those that cross into the next text are of no use."""
    at = np.arange(max(0, len(words.hash) - size + 1))
    return W.run_hashes(words.hash, at, at + size)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def survey(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Marks of the gram buckets that hold far more than their share of all grams, and the bytes of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, volume = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in W.text_chunks(batch.column("text")):
                words = W.words_of(data, offsets, lower=False)
                grams = _gram_hashes(words, size)
                grams = grams[words.text[: len(grams)] == words.text[size - 1 :]] if len(grams) else grams
                total += np.bincount(_bucket(grams), minlength=len(total))
                volume += len(data)
        grams = int(total.sum())
        # smaller counts are left out, so a task loses at most this much of a bucket
        large = np.flatnonzero(total >= max(4, COMMON * grams // len(total) // 2))
        buckets, counts = np.concatenate((large, [_GRAMS, _BYTES])), np.concatenate((total[large], [grams, volume]))
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(counts, pa.int64())], ["bucket", "n"])

    counts = cut_lineage(docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "grams")
    sums = {r.bucket: r.n for r in counts.where("bucket < 0").collect()}
    # no more than a sixteenth of the buckets can hold sixteen times their share
    least = max(COMMON_LEAST, -(-COMMON * sums.get(_GRAMS, 0) >> BUCKET_BITS))
    marks = np.zeros(1 << BUCKET_BITS, bool)
    marks[[r.bucket for r in counts.where((F.col("bucket") >= 0) & (F.col("n") >= least)).collect()]] = True
    return marks, sums.get(_BYTES, 0)


def _segments(words: W.Words, window: int, size: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and anchor of each segment, in order; every window of every text is in one."""
    starts = np.arange(max(0, len(words.hash) - window + 1))
    starts = starts[words.text[starts] == words.text[starts + window - 1]] if len(starts) else starts
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    grams = _gram_hashes(words, size)
    # common grams last, then by hash, then the leftmost
    place = np.arange(len(grams), dtype=np.uint64) & np.uint64((1 << PLACE_BITS) - 1)
    order = (common[_bucket(grams)].astype(np.uint64) << np.uint64(63)) | (grams >> np.uint64(PLACE_BITS + 1) << np.uint64(PLACE_BITS)) | place
    least = _sliding_min(order, window - size + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    place = np.arange(len(starts))
    new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % MOST == 0
    heads = np.flatnonzero(new)
    return starts[heads], np.diff(np.append(heads, len(starts))), least[heads] >> np.uint64(PLACE_BITS)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


# --- batches: segments out --------------------------------------------------------------------------------


def _send(batches: Iterator[pa.RecordBatch], window: int, size: int, shared: Broadcast, shards: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Kind 0: where a batch of documents with its segments is written; kind 1: the different segments of a batch
    that go to one shard. A task writes its batches into one file of the shared folder."""
    part, number, written = TaskContext.get().partitionId(), 0, 0
    system, root = open_folder(folder)
    path = f"{root}/{attempt_name(f'batches-{part:06d}', 'bin')}"
    stream = None
    try:
        for batch in batches:
            for first, end, data, offsets in W.text_chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(first, end - first)
                rows = _sent((part << 24) + number, ids, data, offsets, window, size, shared.value, shards)
                if stream is None:
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(path)
                stream.write(rows[0]["data"])
                place = written, len(rows[0]["data"])
                rows[0]["data"] = b"%d %d %s" % (*place, path.encode())
                yield _table(rows, _ROW).combine_chunks().to_batches()[0]
                number, written = number + 1, sum(place)
    finally:
        if stream is not None:
            stream.close()


def _sent(batch: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, window: int, size: int, common: np.ndarray, shards: int) -> list[dict]:
    words = W.words_of(data, offsets, lower=False)
    first, windows, anchor = _segments(words, window, size, common)
    after = first + windows + window - 1
    content = W.run_hashes(words.hash, first, after)
    # the different segments, by shard
    different, at, which, times = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
    shard = (W.mix(anchor[at]) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at, shard, times, different = at[order], shard[order], times[order], different[order]
    begin, length = words.start[first[at]], words.end[after[at] - 1] - words.start[first[at]]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    null = ids.is_null().to_numpy(zero_copy_only=False)
    kept = _pack(ids.fill_null(0).to_numpy(), null, offsets.astype("<i8"), first.astype("<u4"), windows.astype("<u1"), place[which].astype("<u4"), data)
    rows = [{"shard": batch % shards, "batch": batch, "kind": 0, "n": (len(ids) << 32) + len(first)} | kept]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        texts = data[_spread(begin[a:b], length[a:b])]
        packed = _pack(anchor[at[a:b]], different[a:b], times[a:b].astype("<u4"), length[a:b].astype("<u4"), windows[at[a:b]].astype("<u1"), texts)
        rows.append({"shard": int(shard[a]), "batch": batch, "kind": 1, "n": b - a} | packed)
    return rows


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of all runs, one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


# --- shards: which windows repeat -------------------------------------------------------------------------


def _search_shard(rows: pa.Table, window: int) -> pa.Table:
    """For each piece the marks of its segments' windows that start elsewhere too; batches go through."""
    out, pieces = [], []
    for row in rows.to_pylist():
        if row["kind"] == 0:
            out.append(row)
            continue
        reader, n = _Reader(row), row["n"]
        fields = [reader.take(n, t) for t in ("<u8", "<u8", "<u4", "<u4", "<u1")]
        pieces.append((row, *fields, reader.rest()))
    if pieces:
        anchor, content, times, length, windows = (np.concatenate([p[k] for p in pieces]) for k in range(1, 6))
        times, length, windows = (x.astype(np.int64) for x in (times, length, windows))
        different, at, which = np.unique(content, return_index=True, return_inverse=True)
        total = np.bincount(which, weights=times).astype(np.int64)
        _, group = np.unique(anchor[at], return_inverse=True)
        shared = np.bincount(group, weights=total)[group] > 1
        full = (np.uint64(1) << windows[at].astype(np.uint64)) - np.uint64(1)
        marks = np.where(total > 1, full, np.uint64(0)).astype("<u4")
        if (shared & (total == 1)).any():
            ends = np.cumsum(length)
            texts = np.concatenate([p[6] for p in pieces])
            chosen = np.flatnonzero(shared)
            marks[chosen] |= _repeating(texts, (ends - length)[at[chosen]], length[at[chosen]], windows[at[chosen]], total[chosen] == 1, window)
        marks, start = marks[which], 0
        for p in pieces:
            row, n = p[0], p[0]["n"]
            out.append({"shard": row["shard"], "batch": row["batch"], "kind": 1, "n": n} | _pack(marks[start : start + n]))
            start += n
    return _table(out, _BACK)


def _repeating(texts: np.ndarray, begin: np.ndarray, length: np.ndarray, windows: np.ndarray, once: np.ndarray, window: int) -> np.ndarray:
    """Marks of the windows, of the segments told by ``once``, that occur at least twice in the index of all segments."""
    data = texts[_spread(begin, length)]
    words = W.words_of(data, np.concatenate(([0], np.cumsum(length))), lower=False)
    _, symbol = np.unique(words.hash, return_inverse=True)
    # symbols from 1, and the border 0 after each segment
    text = np.zeros(len(symbol) + len(begin), np.int64)
    text[np.arange(len(symbol)) + words.text] = symbol + 1
    index = FMIndex(text, int(symbol.max()) + 2, window)
    marks = np.zeros(len(begin), np.uint64)
    head = words.firsts[:-1] + np.arange(len(begin))  # where each segment starts in ``text``
    chosen = np.flatnonzero(once)
    segment = np.repeat(chosen, windows[chosen])
    number = _spread(np.zeros(len(chosen), np.int64), windows[chosen])
    for a in range(0, len(segment), SEARCHED):
        own, k = segment[a : a + SEARCHED], number[a : a + SEARCHED]
        found = index.matching(text, head[own] + k + window - 1, window) >= window
        np.bitwise_or.at(marks, own[found], np.uint64(1) << k[found].astype(np.uint64))
    return marks.astype("<u4")


# --- batches: words to remove -----------------------------------------------------------------------------


def _cut_batch(rows: pa.Table, window: int, folder: str) -> pa.Table:
    rows = sorted(rows.to_pylist(), key=lambda r: (r["kind"], r["shard"]))
    start, length, path = rows[0]["data"].split(b" ", 2)
    with open_folder(folder)[0].open_input_file(path.decode()) as source:
        rows[0]["data"] = source.read_at(int(length), int(start))
    reader, (docs, n) = _Reader(rows[0]), (rows[0]["n"] >> 32, rows[0]["n"] & 0xFFFFFFFF)
    ids, null, offsets = reader.take(docs, "<i8"), reader.take(docs, "?"), reader.take(docs + 1, "<i8")
    first, _, place = reader.take(n, "<u4").astype(np.int64), reader.take(n, "<u1"), reader.take(n, "<u4")
    data = reader.rest()
    words = W.words_of(data, offsets, lower=False)
    marks = np.concatenate([np.zeros(0, "<u4"), *(_Reader(r).take(r["n"], "<u4") for r in rows[1:])])[place]
    hit = np.flatnonzero(marks)
    segment, number = np.nonzero((marks[hit][:, None] >> np.arange(MOST, dtype=np.uint32)) & np.uint32(1))
    starts = first[hit][segment] + number
    total = len(words.hash)
    change = np.bincount(starts, minlength=total + 1) - np.bincount(starts + window, minlength=total + 1)
    removed = np.cumsum(change[:total]) > 0
    counts = words.counts
    left = np.flatnonzero(~removed)
    # kept words with one blank after each; a document's last blank is not its own
    size = words.end[left] - words.start[left] + 1
    where = _spread(words.start[left], size)
    out = data[np.minimum(where, max(0, len(data) - 1))]
    ends = np.cumsum(size)
    out[ends - 1] = 32
    owner = words.text[left]
    bounds = np.concatenate(([0], ends))[np.searchsorted(owner, np.arange(docs + 1))]
    raw, cuts = out.tobytes(), bounds.tolist()
    kept = [raw[a : max(a, b - 1)].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    runs = [[]] * docs
    gone = np.bincount(words.text[removed], minlength=docs)
    firsts = words.firsts
    for d in np.flatnonzero(gone).tolist():
        own = np.concatenate(([0], removed[firsts[d] : firsts[d + 1]].astype(np.int8), [0]))
        runs[d] = np.flatnonzero(np.diff(own)).tolist()
    return pa.table({"doc_id": pa.array(ids, mask=null), "n_words": pa.array(counts.astype(np.int64)), "n_removed": pa.array(gone.astype(np.int64)), "kept": pa.array(kept, pa.string()), "removed": pa.array(runs, pa.list_(pa.int32()))})


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, ``kept`` (the words left, joined by one
    blank) and ``removed`` (first and end word of each removed run, one after the other)."""
    spark, size = docs.sparkSession, GRAM if window >= 2 * GRAM else 1
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    common, volume = survey(docs, size)
    shared, shards, folder = spark.sparkContext.broadcast(common), -(-volume // shard_bytes) or 1, new_folder(spark, "batches")
    sent = docs.mapInArrow(lambda b: _send(b, window, size, shared, shards, folder), _ROW)
    found = sent.groupBy("shard").applyInArrow(lambda t: _search_shard(t, window), _BACK)
    return found.groupBy("batch").applyInArrow(lambda t: _cut_batch(t, window, folder), RESULT)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Windows as joined words; a word goes if it is inside one that starts twice.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i : i + 34], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT gram FROM g GROUP BY gram HAVING count(*) > 1),
gone AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM g JOIN twice USING (gram)) GROUP BY r),
kept AS (SELECT d.r, string_agg(x, ' ' ORDER BY p) AS text FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) d
         ANTI JOIN (SELECT r, unnest(ps) AS p FROM gone) n ON n.r = d.r AND n.p = d.p GROUP BY d.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""
