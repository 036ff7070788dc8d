"""Best-fit packing under conflicts.

Documents go into bins of ``capacity`` tokens. A bin never holds two documents of one duplicate cluster,
and at most ``per_source`` documents of one source. Within a shard, items are placed by falling length;
each takes the compatible bin with the least room that suffices. Bins are ordered by residual: a bitmap
over the residuals gives the next residual that has bins (successor search), and the search goes on to
the next until a compatible bin is found; a new bin is opened if there is none. A bin carries a bitmap
of its clusters and ``per_source`` bitmaps of its sources, the k-th for sources with k documents or more.

Shards are dealt by a hash of ``doc_id`` and hold about ``SHARD_ROWS`` rows each, whatever the source or
cluster, so hot sources and clusters are spread over all shards; only a bin at the end of a shard
is less full than it would be without shards. Text is not shuffled.

A document longer than a bin is cut into pieces of a whole bin, and a rest that is placed like a document.
Documents without tokens (null, empty or blank text) need no bin: one row with a null ``bin_id``. A null
source is a source like others; a null cluster conflicts with nothing. Ties are placed by doc_id (nulls
first), then source and cluster; repeated rows are separate documents of one cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.tables import append_columns, table

CAPACITY = 2048
PER_SOURCE = 4
SHARD_ROWS = 4096
_PACKED = "doc_id long, piece int, start long, n_tokens long, bin_id long, bin_start long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("bin_id", pa.int64()), ("bin_start", pa.int64())])


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, cluster): words of the whole text, and a hash of the words as the duplicate cluster."""

    def compute(column: pa.Array) -> list[pa.Array]:
        counts, clusters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in W.text_chunks(column, W.SMALL_CHUNK_BYTES):
            words = W.words_of(data, offsets)
            firsts = words.firsts
            counts.append(words.counts)
            clusters.append(W.run_hashes(words.hash, firsts[:-1], firsts[1:]).astype(np.int64))
        return [pa.array(np.concatenate(counts)), pa.array(np.concatenate(clusters))]

    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), F.col("text").cast("string").alias("text"))
    return append_columns(rows, "text", "n_tokens long, cluster long", compute).drop("text")


class Bins:
    """Open bins of one shard, ordered by residual."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.at: list[dict[int, None]] = [{} for _ in range(capacity + 1)]
        self.occupied = 0  # bit r: some bin has residual r
        self.residual: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset of an item; ``source`` and ``cluster`` are single bits (0: no conflict)."""
        residual = size
        while True:
            left = self.occupied >> residual
            if not left:
                chosen = self._open()
                break
            residual += (left & -left).bit_length() - 1
            chosen = next((b for b in self.at[residual] if not (self.clusters[b] & cluster or self.sources[b][-1] & source)), -1)
            if chosen >= 0:
                break
            residual += 1
        self._move(chosen, self.residual[chosen] - size)
        self.clusters[chosen] |= cluster
        for k, plane in enumerate(self.sources[chosen]):
            if not plane & source:
                self.sources[chosen][k] |= source
                break
        return chosen, self.capacity - self.residual[chosen] - size

    def _open(self) -> int:
        self.residual.append(self.capacity)
        self.clusters.append(0)
        self.sources.append([0] * self.per_source)
        self.at[self.capacity][len(self.residual) - 1] = None
        self.occupied |= 1 << self.capacity
        return len(self.residual) - 1

    def _move(self, b: int, residual: int) -> None:
        old = self.residual[b]
        del self.at[old][b]
        if not self.at[old]:
            self.occupied &= ~(1 << old)
        self.residual[b] = residual
        self.at[residual][b] = None
        self.occupied |= 1 << residual


def pack_shard(rows: list[tuple[int | None, int, str | None, int | None]], shard: int, capacity: int, per_source: int) -> list[tuple]:
    """Rows of ``_PACKED`` for the (doc_id, n_tokens, source, cluster) rows of one shard."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r[2]), r[3] or 0))
    out, items, used, next_bin = [], [], {}, 0
    for doc, tokens, source, cluster in rows:
        whole, rest = divmod(tokens, capacity)
        for piece in range(whole):
            out.append((doc, piece, piece * capacity, capacity, (shard << 32) + next_bin, 0))
            next_bin += 1
        if rest:
            items.append((doc, whole, whole * capacity, rest, source, cluster))
            used[cluster] = used.get(cluster, 0) + 1
        elif not whole:
            out.append((doc, 0, 0, 0, None, None))
    bins = Bins(capacity, per_source)
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(i[4] for i in items))}
    cluster_bit = {c: 1 << k for k, c in enumerate(c for c, n in used.items() if n > 1 and c is not None)}
    for doc, piece, start, size, source, cluster in sorted(items, key=lambda i: -i[3]):
        b, offset = bins.place(size, source_bit[source], cluster_bit.get(cluster, 0))
        out.append((doc, piece, start, size, (shard << 32) + next_bin + b, offset))
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each piece of each item (doc_id, n_tokens, source, cluster): its place in the document, bin and place in the bin."""
    shards = max(1, -(-items.count() // shard_rows))
    dealt = items.select("doc_id", "n_tokens", "source", "cluster").withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        columns = [group[c].to_pylist() for c in ("doc_id", "n_tokens", "source", "cluster")]
        packed = pack_shard(list(zip(*columns, strict=True)), group["shard"][0].as_py(), capacity, per_source)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*packed, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return dealt.groupBy("shard").applyInArrow(run, _PACKED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    return pack(measure(docs), capacity, per_source)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
