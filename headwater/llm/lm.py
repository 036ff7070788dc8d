"""Language-model scoring with an Elias-Fano bigram trie.

Tokens are words, A-Z as a-z, and one end a text. The unigram base of a token seen c times among N
training tokens with V distinct is log10((c + 0.5) / (N + 0.5 (V + 1))). The model mixes it with the
bigram: ``WEIGHT`` times the share of the token after its context, plus the rest of the unigram. Contexts
are the start of a text and all training words; after a word without training occurrences the unigram stands
alone.

1. All training words are counted, packed by slices of their hash. Frequent words, which make up a millionth
   of the training tokens or more (so at most a million words), and their counts are broadcast.
2. All texts are read again for the rare words that follow rare words: the slices that will see the later
   ones ask the counts of the earlier ones, and each gets those of its contexts.
3. All texts are read a third time. Frequent words are scored for the base at once. Every occurrence is sent,
   packed, to a slice: of a rare word by the word, of a frequent one after a rare one by the rare one, of two
   frequent ones by the pair. A slice thus sees all occurrences of its rare words, which are the totals of
   these as contexts, and of its pairs, counts the training ones, and builds its
   trie: contexts, pointers and successors as Elias-Fano levels with quantised probabilities, written to the
   shared folder and memory-mapped where the file system allows. Each distinct pair is looked up once,
   by its context and then by successor search in the context's range; sums go back by text.

No group is larger than a slice: a frequent word's occurrences are spread over as many pairs and slices as
it has neighbours. What is gathered grows with the text, and slices with its size.

Null, empty and blank texts are one token, the end. Null ids are scored. Without training texts N = V = 0
and every base is 0. Repeated rows are scored (and learned from) each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.files import attempt_name, new_folder, open_folder
from headwater.llm.tables import fold, table
from headwater.llm.trie import Trie
from headwater.session import cut_lineage

WEIGHT = 0.3
#: A word is frequent, and broadcast, from one in so many tokens.
FREQUENT = 1_000_000
#: Words are contexts from one in so many tokens; all training words.
RARE = 1 << 62
#: Tokens that a task holds before it sends them off.
HELD = 1_500_000
_NONE = np.uint32(0xFFFFFFFF)
_DOC = np.dtype([("doc", "<i8"), ("null", "?"), ("train", "?"), ("tokens", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])
_PART = np.dtype([("doc", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])


def _slices(docs: DataFrame) -> int:
    return max(8, 2 * docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _squeeze(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def _stretch(data: bytes, n: int, dtype: type) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.frombuffer(pa.decompress(data, n * dtype.itemsize, codec="zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)


def _cuts(where: np.ndarray) -> Iterator[tuple[int, int]]:
    return pairwise(np.flatnonzero(np.diff(where, prepend=-1, append=-2)).tolist()) if len(where) else iter(())


# --- counting ---------------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, tokens, texts = [], 0, 0
        for first, end, data, offsets in W.text_chunks(batch.column("text")):
            held.append(W.words_of(data, offsets).hash)
            tokens += len(held[-1])
            texts += end - first
            if tokens > HELD:
                yield from _counted(held, texts, slices)
                held, tokens, texts = [], 0, 0
        if texts:
            yield from _counted(held, texts, slices)


def _counted(held: list[np.ndarray], texts: int, slices: int) -> Iterator[pa.RecordBatch]:
    word, count = np.unique(np.concatenate(held), return_counts=True)
    where = (word % np.uint64(slices)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    word, count, where = word[order], count[order], where[order]
    rows = [(int(where[a]), word[a:b].tobytes(), _squeeze(count[a:b].astype("<u4")), b - a, 0) for a, b in _cuts(where)]
    rows.append((0, b"", b"", 0, texts))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["slice", "words", "counts", "n", "texts"])


def _merge_counts(rows: pa.Table) -> pa.Table:
    sizes = rows["n"].to_pylist()
    word = np.frombuffer(b"".join(rows["words"].to_pylist()), "<u8")
    count = np.concatenate([_stretch(c, n, "<u4") for c, n in zip(rows["counts"].to_pylist(), sizes, strict=True)]).astype(np.int64)
    distinct, at = np.unique(word, return_inverse=True)
    total = np.bincount(at, weights=count, minlength=len(distinct)).astype("<i8")
    return pa.table({"words": pa.array([distinct.tobytes()], pa.binary()), "counts": pa.array([total.tobytes()], pa.binary()), "n": pa.array([len(distinct)], pa.int64()), "slice": rows["slice"][:1].combine_chunks(), "tokens": pa.array([int(total.sum())], pa.int64()), "texts": pa.array([sum(rows["texts"].to_pylist())], pa.int64())})


class Counts:
    """Totals of the training texts and the frequent words, sorted by hash, with their counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, texts: int) -> None:
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.tokens, self.distinct, self.texts = tokens + texts, distinct + (texts > 0), texts
        self.start, self.end = len(words), len(words) + 1  # ids beside the frequent words' places
        self.least = -(-self.tokens // RARE)  # occurrences of a context

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def contexts(self, others: np.ndarray) -> np.ndarray:
        """How often the contexts were followed by a token: frequent words, start, end, then ``others``; 0 if not used."""
        totals = np.concatenate((self.counts, [self.texts, 0], others))
        return np.where((totals >= self.least) | (np.arange(len(totals)) == self.start), totals, 0)


def count_words(docs: DataFrame) -> tuple[Counts, DataFrame]:
    """Counts of the training rows of ``docs`` (text, train), and those of all words by slices (slice, words, counts, n)."""
    slices = _slices(docs)
    packed = docs.where("train").select("text").mapInArrow(lambda b: _count(b, slices), "slice int, words binary, counts binary, n long, texts long")
    merged = cut_lineage(packed.groupBy("slice").applyInArrow(_merge_counts, "words binary, counts binary, n long, slice int, tokens long, texts long"), "counts")
    tokens, distinct, texts = (x or 0 for x in merged.agg(F.sum("tokens"), F.sum("n"), F.sum("texts")).first())
    least = -(-(tokens + texts) // FREQUENT)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                word, count = np.frombuffer(words, "<u8"), np.frombuffer(counts, "<i8")
                keep = count >= least
                yield pa.RecordBatch.from_arrays([pa.array([x[keep].tobytes()], pa.binary()) for x in (word, count)], ["words", "counts"])

    rows = merged.select("words", "counts").mapInArrow(frequent, "words binary, counts binary").collect()
    return Counts(*(np.frombuffer(b"".join(r[k] for r in rows), t) for k, t in enumerate(("<u8", "<i8"))), tokens, distinct, texts), merged.select("slice", "words", "counts", "n")


# --- totals of rare contexts of rare words ------------------------------------------------------------------

_ASKED = "slice int, words binary, counts binary, targets binary, n long"


def _ask(batches: Iterator[pa.RecordBatch], shared: Broadcast, slices: int) -> Iterator[pa.RecordBatch]:
    """By slices of rare words that rare words follow: the words, and the slices of those that follow."""
    counts: Counts = shared.value
    for batch in batches:
        names, train, held, tokens = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False), [], 0
        for first, end, data, offsets in W.text_chunks(batch.column("text")):
            _, hashes, ident, context, _ = _occurrences(data, offsets, names.slice(first, end - first), train[first:end], counts)
            at = np.flatnonzero((ident == _NONE) & (context == _NONE))
            held.append((hashes[at - 1], (hashes[at] % np.uint64(slices)).astype(np.uint32)))
            tokens += len(hashes)
            if tokens > HELD or end == batch.num_rows:
                word, target = _distinct(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
                where = (word % np.uint64(slices)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                word, target, where = word[order], target[order], where[order]
                rows = [(int(where[a]), word[a:b].tobytes(), None, _squeeze(target[a:b]), b - a) for a, b in _cuts(where)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3, pa.int64()), strict=True)], [f.split()[0] for f in _ASKED.split(", ")])
                held, tokens = [], 0


def _distinct(word: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, sorted by target and word."""
    order = np.lexsort((word, target))
    word, target = word[order], target[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (target[1:] != target[:-1])
    return word[new], target[new]


def _answer(rows: pa.Table) -> pa.Table:
    """For the slices that ask, the counts of one slice's words."""
    known, words, targets = (np.zeros(0, "<u8"), np.zeros(0, "<i8")), [], []
    for row in rows.to_pylist():
        if row["counts"] is not None:
            known = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["counts"], "<i8")
        else:
            words.append(np.frombuffer(row["words"], "<u8"))
            targets.append(_stretch(row["targets"], row["n"], "<u4"))
    out = []
    if words:
        word, target = _distinct(np.concatenate(words), np.concatenate(targets))
        total = np.zeros(len(word), "<i8")
        if len(known[0]):
            at = np.minimum(np.searchsorted(known[0], word), len(known[0]) - 1)
            total = np.where(known[0][at] == word, known[1][at], 0)
        out = [(int(target[a]), 0, 5, word[a:b].tobytes(), _squeeze(total[a:b]), None, b - a) for a, b in _cuts(target.astype(np.int64))]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(_SENT_TYPES), _SENT_TYPES, strict=True)], [f.split()[0] for f in _SENT.split(", ")])


# --- occurrences ------------------------------------------------------------------------------------------

_SENT = "slice int, batch long, kind int, keys binary, contexts binary, docs binary, n long"
_SENT_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]


def _send(batches: Iterator[pa.RecordBatch], shared: Broadcast, slices: int) -> Iterator[pa.RecordBatch]:
    """Rows of one task's texts: kind 0 texts with what is known at once, 1 rare words after frequent ones, 2 pairs of
    frequent words, 3 frequent words after rare ones, 4 pairs of rare words."""
    counts: Counts = shared.value
    part, number = TaskContext.get().partitionId(), 0
    ids = np.concatenate((counts.counts, [0, counts.texts]))
    base_of, known_of = counts.base(ids), ids > 0
    for batch in batches:
        names, train, held, tokens = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False), [], 0
        for first, end, data, offsets in W.text_chunks(batch.column("text")):
            held.append(_occurrences(data, offsets, names.slice(first, end - first), train[first:end], counts))
            tokens += len(held[-1][1])
            if tokens > HELD or end == batch.num_rows:
                yield _sent(held, (part << 24) + number, slices, base_of, known_of)
                held, tokens, number = [], 0, number + 1


def _occurrences(data: np.ndarray, offsets: np.ndarray, names: pa.Array, train: np.ndarray, counts: Counts) -> tuple:
    """(texts, word hash, id or none, context id or none, text) of every token, ends included."""
    words = W.words_of(data, offsets)
    texts = words.texts
    docs = np.zeros(texts, _DOC)
    docs["doc"], docs["null"], docs["train"], docs["tokens"] = names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False), train, words.counts + 1
    ends = np.cumsum(words.counts + 1) - 1
    total = len(words.hash) + texts
    is_word = np.ones(total, bool)
    is_word[ends] = False
    owner = np.repeat(np.arange(texts), words.counts + 1)
    own = np.full(len(words.hash), _NONE)
    if len(counts.words) and len(own):
        at = np.minimum(np.searchsorted(counts.words, words.hash), len(counts.words) - 1)
        own = np.where(counts.words[at] == words.hash, at, _NONE).astype(np.uint32)
    ident, hashes = np.full(total, counts.end, np.uint32), np.zeros(total, np.uint64)
    ident[is_word], hashes[is_word] = own, words.hash
    context = np.empty(total, np.uint32)
    context[1:] = ident[:-1]
    context[ends - words.counts] = counts.start
    return docs, hashes, ident, context, owner


def _sent(held: list[tuple], batch: int, slices: int, base_of: np.ndarray, known_of: np.ndarray) -> pa.RecordBatch:
    shift = np.cumsum([0] + [len(h[0]) for h in held])[:-1]
    docs = np.concatenate([h[0] for h in held])
    hashes, ident, context = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
    owner = np.concatenate([h[4] + s for h, s in zip(held, shift, strict=True)])
    frequent, n = ident != _NONE, len(docs)
    after_rare = context == _NONE
    docs["base"] = np.bincount(owner[frequent], weights=base_of[ident[frequent]], minlength=n)
    docs["known"] = np.bincount(owner[frequent], weights=known_of[ident[frequent]], minlength=n)
    tagged = (owner * 2 + docs["train"][owner]).astype(np.uint32)
    rows = [(batch % slices, batch, 0, _squeeze(docs), None, None, n)]
    previous = np.concatenate((hashes[:1], hashes[:-1]))
    for kind, chosen, key, beside in ((1, ~frequent & ~after_rare, hashes, context), (3, frequent & after_rare, previous, ident), (4, ~frequent & after_rare, hashes, previous)):
        at = np.flatnonzero(chosen)
        where = (key[at] % np.uint64(slices)).astype(np.int64)
        order = np.lexsort((key[at], where))
        at, where = at[order], where[order]
        rows += [(int(where[a]), batch, kind, key[at[a:b]].tobytes(), _squeeze(beside[at[a:b]]), _squeeze(tagged[at[a:b]]), b - a) for a, b in _cuts(where)]
    both = np.flatnonzero(frequent & ~after_rare)
    pair = (context[both].astype(np.uint64) << np.uint64(32)) + ident[both]
    where = (W.mix(pair) % np.uint64(slices)).astype(np.int64)
    order = np.lexsort((pair, where))
    pair, where, tagged = pair[order], where[order], tagged[both[order]]
    for a, b in _cuts(where):
        rows.append((int(where[a]), batch, 2, _squeeze(np.diff(pair[a:b], prepend=np.uint64(0))), None, _squeeze(tagged[a:b]), b - a))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SENT_TYPES, strict=True)], [f.split()[0] for f in _SENT.split(", ")])


# --- slices -----------------------------------------------------------------------------------------------


def _map_trie(folder: str, stem: str, data: bytes) -> Trie:
    """Writes a trie to the shared folder and opens the written file, mapped into memory if it is a local one."""
    from pyarrow import fs, memory_map

    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    path = f"{root}/{attempt_name(stem, 'trie')}"
    with system.open_output_stream(path) as stream:
        stream.write(data)
    if isinstance(system, fs.LocalFileSystem):
        return Trie(memoryview(memory_map(path).read_buffer()))
    with system.open_input_file(path) as source:
        return Trie(memoryview(source.read_buffer()))


def _score_slice(rows: pa.Table, shared: Broadcast, folder: str, weight: float) -> pa.Table:
    """(batch, part): kind 0 rows as they are, and the sums of the slice's occurrences for each batch's texts."""
    counts: Counts = shared.value
    out_batch, out_kind, out_data, out_n = [], [], [], []
    words, contexts, successors, tags, batches, kinds = [], [], [], [], [], []
    behind: dict[int, list[np.ndarray]] = {3: [], 4: []}  # hashes of rare contexts
    asked, totals = [np.zeros(0, "<u8")], [np.zeros(0, "<i8")]
    for row in rows.to_pylist():
        n, kind = row["n"], row["kind"]
        if kind == 0:
            out_batch.append(row["batch"])
            out_kind.append(0)
            out_data.append(row["keys"])
            out_n.append(n)
            continue
        if kind == 5:
            asked.append(np.frombuffer(row["keys"], "<u8"))
            totals.append(_stretch(row["contexts"], n, "<i8"))
            continue
        if kind == 2:
            pair = np.cumsum(_stretch(row["keys"], n, "<u8"))
            contexts.append((pair >> np.uint64(32)).astype(np.uint32))
            successors.append((pair & np.uint64(0xFFFFFFFF)).astype(np.int64))
        elif kind == 3:
            behind[3].append(np.frombuffer(row["keys"], "<u8"))
            contexts.append(np.full(n, _NONE))
            successors.append(_stretch(row["contexts"], n, "<u4").astype(np.int64))
        else:
            words.append(np.frombuffer(row["keys"], "<u8"))
            if kind == 4:
                behind[4].append(_stretch(row["contexts"], n, "<u8"))
            contexts.append(_stretch(row["contexts"], n, "<u4") if kind == 1 else np.full(n, _NONE))
            successors.append(np.zeros(n, np.int64))
        kinds.append(np.full(n, kind, np.uint8))
        tags.append(_stretch(row["docs"], n, "<u4"))
        batches.append(np.full(n, row["batch"]))
    if tags:
        context, successor, tag, batch, kind = (np.concatenate(x) for x in (contexts, successors, tags, batches, kinds))
        is_rare = (kind == 1) | (kind == 4)
        train = (tag & 1).astype(bool)
        base = np.zeros(len(tag))
        base[~is_rare] = counts.base(np.concatenate((counts.counts, [0, counts.texts])))[successor[~is_rare]]
        known = np.zeros(len(tag), bool)
        seen = np.zeros(0, np.int64)
        if words:
            distinct, at = np.unique(np.concatenate(words), return_inverse=True)
            seen = np.bincount(at[train[is_rare]], minlength=len(distinct))
            successor[is_rare] = at + counts.end + 1
            base[is_rare] = counts.base(seen)[at]
            known[is_rare] = seen[at] > 0
        # a rare context is a word of this slice, or one whose count the slice asked for
        asked, totals = np.concatenate(asked), np.concatenate(totals)
        order = np.argsort(asked)
        if behind[3]:
            context[kind == 3] = np.searchsorted(distinct, np.concatenate(behind[3])) + counts.end + 1
        if behind[4]:
            context[kind == 4] = np.searchsorted(asked[order], np.concatenate(behind[4])) + counts.end + 1 + len(seen)
        total_of = counts.contexts(np.concatenate((seen, totals[order])))
        pair = (context.astype(np.int64) << 33) + successor
        distinct, first, at = np.unique(pair, return_index=True, return_inverse=True)
        times = np.bincount(at[train], minlength=len(distinct))
        c, s, unigram = distinct >> 33, distinct & ((1 << 33) - 1), 10 ** base[first]
        total = total_of[c]
        learned = (times > 0) & (total > 0)
        mixed = np.log10(weight * times[learned] / total[learned] + (1 - weight) * unigram[learned])
        trie = _map_trie(folder, f"slice-{rows['slice'][0].as_py():06d}", Trie.build(c[learned], s[learned], mixed))
        place = trie.find(c, s)
        # a context that was never followed by anything leaves the unigram alone
        value = np.log10(np.where(total > 0, 1 - weight, 1.0) * unigram)
        value[place >= 0] = trie.log10(place[place >= 0])
        score = value[at]
        doc = tag >> 1
        order = np.lexsort((doc, batch))
        start = np.flatnonzero(np.concatenate(([True], (batch[order][1:] != batch[order][:-1]) | (doc[order][1:] != doc[order][:-1]))))
        sums = np.zeros(len(start), _PART)
        sums["doc"] = doc[order[start]]
        sums["known"] = np.add.reduceat(known[order].astype(np.int64), start)
        sums["base"] = np.add.reduceat(np.where(is_rare, base, 0.0)[order], start)
        sums["score"] = np.add.reduceat(score[order], start)
        for a, b in _cuts(batch[order[start]]):
            out_batch.append(int(batch[order[start[a]]]))
            out_kind.append(1)
            out_data.append(sums[a:b].tobytes())
            out_n.append(b - a)
    return pa.table([pa.array(out_batch, pa.int64()), pa.array(out_kind, pa.int32()), pa.array(out_data, pa.binary()), pa.array(out_n, pa.int64())], names=["batch", "kind", "data", "n"])


def _sum_batch(rows: pa.Table, counts: dict[str, int]) -> pa.Table:
    parts = rows.to_pylist()
    docs = next(_stretch(r["data"], r["n"], _DOC) for r in parts if r["kind"] == 0).copy()
    for r in parts:
        if r["kind"] == 1:
            part = np.frombuffer(r["data"], _PART)
            for name in ("known", "base", "score"):
                docs[name][part["doc"]] += part[name]
    n = len(docs)
    return pa.table(
        {"doc_id": pa.array(docs["doc"], mask=docs["null"]), "train": pa.array(docs["train"]), "n_tokens": pa.array(docs["tokens"]), "n_known": pa.array(docs["known"])}
        | {"train_tokens": pa.array(np.full(n, counts["tokens"])), "base_score": pa.array(docs["base"]), "score": pa.array(docs["score"])}
    )


def score_documents(docs: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """Scores all rows of ``docs`` (doc_id, text, train) with a model of those with ``train``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    counts, by_slice = count_words(docs)
    shared, folder, slices = spark.sparkContext.broadcast(counts), new_folder(spark, "trie"), _slices(docs)
    tokens = {"tokens": int(counts.tokens)}
    asked = docs.mapInArrow(lambda b: _ask(b, shared, slices), _ASKED)
    known = by_slice.select("slice", "words", "counts", F.lit(None).cast("binary").alias("targets"), "n")
    answers = asked.unionAll(known).groupBy("slice").applyInArrow(_answer, _SENT)
    sent = docs.mapInArrow(lambda b: _send(b, shared, slices), _SENT)
    sums = sent.unionAll(answers).groupBy("slice").applyInArrow(lambda t: _score_slice(t, shared, folder, weight), "batch long, kind int, data binary, n long")
    result = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sums.groupBy("batch").applyInArrow(lambda t: _sum_batch(t, tokens), result)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", fold("doc_id", 5) != 1)
    return score_documents(docs).withColumn("held_out", ~F.col("train")).drop("train")
