"""N-gram Jaccard join by universe partition and the pigeonhole principle.

Two sets of sizes r and s with Jaccard similarity p/100 or more differ in at most
H = (r + s) (100 - p) / (100 + p) elements. Hash the elements into m > H segments: at least m - H
segments of the two sets are equal, so among any H + 1 segments of one set some segment equals the
other set's.

* **Levels.** Sizes fall into bands that grow by ``GROWTH``; each band is a level with its own m. A set
  is indexed at its own level and also probes the level below if that can hold partners. Each segment
  that is not empty gives one signature: a hash of its subset, its number and the level.
* **Cost-based allocation.** A set may do without all its segments but H + 1, so m has slack, and the
  dearest are left out: empty segments, and signatures that more than ``CAP`` distinct sets share. A set
  that has fewer cheap segments than it needs is *crowded*. A link is found by cheap segments unless both
  ends are crowded.
* **One-deletion neighbourhoods.** Crowded sets meet again on half as many, larger segments, by their
  subsets and all subsets with one element left out. Such a segment also matches one that differs by an
  element, so it counts twice in the pigeonhole (once if it has a single element), and is far rarer. A
  match takes the whole subset of one side at least. Segments with dear signatures are left out again, if
  the set has enough others; sets that have not are compared with their like in every dear bucket too.
* **Single elements.** Hashing may leave a small set's segments so empty or full that even all of them count less
  than it needs, and no segment need match. Such sets meet a third time, each element its own signature: a set
  needs H + 1 of its elements, and sets that have not enough cheap ones are compared in every dear bucket too.
* **Verification.** In each bucket all sets are first compared with one of them (a star) and with the next by
  key (a ring); buckets of one group of near copies have mostly the same stars and rings. Then all pairs that
  links do not join yet, so a group of near copies takes a few comparisons for each of its sets. A comparison first
  bounds the difference from below by parity sketches: bit i says whether an odd number of elements hash
  to i, and two sketches differ in no more bits than the sets in elements. Buckets are compared in blocks
  of sketches, and only the sets that may still link with another leave the task, not the pairs. Their whole
  sets are written once to the shared folder, look-alikes side by side (by least element), and the buckets are
  compared again in blocks that hold places in these files: the intersection of the whole sets decides, and a
  task sends off a spanning forest of its links.

Equal sets are one set from the start. Signatures travel packed by slices of the hash space, one row
per batch and slice. Elements, sets and signatures are told apart by hashes of 64, 64 and 32 bits plus
slice; signatures only propose pairs.

A text's elements: its distinct runs of ``words`` consecutive words, A-Z as a-z; with fewer words, the
whole sequence as one. Null, empty and blank texts have no elements and link with nothing: their
component is their own id. Repeated rows and ties are equal sets. Null ids join their copies' component.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.components import connected_components, forest
from headwater.llm.files import delete_folder, new_folder, open_folder
from headwater.llm.tables import give_back, table, tidy
from headwater.session import cut_lineage

GROWTH = 1.8
SLACK = 1.25
#: A signature shared by more distinct sets is dear.
CAP = 8
#: The same for one-deletion neighbourhoods.
CAP_DELETIONS = 64
#: Signatures that a task holds before it sends them off.
HELD = 500_000
#: Sets of a bucket that are compared in one block, and the elements of these sets on average at most.
BLOCK = 512
BLOCK_ELEMENTS = 1 << 20
#: Members of a block that are compared pair by pair, not by a matrix.
FEW = 16
#: Elements of sets that a task holds at once, or those of one pair or block.
STEP_ELEMENTS = 1 << 22
#: Bytes between two sets in a file that are read along rather than skipped.
GAP = 1 << 16
#: Sets with one least element that are written to one file.
SIDE_BY_SIDE = 4096
#: Ids of one broadcast filter at most; beyond, texts are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_edges = [1]
while _edges[-1] < 1 << 40:
    _edges.append(max(_edges[-1] + 1, int(_edges[-1] * GROWTH)))
EDGES = np.array(_edges)


def largest_difference(r: np.ndarray, s: np.ndarray, percent: int) -> np.ndarray:
    return (r + s) * (100 - percent) // (100 + percent)


def level_bounds(level: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest size of the level's band, and the most that sets compared at the level differ by."""
    top = EDGES[level + 1] - 1
    return top, largest_difference(top, top * 100 // percent, percent)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct element hashes, the text of each, the number and a 64-bit identity of each text's set."""
    element, owner = W.grams(W.words_of(data, offsets), words, whole_if_fewer=True)
    order = np.argsort(W.mix(element + W.mix(owner.astype(np.uint64))))
    e, o = element[order], owner[order]
    again = np.zeros(len(e), bool)
    again[1:] = (e[1:] == e[:-1]) & (o[1:] == o[:-1])
    keep = np.ones(len(e), bool)
    keep[order[again]] = False
    element, owner = element[keep], owner[keep]
    texts = len(offsets) - 1
    size = np.bincount(owner, minlength=texts)
    identity = np.zeros(texts, np.uint64)
    np.add.at(identity, owner, W.mix(element))
    return element, owner, size, W.mix(identity + size.astype(np.uint64))


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of the sketch of a set: a power of two, at least 64, between two and four times its size."""
    return np.where(size > 0, 1 << np.maximum(6, np.ceil(np.log2(np.maximum(size, 1) * 2)).astype(np.int64)), 0)


def sketches(element: np.ndarray, owner: np.ndarray, size: np.ndarray) -> bytes:
    """The parity sketches of the sets, one after the other."""
    bits = sketch_bits(size)
    base = np.cumsum(bits) - bits
    place = base[owner] + (W.mix(element ^ np.uint64(0x2545F4914F6CDD1D)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the difference of two sets from their sketches; the longer is folded to the shorter."""
    if len(x) > len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def _half(sketch: bytes) -> bytes:
    """The sketch folded once, if it is longer than a word."""
    words = np.frombuffer(sketch, np.uint64)
    return bytes(sketch) if len(words) < 2 else (words[: len(words) // 2] ^ words[len(words) // 2 :]).tobytes()


def signatures(element: np.ndarray, owner: np.ndarray, size: np.ndarray, level: np.ndarray, needed: np.ndarray, percent: int, deletions: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the sets at ``level`` (-1: none), the set of each, whether an element is left out, and how much
    more the set's segments count than it needs.

    ``needed``: how much a set may differ from its partners at that level.
    """
    on = level >= 0
    _, most = level_bounds(np.maximum(level, 0), percent)
    parts = most // 2 + 1 if deletions else most + 1
    m = np.where(on, np.ceil(parts * SLACK).astype(np.int64), 0)
    base = np.concatenate(([0], np.cumsum(m)))
    own = on[owner]
    element, owner = element[own], owner[own]
    if not len(element):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.full(len(size), -1)
    segment = ((element >> np.uint64(32)) * m[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = base[owner] + segment
    value = W.mix(element ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, cell, value)
    held = np.bincount(cell, minlength=base[-1])
    filled = np.flatnonzero(held)
    set_of = np.repeat(np.arange(len(size)), m)
    place = np.arange(base[-1]) - base[set_of]
    tag = W.mix((level[set_of].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64) + np.uint64(int(deletions) << 62))
    worth = np.minimum(held[filled], 2 if deletions else 1)
    spare = np.bincount(set_of[filled], weights=worth, minlength=len(size)).astype(np.int64) - (needed + 1)
    found, who = W.mix(sums[filled] + tag[filled]), set_of[filled]
    less = np.zeros(len(found), np.uint8)
    if deletions:
        several = held[cell] > 1
        found = np.concatenate((found, W.mix(sums[cell] - value + tag[cell])[several]))
        who = np.concatenate((who, owner[several]))
        less = np.concatenate((less, np.ones(several.sum(), np.uint8)))
    return found, who, less, spare


def element_signatures(element: np.ndarray, owner: np.ndarray, size: np.ndarray, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same with each element a segment of its own, for sets of all sizes alike."""
    return W.mix(element ^ np.uint64(0x14057B7EF767814F)), owner, np.zeros(len(element), np.uint8), size - (needed + 1)


_PACKED = "slice int, kind int, signature binary, key binary, role binary, less binary, docs binary, sketches binary"
_DOC = np.dtype([("doc", "<i8"), ("null", "?"), ("key", "<u8"), ("n", "<i8"), ("least", "<i8"), ("own", "<i4"), ("below", "<i4")])


def _pack(batches: Iterator[pa.RecordBatch], slices: int, words: int, percent: int, deletions: bool, singly: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, seen, held = batch.column("doc_id"), np.zeros(0, np.uint64), 0
        found, keys, roles, lesses, docs, marks = ([] for _ in range(6))
        for first, end, data, offsets in W.text_chunks(batch.column("text"), W.SMALL_CHUNK_BYTES):
            element, owner, size, identity = shingle_sets(data, offsets, words)
            _, at = np.unique(identity, return_index=True)
            fresh = np.zeros(len(size), bool)
            fresh[at] = True
            fresh &= (size > 0) & ~np.isin(identity, seen)
            seen = np.concatenate((seen, identity[fresh]))
            own = np.where(size > 0, np.searchsorted(EDGES, size, "right") - 1, -1)
            below_top = EDGES[np.maximum(own, 0)] - 1
            # single elements are the same at all levels
            below = np.where((own > 0) & (size * percent <= below_top * 100) & (not singly), own - 1, -1)
            doc = np.zeros(end - first, _DOC)
            part = ids.slice(first, end - first)
            doc["doc"], doc["null"], doc["key"], doc["n"] = part.fill_null(0).to_numpy(), part.is_null().to_numpy(zero_copy_only=False), identity, size
            doc["least"][size > 0] = np.minimum.reduceat(element, np.searchsorted(owner, np.flatnonzero(size))).astype(np.int64) if len(element) else 0
            for role, (name, level, partner) in enumerate((("own", own, size * 100 // percent), ("below", below, below_top))):
                # spare segments are a matter of the set, so copies get them as well
                needed = largest_difference(size, partner, percent)
                if singly and name == "own":
                    sig, who, less, spare = element_signatures(element, owner, size, needed)
                else:
                    sig, who, less, spare = signatures(element, owner, size, level, needed, percent, deletions)
                doc[name] = np.where(level >= 0, spare, 1 << 30)
                use = fresh[who]
                found.append(sig[use])
                keys.append(identity[who[use]])
                roles.append(np.full(use.sum(), role, np.uint8))
                lesses.append(less[use])
            docs.append(doc)
            marks.append(sketches(element, owner, size))
            held += sum(len(x) for x in found[-2:])
            if held > HELD or end == batch.num_rows:
                yield from _packed_rows(*(np.concatenate(x) for x in (found, keys, roles, lesses, docs)), b"".join(marks), slices, deletions)
                found, keys, roles, lesses, docs, marks = ([] for _ in range(6))
                held = 0


def _packed_rows(found: np.ndarray, keys: np.ndarray, roles: np.ndarray, lesses: np.ndarray, docs: np.ndarray, marks: bytes, slices: int, deletions: bool) -> Iterator[pa.RecordBatch]:
    """One row for each slice that signatures fall into, and one with the documents."""
    where = (found & np.uint64(0xFFFFFFFF)) % np.uint64(slices)
    order = np.argsort(where, kind="stable")
    found, keys, roles, lesses, where = (found[order] >> np.uint64(32)).astype(np.uint32), keys[order], roles[order], lesses[order], where[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(where, prepend=-1, append=-2)) if len(where) else np.zeros(1, np.int64)
    rows = []
    for a, b in pairwise(cuts):
        rows.append((int(where[a]), 1, found[a:b].tobytes(), keys[a:b].tobytes(), np.packbits(roles[a:b]).tobytes(), np.packbits(lesses[a:b]).tobytes() if deletions else None, None, None))
    rows.append((int(docs["key"][0] % np.uint64(slices)), 0, None, None, None, None, docs.tobytes(), marks))
    for a in range(0, len(rows), 512):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 512], strict=True), _PACKED_TYPES, strict=True)], _PACKED_NAMES)


_PACKED_NAMES = [f.split()[0] for f in _PACKED.split(", ")]
_PACKED_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 6]

_FOUND = "kind int, doc_id long, key long, n long, least long, own int, below int, keys array<long>, sketch binary, coarse binary"
_FOUND_SCHEMA = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("least", pa.int64()), ("own", pa.int32()), ("below", pa.int32()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary()), ("coarse", pa.binary())])


def _rows(kind: int, rows: int, **columns: pa.Array) -> pa.Table:
    return pa.table([pa.array(np.full(rows, kind, np.int32))] + [columns.get(f.name, pa.nulls(rows, f.type)) for f in list(_FOUND_SCHEMA)[1:]], schema=_FOUND_SCHEMA)


def _joined_bytes(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


def _buckets(packed: pa.Table, cap: int, deletions: bool) -> pa.Table:
    """Of one slice: kind 0 documents; 1 cheap and 2 dear buckets of two or more sets, equal ones once, the ``n`` sets
    with whole subsets first; 3 how much a set's dear segments count in a role (``own`` = role, ``n`` = count)."""
    out = []
    docs = _joined_bytes(packed["docs"], _DOC)
    if len(docs):
        ends = np.concatenate(([0], np.cumsum(sketch_bits(docs["n"]) // 8)))
        sketch = pa.Array.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(x for x in packed["sketches"].to_pylist() if x))])
        coarse = [_half(x.as_buffer()) for x in sketch]
        out.append(_rows(0, len(docs), sketch=sketch.cast(pa.binary()), coarse=pa.array(coarse, pa.binary()), doc_id=pa.array(docs["doc"], mask=docs["null"]), key=pa.array(docs["key"].astype(np.int64)), n=pa.array(docs["n"]), least=pa.array(docs["least"]), own=pa.array(docs["own"]), below=pa.array(docs["below"])))
    sig, key = _joined_bytes(packed["signature"], np.uint32), _joined_bytes(packed["key"], np.uint64)
    role = np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(r, np.uint8), count=len(x) // 4) for r, x in zip(packed["role"].to_pylist(), packed["signature"].to_pylist(), strict=True) if x)])
    less = np.zeros(len(role), bool)
    if deletions:
        less = np.concatenate([less[:0], *(np.unpackbits(np.frombuffer(r, np.uint8), count=len(x) // 4).astype(bool) for r, x in zip(packed["less"].to_pylist(), packed["signature"].to_pylist(), strict=True) if x)])
    order = np.argsort(sig, kind="stable")
    shared = np.zeros(len(sig), bool)
    shared[1:] = sig[order][1:] == sig[order][:-1]
    shared[:-1] |= shared[1:]
    order = order[shared]
    # each set once a signature, by its whole subset if it has that
    order = order[np.lexsort((less[order], key[order], sig[order]))]
    again = np.zeros(len(order), bool)
    again[1:] = (sig[order][1:] == sig[order][:-1]) & (key[order][1:] == key[order][:-1])
    order = order[~again]
    order = order[np.lexsort((key[order], less[order], sig[order]))]
    sig, key, role, less = sig[order], key[order], role[order], less[order]
    if len(sig):
        start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        size = np.diff(start, append=len(sig))
        whole_ones = np.add.reduceat((~less).astype(np.int64), start)
        use = (size > 1) & (whole_ones > 0)
        start, size, whole_ones = start[use], size[use], whole_ones[use]
        if len(start):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mix(key + less * np.uint64(0x9E3779B97F4A7C15)))))
            _, first = np.unique(sums[start + size] - sums[start], return_index=True)
            for kind, chosen in ((1, first[size[first] <= cap]), (2, first[size[first] > cap])):
                if len(chosen):
                    n = size[chosen]
                    index = np.repeat(start[chosen] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(key[index].astype(np.int64)))
                    out.append(_rows(kind, len(chosen), keys=lists, n=pa.array(whole_ones[chosen])))
            dear = size > cap
            if dear.any():
                n = size[dear]
                index = np.repeat(start[dear] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                for r in (0, 1):
                    of_role = index[role[index] == r]
                    sets, at = np.unique(key[of_role], return_inverse=True)
                    count = np.bincount(at, weights=np.where(less[of_role], 1, 2 if deletions else 1), minlength=len(sets)).astype(np.int64)
                    out.append(_rows(3, len(sets), key=pa.array(sets.astype(np.int64)), own=pa.array(np.full(len(sets), r, np.int32)), n=pa.array(count)))
    return pa.concat_tables(out) if out else _FOUND_SCHEMA.empty_table()


def _bucket_table(docs: DataFrame, words: int, percent: int, cap: int, deletions: bool = False, singly: bool = False) -> DataFrame:
    spark = docs.sparkSession
    slices = max(8, 2 * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def gathered(packed: pa.Table) -> pa.Table:
        made = _buckets(packed, cap, deletions)
        give_back()
        return made

    packed = docs.mapInArrow(tidy(lambda batches: _pack(batches, slices, words, percent, deletions, singly)), _PACKED)
    return cut_lineage(packed.groupBy("slice").applyInArrow(gathered, _FOUND), "buckets")


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The sets of texts that are those of the key, once a task; a repeated id may have other texts."""
    seen = np.zeros(0, np.uint64)
    for batch in batches:
        keys, others = batch.column("key").to_numpy().astype(np.uint64), ["key", "rep", "least", "salt"]
        for first, end, data, offsets in W.text_chunks(batch.column("text"), W.SMALL_CHUNK_BYTES):
            element, owner, size, identity = shingle_sets(data, offsets, words)
            order = np.lexsort((element, owner))
            element, cuts = element[order], np.concatenate(([0], np.cumsum(size)))
            own = np.flatnonzero((identity == keys[first:end]) & ~np.isin(identity, seen))
            own = own[np.unique(identity[own], return_index=True)[1]]
            seen = np.concatenate((seen, identity[own]))
            sets = pa.array([element[cuts[i] : cuts[i + 1]].tobytes() for i in own], pa.binary())
            chosen = pa.array(own + first)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(chosen) for c in others), sets], [*others, "elements"])


_STORED = "key long, rep long, n long, file long, at long"


def _store(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Writes the sets of a partition to one file, whose name is a number that no other attempt uses."""
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    name, at, stream = uuid.uuid4().int >> 65, 0, None
    for batch in batches:
        if stream is None:
            stream = system.open_output_stream(f"{root}/{name:016x}")
        sets = [x.as_buffer() for x in batch.column("elements")]
        size = np.array([len(x) for x in sets], np.int64)
        for x in sets:
            stream.write(x)
        places = at + np.cumsum(size) - size
        at += int(size.sum())
        columns = [batch.column("key"), batch.column("rep"), pa.array(size // 8), pa.array(np.full(len(sets), name)), pa.array(places)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "rep", "n", "file", "at"])
    if stream is not None:
        stream.close()


def _fetch(folder: str, file: np.ndarray, at: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """The sets at these places; equal places are read once, and near ones together."""
    system, root = open_folder(folder)
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(file)
    order = np.lexsort((at, file))
    ends = (at + 8 * n)[order]
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(file[order]) != 0) | (at[order][1:] > ends[:-1] + GAP)))) if len(order) else []
    source, opened = None, None
    for a, b in pairwise([*cut, len(order)]):
        first = order[a]
        if opened != file[first]:
            if source is not None:
                source.close()
            source, opened = system.open_input_file(f"{root}/{file[first]:016x}"), file[first]
        start = int(at[first])
        data = np.frombuffer(source.read_at(int(ends[a:b].max()) - start, start), np.uint64)
        for i in order[a:b]:
            x = (int(at[i]) - start) // 8
            out[i] = data[x : x + int(n[i])]
    if source is not None:
        source.close()
    return out


def _may_link(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches do not rule out a link."""
    for batch in batches:
        most = largest_difference(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
        x, y = batch.column("sa"), batch.column("sb")
        near = [least_difference(np.frombuffer(x[i].as_buffer(), np.uint8), np.frombuffer(y[i].as_buffer(), np.uint8)) <= most[i] for i in range(batch.num_rows)]
        keep = pa.array(near, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def _link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(x, y)
    same = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * same >= percent * (len(x) + len(y) - same)


def _steps(weights: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with ``STEP_ELEMENTS`` elements, or one row of more."""
    sums, first = np.concatenate(([0], np.cumsum(weights))), 0
    while first < len(weights):
        end = max(first + 1, int(np.searchsorted(sums, sums[first] + STEP_ELEMENTS, "right")) - 1)
        yield first, end
        first = end


def _verify(batches: Iterator[pa.RecordBatch], folder: str, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = {c: batch.column(c).to_numpy() for c in ("fa", "aa", "na", "fb", "ab", "nb")}
        linked = np.zeros(batch.num_rows, bool)
        for first, end in _steps(place["na"] + place["nb"]):
            both = [np.concatenate((place[c + "a"][first:end], place[c + "b"][first:end])) for c in "fan"]
            sets = _fetch(folder, *both)
            for i in range(end - first):
                linked[first + i] = _link(sets[i], sets[end - first + i], percent)
        keep = pa.array(linked)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "u", "v")], ["a", "b", "u", "v"])


class _Verifier:
    """Compares candidate pairs of keys by the whole sets of one document each."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> None:
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent

    def store(self, keys: DataFrame, folder: str) -> DataFrame:
        """(key, rep, n, file, at) of the sets of the distinct ``keys``, written to ``folder``, those with one least
        element side by side. A least element that very many sets have is split over files."""
        words = self.words
        chosen = cut_lineage(self.classes.join(keys, "key", "left_semi").select("rep", "key", "least"), "chosen")
        few = chosen.count() <= BROADCAST_IDS
        hot = chosen.groupBy("least").agg(F.ceil(F.count("*") / SIDE_BY_SIDE).alias("files")).where("files > 1")
        salted = chosen.join(hot, "least", "left").select("rep", "key", "least", F.pmod(F.xxhash64("key"), F.coalesce("files", F.lit(1))).cast("int").alias("salt"))
        texts = self.docs.withColumnRenamed("doc_id", "rep").join(F.broadcast(salted) if few else salted, "rep").select("key", "rep", "least", "salt", "text")
        sets = texts.mapInArrow(tidy(lambda b: _sets(b, words)), "key long, rep long, least long, salt int, elements binary")
        dealt = sets.repartition("least", "salt").sortWithinPartitions("least", "salt").select("key", "rep", "elements")
        stored = cut_lineage(dealt.mapInArrow(tidy(lambda b: _store(b, folder)), _STORED), "stored")
        # equal rows of several tasks are written several times
        return stored.groupBy("key").agg(F.min(F.struct("rep", "n", "file", "at")).alias("place")).select("key", "place.*")

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b, u, v): pairs of keys that link, with the smallest document ids of their sets."""
        percent, folder = self.percent, new_folder(self.docs.sparkSession, "elements")
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sizes, marks = self.classes.select("key", "n"), self.classes.select("key", "sketch")
        fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent
        pairs = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").where(fits)
        pairs = pairs.join(marks.toDF("a", "sa"), "a").join(marks.toDF("b", "sb"), "b")
        pairs = cut_lineage(pairs.mapInArrow(tidy(lambda b: _may_link(b, percent)), "a long, b long").distinct(), "pairs")
        stored = self.store(pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct(), folder)
        joined = pairs.join(stored.toDF("b", "v", "nb", "fb", "ab"), "b").join(stored.toDF("a", "u", "na", "fa", "aa"), "a")
        # pairs of one file meet in a few tasks, in the order of the file
        near = joined.repartition(F.col("fa"), F.pmod(F.xxhash64("b"), F.lit(8))).sortWithinPartitions("fa", "aa")
        linked = cut_lineage(near.mapInArrow(tidy(lambda b: _verify(b, folder, percent)), "a long, b long, u long, v long").distinct(), "linked")
        delete_folder(folder)
        return linked


def _folded(marks: list[bytes], size: int) -> np.ndarray:
    """Sketches of one length folded to ``size`` bytes, as rows of 64-bit words."""
    rows = np.frombuffer(b"".join(marks), np.uint64).reshape(len(marks), -1, size // 8)
    return np.bitwise_xor.reduce(rows, axis=1)


class _Cells:
    """The members of the blocks of a batch as arrays; block i has the members ``cuts[i]`` to ``cuts[i + 1]``."""

    def __init__(self, column: pa.Array) -> None:
        values = column.flatten()
        self.cuts = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
        self.fields = {f.name: values.field(k) for k, f in enumerate(values.type)}
        self.of = {name: x.to_numpy(zero_copy_only=False) for name, x in self.fields.items() if name != "sketch"}


def _open(of: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may still link: other labels, one with its whole subset, neither the bucket's first, sizes near."""
    label, n, whole, first = (of[f] for f in ("label", "n", "whole", "first"))
    fits = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
    return fits & (label[i] != label[j]) & (whole[i] | whole[j]) & ~first[i] & ~first[j]


def _rest(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keys of the members of blocks that sketches do not keep from a link with another member."""
    for batch in batches:
        cells, found = _Cells(batch.column("members")), [np.zeros(0, np.int64)]
        marks, of = cells.fields["sketch"].to_pylist(), cells.of
        length = np.array([len(x) for x in marks])
        for first, end in pairwise(cells.cuts):
            by_size = [(size, first + np.flatnonzero(length[first:end] == size)) for size in np.unique(length[first:end])]
            for k, (small, left) in enumerate(by_size):
                for _, right in by_size[k:]:
                    y = _folded([marks[j] for j in right], small)
                    step = max(1, (1 << 22) // y.nbytes)
                    for a in range(0, len(left), step):
                        part = left[a : a + step]
                        differ = np.bitwise_count(_folded([marks[i] for i in part], small)[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                        i, j = part[:, None], right[None, :]
                        near = _open(of, i, j, percent) & (differ <= largest_difference(of["n"][i], of["n"][j], percent))
                        found += [of["key"][part[near.any(axis=1)]], of["key"][right[near.any(axis=0)]]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["key"])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, by products of their incidence matrix; elements that the same sets
    hold are one column, with their number as its weight."""
    k, size = len(sets), np.array([len(x) for x in sets])
    element, owner = np.concatenate(sets), np.repeat(np.arange(k), size)
    _, at, held = np.unique(element, return_inverse=True, return_counts=True)
    several = held[at] > 1
    at, owner = at[several], owner[several]
    holders = np.zeros(len(held), np.uint64)
    np.add.at(holders, at, W.mix(owner.astype(np.uint64) + np.uint64(1)))
    shown = np.flatnonzero(held > 1)
    _, first, weight = np.unique(holders[shown], return_index=True, return_counts=True)
    column = np.full(len(held), -1)
    column[shown[first]] = np.arange(len(first))
    use = column[at] >= 0
    at, owner = column[at[use]], owner[use]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    common = np.zeros((k, k), np.int64)
    for low in range(0, len(weight), 4096):
        high = min(low + 4096, len(weight))
        a, b = np.searchsorted(at, (low, high))
        matrix = np.zeros((k, high - low))
        matrix[owner[a:b], at[a:b] - low] = 1
        common += np.rint((matrix * weight[low:high]) @ matrix.T).astype(np.int64)
    common[np.arange(k), np.arange(k)] = size
    return common


def _links_in_blocks(batches: Iterator[pa.RecordBatch], folder: str, percent: int) -> Iterator[pa.RecordBatch]:
    """(u, v): a spanning forest of the links between members of the blocks of a task."""
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        cells = _Cells(batch.column("members"))
        of = cells.of
        weights = np.add.reduceat(np.append(of["n"], 0), cells.cuts[:-1]) if len(cells.cuts) > 1 else np.zeros(0, np.int64)
        for low, high in _steps(weights):
            first, end = cells.cuts[low], cells.cuts[high]
            # a set is in many blocks, and read once
            _, at, code = np.unique(of["key"][first:end], return_index=True, return_inverse=True)
            sets = _fetch(folder, *(of[f][first:end][at] for f in ("file", "at", "n")))
            rep, n, pairs = of["rep"][first:end][at], of["n"][first:end][at], [np.zeros((0, 2), np.int64)]
            for a, b in pairwise(cells.cuts[low : high + 1]):
                i, j = (x + a for x in np.triu_indices(b - a, 1))
                keep = _open(of, i, j, percent)
                i, j = code[i[keep] - first], code[j[keep] - first]
                if b - a > FEW:
                    members = np.unique(np.concatenate((i, j)))
                    if len(members):
                        common = _common([sets[m] for m in members])
                        same = common[np.searchsorted(members, i), np.searchsorted(members, j)]
                        linked = 100 * same >= percent * (n[i] + n[j] - same)
                        us.append(rep[i[linked]])
                        vs.append(rep[j[linked]])
                elif len(i):
                    pairs.append(np.column_stack((np.minimum(i, j), np.maximum(i, j))))
            # a pair meets in many small buckets, and is compared once
            several = np.unique(np.concatenate(pairs), axis=0)
            linked = np.array([_link(sets[i], sets[j], percent) for i, j in several], bool)
            us.append(rep[several[linked, 0]])
            vs.append(rep[several[linked, 1]])
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs = [u], [v]
    u, v = us[0], vs[0]
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _linked_in_buckets(verifier: _Verifier, buckets: DataFrame, rest_of: str, among: DataFrame | None = None) -> DataFrame:
    """(u, v): links in buckets, every set with the bucket's first, then the rest of the buckets that ``rest_of`` selects.

    In other buckets the sets of ``among`` (key) are compared with each other.
    """
    stars = buckets.select(F.col("keys")[0].alias("a"), F.explode(F.slice("keys", 2, 1 << 30)).alias("b"))
    ordered, last = F.array_sort("keys"), F.size("keys") - 1
    rings = buckets.where(F.size("keys") > 2).select(F.explode(F.arrays_zip(F.slice(ordered, 1, last).alias("a"), F.slice(ordered, 2, last).alias("b"))).alias("p"))
    links = verifier.links(stars.unionAll(rings.select("p.a", "p.b")))
    many = cut_lineage(buckets.where(F.size("keys") > 2).select(F.monotonically_increasing_id().alias("bucket"), F.expr(rest_of).alias("all"), "n", "keys"), "many")
    members = many.select("bucket", F.col("keys")[0].alias("star"), "all", "n", F.posexplode("keys").alias("place", "key"))
    members = members.select("bucket", "star", "all", "key", (F.col("place") == 0).alias("first"), (F.col("place") < F.col("n")).alias("whole"))
    if among is None:
        members = members.where("all")
    else:
        members = members.join(among.select("key", F.lit(True).alias("chosen")), "key", "left").where("all OR (chosen AND NOT first)").drop("chosen")
    return links.select("u", "v").unionAll(_links_of_rest(verifier, members, links))


def _links_of_rest(verifier: _Verifier, members: DataFrame, links: DataFrame) -> DataFrame:
    """(u, v): links between bucket members that ``links`` do not join yet."""
    percent, folder = verifier.percent, new_folder(verifier.docs.sparkSession, "elements")
    labels = cut_lineage(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).toDF("key", "label"), "labels")
    members = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    members = members.join(verifier.classes.select("key", F.col("n").cast("long").alias("n")), "key")
    members = cut_lineage(_open_members(members), "open")
    sketched = members.join(verifier.classes.select("key", F.col("coarse").alias("sketch")), "key")
    near = _blocks(sketched, ["key", "label", "n", "first", "whole", "sketch"]).mapInArrow(tidy(lambda b: _rest(b, percent)), "key long")
    stored = verifier.store(near.distinct(), folder)
    placed = _open_members(members.join(stored.drop("n"), "key"))
    blocks = _blocks(placed, ["key", "label", "n", "first", "whole", "rep", "file", "at"])
    joined = cut_lineage(blocks.mapInArrow(tidy(lambda b: _links_in_blocks(b, folder, percent)), "u long, v long"), "joined")
    delete_folder(folder)
    return joined


def _open_members(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one label; in others nothing is left to compare."""
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks")
    labels = members.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"), blocks)
    return members.drop("blocks").join(labels.where("least <> most").select("bucket", "blocks"), "bucket")


def _blocks(members: DataFrame, fields: list[str]) -> DataFrame:
    """(members): each two blocks of a bucket together; those of buckets with one star are dealt to the same task."""
    own, blocks = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"), F.col("blocks")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    blocked = members.withColumn("own", own).withColumn("other", other).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    dealt = blocked.select("star", "bucket", "low", "high", F.struct(*fields).alias("member")).repartition("star", "low", "high")
    return dealt.groupBy("star", "bucket", "low", "high").agg(F.collect_list("member").alias("members")).select("members")


def _crowded(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, key) of the sets whose cheap segments do not count enough, one document each."""
    dear = found.where("kind = 3").groupBy("key").agg(*(F.sum(F.when(F.col("own") == r, F.col("n")).otherwise(0)).alias(f"dear{r}") for r in (0, 1)))
    few = classes.join(dear, "key", "left").where("coalesce(dear0, 0) > own OR coalesce(dear1, 0) > below")
    return cut_lineage(few.select(F.col("rep").alias("doc_id"), "key"), "crowded")


def similar_components(docs: DataFrame, words: int = 5, percent: int = 75, cap: int = CAP) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    with small_batches(docs.sparkSession):
        return _similar_components(docs, words, percent, cap)


@contextmanager
def small_batches(spark: SparkSession, size: str = "16m") -> Iterator[None]:
    """Whole sets travel in Arrow batches of at most ``size`` while the jobs of the block run."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _similar_components(docs: DataFrame, words: int, percent: int, cap: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _bucket_table(docs, words, percent, cap)
    own = found.where("kind = 0").select("doc_id", "key", "n", "least", "own", "below", "sketch", "coarse")
    classes = own.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "least", "own", "below", "sketch", "coarse")))
    classes = cut_lineage(classes, "classes")
    verifier = _Verifier(docs, classes, words, percent)
    links = _linked_in_buckets(verifier, found.where("kind IN (1, 2)").select("kind", "n", "keys"), "kind = 1")
    crowded = _crowded(classes, found)
    for singly in (False, True):
        count = crowded.count()
        if count < 2:
            break
        texts = docs.join(F.broadcast(crowded) if count <= BROADCAST_IDS else crowded, "doc_id", "left_semi")
        again = _bucket_table(texts, words, percent, cap if singly else CAP_DELETIONS, deletions=not singly, singly=singly)
        spare = again.where("kind = 0").groupBy("key").agg(F.min("own").alias("own"), F.min("below").alias("below"), F.min("doc_id").alias("rep"))
        links = links.unionAll(_linked_in_buckets(verifier, again.where("kind IN (1, 2)").select("kind", "n", "keys"), "kind = 1", _crowded(spare, again)))
        if not singly:
            crowded = cut_lineage(spare.where("own < 0 OR below < 0").select(F.col("rep").alias("doc_id"), "key"), "short")
    component = connected_components(links.select("u", "v"))
    named = classes.select("key", "rep").join(component.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component"))
    return own.select("doc_id", "key", "n").join(named, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, null ids last, and of its rows any one.

    Rows meet by a row id, so null and repeated ids are near copies like others. Texts without elements all stay.
    """
    rows = cut_lineage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = similar_components(rows.select(F.col("__row").alias("doc_id"), "text"), words, percent)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"), "__row")
    found = found.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    kept = found.groupBy("component_id").agg(F.min(order).alias("least")).select("least.__row")
    return rows.join(kept, "__row", "left_semi").drop("__row")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: All pairs that share a shingle, and everything reachable by links.
OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 75 * (x.n + y.n - common)),
link AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
reach(u, v) AS (SELECT u, v FROM link UNION SELECT r.u, k.v FROM reach r JOIN link k ON r.v = k.u),
least AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(v, d.doc_id)) AS BIGINT) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON u = d.doc_id
"""
