"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the documents of one range of ids: ``HWPF``, the blocks, then a footer with the documents'
ids and lengths and the place of every block, and last the footer's place. A block has up to ``BLOCK``
ids: their minimum, the bit width, the number of ids, the number of exceptions, the differences to the
minimum packed at that width, and the places and full differences of the exceptions, which do not fit
the width. The width is the cheapest of those that fit the smallest value, half, three quarters, 90, 95,
98 or all of the block's differences. All numbers are little-endian.

Documents are dealt to files by ranges of ``doc_id`` and sorted there, so all files in order have all ids
in ascending document order. Ties (repeated ids) are ordered by text; null ids come first and are written as -1. A null or
empty text is the end id alone. Strings of added tokens in a text become these tokens, as the tokenizer file has it, if
``added`` is set (the query does), and ordinary text otherwise.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.files import attempt_name, new_folder, open_folder
from headwater.llm.tables import table
from headwater.session import cut_lineage

END_ID = 2
BLOCK = 512
MAGIC = b"HWPF"
PERCENTILES = (0, 50, 75, 90, 95, 98, 100)
_HEAD = np.dtype([("least", "<u4"), ("count", "<u2"), ("exceptions", "<u2"), ("width", "u1")])
#: Pieces that one worker remembers.
REMEMBERED = 3_000_000


class Encoder:
    """Encodes texts with a byte-level tokenizer file, each distinct piece once.

    The tokenizer's pattern never crosses the pieces that ``_piece_starts`` cuts, so encoding pieces and
    joining is encoding the text. Pieces are remembered by a 64-bit hash in sorted arrays. Texts that hold
    ``added`` tokens are encoded whole and not remembered.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        # Spark's tasks fill the cores; a pool of threads in each only takes time from the others
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.clear()

    def clear(self) -> None:
        self.hash = np.zeros(1, np.uint64)  # of remembered pieces, sorted; a zero stands first
        self.place = self.size = np.zeros(1, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _remember(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids, size = self._encode(pieces)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)))
        self.ids[self.used : self.used + len(ids)] = ids
        place = self.used + np.cumsum(size) - size
        self.used += len(ids)
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.place, self.size = np.insert(self.hash, at, hashes), np.insert(self.place, at, place), np.insert(self.size, at, size)

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """The texts that hold an added token."""
        found = set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[text + 1]:
                    found.add(text)
                    at = int(offsets[text + 1]) - 1  # on with the next text
                at = raw.find(token, at + 1)
        return np.array(sorted(found), np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, each text with the end id, and the number of ids of each text."""
        raw = data.tobytes() if self.added else b""
        whole = self._with_added(raw, offsets)
        if not len(whole):
            return self._encode_pieces(data, offsets)
        size = np.diff(offsets)
        rest = size.copy()
        rest[whole] = 0
        ids, lengths = self._encode_pieces(data[np.repeat(rest > 0, size)], np.concatenate(([0], np.cumsum(rest))))
        found, count = self._encode([raw[offsets[i] : offsets[i + 1]].decode() for i in whole])
        ids = np.insert(ids, np.repeat(np.cumsum(lengths)[whole] - 1, count), found)
        lengths[whole] += count
        return ids, lengths

    def _encode_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.full(len(offsets) - 1, END_ID, np.uint32), np.ones(len(offsets) - 1, np.int64)
        starts = _piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = W.run_hashes(W.BYTE_VALUES[data], starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, distinct)
        new = self.hash[np.minimum(at, len(self.hash) - 1)] != distinct
        if new.any():
            raw = data.tobytes()
            text = lambda k: raw[starts[k] : ends[k]].decode()
            if len(self.hash) + new.sum() > REMEMBERED:
                self.clear()
                new[:] = True
            self._remember(distinct[new], [text(k) for k in first[new]])
            at = np.searchsorted(self.hash, distinct)
        place, size = self.place[at][which], self.size[at][which]
        per_text = np.bincount(np.searchsorted(offsets, starts, "right") - 1, weights=size, minlength=len(offsets) - 1).astype(np.int64)
        total = np.cumsum(size)
        ids = self.ids[np.repeat(place - (total - size), size) + np.arange(total[-1])]
        return np.insert(ids, np.cumsum(per_text), END_ID), per_text + 1


# Byte classes of the pieces: 0 a blank or line feed, 1 a letter, 2 a digit, 3 another ASCII byte, 4 any other byte.
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, 0x0A]] = 0
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_KIND[0x30:0x3A] = 2
_KIND[0x80:] = _KIND[0x27] = 4
# White space besides the blank and the line feed, as UTF-8.
_OTHER_SPACE = re.compile(rb"[\t\x0b\x0c\r]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_SPACE_LEADS = np.zeros(256, bool)
_SPACE_LEADS[[0x09, 0x0B, 0x0C, 0x0D, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def _piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin. The pattern takes a run of letters, digits or other signs with one blank before it, and of
    a run of white space all but the last character. Words with apostrophes or bytes beyond ASCII, but for Latin-1
    letters, are one piece; so is a text with other white space than blanks and line feeds."""
    kind = _KIND[data]
    # letters of two bytes from C3 80 to C3 BF, without the signs C3 97 and C3 B7
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[lead] = kind[lead + 1] = 1
    blank = kind == 0
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, blank[:-1]
    text_start = np.zeros(len(data) + 1, bool)
    text_start[offsets] = True
    text_start = text_start[:-1]
    word_start = text_start | (blank & ~before)
    begins = np.flatnonzero(word_start)
    odd = np.maximum.reduceat(kind, begins) == 4
    last_blank = np.zeros(len(data), bool)
    last_blank[:-1] = blank[:-1] & ~blank[1:] & ~text_start[1:]
    cut = word_start | last_blank
    cut[1:] |= ~blank[1:] & (data[:-1] == 0x0A)
    change = np.flatnonzero((kind[1:] != kind[:-1]) & ~blank[1:] & ~blank[:-1]) + 1
    if odd.any():
        change = change[~odd[np.searchsorted(begins, change, "right") - 1]]
    cut[change] = True
    if _SPACE_LEADS[data].any():
        raw = data.tobytes()
        for a, b in pairwise(offsets):
            if _OTHER_SPACE.search(raw, a, b):
                cut[a + 1 : b] = False
    return np.flatnonzero(cut)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """The worker's encoder; kept between tasks."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, 512) differences below 2**width as (n, 8 * width) words of 64 bits."""
    groups = values.reshape(-1, 64).astype(np.uint64)
    out = np.zeros((len(groups), width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    groups = words.reshape(-1, width)
    out = np.empty((len(groups), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, j] = groups[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, j] |= groups[:, word + 1] << np.uint64(64 - shift)
    return (out & mask).reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids; the last may be short."""
    count = -(-len(ids) // BLOCK)
    padded = np.empty(count * BLOCK, np.int64)
    padded[: len(ids)] = ids
    if count:
        padded[len(ids) :] = ids[(count - 1) * BLOCK :].min()
    rows = padded.reshape(count, BLOCK)
    least = rows.min(axis=1)
    delta = rows - least[:, None]
    bits = np.frexp(delta.astype(np.float64))[1].astype(np.uint8)  # bit length
    fits = np.cumsum(np.bincount((np.arange(count) * 33)[:, None].repeat(BLOCK, 1).ravel() + bits.ravel(), minlength=count * 33).reshape(count, 33), axis=1)
    choices = np.stack([(fits <= (BLOCK - 1) * p // 100).sum(axis=1) for p in PERCENTILES], axis=1)
    cost = choices * BLOCK + (BLOCK - np.take_along_axis(fits, choices, axis=1)) * 48
    width = np.take_along_axis(choices, cost.argmin(axis=1)[:, None], axis=1)[:, 0]
    out: list[bytes] = [b""] * count
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        values, exceptional = delta[own], bits[own] > w
        packed = _pack(np.where(exceptional, 0, values), int(w)) if w else np.zeros((len(own), 0), np.uint64)
        for k, i in enumerate(own):
            at = np.flatnonzero(exceptional[k])
            n = min(BLOCK, len(ids) - i * BLOCK)
            head = np.array([(least[i], n, len(at), w)], _HEAD).tobytes()
            out[i] = b"".join((head, packed[k].tobytes(), at.astype("<u2").tobytes(), values[k][at].astype("<u4").tobytes()))
    return out


def decode_blocks(data: bytes, places: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks that begin at ``places`` in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    heads = raw[places[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD)[:, 0] if len(places) else np.zeros(0, _HEAD)
    out = np.zeros((len(places), BLOCK), np.uint32)
    for w in np.unique(heads["width"]):
        own = np.flatnonzero(heads["width"] == w)
        size = int(w) * BLOCK // 8
        if w:
            words = raw[(places[own] + _HEAD.itemsize)[:, None] + np.arange(size)].copy().view("<u8")
            out[own] = _unpack(words, int(w))
        for i in own[heads["exceptions"][own] > 0]:
            n, at = int(heads["exceptions"][i]), int(places[i]) + _HEAD.itemsize + size
            out[i, np.frombuffer(data, "<u2", n, at)] = np.frombuffer(data, "<u4", n, at + 2 * n)
    out += heads["least"][:, None]
    return out[np.arange(BLOCK) < heads["count"][:, None]]


class Writer:
    """Writes one file; blocks go out as soon as they are full."""

    def __init__(self, stream) -> None:
        self.stream, self.at, self.rest = stream, len(MAGIC), np.zeros(0, np.uint32)
        self.documents: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.places: list[int] = []
        stream.write(MAGIC)

    def add(self, documents: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.documents.append(documents)
        self.lengths.append(lengths)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK * BLOCK
        self._put(ids[:whole])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        blocks = encode_blocks(ids)
        for block in blocks:
            self.places.append(self.at)
            self.at += len(block)
        self.stream.write(b"".join(blocks))

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and bytes of the file."""
        self._put(self.rest)
        documents = np.concatenate([np.zeros(0, np.int64), *self.documents]).astype("<i8")
        lengths = np.concatenate([np.zeros(0, np.int64), *self.lengths]).astype("<i8")
        footer = b"".join((struct.pack("<QQ", len(documents), len(self.places)), documents.tobytes(), lengths.tobytes(), np.array(self.places, "<i8").tobytes()))
        self.stream.write(footer + struct.pack("<Q", self.at))
        return len(documents), int(lengths.sum()), self.at + len(footer) + 8


@dataclass
class TokenFile:
    """Random access to a file: whole footer, blocks on demand."""

    source: pa.NativeFile

    def __post_init__(self) -> None:
        size = self.source.size()
        if self.source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        (self.end,) = struct.unpack("<Q", self.source.read_at(8, size - 8))
        footer = self.source.read_at(size - 8 - self.end, self.end)
        documents, blocks = struct.unpack_from("<QQ", footer)
        self.documents = np.frombuffer(footer, "<i8", documents, 16)
        self.lengths = np.frombuffer(footer, "<i8", documents, 16 + 8 * documents)
        self.places = np.frombuffer(footer, "<i8", blocks, 16 + 16 * documents)

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids from ``first`` to before ``end``, of the blocks that hold them."""
        a, b = first // BLOCK, -(-end // BLOCK)
        if a >= b:
            return np.zeros(0, np.uint32)
        low, high = int(self.places[a]), int(self.places[b]) if b < len(self.places) else self.end
        data = self.source.read_at(high - low, low)
        return decode_blocks(data, self.places[a:b] - low)[first - a * BLOCK : end - a * BLOCK]


def write_tokens(docs: DataFrame, tokenizer: str, added: bool = False) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as token files; returns one row a file: shard, path, documents, ids, bytes."""
    folder = new_folder(docs.sparkSession, "tokens")
    shards = max(1, docs.rdd.getNumPartitions())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/{attempt_name(f'part-{shard:06d}', 'pfor')}"
        code, writer = encoder(tokenizer, added), None
        with system.open_output_stream(path) as stream:
            writer = Writer(stream)
            for batch in batches:
                ids = batch.column("doc_id").fill_null(-1).to_numpy()
                for first, end, data, offsets in W.text_chunks(batch.column("text")):
                    tokens, lengths = code.encode(data, offsets)
                    writer.add(ids[first:end], lengths, tokens)
            documents, total, size = writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int32()), (path, pa.string()), (documents, pa.int64()), (total, pa.int64()), (size, pa.int64()))], ["shard", "path", "documents", "ids", "bytes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shards, "doc_id") if shards > 1 else rows.repartition(1)
    written = dealt.sortWithinPartitions("doc_id", "text").mapInArrow(run, "shard int, path string, documents long, ids long, bytes long")
    return cut_lineage(written, "manifest").withColumn("folder", F.lit(folder))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``write_tokens``, read back in bounded pieces."""
    # the running sum is over one row a file
    base = files.withColumn("base", F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    shards = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = open_folder(row["folder"])
                with system.open_input_file(row["path"]) as source:
                    yield from _digests(TokenFile(source), row["base"] or 0)

    one_each = base.select("folder", "path", "base").repartition(shards, "path")
    return one_each.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(file: TokenFile, base: int, piece: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(file.lengths)
    starts = ends - file.lengths
    crc = np.zeros(len(ends), np.int64)
    total, at = int(ends[-1]) if len(ends) else 0, 0
    doc = 0
    while at < total:
        upto = min(total, at + piece)
        ids = memoryview(file.ids(at, upto).astype("<u4").tobytes())
        while doc < len(ends) and starts[doc] < upto:
            a, b = max(at, int(starts[doc])), min(upto, int(ends[doc]))
            crc[doc] = zlib.crc32(ids[4 * (a - at) : 4 * (b - at)], int(crc[doc]))
            if ends[doc] > upto:
                break
            doc += 1
        at = upto
    yield pa.RecordBatch.from_arrays([pa.array(file.documents), pa.array(base + starts), pa.array(file.lengths), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return read_tokens(files)
