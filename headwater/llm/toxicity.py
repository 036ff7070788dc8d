"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, undoes compatibility forms, lookalike letters of other alphabets and digits or
signs used as letters inside words, and turns all else between words into blanks. A lexicon entry is
a whole word (`` idiot ``) or the beginning of words (`` chlla``); matches inside an exception phrase
do not count. The weights of a text's matches are added, divided by the text's length and mapped to a
probability by a fitted logistic curve.

The lexicon is learned from a bounded sample of labelled rows by repeated choice: the entry found in
most toxic texts not yet explained by ``COVER`` entries, and in (nearly) no clean one, comes next. Of
near copies in the sample, told by their min-hashes, one counts, so words that merely stand in copies
of one toxic text are not taken up. Scoring itself reads every text.

Null and empty texts match nothing and get the lowest score. Labels that are null or not 0/1 are not
learned from; without labelled rows the lexicon is empty. Repeated rows are scored alike, extra columns
are kept, and input columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm.tables import append_columns, fit_in_one_task, fold, labelled_sample, table

# Letters of other alphabets that look like Latin ones, and signs read as letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ɑ": "a",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"

_SIGN_IN_WORD = re.compile(r"(?<=[a-z])[0134@$!5789]+(?=[a-z])|(?<![^\W\d_])[0134@$5789]+(?=[a-z][a-z0134@$5789])|(?<=[a-z]{2})[0134@5789]+(?![^\W_])")
_HAS_SIGN = re.compile(r"[a-z][0-9@$!]|[0-9@$][a-z]")
_SIGN_TABLE = str.maketrans(SIGNS)


class _Fold(dict):
    """Character table filled on first use: letters and digits stay, lookalikes change, all else is a blank."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "" if c in INVISIBLE else LOOKALIKES.get(c, c) if c.isalnum() else " "
        return out


_FOLD = _Fold()


def fold_text(text: str) -> str:
    """The folded text between two blanks."""
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text).lower()
    if not text.isascii():
        text = "".join([LOOKALIKES.get(c, c) for c in text]) if _FOREIGN.search(text) else text
    if _HAS_SIGN.search(text):
        text = _SIGN_IN_WORD.sub(lambda m: m[0].translate(_SIGN_TABLE), text)
    return f" {text.translate(_FOLD)} "


#: So many entries explain a toxic text.
COVER = 3

_FOREIGN = re.compile("[" + "".join(LOOKALIKES) + INVISIBLE + "]")


@dataclass
class Lexicon:
    """Entries with their weights, exception phrases, and the curve from rate to probability."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    intercept: float = -4.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(f" {phrase.strip()} ", (0.0, len(phrase.strip()) + 2))
        for entry, weight in self.weights.items():
            found.add_word(entry, (weight, len(entry)))
        found.make_automaton()
        return found


def rate(folded: str, automaton: ahocorasick.Automaton | None, exceptions: bool) -> float:
    """Log of one plus the weight of all matches for each ten thousand words (a hundred words are added to damp short texts)."""
    if automaton is None:
        return 0.0
    hits = [(end, weight, size) for end, (weight, size) in automaton.iter(folded)]
    if not hits:
        return 0.0
    if exceptions:
        excused = [(end - size + 1, end) for end, weight, size in hits if not weight]
        hits = [h for h in hits if h[1] and not any(a <= h[0] - h[2] + 1 and h[0] <= b for a, b in excused)]
    return math.log1p(1e4 * sum(h[1] for h in hits) / (100 + len(folded.split())))


def _entries(folded: str, prefixes: range) -> set[str]:
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for n in prefixes for w in words if len(w) > n}


def _one_of_near_copies(texts: Iterator[str], hashes: int = 6, same: int = 3) -> Iterator[str]:
    """The texts whose long words do not have ``same`` of their min-hashes in common with an earlier text."""
    seen: dict[tuple[int, int], list[int]] = {}
    for number, text in enumerate(texts):
        words = {w.encode() for w in text.split() if len(w) > 5} or {w.encode() for w in text.split()} or {b""}
        own = [(k, min(zlib.crc32(w, k) for w in words)) for k in range(hashes)]
        shared = Counter(i for h in own for i in seen.get(h, ()))
        if not shared or max(shared.values()) < same:
            for h in own:
                seen.setdefault(h, []).append(number)
            yield text


def learn(batches: Iterator[pa.RecordBatch], exceptions: tuple[str, ...] = (), least: float = 0.008, odds: float = 30.0, prefixes: range = range(4, 7)) -> Lexicon:
    """A lexicon from (text, label) rows. ``least``: share of the toxic texts, three at
    least, that an entry must newly explain; ``odds``: how much more common it must be in toxic texts."""
    rows = sorted({(t or "", y) for b in batches for t, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True)})
    toxic = [_entries(t, prefixes) for t in _one_of_near_copies(fold_text(t) for t, y in rows if y == 1)]
    clean = [fold_text(t) for t, y in rows if y == 0]
    least = max(3, round(least * len(toxic)))
    in_toxic = Counter(e for s in toxic for e in s)
    wanted = {e for e, n in in_toxic.items() if n >= least}
    in_clean: Counter[str] = Counter()
    for text in clean:
        in_clean.update(_entries(text, prefixes) & wanted)
    ratio = lambda e: (in_toxic[e] + 0.5) / (len(toxic) + 1) / ((in_clean[e] + 0.5) / (len(clean) + 1))
    wanted = {e for e in wanted if ratio(e) >= odds and in_clean[e] <= 0.02 * in_toxic[e]}
    open_sets = [[s & wanted, 0] for s in toxic]
    lexicon = Lexicon(exceptions=tuple(fold_text(x).strip() for x in exceptions))
    left = Counter(e for s, _ in open_sets for e in s)
    while left:
        # whole words before beginnings, long beginnings before short ones, if they explain about as much
        most = max(left.values())
        if most < least:
            break
        entry = min((e for e, n in left.items() if n >= 0.95 * most), key=lambda e: (not e.endswith(" "), -len(e), -left[e], e))
        lexicon.weights[entry] = math.log(ratio(entry))
        for own in open_sets:
            if entry in own[0]:
                same = {e for e in own[0] if e.startswith(entry) or entry.startswith(e) or e.strip() == entry.strip()}
                own[1] += 1
                gone = own[0] if own[1] == COVER else same
                left.subtract(gone)
                own[0] = own[0] - gone
        left = +left
    machine = lexicon.automaton()
    x = np.array([rate(fold_text(t), machine, bool(exceptions)) for t, _ in rows])
    y = np.array([y for _, y in rows], float)
    if len(x) and 0 < y.mean() < 1 and x.any():
        lexicon.slope, lexicon.intercept = _curve(x, y)
    return lexicon


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a small ridge."""
    design, w = np.column_stack((x, np.ones(len(x)))), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2) * 0.1, design.T @ (y - p) - 0.1 * ridge * w)
        w += np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, where: Column, label: str = "toxic", rows: int = 8000, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from about ``rows`` of the labelled rows that ``where`` selects (``rows`` is the bound of the sample)."""
    sample = labelled_sample(docs, labels, label, "doc_id", where, rows).select("text", "label")
    return fit_in_one_task(sample, lambda batches: learn(batches, exceptions))


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score (0 to 1) and a prediction (1 from ``threshold`` up), in columns of these names; such
    columns of ``docs`` are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def compute(column: pa.Array) -> list[pa.Array]:
        lexicon = shared.value
        machine = lexicon.automaton()
        x = np.fromiter((rate(fold_text(t.as_py() or ""), machine, bool(lexicon.exceptions)) for t in column), float, len(column))
        p = 1 / (1 + np.exp(-np.clip(lexicon.intercept + lexicon.slope * x, -35, 35)))
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return append_columns(docs, "text", f"`{names[0]}` double, `{names[1]}` int", compute)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return score(docs, lexicon).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
