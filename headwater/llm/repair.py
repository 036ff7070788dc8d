"""Repair of conversations: the cheapest edits that give an optional system turn and then user and assistant in turns.

A row is blank (no visible character), a duplicate (role and text seen earlier in its conversation) or truncated
(its last visible character does not end a sentence); its first fault counts. Edits and costs: Keep 0, Rerole to
user or assistant 1, Delete 2, which blank rows and duplicates need, Insert an empty user or assistant turn 5; a
truncated row that stays costs 5 more. The first characters of the roles left have to be ``(s?(ua)+)?``. Of the
cheapest edits those whose initials are least in ASCII order are made. An insertion stands right before the row that
needs it, after deletions, which is least. What a letter does follows from the letters before it, so the initials
alone tell the repaired conversation.

1. Equal rows of a turn become one with a count; the first turn of every repeated (role, text) tells duplicates.
2. Rows are dealt out by ranges of (conversation, turn, role, text), so a long conversation is split over tasks,
   and cut into blocks of ``BLOCK_ROWS``. A task runs the survivor-coalescence Viterbi (``survivors``) through each
   block from every state it can be entered in, and notes cost and initials for each pair of entry and exit.
3. The blocks of a conversation come together in order. The same Viterbi, with blocks for steps, picks one pair a block
   and emits every block once all survivors agree on it; only blocks that survivors disagree on are held.
   The digest of a conversation needs its text in order, so this pass is one stream a conversation, whose steps only
   hash.

Rows are ordered by turn, nulls first, then role, then text. A null role or text is one space, so such a role is
rerole'd or its row deleted, as is a row with an empty role. Null conversation ids are one conversation. Repeated rows
are duplicates. Conversations without rows do not come back here; the query adds them. Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm.survivors import Survivors
from headwater.llm.tables import table

#: Rows of a block; also texts of a block end it at so many characters.
BLOCK_ROWS = 256
BLOCK_CHARS = 1 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
STATES = (START, SYSTEM, USER, ASSISTANT)
#: What finishing the empty, and a begun, conversation takes.
ENDINGS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
#: One state's future costs at most this much more than another's: two insertions and a deletion.
APART = 2 * INSERT + DELETE
NO_FAULT, BLANK, DUPLICATE, CUT_OFF = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
_BLOCK = "conv_id long, part int, number long, roles array<string>, texts array<string>, faults array<int>, copies array<long>, turns array<long>, pairs array<struct<source:string,target:string,cost:long,edits:string>>"
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_turns long"
TURNS = "conv_id long, part int, number long, turns array<struct<role:string,text:string>>"


# --- faults -----------------------------------------------------------------------------------------------


def find_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, fault) of the different rows of a turn; ``copies`` further equal rows follow each.

    The text of blank rows and duplicates, which is never needed again, is dropped.
    """
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.col("copies").cast("long") if "copies" in rows.columns else F.lit(0).cast("long")).alias("copies"),
    )
    one = plain.groupBy("conv_id", "turn", "role", "text").agg((F.sum(F.col("copies") + 1) - 1).alias("copies"))
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
    one = one.withColumn("__key", key).withColumn("__place", place)
    again = one.groupBy("conv_id", "__key").agg(F.min("__place").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    again = again.select(F.col("conv_id").alias("__conv"), F.col("__key").alias("__same"), "__first")
    judged = one.join(again, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__key") == F.col("__same")), "left")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(F.col("__first") < F.col("__place"), DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF)
        .otherwise(NO_FAULT)
    )
    judged = judged.withColumn("fault", fault)
    return judged.select("conv_id", "turn", "role", "text", F.when(F.col("fault").isin(BLANK, DUPLICATE), "").otherwise(F.col("text")).alias("kept"), "copies", "fault")


# --- blocks -----------------------------------------------------------------------------------------------


def moves(initial: str, fault: int, copies: int) -> list[tuple[str, str, int, str]]:
    """What can be done with a row: (state before, state after, cost, edits)."""
    after = DELETE * copies
    tail = "D" * copies
    out = [(q, q, DELETE + after, "D" + tail) for q in STATES]
    if fault in (BLANK, DUPLICATE):
        return out
    after += TRUNCATED if fault == CUT_OFF else 0
    if initial == SYSTEM:
        out.append((START, SYSTEM, KEEP + after, "K" + tail))
    for target in (USER, ASSISTANT):
        # a state that the turn may follow, or one insertion before it
        fits = {q: (q == USER) == (target == ASSISTANT) for q in STATES}
        for letter, cost in (("K", KEEP), ("R", REROLE)):
            if letter == "K" and initial != target:
                continue
            out += [(q, target, cost + after + (0 if fits[q] else INSERT), ("" if fits[q] else "I") + letter + tail) for q in STATES]
    return out


def run_block(roles: list[str], faults: list[int], copies: list[int], sources: tuple[str, ...]) -> list[dict]:
    """The cheapest edits of a block for each state before and after it."""
    steps = [moves(r[:1], f, c) for r, f, c in zip(roles, faults, copies, strict=True)]
    out = []
    for source in sources:
        trellis, done = Survivors(source, APART), []
        for step in steps:
            done += [edits for edits, _ in trellis.step(step)]
        for target, (cost, path) in trellis.paths().items():
            out.append({"source": source, "target": target, "cost": cost, "edits": "".join(done + [edits for edits, _ in path])})
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted rows of one range. The first conversation of a range, and blocks after a conversation's
    first, are entered in any state."""
    part = TaskContext.get().partitionId()
    names = [f.split()[0] for f in "conv_id turn role kept fault copies".split()]
    held: dict[str, list] = {n: [] for n in names}
    number, chars, begun, out = 0, 0, False, []

    def close() -> dict:
        sources = STATES if number == 0 or begun else (START,)
        pairs = run_block(held["role"], held["fault"], held["copies"], sources)
        return {"conv_id": held["conv_id"][0], "part": part, "number": number, "roles": held["role"], "texts": held["kept"], "faults": held["fault"], "copies": held["copies"], "turns": held["turn"], "pairs": pairs}

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            same = bool(held["conv_id"]) and held["conv_id"][0] == row[0]
            full = len(held["turn"]) >= BLOCK_ROWS or chars >= BLOCK_CHARS
            if held["conv_id"] and (full or not same):
                out.append(close())
                held, chars, number, begun = {n: [] for n in names}, 0, number + 1, same
            for n, value in zip(names, row, strict=True):
                held[n].append(value)
            chars += len(row[3])
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, _BLOCK_TYPE)
            out = []
    if held["conv_id"]:
        out.append(close())
    if out:
        yield pa.RecordBatch.from_pylist(out, _BLOCK_TYPE)


_PAIR_TYPE = pa.struct([("source", pa.string()), ("target", pa.string()), ("cost", pa.int64()), ("edits", pa.string())])
_BLOCK_TYPE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("faults", pa.list_(pa.int32())), ("copies", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64())), ("pairs", pa.list_(_PAIR_TYPE)),
])
_REPORT_TYPE = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in "gaps blank duplicate truncated illegal cost".split()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_turns", pa.int64())])
_TURNS_TYPE = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


# --- conversations ----------------------------------------------------------------------------------------


def apply_edits(state: str, edits: str, roles: list[str], texts: list[str], copies: list[int]) -> tuple[str, list[tuple[str, str]]]:
    """The state after the edits of a block (or, without rows, of an ending) and the turns that they leave."""
    out, at = [], 0

    def inserted() -> None:
        nonlocal state, at
        while edits[at : at + 1] == "I":
            state = ASSISTANT if state == USER else USER
            out.append((ROLES[state], ""))
            at += 1

    for role, text, more in zip(roles, texts, copies, strict=True):
        inserted()
        letter = edits[at]
        if letter == "K":
            state = role[0]
            out.append((role, text))
        elif letter == "R":
            state = ASSISTANT if state == USER else USER
            out.append((ROLES[state], text))
        at += 1 + more
    inserted()
    return state, out


class _Conversation:
    """What has been seen of one conversation, block after block."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.trellis = Survivors(START, APART)
        self.state = START
        self.audit: list[str] = []
        self.digest, self.n_turns = hashlib.sha256(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None
        self.last: str | None = None

    def add(self, block: dict) -> list[dict]:
        faults, copies = np.array(block["faults"]), np.array(block["copies"])
        self.blank += int((copies[faults == BLANK] + 1).sum())
        self.duplicate += int((copies[faults == DUPLICATE] + 1).sum() + copies[(faults != BLANK) & (faults != DUPLICATE)].sum())
        self.truncated += int((faults == CUT_OFF).sum())
        for initial, more in zip((r[:1] for r in block["roles"]), block["copies"], strict=True):
            self.illegal += (self.last is not None and self.last + initial not in ("su", "ua", "au")) + more
            self.last = initial
        for turn in block["turns"]:
            if turn is not None and (self.high is None or turn > self.high):
                self.low, self.high, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        pairs = [(p["source"], p["target"], p["cost"], p["edits"]) for p in block["pairs"]]
        return [self.emit(edits, b) for edits, b in self.trellis.step(pairs, block)]

    def emit(self, edits: str, block: dict) -> dict:
        self.state, turns = apply_edits(self.state, edits, block["roles"], block["texts"], block["copies"])
        self.audit.append(edits)
        self._hash(turns)
        return {"conv_id": self.conv_id, "part": block["part"], "number": block["number"], "turns": [{"role": r, "text": t} for r, t in turns]}

    def _hash(self, turns: list[tuple[str, str]]) -> None:
        for role, text in turns:
            self.digest.update((("\n" if self.n_turns else "") + role + ":" + text).encode())
            self.n_turns += 1

    def finish(self) -> tuple[list[dict], dict]:
        cost, rest, ending = self.trellis.finish(ENDINGS)
        out = [self.emit(edits, block) for edits, block in rest]
        last = {"part": -1, "number": -1, "roles": [], "texts": [], "copies": []}
        if ending:
            out.append(self.emit(ending, last | {"part": (1 << 31) - 1}))
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.distinct
        report = {"conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}
        return out, report | {"cost": cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(), "n_turns": self.n_turns}


def _conversations(batches: Iterator[pa.RecordBatch], turns: bool) -> Iterator[pa.RecordBatch]:
    """Reports, or repaired turns, of blocks that come by conversation and in order."""
    own, out = None, []
    for batch in batches:
        for block in batch.to_pylist():
            if own is None or own.conv_id != block["conv_id"]:
                if own is not None:
                    rest, report = own.finish()
                    out += rest if turns else [report]
                own = _Conversation(block["conv_id"])
            done = own.add(block)
            if turns:
                out += done
        if out:
            yield pa.RecordBatch.from_pylist(out, _TURNS_TYPE if turns else _REPORT_TYPE)
            out = []
    if own is not None:
        rest, report = own.finish()
        yield pa.RecordBatch.from_pylist(rest if turns else [report], _TURNS_TYPE if turns else _REPORT_TYPE)


def _in_order(rows: DataFrame) -> DataFrame:
    """Blocks of all conversations, each conversation in one partition and in order."""
    ranged = find_faults(rows).repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    blocks = ranged.drop("text").mapInArrow(_blocks, _BLOCK)
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")


def report(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``rows`` (conv_id, turn, role, text): gaps, faults, cost, audit, digest and number of turns."""
    return _in_order(rows).mapInArrow(lambda b: _conversations(b, False), REPORT)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations; ``place`` orders a conversation's turns."""
    turns = _in_order(rows).mapInArrow(lambda b: _conversations(b, True), TURNS)
    return turns.select("conv_id", "part", "number", F.posexplode("turns").alias("at", "turn")).select("conv_id", F.struct("part", "number", "at").alias("place"), "turn.role", "turn.text")


# --- the query --------------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn: some dropped, emptied, cut off, repeated (``copies``) or given
    another role. Nulls are one space."""
    some: Column = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), some), F.lit(":"), F.coalesce(F.col("turn").cast("string"), some))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", some)
    return (
        rows.withColumn("__kind", kind).where("__kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("__kind") == 4, "user").otherwise(F.coalesce("role", some)).alias("role"),
            F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            (F.col("__kind") == 3).cast("long").alias("copies"),
        )
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(report(damage(rows)), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
