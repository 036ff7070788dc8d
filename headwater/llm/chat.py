"""Chat formatting with typed content parts, in built-in column expressions only.

A message is (conv_id, turn, role, parts); ``parts`` is an array of (type, text, ref, tokens). A visitor
flattens the parts of a turn in order: text is escaped, every other part becomes the placeholder
``<type k>``, where k counts the conversation's attachments from 0. Attachment references and the number
of tokens that an attachment expands to are recorded in that order; ``tokens`` null takes the type's
default in ``PART_TOKENS``.

Template: each turn is ``<turn role>body</turn>`` and a line feed. In texts and roles a backslash is
written ``\\\\``, ``<`` is ``\\l`` and ``>`` is ``\\g``, so ``<`` and ``>`` only ever belong to the template
and any text, template marks included, reads back unchanged. The loss mask covers the bodies of
assistant turns, as spans of code points (``loss``) and as one flag a turn (``loss_turns``).

Turns are ordered by turn, then role, then text; nulls first, repeated rows stay. A null role or text is
empty; null parts are an empty list, a null part an empty text. Unknown part types are placeholders like
the rest, with no tokens unless given; a null type is text. Null conversation ids form one conversation.
Extra columns are not read.

A conversation's formatted text is one value, so its turns meet in one row at the end; the limit is
Spark's, two gigabytes a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headwater.llm.tables import table
from headwater.session import cut_lineage

PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
#: Tokens that an attachment takes unless it says so itself.
PART_TOKENS = {"image": 256, "audio": 128, "document": 512}
TURN_END = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """Undoes ``escape``: between pairs of backslashes, which stand for one, each other sequence is read alone."""
    pieces = F.split(text, r"\\\\", -1)
    plain = F.transform(pieces, lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(plain, "\\")


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _tokens(part: Column) -> Column:
    default = F.lit(0)
    for kind, tokens in PART_TOKENS.items():
        default = F.when(part["type"] == kind, tokens).otherwise(default)
    return F.coalesce(part["tokens"], default)


def format_conversations(messages: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, n_turns, formatted, loss, loss_turns, attachments, expanded_tokens."""
    parts = F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS))
    turns = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    attached = F.filter("parts", lambda p: p.isNotNull() & ~_is_text(p))
    turns = turns.withColumn("files", F.transform(attached, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).cast("long").alias("tokens"))))
    own_text = F.array_join(F.transform("parts", lambda p: F.coalesce(F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))), F.lit(""))), "")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "__text", "__files")
    turns = turns.withColumn("__text", own_text).withColumn("__files", F.to_json("files"))
    turns = turns.withColumn("__place", F.row_number().over(order))
    before = Window.partitionBy("conv_id").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("__first_file", F.coalesce(F.sum(F.size("files")).over(before), F.lit(0)))
    # the k-th part's placeholder: attachments of earlier turns, and of this turn's earlier parts
    number = lambda i: F.col("__first_file") + F.size(F.filter(F.slice("parts", 1, i), lambda p: p.isNotNull() & ~_is_text(p)))
    visit = lambda p, i: F.when(p.isNull(), "").when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<"), escape(p["type"]), F.lit(" "), number(i).cast("string"), F.lit(">")))
    body = F.when(F.size("files") == 0, F.col("__text")).otherwise(F.array_join(F.transform("parts", visit), ""))
    turns = turns.withColumn("__head", F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">"))).withColumn("__body", body)
    turns = turns.withColumn("__piece", F.concat("__head", "__body", F.lit(TURN_END)))
    start = F.coalesce(F.sum(F.length("__piece")).over(before), F.lit(0)) + F.length("__head")
    turns = turns.withColumn("__start", start).withColumn("__loss", F.col("role") == "assistant")
    piece = F.struct("__place", "__piece", "__loss", "__start", F.length("__body").alias("__length"), "files")
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["__loss"]), lambda x: F.struct(x["__start"].alias("start"), x["__length"].alias("length")))
    files = F.flatten(F.transform("t", lambda x: x["files"]))
    return gathered.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["__piece"]), "").alias("formatted"),
        spans.alias("loss"),
        F.transform("t", lambda x: x["__loss"]).alias("loss_turns"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, f: n + f["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; placeholders stay as they are written."""
    pieces = F.filter(F.split(formatted, TURN_END, -1), lambda x: x != "")
    head = lambda x: F.substring_index(x, ">", 1)
    return F.transform(pieces, lambda x: F.struct(unescape(F.substring(head(x), 7, 1 << 30)).alias("role"), unescape(F.substr(x, F.length(head(x)) + F.lit(2))).alias("text")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    trap = F.lit("\\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), trap.alias("text"))
    part = F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"))
    messages = rows.unionAll(added).select("conv_id", "turn", "role", F.array(part).alias("parts"))
    output = cut_lineage(format_conversations(messages), "chats")
    read = output.select("conv_id", "formatted", "loss_turns", read_turns(F.col("formatted")).alias("turns"))
    all_turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter(F.arrays_zip("turns", "loss_turns"), lambda x: x["loss_turns"]), lambda x: x["turns"]["text"]), "")
    read = read.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), all_turns.alias("all_turns"), loss.alias("loss"))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("all_turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(role || text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
