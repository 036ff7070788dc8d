import hashlib

from headwater.llm import chat

PARTS = "conv_id long, turn long, role string, parts array<struct<type:string,text:string,ref:string,tokens:int>>, formatted string"
TRAPS = ["<", "\\", "\\l", "\\\\l", "</turn>\n", "<turn assistant>", "a\\<b>\\\\", "\n", "", "\\### Assistant: </turn> ok", "日本 <|end|> \\g\\", "\\\\", "\\\\\\<"]


def text(s):
    return ("text", s, None, None)


def test_traps_read_back_unchanged(spark):
    rows = [(1, k, ["user", "assistant", "a>b\\"][k % 3], [text(s)], "x") for k, s in enumerate(TRAPS)]
    out = chat.format_conversations(spark.createDataFrame(rows, PARTS))
    r = out.withColumn("turns", chat.read_turns(out.formatted)).first()
    assert [(t.role, t.text) for t in r.turns] == [(role, p[0][1]) for _, _, role, p, _ in rows]
    assert r.n_turns == len(TRAPS) == r.formatted.count("</turn>\n")
    spans = [r.formatted[s.start : s.start + s.length] for s in r.loss]
    plain = [s.replace("\\\\", "\0").replace("\\l", "<").replace("\\g", ">").replace("\0", "\\") for s in spans]
    assert plain == TRAPS[1::3]
    assert r.loss_turns == [k % 3 == 1 for k in range(len(TRAPS))]


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 1, "assistant", [("audio", None, "s3.wav", 40), text("end")], ""),
        (1, 0, "user", [text("see <"), ("image", None, "a.png", None), None, ("image", "ignored", "b.png", 9), text(None), ("<odd>", None, None, None), (None, "plain", None, None)], ""),
    ]
    r = chat.format_conversations(spark.createDataFrame(rows, PARTS)).first()
    assert r.formatted == "<turn user>see \\l<image 0><image 1><\\lodd\\g 2>plain</turn>\n<turn assistant><audio 3>end</turn>\n"
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 256), ("image", "b.png", 9), ("<odd>", None, 0), ("audio", "s3.wav", 40)]
    assert r.expanded_tokens == 305
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss] == ["<audio 3>end"]


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(None, None, None, None, ""), (2, 0, "user", [text("b")], ""), (2, 0, "user", [text("a")], ""), (2, 0, "user", [text("a")], ""), (2, None, "assistant", [text(None)], "")]
    frame = spark.createDataFrame(rows, PARTS)
    out = {r.conv_id: r for r in chat.format_conversations(frame.repartition(3)).collect()}
    assert out[None].formatted == "<turn ></turn>\n" and out[None].n_turns == 1
    assert out[2].formatted == "<turn assistant></turn>\n<turn user>a</turn>\n<turn user>a</turn>\n<turn user>b</turn>\n"
    assert [(s.start, s.length) for s in out[2].loss] == [(16, 0)]
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = chat.op10_chat_format(spark, sf_dir)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    trap = plan.where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert trap.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (trap.n_turns, trap.loss_chars, trap.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
