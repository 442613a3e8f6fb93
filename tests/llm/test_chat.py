"""Preference formatting: prompts, completions and masks."""

from bundleflow.llm import chat

TURNS = "array<struct<role:string,text:string>>"


def pairs(llm, rows):
    df = llm.createDataFrame(rows, f"k long, chosen {TURNS}, rejected {TURNS}, prompt string")
    return {r.k: r for r in chat.preference_pairs(df, "k").collect()}


def test_prefix_and_masks(llm):
    a, b, c, d = ("user", "hi"), ("assistant", "yes"), ("assistant", "no"), ("user", None)
    got = pairs(llm, [
        (1, [a, b], [a, c], "x"), (2, [a, b, d], [a, b], None), (3, [a, b], [a, b], None), (4, [b], [c], None),
        (5, None, [], None), (6, [a, (None, "z"), b], [a, ("user", "z"), c], None), (7, [("user", "<|end|>")], [a], None)])
    assert got[1].n_common == 1 and got[1].prompt == "<|user|>\nhi<|end|>\n"
    assert got[1].chosen == "<|assistant|>\nyes<|end|>\n" and got[1].rejected == "<|assistant|>\nno<|end|>\n"
    s, e = map(int, got[1].chosen_mask.split(":"))
    assert got[1].chosen[s:e] == "yes<|end|>"
    assert got[2].n_common == 2 and got[2].chosen == "<|user|>\n<|end|>\n" and got[2].rejected == "" == got[2].chosen_mask
    assert got[3].n_common == 2 and not got[3].usable
    assert got[4].prompt == "" and got[4].n_common == 0 and got[4].usable
    assert got[5].prompt == got[5].chosen == got[5].rejected == ""
    assert got[7].chosen.count("<|end|>") == 1


def test_masks_of_several_turns(llm):
    turns = [("user", "q"), ("assistant", "one"), ("user", "again"), ("assistant", "two 🙂")]
    row = pairs(llm, [(1, turns, [], None)])[1]
    spans = [tuple(map(int, m.split(":"))) for m in row.chosen_mask.split(",")]
    assert [row.chosen[s:e] for s, e in spans] == ["one<|end|>", "two 🙂<|end|>"]


def test_reply_pairs(llm):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"),
            (2, 0, "user", "x"), (3, 1, "assistant", "second"), (3, 0, "user", "first"), (3, 0, "user", "first"),
            (None, 0, None, None), (None, 1, "assistant", None)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F_lit())
    got = {r.conv_id: r for r in chat.preference_pairs(chat.reply_pairs(df), "conv_id").collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1].n_common == 3 and "d" in got[1].chosen and "b" in got[1].rejected and got[1].chosen.endswith("e<|end|>\n")
    assert got[2].n_common == 1 and not got[2].usable and got[2].prompt == "<|user|>\nx<|end|>\n"
    assert got[3].n_common == 2 and got[3].rejected == "<|assistant|>\n<|end|>\n"
    assert not got[None].usable and got[None].n_common == 2
    assert chat.reply_pairs(df.limit(0)).count() == 0


def test_every_later_reply_is_in_the_completions(llm):
    """Equal replies lengthen the prefix; the first that differs ends it."""
    turns = ["q1", "same", "q2", "same", "q3", "new", "q4", "last"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(turns)]
    got = chat.preference_pairs(chat.reply_pairs(llm.createDataFrame(
        rows, "conv_id long, turn long, role string, text string")), "conv_id").first()
    assert got.n_common == 5 and got.usable
    for text, mask, want in ((got.chosen, got.chosen_mask, ["new", "last"]), (got.rejected, got.rejected_mask, ["same", "new"])):
        spans = [tuple(map(int, m.split(":"))) for m in mask.split(",")]
        assert [text[s:e] for s, e in spans] == [f"{w}<|end|>" for w in want]


def test_a_very_long_conversation(llm):
    rows = llm.range(6000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                      "concat('turn ', id) AS text")
    got = chat.preference_pairs(chat.reply_pairs(rows), "conv_id").first()
    assert got.n_common == 3 and got.chosen.count("<|end|>") == 5997 == got.rejected.count("<|end|>")
    assert got.chosen_mask.count(":") == 2999


def test_native(llm):
    df = llm.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.preference_pairs(chat.reply_pairs(df), "conv_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def F_lit():
    from pyspark.sql import functions as F
    return F.lit("clash")
