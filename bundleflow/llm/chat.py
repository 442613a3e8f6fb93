"""Preference formatting of chosen and rejected conversations (operator 7).

The longest common prefix of turns (equal role and text) is rendered once as the prompt; what
follows in either conversation is rendered as its completion, with a mask that names the
character ranges a loss may count: the texts of assistant turns with their end mark.
Everything is a projection of one row, so pairs need no shuffle; only gathering turns into
conversations groups by the conversation's id, as a conversation is one record.

Defined results: null roles count as ``user``, null texts as empty; the end mark inside a text
is broken up, so a text cannot close its own turn; equal conversations have empty completions
and are not usable; empty conversations have an empty prompt; very long conversations are one record
each; turns are ordered by turn
number, then role, then text, and repeated turns stay; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The marks of the rendered format.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
BROKEN = "<\u200b|"
ASSISTANT = "assistant"
_TURNS = "array<struct<role:string,text:string>>"


def gather(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turns) with the ordered turns of every conversation; null ids form one."""
    one = F.struct(F.col(turn_col).alias("turn"),
                   F.coalesce(F.col(role_col), F.lit("user")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (conversations.groupBy(F.col(id_col)).agg(F.sort_array(F.collect_list(one)).alias("t"))
            .select(id_col, F.transform("t", lambda x: F.struct(x["role"].alias("role"),
                                                                x["text"].alias("text"))).alias("turns")))


def _rendered(turns: str) -> str:
    """SQL of the text of an array of turns."""
    return (f"array_join(transform({turns}, t -> concat('{OPEN}', t.role, '{CLOSE}\\n', "
            f"replace(t.text, '{OPEN}', '{BROKEN}'), '{END}\\n')), '')")


def _mask(turns: str) -> str:
    """SQL of ``start:end`` ranges (characters, end exclusive) of assistant texts."""
    head = f"(length(t.role) + {len(OPEN) + len(CLOSE) + 1})"
    body = f"(length(replace(t.text, '{OPEN}', '{BROKEN}')) + {len(END)})"
    return (f"array_join(aggregate({turns}, named_struct('at', 0, 'out', cast(array() as array<string>)), "
            f"(s, t) -> named_struct('at', s.at + {head} + {body} + 1, 'out', if(t.role = '{ASSISTANT}', "
            f"concat(s.out, array(concat(s.at + {head}, ':', s.at + {head} + {body}))), s.out)), s -> s.out), ',')")


def preference_pairs(pairs: DataFrame, id_col: str, chosen: str = "chosen",
                     rejected: str = "rejected") -> DataFrame:
    """(id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, usable) for every
    row of ``pairs``, whose two columns are arrays of (role, text)."""
    turns = F.expr(f"cast(array() as {_TURNS})")
    filled = lambda t: F.struct(F.coalesce(t["role"], F.lit("user")).alias("role"),
                                F.coalesce(t["text"], F.lit("")).alias("text"))
    rows = pairs.select(F.col(id_col), *[
        F.transform(F.coalesce(F.col(side).cast(_TURNS), turns), filled).alias(name)
        for side, name in ((chosen, "c"), (rejected, "r"))])
    common = ("aggregate(c, named_struct('i', 0, 'n', 0), (s, t) -> named_struct('i', s.i + 1, 'n', "
              "if(s.n = s.i and get(r, s.i) is not null and t <=> get(r, s.i), s.n + 1, s.n)), s -> s.n)")
    rows = rows.withColumn("n_common", F.expr(common))
    for side in ("c", "r"):
        rows = rows.withColumn(f"{side}_rest", F.expr(f"slice({side}, n_common + 1, size({side}))"))
    out = rows.select(
        id_col, "n_common", F.expr(_rendered("slice(c, 1, n_common)")).alias("prompt"),
        F.expr(_rendered("c_rest")).alias("chosen"), F.expr(_rendered("r_rest")).alias("rejected"),
        F.expr(_mask("c_rest")).alias("chosen_mask"), F.expr(_mask("r_rest")).alias("rejected_mask"))
    return out.withColumn("usable", F.col("chosen") != F.col("rejected"))


def reply_pairs(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, chosen, rejected) from single conversations, one row each.

    ``chosen`` is the whole conversation.  In ``rejected`` every assistant turn gives the assistant's
    reply before it, which answers another question; the first reply stays, unless it is the only
    one, which becomes empty.  So the common prefix ends at the first reply that differs from the one
    before, and every later turn is in both completions.  Conversations without an assistant turn,
    or with equal replies only, give a pair of equal sides, which is not usable."""
    role, text = F.coalesce("role", F.lit("user")), F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col(id_col), "turn", role.alias("role"), text.alias("text"))
    reply = F.when(F.col("role") == ASSISTANT, F.col("text"))
    whole = Window.partitionBy(id_col)
    so_far = whole.orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"before": F.last(reply, ignorenulls=True).over(so_far), "replies": F.count(reply).over(whole)})
    other = (F.when(F.col("role") != ASSISTANT, F.col("text")).when(F.col("before").isNotNull(), F.col("before"))
             .when(F.col("replies") == 1, "").otherwise(F.col("text")))
    turns = rows.withColumn("other", other).groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "other"))).alias("t"))
    return turns.select(
        id_col, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("chosen"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["other"].alias("text"))).alias("rejected"))
