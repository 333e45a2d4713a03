"""Chat formatting by relational means: collect, sort, merge, concatenate.

The turns of a conversation are collected as structs and sorted; adjacent
turns of the same role form one block, whose parts are set apart by a
separator, so reading back gives the turns as they were:

    <|im_start|>ROLE\\nPART<|im_sep|>PART<|im_end|>\\n

Control strings inside texts are escaped by one backslash more after each
``<`` that backslashes and a ``|`` follow, and a role's backslashes and line
breaks are written as ``\\\\`` and ``\\n``; both are undone on reading.  The
loss mask is run-length coded: lengths and flags that cover the formatted
text in order.  Expressions of Spark only, each linear in the conversation.

Cases: very long texts are formatted whole, and a conversation is one row,
however long; null text is empty, a null role is empty; turns sort by number (null
first), then role, then text, so ties and repeated rows have a fixed order
and repeats stay; rows with a null conversation id form one conversation;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # a role has no line break once written, so breaks can stand for backslashes
    # until both are swapped at the end
    out = F.replace(unescape(role), F.lit("\\\\"), F.lit("\n"))
    return F.translate(F.replace(out, F.lit("\\n"), F.lit("\\")), "\\\n", "\n\\")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         target_role: str = TARGET_ROLE) -> DataFrame:
    """One row per conversation: id, ``formatted`` and ``loss_runs``, an
    array of (n_chars, loss) that covers ``formatted``."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sorted_turns = turns.groupBy(F.col(conv_col).alias("conv")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    all_turns = F.col("turns")

    def segments(t: Column, i: Column) -> Column:
        opens = F.coalesce(F.get(all_turns, i - 1)["role"] != t["role"], F.lit(True))
        closes = F.coalesce(F.get(all_turns, i + 1)["role"] != t["role"], F.lit(True))
        before = F.when(opens, F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))).otherwise(SEP)
        after = F.when(closes, F.lit(END + "\n")).otherwise("")
        return F.struct(before.alias("before"), escape(t["text"]).alias("text"), after.alias("after"),
                        (t["role"] == target_role).alias("loss"))

    pieces = sorted_turns.select("conv", F.transform("turns", segments).alias("p"))
    run = lambda n, loss: F.struct(F.length(n).alias("n_chars"), loss.alias("loss"))
    runs = F.flatten(F.transform("p", lambda s: F.array(
        run(s["before"], F.lit(False)), run(s["text"], s["loss"]), run(s["after"], F.lit(False)))))
    return pieces.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("p", lambda s: F.concat(s["before"], s["text"], s["after"])), "").alias("formatted"),
        F.filter(runs, lambda r: r["n_chars"] > 0).alias("loss_runs"))


def read_conversations(formatted: DataFrame, conv_col: str = "conv_id",
                       target_role: str = TARGET_ROLE) -> DataFrame:
    """The turns back from the formatted text: id, ``formatted``, ``turns``
    (role, text), and ``loss_text``, all text under the loss mask.  A mask
    that does not fit the text stops the query."""
    blocks = F.transform(
        F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda b: b != ""),
        lambda b: F.substr(b, F.lit(len(START) + 1)))
    step = formatted.select("*", blocks.alias("blocks"))

    def block_parts(b: Column) -> Column:
        cut = F.instr(b, "\n")
        parts = F.split(F.substr(b, cut + 1), r"<\|im_sep\|>", -1)
        return F.transform(parts, lambda p, i: F.struct(
            F.substr(b, F.lit(1), cut - 1).alias("role"), p.alias("raw"), i.alias("i"),
            F.lit(False).alias("_")))

    step = step.select("*", F.flatten(F.transform("blocks", block_parts)).alias("raw")).drop("blocks")
    # the mask that the parsed text calls for, run by run
    last = lambda i: F.coalesce(F.get(F.col("raw"), i + 1)["i"] == 0, F.lit(True))
    run = lambda n, loss: F.struct(n.alias("n_chars"), loss.alias("loss"))
    expected = F.flatten(F.transform("raw", lambda p, i: F.array(
        run(F.when(p["i"] == 0, F.length(p["role"]) + len(START) + 1).otherwise(len(SEP)), F.lit(False)),
        run(F.length(p["raw"]), p["role"] == target_role),
        run(F.when(last(i), len(END) + 1).otherwise(0), F.lit(False)))))
    fits = F.filter(expected, lambda r: r["n_chars"] > 0) == F.col("loss_runs")
    step = step.withColumn("raw", F.when(fits, F.col("raw")).otherwise(
        F.raise_error(F.lit("a loss mask does not fit its text")).cast("array<struct<role:string,raw:string,i:int,_:boolean>>")))
    return step.select(
        conv_col, "formatted",
        F.transform("raw", lambda p: F.struct(unescape_role(p["role"]).alias("role"),
                                              unescape(p["raw"]).alias("text"))).alias("turns"),
        F.array_join(F.transform(F.filter("raw", lambda p: p["role"] == target_role),
                                 lambda p: unescape(p["raw"])), "").alias("loss_text"))
