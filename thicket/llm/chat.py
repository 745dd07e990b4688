"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, adjacent turns of one role
merged by array aggregation into blocks, and the blocks concatenated:

    <s>[INST]role[/INST]text[SEP]text of the next turn of the same role</s>

The five control strings are escaped inside roles and texts ("&" as "&amp;", the "<" of
a control string as "&lt;", its "[" as "&lsqb;"), so that the turns can be read back from
the formatted string alone. loss_spans has the place of each assistant text.

Defined cases: null roles and texts count as empty; null turns come first; ties of turn
are ordered by role, then text; repeated rows are turns of their own; rows with a null
conversation key form one conversation; an empty table gives no rows; other columns, whatever
their names, are left alone; texts of any length are written whole, and the work grows with
the number of turns. A conversation is one output row, so it must fit a row; conversations
are never merged or split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of a conversation whose places are summed one by one.
CHUNK = 500
OPEN, HEAD, TAIL, SEP, CLOSE = "<s>", "[INST]", "[/INST]", "[SEP]", "</s>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    text = F.regexp_replace(text, r"<(/?s>)", "&lt;$1")
    return F.regexp_replace(text, r"\[(/?INST\]|SEP\])", "&lsqb;$1")


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("&lsqb;"), F.lit("["))
    text = F.replace(text, F.lit("&lt;"), F.lit("<"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn_from: str = "assistant") -> DataFrame:
    """One row for each conversation: its key, formatted, loss_spans (start from 0, length, in code points)."""
    empty = F.lit("")
    each = turns.select(
        F.col(conv).alias("_conv"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")).alias("_turn"),
    )
    sorted_turns = each.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    # a block begins where the role changes, and holds the turns up to where the next one begins
    role_at = lambda i: F.get("_turns", i)["role"]
    begins = F.filter(F.sequence(F.lit(0), F.size("_turns") - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    begun = sorted_turns.select("_conv", "_turns", begins.alias("_begins"))

    def block(begin: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_begins", k + 1), F.size("_turns"))
        return F.struct(role_at(begin).alias("role"), F.transform(F.sequence(begin, end - 1), lambda i: escape(F.get("_turns", i)["text"])).alias("texts"))

    merged = begun.select("_conv", F.transform("_begins", block).alias("_blocks"))
    written = F.transform("_blocks", lambda b: F.concat(F.lit(OPEN + HEAD), escape(b["role"]), F.lit(TAIL), F.array_join(b["texts"], SEP), F.lit(CLOSE)))
    # lengths of all parts in order: before the first text of a block, then each text with what follows it
    parts = F.flatten(
        F.transform(
            "_blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(escape(b["role"])) + len(OPEN + HEAD + TAIL)).otherwise(len(SEP)).alias("skip"),
                    F.length(t).alias("length"),
                    F.when(i == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(0).alias("end"),
                    (b["role"] == learn_from).alias("learn"),
                ),
            ),
        )
    )

    def place(s: Column, p: Column) -> Column:
        start = s["at"] + p["skip"]
        span = F.struct(start.alias("start"), p["length"].alias("length"))
        return F.struct((start + p["length"] + p["end"]).alias("at"), F.when(p["learn"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    # an aggregation copies what it has gathered at each step, so that parts are placed in chunks, which begin at the sums of those before
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("_parts") - 1) / CHUNK).cast("int")), lambda k: F.slice("_parts", k * CHUNK + 1, CHUNK))
    chunked = merged.select("_conv", F.array_join(written, "").alias("formatted"), parts.alias("_parts")).select("_conv", "formatted", cut.alias("_chunks"))
    long = F.transform("_chunks", lambda c: F.aggregate(c, F.lit(0), lambda n, p: n + p["skip"] + p["length"] + p["end"]))
    starts = F.aggregate(long, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    none = F.array().cast("array<struct<start:int,length:int>>")
    placed = F.transform("_chunks", lambda c, k: F.aggregate(c, F.struct(F.get("_starts", k).alias("at"), none.alias("spans")), place)["spans"])
    return chunked.withColumn("_starts", starts).select(F.col("_conv").alias(conv), "formatted", F.flatten(placed).alias("loss_spans"))


def read_turns(formatted: str | Column) -> Column:
    """The turns as array of (role, text) structs, from a formatted string alone."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    blocks = F.filter(F.split(formatted, f"{CLOSE}"), lambda b: b != "")

    def turns(b: Column) -> Column:
        body = F.substr(b, F.lit(len(OPEN + HEAD) + 1))
        cut = F.instr(body, TAIL)
        role = unescape(F.substring(body, F.lit(1), cut - 1))
        return F.transform(F.split(F.substr(body, cut + len(TAIL)), r"\[SEP\]"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
