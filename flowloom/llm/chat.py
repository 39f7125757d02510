"""Chat formatting by prefix-target expansion, with SQL functions only.

A turn is ``<s>[INST]`` role ``[/INST]`` text ``</s>``. Inside roles and texts a backslash is doubled,
and each control string gets one after its first character, so that none is left and unescaping gives
the text back. Every assistant turn becomes an example of its own: all turns before it are context, and
only the reply between ``loss_start`` and ``loss_end`` is trained on. Turns after the last reply end up
in a closing example without a target, so that the output holds every turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, HEAD, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + "\\" + c[1:])), CONTROLS, doubled)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand(conversations: DataFrame, reply: str = "assistant") -> DataFrame:
    """``conv_id``, ``example`` (from 1), ``formatted``, ``loss_start``, ``loss_end`` (code points, end exclusive).

    Turns go by ``turn``, ties by role and text, null turns first; null roles and texts are empty.
    Repeated rows are turns of their own. Rows with a null ``conv_id`` are one conversation. A
    conversation without any reply gives one example without a target; an empty table gives none.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    talks = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    shown = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD), escape(t["text"]), F.lit(CLOSE)))
    replies = F.transform("turns", lambda t, i: F.when(t["role"] == reply, i + 1))
    ends = F.array_compact(F.array_union(replies, F.array(F.size("turns"))))
    sizes = F.transform("turns", lambda t: F.when(t["role"] == reply, F.length(escape(t["text"]))).otherwise(0))
    rows = talks.select("conv_id", shown.alias("shown"), sizes.alias("sizes"), F.posexplode(ends).alias("at", "end"))
    rows = rows.select("conv_id", (F.col("at") + 1).alias("example"), F.array_join(F.slice("shown", 1, F.col("end")), "").alias("formatted"), F.element_at("sizes", F.col("end")).alias("n"), F.element_at("shown", F.col("end")).alias("last"))
    is_reply = F.startswith("last", F.lit(OPEN + reply + HEAD))
    stop = F.length("formatted") - len(CLOSE)
    return rows.select("conv_id", "example", "formatted", F.when(is_reply, stop - F.col("n")).otherwise(F.length("formatted")).cast("long").alias("loss_start"), F.when(is_reply, stop).otherwise(F.length("formatted")).cast("long").alias("loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """What a reader of the examples finds for each conversation: its turns, and the text that is trained on."""
    trained = unescape(F.expr("substring(formatted, int(loss_start) + 1, int(loss_end - loss_start))"))
    talks = examples.withColumn("trained", trained).groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "trained"))), lambda x: x["trained"]), "").alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    parts = F.split("longest", CLOSE, -1)
    bare = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))
    role = lambda p: F.substring_index(p, HEAD, 1)
    text = lambda p: F.substring(p, F.length(role(p)) + len(HEAD) + 1, F.length(p))
    said = F.transform(bare, lambda p: F.concat(unescape(role(p)), F.lit("\n"), unescape(text(p)), F.lit("\n")))
    return talks.select(
        "conv_id", F.size(said).cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"
    )
