"""Chat formatting of reply trees.

Messages form trees by their parents. Root-to-leaf paths come from self-joins that double their reach each
round, so a thread of n messages takes about log2(n) of them. Branches of a conversation are ranked by their
mean score, and each chosen path becomes one string, with the spans of it that a loss is taken on.

A turn is ``<s>[role] text [/role]</s>`` and a line break. ``&``, ``<``, ``[`` and ``]`` inside roles and texts are
written as ``&amp;``, ``&lt;``, ``&#91;`` and ``&#93;``, so no text can hold a mark, and reading back undoes it.

Cases: null texts and roles count as empty, null scores as 0. A message whose parent is missing starts a tree.
Messages whose chain of parents never ends belong to no path. Of messages repeated with one id the smallest
(parent, role, text) counts. Messages of a null conversation form one conversation. Equal scores rank by the
leaf's id. One conversation is one row of the result, so it must fit in memory; its tree need not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.runtime import materialize

ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, F.coalesce(text, F.lit("")))


def unescape(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES), text)


def by_turn(conversations: DataFrame) -> DataFrame:
    """Messages of plain conversations: each turn answers the one before. Equal turns go by role, then text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    number = F.row_number().over(order).cast("long")
    rows = conversations.select("conv_id", number.alias("msg_id"), "role", "text")
    return rows.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def unique_messages(messages: DataFrame) -> DataFrame:
    order = Window.partitionBy("conv_id", "msg_id").orderBy("parent_id", "role", "text", "score")
    return messages.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def paths(messages: DataFrame) -> DataFrame:
    """Every root-to-leaf path: ``conv``, ``leaf``, ``node`` and its ``distance`` above the leaf.

    ``conv`` is the conversation as a text that is never null. After round j the ancestors at distances below
    2^j are known, and the ancestor at 2^j of every message that has one.
    """
    nodes = materialize(messages.select(_conv(), F.col("msg_id").alias("node"), F.col("parent_id").alias("up")), "chat-nodes")
    here = nodes.select("conv", F.col("node").alias("up"))
    jumps = materialize(nodes.where("up is not null").join(here, ["conv", "up"]).select("conv", "node", "up"), "chat-jumps")
    inner = jumps.select("conv", F.col("up").alias("node")).distinct()
    found = materialize(
        nodes.join(inner, ["conv", "node"], "left_anti").select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance")),
        "chat-paths",
    )
    largest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach <= largest and not jumps.isEmpty():
        further = found.join(jumps, ["conv", "node"]).select("conv", "leaf", F.col("up").alias("node"), (F.col("distance") + reach).alias("distance"))
        found = found.unionByName(materialize(further, "chat-paths"))
        twice = jumps.select("conv", F.col("node").alias("up"), F.col("up").alias("further"))
        jumps = materialize(jumps.join(twice, ["conv", "up"]).select("conv", "node", F.col("further").alias("up")), "chat-jumps")
        reach *= 2
    if reach > largest and not jumps.isEmpty():  # still an ancestor beyond every message: a circle
        found = found.join(jumps.select("conv", F.col("node").alias("leaf")), ["conv", "leaf"], "left_anti")
    return found


def _conv() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``conv_id``, ``leaf``, ``score``, ``rank``, ``formatted`` and ``loss`` (spans in characters) of each chosen path.

    ``best`` paths of each conversation, all if None.
    """
    messages = materialize(unique_messages(messages), "chat-messages")
    on_path = paths(messages)
    mean = on_path.join(messages.select(_conv(), F.col("msg_id").alias("node"), "score"), ["conv", "node"])
    ranks = mean.groupBy("conv", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"))
    order = Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")
    ranks = ranks.withColumn("rank", F.row_number().over(order))
    chosen = ranks if best is None else ranks.where(F.col("rank") <= best)
    role, text = escape(F.col("role")), escape(F.col("text"))
    turns = (
        on_path.join(chosen, ["conv", "leaf"])
        .join(messages.select(_conv(), "conv_id", F.col("msg_id").alias("node"), "role", "text"), ["conv", "node"])
        .select(
            "conv", "conv_id", "leaf", "score", "rank", "distance", "role",
            F.concat(F.lit("<s>["), role, F.lit("] "), text, F.lit(" [/"), role, F.lit("]</s>\n")).alias("turn"),
            (F.length(role) + 6).alias("skip"), F.length(text).alias("long"),
        )
    )
    above = Window.partitionBy("conv", "leaf").orderBy(F.desc("distance")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("turn").cast("long")).over(above), F.lit(0)) + F.col("skip"))
    row = F.struct((-F.col("distance")).alias("at"), "turn", "start", (F.col("start") + F.col("long")).alias("end"), (F.col("role") == LOSS_ROLE).alias("loss"))
    whole = turns.groupBy("conv", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("score").alias("score"), F.first("rank").alias("rank"),
        F.array_sort(F.collect_list(row)).alias("rows"),
    )
    spans = F.transform(F.filter("rows", lambda r: r["loss"]), lambda r: F.struct(r["start"], r["end"]))
    return whole.select(
        "conv_id", "leaf", "score", "rank", F.array_join(F.col("rows.turn"), "").alias("formatted"), spans.alias("loss")
    )


def read_turns(formatted: Column) -> Column:
    """The roles and texts in a formatted conversation."""
    mark = r"^<s>\[([^\]]*)\] ([^\[]*) \[/"
    pieces = F.filter(F.split(formatted, "</s>\n"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(unescape(F.regexp_extract(p, mark, 1)).alias("role"), unescape(F.regexp_extract(p, mark, 2)).alias("text")),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )
