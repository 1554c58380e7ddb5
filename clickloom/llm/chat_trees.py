"""Chat formatting of reply trees.

Messages point to the message they answer. Self-joins over pointers that double
their reach (parent, grandparent, ...) find each message's depth, root and the
summed score of its path in as many rounds as the depth has binary digits; the
branches of a tree are ranked by score, and the same pointers, applied to the
chosen leaves, list every message on the chosen paths. Only ids travel in these
joins. Each path is then formatted as one conversation.

A turn is ``<s>[ROLE] role [/ROLE] text </s>``. Control strings inside roles and
texts get a backslash after their first character, one more than they had
there, and unescaping takes one away, which gives back every text. The loss mask
covers the assistant's texts, as code-point spans of the formatted string.

Only DataFrame functions are used.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

#: strings with a meaning of their own to this template or to common ones
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
#: first character, backslashes already there, rest
_CONTROL = r"([<\[])(\\*+)(/?(?:s>|INST\]|ROLE\]))"
_ESCAPED = r"([<\[])\\(\\*+)(/?(?:s>|INST\]|ROLE\]))"
OPEN, BETWEEN, CLOSE = "<s>[ROLE] ", " [/ROLE] ", " </s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _reach(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, id, root, depth, total) of every message that reaches a root, and
    the pointer tables (tree, id, up) for 1, 2, 4, ... steps. Trees that are
    done leave the loop, so a few deep ones do not drag the others along."""
    pointers: list[DataFrame] = []
    done: list[DataFrame] = []
    state = cut_lineage(nodes.select(
        "tree", "id", F.col("parent").alias("up"), F.col("id").alias("top"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("score").alias("total")))
    # what still points upwards after so many doublings goes round in a circle
    for _ in range(1 + ceil(log2(max(2, nodes.count())))):
        open_ = state.where(F.col("up").isNotNull())
        trees = open_.select(F.col("tree").alias("t")).distinct()
        done.append(state.join(trees, F.col("tree").eqNullSafe(F.col("t")), "left_anti"))
        if open_.isEmpty():
            state = None
            break
        pointers.append(open_.select("tree", "id", "up"))
        active = cut_lineage(state.join(trees, F.col("tree").eqNullSafe(F.col("t")), "left_semi"))
        above = active.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("up").alias("up2"), F.col("top").alias("top2"),
                              F.col("depth").alias("depth2"), F.col("total").alias("total2"))
        moved = active.where(F.col("up").isNotNull()).join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("i")))
        moved = moved.select("tree", "id", F.col("up2").alias("up"), F.col("top2").alias("top"), (F.col("depth") + F.col("depth2")).alias("depth"),
                             (F.col("total") + F.col("total2")).alias("total"))
        state = cut_lineage(active.where(F.col("up").isNull()).unionByName(moved))
    if state is not None:
        done.append(state.where(F.col("up").isNull()))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("tree", "id", F.col("top").alias("root"), "depth", "total"), pointers


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, rank, id, depth``: the messages of each tree's ``branches``
    best root-to-leaf paths (highest summed score, then smallest leaf id).

    ``messages`` has tree, id, parent, score. A parent that is not there makes a
    root; every root of a tree is ranked on its own; messages that answer each
    other in a circle belong to no path."""
    known = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"))
    nodes = (messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
             .join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("i")), "left")
             .select("tree", "id", F.col("i").alias("parent"), "score"))
    nodes = cut_lineage(nodes)
    reached, pointers = _reach(nodes)
    parents = nodes.where(F.col("parent").isNotNull()).select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = reached.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p")), "left_anti")
    best = Window.partitionBy("tree", "root").orderBy(F.col("total").desc(), "id")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    found = chosen.select("tree", F.col("id").alias("leaf"), "rank", "id", "depth")
    for step, up in enumerate(pointers):
        above = up.select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
        higher = (found.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")))
                  .select("tree", "leaf", "rank", F.col("up").alias("id"), (F.col("depth") - F.lit(1 << step)).alias("depth")))
        found = cut_lineage(found.unionByName(higher))
    return found


def format_paths(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """``tree, leaf, rank, formatted, loss_spans`` of each chosen path: the turns
    from the root down, and (start, end) of the assistant's texts in code points."""
    texts = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(BETWEEN))
    body = escape(F.col("text"))
    turns = (chosen.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")))
             .select("tree", "leaf", "rank", "depth", "role", head.alias("head"), body.alias("body")))
    along = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(CLOSE)
    placed = turns.withColumn("at", F.coalesce(F.sum(size).over(along), F.lit(0)))
    start = F.col("at") + F.length("head")
    turn = F.struct("depth", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), (F.col("role") == LOSS_ROLE).alias("loss"),
                    start.alias("start"), (start + F.length("body")).alias("end"))
    rows = placed.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select(
        "tree", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss_spans"))


def chain(conversations: DataFrame) -> DataFrame:
    """Conversations as trees of one branch: each row answers the one before it
    by turn. Rows that share a turn follow each other by role, then
    by a hash of the text; equal ones are alike, so their order does not show."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "hash")
    rows = conversations.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("hash"))
    numbered = rows.withColumn("id", F.row_number().over(order).cast("long"))
    return numbered.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                           F.lit(0.0).alias("score"), "role", "text")


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are full of control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss of formatted conversations, taken from the strings alone."""
    parts = F.split("formatted", CLOSE)
    turns = F.slice(parts, 1, F.size(parts) - 1)
    field = lambda part, i: unescape(F.regexp_extract(part, r"(?s)^<s>\[ROLE\] (.*?) \[/ROLE\] (.*)$", i))
    said = F.array_join(F.transform("turns", lambda p: F.concat(field(p, 1), F.lit("\n"), field(p, 2), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return (formatted.withColumn("turns", turns).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation, rows by turn, plus the control conversation.

    A null text or role is empty; a null turn comes first; rows with a null
    conv_id are one conversation; repeated rows are repeated turns. An empty
    table gives the control conversation alone; other columns are not read."""
    columns = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(*columns).unionByName(control_conversation(conversations.sparkSession))
    messages = cut_lineage(chain(rows))
    return format_paths(messages, paths(messages))
