"""Chat formatting: root-to-leaf paths of reply trees, each written as one conversation.

Paths are found by self-joins that double their reach: first every message knows its parent,
then the message two above, four above and so on; the leaves then gather their whole path with
the same tables, so a path of n messages takes about log2(n) joins. Branches are ranked by the
sum of their messages' scores. All steps are DataFrame operations.

A formatted conversation is a row of turns, each ``<|im_start|>role`` and a line break, the text,
``<|im_end|>`` and a line break. Inside roles and texts a backslash is written twice, ``<|`` as
``<\\|``, and a line break in a role as ``<\\/``, so no text can end or begin a turn and the
writing can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.llm.tables import stored

# The marks of a turn.
START = "<|im_start|>"
END = "<|im_end|>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    marks = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(marks, F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\/"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every message of every root-to-leaf path, ``up`` steps above its leaf.

    ``nodes`` has tree, node and parent (null for a root), no two rows equal in (tree, node), no
    nulls in them. A parent that isn't there makes a root. Messages whose parents run in a
    circle have no root and are left out.
    """
    own = nodes.select("tree", "node", "parent")
    known = own.select("tree", F.col("node").alias("parent"))
    above = own.filter("parent IS NOT NULL").join(known, ["tree", "parent"], "left_semi")
    above = stored(above.select("tree", "node", F.col("parent").alias("above")), "reply-above")
    leaves = own.join(above.select("tree", F.col("above").alias("node")).distinct(), ["tree", "node"], "left_anti")
    reached = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "reply-paths")
    most = own.count()
    reach = 1
    while reach <= most and not above.isEmpty():
        # Each message on a path below 2**i leads to the one 2**i above, once.
        further = reached.join(above, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up"))
        reached = stored(reached.unionByName(further), "reply-paths")
        next_above = above.select("tree", F.col("node").alias("above"), F.col("above").alias("top"))
        above = stored(above.join(next_above, ["tree", "above"]).select("tree", "node", F.col("top").alias("above")), "reply-above")
        reach *= 2
    if reach > most and not above.isEmpty():  # longer than there are messages: a circle
        astray = reached.join(above.select("tree", "node"), ["tree", "node"], "left_semi").select("tree", "leaf").distinct()
        reached = reached.join(astray, ["tree", "leaf"], "left_anti")
    return reached


def conversations(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss) of the paths, the ``best`` of each tree or all.

    ``nodes`` has tree, node, parent, role, text and score. A path's score is the sum over its
    messages, null counts as 0; ties go to the smaller leaf. Null roles and texts are empty.
    ``loss`` lists the spans (start, length), in code points of ``formatted``, of the texts of
    ``assistant`` turns: the text alone, without marks.
    """
    messages = nodes.select(
        "tree",
        "node",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = paths(nodes)
    scores = found.join(messages.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")
    ranked = scores.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    text = escaped(F.col("text"))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    turns = messages.select(
        "tree",
        "node",
        (F.col("role") == LEARNED).alias("learned"),
        F.length(head).cast("long").alias("head"),
        F.length(text).cast("long").alias("length"),
        F.concat(head, text, F.lit(END + "\n")).alias("turn"),
    )
    chosen = found.join(ranked, ["tree", "leaf"]).join(turns, ["tree", "node"])
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    placed = chosen.withColumn("start", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.col("head"))
    rows = placed.groupBy("tree", "leaf", "rank", F.col("total").alias("score")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "turn"))).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("learned"), F.struct("start", "length")))).alias("loss"),
    )
    return rows.withColumn("formatted", F.array_join(F.col("turns.turn"), "")).drop("turns")


def chains(rows: DataFrame) -> DataFrame:
    """Reply trees of plain conversations: each row answers the one before it by turn.

    ``rows`` has conv_id, turn, role and text. Null turns come first; equal turns are ordered by
    role and text, and rows that are equal throughout stay as many turns.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none"))
    return numbered.select(
        tree.alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs that a formatted conversation was written from."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    written = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.length(role) + 2)
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(written, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
