"""Chat formatting of reply trees.

Messages form trees by parent ids. Self-joins double the reach of every
message's ancestor pointer, so that depth d takes log2(d) of them; leaves are
ranked by the score along their path, the chosen paths are spelled out through
the same pointers, and each becomes one conversation in a marked-up template.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from driftscan.session import materialize

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Text in which no control string can occur: a backslash is doubled, `<|` becomes `<\\|`, a line feed stays."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As escape(), and a line feed becomes `\\n`, for a role ends at one."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """The inverse of escape() and escape_role()."""
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(parts, "\\")


def reply_paths(messages: DataFrame, paths_per_tree: int | None = None, most_rounds: int = 40) -> DataFrame:
    """tree_id, leaf_id, path_rank, path_score, pos, msg_id: every message of every chosen root-to-leaf path.

    messages: tree_id, msg_id, parent_id, score. Leaves rank within their tree by
    the mean score of their path, best first, ties by msg_id; paths_per_tree
    None keeps all. A parent that does not exist makes its child a root; a null
    score counts as 0; rows with a null msg_id are left out; of rows with the
    same ids the one of least parent_id and score counts. A null tree_id is a
    tree like others. Cycles raise.
    """
    own = messages.filter("msg_id is not null").groupBy(F.struct("tree_id").alias("t"), "msg_id").agg(F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))).alias("m"))
    own = own.select("t", "msg_id", "m.parent_id", "m.score")
    known = own.select("t", F.col("msg_id").alias("up"))
    jump = own.withColumnRenamed("parent_id", "up").join(known.withColumn("there", F.lit(True)), ["t", "up"], "left")
    jump = materialize(jump.select("t", "msg_id", F.when(F.col("there"), F.col("up")).alias("up"), F.lit(1).cast("bigint").alias("n"), "score"), "jump")
    jumps, ended = [jump], []
    while not jump.filter("up is not null").isEmpty():
        if len(jumps) > most_rounds:
            raise ValueError("the parents form a cycle")
        # only messages whose pointer has not reached the root go on
        ended.append(jump.filter("up is null"))
        above = reduce(DataFrame.unionByName, ended, jump.filter("up is not null"))
        above = above.select("t", F.col("msg_id").alias("up"), F.col("up").alias("up2"), F.col("n").alias("n2"), F.col("score").alias("score2"))
        jump = jump.filter("up is not null").join(above, ["t", "up"]).select("t", "msg_id", F.col("up2").alias("up"), (F.col("n") + F.col("n2")).alias("n"), (F.col("score") + F.col("score2")).alias("score"))
        jump = materialize(jump, "jump")
        jumps.append(jump)
    whole = reduce(DataFrame.unionByName, ended, jump)
    parents = jumps[0].filter("up is not null").select("t", F.col("up").alias("msg_id")).distinct()
    leaves = whole.join(parents, ["t", "msg_id"], "left_anti").withColumn("path_score", F.col("score") / F.col("n"))
    order = Window.partitionBy("t").orderBy(F.desc("path_score"), "msg_id")
    leaves = leaves.withColumn("path_rank", F.row_number().over(order))
    if paths_per_tree is not None:
        leaves = leaves.filter(F.col("path_rank") <= paths_per_tree)
    path = leaves.select("t", F.col("msg_id").alias("leaf_id"), "path_rank", "path_score", "msg_id", (F.col("n") - 1).alias("pos"))
    for k in reversed(range(len(jumps) - 1)):
        step = jumps[k].filter("up is not null").select("t", "msg_id", "up")
        path = path.unionByName(path.join(step, ["t", "msg_id"]).select("t", "leaf_id", "path_rank", "path_score", F.col("up").alias("msg_id"), (F.col("pos") - (1 << k)).alias("pos")))
        path = materialize(path, "path")
    return path.select("t.tree_id", "leaf_id", "path_rank", "path_score", "pos", "msg_id")


def format_conversations(paths: DataFrame, messages: DataFrame, learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each path: tree_id, leaf_id, path_rank, formatted, segments.

    segments are the formatted string's parts in order, loss telling which of
    them are learned: the texts of the roles in learn_from. Null roles and texts
    are empty. A path's turns are gathered in one row, as the result must be.
    """
    told = messages.filter("msg_id is not null").groupBy(F.struct("tree_id").alias("t"), "msg_id").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    turns = paths.withColumn("t", F.struct("tree_id")).join(told, ["t", "msg_id"])
    turns = turns.groupBy("t", "leaf_id", "path_rank").agg(F.array_sort(F.collect_list(F.struct("pos", "m.role", "m.text"))).alias("turns"))

    def parts(x: Column) -> Column:
        def part(text, loss):
            return F.struct(text.alias("text"), loss.alias("loss"))

        return F.array(part(F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n")), F.lit(False)), part(escape(x["text"]), x["role"].isin(*learn_from)), part(F.lit(END + "\n"), F.lit(False)))

    out = turns.select("t.tree_id", "leaf_id", "path_rank", F.flatten(F.transform("turns", parts)).alias("segments"))
    return out.select("tree_id", "leaf_id", "path_rank", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and text, unescaped."""

    def turn(x: Column) -> Column:
        inner = F.substring(x, F.lit(len(START) + 1), F.length(x))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(inner, F.length(role) + 2, F.length(inner))).alias("text"))

    whole = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(F.slice(whole, F.lit(1), F.size(whole) - 1), turn)


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations of plain turns as reply trees without branches: each turn answers the one before it.

    Turns are in the order of turn, then role and text, so that gaps, ties and
    repeated rows keep all their rows.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(order).cast("bigint")
    return conversations.select("conv_id", "turn", "role", "text").select(
        F.col("conv_id").alias("tree_id"), n.alias("msg_id"), F.when(n > 1, n - 1).alias("parent_id"), "role", "text", F.lit(0.0).cast(T.DoubleType()).alias("score")
    )
