"""Chat formatting from reply trees, in DataFrame operations only.

A tree is a set of nodes with a parent each. Runs of nodes without a branch are first joined up by
pointer doubling (a self-join in which a node's reach doubles each round), so a thread of n replies takes
log n rounds; then root-to-leaf paths are enumerated by self-joins of the runs, one level of branching a
round. Paths are ranked by score within their tree, and each chosen path is one conversation.

The template marks turns as <|im_start|>role\\ntext<|im_end|>\\n. A control string inside a text gets one
backslash after its first character; one that has k backslashes there gets k + 1, which makes it reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, or_empty, partitions, table

START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that chat templates give a meaning; never left as they are inside a text.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _rest() -> str:
    quoted = "".join
    tails = sorted({c[1:] for c in CONTROL}, key=lambda t: (-len(t), t))
    return "|".join(quoted("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in t) for t in tails)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_rest()})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_rest()})", "$1$2$3")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    plain = F.replace(F.replace(unescaped(role), F.lit("\\\\"), F.lit("\x00")), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\x00"), F.lit("\\"))


def conversation_nodes(turns: DataFrame) -> DataFrame:
    """Rows by turn as a reply tree without branches: tree, id, parent, score, role, text. Rows of one turn follow
    each other in the order of role and text; null texts and roles are empty, a null turn comes first; null conversations
    are one. An empty table gives no rows; other columns are ignored, whatever their names."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    n = F.row_number().over(order)
    node = lambda k: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), k)
    return turns.select(
        F.col("conv_id").alias("tree"), node(n).alias("id"), F.when(n > 1, node(n - 1)).alias("parent"), F.lit(0.0).alias("score"), or_empty("role").alias("role"), or_empty("text").alias("text")
    )


def runs_of(links: DataFrame, scratch: Scratch) -> DataFrame:
    """id, parent, score, leaf, head, dist: each node's run of unbranched replies (by its first node) and its place there."""
    # Nodes without a parent are split off: their nulls would meet in one task of a join.
    fans = links.filter("parent is not null").groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("fan"))
    fans = scratch.keep(fans.join(links.select(F.col("id").alias("p")), "p", "left_semi"), "fans")
    own = F.col("id") == F.col("p")
    nodes = links.join(fans, own, "left").select("tree", "id", "parent", "score", F.col("fan").isNull().alias("leaf"))
    nodes = scratch.keep(nodes, "with-leaves")
    replies = nodes.filter("parent is not null").join(fans, F.col("parent") == F.col("p"), "left")  # a reply to nothing that is there starts a tree
    replies = replies.select("tree", "id", F.col("p").alias("parent"), "score", "leaf", (F.col("p").isNull() | (F.col("fan") > 1)).alias("is_head"))
    nodes = nodes.filter("parent is null").withColumn("is_head", F.lit(True)).unionByName(replies)
    nodes = scratch.keep(nodes, "nodes")
    at = nodes.select(
        "id", F.when(F.col("is_head"), F.col("id")).otherwise(F.col("parent")).alias("head"), F.when(F.col("is_head"), 0).otherwise(1).cast("long").alias("dist"), F.col("is_head").alias("done")
    )
    at = scratch.keep(at, "reach0")
    n, total, step = at.filter("not done").count(), at.count(), 0
    while n and 2**step <= 2 * total:  # a circle of replies has no head and is left when any chain would be done
        far = at.select(F.col("id").alias("head"), F.col("head").alias("head2"), F.col("dist").alias("dist2"), F.col("done").alias("done2"))
        moved = at.filter("not done").join(far, "head", "left").select(
            "id", F.coalesce("head2", "head").alias("head"), (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist"), F.coalesce("done2", F.lit(True)).alias("done")
        )
        step += 1
        at = scratch.keep(at.filter("done").unionByName(moved), f"reach{step}")
        scratch.drop(f"reach{step - 1}")
        n = at.filter("not done").count()
    return nodes.join(at.filter("done").select("id", "head", "dist"), "id")


def paths_of(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """tree, path (heads of the runs from the root on), score (mean over its nodes): a row per root-to-leaf path."""
    runs = placed.groupBy("head").agg(F.sum("score").alias("score"), F.count("*").alias("n"), F.max("leaf").alias("leaf"))
    of = placed.select(F.col("id").alias("parent"), F.col("head").alias("above"))
    tops = placed.filter("dist = 0").select("tree", F.col("id").alias("head"), "parent")
    below = tops.filter("parent is not null").join(of, "parent", "left").select("tree", "head", "above")
    tops = tops.filter("parent is null").select("tree", "head", F.lit(None).cast("string").alias("above")).unionByName(below)
    runs = scratch.keep(tops.join(runs, "head").select("tree", "head", "above", "score", "n", "leaf"), "runs")
    step, done = 0, None
    front = runs.filter("above is null").select("tree", F.array("head").alias("path"), "head", "score", "n", "leaf")
    while True:
        front = scratch.keep(front, f"paths{step}")
        ended = front.filter("leaf")
        done = ended if done is None else done.unionByName(ended)
        more = front.filter("not leaf")
        if more.isEmpty():
            break
        below = runs.filter("above is not null").select(F.col("above").alias("head"), F.col("head").alias("next"), F.col("score").alias("score2"), F.col("n").alias("n2"), F.col("leaf").alias("leaf2"))
        front = more.join(below, "head").select(
            "tree", F.concat("path", F.array("next")).alias("path"), F.col("next").alias("head"), (F.col("score") + F.col("score2")).alias("score"), (F.col("n") + F.col("n2")).alias("n"), F.col("leaf2").alias("leaf")
        )
        step += 1
    return done.select("tree", "path", F.col("head").alias("last"), (F.col("score") / F.col("n")).alias("score"))


def best_paths(paths: DataFrame, keep: int | None, scratch: Scratch, salts: int = 64) -> DataFrame:
    """The keep paths with the highest scores of each tree (all if None; smallest last run first among equals), with
    branch_rank from 1. A tree of any width is first ranked in salted parts, or in ranges if all its paths stay."""
    order = [F.col("score").desc(), "last"]
    if keep is not None:
        some = paths.withColumn("part", F.pmod(F.xxhash64("last"), F.lit(salts)))
        some = some.withColumn("branch_rank", F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))).filter(F.col("branch_rank") <= keep)
        return some.withColumn("branch_rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).filter(F.col("branch_rank") <= keep).drop("part")
    ranged = paths.repartitionByRange(partitions(paths.sparkSession), F.col("tree").asc(), *order).withColumn("part", F.spark_partition_id())
    ranged = scratch.keep(ranged, "ranged")
    # Trees in one range, nearly all, need no count of what is before.
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    some = ranged.withColumn("branch_rank", F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)))
    later = counts.filter("before > 0").select(F.col("tree").alias("t"), F.col("part").alias("q"), "before")
    some = some.join(later, F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("q")), "left")
    return some.withColumn("branch_rank", (F.col("branch_rank") + F.coalesce("before", F.lit(0))).cast("int")).drop("part", "t", "q", "before")


def format_paths(nodes: DataFrame, keep: int | None = None, train_role: str = "assistant") -> DataFrame:
    """One row per chosen root-to-leaf path: tree, path_id (its last node's run), branch_rank (from 1, best score of its
    tree first), score, n_turns, formatted, loss_spans.

    nodes: tree, id, parent, score, role, text. Of rows with one id the first by score (highest), role and text
    stays. Replies to an unknown parent start a tree of their own, circles of replies (which have no root) give no
    path. A null score counts as 0. loss_spans: code points [start, end) of formatted that hold texts of train_role.
    keep: paths for each tree, best score first; None for all. Null ids are one node; a null tree is a tree; an empty
    table gives no rows; other columns are ignored, whatever their names. A path is one text, however long.
    """
    scratch = Scratch(nodes.sparkSession, "chat")
    best = F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), or_empty("role").alias("role"), or_empty("text").alias("text"), "tree", "parent")).alias("b")
    one = scratch.keep(nodes.groupBy("id").agg(best).select("id", "b.*"), "given")
    placed = scratch.keep(runs_of(one.select("tree", "id", "parent", "score"), scratch), "placed")
    scratch.only("given", "placed")
    paths = best_paths(paths_of(placed, scratch), keep, scratch)
    if keep is None:
        scratch.only("given", "placed", "ranged")
    steps = paths.select("tree", F.col("last").alias("path_id"), "branch_rank", F.col("score").alias("path_score"), F.posexplode("path").alias("run_no", "head"))
    where = placed.select("head", "dist", "id").join(steps, "head")
    mark = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    turns = where.join(one.select("id", "role", mark.alias("mark"), body.alias("body")), "id")
    # Lengths are summed in order before anything is gathered, so that spans need no second pass over the text.
    so_far = Window.partitionBy("path_id").orderBy("run_no", "dist").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("stop", F.sum(F.length("mark") + F.length("body") + len(END)).over(so_far) - len(END))
    turns = turns.withColumn("span", F.when(F.col("role") == train_role, F.struct((F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("end"))))
    each = F.sort_array(F.collect_list(F.struct("stop", F.concat("mark", "body", F.lit(END)).alias("piece"), "span")))
    whole = turns.groupBy("tree", "path_id", "branch_rank", "path_score").agg(each.alias("t"))
    return whole.select(
        "tree", "path_id", "branch_rank", F.col("path_score").alias("score"), F.size("t").cast("long").alias("n_turns"), F.array_join(F.col("t.piece"), "").alias("formatted"), F.filter(F.col("t.span"), lambda s: s.isNotNull()).alias("loss_spans")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (role and text of each, unescaped) and loss_text (unescaped text under the loss mask, joined)."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    inner = F.transform(pieces, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    turn = lambda p: F.struct(unescaped_role(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.substring(p, F.instr(p, F.lit("\n")) + 1, F.length(p))).alias("text"))
    masked = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", F.transform(inner, turn)).withColumn("loss_text", F.array_join(masked, ""))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    done = read_back(format_paths(conversation_nodes(turns.unionByName(extra))))
    as_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(as_text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql() -> str:
    said = "</s>[INST] ok [/INST]"
    body = rf"regexp_replace(text, '([<\[])(\\*)({_rest()})', '\1\\\2\3', 'g')"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{said}' UNION ALL SELECT -7, 1, 'assistant', '{said}'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum({len(START) + 1 + len(END)} + length(role) + length({body})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


OP1_SQL = _sql()
