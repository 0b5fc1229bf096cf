"""Chat formatting over reply trees (operator 6).

Messages are nodes of trees: each names its parent, roots name none.  Pointer
doubling by self-joins gives every node its root, depth and the score summed
along its path; root-to-leaf paths are then ranked per root by that score, and
the chosen leaves collect their ancestors by walking the same pointers from
the longest to the shortest.  Each chosen path becomes one conversation text.

The template is ``<|turn|>role<|text|>text<|end|>`` per turn.  Control strings
inside roles and texts are broken by a backslash after their first character,
and backslashes are doubled, so ``parse`` gives back exactly what went in.
``loss`` spans (start, length in code points) cover the assistant texts.

Results on odd input: null roles and texts are empty; a node whose parent does
not exist is a root; nodes of a parent cycle have no root and are left out;
equal scores go to the smaller leaf id; rows without a node id are left out
and of rows that repeat a node id the first by (role, text) stands; an
empty table gives no conversation; other columns are not read.  A conversation is one
value, so a task must hold the longest conversation, but never a whole tree.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schemelens.llm.common import Scratch, map_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that this or a common chat template reads as control marks.
CONTROLS = (TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
            "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_BREAK = re.compile(r"\\(\\?)")
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(s: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], s.replace("\\", "\\\\"))


def unescape(s: str) -> str:
    return _BREAK.sub(r"\1", s)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(conversation text, loss spans)."""
    out, at, loss = [], 0, []
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == ASSISTANT:
            loss.append((at + len(head), len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def paths(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """(root, leaf, rank, score, node_id, depth): the nodes of the ``per_root`` best root-to-leaf paths of each root.

    ``nodes`` has node_id, parent_id and score (null counts 0); ids of any one type.
    """
    scratch = Scratch(nodes.sparkSession, "reply-trees")
    base = nodes.select("node_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    ids = base.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("known"))
    start = base.join(ids, "parent_id", "left").select(
        "node_id", F.when(F.col("known"), F.col("parent_id")).alias("up"), F.lit(1).alias("steps"), "score")
    # up: the ancestor 2^k above (null: there is none); top: the highest one reached; score and steps up to below `up`
    jump = scratch.keep(start.select("node_id", "up", F.when(F.col("up").isNull(), F.col("node_id")).alias("root"),
                                     F.col("steps").cast("long").alias("depth"), "score"))
    jumps = [jump]
    open_nodes = jump.where("up is not null").count()
    while open_nodes:
        far = jump.select(F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"),
                          F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        moving = jump.where("up is not null").join(far, "up").select(
            "node_id", F.col("up2").alias("up"), F.col("root2").alias("root"),
            (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("score") + F.col("score2")).alias("score"))
        jump = scratch.keep(jump.where("up is null").unionByName(moving))
        left = jump.where("up is not null").count()
        jumps.append(jump)
        if left == open_nodes and 2 ** len(jumps) > 2 * jump.count():
            break  # only cycles are left
        open_nodes = left
    leaves = jump.where("root is not null").join(
        base.select(F.col("parent_id").alias("node_id")).where("node_id is not null").distinct(), "node_id", "left_anti")
    order = Window.partitionBy("root").orderBy(F.col("score").desc(), "node_id")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_root).select(
        "root", F.col("node_id").alias("leaf"), "rank", "score", F.col("node_id"))
    chosen = scratch.keep(chosen)
    for step in reversed(jumps[:-1]):
        above = chosen.join(step.select("node_id", "up").where("up is not null"), "node_id").select(
            "root", "leaf", "rank", "score", F.col("up").alias("node_id"))
        chosen = scratch.keep(chosen.unionByName(above))
    return chosen.join(jump.select("node_id", "depth"), "node_id")


FORMATTED = "formatted string, loss array<struct<start:int,length:int>>"


def format_paths(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """(root, leaf, rank, n_turns, formatted, loss) of each chosen path.

    ``nodes`` has node_id, parent_id, role, text and score.
    """
    one = Window.partitionBy("node_id").orderBy("role", "text", "parent_id", "score")
    scratch = Scratch(nodes.sparkSession, "chat")
    nodes = scratch.keep(nodes.where("node_id is not null").select("node_id", "parent_id", "role", "text", "score")
                         .withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n"))
    said = paths(nodes, per_root).join(nodes.select("node_id", "role", "text"), "node_id")
    turn = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = said.groupBy("root", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = whole.select("root", "leaf", "rank", F.size("turns").alias("n_turns"), "turns")
    head = rows.schema.fields[:4]

    def run(batch):
        got = [write([(t["role"], t["text"]) for t in turns]) for turns in batch.column(4).to_pylist()]
        loss = pa.array([[{"start": a, "length": n} for a, n in spans] for _, spans in got],
                        pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([f for f, _ in got], pa.string()), loss],
                                         names=[f.name for f in head] + ["formatted", "loss"])

    return map_batches(rows, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in head) + ", " + FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """The columns of ``format_paths`` and, from the text and its spans alone, turns and loss_texts (unescaped)."""
    at, spans = formatted.columns.index("formatted"), formatted.columns.index("loss")
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batch):
        texts, loss = batch.column(at).to_pylist(), batch.column(spans).to_pylist()
        turns = pa.array([[{"role": r, "text": t} for r, t in parse(f)] for f in texts], pa.list_(turn))
        under = pa.array([[unescape(f[s["start"]:s["start"] + s["length"]]) for s in own]
                          for f, own in zip(texts, loss)], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, turns, under],
                                         names=[*batch.schema.names, "turns", "loss_texts"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in formatted.schema.fields)
    return map_batches(formatted, run, kinds + ", turns array<struct<role:string,text:string>>, loss_texts array<string>")
