"""Chat formatting of reply trees.

Nodes name their parent. Iterative self-joins that double the known distance
find every node's root, depth and score sum; leaves are ranked by the mean score
of their path; the chosen leaves' paths are enumerated by joins with the same
jump tables; and each path becomes one conversation in a template with a loss
mask over the assistant's texts.

Defined cases: null text and null role count as empty; a node whose parent is
missing is a root; nodes on or below a cycle have no root and are left out;
repeated node ids within a tree count once (the smallest row by parent, role and
text, nulls first); equal scores go to the smaller leaf id; a null score is 0;
extra columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.llm.shared import require, write_scratch

#: Control strings of the template (fixed values).
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
NAMES = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"), ("\n", "\\n"))

FORMATTED = "tree long, leaf long, score double, formatted string, loss array<struct<start:long,stop:long>>"


def escape(text: str, header: bool = False) -> str:
    """No control string is left: their first characters are replaced, reversibly."""
    for char, code in ESCAPES if header else ESCAPES[:3]:
        text = text.replace(char, code)
    return text


def unescape(text: str) -> str:
    back = {code[1]: char for char, code in ESCAPES}
    first, *rest = text.split("\\")
    out, pending = [first], False
    for part in rest:
        if pending:  # the part after an escaped backslash
            out.append(part)
            pending = False
        elif part:
            out.append(back[part[0]] + part[1:])
        else:
            out.append("\\")
            pending = True
    return "".join(out)


def format_path(turns) -> tuple[str, list[tuple[int, int]]]:
    """``(role, text)`` turns as one text, and the spans of the assistant's texts in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        name = NAMES.get(role) or "=" + escape(role or "", header=True)
        head, body = OPEN + name + MIDDLE, escape(text or "")
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    known = {name: role for role, name in NAMES.items()}
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        name, _, body = piece[len(OPEN):].partition(MIDDLE)
        turns.append((known.get(name) if name[:1] != "=" else unescape(name[1:]), unescape(body)))
    return turns


def nodes_from_turns(rows: DataFrame) -> DataFrame:
    """``(tree, node, parent, role, text, score)`` of conversations that are chains of turns.

    Rows follow by turn (null first), rows of one turn by role and text; every
    row, repeated ones too, is a node.
    """
    require(rows, "conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (rows.select("conv_id", "turn", "role", "text")
            .withColumn("node", F.row_number().over(order).cast("long"))
            .select(F.col("conv_id").alias("tree"), "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score")))


def choose_paths(nodes: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """``(tree, leaf, score, turns)`` of the best root-to-leaf paths, turns in order.

    Joins run on (tree, node), which spreads one large tree over all tasks. The
    number of joins is twice the binary logarithm of the longest path. Each
    round is written to the shared folder.
    """
    require(nodes, "tree", "node", "parent", "role", "text", "score")
    fields = ["parent", "role", "text", "score"]
    nodes = nodes.select(F.coalesce("tree", F.lit(-(1 << 63))).alias("tree"),
                         F.coalesce("node", F.lit(-(1 << 63))).alias("node"), *fields)
    nodes = write_scratch(nodes.groupBy("tree", "node").agg(F.min(F.struct(*fields)).alias("r"))
                          .select("tree", "node", *[F.col(f"r.{c}").alias(c) for c in fields]), "chat-nodes")
    known = nodes.select("tree", "node")
    state = nodes.select("tree", "node", F.col("parent").alias("up"),
                         F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("depth"))
    state = state.join(known.select("tree", F.col("node").alias("up"), F.lit(True).alias("there")),
                       ["tree", "up"], "left").withColumn("up", F.when(F.col("there"), F.col("up"))).drop("there")
    jumps, most = [], nodes.count()
    while True:
        state = write_scratch(state, "chat-jump")
        if state.where("up IS NOT NULL").isEmpty() or 1 << len(jumps) > most:
            break
        jumps.append(state.where("up IS NOT NULL").select("tree", "node", "up"))
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"),
                             F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        # nodes that have reached their root are done; only the others are joined again
        further = state.where("up IS NOT NULL").join(above, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"),
            (F.col("total") + F.col("_total")).alias("total"), (F.col("depth") + F.col("_depth")).alias("depth"))
        state = state.where("up IS NULL").select("tree", "node", "up", "total", "depth").union(further)
    rooted = state.where("up IS NULL")
    leaves = rooted.join(nodes.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    chosen = (leaves.select("tree", F.col("node").alias("leaf"), "depth",
                            (F.col("total") / F.col("depth")).alias("score"))
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= paths_per_tree))
    chosen = write_scratch(chosen.select("tree", "leaf", "depth", "score"), "chat-leaves")
    path = chosen.select("tree", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("at"))
    for k in reversed(range(len(jumps))):
        higher = path.join(jumps[k], ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("at") - (1 << k)).alias("at"))
        path = write_scratch(path.union(higher), "chat-path")
    turns = (path.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
             .groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns")))
    return (turns.join(chosen.select("tree", "leaf", "score"), ["tree", "leaf"])
            .withColumn("tree", F.when(F.col("tree") > -(1 << 63), F.col("tree"))))


def format_paths(paths: DataFrame) -> DataFrame:
    """``(tree, leaf, score, formatted, loss)``: ``loss`` are code point spans of the formatted text."""
    def run(frames):
        for frame in frames:
            done = [format_path((t["role"], t["text"]) for t in turns) for turns in frame["turns"]]
            frame["formatted"] = [text for text, _ in done]
            frame["loss"] = [[{"start": a, "stop": b} for a, b in spans] for _, spans in done]
            frame["tree"] = frame["tree"].astype("Int64")
            yield frame[["tree", "leaf", "score", "formatted", "loss"]]

    return paths.select("tree", "leaf", "score", "turns").mapInPandas(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds: turns, their digest, and the text under the mask."""
    def run(frames):
        for frame in frames:
            out = []
            for tree, text, spans in zip(frame["tree"], frame["formatted"], frame["loss"]):
                turns = parse(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[s["start"]:s["stop"]]) for s in spans)
                out.append((tree, len(turns), hashlib.sha256(whole.encode()).hexdigest(),
                            len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=["tree", "n_turns", "turns_sha256", "loss_chars",
                                             "loss_sha256", "formatted_chars"]).astype({"tree": "Int64"})

    return formatted.select("tree", "formatted", "loss").mapInPandas(
        run, "tree long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
