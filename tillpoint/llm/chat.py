"""Reply trees to training conversations.

Rows are nodes of reply trees (conversation, node, parent, role, text, score).
Self-joins that double the step (1, 2, 4, ... ancestors) give every node its depth
and its path's total score in a logarithmic number of rounds; leaves are ranked
by it within their conversation; the chosen leaves' paths are enumerated by the
same doubled steps.  Every join is on (conversation, node), which is unique, and
carries ids and scores only: texts join once, on the nodes of chosen paths.

A path becomes one text.  Turns are marked by control strings; inside roles and
texts every occurrence of a control string gets a backslash after its first
character and every backslash is doubled, so no text can forge a turn and the
original comes back exactly.  ``loss_spans`` are the character ranges of the
assistant's texts.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.session import cut_lineage

TURN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings that no text may hold unescaped: our own and those of other common templates (fixed values).
CONTROL = [TURN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_START = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    return _START.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(roles: list[str], texts: list[str], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the ranges (start, end) of the turns to learn."""
    out, spans, at = [], [], 0
    for role, text in zip(roles, texts):
        head, body = TURN + escape(role) + SEP, escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURNS.findall(formatted)]


def _same(left: DataFrame, c: str, n: str, right: DataFrame, rc: str, rn: str) -> Column:
    return left[c].eqNullSafe(right[rc]) & (left[n] == right[rn])


def chosen_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(c, leaf, rank, node, depth): the nodes of the ``top`` best root-to-leaf paths of each conversation.

    ``nodes``: c (conversation), node, parent, score; (c, node) unique.  A path's score is the mean score of its
    nodes (null scores count as 0); ties go to the smaller leaf.  A parent that isn't there makes its child a root;
    a null node raises, as repeated nodes and circles do.
    """
    base = cut_lineage(nodes.select("c", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")))
    per_node = base.groupBy("c", "node").agg(F.count("*").alias("n"))
    most, twice, nameless = per_node.agg(F.sum("n"), F.count_if(F.col("n") > 1), F.count_if(F.col("node").isNull())).first()
    if twice or nameless:
        raise ValueError("nodes must be unique and not null in their conversation")
    ids = base.select(F.col("c").alias("pc"), F.col("node").alias("pn"))
    step = base.join(ids, _same(base, "c", "parent", ids, "pc", "pn"), "left")
    state = cut_lineage(step.select("c", "node", F.col("pn").alias("anc"), F.col("score").alias("total"),
                                    F.when(F.col("pn").isNull(), 0).otherwise(1).alias("depth")))
    steps = []   # step k leads 2^k nodes up; a node settles once its steps reach the root
    while not (moving := state.filter("anc is not null")).isEmpty():
        if 2 ** len(steps) > most:
            raise ValueError("the replies run in a circle")
        steps.append(moving.select("c", "node", "anc"))
        up = state.toDF("uc", "un", "u_anc", "u_total", "u_depth")
        moved = moving.join(up, _same(moving, "c", "anc", up, "uc", "un")).select(
            "c", "node", F.col("u_anc").alias("anc"), (F.col("total") + F.col("u_total")).alias("total"),
            (F.col("depth") + F.col("u_depth")).alias("depth"))
        state = cut_lineage(state.filter("anc is null").union(moved))
    parents = base.filter("parent is not null").select(F.col("c").alias("lc"), F.col("parent").alias("ln")).distinct()
    leaves = state.join(parents, _same(state, "c", "node", parents, "lc", "ln"), "left_anti")
    order = Window.partitionBy("c").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), "node")
    best = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    walk = cut_lineage(best.select("c", F.col("node").alias("leaf"), "rank", "node"))
    for jump in steps:   # what is found reaches 2^k nodes up; its 2^k-th ancestors double that
        j = jump.toDF("jc", "jn", "anc")
        further = walk.join(j, _same(walk, "c", "node", j, "jc", "jn")).select("c", "leaf", "rank", F.col("anc").alias("node"))
        walk = cut_lineage(walk.union(further))
    depths = state.select(F.col("c").alias("dc"), F.col("node").alias("dn"), "depth")
    return walk.join(depths, _same(walk, "c", "node", depths, "dc", "dn")).select("c", "leaf", "rank", "node", "depth")


def _formatted(roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
    made = [format_turns(list(r), list(t)) for r, t in zip(roles, texts)]
    return pd.DataFrame({"formatted": [m[0] for m in made], "loss_spans": [[{"start": a, "end": b} for a, b in m[1]] for m in made]})


def format_trees(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(c, leaf, rank, n_turns, formatted, loss_spans): each chosen path as one conversation.

    ``nodes``: c, node, parent, role, text, score.  Null roles and texts are empty; a null conversation is one of
    its own; an empty table gives an empty table.  One conversation's text is one value, as the result demands;
    everything before it is spread by node.
    """
    paths = chosen_paths(nodes, top)
    texts = nodes.select(F.col("c").alias("tc"), F.col("node").alias("tn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = paths.join(texts, _same(paths, "c", "node", texts, "tc", "tn"))
    each = turns.groupBy("c", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    made = each.withColumn("m", F.pandas_udf(_formatted, "formatted string, loss_spans array<struct<start:int,end:int>>")(F.col("turns.role"), F.col("turns.text")))
    return made.select("c", "leaf", "rank", F.size("turns").cast("long").alias("n_turns"), "m.formatted", "m.loss_spans")


def turns_as_chain(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Nodes for ``format_trees`` from conversations without branches: each turn answers the one before it.

    Rows of equal turn follow each other by role and text; null turns come first.
    """
    order = Window.partitionBy("c").orderBy("turn", "role", "text")
    named = rows.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    n = F.row_number().over(order).cast("long")
    return named.withColumn("node", n).select(
        "c", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.coalesce(F.length("text"), F.lit(0)).cast("double").alias("score"))
