"""Chat formatting of reply trees.

Messages ``(tree_id, msg_id, parent_id, role, text, score)`` form trees.
Iterative self-joins double the step from a message to its ancestors (1, 2, 4,
... replies), which gives every message its depth and the sum of scores on its
path in a logarithmic number of rounds, however long a thread is. The leaves of
a tree are ranked by that sum (ties: the smaller msg_id), the best ``branches``
are chosen, and the same doubled steps list the messages on each chosen path,
root to leaf. Each path becomes one conversation:

    <|im_start|>role\\ntext<|im_end|>\\n        for each turn

Control strings inside texts are escaped reversibly: wherever ``<``, any number
of backslashes and ``|`` follow each other, one backslash is added; reading
takes one away, so no text can hold a marker. In roles, backslash and line feed
are written as two characters. The loss mask covers the texts of ``assistant``
turns as spans of code points.

Defined cases: null role or text is empty; null tree_id is a tree of its own;
a message whose parent is not in its tree is a root; equal rows, and rows that
repeat a (tree_id, msg_id), count once (the smallest by parent, role, text);
messages on a cycle have no root and are left out; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskgraph.llm.common import cut_lineage

START, END = "<|im_start|>", "<|im_end|>"
_RAISE, _LOWER = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _RAISE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _LOWER.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The conversation and its loss spans, flat: start, end, start, end, ..."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_role_out(role)}\n", escape(text)
        at += len(head)
        if role == "assistant":
            spans += [at, at + len(body)]
        at += len(body) + len(END) + 1
        parts.append(f"{head}{body}{END}\n")
    return "".join(parts), spans


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(_role_in(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Written tables of the step doubled: ``(t, m, anc, total)`` where
    ``anc`` is the ancestor 2^i replies up (absent rows: above the root) and
    ``total`` the scores of the 2^i messages from ``m`` on."""
    step = cut_lineage(nodes.select("t", "m", F.col("p").alias("anc"), F.col("score").alias("total")))
    steps, limit = [step], nodes.count()
    while 2 ** len(steps) <= 2 * limit and len(step.where("anc is not null").take(1)):
        up = step.select("t", F.col("m").alias("anc"), F.col("anc").alias("anc2"), F.col("total").alias("more"))
        # only messages that have such an ancestor are joined: fewer each round
        higher = step.where("anc is not null").join(up, ["t", "anc"]).select(
            "t", "m", F.col("anc2").alias("anc"), (F.col("total") + F.col("more")).alias("total"))
        step = cut_lineage(step.where("anc is null").unionByName(higher))
        steps.append(step)
    return steps


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``(tree_id, branch, pos, role, text)``: the messages of the best
    ``branches`` root-to-leaf paths of every tree, ``pos`` from 1 at the root.

    The joins are on (tree, message), of which a message has one, so they stay
    even when one tree holds a third of all rows; the rank of leaves keeps
    ``branches`` rows a tree in each task before it shuffles."""
    key = F.coalesce(F.concat(F.lit("="), F.col("tree_id").cast("string")), F.lit("null"))
    rows = (messages.select(key.alias("t"), "tree_id", F.col("msg_id").cast("string").alias("m"),
                            F.col("parent_id").cast("string").alias("p"), F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"),
                            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
            .groupBy("t", "m").agg(F.min(F.struct("p", "role", "text", "score", "tree_id")).alias("x")).select("t", "m", "x.*"))
    rows = cut_lineage(rows)
    known = rows.select("t", F.col("m").alias("p"), F.lit(True).alias("known"))
    nodes = cut_lineage(rows.select("t", "m", "p", "score").join(known, ["t", "p"], "left")
                        .select("t", "m", F.when(F.col("known"), F.col("p")).alias("p"), "score"))
    steps = _ancestors(nodes)
    total = steps[-1].where("anc is null")          # whole paths; cycles never end
    parents = nodes.select("t", F.col("p").alias("m")).where("m is not null").distinct()
    leaves = total.join(parents, ["t", "m"], "left_anti")
    best = Window.partitionBy("t").orderBy(F.desc("total"), F.length("m"), "m")
    path = cut_lineage(leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
                       .select("t", "branch", "m", F.lit(0).cast("long").alias("up")))
    for i, step in enumerate(steps):                # up: 0 .. 2^i - 1 becomes 0 .. 2^(i+1) - 1
        higher = (path.join(step.where("anc is not null").select("t", "m", "anc"), ["t", "m"])
                  .select("t", "branch", F.col("anc").alias("m"), (F.col("up") + 2 ** i).alias("up")))
        path = cut_lineage(path.unionByName(higher))
    return path.join(rows.select("t", "m", "tree_id", "role", "text"), ["t", "m"]).select(
        "t", "tree_id", "branch", (-F.col("up")).alias("pos"), "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of tree, branch and pos: one conversation at a time."""
    key, turns, out = None, [], []

    def close() -> None:
        if key is not None:
            text, spans = format_turns(turns)
            out.append((key[2], key[1], len(turns), text, spans))

    def table() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (tree_type, pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64())),
                                            strict=True)], ["tree_id", "branch", "n_turns", "formatted", "loss_spans"])

    tree_type = pa.string()
    for b in batches:
        tree_type = b.schema.field("tree_id").type
        for t, tree, branch, role, text in zip(*(b.column(c).to_pylist() for c in ("t", "tree_id", "branch", "role", "text")),
                                               strict=True):
            if key is None or key[:2] != (t, branch):
                close()
                key, turns = (t, branch, tree), []
            turns.append((role, text))
        if len(out) >= 500:
            yield table()
            out.clear()
    close()
    yield table()


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``(tree_id, branch, n_turns, formatted, loss_spans)``: one row per
    chosen path. A task holds one conversation at a time."""
    kind = messages.schema["tree_id"].dataType.simpleString()
    p = paths(messages, branches)
    return (p.repartition("t", "branch").sortWithinPartitions("t", "branch", "pos")
            .mapInArrow(_conversations, f"tree_id {kind}, branch int, n_turns long, formatted string, loss_spans array<long>"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
            whole, loss, chars, turns = hashlib.sha256(), hashlib.sha256(), 0, read_turns(text)
            for role, said in turns:
                whole.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for a, z in zip(spans[::2], spans[1::2], strict=True):
                said = unescape(text[a:z])
                chars += len(said)
                loss.update(said.encode("utf-8", "surrogatepass"))
            rows.append((len(turns), whole.hexdigest(), chars, loss.hexdigest(), len(text)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("tree_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its formatted text and spans."""
    kind = formatted.schema["tree_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                  "formatted_chars long")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` as trees without branches: each
    row replies to the one before it by turn (then role and text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(w)
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("n", n.cast("long"))
            .select(F.col("conv_id").alias("tree_id"), F.col("n").alias("msg_id"),
                    F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score")))
