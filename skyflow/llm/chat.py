"""Chat formatting: paths through reply trees, each written as one conversation with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.lineage import materialize
from ..operators.numbering import write_row_index
from .arrow import map_rows

BRANCHES = 1                  # paths that are formatted of each tree
PART_CHARS = 1 << 18          # a longer conversation is written in parts
LEARNED = "assistant"         # whose texts the loss mask covers

# The template: `<turn>`, the role, a line break, the text, `</turn>` and a line break. In roles and texts a backslash stands before each
# backslash and each `<`, so that no text holds a mark; a line break in a role is written as backslash and n.
OPEN, CLOSE = "<turn>", "</turn>\n"
_TURN = re.compile(r"<turn>([^\\\n]*(?:\\.[^\\\n]*)*)\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)
_MARKED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text) if "\\" in text else text


def format_turns(turns: list[tuple[str, str]], learned: str = LEARNED) -> tuple[str, list[int]]:
    """The formatted turns, and begin and end (in characters) of each stretch under the loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role).replace("\n", "\\n") + "\n", escape(text)
        if role == learned:
            mask += [at + len(head), at + len(head) + len(body)]
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation (or of a part of one)."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"not a turn at character {at}")
        role = _MARKED.sub(lambda m: "\n" if m[1] == "n" else m[1], found[1])
        turns.append((role, unescape(found[2])))
        at = found.end()
    return turns


def learned_texts(formatted: str, mask: list[int]) -> list[str]:
    """What the loss mask covers, as it was before formatting."""
    return [unescape(formatted[a:b]) for a, b in zip(mask[::2], mask[1::2])]


def _same(left: str, right: str, *names: str) -> Column:
    """Equal keys, missing ones too."""
    condition = F.lit(True)
    for pair in names:
        a, _, b = pair.partition("=")
        condition = condition & F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b or a}"))
    return condition


def reply_paths(links: DataFrame, branches: int = BRANCHES) -> DataFrame:
    """
    tree_id, branch (from 1), message_id, first (size of all that stands before it in its path) and size of every message on the `branches` best paths from a
    root to a leaf of each tree. `links`: one row (tree_id, message_id, parent_id, score, size) a message. Paths rank by the sum of their
    scores, ties by the leaf's id.

    Joins of the table with itself, each over twice the distance of the one before: first every message learns the sums of its path and its
    ancestors 1, 2, 4, ... steps up, then the chosen leaves' paths are filled in from those. A path of a million messages takes 20 rounds, and only messages
    that still have an ancestor at the round's distance take part. A root with many replies is a hot key on one side only, which Spark splits.

    A message whose parent is missing or not in the tree is a root; messages on or below a circle of replies have no root and are on no path.
    """
    open_ = materialize(links.select("tree_id", "message_id", F.col("parent_id").alias("up"), "score", F.col("size").alias("sum")), "replies")
    done, jumps = open_.filter("up IS NULL"), []
    open_ = open_.filter("up IS NOT NULL")
    left = open_.count()
    while left:
        above = done.unionByName(open_).select("tree_id", "message_id", F.col("up").alias("_up"), F.col("score").alias("_score"), F.col("sum").alias("_sum"), F.lit(True).alias("_there"))
        stepped = materialize(
            open_.alias("o").join(above.alias("a"), _same("o", "a", "tree_id", "up=message_id"), "left").select(
                "o.tree_id", "o.message_id", F.when(F.col("_there"), F.col("up")).alias("jump"), F.col("_up").alias("up"),
                (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"), (F.col("sum") + F.coalesce("_sum", F.lit(0))).alias("sum")), "replies")
        jumps.append(stepped.filter("jump IS NOT NULL").select("tree_id", "message_id", "jump"))
        done = done.unionByName(stepped.filter("up IS NULL").drop("jump"))
        open_ = stepped.filter("up IS NOT NULL").drop("jump")
        still = open_.count()
        if still == left:                                  # what is left goes round in circles
            break
        left = still
    parents = links.filter("parent_id IS NOT NULL").select("tree_id", F.col("parent_id").alias("message_id")).distinct()
    leaves = done.alias("d").join(parents.alias("p"), _same("d", "p", "tree_id", "message_id"), "left_anti")
    best = Window.partitionBy("tree_id").orderBy(F.desc("score"), F.col("message_id").asc_nulls_last())
    chosen = leaves.withColumn("branch", F.row_number().over(best)).filter(F.col("branch") <= branches)
    path = materialize(chosen.select("tree_id", "branch", "message_id"), "paths")
    for jump in jumps:
        more = path.alias("p").join(jump.alias("j"), _same("p", "j", "tree_id", "message_id")).select("p.tree_id", "p.branch", F.col("j.jump").alias("message_id"))
        path = path.unionByName(materialize(more, "paths"))
    ends = done.select("tree_id", "message_id", F.col("sum").alias("end")).alias("e")
    sizes = links.select("tree_id", "message_id", "size").alias("l")
    return path.alias("p").join(ends, _same("p", "e", "tree_id", "message_id")).join(sizes, _same("p", "l", "tree_id", "message_id")).select(
        "p.tree_id", "p.branch", "p.message_id", (F.col("end") - F.col("size")).alias("first"), "size")


_FORMATTED = "tree_id bigint, branch int, part bigint, text string, mask array<bigint>"
_FORMATTED_SCHEMA = pa.schema([("tree_id", pa.int64()), ("branch", pa.int32()), ("part", pa.int64()), ("text", pa.string()), ("mask", pa.list_(pa.int64()))])


def format_replies(messages: DataFrame, branches: int = BRANCHES, learned: str = LEARNED) -> DataFrame:
    """
    tree_id, branch, part, text and mask of the `branches` best paths of each reply tree in `messages` (tree_id, message_id, parent_id, role, text,
    score). The texts of a path's parts, in order, are one conversation in the module's template; nearly all have one part. mask:
    begin and end, in characters of the part's text, of each stretch that is learned, the texts of the role `learned`.

    Paths are found on narrow rows (`reply_paths`), and texts are joined with them once. Parts are cut where PART_CHARS characters of texts have gone before, so that no
    task gathers more than that and one text.

    Null texts and roles are empty, null scores 0. Rows of one tree and message_id (null too) stand side by side, with the least of their parents
    and the highest of their scores. Other columns are not read; an empty table gives an empty table.
    """
    said = messages.select(
        F.col("tree_id").cast("long").alias("tree_id"), F.col("message_id").cast("long").alias("message_id"), F.col("parent_id").cast("long").alias("parent_id"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0)).cast("double").alias("score"))
    size = (F.length("role") + F.length("text") + 1).cast("long")
    links = materialize(said.groupBy("tree_id", "message_id").agg(
        F.min("parent_id").alias("parent_id"), F.max("score").alias("score"), F.sum(size).alias("size"), F.count("*").alias("copies")), "messages")
    paths = reply_paths(links.drop("copies"), branches).alias("p").join(
        links.select("tree_id", "message_id", "copies").alias("l"), _same("p", "l", "tree_id", "message_id")).select("p.*", "copies")
    # rows of one message share its room; a message of many rows is spread over several parts
    share = F.pmod(F.monotonically_increasing_id(), F.col("copies")) * F.col("size") / F.col("copies")
    placed = said.select("tree_id", "message_id", "role", "text").alias("m").join(paths.alias("p"), _same("m", "p", "tree_id", "message_id")).select(
        "p.tree_id", "p.branch", (F.col("first") + F.floor(share)).alias("at"), "p.message_id", "m.role", "m.text")
    parts = placed.groupBy("tree_id", "branch", F.floor(F.col("at") / PART_CHARS).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "message_id", "role", "text"))).alias("turns"))

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = [format_turns([(t["role"], t["text"]) for t in turns], learned) for turns in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([t for t, _ in out], pa.string()), pa.array([m for _, m in out], pa.list_(pa.int64()))], schema=_FORMATTED_SCHEMA)

    return map_rows(parts, write, _FORMATTED)


def conversation_messages(rows: DataFrame) -> DataFrame:
    """
    `conversations` (conv_id, turn, role, text) as reply trees without branches: each row replies to the one before it by turn (null first), role,
    the first 64 characters of the text and its hash. Rows that are equal in all of these are one message. A long text scores more.

    Narrow rows are numbered over ranges of (conv_id, turn, ...), and joined with their neighbours by number, so a conversation with a large share of
    all rows is spread over tasks.
    """
    said = rows.select(
        F.col("conv_id").cast("long").alias("tree_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    said = said.withColumn("message_id", F.xxhash64(F.col("turn").isNull(), "turn", "role", F.lit("\n"), "text"))
    order = ["tree_id", "turn", "role", "head", "message_id"]
    narrow = said.withColumn("head", F.substring("text", 1, 64)).groupBy(*order).agg(F.count("*").alias("_n"))
    numbered = write_row_index(narrow.drop("_n"), [F.col(c) for c in order], "number")[0]
    numbered = materialize(numbered.select("tree_id", "message_id", "number"), "message-numbers")
    before = numbered.select((F.col("number") + 1).alias("number"), F.col("tree_id").alias("_tree"), F.col("message_id").alias("_message"))
    parents = numbered.join(before, "number").filter(F.col("tree_id").eqNullSafe(F.col("_tree"))).select("tree_id", "message_id", F.col("_message").alias("parent_id"))
    return said.alias("s").join(parents.alias("p"), _same("s", "p", "tree_id", "message_id"), "left").select(
        "s.tree_id", "s.message_id", "p.parent_id", "s.role", "s.text", F.length("s.text").cast("double").alias("score"))


def _read_back(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each conversation, in order, to its counts and digests; a part is read at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    current, out = None, []

    def begin(key: tuple) -> dict:
        return {"key": key, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0, "formatted": 0}

    def end(c: dict) -> dict:
        return {"conv_id": c["key"][0], "n_turns": c["n"], "turns_sha256": c["turns"].hexdigest(), "loss_chars": c["chars"], "loss_sha256": c["loss"].hexdigest(),
                "formatted_chars": c["formatted"]}

    for batch in rows:
        for tree, branch, text, mask in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or current["key"] != (tree, branch):
                if current is not None:
                    out.append(end(current))
                current = begin((tree, branch))
            turns = read_turns(text)
            current["turns"].update("".join(f"{role}\n{said}\n" for role, said in turns).encode("utf-8"))
            learned = "".join(learned_texts(text, mask))
            current["loss"].update(learned.encode("utf-8"))
            current["n"] += len(turns)
            current["chars"] += len(learned)
            current["formatted"] += len(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if current is not None:
        yield pa.RecordBatch.from_pylist([end(current)], schema)


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written, and read back."""
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    formatted = materialize(format_replies(conversation_messages(rows)), "chats")
    several = formatted.filter("part > 0").select("tree_id", "branch").distinct()
    split = formatted.alias("f").join(several.alias("s"), _same("f", "s", "tree_id", "branch"), "left_semi")
    whole = formatted.alias("f").join(several.alias("s"), _same("f", "s", "tree_id", "branch"), "left_anti")
    ordered = split.repartition("tree_id", "branch").sortWithinPartitions("tree_id", "branch", "part")
    columns = ["tree_id", "branch", "text", "mask"]
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_rows(whole.select(*columns), _read_back, schema).unionByName(map_rows(ordered.select(*columns), _read_back, schema))
