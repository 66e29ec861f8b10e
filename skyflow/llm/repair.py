"""Repair of damaged conversations: cheapest edits by a bidirectional shortest-path search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.lineage import materialize
from .arrow import map_rows

SPACES = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
PART_ROWS, PART_BYTES = 1024, 4 << 20       # a longer conversation is handled in parts

# What has been said so far: nothing, the system's words, a user's last, an assistant's last.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_SAYS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}       # where a user's or assistant's turn leads
_ROLE = {USER: "user", ASSISTANT: "assistant"}
GONE = "d"                                  # the code of a row that has to go; others: initial of the role or x, a capital if truncated


def row_code(role: str, text: str, seen: bool) -> str:
    """What the edit lattice has to know of a row."""
    words = text.rstrip(SPACES)
    if not words or seen:
        return GONE
    code = role[:1] if role[:1] in _SAYS else "x"
    return code if words[-1] in ".!?" else code.upper()


def _row_edges(code: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, state after it) of the edits that take a row."""
    yield DELETE, "D", state
    if code != GONE:
        more = TRUNCATED if code.isupper() else 0
        kept = _SAYS.get(code.lower(), {}).get(state)
        if kept is not None:
            yield more, "K", kept
        yield REROLE + more, "R", _NEXT[state]


@lru_cache(100_000)
def _edges_back(code: str) -> dict[int, list[tuple[int, str, int]]]:
    back: dict[int, list[tuple[int, str, int]]] = {state: [] for state in range(4)}
    for state in range(4):
        for cost, letter, after in _row_edges(code, state):
            back[after].append((cost, letter, state))
    return back


@lru_cache(100_000)
def cheapest_edits(codes: str, begin: int = START, ends: tuple[int, ...] = _ENDS) -> tuple[int, str] | None:
    """
    (cost, audit) of the cheapest way from `begin` to one of `ends` through the rows with these codes; of equal costs the least audit in
    ASCII order. None if there is no way.

    The lattice's nodes are (rows taken, state). One search runs forward from the begin and one back from the ends, each settling its
    nodes by (cost, place, audit): edits of no cost move on by a row, so that a node is settled with its least audit. Where an edge joins
    nodes that both searches have settled they meet. The searches go on until their costs together exceed the best meeting, so
    that all crossings of equal cost are found; the least concatenated audit among them is taken.
    """
    n = len(codes)
    ahead: list[tuple[int, int, str, int]] = [(0, 0, "", begin)]
    behind: list[tuple[int, int, str, int]] = [(0, 0, "", end) for end in ends]
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    leads: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = (0, "") if n == 0 and begin in ends else None
    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best[0]):
        if ahead[0][0] <= behind[0][0]:
            cost, i, audit, state = heappop(ahead)
            if (i, state) in reached:
                continue
            reached[i, state] = cost, audit
            steps = [(INSERT, "I", i, _NEXT[state])]
            if i < n:
                steps += [(c, letter, i + 1, s) for c, letter, s in _row_edges(codes[i], state)]
            for c, letter, j, s in steps:
                heappush(ahead, (cost + c, j, audit + letter, s))
                rest = leads.get((j, s))
                if rest is not None:
                    whole = cost + c + rest[0], audit + letter + rest[1]
                    best = whole if best is None else min(best, whole)
        else:
            cost, back, audit, state = heappop(behind)
            i = n - back
            if (i, state) in leads:
                continue
            leads[i, state] = cost, audit
            steps = [(INSERT, "I", i, s) for s in range(4) if _NEXT[s] == state]
            if i:
                steps += [(c, letter, i - 1, s) for c, letter, s in _edges_back(codes[i - 1])[state]]
            for c, letter, j, s in steps:
                heappush(behind, (cost + c, n - j, letter + audit, s))
                rest = reached.get((j, s))
                if rest is not None:
                    whole = cost + c + rest[0], rest[1] + letter + audit
                    best = whole if best is None else min(best, whole)
    return best


Table = list[list[tuple[int, str] | None]]


def _joined(first: Table, second: Table) -> Table:
    """Cheapest edits from each state to each through two stretches of rows, one after the other."""
    out: Table = [[None] * 4 for _ in range(4)]
    for begin in range(4):
        for end in range(4):
            ways = [(a[0] + b[0], a[1] + b[1]) for a, b in ((first[begin][s], second[s][end]) for s in range(4)) if a and b]
            out[begin][end] = min(ways, default=None)
    return out


def _shares(audit: str, codes: list[str]) -> list[tuple[int, str]]:
    """(state at its begin, its letters) for each part of a conversation; insertions go to the row before which they stand."""
    state, at, out = START, 0, []
    for number, part in enumerate(codes):
        begin, first, rows = state, at, 0
        while at < len(audit) and (rows < len(part) or number == len(codes) - 1):
            letter = audit[at]
            if letter == "K":
                state = _SAYS[part[rows].lower()][state]
            elif letter != "D":
                state = _NEXT[state]
            rows, at = rows + (letter != "I"), at + 1
        out.append((begin, audit[first:at]))
    return out


def _edited(roles: list[str], texts: list[str], audit: str, state: int = START) -> tuple[list[str], list[str]]:
    """The turns that are left."""
    new_roles, new_texts, row = [], [], 0
    for letter in audit:
        if letter == "K":
            state = _SAYS[roles[row][:1]][state]
            new_roles.append(roles[row])
        elif letter != "D":
            state = _NEXT[state]
            new_roles.append(_ROLE[state])
        if letter != "D":
            new_texts.append("" if letter == "I" else texts[row])
        row += letter != "I"
    return new_roles, new_texts


@dataclass
class _Part:
    """Neighbouring rows of one conversation, and what its report needs of them."""

    turns: list[int | None] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    size: int = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn), self.roles.append(role), self.texts.append(text)
        self.size += len(text)

    def report(self, first: list[bool]) -> tuple[str, dict]:
        codes = "".join(row_code(r, t, not f) for r, t, f in zip(self.roles, self.texts, first))
        blank = sum(not t.strip(SPACES) for t in self.texts)
        known = [t for t in self.turns if t is not None]
        pairs = (a[:1] + b[:1] for a, b in zip(self.roles, self.roles[1:]))
        return codes, {
            "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
            "blank": blank, "duplicate": codes.count(GONE) - blank, "truncated": sum(c.isupper() for c in codes),
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs)}


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PART = f"conv_id bigint, part bigint, whole boolean, turns array<bigint>, roles array<string>, texts array<string>, {_REPORT}"


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_REPORT_FIELDS = [*((c, pa.int64()) for c in ("gaps", *_COUNTS, "cost")), ("audit", pa.string())]
_PART_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())), *_REPORT_FIELDS])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to parts. Conversations that lie wholly in this partition and in one part are repaired at once."""
    number, out, size = TaskContext.get().partitionId() << 32, [], 0
    current, part, alone = None, _Part(), False          # the first conversation may have begun in the partition before

    def close(whole: bool) -> None:
        nonlocal number, part, size
        row = {"conv_id": current[0], "part": number, "whole": whole}
        if whole:
            seen, first = set(), []
            for key in zip(part.roles, part.texts):
                first.append(key not in seen)
                seen.add(key)
            codes, counts = part.report(first)
            cost, audit = cheapest_edits(codes)
            roles, texts = _edited(part.roles, part.texts, audit)
            row |= {"roles": roles, "texts": texts, "cost": cost, "audit": audit,
                    "gaps": _gaps(counts["low"], counts["high"], counts["turns"])} | {c: counts[c] for c in _COUNTS}
        else:
            row |= {"turns": part.turns, "roles": part.roles, "texts": part.texts}
        out.append(row)
        number, size, part = number + 1, size + part.size, _Part()

    for batch in batches:
        for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if current is not None and current[0] != conv:
                close(alone)
                alone = True
            elif part.turns and (len(part.turns) >= PART_ROWS or part.size >= PART_BYTES):
                close(False)
                alone = False
            current = (conv,)
            part.add(turn, role, text)
            if size >= PART_BYTES or len(out) >= 2000:
                yield _arrow(out, _PART_SCHEMA)
                out, size = [], 0
    if current is not None:
        close(False)                                     # it may go on in the next partition
        yield _arrow(out, _PART_SCHEMA)


_TABLE_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("codes", pa.string()), ("first", pa.string()), ("last", pa.string()), ("first_turn", pa.int64()),
    ("last_turn", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_TABLE = ("conv_id bigint, part bigint, codes string, first string, last string, first_turn bigint, last_turn bigint, low bigint, high bigint, turns bigint, "
          "blank bigint, duplicate bigint, truncated bigint, illegal bigint, costs array<bigint>, audits array<string>")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part the cheapest edits between all states."""
    for batch in batches:
        for conv, number, turns, roles, texts, firsts in zip(*(c.to_pylist() for c in batch.columns)):
            first = [False] * len(roles)
            for at in firsts or ():
                first[at] = True
            codes, counts = _Part(turns, roles, texts).report(first)
            ways = [cheapest_edits(codes, begin, (end,)) for begin in range(4) for end in range(4)]
            yield _arrow([{
                "conv_id": conv, "part": number, "codes": codes, "first": roles[0][:1], "last": roles[-1][:1], "first_turn": turns[0], "last_turn": turns[-1],
                "costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]} | counts], _TABLE_SCHEMA)


_SOLVED_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("state", pa.int64()), ("letters", pa.string()), *_REPORT_FIELDS])
_SOLVED = f"conv_id bigint, part bigint, state bigint, letters string, {_REPORT}"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each conversation, in order, to the share that each has in the cheapest edits; its first part carries the report."""
    def close(rows: list[dict]) -> pa.RecordBatch:
        tables: list[Table] = [
            [[None if r["audits"][4 * s + e] is None else (r["costs"][4 * s + e], r["audits"][4 * s + e]) for e in range(4)] for s in range(4)] for r in rows]
        while len(tables) > 1:                           # neighbours first, so that no audit is copied often
            tables = [_joined(*pair) if len(pair) == 2 else pair[0] for pair in (tables[i:i + 2] for i in range(0, len(tables), 2))]
        cost, audit = min(tables[0][START][end] for end in _ENDS if tables[0][START][end])
        known = [r for r in rows if r["low"] is not None]
        turns = sum(r["turns"] for r in rows) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:]))
        report = {c: sum(r[c] for r in rows) for c in _COUNTS}
        report["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        report |= {"gaps": _gaps(min((r["low"] for r in known), default=None), max((r["high"] for r in known), default=None), turns), "cost": cost, "audit": audit}
        out = [{"conv_id": r["conv_id"], "part": r["part"], "state": state, "letters": letters}
               for r, (state, letters) in zip(rows, _shares(audit, [r["codes"] for r in rows]))]
        out[0] |= report
        return _arrow(out, _SOLVED_SCHEMA)

    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and rows[0]["conv_id"] != row["conv_id"]:
                yield close(rows)
                rows = []
            rows.append(row)
    if rows:
        yield close(rows)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "part", "roles", "texts", "state", "letters", "gaps", *_COUNTS, "cost", "audit"]
    for batch in batches:
        out = []
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            row = dict(zip(names, values))
            row["roles"], row["texts"] = _edited(row["roles"], row["texts"], row.pop("letters"), row.pop("state"))
            out.append(row | {"whole": False})
        yield _arrow(out, _PART_SCHEMA)


def repair_conversations(
    rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """
    (report, turns). `report`: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation in `rows`. `turns`:
    the repaired conversations, as rows (conv_id, part, whole, roles, texts); nearly all are `whole`, one row each, and a
    longer one is the rows of its parts in order.

    Rows go by turn (null first), role, the first 64 characters of the text and its hash. They are dealt and sorted by ranges of that order,
    so that a conversation with a large share of all rows lies in many partitions. A conversation within one partition and one part is
    repaired where it is read. Of the others (at the edges of partitions, or long) each part gets the cheapest edits from
    every state to every state; these tables, one row for a part, are joined from left to right, and each part then applies its share.
    What one task holds of a conversation are its tables: 16 audits, each with about a letter a row, no texts.

    Null roles and texts count as one space, null conv_ids are one conversation, null turns come first and no gap counts them. Repeated rows are
    duplicates of the first. An empty role has no initial and cannot stay as it is. Empty texts are blank. Other columns are not read; an empty table gives empty tables.
    """
    text = F.coalesce(text_column, F.lit(" "))
    given = rows.select(
        F.col(conv_column).cast("long").alias("conv_id"), F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(role_column, F.lit(" ")).alias("role"), text.alias("text"))
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    dealt = given.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    parts = materialize(map_rows(dealt, _cut, _PART), "conversation-parts")
    split = parts.filter("NOT whole").select("conv_id", "part", "turns", "roles", "texts")
    # the first of equal rows
    each = split.select("conv_id", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")).select(
        "conv_id", "row.roles", F.sha2("row.texts", 256).alias("digest"), F.struct("part", "at").alias("place"))
    firsts = each.groupBy("conv_id", "roles", "digest").agg(F.min("place").alias("place")).groupBy("place.part").agg(
        F.collect_list("place.at").alias("firsts"))                                     # at most PART_ROWS
    tables = map_rows(split.join(firsts, "part", "left").select("conv_id", "part", "turns", "roles", "texts", "firsts"), _tables, _TABLE)
    solved = materialize(map_rows(tables.repartition("conv_id").sortWithinPartitions("conv_id", "part"), _solve, _SOLVED), "conversation-edits")
    shares = split.drop("turns", "conv_id").join(solved, "part")
    mended = materialize(
        map_rows(shares.select("conv_id", "part", "roles", "texts", "state", "letters", "gaps", *_COUNTS, "cost", "audit"), _apply, _PART), "conversation-mended")
    everything = parts.filter("whole").unionByName(mended)
    report = everything.filter("audit IS NOT NULL").select("conv_id", "gaps", *_COUNTS, "cost", "audit")
    return report, everything.select("conv_id", "part", "whole", "roles", "texts")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations as a crc32 of `conv_id:turn` damages them: rows lost, emptied, without ends of sentences, doubled or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).when(kind != 0, F.array(F.lit(0)))).alias("copy")).drop("copy")


def _lines() -> Column:
    return F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda m: F.concat(m["roles"], F.lit(":"), m["texts"])), "\n")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order to one digest for each conversation; a part is read at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])
    current, digest, begun = None, None, False
    for batch in batches:
        for conv, lines in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None or current != conv:
                if digest is not None:
                    yield _arrow([{"conv_id": current, "sha256": digest.hexdigest()}], schema)
                current, digest, begun = conv, hashlib.sha256(), False
            if lines is not None:
                digest.update((("\n" if begun else "") + lines).encode("utf-8"))
                begun = True
    if digest is not None:
        yield _arrow([{"conv_id": current, "sha256": digest.hexdigest()}], schema)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: its faults, the cheapest edits and a digest of what they leave."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report, turns = repair_conversations(damaged(rows))
    whole = turns.filter("whole").select("conv_id", F.sha2(_lines(), 256).alias("sha256"))
    split = turns.filter("NOT whole").select("conv_id", "part", F.when(F.size("roles") > 0, _lines()).alias("lines"))
    ordered = split.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "lines")
    digests = whole.unionByName(map_rows(ordered, _digests, "conv_id bigint, sha256 string"))
    found = report.alias("r").join(digests.alias("d"), F.col("r.conv_id").eqNullSafe(F.col("d.conv_id"))).select("r.*", "d.sha256")
    every = rows.select("conv_id").distinct().alias("e")
    zero = [F.coalesce(f"f.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return every.join(found.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left").select(
        "e.conv_id", *zero, F.coalesce("f.audit", F.lit("")).alias("audit"), F.coalesce("f.sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
