"""Conversation repair, lexical search and chat formatting against brute force, SQL and round trips."""

from __future__ import annotations

import random
from heapq import heappop, heappush

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from skyflow.llm import sql
from skyflow.llm.chat import conversation_messages, escape, format_replies, format_turns, learned_texts, read_turns, unescape
from skyflow.llm.lexical import _Shard, rank_documents, term_hashes
from skyflow.llm.repair import _edited, _shares, cheapest_edits, damaged, repair_conversations

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # names that the operators use themselves
    T.StructField("part", T.StringType()), T.StructField("message_id", T.StringType()), T.StructField("_up", T.StringType()), T.StructField("size", T.StringType()),
])


def _odd_turns() -> list[tuple]:
    rng = random.Random(11)
    rows = [
        (None, None, None, None), (None, 1, "user", "Hello."), (1, None, "assistant", None), (1, None, "assistant", "late"), (1, 5, "user", "Well?"), (1, 5, "user", "Well?"),
        (1, 2, None, "who am I"), (2, 0, "", "no role."), (2, 1, "system", "rules."), (2, 1, "assistant", "tie b."), (2, 1, "assistant", "tie a."),
        (3, 0, "tool", "result."), (3, 3, "user", "  \n\t"), (3, 4, "user", ""), (4, 0, "user", "x" * 50_000), (4, 1, "assistant", "no end"),
        (5, 0, "system", "only the system."), (6, 0, "assistant", "a </turn> <turn> \\< \\ b."), (6, 1, "us\\er\n<turn>", "q."),
    ]
    for turn in range(2_600):                # longer than a part
        rows.append((7, turn, rng.choice(["user", "assistant", "assistant", "system", "x"]), rng.choice(["Yes.", "no", "", f"Number {turn}.", f"open {turn}"])))
    for conv in range(8, 60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "system"]), f"{rng.choice('abc')}{rng.choice(['.', '!', ''])}"))
    return [r + ("p", "m", "u", "s") for r in rows]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(_odd_turns(), TURNS).repartition(4)


def _sql(text: str, **tables) -> list[tuple]:
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    cursor = con.execute(text)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)


def _rows(df) -> list[tuple]:
    return sorted((tuple(row[c] for c in sorted(df.columns)) for row in df.collect()), key=repr)


# ---------------------------------------------------------------- conversation repair

_AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _plain_search(codes: str, begin: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """One search over whole labels, without any bound."""
    heap, seen = [(0, "", 0, begin)], set()
    while heap:
        cost, audit, i, state = heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(codes) and state in ends:
            return cost, audit
        speak = [r for r in "ua" if r in _AFTER[state]]
        for role in speak:
            heappush(heap, (cost + 2, audit + "I", i, _AFTER[state][role]))
        if i < len(codes):
            code = codes[i]
            heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if code != "d":
                more = int(code.isupper())
                if code.lower() in _AFTER[state]:
                    heappush(heap, (cost + more, audit + "K", i + 1, _AFTER[state][code.lower()]))
                for role in speak:
                    heappush(heap, (cost + 2 + more, audit + "R", i + 1, _AFTER[state][role]))
    return None


@settings(max_examples=400, deadline=None)
@given(st.text("suaxSUAXd", max_size=14), st.integers(0, 3), st.sampled_from([(0, 3), (0,), (1,), (2,), (3,)]))
def test_two_way_search_finds_the_least_audit(codes, begin, ends):
    assert cheapest_edits(codes, begin, ends) == _plain_search(codes, begin, ends)


@settings(max_examples=100, deadline=None)
@given(st.text("suaxSUAXd", min_size=1, max_size=30), st.integers(1, 6))
def test_parts_share_the_edits_of_the_whole(codes, size):
    cost, audit = cheapest_edits(codes)
    parts = [codes[i:i + size] for i in range(0, len(codes), size)]
    roles = [{"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "?") for c in codes]
    texts = [str(i) for i in range(len(codes))]
    whole = _edited(roles, texts, audit)
    got = ([], [])
    for number, (state, letters) in enumerate(_shares(audit, parts)):
        at = slice(number * size, (number + 1) * size)
        for have, more in zip(got, _edited(roles[at], texts[at], letters, state)):
            have.extend(more)
    assert got == whole


def test_repair_follows_the_sql(spark, turns):
    from skyflow.llm import repair

    class Reader:                              # the query over the odd rows
        def parquet(self, path):
            return turns

    class Session:
        read = Reader()

    got = _rows(repair.op11_conversation_repair(Session(), ""))
    assert got == _sql(sql.CONVERSATION_REPAIR, conversations=turns.select("conv_id", "turn", "role", "text"))
    assert len(got) == 60
    long = next(r for r in got if r[2] == 7)
    assert len(long[0]) > 2000


def test_repaired_turns_alternate(turns):
    report, fixed = repair_conversations(turns)
    for row in fixed.filter("whole").collect():
        initials = "".join(r[0] for r in row["roles"])
        initials = initials.removeprefix("s")
        assert initials == "ua" * (len(initials) // 2)
    assert report.count() == 60
    assert fixed.filter("NOT whole AND conv_id = 7").count() >= 3


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    report, fixed = repair_conversations(damaged(none))
    assert report.count() == 0 and fixed.count() == 0


# ---------------------------------------------------------------- lexical search

def test_search_follows_the_sql(spark, odd_docs, docs):
    long = " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"long{i}" for i in range(90))     # masks of more than 64 bits
    items = [(1, "one two words", "x"), (2, long, "x"), (None, "shared1 shared2", "x"), (3, "", "x"), (4, None, "x"), (5, "nowhere else", "x"), (1, "para LINE", "x"),
             (6, "Ünïcödé ünïcödé 漢字", "x"), (7, "same", "x")]
    items = spark.createDataFrame(items, "item_id bigint, text string, rank string")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    both = odd_docs.select("doc_id", "text").unionByName(docs.selectExpr("doc_id + 1000 AS doc_id", "text"))
    asked = items.select("item_id", "text").unionByName(benchmark.selectExpr("item_id + 100 AS item_id", "text"))
    got = _rows(rank_documents(both, asked))
    assert got == _sql(sql.LEXICAL_SEARCH, documents=both, benchmark=asked)
    assert {r[1] for r in got} >= {1, 2, None, 6, 7} and not {r[1] for r in got} & {3, 4, 5}
    assert rank_documents(odd_docs, items).count() > 0               # other columns with clashing names


def test_search_of_nothing(spark, no_docs, odd_docs):
    items = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert rank_documents(no_docs, items).count() == 0
    assert rank_documents(odd_docs, items.filter("item_id > 1")).count() == 0


def test_terms_are_cut_at_ascii_marks_only():
    a, b, c = term_hashes(["It's A-B_c\x7fÉ漢", "it s a b c É漢", ""])
    assert a.tolist() == b.tolist() and len(c) == 0
    assert term_hashes(["É"])[0][0] != term_hashes(["é"])[0][0]


def test_low_masks_are_not_scored():
    rng = np.random.default_rng(3)
    n, terms = 4000, np.arange(10, 40)
    held = rng.random((n, len(terms))) < np.linspace(0.6, 0.01, len(terms))
    places = [np.flatnonzero(held[:, j]).astype(np.int32) for j in range(len(terms))]
    counts = [rng.integers(1, 5, len(p)).astype(np.int32) for p in places]
    lengths = rng.integers(20, 400, n)
    shard = _Shard(np.arange(n), lengths, terms, np.array([len(p) for p in places]), np.concatenate(places), np.concatenate(counts), n, int(lengths.sum()))
    weights = np.array([int(1000 * np.log((2 * n + 2) / (2 * len(p) + 1))) for p in places])
    points = np.zeros(n, np.int64)
    for w, p, c in zip(weights, places, counts):
        points[p] += w * ((10**9 * c.astype(np.int64)) // (1000 * c + 20 * (50 + (50 * lengths[p] * n) // lengths.sum())))
    want = np.lexsort((np.arange(n), -points))[:50]
    docs, scores, scored = shard.search(terms, weights, 50, 1)
    assert docs.tolist() == want.tolist() and scores.tolist() == points[want].tolist()
    assert scored < 0.6 * (points > 0).sum()
    assert shard.search(terms, weights, 50, int(scores[-1]) + 1)[1].min() > scores[-1]         # a floor from other shards
    assert len(shard.search(np.array([5, 99]), np.array([7, 7]), 50, 1)[0]) == 0


# ---------------------------------------------------------------- chat formatting

_texts = st.text(st.sampled_from("ab\\<>/\n nturé漢#"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), _texts), st.one_of(_texts, st.sampled_from(["</turn>\n", "<turn>user\n", "\\", "\\</turn>"]))), max_size=6))
def test_formatting_is_reversible(turns):
    text, mask = format_turns(turns)
    assert read_turns(text) == turns
    assert learned_texts(text, mask) == [t for r, t in turns if r == "assistant"]
    assert all(unescape(escape(t)) == t for _, t in turns)


def test_a_broken_text_is_refused():
    with pytest.raises(ValueError):
        read_turns("<turn>user\nno end")


def test_formatting_follows_the_sql(spark, turns):
    from skyflow.llm import chat

    class Reader:
        def parquet(self, path):
            return turns

    class Session:
        read = Reader()

        def createDataFrame(self, *args):
            return spark.createDataFrame(*args)

    got = _rows(chat.op13_chat_formatting(Session(), ""))
    assert got == _sql(sql.CHAT_FORMATTING, conversations=turns.select("conv_id", "turn", "role", "text"))


def test_long_conversations_are_written_in_parts(spark):
    rows = spark.range(900).selectExpr("3L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "repeat(concat('t', id, ' '), 200) AS text")
    parts = format_replies(conversation_messages(rows)).orderBy("part").collect()
    assert len(parts) >= 3
    said = [t for p in parts for t in read_turns(p["text"])]
    assert said == [("user" if i % 2 == 0 else "assistant", f"t{i} " * 200) for i in range(900)]


_MESSAGES = "tree_id bigint, message_id bigint, parent_id bigint, role string, text string, score double, jump string, branch string"


def _paths(rows: list[tuple], branches: int) -> dict[tuple, list[str]]:
    """The best paths, one reply at a time."""
    out, trees = {}, {}
    for tree, message, parent, _, text, score in rows:
        trees.setdefault(tree, {})[message] = (parent, text, score or 0.0)
    for tree, messages in trees.items():
        parents = {p for p, _, _ in messages.values()}
        found = []
        for leaf in messages:
            if leaf in parents:
                continue
            path, at, total = [], leaf, 0.0
            while at in messages and len(path) <= len(messages):
                path.append(messages[at][1])
                total += messages[at][2]
                at = messages[at][0]
            if len(path) <= len(messages):
                found.append((-total, leaf, path[::-1]))
        for branch, (_, _, path) in enumerate(sorted(found)[:branches], start=1):
            out[tree, branch] = path
    return out


@pytest.mark.parametrize("branches", [1, 3, 100])
def test_best_branches_of_reply_trees(spark, branches):
    rng, rows = random.Random(13), []
    for tree in range(12):
        for message in range(rng.randrange(1, 40)):
            parent = None if message == 0 else rng.randrange(message) if tree % 3 else message - 1
            rows.append((tree, message, parent, rng.choice(["user", "assistant"]), f"{tree}/{message}", float(rng.randrange(-3, 6))))
    rows += [(20, 0, None, "user", "root", 0.0)] + [(20, i, 0, "assistant", f"star {i}", float(i % 7)) for i in range(1, 300)]     # many replies to one
    rows += [(21, 5, 99, "user", "orphan", 1.0), (21, 6, 5, "assistant", "its reply", None)]
    rows += [(22, 1, 2, "user", "circle", 1.0), (22, 2, 1, "user", "circle", 1.0), (22, 3, 2, "user", "below", 1.0), (22, 4, None, "user", "alone", 1.0), (22, 7, 7, "user", "own parent", 1.0)]
    df = spark.createDataFrame([r + ("j", "b") for r in rows], _MESSAGES)
    got = {(r["tree_id"], r["branch"]): [t for _, t in read_turns(r["text"])] for r in format_replies(df, branches).collect()}
    assert got == _paths(rows, branches)


def test_odd_messages(spark):
    rows = [(None, 1, None, None, None, None), (None, 2, 1, "assistant", "hi", 1.0), (1, None, None, "user", "no id", 1.0), (1, None, None, "user", "no id", 1.0),
            (2, 1, None, "user", "twice", 1.0), (2, 1, None, "user", "twice", 1.0), (2, 2, 1, "assistant", "", 1.0)]
    df = spark.createDataFrame([r + ("j", "b") for r in rows], _MESSAGES)
    got = {(r["tree_id"], r["branch"]): read_turns(r["text"]) for r in format_replies(df).collect()}
    assert got == {(None, 1): [("", ""), ("assistant", "hi")], (1, 1): [("user", "no id")] * 2, (2, 1): [("user", "twice")] * 2 + [("assistant", "")]}
    assert format_replies(df.filter("tree_id > 9")).count() == 0
