"""Conversation repair against a search over whole strings, the linked edits, chunks and odd tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadloom.llm import conversation_repair as cr

from .conftest import key

TYPES = "conv_id long, turn long, role string, text string"


def damage(rows):
    """(conv_id, turn, role, text) rows after damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, edits, lines) by whole strings: rows are (role, text, must go, cut off)."""
    best = {"": (0, "", ())}  # by the roles' pattern so far: "", s, u, a

    def offer(to, state, cost, edits, lines):
        if state not in to or (cost, edits) < to[state][:2]:
            to[state] = (cost, edits, lines)

    def inserted(states):
        for _ in range(3):
            for state, (cost, edits, lines) in list(states.items()):
                role = "assistant" if state == "u" else "user"
                offer(states, role[0], cost + 5, edits + "I", (*lines, f"{role}:"))
        return states

    for role, text, gone, cut in rows:
        after = {}
        for state, (cost, edits, lines) in inserted(best).items():
            offer(after, state, cost + 2, edits + "D", lines)
            if gone:
                continue
            following = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if role[:1] and role[:1] in following:
                offer(after, role[:1], cost + 5 * cut, edits + "K", (*lines, f"{role}:{text}"))
            name = "assistant" if state == "u" else "user"
            offer(after, name[0], cost + 5 * cut + 1, edits + "R", (*lines, f"{name}:{text}"))
        best = after
    best = inserted(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]]
    for row in damage(rows):
        groups[row[0]].append(row[1:])
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, seen, judged = [0, 0, 0], set(), []
        for _, role, text in own:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(own))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, edits, lines = cheapest(judged)
        out.append((conv, gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def repaired(df, **kw):
    return key(tuple(r) for r in cr.repair(df, **kw).select(*cr.RESULT).collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.booleans(), st.booleans()), max_size=24), st.integers(1, 9))
def test_chunks_give_the_cheapest_and_least_edits(rows, size):
    """Whatever rows a chunk ends at."""
    rows = [(i, gone, cut and not gone) for i, gone, cut in rows]
    chunks = [rows[k : k + size] for k in range(0, len(rows), size)]
    cost, path = cr.chained([*map(cr.transfers, chunks), cr.CLOSING])
    assert (cost, "".join(e for _, e in path)) == cheapest([(i, "", gone, cut) for i, gone, cut in rows])[:2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("DIKR", max_size=40), min_size=2, max_size=6), st.booleans())
def test_linked_edits_compare_as_strings(strings, collide):
    """Prefixes are shared or not, and equal hashes prove nothing."""
    edits, nodes = cr.Edits(), []
    for text in strings:
        node = 0
        for letter in text:
            node = edits.add(node, letter)
        nodes.append(node)
        shared = edits.climb(node, len(text) // 2)
        nodes.append(edits.add(shared, "K"))
    if collide:
        edits.hash = [0] * len(edits.hash)
    for a in nodes:
        for b in nodes:
            assert edits.less(a, b) == (edits.text(a) < edits.text(b))


def test_table(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = brute([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    assert repaired(conversations) == key(want)


def some_rows(n, convs, seed):
    r = random.Random(seed)
    texts = ["Yes.", "No", "What now?", " ", "", "ok!", "Well", "é.", "Yes. ", "a\x1c", "x" * 3000 + "."]
    return [(r.choice(convs), r.choice([None, *range(12), 40]), r.choice(["user", "assistant", "system", "tool", "", None]), r.choice([*texts, None])) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_long_conversations_lie_across_tasks(spark, chunk):
    """A conversation with most rows, repeated texts, ties, nulls: cut by range into tasks and there into chunks."""
    rows = some_rows(400, [7, 7, 7, 7, 1, 2, None], 5) + [(7, t, ("user", "assistant")[t % 2], f"text {t % 90}.") for t in range(12, 400)]
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "9")
        spark.conf.set(names[1], "false")
        assert repaired(spark.createDataFrame(rows, TYPES).repartition(5), chunk_rows=chunk) == key(brute(rows))
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@pytest.mark.parametrize("frequent", [2, 1 << 15])
def test_repeats_by_broadcast_and_by_shuffle(spark, monkeypatch, frequent):
    monkeypatch.setattr(cr, "FREQUENT", frequent)
    rows = some_rows(300, list(range(20)), 9) + [(3, t, "user", "again.") for t in range(60)]
    assert repaired(spark.createDataFrame(rows, TYPES)) == key(brute(rows))


def test_odd_tables(spark):
    """No rows, all rows dropped, one row repeated often, clashing columns."""
    none = spark.createDataFrame([], TYPES)
    assert cr.repair(none).collect() == [] and cr.repair(none).columns == list(cr.RESULT)
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hello."), (5, 1, "user", "same."), *[(5, 2, "assistant", "same.")] * 50, (None, None, None, None), (6, None, "system", "s."), (6, None, "user", "u.")]
    df = spark.createDataFrame(rows, TYPES)
    for name in ("kind", "gone", "same", "copy", "repeat", "part", "chunk", "audit", "cost", "first", "known", "n", "done"):
        df = df.withColumn(name, F.lit("clash"))
    got = repaired(df)
    assert got == key(brute(rows)) and (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
