import hashlib
import random
import zlib

import pytest

from placeweave.llm import prefix_trie as pt


def in_order(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        if c is not None:
            out.setdefault(c, []).append((role or "", text or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def expected(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below.get(node, [])) or 1
        saved[node] = sum(saved[x] for x in below.get(node, [])) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        rows.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(below.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=lambda r: r[:2])


def some_rows(seed, n=260):
    random.seed(seed)
    rows = []
    for c in random.sample(range(-50, 420), n):
        for t in range(random.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, random.choice([t, t, t, t + 3, None]), random.choice(["user", "user", "assistant", None, ""]), random.choice(["a", "b", "ab", "é𝄞", "", None])))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1090) for t in range(4)]
    rows += [(5, t, "user", "on and on") for t in range(700)] + [(None, 0, "user", "a"), (None, None, None, None)]
    rows += [(6, 0, "user", "word " * 200_000)]
    return rows + rows[: n // 8]


def table(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, part string")


@pytest.mark.parametrize("seed,bounds,spread", [(1, {}, False), (2, {"least": 5, "share": 100}, True), (3, {"least": 1, "share": 10**9, "held": 7}, True), (4, {"least": 40, "held": 1}, True)])
def test_equals_brute_force(spark, seed, bounds, spread):
    rows = some_rows(seed)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not spread).lower())  # conversations that lie in several partitions
    try:
        convs = in_order(rows)
        got = sorted(map(tuple, pt.conversation_trie(table(spark, rows), **bounds).collect()), key=lambda r: r[:2])
        assert got == expected(convs)
        got = sorted(map(tuple, pt.rebuilt_trie(table(spark, rows), **bounds).collect()), key=lambda r: r[:2])
        assert got == expected(rebuilt(convs))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_conversations_left_without_turns(spark):
    short = [c for c in range(1, 40) if zlib.crc32(str(c).encode()) % 6 > 1][:5]
    rows = [(c, 0, "user", "only") for c in short]
    got = list(map(tuple, pt.rebuilt_trie(table(spark, rows)).collect()))
    assert got == [(min(short), 0, None, 5, 0, 1, 0, hashlib.sha256(",".join(map(str, short)).encode()).hexdigest())]


def test_empty(spark):
    assert pt.rebuilt_trie(table(spark, [])).count() == 0
    assert pt.rebuilt_trie(table(spark, [(None, 1, "user", "a")])).count() == 0


@pytest.mark.parametrize("held,runs", [(1000, 4), (5, 2), (1, 3)])
def test_queue_in_order(held, runs):
    random.seed(held)
    queue, left = pt.SpillingQueue(held, runs), []
    for step in range(-50, 0):
        for _ in range(random.randint(0, 30)):
            m = (random.randint(step, 0), random.randint(-3, 3), 0, 0, random.randint(0, 9), 1)
            queue.push(m)
            left.append(m)
        key = (step, random.randint(-3, 3), 0)
        got = list(queue.pop_upto(key))
        assert [m[:3] for m in got] == sorted(m[:3] for m in got)
        assert sorted(got) == sorted(m for m in left if m[:3] <= key)
        left = [m for m in left if m[:3] > key]
