import hashlib
import heapq
import random
import re
import zlib

import pytest

from placeweave.llm import structure_repair as sr

GOOD = re.compile(r"(s?(ua)+)?\Z")


def faults_of(rows):
    """rows: (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edit sequences by cost, then letters, until one reads well; states are not merged."""
    heap, most = [(0, "", 0, ())], 4 * len(rows) + 1
    while heap:
        cost, audit, k, out = heapq.heappop(heap)
        said = "".join(r[:1] or "-" for r, _ in out)
        if k == len(rows) and GOOD.match(said):
            return cost, audit, out
        if not re.match(r"s?(ua)*u?\Z", said) or cost > most:
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", k, (*out, (role, ""))))
        if k < len(rows):
            role, text = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, out))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 * (faults[k] == "truncated")
                heapq.heappush(heap, (cost + more, audit + "K", k + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", k + 1, (*out, (new, text))))


def by_states(rows, faults):
    """The same for longer conversations: best (cost, audit, turns) of each state, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(best):
        for _ in range(3):
            for s, (c, w, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if (s, role[0]) in step:
                        t, new = step[s, role[0]], (c + 3, w + "I", (*out, (role, "")))
                        best[t] = min(best.get(t, new), new)
        return best

    best = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults):
        new = {}
        for s, (c, w, out) in inserts(best).items():
            options = [(s, (c + 4, w + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                options += [(step[s, r[0]], (c + more + x, w + letter, (*out, (r, text)))) for r, x, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")) if r and (s, r[0]) in step]
            for t, way in options:
                new[t] = min(new.get(t, way), way)
        best = new
    return min(inserts(best)[s] for s in ("", "a") if s in inserts(best))


def expected(conv, rows, best=by_states):
    """rows: (turn, role, text) of a conversation."""
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    said = [(r, x) for _, r, x in rows]
    faults = faults_of(said)
    known = [t for t, _, _ in rows if t is not None]
    cost, audit, out = best(said, faults)
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def some_rows(n, seed):
    random.seed(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "bot", "", None, "umpire"], ["a.", "b!", "c", " d? \n", "", None, "\t \n", "e\x85", "ééé.", "f. "]
    rows = []
    for c in [*range(n), None]:
        for t in range(random.choice([0, 1, 2, 3, 4, 5, 7, 9])):
            turn = random.choice([t, t, t, t, t + 2, None, 0])
            if random.random() < 0.5:
                rows.append((c, turn, ["user", "assistant"][t % 2], random.choice(texts) or f"{t}."))
            else:
                rows.append((c, turn, random.choice(roles), random.choice(texts)))
    return rows + rows[: len(rows) // 9]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, place int")


def by_conv(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


def test_states_are_exhaustive():
    random.seed(8)
    for _ in range(150):
        rows = [(random.choice(["user", "assistant", "system", "bot", "user"]), random.choice(["a.", "b.", "c", ""])) for _ in range(random.randint(0, 4))]
        assert by_states(rows, faults_of(rows)) == cheapest(rows, faults_of(rows))


@pytest.mark.parametrize("piece,rules,spread", [(1024, 4096, False), (1, 0, True), (3, 2, True), (4, 50, True)])
def test_equals_brute_force(spark, piece, rules, spread):
    rows = some_rows(150, piece)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not spread).lower())  # conversations that lie in several partitions
    try:
        found = sr.written(sr.reports(table(spark, rows), piece, rules), "reports")
        want = {c: expected(c, x) for c, x in by_conv(rows).items()}
        got = {r.conv_id: tuple(r) for r in sr.digests(table(spark, rows), found).collect()}
        assert got == {c: w for c, (w, _) in want.items()}
        kept = by_conv(map(tuple, sr.repaired(table(spark, rows), found).collect()))
        assert {c: [t[1:] for t in sorted(x)] for c, x in kept.items()} == {c: list(out) for c, (_, out) in want.items() if out}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_damaged(spark):
    rows = [(c, t, r, x) for c, t, r, x in some_rows(300, 77)] + [(c, 0, "user", "one.") for c in range(1000, 1060)]
    left = by_conv(damage(rows))
    got = {r.conv_id: tuple(r) for r in sr.repair_damaged(table(spark, rows)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert any(c not in left for c, *_ in rows)
    assert got == {c: expected(c, left[c])[0] if c in left else (c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in rows}


def test_long_conversation_and_copies(spark):
    long = [(7, t, ["user", "assistant"][t % 2] if t % 11 else "assistant", f"{t}{'.' if t % 5 else ''}") for t in range(3000)]
    copies = [(c, t, ["user", "assistant"][t % 2], "same.") for c in range(100, 400) for t in range(5)]
    long_text = [(8, 0, "user", "word " * 300_000 + "."), (8, 1, "assistant", " " * 300_000)]
    rows = long + copies + long_text
    found = sr.reports(table(spark, rows))
    got = {r.conv_id: tuple(r) for r in sr.digests(table(spark, rows), found).collect()}
    assert got == {c: expected(c, x)[0] for c, x in by_conv(rows).items()}


def test_empty(spark):
    assert sr.repair_damaged(table(spark, [])).count() == 0
    assert sr.repaired(table(spark, []), sr.reports(table(spark, []))).count() == 0


def test_grammar_rules_stand_for_their_pairs(spark):
    marks = spark.createDataFrame([("uauauaua",), ("suauax",), ("uuuu",)], "marks string")
    rules = sr.grammar(marks)
    assert rules[0] == "ua" and len(rules) > 2
    whole = sr.Grammar(tuple(rules))
    plain = sr.Grammar(())
    for m in ("uauauaua", "suauax", "uuuu", "aauuUASx"):
        assert whole.piece(m) == plain.piece(m)
        text = sr.parsed(m, rules)
        while any(ord(x) >= sr.RULE_MARK for x in text):
            text = "".join(rules[ord(x) - sr.RULE_MARK] if ord(x) >= sr.RULE_MARK else x for x in text)
        assert text == m


def test_ropes():
    random.seed(3)
    ropes = ["", "K", "DK", "IIR"]
    for _ in range(300):
        ropes.append(sr.rope(random.choice(ropes), random.choice(ropes)))
        if len(sr.flat(ropes[-1])) > 400:
            ropes.pop()
    for _ in range(2000):
        a, b = random.choice(ropes), random.choice(ropes)
        assert sr.before(a, b) == (sr.flat(a) < sr.flat(b))
