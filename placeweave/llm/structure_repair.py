"""Repair of turn order: cheapest edits by dynamic programming over a Re-Pair grammar.

A repaired conversation reads ``(s?(ua)+)?`` by the first letters of its roles. A row is kept (0),
given the role of a user or assistant (3) or deleted (4); turns without text are inserted (3). Blank
and repeated rows have to go; a truncated row that stays costs 3 more.

1. ``placed`` orders all rows at once, so that a long conversation lies in many tasks; repeated rows
   are those that aren't the first place of their role and text.
2. ``pieces`` are up to PIECE rows of a conversation as a string of marks, one for each row.
3. ``grammar`` replaces the most frequent pairs of neighbouring marks by new ones, round by round,
   counting pairs over all distinct pieces.
4. A min-plus matrix over the four states of the pattern holds, from state to state, the least cost and
   the least audit. Those of rules are products, their audits ropes that share their parts, made bottom
   up once and used for every conversation; ties go to the lesser audit. Audits of a cost have the same
   number of letters for rows and end with one, so none begins with another, and products keep order.
5. The pieces of a conversation are joined in order: four costs go from piece to piece.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import importable, worker_store, written

#: Rows of a piece; rules of the grammar, which only save work; pairs looked at in a round.
PIECE, RULES, ROUNDS, PAIRS = 1024, 4096, 40, 2000
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
INSERT = {(START, USER): "I", (START, ASSISTANT): "II", (SYSTEM, USER): "I", (SYSTEM, ASSISTANT): "II", (USER, ASSISTANT): "I", (ASSISTANT, USER): "I"}
CLOSE = {START: (0, ""), SYSTEM: (6, "II"), USER: (3, "I"), ASSISTANT: (0, "")}
RULE_MARK = 0xE000
#: Letters of audits that a worker keeps for pieces it has seen.
KEPT_LETTERS = 1 << 24
SOLID, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

Rope = str | tuple  # a string, or (left, right, size)
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _size(r: Rope) -> int:
    return len(r) if isinstance(r, str) else r[2]


def rope(a: Rope, b: Rope) -> Rope:
    if not _size(a):
        return b
    return (a, b, _size(a) + _size(b)) if _size(b) else a


def flat(r: Rope) -> str:
    out, todo = [], [r]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


def before(a: Rope, b: Rope) -> bool:
    """Whether a's string is less than b's; parts that both share are skipped."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if isinstance(p, str) and isinstance(q, str):
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p < q
            x += [p[n:]] * (len(p) > n)
            y += [q[n:]] * (len(q) > n)
        elif _size(p) >= _size(q):
            x += (p[1], p[0])
            y.append(q)
        else:
            y += (q[1], q[0])
            x.append(p)
    return not x and bool(y)


def put(m: Matrix, at: tuple[int, int], cost: int, audit: Rope) -> None:
    old = m.get(at)
    if old is None or cost < old[0] or (cost == old[0] and before(audit, old[1])):
        m[at] = (cost, audit)


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (c, x) in a.items():
        for j in range(4):
            if (k, j) in b:
                d, y = b[k, j]
                put(out, (i, j), c + d, rope(x, y))
    return out


@lru_cache(maxsize=None)
def row_matrix(mark: str) -> Matrix:
    """What a row with this mark may become, turns inserted before it included."""
    inserts: Matrix = {(i, i): (0, "") for i in range(4)} | {at: (3 * len(x), x) for at, x in INSERT.items()}
    edits: Matrix = {(i, i): (4, "D") for i in range(4)}
    if mark != "x":
        more = 3 if mark.isupper() else 0
        for (i, role), j in STEP.items():
            put(edits, (i, j), more, "K") if role == mark.lower() else None
            put(edits, (i, j), 3 + more, "R") if role in "ua" else None
    return product(inserts, edits)


def parsed(marks: str, rules: Iterable[str]) -> str:
    """Marks with pairs replaced rule by rule."""
    for k, pair in enumerate(rules):
        if pair in marks:
            marks = marks.replace(pair, chr(RULE_MARK + k))
    return marks


class Grammar:
    """Matrices of rules, and pieces evaluated with them."""

    def __init__(self, rules: tuple[str, ...]):
        self.rules, self.of, self.seen, self.letters = rules, {}, {}, 0
        for k, (a, b) in enumerate(rules):
            self.of[chr(RULE_MARK + k)] = product(self.matrix(a), self.matrix(b))

    def matrix(self, mark: str) -> Matrix:
        return self.of[mark] if ord(mark) >= RULE_MARK else row_matrix(mark)

    def piece(self, marks: str) -> tuple[list[int], list[str | None]]:
        """Costs (-1: no way) and audits from each state to each, row by row of the matrix."""
        if marks not in self.seen:
            found: Matrix | None = None
            for mark in parsed(marks, self.rules):
                found = product(found, self.matrix(mark)) if found else self.matrix(mark)
            cells = [found.get((i, j)) for i in range(4) for j in range(4)]
            result = [-1 if c is None else c[0] for c in cells], [None if c is None else flat(c[1]) for c in cells]
            self.letters += sum(map(len, filter(None, result[1]))) + len(marks)
            if self.letters > KEPT_LETTERS:
                self.seen, self.letters = {}, 0
            self.seen[marks] = result
            return result
        return self.seen[marks]


def _grammar_of(rules: tuple[str, ...]) -> Grammar:
    own = worker_store("grammar")
    if rules not in own:
        own.clear()
        own[rules] = Grammar(rules)
    return own[rules]


def pairs_of(marks: str) -> Counter:
    """How often each pair of neighbouring marks occurs; in a run of one mark, without overlap."""
    found = Counter(map("".join, zip(marks, marks[1:])))
    for pair in [p for p in found if p[0] == p[1]]:
        found[pair] = marks.count(pair)
    return found


def grammar(distinct: DataFrame, most: int = RULES, rounds: int = ROUNDS) -> list[str]:
    """Re-Pair rules (pairs of marks) for a table of distinct ``marks``, most frequent pairs first.

    A round takes the most frequent pairs that share no mark, as replacing one leaves the counts of
    the others alone. It ends when no pair occurs twice; ``most`` and ``rounds`` bound the rules, what
    is left unreplaced is evaluated mark by mark, with the same result.
    """
    rules: list[str] = []
    for _ in range(rounds):
        known = tuple(rules)

        def work(batches: Iterable[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                for marks in batch.column(0).to_pylist():
                    found.update(pairs_of(parsed(marks, known)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"])

        counts = distinct.mapInArrow(work, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        used: set[str] = set()
        for r in counts.orderBy(F.desc("n"), "pair").limit(PAIRS).collect():  # PAIRS rows at most
            if not used & set(r.pair) and len(rules) < most:
                used |= set(r.pair)
                rules.append(r.pair)
        if not used:
            break
    return rules


def ordered_by() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) alone; null roles and texts are empty."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role"), said("text"))


def placed(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, place, role: its letter, fault): all rows in one order, without their texts.

    fault: x blank, d repeated, t truncated, or empty. Equal rows are told apart by where they were read, so
    even they lie in many tasks.
    """
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256)
    letter = F.substring("role", 1, 1)
    marked = rows.withColumn("read", F.monotonically_increasing_id()).orderBy(*ordered_by(), "read").select(
        "conv_id", "turn", F.monotonically_increasing_id().alias("place"), F.when(letter.isin("s", "u", "a"), letter).otherwise("o").alias("role"),
        F.unhex(said).alias("said"), (~F.col("text").rlike(SOLID)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"),
    )
    marked = written(marked, "placed")
    first = marked.where("not blank").groupBy("conv_id", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "x").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("")
    return written(marked.join(first, "place", "left").select("conv_id", "turn", "place", "role", fault.alias("fault")), "faults")


def pieces(faults: DataFrame, size: int = PIECE) -> DataFrame:
    """(conv_id, piece, marks, roles): ``size`` rows of a conversation at most, pieces numbered in order.

    A mark is the letter of the role, in capitals if truncated, or x for rows that have to go.
    """
    mark = F.when(F.col("fault").isin("x", "d"), "x").when(F.col("fault") == "t", F.upper("role")).otherwise(F.col("role"))
    each = faults.select("conv_id", F.expr(f"place div {size}").alias("piece"), F.struct("place", mark.alias("mark"), "role").alias("row"))
    found = each.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return found.select("conv_id", "piece", F.concat_ws("", "rows.mark").alias("marks"), F.concat_ws("", "rows.role").alias("roles"))


def illegal_in(roles: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def audits(found: DataFrame, rules: list[str]) -> DataFrame:
    """(conv_id, cost, audit, illegal) from ``pieces``."""
    importable(found.sparkSession)
    known = tuple(rules)
    out = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])

    def evaluate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _grammar_of(known)
        for batch in batches:
            cells = [g.piece(m) for m in batch.column(2).to_pylist()]
            roles = batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([c for c, _ in cells], pa.list_(pa.int32())), pa.array([a for _, a in cells], pa.list_(pa.string())),
                pa.array([r[0] + r[-1] for r in roles]), pa.array([illegal_in(r) for r in roles], pa.int64()),
            ], names=["conv_id", "piece", "costs", "audits", "ends", "illegal"])

    def close(conv, ways, illegal) -> dict:
        best = min((cost + CLOSE[i][0], rank, CLOSE[i][1], path) for i, (cost, rank, path) in ways.items())
        parts, path = [best[2]], best[3]
        while path:
            parts.append(path[1])
            path = path[0]
        return {"conv_id": conv, "cost": best[0], "audit": "".join(reversed(parts)), "illegal": illegal}

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ways, last, illegal, begun = None, {}, "", 0, False
        for batch in batches:
            rows = []
            for c, _, costs, texts, ends, inside in zip(*(x.to_pylist() for x in batch.columns)):
                if not begun or c != conv:
                    if begun:
                        rows.append(close(conv, ways, illegal))
                    conv, ways, last, illegal, begun = c, {START: (0, 0, None)}, "", 0, True
                best = {}
                for j in range(4):
                    # a path's rank is the place of its audit among those of the other states
                    options = [(cost + costs[4 * i + j], rank, texts[4 * i + j], i) for i, (cost, rank, _) in ways.items() if costs[4 * i + j] >= 0]
                    if options:
                        best[j] = min(options)
                ranks = {j: k for k, j in enumerate(sorted(best, key=lambda j: best[j][1:3]))}
                ways = {j: (cost, ranks[j], (ways[i][2], text)) for j, (cost, _, text, i) in best.items()}
                illegal += inside + (bool(last) and illegal_in(last + ends[0]))
                last = ends[1]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=out)
        if begun:
            yield pa.RecordBatch.from_pylist([close(conv, ways, illegal)], schema=out)

    each = found.mapInArrow(evaluate, "conv_id long, piece long, costs array<int>, audits array<string>, ends string, illegal long")
    return each.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(fold, "conv_id long, cost long, audit string, illegal long")


def reports(conversations: DataFrame, piece: int = PIECE, rules: int = RULES) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows without conv_id make one conversation; rows without turn come first; those of one turn are ordered by role
    and text. Null roles and texts are empty; equal rows count one by one; an empty table gives an empty one.
    """
    faults = placed(turns(conversations))
    count = lambda f: F.sum(F.when(F.col("fault") == f, 1).otherwise(0))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count_distinct("turn")
    counted = faults.groupBy("conv_id").agg(gaps.alias("gaps"), count("x").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"))
    cut = written(pieces(faults, piece), "pieces")
    edits = audits(cut, grammar(written(cut.select("marks").distinct(), "marks"), rules))
    same = counted.conv_id.eqNullSafe(edits.conv_id)
    return counted.join(edits, same).select(counted.conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def edited(role: str, text: str, letter: str, state: int) -> tuple[tuple[str, str] | None, int]:
    """The turn that an edit leaves, if any, and the state after it."""
    if letter == "D":
        return None, state
    if letter != "K":
        role = "assistant" if state == USER else "user"
    return (role, "" if letter == "I" else text), STEP[state, role[0]]


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Turns (conv_id, role, text, report) of repaired conversations, batch by batch; (conv_id, None, report, None) begins each.

    batches: conv_id, audit, report, role, text; a conversation's audit and report come before its rows.
    """
    audit, at, state, conv = "", 0, START, None

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            turn, state = edited("", "", "I", state)
            at += 1
            yield (conv, *turn)

    for batch in batches:
        out: list[tuple] = []
        for c, letters, report, role, text in zip(*(x.to_pylist() for x in batch.columns)):
            if letters is not None:
                out += inserted()
                conv, audit, at, state = c, letters, 0, START
                out.append((c, None, report))
                continue
            out += inserted()
            turn, state = edited(role, text, audit[at], state)
            at += 1
            if turn:
                out.append((c, *turn))
        yield out
    yield list(inserted())


def _with_audits(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, after a row with its audit and report."""
    none = lambda kind: F.lit(None).cast(kind)
    head = found.select("conv_id", "audit", F.struct(*found.columns).alias("report"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"))
    body = turns(conversations).select("conv_id", none("string").alias("audit"), none(head.schema["report"].dataType.simpleString()).alias("report"), "turn", "role", "text")
    together = head.unionByName(body).withColumn("row", F.col("audit").isNull())
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "row", "turn", "role", "text")]
    return together.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "report", "role", "text")


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the turns that the audits of ``reports`` leave, numbered from 0."""
    importable(conversations.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for rows in _repaired(batches):
            out = []
            for c, role, text in rows:
                if role is None:
                    n = 0
                else:
                    out.append((c, n, role, text))
                    n += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["conv_id", "turn", "role", "text"])

    return _with_audits(conversations, found).mapInArrow(work, "conv_id long, turn long, role string, text string")


def digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with repaired_sha256: that of its repaired turns as lines ``role:text``.

    A digest is made in order, so one task reads the rows of a conversation, one batch at a time.
    """
    importable(conversations.sparkSession)
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    out = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in found.schema] + [("repaired_sha256", pa.string())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, digest, begun = None, None, False
        for rows in _repaired(batches):
            done = []
            for _, role, text in rows:
                if role is None:
                    if report is not None:
                        done.append({**report, "repaired_sha256": digest.hexdigest()})
                    report, digest, begun = text, hashlib.sha256(), False
                else:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if report is not None:
            yield pa.RecordBatch.from_pylist([{**report, "repaired_sha256": digest.hexdigest()}], schema=out)

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) + ", repaired_sha256 string"
    return _with_audits(conversations, found).mapInArrow(work, ddl)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults made by the CRC-32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), kind.alias("kind"), times.alias("times"))
    return kept.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode("times").alias("time")).drop("time")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Per conversation of the undamaged table, what ``digests`` says of the damaged one; those without rows are repaired as they are."""
    rows = damaged(conversations)
    found = written(reports(rows), "reports")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    full = ids.join(found, ids.conv_id.eqNullSafe(found.conv_id), "left").select(ids.conv_id, *numbers, F.coalesce("audit", F.lit("")).alias("audit"))
    return digests(rows, full)
