import hashlib
import random
from collections import Counter

import pytest

from placeweave.llm import repeats


def brute(rows, length):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((k, len(b), len(b) - len(kept), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, length):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdeé", k=random.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(length // 3) for _ in range(6)] + [text(length // 8) for _ in range(4)] + ["x" * (length + 5), "ab" * length]
    rows = []
    for k in range(120):
        parts = [random.choice([text(random.randint(0, 30)), random.choice(passages), random.choice(passages)[random.randint(0, 20) :]]) for _ in range(random.randint(0, 5))]
        rows.append((k, "".join(parts)))
    rows += [(200 + k, rows[random.randrange(100)][1]) for k in range(10)]
    for k in range(10):  # near copies
        t = list(rows[random.randrange(100)][1] or "y")
        t[random.randrange(len(t))] = "#"
        rows.append((300 + k, "".join(t)))
    return rows + [(400, None), (401, ""), (402, "q" * 3 * length), (403, "é" * length), (403, "other " + text(9)), (404, passages[0]), (404, passages[0]), (None, text(length)), (None, passages[1])]


@pytest.mark.parametrize("length, rows_of_a_block, part", [(40, 500_000, 1 << 20), (64, 50, 100)])
def test_equals_brute_force(spark, docs, monkeypatch, length, rows_of_a_block, part):
    monkeypatch.setattr(repeats, "BLOCK_ROWS", rows_of_a_block)
    monkeypatch.setattr(repeats, "SLICE", part)
    rows = corpus(length, length)
    got = repeats.without_repeats(docs(rows).repartition(5), length).drop("kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, length)


def test_empty(spark, docs):
    assert repeats.without_repeats(docs([])).count() == 0


def test_triggers(monkeypatch):
    data = random.Random(3).randbytes(700) + b"a" * 300
    whole = repeats.triggers(data, 50)
    assert len(whole) == 951 and all(s <= t <= s + 42 for s, t in enumerate(whole.tolist()))
    monkeypatch.setattr(repeats, "SLICE", 64)
    assert repeats.triggers(data, 50).tolist() == whole.tolist()
    moved = repeats.triggers(b"zz" + data, 50)
    assert (moved[2:] - 2).tolist() == whole.tolist()
