import random
import re

import numpy as np
import xxhash

from placeweave.llm import simhash
from placeweave.llm.components import components


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components(spark):
    random.seed(5)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    pairs = chain + star + [(random.randint(0, 90), random.randint(0, 90)) for _ in range(60)] + [(3, 3), (1, 2), (2, 1)]
    df = spark.createDataFrame([*pairs, (None, 1)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    linked = [(a, b) for a, b in pairs if a != b]
    assert got == roots({n for p in linked for n in p}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 20)  # so that groups are dealt to chunks
    random.seed(6)
    bits = {0, 2**64 - 1}
    for _ in range(25):
        center = random.getrandbits(64)
        for _ in range(40):
            x = center
            for b in random.sample(range(64), random.randint(0, 4)):
                x ^= 1 << b
            bits.add(x)
    bits = sorted(bits)
    pairs = [(a, b) for k, a in enumerate(bits) for b in bits[k + 1 :] if (a ^ b).bit_count() <= 3]
    signed = [int(np.uint64(x).view(np.int64)) for x in bits]
    df = spark.createDataFrame([(x,) for x in signed], "bits long").repartition(3)
    got = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(df).collect()]
    assert roots(bits, got) == roots(bits, pairs)
    assert all(r != s for r, s in got)


def test_near_duplicates(spark, docs):
    random.seed(7)
    words = [f"W{k}" for k in range(60)]
    base = [random.choices(words, k=80) for _ in range(12)]
    rows = []
    for k in range(150):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2])):
            w[random.randrange(len(w))] = random.choice(words)
        rows.append((1000 - k, random.choice([" ", "\t", "\n "]).join(w)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One two"), (6, "é É ß"), (7, "w " * 300_000), (7, "w " * 300_000), (None, "one"), (None, "lonely words here")]
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()}
    fingers = [(k, slow_fingerprint(t) if len(t or "") < 10_000 else simhash.fingerprint(t)) for k, t in rows]
    nodes = sorted({f for _, f in fingers})
    root = roots(nodes, [(a, b) for k, a in enumerate(nodes) for b in nodes[k + 1 :] if (a ^ b).bit_count() <= 3])
    name = {}
    for k, f in fingers:
        if k is not None:
            name[root[f]] = min(k, name.get(root[f], k))
    assert got == {(k, f"{f:016x}", name.get(root[f])) for k, f in fingers}
    assert simhash.near_duplicates(docs([])).count() == 0


def test_long_text_in_slices(monkeypatch):
    text = " ".join(random.choices(["aa", "b", "ccc ddd", "É\n"], k=500))
    monkeypatch.setattr(simhash, "SLICE_BYTES", 7)
    assert simhash.fingerprint(text) == slow_fingerprint(text)
