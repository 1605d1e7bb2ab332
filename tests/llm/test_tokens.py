import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from placeweave.llm import packing, token_files, tokens

V, R = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "a", "the cat sat.\nOn  a mat", " lead", "trail ", "tab\t x", "don't ''s", "<|endoftext|>", "a <|endoftext|> b", "\x1c \x1c", "中文 字 é", "  x", "x" * 5000, "word " * 3000, "the cat sat.\nOn  a mat"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(V)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library):
    random.seed(3)
    encoder = tokens.Encoder(V, R, size=50)
    alphabet = [*"ab '\n\t ,.1é\x1c\U0001f600中sßx ", "<|endoftext|>", "  ", " the", "\r\n"]
    for _ in range(3000):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        expected = ids(library, text)
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected
        assert np.frombuffer(b"".join(encoder._slice(x) for x in tokens.slices(text, 5) if x), "<u4").tolist() == expected


@pytest.mark.parametrize("size,letters", [(40, 10_000), (10_000, 60)])
def test_lengths_equal_library(library, size, letters):
    random.seed(size)
    lengths = tokens.Lengths(V, R, {" the": 1, "a": 1}, size, letters)
    alphabet = [*"ab '\n\t ,.1é\x1c\U0001f600中sßx÷ ", "<|endoftext|>", "  ", " the", "\r\n", "'s", " foo.bar(baz)", " 字字。"]
    for _ in range(3000):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        assert lengths.count(text) == len(ids(library, text))
        assert sum(lengths._slice(x) for x in tokens.slices(text, 5) if x) == len(ids(library, text))
        assert "".join(tokens.pieces_of(text)) == text
    assert len(lengths.known) <= size + 2 and lengths.known.letters <= letters + 64


def test_text_without_spaces_is_looked_up_by_pre_tokens(library):
    code = "foo.bar(baz);" * 4000
    lengths = tokens.Lengths(V, R, {})
    assert lengths.count(code) == len(ids(library, code))
    assert lengths.known.misses < 12
    chinese = "中文字，" * 3000
    assert lengths.count(chinese) == len(ids(library, chinese))


def test_frequent_pre_tokens_of_a_sample(spark, docs):
    rows = docs([(k, "common words, common words " + f"rare{'abcdefghij'[k % 10]} " * 2) for k in range(400)]).select("text")
    table = tokens.frequent_lengths(rows, V, R, most=4)
    assert {" common", " words", ","} <= set(table)
    assert table[","] == 1 and len(table) == 4
    assert tokens.frequent_lengths(rows.limit(0), V, R) == {}


def test_tables_are_kept_apart_in_a_worker(spark, docs, library):
    texts = [(k, t) for k, t in enumerate(TEXTS)]
    packing.pack_documents(docs(texts), V, R, end_id=2, capacity=64).collect()  # its workers have encoders of their own
    a, b = tokens.Lengths.of_worker(V, R, "a", {"x": 1}), tokens.Lengths.of_worker(V, R, "b", {"y": 1})
    assert "x" in a.known and "y" in b.known and tokens.Lengths.of_worker(V, R, "b", {}) is b
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs(texts), V, R, sample=3).collect()}
    assert got == {k: len(ids(library, t)) for k, t in texts}


def test_count_tokens(spark, docs, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again")]
    got = sorted(map(tuple, tokens.count_tokens(docs(rows), V, R).collect()), key=str)
    expected = [(k, len((t or "").encode()), n := len(ids(library, t)), n > 512) for k, t in rows]
    assert got == sorted(expected, key=str)
    assert tokens.count_tokens(docs([]), V, R).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_everything_once(seed):
    random.seed(seed)
    capacity = random.choice([10, 64, 1024])
    items = {random.randint(1, capacity): random.randint(1, 50) for _ in range(random.randint(1, 60))}
    used, seen = {}, {}
    for length, rank, count, first, each, offset in packing.plan(items, capacity):
        for k in range(count):
            seen.setdefault(length, []).append(rank + k)
            used.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert {n: sorted(x) for n, x in seen.items()} == {n: list(range(c)) for n, c in items.items()}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    assert sorted(used) == list(range(len(used)))
    # best fit decreasing, item by item, needs about as many
    bins = []
    for n in sorted((n for n, c in items.items() for _ in range(c)), reverse=True):
        fit = [k for k, b in enumerate(bins) if b >= n]
        if fit:
            bins[min(fit, key=bins.__getitem__)] -= n
        else:
            bins.append(capacity - n)
    assert len(used) <= len(bins) * 1.05 + 1


def test_pack_documents(spark, docs, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again")]
    got = packing.pack_documents(docs(rows), V, R, end_id=2, capacity=100).collect()
    texts = {}
    for k, t in rows:
        texts.setdefault(k, []).append(ids(library, t) + [2])
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in texts[r.doc_id])
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 100
    assert sum(r.length for r in got) == sum(len(x) for xs in texts.values() for x in xs)
    assert packing.pack_documents(docs([]), V, R).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    random.seed(n)
    x = np.array([random.choice([5, random.randint(0, 300), random.randint(0, 2**32 - 1)]) for _ in range(n)], np.uint32)
    cuts = sorted(random.sample(range(n + 1), min(n, 3)))
    parts = np.split(x, cuts)
    s = token_files.Segment(token_files.segment([None, *range(len(parts) - 1)], [p.astype("<u4").tobytes() for p in parts]))
    assert s.ids().tolist() == x.tolist()
    assert s.doc_ids[0] is None
    for a, b in [(0, 3), (n // 2, n // 2 + 300), (n - 1, n + 5)]:
        assert s.ids(max(a, 0), b).tolist() == x[max(a, 0) : b].tolist()


def test_token_files(spark, docs, library):
    rows = [*enumerate(TEXTS)][::-1]
    got = sorted(map(tuple, token_files.token_files(docs(rows), V, R).collect()))
    at, expected = 0, []
    for k, t in sorted(rows, key=lambda r: r[0]):
        x = ids(library, t) + [2]
        expected.append((k, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert got == expected
    assert token_files.token_files(docs([]), V, R).count() == 0
    assert token_files.token_files(docs([(None, "x"), (1, "y"), (1, "y")]), V, R).count() == 3
