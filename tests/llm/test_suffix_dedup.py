import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rollweave.llm import run_index, suffix_dedup

from .conftest import make_docs


def brute(rows, length=100):
    order = sorted({(k is None, k if k is not None else 0) for k, _ in rows})
    first = {}
    for i in order:
        for k, t in rows:
            if (k is None, k if k is not None else 0) == i:
                data = (t or "").encode()
                for p in range(len(data) - length + 1):
                    w = data[p : p + length]
                    if w not in first or (i, p) < first[w]:
                        first[w] = (i, p)
    out = []
    for k, t in rows:
        data, i = (t or "").encode(), (k is None, k if k is not None else 0)
        gone = np.zeros(len(data) + 2, bool)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] != (i, p):
                gone[p + 1 : p + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(data, gone[1:-1], strict=True) if not g)
        out.append((k, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()), key=str)


def test_edges_match_brute_force(edge_docs, edge_rows):
    assert got(edge_docs) == brute(edge_rows)


@pytest.mark.parametrize("most", [5_000, 3])
def test_crowded_grams_match_brute_force(spark, monkeypatch, most):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcde") for _ in range(4))
    common = [" ".join(word() for _ in range(n)) for n in (8, 13, 30)]
    rows = [(k, " ".join(x for _ in range(6) for x in (word(), word(), draw.choice(common), word()))) for k in range(60)]
    monkeypatch.setattr(suffix_dedup, "CROWD", 4)
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    monkeypatch.setattr(suffix_dedup, "INDEXED", 20)
    monkeypatch.setattr(suffix_dedup, "CONTEXTS", 50)
    assert got(make_docs(spark, rows)) == brute(rows)


def test_empty_table(no_docs):
    assert got(no_docs) == []


def test_kept_text_and_spans(edge_docs):
    for r in suffix_dedup.suffix_dedup(edge_docs, keep_text=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"] == r["n_bytes"] - len(r["kept"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=30), min_size=1, max_size=6), st.integers(1, 6))
def test_run_index(texts, least):
    texts = [t.encode() for t in texts]
    text, order, _, _ = run_index.suffix_rows(texts)
    whole = [tuple(text[p:]) for p in order]
    assert whole == sorted(whole)
    index = run_index.RunIndex.compressed(text, order)
    shared, above = index.statistics()
    for k, p in enumerate(order):
        same = next((j for j, (x, y) in enumerate(zip(whole[k], whole[k - 1], strict=False)) if x != y), min(len(whole[k]), len(whole[k - 1]))) if k else 0
        assert above[p] == (order[k - 1] if k else -1) and (not k or shared[p] == same)
    transform = text[order - 1]
    assert len(index.head) == len(index.above) == len(index.shared) == 1 + (transform[1:] != transform[:-1]).sum()
    late = run_index.later_matches(texts, np.arange(len(texts)), np.zeros(len(texts), int), least)
    seen = set()
    for i, t in enumerate(texts):
        want = []
        for p in range(len(t) - least + 1):
            if t[p : p + least] in seen:
                want.append(p)
            seen.add(t[p : p + least])
        assert late[i].tolist() == want


def test_the_index_is_run_compressed():
    """Samples follow the number of different texts, not of copies."""
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"abcdefgh") for _ in range(150)) for _ in range(5)]
    few, many = run_index.RunIndex.of(texts), run_index.RunIndex.of(texts * 40)
    assert many.length == 40 * few.length and len(many.head) < 2 * len(few.head) + 2 * 200


def test_anchors_match_a_plain_loop_in_little_memory():
    draw = random.Random(6)
    texts = [bytes(draw.choice(b"abcd") for _ in range(n)) for n in (99, 100, suffix_dedup.BLOCK + 120, 101, 168, 3_000)] + [b"ab" * 400]
    want = []
    for k, t in enumerate(texts):
        grams = suffix_dedup.gram_hashes(np.frombuffer(t, np.uint8)).tolist()
        least = [max(range(p, p + suffix_dedup.SIDE + 1), key=lambda q: (-(grams[q] >> 16), q)) for p in range(len(t) - suffix_dedup.LENGTH + 1)]
        want += [(k, p, grams[p]) for p in sorted(set(least))]
    for found in (suffix_dedup.anchors(texts), suffix_dedup.anchors(texts, contexts=False)):
        assert list(zip(*(x.tolist() for x in found[:3]), strict=True)) == want
    long = bytes(draw.choices(b"abcdefgh", k=1_000_000))
    tracemalloc.start()
    suffix_dedup.anchors([long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * len(long)
