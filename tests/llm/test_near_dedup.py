import random
import re

from rollweave.llm import near_dedup

from .conftest import make_docs


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        own = [k for j, (k, _) in enumerate(rows) if find(j) == find(i) and k is not None]
        least[i] = min(own, default=None)
    return sorted(((k, len(sets[i]), least[i], k == least[i]) for i, (k, _) in enumerate(rows)), key=str)


def got(docs):
    return sorted((tuple(r) for r in near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_edges_match_brute_force(edge_docs, edge_rows):
    assert got(edge_docs) == brute(edge_rows)


def test_empty_table(no_docs):
    assert got(no_docs) == []


def chain_rows():
    """Chains of small edits, so that links go by way of others, and texts that share a passage but aren't linked."""
    draw = random.Random(3)
    rows, vocabulary = [], [f"w{k}" for k in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(40)]
    for _ in range(4):
        words = [draw.choice(vocabulary) for _ in range(90)]
        for _ in range(12):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[draw.randrange(90)] = draw.choice(vocabulary)
    for _ in range(150):
        own = [draw.choice(vocabulary) for _ in range(25)]
        rows.append((len(rows), " ".join(own[:12] + passage + own[12:])))
    return rows


def test_chains_and_shared_passages(spark, monkeypatch):
    rows = chain_rows()
    assert got(make_docs(spark, rows)) == brute(rows)
    monkeypatch.setattr(near_dedup, "CROWD", 3)
    assert got(make_docs(spark, rows)) == brute(rows)


def test_one_of_each_group_stays(edge_docs, edge_rows):
    out = near_dedup.drop_near_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(k for k in kept if k is not None) == sorted({k for k, _, _, keep in brute(edge_rows) if keep and k is not None})


def test_odd_sketch_estimates():
    import numpy as np

    draw = np.random.default_rng(1)
    for share in (0.75, 0.9):
        low = draw.integers(0, 1 << 63, (200, near_dedup.SAMPLES)).astype(np.uint64)
        other = np.where(draw.random(low.shape) < share, low, draw.integers(0, 1 << 63, low.shape).astype(np.uint64))
        z = np.bitwise_count((near_dedup.odd_sketch(low) ^ near_dedup.odd_sketch(other)).view(np.uint64)).sum(axis=1)
        estimate = 1 + near_dedup.BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * z / near_dedup.BITS)
        assert abs(estimate.mean() - share) < 0.02
        assert (z <= near_dedup.MOST_DIFFERENT).mean() == 1
