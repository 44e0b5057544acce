import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, rule string, kept string, node string"


def make_docs(spark, rows):
    """rows: (doc_id, text). The further columns clash with names that operators use."""
    return spark.createDataFrame([(i, t, "en" if i is None or i % 2 else None, None if i == 3 else f"s{(i or 0) % 3}", len(t) if t is not None else None, "k", "r", "x", "n") for i, t in rows], COLUMNS)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, copies, near copies, non-ASCII and a very long text."""
    draw = random.Random(7)
    vocabulary = ["the", "of", "ion", "thé", "Straße", "alpha", "beta", "gamma", "delta", "x1", "y2", "zeta", "eta", "theta"]
    line = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base = "\n".join(line(12) for _ in range(12))
    passage = "\n".join(line(15) for _ in range(5))
    words = base.split(" ")
    rows = [(0, base), (1, base), (2, None), (3, ""), (4, " \n\t "), (5, "one two"), (6, "one two"), (7, base.upper())]
    rows += [(k, " ".join(w if draw.random() > 0.02 else "changed" for w in words)) for k in range(8, 16)]
    rows += [(k, line(30) + "\n" + passage + "\n" + line(30)) for k in range(16, 22)]
    rows += [(22, "\n".join(line(10) for _ in range(2500))), (23, "a" * 500), (24, "ab" * 300), (None, base), (None, None), (25, base), (25, base)]
    rows += [(26, "Ünïcode ☃ " * 40), (27, passage), (28, "same line\n" * 40)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return make_docs(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
