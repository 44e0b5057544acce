import hashlib
import itertools
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollweave.llm import line_dedup, mixing, toxicity
from rollweave.llm.queries import oracle_sql

from .conftest import make_docs


def cuts(text):
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in text.split("\n")]
    runs = [(k, list(g)) for k, g in itertools.groupby(range(len(h)), key=h.__getitem__)]
    out = {len(h) - 1}
    for j, (x, own) in enumerate(runs):
        follows = j + 1 < len(runs) and len(runs[j + 1][1]) > 1
        if len(own) > 1 or follows or j and (x + line_dedup.FACTOR * runs[j - 1][0]) % line_dedup.PRIME % line_dedup.DIVISOR == 0:
            out.add(own[-1])
    return out


def chunks(text):
    lines, out, at = (text or "").split("\n"), [], 0
    for end in sorted(cuts(text or "")):
        out.append(lines[at : end + 1])
        at = end + 1
    return out


def brute_lines(rows):
    place = lambda k, no: (k is None, k or 0, no)
    first = {}
    for k, t in rows:
        for no, c in enumerate(chunks(t)):
            if len(c) >= 2 and re.search(r"[^ \t\n\x0B\f\r]", "\n".join(c)):
                x = "\n".join(c)
                first[x] = min(first.get(x, place(k, no)), place(k, no))
    out = []
    for k, t in rows:
        own = chunks(t)
        gone = [no for no, c in enumerate(own) if first.get("\n".join(c), place(k, no)) < place(k, no) and len(c) >= 2]
        kept = t if not gone else "\n".join(x for no, c in enumerate(own) if no not in gone for x in c)
        out.append((k, sum(map(len, own)), len(own), len(gone), sum(len(own[no]) for no in gone), kept))
    return sorted(out, key=str)


def test_line_dedup(edge_docs, edge_rows, no_docs):
    out = line_dedup.line_dedup(edge_docs)
    assert sorted((tuple(r) for r in out.drop("row").collect()), key=str) == brute_lines(edge_rows)
    assert sum(r[3] for r in brute_lines(edge_rows)) > 10
    assert all(r["row"]["doc_id"] == r["doc_id"] and r["row"]["rule"] == "r" for r in out.collect())
    assert line_dedup.line_dedup(no_docs).collect() == []


def test_drop_repeated_lines(edge_docs, edge_rows):
    out = line_dedup.drop_repeated_lines(edge_docs)
    assert out.columns == edge_docs.columns and out.dtypes == edge_docs.dtypes
    want = [(r[0], r[5]) for r in brute_lines(edge_rows) if not r[3] or r[5].strip(" \t\n\x0b\f\r")]
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in got)


def brute_runs(rows):
    """(key, text): without the lines of chunks and of line pairs that stand earlier; blank is empty. Rows of which the chunks leave nothing go."""
    full = lambda x: re.search(r"[^ \t\n\x0B\f\r]", x)
    place = lambda k, a: (k is None, k or 0, a)
    found, first = [], {}
    for k, t in rows:
        own, units, at = (t or "").split("\n"), [], 0
        for c in chunks(t):
            units += [(False, at, at + len(c))] * (len(c) >= 2 and bool(full("\n".join(c))))
            at += len(c)
        some = [i for i, x in enumerate(own) if full(x)]
        units += [(True, i, j + 1) for i, j in zip(some, some[1:])]
        found.append((k, t, own, units))
        for pair, a, b in units:
            x = pair, "\n".join(own[a:b])
            first[x] = min(first.get(x, place(k, a)), place(k, a))
    out = []
    for k, t, own, units in found:
        gone = [(pair, a, b) for pair, a, b in units if first[pair, "\n".join(own[a:b])] < place(k, a)]
        rest = lambda spans: "\n".join(x for i, x in enumerate(own) if not any(a <= i < b for _, a, b in spans))  # noqa: B023, E731
        chunked = [x for x in gone if not x[0]]
        if not chunked or full(rest(chunked)):
            out.append((k, t if not gone else rest(gone) if full(rest(gone)) else ""))
    return sorted(out, key=str)


def test_drop_repeated_runs(edge_docs, edge_rows, no_docs):
    out = line_dedup.drop_repeated_runs(edge_docs)
    assert out.columns == edge_docs.columns and out.dtypes == edge_docs.dtypes
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == brute_runs(edge_rows)
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in got)
    assert line_dedup.drop_repeated_runs(no_docs).collect() == []


def test_short_passages_and_copies_go_whole(spark):
    """At every place in a text, whatever cuts are near; drop_repeated_lines leaves most of these."""
    line = lambda k, i: f"text {k} line {i} of some words"
    rows, want = [], {}
    for k in range(40):
        passage = [line(k, f"p{i}") for i in range(2 + k % 4)]
        first, second = [line(k, "a"), *passage, line(k, "b")], [line(k, "c"), line(k, "d"), *passage, line(k, "e")]
        rows += [(3 * k, "\n".join(first)), (3 * k + 1, "\n".join(second)), (3 * k + 2, "\n".join(first))]
        want |= {3 * k: "\n".join(first), 3 * k + 1: "\n".join([line(k, "c"), line(k, "d"), line(k, "e")])}
    docs = make_docs(spark, rows)
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_runs(docs).collect()}
    assert {k: t for k, t in got.items() if t} == want
    left = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert set(got) == set(left) and sum(left[k] != t for k, t in got.items()) > 40


def test_boundaries_come_back_in_step():
    lines = [f"line {k}" for k in range(200)]
    a, b = cuts("\n".join(lines)), cuts("\n".join(["new"] + lines))
    assert {x + 1 for x in a if x > 1} <= b


def test_runs_of_equal_lines_go(spark):
    """Four documents share a run of six equal lines between lines of their own; it goes from all but the first."""
    rows = [(k, f"first {k}\nsecond {k}\n" + "the same words again\n" * 6 + f"last {k}") for k in range(4)]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(make_docs(spark, rows)).collect()}
    assert out[0]["n_removed_lines"] == 0 and all(out[k]["n_removed_lines"] == 6 for k in (1, 2, 3))
    assert all(out[k]["kept"] == f"first {k}\nsecond {k}\nlast {k}" for k in (1, 2, 3))


def test_cuts_look_at_both_lines_whole():
    """About one place in DIVISOR is a cut, and not just those at which two line hashes agree in their low bits."""
    lines = [f"line {k * 7919 % 100_003}" for k in range(4000)]
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    found = cuts("\n".join(lines))
    assert abs(len(found) / len(lines) - 1 / line_dedup.DIVISOR) < 0.03
    assert abs(sum(h[i] % 4 == h[i - 1] % 4 for i in found) / len(found) - 0.25) < 0.05


def test_mix_hits_its_targets(spark):
    rows = [(k, f"{'w ' * (k % 17 + 1)}{'@' if k % 5 == 0 else ''}{' | ' if k % 7 == 0 else ''}") for k in range(3000)]
    docs = make_docs(spark, rows)
    targets = {"source": {"s0": 0.5, "s1": 0.3, "s2": 0.2}, "lang": {"en": 0.6, "": 0.4}}
    mixed = mixing.mix(docs, targets, rate=0.4).collect()
    assert len(mixed) == 3000
    total = sum(r["tokens"] for r in mixed)
    mass = sum(r["expected"] * r["tokens"] for r in mixed)
    assert abs(mass / total - 0.4) < 1e-4
    for d, goal in (("source", targets["source"]), ("lang", targets["lang"])):
        for v, share in goal.items():
            assert abs(sum(r["expected"] * r["tokens"] for r in mixed if r[d] == v) / mass - share) < 1e-3
    assert abs(sum(r["copies"] for r in mixed) - sum(r["expected"] for r in mixed)) < 4 * 3000**0.5
    assert all(0 <= r["copies"] - int(r["expected"]) <= 1 for r in mixed)
    with pytest.warns(UserWarning, match="don't fit together"):
        none = mixing.mix(docs, {"source": {"s0": 1.0}, "lang": {"xx": 1.0}}).collect()
    assert sum(r["copies"] for r in none) == 0
    none = mixing.mix(docs, {"source": {"s9": 1.0}}).collect()
    assert sum(r["copies"] for r in none) == 0


def test_mix_edges(edge_docs, edge_rows, no_docs):
    mixed = mixing.mix(edge_docs).collect()
    assert len(mixed) == len(edge_rows)
    assert all(r["copies"] == 0 for r in mixed if not r["tokens"])
    by = {}
    for r in mixed:
        assert by.setdefault((r["row"]["doc_id"], r["row"]["text"]), r["copies"]) == r["copies"]
    drawn = mixing.sample(edge_docs)
    clash = mixing.sample(edge_docs.selectExpr("*", "'mine' as copies", "doc_id % 2 as topic"), by=F.col("topic"))
    assert clash.columns == [*edge_docs.columns, "topic", "copies", "expected"] and dict(clash.dtypes)["copies"] == "bigint" and clash.count()
    assert drawn.columns == [*edge_docs.columns, "copies", "expected"] and drawn.count() == sum(r["copies"] > 0 for r in mixed)
    assert mixing.mix(no_docs).collect() == []


def test_sql_agrees_on_small_tables(spark, edge_rows):
    rows = [(k, t) for k, t in dict(edge_rows).items() if k is not None]
    docs = make_docs(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"n_chars": "float"}))
    want = sorted(con.execute(oracle_sql()["op1_mix"]).fetchall())
    got = sorted(tuple(r) for r in mixing.mix(docs).select("row.doc_id", "source", "lang", "topic", "tokens", "expected", "copies").collect())
    assert [r[:5] + r[6:] for r in got] == [r[:5] + r[6:] for r in want]
    assert [r[5] for r in got] == pytest.approx([float(r[5]) for r in want], abs=2e-6)
    want = sorted(con.execute(oracle_sql()["op6_line_dedup"]).fetchall())
    got = line_dedup.line_dedup(docs).drop("row").collect()
    assert sorted((*tuple(r)[:5], hashlib.sha256((r["kept"] or "").encode()).hexdigest()) for r in got) == want


# Toxicity

BAD = ["idiot", "trottel", "crétin"]


def labelled(spark, n, seed):
    draw = np.random.default_rng(seed)
    rows, labels = [], []
    for k in range(n):
        words = [f"w{x}" for x in draw.integers(0, 300, draw.integers(5, 60))]
        low, bad = bool(draw.random() < 0.2), bool(draw.random() < 0.2)
        words += ["buy", "now"] * low + [BAD[x] for x in draw.integers(0, 3, 2)] * bad
        draw.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if low else 1, int(bad)))
    return make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {k: (low, bad) for k, low, bad in labels}


CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def test_chain_on_held_out_documents(spark):
    docs, labels, _ = labelled(spark, 1200, 1)
    chain = toxicity.train(docs, labels, CATEGORIES, sample=1000)
    assert chain.categories == ("low_quality", "toxic") and len(chain.weights[1]) == len(chain.vocabulary) + 2
    new, _, truth = labelled(spark, 600, 2)
    out = toxicity.score(new, chain).collect()
    assert len(out) == 600
    right = np.mean([(r["p_toxic"] >= 0.5) == bool(truth[r["doc_id"]][1]) for r in out])
    assert right >= 0.99
    assert np.mean([(r["p_low_quality"] >= 0.5) == (truth[r["doc_id"]][0] == 0) for r in out]) >= 0.99
    kept = {r["doc_id"] for r in toxicity.reject(new, chain, "toxic").collect()}
    assert kept == {r["doc_id"] for r in out if r["p_toxic"] < 0.5}


def test_clear_words_of_small_label_tables(spark):
    """80 labelled documents, 10 toxic, each clear word in 3 or 4 of the toxic ones only: chi-square 22 to 30."""
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 300, 40)) for _ in range(80)]
    rows = [(k, t + f" {BAD[k % 3]}" * (k < 10)) for k, t in enumerate(texts)]
    labels = spark.createDataFrame([(k, int(k % 2), int(k < 10)) for k in range(80)], "doc_id long, quality int, toxic int")
    docs = make_docs(spark, rows)
    chain = toxicity.train(docs, labels, CATEGORIES)
    assert {x.encode() for x in BAD} <= set(chain.vocabulary) and len(chain.vocabulary) <= 5
    out = toxicity.score(docs, chain).collect()
    assert all((r["p_toxic"] >= 0.5) == (r["doc_id"] < 10) for r in out)


def test_toxicity_edges(spark, edge_docs, edge_rows, no_docs):
    odd = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, None, 1), (None, 1, 1), (99, 1, 1), (25, 0, 0), (16, 1, 0), (17, 0, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(edge_docs, odd, CATEGORIES)
    assert toxicity.score(edge_docs, chain).count() == len(edge_rows)
    for docs, labels in ((edge_docs, odd.limit(0)), (no_docs, odd)):
        chain = toxicity.train(docs, labels, CATEGORIES)
        assert toxicity.score(edge_docs, chain).count() == len(edge_rows) and toxicity.score(no_docs, chain).collect() == []
    assert toxicity.reject(edge_docs, chain, "toxic").columns == edge_docs.columns


def test_out_of_fold_predictions_feed_the_next_model():
    draw = np.random.default_rng(4)
    x = draw.random((400, 3))
    y = np.stack([(x[:, 0] + draw.normal(0, 0.1, 400) > 0.5), (x[:, 0] > 0.5)], 1).astype(float)
    weights = toxicity.fit_chain(x, y, np.arange(400) % 5)
    assert [len(w) for w in weights] == [4, 5]
    p = toxicity.Chain(("a", "b"), {b"x": 0, b"y": 1, b"z": 2}, weights).predict(x)
    assert ((p[:, 1] > 0.5) == y[:, 1]).mean() > 0.9


def test_chain_matches_a_plain_one(spark):
    """The trained chain against one written plainly: words chosen by dictionaries, models fitted by many small gradient steps."""
    docs, labels, truth = labelled(spark, 300, 9)
    chain = toxicity.train(docs, labels, CATEGORIES)
    rows = sorted((r["doc_id"], r["text"].split()) for r in docs.collect())
    fold = {r[0]: r[1] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id, 1), {toxicity.FOLDS})").collect()}
    y = np.array([(1 - truth[k][0], truth[k][1]) for k, _ in rows], float)
    df = {}
    for _, t in rows:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    tested = sum(n >= toxicity.LEAST_DOCS for n in df.values())

    def words_of(c, without):
        own = [(set(t), y[i, c]) for i, (k, t) in enumerate(rows) if fold[k] != without]
        n, p = len(own), sum(v for _, v in own)
        out = []
        for w in df:
            a, d = sum(v for t, v in own if w in t), sum(w in t for t, _ in own)
            if toxicity.LEAST_DOCS <= d < n and round(n * (a * n - d * p) ** 2 / (d * (n - d) * p * (n - p)), 6) >= toxicity.least_chi2(tested):
                out.append(w)
        return sorted(out)

    def fitted(x, t):
        x = np.hstack([x, np.ones((len(x), 1))])
        ridge = np.append(np.full(x.shape[1] - 1, toxicity.RIDGE), 1e-6)
        w, rate = np.zeros(x.shape[1]), 1 / (0.25 * np.linalg.norm(x, 2) ** 2 + 1)
        v, k = w.copy(), 0
        for k in range(60_000):
            new = v - rate * (x.T @ (1 / (1 + np.exp(-(x @ v))) - t) + ridge * v)
            v, w = new + k / (k + 3) * (new - w), new
        return lambda z: 1 / (1 + np.exp(-(np.hstack([z, np.ones((len(z), 1))]) @ w)))

    x_of = lambda ws: np.log1p(np.array([[t.count(w) for w in ws] for _, t in rows], float).reshape(len(rows), len(ws)))
    folds = np.array([fold[k] for k, _ in rows])
    out = np.zeros(len(rows))
    for k in range(toxicity.FOLDS):
        x = x_of(words_of(0, k))
        out[folds == k] = fitted(x[folds != k], y[folds != k, 0])(x[folds == k])
    low, bad = x_of(words_of(0, None)), x_of(words_of(1, None))
    p0 = fitted(low, y[:, 0])(low)
    p1 = fitted(np.hstack([bad, out[:, None]]), y[:, 1])(np.hstack([bad, p0[:, None]]))
    got = {r["doc_id"]: (r["p_low_quality"], r["p_toxic"]) for r in toxicity.score(docs, chain).collect()}
    assert sorted(chain.vocabulary) == sorted(w.encode() for w in {*words_of(0, None), *words_of(1, None)})
    assert max(abs(got[k][0] - a) for (k, _), a in zip(rows, p0, strict=True)) < 0.01
    assert max(abs(got[k][1] - a) for (k, _), a in zip(rows, p1, strict=True)) < 0.02
