"""Toxicity by a classifier chain.

Categories are predicted in order by linear (logistic) models over word counts; each model also gets the probabilities of the categories
before it. A later model is trained on out-of-fold predictions of the earlier ones, so that it sees them as wrong as they will be on
new texts; in use it gets those of the models trained on all folds. A fold's predictions come from models that have seen none of it: their feature words are
chosen from the other folds' counts too.

Training takes at most SAMPLE labelled documents (those with the smallest hash of their id; repeated texts count once), read once and written to the shared
folder. Spark counts their words by fold and category; the MOST_WORDS words of largest chi-square of each category, if it is significant, are a model's
features. SAMPLE and MOST_WORDS are parameters of the fit: they bound what the driver holds to SAMPLE rows of some hundred counts. On the driver's labels
(sf0.1, 8,574 rows) 150 words a category are more than are significant there, so that MOST_WORDS drops none. Every document is scored alone, as a whole, with no shuffle.

A null or empty text has no words and gets the models' intercept. Very long texts count like others, by their words. Labels that are null, or of unknown documents, don't
count; of repeated labels the largest counts, and repeated documents are scored alike, each on its own row. Of words with equal chi-square the smaller one goes first.
With no labels, or one class only, a category's probability is that class's smoothed share. Further columns of any name don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, batch_type, words

SAMPLE = 8_000
MOST_WORDS = 150
#: Level at which a word that is to be a feature is significant by chi-square, shared out over all words tested, and its least documents.
LEVEL, LEAST_DOCS = 0.05, 3
FOLDS = 5
#: L2 penalty of a weight, in units of one document.
RIDGE = 0.02
THRESHOLD = 0.5


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Weights, the intercept last, by Newton's method with step halving."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return np.append(np.zeros(x.shape[1]), np.log(p / (1 - p)))
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    w = np.zeros(x.shape[1])
    loss = lambda v: np.logaddexp(0, -(2 * y - 1) * (x @ v)).sum() + 0.5 * (penalty * v * v).sum()
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        move = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        rate = 1.0
        while (new := loss(w - rate * move)) > now and rate > 1e-4:
            rate /= 2
        w, gain, now = w - rate * move, now - new, new
        if gain < 1e-6 * max(1.0, now):
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass(frozen=True)
class Chain:
    """vocabulary: word to column; weights: by category, over the columns, the earlier categories' probabilities and 1."""

    categories: tuple[str, ...]
    vocabulary: dict[bytes, int]
    weights: tuple[np.ndarray, ...]

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)))
        get = self.vocabulary.get
        for i, text in enumerate(texts):
            for j, n in Counter(map(get, words(text))).items():
                if j is not None:
                    x[i, j] = n
        return np.log1p(x)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """[rows, categories] of probabilities."""
        p = np.zeros((len(x), 0))
        for w in self.weights:
            p = np.hstack([p, probability(np.hstack([x, p]), w)[:, None]])
        return p


def _fit(x: np.ndarray, known: np.ndarray, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """A model over the columns that ``use`` names and the earlier categories' probabilities, ``known``; the other columns weigh nothing."""
    w = np.zeros(x.shape[1] + known.shape[1] + 1)
    at = np.concatenate([use, np.arange(x.shape[1], len(w))])
    w[at] = fit_logistic(np.hstack([x[:, use], known]), y)
    return w


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int = FOLDS, use: list[list[np.ndarray]] | None = None) -> tuple[np.ndarray, ...]:
    """y: [rows, categories]. use[c][k]: the columns of category c chosen without fold k, last those chosen from all; without it, all columns.

    known holds the out-of-fold probabilities of the categories so far. They, and not fitted ones, train the next model."""
    use = use or [[np.arange(x.shape[1])] * (folds + 1)] * y.shape[1]
    weights, known = [], np.zeros((len(x), 0))
    for c in range(y.shape[1]):
        weights.append(_fit(x, known, y[:, c], use[c][folds]))
        if c + 1 < y.shape[1]:
            out = np.zeros(len(x))
            for k in range(folds):
                held = fold == k
                if held.any():
                    out[held] = probability(np.hstack([x, known])[held], _fit(x[~held], known[~held], y[~held, c], use[c][k]))
            known = np.hstack([known, out[:, None]])
    return tuple(weights)


def least_chi2(tested: int, level: float = LEVEL) -> float:
    """The chi-square (1 degree of freedom) that any of so many words without a link to the category reaches with at most this probability."""
    return NormalDist().inv_cdf(level / max(1, tested) / 2) ** 2


def labelled(docs: DataFrame, labels: DataFrame, categories: dict[str, str], key: str, text: str, sample: int) -> DataFrame:
    """(_key, _text, _y0, ..., _fold): at most ``sample`` labelled documents, repeated texts once, with their smallest key and largest labels."""
    flags = [F.max(F.coalesce(F.expr(c), F.lit(False)).cast("int")).alias(f"_y{k}") for k, c in enumerate(categories.values())]
    known = labels.where(" and ".join(f"({c}) is not null" for c in categories.values())).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*flags)
    # At most `sample` rows of a few integers: a proven bound.
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    own = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), "_key")
    once = own.groupBy(F.coalesce("_text", F.lit("")).alias("_text")).agg(F.min("_key").alias("_key"), *(F.max(f"_y{k}").alias(f"_y{k}") for k in range(len(flags))))
    return once.withColumn("_fold", F.pmod(F.xxhash64("_key", F.lit(1)), F.lit(FOLDS)).cast("int"))


def choose_words(counts: DataFrame, totals: list, c: str, fold: int | None, tested: int, most: int) -> list[bytes]:
    """The words that tell category c best, from all rows but fold's. counts: _word, n_<fold>, <category>_<fold>; totals: (fold, rows, positives...)."""
    at = int(c[2:])
    rest = [k for k in range(FOLDS) if k != fold]
    n, p = (sum(t[i] for t in totals if t[0] in rest) for i in (1, 2 + at))
    if not 0 < p < n:
        return []
    df, a = (sum((F.col(f"{x}_{k}") for k in rest), F.lit(0)).cast("double") for x in ("n", c))
    chi2 = n * F.pow(F.col("a") * n - F.col("df") * p, 2) / (F.col("df") * (n - F.col("df")) * p * (n - p))
    own = counts.select("_word", a.alias("a"), df.alias("df")).where((F.col("df") >= LEAST_DOCS) & (F.col("df") < n)).select("_word", F.round(chi2, 6).alias("_chi2"))
    best = own.where(F.col("_chi2") >= least_chi2(tested)).orderBy(F.desc("_chi2"), "_word").limit(most)
    return [bytes(w) for w, _ in best.collect()]


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], key: str = "doc_id", text: str = "text", sample: int = SAMPLE, most_words: int = MOST_WORDS) -> Chain:
    """categories: name to SQL condition over the labels, in the chain's order."""
    names = tuple(categories)
    columns = [f"_y{k}" for k in range(len(names))]
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.put(labelled(docs, labels, categories, key, text, sample), "sample")
    totals = [tuple(r) for r in rows.groupBy("_fold").agg(F.count("*"), *(F.sum(c) for c in columns)).collect()]
    if not totals:
        scratch.drop("sample")
        return Chain(names, {}, tuple(fit_logistic(np.zeros((0, k)), np.zeros(0)) for k in range(len(names))))

    def distinct_words(batches):
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch["_text"]):
                got = set(words(value.as_py()))
                at += [i] * len(got)
                found += got
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *(batch[c].take(at) for c in ("_fold", *columns))], names=["_word", "_fold", *columns])

    each = rows.select("_text", "_fold", *columns).mapInArrow(distinct_words, "_word binary, _fold int, " + ", ".join(f"{c} int" for c in columns))
    in_fold = lambda k, c: F.sum(F.when(F.col("_fold") == k, c).otherwise(0)).alias
    sums = [in_fold(k, F.lit(1))(f"n_{k}") for k in range(FOLDS)] + [in_fold(k, F.col(c))(f"{c}_{k}") for k in range(FOLDS) for c in columns]
    counts = scratch.put(each.groupBy("_word").agg(F.count("*").alias("_df"), *sums).where(F.col("_df") >= LEAST_DOCS), "counts")
    tested = counts.count()
    chosen = [[choose_words(counts, totals, c, k, tested, most_words) for k in (*range(FOLDS), None)] for c in columns]
    vocabulary: dict[bytes, int] = {}
    for w in (w for one in chosen for found in reversed(one) for w in found):
        vocabulary.setdefault(w, len(vocabulary))
    use = [[np.array(sorted(vocabulary[w] for w in found), int) for found in one] for one in chosen]
    chain = Chain(names, vocabulary, ())

    def counted(batches):
        for batch in batches:
            x = chain.features(batch["_text"].to_pylist())
            cells = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays([batch["_key"], pa.array([c.astype(np.int32) for c in cells], pa.list_(pa.int32())), pa.array([r[c] for r, c in zip(x, cells, strict=True)], pa.list_(pa.float64())), *(batch[c] for c in (*columns, "_fold"))], names=["_key", "_at", "_x", *columns, "_fold"])

    kind = dict(rows.dtypes)["_key"]
    held = rows.mapInArrow(counted, f"_key {kind}, _at array<int>, _x array<double>, " + ", ".join(f"{c} int" for c in (*columns, "_fold"))).orderBy("_key", "_at").collect()
    scratch.drop("sample", "counts")
    x, y = np.zeros((len(held), len(vocabulary))), np.array([[r[c] for c in columns] for r in held], float).reshape(len(held), len(names))
    for i, r in enumerate(held):
        x[i, r["_at"]] = r["_x"]
    weights = fit_chain(x, y, np.array([r["_fold"] for r in held]), use=use)
    # Words that only some folds chose weigh nothing in the final models.
    final = sorted({k for one in use for k in one[FOLDS].tolist()})
    by_column = {k: w for w, k in vocabulary.items()}
    keep = lambda w: np.concatenate([w[final], w[len(vocabulary) :]])
    return Chain(names, {by_column[k]: i for i, k in enumerate(final)}, tuple(map(keep, weights)))


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and p_<category> of each category (rounded to 6 digits)."""
    kind = dict(docs.dtypes)[key]
    names = [key, *(f"p_{c}" for c in chain.categories)]

    def run(batches):
        for batch in batches:
            p = chain.predict(chain.features(batch[1].to_pylist())).round(6)
            yield pa.RecordBatch.from_arrays([batch[0].cast(batch_type(kind)), *(pa.array(p[:, k], pa.float64()) for k in range(p.shape[1]))], names=names)

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{c} double" for c in names[1:]))


def reject(docs: DataFrame, chain: Chain, category: str, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose probability of the category is under the threshold, all columns as they are."""
    at, k = docs.columns.index(text), chain.categories.index(category)

    def run(batches):
        for batch in batches:
            p = chain.predict(chain.features(batch[at].to_pylist()))[:, k]
            yield batch.filter(pa.array(p < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
