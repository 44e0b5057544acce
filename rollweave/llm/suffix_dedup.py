"""Long repeated strings, removed but for their first place: content-defined anchors find where, run-length indexes decide.

A string of LENGTH bytes that also starts earlier (a smaller key, or the same document and an earlier start) is covered byte by byte.

Each document gives anchors: of any LENGTH - GRAM + 1 neighbouring GRAM-byte grams that with the least hash is one, so equal strings of LENGTH
bytes hold an anchor at the same offset. All that such a string can reach around an anchor is its context of up to ``LENGTH - GRAM``
bytes on both sides. Only grams that stand at more than one place matter; of equal contexts the first place is kept as
their example, and every later one is covered whole. What is left are grams with several contexts. Their examples (context bytes) are
dealt by gram, and each task builds run-length indexes over its contexts, streams matching statistics and marks the strings
that start earlier in another context. A gram with more than CROWD contexts is split by the CUT bytes after and those before it: a string
holds the one or the other.

A part with more than MOST contexts even so (a very common passage of 66 bytes) isn't gathered in one task: its strings' 128-bit digests are grouped by Spark, the
least place of each by partial aggregation.

Hashes and places are shuffled, not texts; examples are as many as there are places where copies begin to differ. A task's index is bounded by the
number of partitions, which follows the count of contexts, and by MOST. The text itself is shuffled twice, to its contexts and to its marks.

What an index marks has been compared byte by byte; equal contexts are equal by their gram's and their own 64-bit hashes, and the strings of very common parts by their digests.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, batch_type, deal_join
from .run_index import later_matches

LENGTH = 100
GRAM = 32
SIDE = LENGTH - GRAM
#: A string's SIDE bytes beside the anchor hold at least CUT on one side.
CUT = SIDE // 2
CROWD = 256
#: Contexts of one part that a task may hold.
MOST = 5_000
#: Contexts for each partition of the index step.
CONTEXTS = 10_000
#: Contexts for each run-length index in it, unless one key has more.
INDEXED = 500
#: Bytes whose anchors are looked for at once, but for longer texts.
PIECE = 1_000_000

_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_FACTORS = np.random.default_rng(20240301).integers(0, 1 << 64, GRAM.bit_length() - 1, np.uint64) | np.uint64(1)
#: Bytes that are worked on at once, so that the arrays stay in a core's cache. The anchors don't depend on it.
BLOCK = 1 << 15
_LOW = np.uint64((1 << 16) - 1)
#: Places in a block, downwards.
_DOWN = _LOW - np.arange(BLOCK + SIDE, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the GRAM bytes from each place on, by doubling; shorter ones at the end are cut off.

    Sums of random table values times odd factors of their places, scrambled: hashes of one changed byte always differ.
    """
    out = np.empty(max(0, len(data) - GRAM + 1), np.uint64)
    for a in range(0, len(out), BLOCK):
        h, size = _TABLE[data[a : a + BLOCK + GRAM - 1]], 1
        for factor in _FACTORS:
            ahead = h[size:]
            h = h[:-size] * factor
            h += ahead
            size *= 2
        out[a : a + BLOCK] = mix(h)
    return out


def _least_places(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of SIDE + 1 neighbouring grams: the first one of each run of windows whose least hash stands at one place, and that place."""
    n = len(grams) - SIDE
    begins, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, n, BLOCK):
        # Least hash first, of equal ones the last place: places count in the low bits, downwards.
        least = grams[a : a + BLOCK + SIDE] & ~_LOW
        least |= _DOWN[: len(least)]
        window = 1
        while window * 2 <= SIDE + 1:
            least = np.minimum(least[:-window], least[window:])
            window *= 2
        rest = SIDE + 1 - window
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        begins.append(first + a)
        places.append((_LOW - (least[first] & _LOW)).astype(np.int64) + a)
    begin, place = np.concatenate(begins), np.concatenate(places)
    fresh = np.ones(len(place), bool)
    fresh[1:] = place[1:] != place[:-1]
    return begin[fresh], place[fresh]


def anchors(texts: list[bytes], contexts: bool = True) -> tuple[np.ndarray, ...]:
    """(text, place, gram, context) of every anchor; context is a hash of the bytes around it and of their number, left out if not asked for."""
    texts_long = [k for k, t in enumerate(texts) if len(t) >= LENGTH]
    if not texts_long:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * (1 + contexts)
    sizes = np.array([len(texts[k]) for k in texts_long], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.frombuffer(b"".join(texts[k] for k in texts_long), np.uint8)
    grams = gram_hashes(data)
    begin, place = _least_places(grams)
    # Windows inside one text only. Windows of one place that begin behind a text's last one go on to the next text's first one, if they reach it.
    owner = np.searchsorted(ends, begin, "right")
    outside = begin + LENGTH > ends[owner]
    inside = ~outside | (ends[owner] < np.append(begin[1:], len(grams) - SIDE))
    place, owner = place[inside], (owner + outside)[inside]
    if not contexts:
        return np.array(texts_long, np.int64)[owner], place - starts[owner], grams[place]
    from_, to = np.maximum(place - SIDE, starts[owner]), np.minimum(place + GRAM + SIDE, ends[owner])
    context = (place - from_).astype(np.uint64) * np.uint64(1000) + (to - place).astype(np.uint64)
    # GRAM-byte hashes at overlapping places cover the context.
    for k in range(-SIDE, SIDE + 1, GRAM):
        context = mix(context * np.uint64(0x9E3779B97F4A7C15) + grams[np.clip(place + k, from_, to - GRAM)])
    context = mix(context + grams[to - GRAM])
    return np.array(texts_long, np.int64)[owner], place - starts[owner], grams[place], context


def _pieces(texts: list[bytes]):
    """(first, end) of neighbouring texts that make at most PIECE bytes, or are one longer text."""
    first = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            yield first, k
            first, size = k, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("_key"), F.xxhash64(own).alias("_fp"), own.cast("binary").alias("_data"))


def _grams(source: DataFrame) -> DataFrame:
    """(gram, n), already counted in each batch."""

    def run(batches):
        for batch in batches:
            texts = batch[0].to_pylist()
            grams = np.concatenate([np.zeros(0, np.uint64), *(anchors(texts[a:b], contexts=False)[2] for a, b in _pieces(texts))])
            grams, n = np.unique(grams, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return source.select("_data").mapInArrow(run, "gram bigint, n bigint")


def _places(source: DataFrame, kind: str) -> DataFrame:
    """(gram, context, _key, _fp, place)."""

    def run(batches):
        for batch in batches:
            texts = batch[2].to_pylist()
            for a, b in _pieces(texts):
                owner, place, grams, context = anchors(texts[a:b])
                owner = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)), batch[0].cast(batch_type(kind)).take(owner), batch[1].take(owner), pa.array(place.astype(np.int32))], names=["gram", "context", "_key", "_fp", "place"])

    return source.select("_key", "_fp", "_data").mapInArrow(run, f"gram bigint, context bigint, _key {kind}, _fp bigint, place int")


def _with_text(source: DataFrame, per_text: DataFrame, how: str) -> DataFrame:
    """per_text: (_pkey, _pfp, ...)."""
    return source.join(per_text, (F.col("_fp") == F.col("_pfp")) & F.equal_null("_key", "_pkey"), how)


def _contexts(source: DataFrame, examples: DataFrame, kind: str) -> DataFrame:
    """examples: (gram, crowded, _key, _fp, place). Returns (part, _key, _fp, begin, anchor, data) with a row, or two if crowded, for each; anchor: where the gram stands in data."""
    wanted = examples.groupBy(F.col("_key").alias("_pkey"), F.col("_fp").alias("_pfp")).agg(F.collect_list(F.struct("gram", "crowded", "place")).alias("wanted"))

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for key, fp, data, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for w in wanted:
                    p = w["place"]
                    a, b = max(0, p - SIDE), min(len(data), p + GRAM + SIDE)
                    parts = [w["gram"]]
                    if w["crowded"]:
                        sides = (data[p - CUT : p] if p - CUT >= a else None, data[p + GRAM : p + GRAM + CUT] if p + GRAM + CUT <= b else None)
                        parts = [int.from_bytes(hashlib.blake2b(s + data[p : p + GRAM], digest_size=8, person=name).digest(), "big", signed=True) for s, name in zip(sides, (b"before", b"after"), strict=True) if s is not None]
                    for part in parts:
                        for column, value in zip(out, (part, key, fp, a, p - a, data[a:b]), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], batch_type(kind)), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.int32()), pa.array(out[5], pa.binary())], names=["part", "_key", "_fp", "begin", "anchor", "data"])

    # Repeated rows give their contexts again, at equal places, which is no earlier.
    rows = _with_text(source, wanted, "inner").select("_key", "_fp", "_data", "wanted")
    return rows.mapInArrow(run, f"part bigint, _key {kind}, _fp bigint, begin int, anchor int, data binary")


def spans_of(starts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of the spans covered by ``length`` bytes from each of a text's sorted starts on."""
    text, start = np.repeat(np.arange(len(starts)), [len(x) for x in starts]), np.concatenate([np.zeros(0, np.int64), *starts])
    first = np.ones(len(start), bool)
    first[1:] = (text[1:] != text[:-1]) | (start[1:] - start[:-1] > length)
    return text[first], start[first], start[np.append(first[1:], True)[: len(start)]] + length


def _indexed(contexts: DataFrame, kind: str) -> DataFrame:
    """Runs over partitions sorted by part. Returns (_key, _fp, begin, end): bytes that are covered."""

    def flush(keys, fps, begins, texts):
        # Null keys come last.
        known = sorted({k for k in keys if k is not None})
        rank = {k: i for i, k in enumerate(known)} | {None: len(known)}
        late = later_matches(texts, np.array([rank[k] for k in keys]), np.array(begins), LENGTH)
        of, begin, end = spans_of(late, LENGTH)
        at, of_row = np.array(begins)[of], pa.array(of)
        return pa.RecordBatch.from_arrays([pa.array(keys, batch_type(kind)).take(of_row), pa.array(fps, pa.int64()).take(of_row), pa.array((at + begin).astype(np.int32)), pa.array((at + end).astype(np.int32))], names=["_key", "_fp", "begin", "end"])

    def sides(anchor, data):
        yield "before", data[anchor - CUT : anchor] if anchor >= CUT else None
        yield "after", data[anchor + GRAM : anchor + GRAM + CUT] if anchor + GRAM + CUT <= len(data) else None

    def sharing(rows):
        """The rows of one part that share CUT bytes on one side with another one; no others can share a string of LENGTH bytes."""
        seen = Counter(s for *_, anchor, data in rows for s in sides(anchor, data) if s[1] is not None)
        return [(key, fp, begin, data) for key, fp, begin, anchor, data in rows if any(seen[s] > 1 for s in sides(anchor, data))]

    def run(batches):
        held, rows, last = [], [], None
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != last:
                    held += sharing(rows)
                    rows, last = [], part
                    if len(held) >= INDEXED:
                        yield flush(*zip(*held, strict=True))
                        held = []
                rows.append(row)
        held += sharing(rows)
        if held:
            yield flush(*zip(*held, strict=True))

    return contexts.mapInArrow(run, f"_key {kind}, _fp bigint, begin int, end int")


def _by_digest(contexts: DataFrame, kind: str) -> DataFrame:
    """As _indexed, for parts of any size: every string of LENGTH bytes by its digest."""

    def run(batches):
        for batch in batches:
            at, digests, places = [], [], []
            for i, (begin, data) in enumerate(zip(batch[2].to_pylist(), batch[3].to_pylist(), strict=True)):
                for k in range(len(data) - LENGTH + 1):
                    at.append(i)
                    digests.append(hashlib.blake2b(data[k : k + LENGTH], digest_size=16).digest())
                    places.append(begin + k)
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch[0].take(at), batch[1].take(at), pa.array(places, pa.int32())], names=["digest", "_key", "_fp", "begin"])

    strings = contexts.select("_key", "_fp", "begin", "data").mapInArrow(run, f"digest binary, _key {kind}, _fp bigint, begin int")
    place = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("begin").alias("p"))
    first = strings.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first != final").select("digest", "first")
    later = deal_join(strings, first, ["digest"]).where((F.col("_key").isNull() != F.col("first.n")) | ~F.equal_null("_key", F.col("first.k")) | (F.col("begin") != F.col("first.p")))
    return later.select("_key", "_fp", "begin", (F.col("begin") + LENGTH).alias("end")).distinct()


def repeated_spans(docs: DataFrame, key: str, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(_key, _fp, place) of the anchors whose whole context is covered, and (_key, _fp, begin, end) of further covered bytes."""
    source, kind = _source(docs, key, text), dict(docs.dtypes)[key]
    repeated = scratch.put(_grams(source).groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "repeated")
    places = scratch.put(_places(source, kind).join(repeated, "gram"), "places")
    at = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("place").alias("p"), F.col("_fp").alias("f"))
    classes = scratch.put(places.groupBy("gram", "context").agg(F.min(at).alias("first"), F.count("*").alias("m")), "classes")
    spread = classes.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
    examples = deal_join(classes, spread, ["gram"]).select("gram", (F.col("c") > CROWD).alias("crowded"), F.col("first.k").alias("_key"), F.col("first.f").alias("_fp"), F.col("first.p").alias("place"))
    contexts = scratch.put(_contexts(source, examples, kind), "contexts")
    parts = max(1, -(-contexts.count() // CONTEXTS))
    large = scratch.put(contexts.groupBy("part").agg(F.count("*").alias("m")).where(F.col("m") > MOST).select("part"), "large")
    if large.isEmpty():
        spans = _indexed(contexts.repartition(parts, "part").sortWithinPartitions("part"), kind)
    else:
        rest = contexts.join(large.hint("merge"), "part", "left_anti")
        spans = _indexed(rest.repartition(parts, "part").sortWithinPartitions("part"), kind).unionByName(_by_digest(contexts.join(large.hint("merge"), "part"), kind))
    spans = scratch.put(spans, "spans")
    scratch.drop("contexts", "repeated", "large")
    twice = classes.where("m > 1").select("gram", "context", "first")
    later = places.join(twice, ["gram", "context"]).where((F.col("_key").isNull() != F.col("first.n")) | ~F.equal_null("_key", F.col("first.k")) | (F.col("place") != F.col("first.p")))
    covered = scratch.put(later.groupBy("_key", "_fp").agg(F.collect_list("place").alias("places")), "covered")
    scratch.drop("places", "classes")
    return covered, spans


SCHEMA = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and if asked for kept (binary) and spans.

    Null counts as an empty text. Null keys come last. Rows with one key count as one document: equal starts in them aren't earlier,
    so repeated rows lose the same bytes. Texts under LENGTH bytes lose nothing. Extra columns don't matter.
    """
    kind = dict(docs.dtypes)[key]
    scratch = Scratch(docs.sparkSession, "suffix")
    covered, spans = repeated_spans(docs, key, text, scratch)
    marks = covered.select("_key", "_fp", "places", F.lit(None).cast("array<struct<begin:int,end:int>>").alias("spans"))
    marks = marks.unionByName(spans.groupBy("_key", "_fp").agg(F.collect_list(F.struct("begin", "end")).alias("spans")).select("_key", "_fp", F.lit(None).cast("array<int>").alias("places"), "spans"))
    marks = marks.groupBy(F.col("_key").alias("_pkey"), F.col("_fp").alias("_pfp")).agg(F.flatten(F.collect_list("places")).alias("places"), F.flatten(F.collect_list("spans")).alias("spans"))
    extra = ", kept binary, spans array<struct<begin:int,end:int>>" if keep_text else ""

    def run(batches):
        for batch in batches:
            out = []
            for data, places, found in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                gone, n = [], len(data)
                if places or found:
                    p = np.array(places or [], np.int64)
                    a = np.concatenate([np.maximum(p - SIDE, 0), np.array([x["begin"] for x in found or []], np.int64)])
                    b = np.concatenate([np.minimum(p + GRAM + SIDE, n), np.array([x["end"] for x in found or []], np.int64)])
                    by = np.argsort(a, kind="stable")
                    a, b = a[by], np.maximum.accumulate(b[by])
                    cut = np.flatnonzero(a[1:] > b[:-1])
                    gone = list(zip(a[np.concatenate([[0], cut + 1])].tolist(), b[np.concatenate([cut, [len(b) - 1]])].tolist(), strict=True))
                kept = b"".join(data[x:y] for x, y in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), n], strict=True))
                out.append((n, n - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), *([kept, [{"begin": a, "end": b} for a, b in gone]] if keep_text else [])))
            cols = list(zip(*out, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch[0].cast(batch_type(kind)), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    types = [pa.int64()] * 3 + [pa.string()] + [pa.binary(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))] * keep_text
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"] * keep_text]
    rows = _with_text(_source(docs, key, text), marks, "left").select(F.col("_key").alias(key), "_data", "places", "spans")
    return rows.mapInArrow(run, f"{key} {kind}, {SCHEMA}{extra}")
