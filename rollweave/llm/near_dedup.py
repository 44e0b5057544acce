"""Near duplicates: MinHash bands propose, odd sketches sift, whole shingle sets confirm, stars join up.

A document's set holds its distinct 5-word shingles. Documents of equal sets are one node from the start, so copies cost no pairs.
Each node has SAMPLES MinHash values. BANDS bands of ROWS of them deal nodes into buckets; two sets of similarity 0.75 meet in one with
probability 1 - 2e-7. The samples are also folded into an odd sketch, a bitmap in which sample i toggles one bit; the XOR of two
sketches has about ``BITS / 2 * (1 - exp(-4 * SAMPLES * (1 - J) / BITS))`` bits set, so its population count estimates a high similarity J
closely. Pairs whose estimate is under 0.55 (over 4.5 standard deviations off) go, by chance a pair of similarity 0.75 with probability 3e-6;
the others are confirmed on whole sets.

No bucket is expanded into all its pairs. First, each bucket gives a star: its hub, the node that meets others most often, with all others. The confirmed links make
components. What is left to check are pairs of one bucket in different components, so next each bucket gives only the pairs of nodes
outside its largest component with the rest. Buckets with more than CROWD such pairs (texts with a shared passage, or many
edits of one text) aren't paired at all: their nodes are joined by whole sets with a prefix filter, which is exact. A node's shingles that stand in no
other component can't link it; what is left is ordered by how rare it is, and two sets of similarity 0.75 share one of their rarest quarter. Pairs that
odd sketches of the whole sets rule out go, which is exact too. A last pass joins the components.

So two steps go by chance: the bands and the odd sketches of the samples. Sets are compared as 64-bit fingerprints of all their shingles, nodes are 128-bit digests of whole sets.
"""

from __future__ import annotations

import hashlib
import math
import operator
import random
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, batch_type, deal_join
from .components import components

SHINGLE = 5
#: Link if PERCENT * union <= 100 * intersection.
PERCENT = 75
BANDS, ROWS = 40, 4
SAMPLES = BANDS * ROWS
BITS = 512
LEAST_ESTIMATE = 0.55
MOST_DIFFERENT = math.ceil(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - LEAST_ESTIMATE) / BITS)))
#: The nodes of buckets with more pairs than these are joined by their rarest shingles instead.
CROWD = 200
PARITY_WORDS = 16

_M = (1 << 64) - 1
_draw = random.Random(20240229)
_FACTOR = np.array([_draw.getrandbits(64) | 1 for _ in range(SAMPLES)], np.uint64)
_SHIFT = np.array([_draw.getrandbits(64) for _ in range(SAMPLES)], np.uint64)
_ORDER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [pow(0x9E3779B97F4A7C15, SHINGLE - 1 - k, 1 << 64) for k in range(SHINGLE)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the text's shingles. Words are what stands between blanks (bytes 9 to 13 and 32), A-Z lower-cased."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    s = np.zeros(n, np.uint64)
    for k, p in enumerate(_POWERS):
        s += h[k : k + n] * np.uint64(p)
    return np.unique(mix(s))


def minhash(fingerprints: np.ndarray) -> np.ndarray:
    """[SAMPLES] 64-bit values."""
    low = np.full(SAMPLES, _M, np.uint64)
    for k in range(0, len(fingerprints), 256):
        values = np.multiply.outer(_FACTOR, fingerprints[k : k + 256])
        values += _SHIFT[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return mix(low)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """[..., SAMPLES] to [..., BITS / 64] int64: bit k is set if an odd number of the (i, sample i) hash to k."""
    bits = (mix(samples + np.arange(SAMPLES, dtype=np.uint64) * _ORDER) >> np.uint64(64 - 9)).astype(np.int64)
    rows = bits.reshape(-1, SAMPLES)
    flat = np.bincount((rows + np.arange(len(rows))[:, None] * BITS).ravel(), minlength=len(rows) * BITS) & 1
    return np.packbits(flat.astype(np.uint8)).view(np.int64).reshape(*bits.shape[:-1], BITS // 64)


def parity(fingerprints: np.ndarray) -> np.ndarray:
    """An odd sketch of the whole set. Each shingle of one set alone changes one bit, so the XOR of two never has more bits set than
    their sets have shingles apart: a pair ruled out by it isn't linked for sure."""
    bits = (fingerprints & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)).view(np.int64)


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _fp, n, sid, samples, odd), a row per document. samples are folded to 32 bits."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        cache = _WordHash()
        for batch in batches:
            n, sid, low = [], [], []
            for value in batch[2]:
                own = shingles(value.as_py(), cache)
                n.append(len(own))
                sid.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                low.append(minhash(own) if len(own) else np.zeros(SAMPLES, np.uint64))
            low = np.array(low, np.uint64).reshape(len(n), SAMPLES)
            odd = odd_sketch(low)
            folded = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * x.shape[-1], pa.int32()), pa.array(x.ravel(), t))
            yield pa.RecordBatch.from_arrays([batch[0].cast(batch_type(kind)), batch[1], pa.array(n, pa.int64()), pa.array(sid, pa.binary()), lists(folded, pa.int32()), lists(odd, pa.int64())], names=["_key", "_fp", "n", "sid", "samples", "odd"])

    return source(docs, key, text).mapInArrow(run, f"_key {kind}, _fp bigint, n bigint, sid binary, samples array<int>, odd array<bigint>")


def source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text).cast("string")).alias("_fp"), F.col(text).cast("string").alias("_text"))


def whole_sets(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(sid, fingerprints, parity) of the wanted nodes (sid, _at: _key and _fp of one document that has this set)."""

    def run(batches):
        cache = _WordHash()
        for batch in batches:
            found = [shingles(v.as_py(), cache) for v in batch[1]]
            right = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() == s for x, s in zip(found, batch[0].to_pylist(), strict=True)]
            columns = [pa.array([y.view(np.int64) for y in x], pa.list_(pa.int64())) for x in (found, map(parity, found))]
            yield pa.RecordBatch.from_arrays([batch[0], *columns], names=["sid", "fingerprints", "parity"]).filter(pa.array(right, pa.bool_()))

    wanted = wanted.select("sid", F.col("_at._key").alias("_wkey"), F.col("_at._fp").alias("_wfp"))
    rows = source(docs, key, text).join(wanted, (F.col("_fp") == F.col("_wfp")) & F.equal_null("_key", "_wkey"))
    return rows.select("sid", "_text").mapInArrow(run, "sid binary, fingerprints array<bigint>, parity array<bigint>").dropDuplicates(["sid"])


def _similar(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and odd sketches don't rule out."""
    side = lambda x: nodes.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"odd{x}"))
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    different = F.aggregate(F.zip_with("odda", "oddb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return both.where(F.lit(100) * F.least("na", "nb") >= F.lit(PERCENT) * F.greatest("na", "nb")).where(different <= MOST_DIFFERENT).select("a", "b", "na", "nb")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    both = pairs.join(sets.select(F.col("sid").alias("b"), F.col("fingerprints").alias("sb")).hint("merge"), "b").join(sets.select(F.col("sid").alias("a"), F.col("fingerprints").alias("sa")).hint("merge"), "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(F.lit(100) * shared >= F.lit(PERCENT) * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def _keys(nodes: DataFrame) -> DataFrame:
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(j, F.slice("samples", j * ROWS + 1, ROWS)))
    return nodes.select("sid", F.explode(keys).alias("key"))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _left_over(members: DataFrame, component: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """members: (key, sid). Rows (key, sid, comp) of the buckets with several components, and (key, main, pairs): the largest one, and how many
    pairs of nodes outside it with any node there are."""
    with_comp = scratch.put(members.join(component.hint("merge"), members["sid"] == component["node"], "left").select("key", "sid", F.coalesce("root", "sid").alias("comp")), f"{name}-all")
    mixed = with_comp.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("key")
    rows = scratch.put(deal_join(with_comp, mixed, ["key"]), f"{name}-rows")
    scratch.drop(f"{name}-all")
    main = rows.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("all"))
    return rows, scratch.put(main.select("key", F.col("m.comp").alias("main"), ((F.col("all") - F.col("m.n")) * F.col("all")).alias("pairs")), f"{name}-main")


def _cross_pairs(rows: DataFrame, main: DataFrame) -> DataFrame:
    """The pairs of a bucket's nodes outside its main component with its nodes of other components. rows: (key, sid, comp)."""
    rows = rows.join(main.select("key", "main").hint("merge"), "key")
    left = rows.where("comp != main").select("key", F.col("sid").alias("l"), F.col("comp").alias("lc"))
    right = rows.select("key", F.col("sid").alias("r"), F.col("comp").alias("rc"), "main").hint("merge")
    once = (F.col("lc") != F.col("rc")) & ((F.col("rc") == F.col("main")) | (F.col("l") < F.col("r")))
    pairs = left.join(right, (left["key"] == right["key"]) & once)
    return pairs.select(*_ordered(F.col("l"), F.col("r"))).distinct()


def _crowd_pairs(crowd: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """crowd: (sid, comp). All pairs of its nodes in different components that can be linked, by prefix filter.

    A link takes PERCENT of either set's shingles. So a node with fewer shingles that stand in another component too is linked with nothing there, and if
    it has ``spare`` more than that, two linked sets share one of their first spare + 1 in any common order; here rare ones come first."""
    sets = scratch.put(whole_sets(docs, key, text, nodes.select("sid", "_at").join(crowd.select("sid").hint("merge"), "sid")), "crowd-sets")
    own = crowd.join(sets.hint("merge"), "sid")
    each = own.select("sid", "comp", F.explode("fingerprints").alias("f"))
    shared = each.groupBy("f").agg(F.count("*").alias("df"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("f", "df")
    linking = deal_join(each.select("sid", "f"), shared, ["f"]).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("df", "f"))).alias("rare"))
    sized = linking.join(own.select("sid", "comp", F.size("fingerprints").alias("n"), "parity").hint("merge"), "sid")
    spare = F.size("rare") - F.ceil(F.lit(PERCENT) * F.col("n") / 100).cast("int")
    prefix = F.transform(F.slice("rare", F.lit(1), spare + 1), lambda x: x["f"])
    able = scratch.put(sized.where(spare >= 0).select("sid", "comp", "n", "parity", prefix.alias("prefix")), "able")
    side = lambda p: able.select(F.explode("prefix").alias("f"), *(F.col(c).alias(f"{p}_{c}") for c in ("sid", "comp", "n", "parity")))
    apart = reduce(operator.add, (F.bit_count(F.col("l_parity")[k].bitwiseXOR(F.col("r_parity")[k])) for k in range(PARITY_WORDS)))
    near = F.lit(100 + PERCENT) * apart <= F.lit(100 - PERCENT) * (F.col("l_n") + F.col("r_n"))
    sizes = F.lit(100) * F.least("l_n", "r_n") >= F.lit(PERCENT) * F.greatest("l_n", "r_n")
    left, right = side("l"), side("r").withColumnRenamed("f", "g").hint("merge")
    pairs = left.join(right, (F.col("f") == F.col("g")) & (F.col("l_sid") < F.col("r_sid")) & (F.col("l_comp") != F.col("r_comp")) & sizes & near)
    return pairs.select(F.col("l_sid").alias("a"), F.col("r_sid").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id (the smallest key reachable, itself included), kept (key = component_id), and
    set_id (hex; equal sets have equal ids), text_fp.

    Null and blank texts are empty and linked with nothing. Null keys come last: a component's id is null only if all its keys are, and
    then its rows are kept. Rows with the same key are rows like others, so repeated rows all have the key's component.
    """
    scratch = Scratch(docs.sparkSession, "near")
    sketched = scratch.put(sketch(docs, key, text), "sketched")
    nodes = scratch.put(
        sketched.where("n > 0").groupBy("sid").agg(F.min("_key").alias("least"), F.first("n").alias("n"), F.first("samples").alias("samples"), F.first("odd").alias("odd"), F.first(F.struct("_key", "_fp")).alias("_at")),
        "nodes",
    )
    buckets = _keys(nodes)
    shared = buckets.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = scratch.put(deal_join(buckets, shared, ["key"]), "members")
    # The hub of a bucket is its node that meets others most often: the text from which the copies come, if it is there. A node has BANDS keys at most.
    meets = members.groupBy("sid").agg(F.sum(F.col("m") - 1).alias("meets"), F.collect_list("key").alias("keys")).select("sid", "meets", F.explode("keys").alias("key"))
    hubs = meets.groupBy("key").agg(F.max(F.struct("meets", "sid")).alias("hub")).select("key", F.col("hub.sid").alias("hub"))
    stars = deal_join(members.select("key", "sid"), hubs, ["key"]).where("sid != hub").select(*_ordered(F.col("hub"), F.col("sid"))).distinct()
    first = scratch.put(_similar(stars, nodes), "first")
    links = _links(first, nodes, docs, key, text, scratch, "first")
    component = scratch.put(components(links, scratch, "stars"), "component")

    rows, main = _left_over(members.select("key", "sid"), component, scratch, "left")
    pairs = _cross_pairs(rows, main.where(F.col("pairs") <= CROWD))
    crowded = main.where(F.col("pairs") > CROWD).select("key")
    if not crowded.isEmpty():
        crowd = scratch.put(rows.join(crowded.hint("merge"), "key").select("sid", "comp").distinct(), "crowd")
        pairs = scratch.put(pairs.unionByName(_crowd_pairs(crowd, nodes, docs, key, text, scratch)).distinct(), "pairs")
    second = scratch.put(_similar(pairs, nodes).join(first.select("a", "b"), ["a", "b"], "left_anti"), "second")
    more = _links(second, nodes, docs, key, text, scratch, "second")
    root = F.coalesce("root", "x")
    up = lambda df, c: df.select(F.col(c).alias("x"), *[d for d in df.columns if d != c]).join(component.hint("merge"), F.col("x") == F.col("node"), "left").select(root.alias(c), *[d for d in df.columns if d != c])
    joined = scratch.put(components(up(up(more, "a"), "b"), scratch, "rest"), "joined")
    final = nodes.select("sid", "least").join(component.select(F.col("node").alias("sid"), "root").hint("merge"), "sid", "left").select("sid", "least", F.coalesce("root", "sid").alias("c1"))
    final = final.join(joined.hint("merge"), final["c1"] == joined["node"], "left").select("sid", "least", F.coalesce("root", "c1").alias("comp"))
    ids = final.groupBy("comp").agg(F.min("least").alias("_cid"))
    of_set = scratch.put(deal_join(final, ids, ["comp"]).select("sid", "_cid"), "ids")
    scratch.drop("members", "first", "first-links", "second", "second-links", "left-rows", "left-main", "crowd", "crowd-sets", "able", "pairs", "component", "joined")
    rows = sketched.select("_key", "_fp", "n", "sid")
    # Empty documents have no set; they are linked with nothing, and kept apart from the join, where they would be one task's work.
    out = rows.where("sid is not null").join(of_set.hint("merge"), "sid").unionByName(rows.where("sid is null").withColumn("_cid", F.col("_key")))
    return out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("_cid").alias("component_id"), F.equal_null("_key", "_cid").alias("kept"), F.lower(F.hex("sid")).alias("set_id"), F.col("_fp").alias("text_fp"))


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, scratch: Scratch, name: str) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    if pairs.isEmpty():
        return pairs.select("a", "b")
    sets = scratch.put(whole_sets(docs, key, text, nodes.select("sid", "_at").join(wanted.hint("merge"), "sid")), f"{name}-sets")
    links = scratch.put(_confirmed(pairs, sets), f"{name}-links")
    scratch.drop(f"{name}-sets")
    return links


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, one of each component, all columns as they are. Repeated rows of a kept key and text come back once."""
    # Both sides are dealt by the same two fingerprints, so that one shuffle of the documents serves the join and the repeated rows.
    keep = near_duplicates(docs, key, text).where("kept").select(F.xxhash64(key, F.lit(1)).alias("_kkey"), F.col("text_fp").alias("_kfp")).distinct()
    own = docs.withColumn("_kkey", F.xxhash64(key, F.lit(1))).withColumn("_kfp", F.xxhash64(F.col(text).cast("string")))
    return own.join(keep, ["_kkey", "_kfp"], "left_semi").dropDuplicates(["_kkey", "_kfp"]).drop("_kkey", "_kfp")
