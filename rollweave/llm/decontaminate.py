"""Benchmark decontamination with a generalised suffix automaton over the items' words.

The items' normalised words go into one token automaton. Documents stream through it word by word; the state and the length of the
longest match that ends at each word tell which windows end there. A window is 13 consecutive item words, or a whole item of fewer;
words inside any occurrence of a window are hit. A document whose hit words reach a twentieth of its words is contaminated.

Once built, an automaton is frozen into flat arrays: a state's first transition, link and length are 4-byte integers, and only further transitions stand in a
dictionary. That takes some BYTES_A_WORD bytes a word of the benchmark in each worker, so that a block of BLOCK_WORDS words is bounded by some 160 MB. Items are
taken in such blocks, read one after the other. With one block the documents are scanned once, and nothing is shuffled. With several a sieve comes first: the hashes of all
windows, 8 bytes each, for SIFT_WORDS words at a time. Documents of which no window's hash is in it can't be hit; the others, few in a corpus, are stored, and only they are scanned
by each block's automaton, whose broadcast is dropped behind the scan. Their hits are joined back to all rows. Each document is handled alone, as a whole. A null or empty text has no words and no hits; null items and items without
words have no windows; repeated items are found under each of their ids; an empty benchmark hits nothing. Repeated rows are rows like others, and
further columns of any name don't matter.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD_BYTES, Scratch, batch_type, words

WINDOW = 13
#: A document is contaminated if SHARE * n_hit >= n_words.
SHARE = 20
BLOCK_WORDS = 400_000
#: Words of the benchmark in one sieve, which takes 160 MB in a worker.
SIFT_WORDS = 20_000_000
#: Measured on random words, the worst case: vocabulary, states and item lists.
BYTES_A_WORD = 400


class SuffixAutomaton:
    """Of several token sequences. While it is built, next holds by state its transitions; then ``token`` and ``to`` hold the first one of each state and ``more``
    the others. link: suffix links; length: of the state's longest string. found: by the state that holds its strings of window words, the items in which they
    occur. short: by state, the (words, item) of the short items that end in it or in a state up its links."""

    def __init__(self, items: Iterable[tuple[object, Sequence[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set] = {}
        shorts: list[tuple[object, int, list[int]]] = []
        for key, tokens in items:
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens]
            last = 0
            for c in ids:
                last = self._extend(last, c)
                ends.setdefault(last, set()).add(key)
            if 0 < len(ids) < window:
                shorts.append((key, len(ids), ids))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        #: By state: the one that holds its strings of window words, -1 if they are shorter.
        self.holder = array("i", [-1]) * len(self.next)
        for s in order:
            up = self.link[s]
            self.holder[s] = s if self.length[up] < window <= self.length[s] else self.holder[up] if self.length[up] >= window else -1
        gathered: dict[int, set] = {}
        for s, keys in ends.items():
            if (h := self.holder[s]) >= 0:
                gathered.setdefault(h, set()).update(keys)
        self.found: dict[int, tuple] = {s: tuple(keys) for s, keys in gathered.items()}
        own: dict[int, list[tuple[int, object]]] = {}
        for key, n, ids in shorts:
            s = 0
            for c in ids:
                s = self.next[s][c]
            own.setdefault(s, []).append((n, key))
        self.short: dict[int, tuple] = {}
        for s in order if own else ():
            if both := (*own.get(s, ()), *self.short.get(self.link[s], ())):
                self.short[s] = both
        first = [next(iter(t.items()), (-1, 0)) for t in self.next]
        self.token, self.to = array("i", [c for c, _ in first]), array("i", [t for _, t in first])
        self.more = {(s, c): t for s, own in enumerate(self.next) for c, t in own.items() if c != self.token[s]}
        self.link, self.length = array("i", self.link), array("i", self.length)
        del self.next

    def _extend(self, last: int, c: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        if c in nexts[last]:
            q = nexts[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy

    def scan(self, tokens: Sequence[bytes]) -> tuple[list[tuple[int, int]], set]:
        """The hit spans [start, end) in order, merged, and the items that have a window here."""
        spans: list[tuple[int, int]] = []
        found: set = set()
        token, to, more, link, length, window = self.token, self.to, self.more, self.link, self.length, self.window
        holder, short, s, n = self.holder, self.short, 0, 0
        for i, c in enumerate(map(self.vocabulary.get, tokens)):
            if c is None:
                s = n = 0
                continue
            while True:
                t = to[s] if token[s] == c else more.get((s, c))
                if t is not None or not s:
                    break
                s = link[s]
                n = length[s]
            if t is None:
                n = 0
                continue
            s, n = t, n + 1
            size = 0
            if n >= window:
                size = window
                found.update(self.found.get(holder[s], ()))
            for m, key in short.get(s, ()):
                if m <= n:
                    size = max(size, m)
                    found.add(key)
            if size:
                at = i + 1 - size
                while spans and spans[-1][1] >= at:
                    at = min(at, spans.pop()[0])
                spans.append((at, i + 1))
        return spans, found


def gram_hashes(tokens: Sequence[bytes], n: int) -> np.ndarray:
    """64-bit hashes of all n words that follow each other."""
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    out = np.zeros(max(len(tokens) - n + 1, 0), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + len(out)]
    return out


class Sieve:
    """Sorted hashes of an item list's windows, by their words."""

    def __init__(self, grams: dict[int, list[np.ndarray]]):
        self.grams = {n: np.unique(np.concatenate(parts)) for n, parts in grams.items()}

    def holds(self, tokens: Sequence[bytes]) -> bool:
        """Whether some window may occur; False is certain."""
        for n, known in self.grams.items():
            own = gram_hashes(tokens, n)
            if own.size and (known[np.minimum(np.searchsorted(known, own), known.size - 1)] == own).any():
                return True
        return False


def sieves(benchmark: DataFrame, text: str, window: int, most: int) -> Iterator[Sieve]:
    """Sieves of at most so many words each (or of one longer item)."""
    grams: dict[int, list[np.ndarray]] = {}
    size = 0
    for (value,) in benchmark.select(F.col(text).cast("string")).toLocalIterator():
        if tokens := words(value):
            if grams and size + len(tokens) > most:
                yield Sieve(grams)
                grams, size = {}, 0
            n = min(window, len(tokens))
            grams.setdefault(n, []).append(gram_hashes(tokens, n))
            size += len(tokens)
    yield Sieve(grams)


def sift(docs: DataFrame, key: str, text: str, sieve) -> DataFrame:
    """(key, text, _fp) of the documents that the broadcast sieve holds."""

    def run(batches):
        own = sieve.value
        for batch in batches:
            yield batch.filter(pa.array([own.holds(words(value.as_py())) for value in batch[1]], pa.bool_()))

    given = docs.select(F.col(key), F.col(text).cast("string").alias(text), _fingerprint(text).alias("_fp"))
    return given.mapInArrow(run, given.schema)


def blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items with words, in blocks of at most so many words (or of one longer item)."""
    block, size = [], 0
    for key, value in benchmark.select(F.col(item), F.col(text).cast("string")).toLocalIterator():
        if tokens := words(value):
            if block and size + len(tokens) > most:
                yield block
                block, size = [], 0
            block.append((key, tokens))
            size += len(tokens)
    yield block


def _fingerprint(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


def scan_block(docs: DataFrame, key: str, text: str, automaton, marked: bool = False) -> DataFrame:
    """(key, _fp, _n_words, _starts, _ends, _items): the spans hit by the items of a broadcast automaton, whose ids are strings. _fp is null unless marked."""
    kind = dict(docs.dtypes)[key]
    names = [key, "_fp", "_n_words", "_starts", "_ends", "_items"]

    def run(batches):
        own = automaton.value
        for batch in batches:
            n_words, starts, ends, items = [], [], [], []
            for value in batch[1]:
                tokens = words(value.as_py())
                spans, found = own.scan(tokens)
                n_words.append(len(tokens))
                starts.append([a for a, _ in spans])
                ends.append([b for _, b in spans])
                items.append(sorted(found))
            cols = [batch[0].cast(batch_type(kind)), batch[2], pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"{key} {kind}, _fp string, _n_words bigint, _starts array<int>, _ends array<int>, _items array<string>"
    mark = _fingerprint(text) if marked else F.lit(None).cast("string")
    return docs.select(F.col(key), F.col(text).cast("string"), mark.alias("_fp")).mapInArrow(run, schema)


def _automaton(docs: DataFrame, block, window: int):
    return docs.sparkSession.sparkContext.broadcast(SuffixAutomaton([("" if k is None else str(k), t) for k, t in block], window))


def _union_spans(spans: Column) -> Column:
    """Sorted spans (_starts, _ends), those that touch or overlap made one."""
    pair = lambda a, b: F.struct(a.alias("_starts"), b.alias("_ends"))
    last = lambda acc: F.element_at(acc, -1)
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<_starts:int,_ends:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["_ends"] >= x["_starts"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(pair(last(acc)["_starts"], F.greatest(last(acc)["_ends"], x["_ends"])))),
        ).otherwise(F.concat(acc, F.array(pair(x["_starts"], x["_ends"])))),
    )


def _hits(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int, block_words: int, sift_words: int = SIFT_WORDS) -> DataFrame:
    """As scan_block, over all blocks: a row for each row of docs. With several blocks, _fp is set, and jobs run as this is called."""
    todo = blocks(benchmark, item, item_text, block_words)
    block, more = next(todo), next(todo, None)
    if more is None:
        return scan_block(docs, key, text, _automaton(docs, block, window))
    spark = docs.sparkSession
    scratch, found = Scratch(spark, "contamination"), []
    for k, sieve in enumerate(sieves(benchmark, item_text, window, sift_words)):
        shared = spark.sparkContext.broadcast(sieve)
        found.append(scratch.put(sift(docs, key, text, shared), f"sifted-{k}"))
        shared.destroy()
    sifted = found[0] if len(found) == 1 else scratch.put(reduce(DataFrame.unionByName, found).dropDuplicates([key, "_fp"]), "sifted")
    found = []
    while block is not None:
        shared = _automaton(docs, block, window)
        found.append(scratch.put(scan_block(sifted, key, text, shared, True).where(F.size("_items") > 0), f"found-{len(found)}"))
        shared.destroy()
        block, more = more, next(todo, None)
    hits = reduce(DataFrame.unionByName, found)
    grouped = hits.groupBy(F.col(key).alias("_gkey"), F.col("_fp").alias("_gfp")).agg(_union_spans(F.flatten(F.collect_set(F.arrays_zip("_starts", "_ends")))).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("_found"))
    n_words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("long")
    rows = docs.select(F.col(key), _fingerprint(text).alias("_fp"), n_words.alias("_n_words")).join(grouped, (F.col("_fp") == F.col("_gfp")) & F.equal_null(F.col(key), F.col("_gkey")), "left")
    side = lambda c: F.coalesce(F.col("_spans")[c], F.array().cast("array<int>")).alias(c)
    return rows.select(key, "_fp", "_n_words", side("_starts"), side("_ends"), F.coalesce("_found", F.array().cast("array<string>")).alias("_items"))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256 (of the item ids as sorted strings), contaminated, spans, items."""
    found = _hits(docs, benchmark, key, text, item, item_text, window, block_words)
    n_hit = F.aggregate(F.zip_with("_starts", "_ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    found = found.select("*", n_hit.alias("n_hit"))
    bad = (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("_n_words"))
    return found.select(key, F.col("_n_words").alias("n_words"), "n_hit", F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), bad.alias("contaminated"), F.struct("_starts", "_ends").alias("spans"), F.col("_items").alias("items"), F.col("_fp").alias("text_sha256"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that aren't contaminated, all columns as they are. A single block of items, the usual case, needs no shuffle."""
    todo = blocks(benchmark, item, item_text, block_words)
    block, more = next(todo), next(todo, None)
    if more is not None:
        bad = contamination(docs, benchmark, key, text, item, item_text, window, share, block_words).where("contaminated").select(F.col(key).alias("_bad"), F.col("text_sha256").alias("_bad_fp"))
        return docs.join(bad, F.equal_null(docs[key], bad["_bad"]) & (_fingerprint(text) == bad["_bad_fp"]), "left_anti")
    automaton = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(block, window))
    at = docs.columns.index(text)

    def run(batches):
        own = automaton.value
        for batch in batches:
            keep = []
            for value in batch[at]:
                tokens = words(value.as_py())
                hit = sum(b - a for a, b in own.scan(tokens)[0])
                keep.append(not (hit and share * hit >= len(tokens)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def spans_over(spans: Sequence[tuple[int, int]], n_words: int, least: int = WINDOW, share: int = SHARE) -> list[tuple[int, int]]:
    """The spans over the limits: all, if they reach the share of a contaminated document, else those of at least so many words."""
    hit = sum(b - a for a, b in spans)
    return [(a, b) for a, b in spans if b - a >= least or share * hit >= n_words]


def cut_words(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without these spans of words, each from its first word's first byte to its last word's last; what stands around them stays."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, least: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS, length: str | None = "n_chars") -> DataFrame:
    """All documents, their texts without the hit spans over the limits (see spans_over), with the new length in characters, all other columns as they are.

    The spans are those of the text as it is: a window whose words only come together at a cut isn't looked for.
    """
    todo = blocks(benchmark, item, item_text, block_words)
    block, more = next(todo), next(todo, None)
    at, columns = docs.columns.index(text), docs.columns
    n_at = columns.index(length) if length in columns else None
    if more is None:
        automaton, given = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(block, window)), docs
    else:
        automaton = None
        hits = _hits(docs, benchmark, key, text, item, item_text, window, block_words).where(F.size("_starts") > 0).dropDuplicates([key, "_fp"])
        hits = hits.select(F.col(key).alias("_hkey"), F.col("_fp").alias("_hfp"), "_starts", "_ends")
        given = docs.join(hits, (_fingerprint(text) == F.col("_hfp")) & F.equal_null(docs[key], hits["_hkey"]), "left").select(*(docs[c] for c in columns), "_starts", "_ends")

    def run(batches):
        for batch in batches:
            texts, sizes = batch[at].to_pylist(), batch[n_at].to_pylist() if n_at is not None else None
            for i, value in enumerate(texts):
                tokens = words(value)
                spans = automaton.value.scan(tokens)[0] if automaton else list(zip(batch[-2][i].as_py() or (), batch[-1][i].as_py() or (), strict=True))
                if over := spans_over(spans, len(tokens), least, share):
                    texts[i] = cut_words(value, over)
                    if sizes:
                        sizes[i] = len(texts[i])
            cols = [batch[k] for k in range(len(columns))]
            cols[at] = pa.array(texts, cols[at].type)
            if sizes:
                cols[n_at] = pa.array(sizes, cols[n_at].type)
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return given.mapInArrow(run, docs.schema)
