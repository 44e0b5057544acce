"""Personal data: fixed patterns, and identifiers found by bootstrapped context.

Base spans come from four fixed patterns (email, ip, card, phone). They are the seeds of the bootstrap: what stands before an identifier (its
last two words) is a lexical pattern, and any identifier-like token (at least MIN_CHARS characters and MIN_DIGITS digits) is a
possible instance of the pattern before it. Spark scores the bipartite graph of patterns and instances for ROUNDS rounds. A pattern is as good as the mean
trust of its distinct instances; an instance that isn't a seed gets the trust of the accepted patterns that vouch for it (1 - product of 1 - score). A pattern is
accepted with a score of at least THRESHOLD and at least MIN_SEEDS distinct trusted instances: seeds, or ones whose own trust has reached the THRESHOLD, so
what one round finds induces patterns in the next. The patterns accepted in the last round mark all their instances (kind ``id``). Scores are rounded, so that
the order of a sum doesn't decide.

Texts are read once, whole, to spans and candidates, written to the shared folder; the graph holds one row per distinct (pattern,
instance), counted with partial aggregation, so neither a frequent pattern nor a frequent identifier gathers in one task.
Offsets are code points, ends exclusive. Null counts as an empty text; rows are kept apart even if repeated, and count once in the graph, whose
edges are distinct. Patterns with equal scores are alike: none is picked over another. Words of over MOST_WORD characters are no lexical words, so a place behind
one has no pattern; that keeps patterns small and the scan linear in very long texts. An empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, batch_type, deal_join

KINDS = ("email", "ip", "card", "phone", "id")
MIN_CHARS, MIN_DIGITS = 6, 3
ROUNDS = 3
THRESHOLD, MIN_SEEDS = 0.8, 3
MOST_WORD = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = _LOCAL | frozenset("/@:")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9][0-9.]*")
_PARTS = re.compile(r"([0-9]+)(\.*)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their ``@`` in linear time."""
    out, done, at = [], 0, -1
    while (at := text.find("@", at + 1)) >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, m.end()))
            done = m.end()
    return out


def ips(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Leftmost matches of four dotted numbers in a run of digits and dots, parts at most 255; linear, as a match takes whole numbers."""
    out, parts, k = [], list(_PARTS.finditer(text, start, end)), 0
    while k + 3 < len(parts):
        if all(len(p[2]) == 1 for p in parts[k : k + 3]):
            numbers = [p[1].lstrip("0") or "0" for p in parts[k : k + 4]]
            if all(len(n) <= 3 and int(n) <= 255 for n in numbers):
                out.append((parts[k].start(), parts[k + 3].end(1)))
            k += 4
        else:
            k += 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    for run in _NUMBERS.finditer(text):
        if run[0].count(".") >= 3:
            out += [(a, 1, b) for a, b in ips(text, run.start(), run.end())]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def context(text: str, start: int) -> str | None:
    """The last two words before a place (one, if there is but one), lower-cased; null if there are none or one is longer than MOST_WORD."""
    words, at = [], start
    while len(words) < 2:
        while at and text[at - 1].isspace():
            at -= 1
        end = at
        while at and not text[at - 1].isspace():
            at -= 1
            if end - at > MOST_WORD:
                return None
        if at == end:
            break
        words.append(text[at:end].lower())
    return " ".join(reversed(words)) or None


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str | None, str, bool]]:
    """(start, end, pattern, instance, seed): the base spans, and the identifier-like tokens that touch none."""
    out = [(a, b, context(text, a), text[a:b].lower(), True) for a, _, b in base]
    done = 0
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))
    for m in _NUMBERS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.start(), m.end()
        while a > done and text[a - 1] in _TOKEN:
            a -= 1
        while b < len(text) and text[b] in _TOKEN:
            b += 1
        done = b
        token = text[a:b]
        whole = token.strip("._%+-/@:")
        a += len(token) - len(token.lstrip("._%+-/@:"))
        b = a + len(whole)
        if len(whole) < MIN_CHARS or len(_DIGIT.findall(whole)) < MIN_DIGITS:
            continue
        before = bisect_left(starts, b)
        if not before or reach[before - 1] <= a:
            out.append((a, b, context(text, a), whole.lower(), False))
    return out


def extract(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: _id (unique), key, base spans and candidates. One pass, no shuffle."""
    kind = dict(docs.dtypes)[key]
    span = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    cand = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("pattern", pa.string()), ("instance", pa.string()), ("seed", pa.bool_())]))

    def run(batches):
        for batch in batches:
            spans, cands = [], []
            for value in batch[2]:
                own = value.as_py() or ""
                base = base_spans(own)
                spans.append([{"s": a, "k": k, "e": b} for a, k, b in base])
                cands.append([dict(zip(("s", "e", "pattern", "instance", "seed"), c, strict=True)) for c in candidates(own, base)])
            yield pa.RecordBatch.from_arrays([batch[0], batch[1].cast(batch_type(kind)), pa.array(spans, span), pa.array(cands, cand)], names=["_id", key, "_base", "_found"])

    source = docs.select(F.monotonically_increasing_id().alias("_id"), F.col(key), F.col(text).cast("string"))  # written once, so ids don't change
    return source.mapInArrow(run, f"_id bigint, {key} {kind}, _base array<struct<s:int,k:int,e:int>>, _found array<struct<s:int,e:int,pattern:string,instance:string,seed:boolean>>")


def score_patterns(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS, threshold: float = THRESHOLD, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """edges: distinct (pattern, instance, seed). Returns the accepted (pattern, score)."""
    trusted = edges.withColumn("trust", F.col("seed").cast("double"))
    for k in range(rounds):
        scored = trusted.groupBy("pattern").agg(F.round(F.avg("trust"), 9).alias("score"), F.count_if(F.col("trust") >= threshold).alias("sure"))
        good = scratch.put(scored.where((F.col("score") >= threshold) & (F.col("sure") >= min_seeds)).select("pattern", "score"), f"good-{k}")
        if k + 1 < rounds:
            vouch = edges.join(good.hint("merge"), "pattern").groupBy("instance").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999))))), 9).alias("vouched"))
            # Instances that no accepted pattern vouches for have no trust; the sums need only those that have some, and all edges for the mean.
            trusted = deal_join(edges, vouch, ["instance"], "left").withColumn("trust", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("vouched", F.lit(0.0)))).select("pattern", "instance", "seed", "trust")
    return good


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, threshold: float = THRESHOLD, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """One row per input row: key, base and all: arrays of (s, k, e) sorted by start, then kind as in KINDS (k is its place)."""
    scratch = Scratch(docs.sparkSession, "pii")
    read = scratch.put(extract(docs, key, text), "read")
    found = read.select("_id", F.explode("_found").alias("c")).select("_id", "c.*").where("pattern is not null")
    edges = scratch.put(found.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    good = score_patterns(edges, scratch, rounds, threshold, min_seeds).select("pattern")
    added = found.where("not seed").join(good.hint("merge"), "pattern").groupBy("_id").agg(F.collect_list(F.struct("s", F.lit(KINDS.index("id")).alias("k"), "e")).alias("_added"))
    out = read.select("_id", key, "_base").join(added.hint("merge"), "_id", "left")
    return out.select(key, F.col("_base").alias("base"), F.array_sort(F.concat("_base", F.coalesce("_added", F.array().cast("array<struct<s:int,k:int,e:int>>")))).alias("all"))


def counted(spans: str, kind: str):
    """The number of spans of a kind. (Spark gives a second parameter of the lambda the element's index, even one with a default.)"""
    k = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


def joined(spans: str):
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
