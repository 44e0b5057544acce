"""Mixing to target weights by iterative proportional fitting. Native: DataFrame functions only.

Documents fall into cells (source, lang, topic). A cell starts with its share of all tokens; each round rakes the cells' weights to the target
shares of the sources, then of the languages, then of the topics. A document's probability is its cell's weight over its cell's
tokens, times a rate: the sample's expected token shares are the fitted weights. Probabilities over 1 mean repetition: the
whole part counts as copies and the fraction is drawn. The draw is a hash of the key, so it doesn't depend on partitions.

Targets are either given as {dimension: {value: share}} or are the observed shares tempered: share ** ALPHA, normed. Every PASS rounds the largest gap between a
fitted and a wanted share is measured: fitting ends once it is within TOLERANCE, and a gap of over REACHED after the last round (targets that the cells at
hand can't meet together) is told by a warning, not passed over. Cells are one row
each (their number is values * values * values, not documents), pre-aggregated before the shuffle. The join back deals documents by cell,
so a hot cell is split by adaptive execution, or the cells are broadcast if Spark finds them small by their size.

The topic is a column of the caller's, or a coarse one by marks in the text. Null texts have no tokens, nulls of a dimension count as the value ''; very long texts count
whole; repeated rows draw alike, as the draw is a hash of the key; further columns stay in ``row``, whatever their names.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch

ALPHA = 0.5
ROUNDS = 12
PASS = 4
#: The largest gap of a share at which fitting ends, and the one that still counts as met.
TOLERANCE, REACHED = 1e-13, 1e-4
RATE = 0.5
DIMENSIONS = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    """Words between blanks."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\x0b\x0c"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[ \t\n\r\x0b\x0c]+", -1))).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic by cheap marks: legal (license or copyright lines), contact (an address sign), table (bars), else prose."""
    t = F.coalesce(text, F.lit(""))
    legal = F.contains(t, F.lit("icense")) | F.contains(t, F.lit("opyright"))
    return F.when(legal, "legal").when(F.contains(t, F.lit("@")), "contact").when(F.contains(t, F.lit(" | ")), "table").otherwise("prose")


def tagged(docs: DataFrame, text: str, by: Column | None = None) -> DataFrame:
    """(row, source, lang, topic, tokens); nulls of a dimension count as ''. by: the topic, if not by marks."""
    side = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = F.col(text).cast("string")
    return docs.select(F.struct(*docs.columns).alias("row"), side("source").alias("source"), side("lang").alias("lang"), (topic(own) if by is None else F.coalesce(by.cast("string"), F.lit(""))).alias("topic"), n_tokens(own).alias("tokens"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None, alpha: float, rounds: int, total: int, scratch: Scratch) -> DataFrame:
    """cells: (source, lang, topic, tokens), all tokens > 0, total in sum. Returns them with weight; the weights add up to 1.

    Values without a given target, and targets of absent values, count as 0 and are left out of the norm.
    """
    out = cells
    for d in DIMENSIONS:
        observed = cells.groupBy(d).agg(F.sum("tokens").alias("t"))
        if targets and d in targets:
            given = F.create_map(*(x for k, v in targets[d].items() for x in (F.lit(k), F.lit(float(v))))) if targets[d] else F.create_map()
            goal = F.coalesce(F.try_element_at(given, F.col(d)), F.lit(0.0))
        else:
            goal = F.pow(F.col("t").cast("double"), F.lit(alpha))
        goals = observed.select(d, goal.alias("goal"))
        norm = goals.agg(F.sum("goal")).first()[0] or 1.0
        out = out.join(goals.select(d, (F.col("goal") / F.lit(norm)).alias(f"target_{d}")), d)
    out = scratch.put(out.withColumn("weight", F.col("tokens") / F.lit(float(total))), "rake-0")
    for k in range(1, rounds + 1):
        for d in DIMENSIONS:
            sums = F.sum("weight").over(Window.partitionBy(d))
            out = out.withColumn("_s", sums).withColumn("weight", F.when(F.col("_s") > 0, F.col("weight") * F.col(f"target_{d}") / F.col("_s")).otherwise(0.0)).drop("_s")
        if k % PASS == 0 or k == rounds:
            out = scratch.put(out, f"rake-{k}")
            gap = residual(out)
            if gap <= TOLERANCE:
                break
    if rounds and gap > REACHED:
        warnings.warn(f"a share is {gap:.2g} off its target after {rounds} rounds: the targets don't fit together", stacklevel=3)
    return out


def residual(fitted: DataFrame) -> float:
    """The largest gap between a value's fitted share and its target, over all dimensions."""
    gaps = [fitted.groupBy(d).agg(F.abs(F.sum("weight") - F.first(f"target_{d}")).alias("gap")).select("gap") for d in DIMENSIONS]
    return gaps[0].unionAll(gaps[1]).unionAll(gaps[2]).agg(F.max("gap")).first()[0] or 0.0


def draw(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone: the first 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, rate: float = RATE, alpha: float = ALPHA, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text", by: Column | None = None) -> DataFrame:
    """One row per input row: row (the input as a struct), source, lang, topic, tokens, expected (copies, rounded to 6 digits) and copies.

    Documents without tokens have no weight: expected and copies 0. Repeated rows draw alike. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    own = tagged(docs, text, by)
    cells = scratch.put(own.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    fitted = rake(cells, targets, alpha, rounds, total, scratch)
    ratio = fitted.select(*DIMENSIONS, F.round(F.lit(float(rate) * total) * F.col("weight") / F.col("tokens"), 6).alias("_ratio"))
    out = own.join(ratio, list(DIMENSIONS), "left")
    expected = F.when(F.col("tokens") > 0, F.coalesce("_ratio", F.lit(0.0))).otherwise(0.0)
    out = out.select("row", *DIMENSIONS, "tokens", expected.alias("expected"))
    copies = F.floor("expected") + F.when(draw(F.col(f"row.`{key}`")) < F.col("expected") - F.floor("expected"), 1).otherwise(0)
    return out.withColumn("copies", copies.cast("long"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The drawn documents once each, with all their columns and ``copies`` and ``expected``, which replace columns of these names in the input."""
    mixed = mix(docs, **options).where("copies > 0")
    return mixed.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("copies", "expected")), "copies", "expected")
