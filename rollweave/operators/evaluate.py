"""Ground truth: greedy one-to-one matching and reports (J5, J12, A7-A9, F20, Z20). Distances run in the JVM, bounded, over distinct names; Python only takes the order-dependent choice."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import clean_gt, norm, ratio, scaled_cap
from .snap import spread

MOST_EDITS = 3
LONG_FROM = 7


def choose_in_order(packets: list[tuple[list, list, list]]) -> list[tuple[int | None, str]]:
    """J5 on one roll: packets in order, each with the places, in order, of the truths of its name with a fitting middle name, of all truths of its name, and of all near ones.
    The first fitting one is exact; else the last one of its name is partial, else the first near one. Each truth is used once."""
    used: set[int] = set()
    out = []
    for fitting, named, near in packets:
        found, grade = next((k for k in fitting if k not in used), None), "exact"
        if found is None:
            found, grade = next((k for k in reversed(named) if k not in used), None), "partial"
        if found is None:
            found = next((k for k in near if k not in used), None)
        if found is not None:
            used.add(found)
        out.append((found, grade if found is not None else "none"))
    return out


def match_candidates(packets: DataFrame, truth: DataFrame, roll: str, most: int = MOST_EDITS) -> DataFrame:
    """(roll, packet_pos, fitting, named, near): arrays of gt_pos in order. Names are compared upper-cased and stripped; distinct names of a roll meet its distinct truths,
    within a length band, so a name that stands on many packets is compared once. Long names of the truth may differ by one edit more (F20)."""
    tidy = lambda df, pos: df.select(roll, pos, *(norm(F.col(c)).alias(c) for c in ("last", "first", "middle")))
    own, gt = tidy(packets, "packet_pos"), tidy(truth, "gt_pos")
    by_name = gt.groupBy(roll, "last", "first").agg(F.array_sort(F.collect_list(F.struct("gt_pos", "middle"))).alias("all"))
    names = own.select(roll, "last", "first").distinct()
    within = lambda c: (F.abs(F.length(c) - F.length(f"g_{c}")) <= most + 1) & (F.coalesce(F.levenshtein(F.col(c), F.col(f"g_{c}"), most + 1), F.lit(-1)).between(0, scaled_cap(F.col(f"g_{c}"), most, LONG_FROM)))
    near = spread(names, roll).join(by_name.select(roll, F.col("last").alias("g_last"), F.col("first").alias("g_first"), "all"), roll).where(within("last") & within("first"))
    near = near.groupBy(roll, "last", "first").agg(F.array_sort(F.flatten(F.collect_list(F.transform("all", lambda x: x["gt_pos"])))).alias("near"))
    out = own.join(by_name, [roll, "last", "first"], "left").join(near, [roll, "last", "first"], "left")
    some = F.coalesce("all", F.array().cast(out.schema["all"].dataType))
    fits = F.filter(some, lambda x: (x["middle"] == F.col("middle")) | (F.col("middle") == "") | (x["middle"] == ""))
    place = lambda a: F.transform(a, lambda x: x["gt_pos"])
    return out.select(roll, "packet_pos", place(fits).alias("fitting"), place(some).alias("named"), F.coalesce("near", F.array().cast(out.schema["near"].dataType)).alias("near"))


def greedy_match(packets: DataFrame, truth: DataFrame, roll: str, most: int = MOST_EDITS) -> DataFrame:
    """Packets (roll, packet_pos, last, first, middle) and truth (roll, gt_pos, ...) to (roll, packet_pos, gt_pos, grade). Consumption depends on
    the order, so a roll is one unit; rolls are independent."""
    kind = dict(packets.dtypes)[roll]

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("packet_pos")
        found = choose_in_order(list(zip(own["fitting"], own["named"], own["near"], strict=True)))
        return pd.DataFrame([(r, p, k, g) for r, p, (k, g) in zip(own[roll], own["packet_pos"], found, strict=True)], columns=[roll, "packet_pos", "gt_pos", "grade"]).astype({"gt_pos": "Int64"})

    return match_candidates(packets, truth, roll, most).groupBy(roll).applyInPandas(run, f"{roll} {kind}, packet_pos long, gt_pos long, grade string")


def exact_match(packets: DataFrame, truth: DataFrame, roll: str) -> DataFrame:
    """J5's first tier while all middles are blank: the k-th packet of a name takes the name's k-th truth."""
    rank = lambda df, pos: df.withColumn("_k", F.row_number().over(Window.partitionBy(roll, "last", "first").orderBy(pos)))
    return rank(packets, "packet_pos").join(rank(truth, "gt_pos").select(roll, "last", "first", "_k", "gt_pos"), [roll, "last", "first", "_k"], "left").drop("_k")


def drop_reasons(cleaned: DataFrame) -> DataFrame:
    """A7."""
    return cleaned.where("drop_reason is not null").groupBy("drop_reason").agg(F.count("*").alias("n"))


def rendered(last: str, first: str) -> Column:
    """A name in the lists of what found no partner."""
    return F.concat(norm(F.col(last)), F.lit("|"), norm(F.col(first)))


def unmatched(rows: DataFrame, matched: DataFrame, roll: str, pos: str) -> DataFrame:
    """(roll, pos, name) of the packets or truths without a partner. matched: of greedy_match."""
    used = matched.where("grade != 'none'").select(roll, pos)
    return rows.join(used, [roll, pos], "left_anti").select(roll, pos, rendered("last", "first").alias("name"))


def clean_truth(files: DataFrame, roll: str, name: str, **options) -> DataFrame:
    """F6 on a listing: (roll, gt_pos, last, first, middle, drop_reason), positions by name: a listing's own order isn't stable."""
    own = files.select(F.col(roll), F.col(name).alias("_n"), clean_gt(F.col(name), F.col(roll), **options).alias("c"))
    return own.withColumn("gt_pos", F.row_number().over(Window.partitionBy(roll).orderBy("_n")).cast("long")).select(roll, "gt_pos", "c.*")


def evaluate(packets: DataFrame, cleaned: DataFrame, totals: DataFrame, roll: str, most: int = MOST_EDITS) -> DataFrame:
    """One row per roll of totals, with all fields of the report.

    packets: (roll, packet_no, last, first, middle, last_raw, first_raw, middle_raw, snap_applied); cleaned: of clean_truth; totals: of page_totals. The match runs twice,
    on raw names and on snapped ones. Ratios are 0 without packets; rolls without packets or truth have zeros and empty lists."""
    truth = cleaned.where("drop_reason is null")
    usable = cleaned.groupBy(roll).agg(F.count("*").alias("gt_rows_raw"), F.count_if(F.col("drop_reason").isNull()).alias("gt_rows_usable"), F.array_sort(F.collect_list(F.when(F.col("drop_reason").isNull(), F.struct("gt_pos", rendered("last", "first").alias("name"))))).alias("_truth"))
    reasons = cleaned.where("drop_reason is not null").groupBy(roll, "drop_reason").agg(F.count("*").alias("n"))
    reasons = reasons.groupBy(roll).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("drop_reason", "n")))).alias("gt_rows_dropped_reasons"))
    counted = packets.groupBy(roll).agg(F.count("*").alias("packets_predicted"), F.count_if("snap_applied").alias("packets_snapped"), F.array_sort(F.collect_list(F.struct(F.col("packet_no").cast("long").alias("packet_pos"), rendered("last", "first").alias("name")))).alias("_packets"))
    # Both matches are one: a roll's raw names and its snapped ones are two rolls to it.
    key = lambda when: F.concat(F.lit(f"{when}:"), F.col(roll).cast("string"))
    side = lambda when, raw: F.struct(key(when).alias("_k"), F.col("packet_no").cast("long").alias("packet_pos"), *(F.col(f"{c}{raw}").alias(c) for c in ("last", "first", "middle")))
    stacked = packets.select(F.inline(F.array(side("pre", "_raw"), side("post", ""))))
    both = truth.select(F.explode(F.array(key("pre"), key("post"))).alias("_k"), "gt_pos", "last", "first", "middle")
    matched = greedy_match(stacked, both, "_k", most)
    grades = matched.groupBy("_k").agg(
        *(F.count_if(F.col("grade") == g).alias(n) for g, n in (("exact", "exact_matches"), ("partial", "partial_matches"), ("none", "no_match"))),
        F.collect_list("gt_pos").alias("_used"), F.collect_list(F.when(F.col("grade") == "none", F.col("packet_pos"))).alias("_alone"),
    )
    out = totals
    for part in (counted, usable, reasons):
        out = out.join(part, roll, "left")
    for when in ("pre", "post"):
        own = grades.where(F.startswith("_k", F.lit(f"{when}:"))).select("_k", *(F.col(n).alias(f"{n}_{when}") for n in ("exact_matches", "partial_matches", "no_match")), *(["_used", "_alone"] if when == "post" else []))
        out = out.withColumn("_k", key(when)).join(own, "_k", "left").drop("_k")
    left = lambda rows, pos, test: F.transform(F.filter(rows, test), lambda x: x["name"])
    out = out.withColumn("unmatched_predictions", left("_packets", "packet_pos", lambda x: F.array_contains("_alone", x["packet_pos"])))
    out = out.withColumn("unmatched_ground_truth", left("_truth", "gt_pos", lambda x: ~F.coalesce(F.array_contains("_used", x["gt_pos"]), F.lit(False))))
    counts = ["packets_predicted", "packets_snapped", "gt_rows_raw", "gt_rows_usable", *(f"{n}_{w}" for w in ("pre", "post") for n in ("exact_matches", "partial_matches", "no_match"))]
    out = out.fillna(0, counts).withColumn("packets_ground_truth", F.col("gt_rows_usable"))
    for when in ("pre", "post"):
        exact, partial = F.col(f"exact_matches_{when}"), F.col(f"partial_matches_{when}")
        out = out.withColumn(f"accuracy_exact_{when}", ratio(exact, F.col("packets_predicted"))).withColumn(f"accuracy_partial_{when}", ratio(exact + partial, F.col("packets_predicted")))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind) if kind.startswith("array") else F.create_map().cast(kind)).alias(c)
    lists = {"gt_rows_dropped_reasons": "map<string,bigint>", "unmatched_predictions": "array<string>", "unmatched_ground_truth": "array<string>"}
    return out.select(roll, *(empty(c, lists[c]) if c in lists else c for c in REPORT))


#: The report's fields behind the roll's id, in their order.
REPORT = (
    "pages_total", "pages_classified", "packets_predicted", "packets_ground_truth", "gt_rows_raw", "gt_rows_usable", "gt_rows_dropped_reasons", "exact_matches_pre", "partial_matches_pre", "no_match_pre",
    "accuracy_exact_pre", "accuracy_partial_pre", "exact_matches_post", "partial_matches_post", "no_match_post", "accuracy_exact_post", "accuracy_partial_post", "index_frames_total", "index_rows_total",
    "packets_snapped", "usd_total", "tokens_in_total", "tokens_out_total", "unmatched_predictions", "unmatched_ground_truth",
)


def page_totals(pages: DataFrame, index: DataFrame, roll: str, failed: DataFrame | None = None) -> DataFrame:
    """(roll, pages_total, pages_classified, index_frames_total, index_rows_total, usd_total, tokens_in_total, tokens_out_total). failed: pages whose enrichment failed, which count in the total."""
    sums = [F.round(F.sum("usd_cost"), 9).alias("usd_total"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"{c}_total") for c in ("tokens_in", "tokens_out"))]
    out = pages.groupBy(roll).agg(F.count("*").alias("pages_classified"), F.count_if(F.col("page_class") == "student_records_index").alias("index_frames_total"), *sums)
    out = out.join(index.groupBy(roll).agg(F.count("*").alias("index_rows_total")), roll, "left").fillna(0, ["index_rows_total", "usd_total"])
    if failed is None:
        return out.withColumn("pages_total", F.col("pages_classified"))
    out = out.join(failed.groupBy(roll).agg(F.count("*").alias("_failed")), roll, "full").fillna(0)
    return out.withColumn("pages_total", F.col("pages_classified") + F.col("_failed")).drop("_failed")


def report(graded: DataFrame, truth_n: int | None = None) -> DataFrame:
    """A8 in short: one row of counts and ratios over (exact, partial) flags; all 0 without packets. With truth_n, also Z20's precision, recall and F1 of the matches."""
    out = graded.agg(F.count("*").alias("packets"), F.count_if("exact").alias("exact"), F.count_if("partial").alias("partial"))
    out = out.withColumn("unmatched", F.col("packets") - F.col("exact") - F.col("partial"))
    out = out.withColumn("exact_rate", ratio(F.col("exact"), F.col("packets"))).withColumn("match_rate", ratio(F.col("exact") + F.col("partial"), F.col("packets")))
    if truth_n is None:
        return out
    return precision_recall(out.withColumn("_truth", F.lit(truth_n)), F.col("exact") + F.col("partial"), F.col("packets"), F.col("_truth")).drop("_truth")


def precision_recall(rows: DataFrame, right: Column, predicted: Column, truth: Column) -> DataFrame:
    """Precision, recall and their harmonic mean, 0 for empty denominators."""
    out = rows.withColumn("precision", ratio(right, predicted)).withColumn("recall", ratio(right, truth))
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
