"""Pages to packets: windows, islands, buckets, majorities, merging (P4-P8, A1-A5, J1, J4, J6, W1-W7, U2, U4, Z6-Z10, Z16, Z17). All share one partitioning by roll."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import blank, coarse_key, has_name, norm, slug
from . import snap

MERGE_PASSES = 5


def bracket(pages: DataFrame, roll: str, order: str, start: Column, end: Column) -> DataFrame:
    """What stands after the first start and before the last end; a missing mark leaves that side open."""
    w = Window.partitionBy(roll)
    own = pages.withColumn("_s", F.min(F.when(start, F.col(order))).over(w)).withColumn("_e", F.max(F.when(end, F.col(order))).over(w))
    return own.where((F.col("_s").isNull() | (F.col(order) > F.col("_s"))) & (F.col("_e").isNull() | (F.col(order) < F.col("_e")))).drop("_s", "_e")


def islands(pages: DataFrame, roll: str, order: str, key: Column) -> DataFrame:
    """A page whose key differs from the last one known opens an island; pages without a key join the open one, and are dropped before the first."""
    w = Window.partitionBy(roll).orderBy(order)
    own = pages.withColumn("_k", key)
    own = own.withColumn("_p", F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.withColumn("_b", (F.col("_k").isNotNull() & (F.col("_p").isNull() | (F.col("_k") != F.col("_p")))).cast("int"))
    return own.withColumn("island", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("island > 0").drop("_p", "_b").withColumnRenamed("_k", "key")


def majority(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """A1, A2: the most frequent value that isn't blank, of equals the one seen first."""
    counted = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), "_o", value)
    return counted.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*keys, F.col(value).alias("majority"), F.col("_n").alias("votes"))


def majority_name(pages: DataFrame, keys: list[str], last: str, first: str, middle: str, order: str) -> DataFrame:
    """A1, A2: the most frequent (last, first) pair, upper-cased, of the pages that have any name, of equals the one seen first; and the most frequent known middle
    name of the pages that bear it. Pages without a name don't vote; a group without any has no row."""
    own = pages.where(has_name(F.col(last), F.col(first))).select(*keys, norm(F.col(last)).alias("_l"), norm(F.col(first)).alias("_f"), norm(F.col(middle)).alias("_m"), F.col(order).alias("_o"))
    pairs = own.groupBy(*keys, "_l", "_f").agg(F.count("*").alias("_n"), F.min("_o").alias("_at"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), "_at")
    won = pairs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*keys, "_l", "_f", F.col("_n").alias("votes"))
    middles = own.where("_m != ''").groupBy(*keys, "_l", "_f", "_m").agg(F.count("*").alias("_n"), F.min("_o").alias("_at"))
    best = middles.groupBy(*keys, "_l", "_f").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_at").alias("at"), F.col("_m").alias("m")))["m"].alias("middle"))
    return won.join(best, [*keys, "_l", "_f"], "left").select(*keys, F.col("_l").alias("last"), F.col("_f").alias("first"), F.coalesce("middle", F.lit("")).alias("middle"), "votes")


def mean(c: str) -> Column:
    """The mean, summed as decimals as the numbers are written, so that it doesn't depend on the order of the rows; as doubles if one doesn't fit."""
    exact = F.col(c).try_cast("decimal(28,18)")
    return F.when(F.count(exact) == F.count(c), F.avg(exact).cast("double")).otherwise(F.avg(c))


def rollup(pages: DataFrame, keys: list[str], order: str, confidence: str, threshold: float) -> DataFrame:
    """A3-A5: pages, mean confidence, any under the threshold, frames in order."""
    return pages.groupBy(*keys).agg(F.count("*").alias("n_pages"), mean(confidence).alias("avg_confidence"), (F.min(confidence) < threshold).alias("flagged"), F.array_sort(F.collect_list(order)).alias("frames"), F.min(order).alias("first_frame"))


def number(packets: DataFrame, roll: str, order: str) -> DataFrame:
    """Packets numbered by their first frame, and packet_id, the roll's short name and the number in three digits at least."""
    own = packets.withColumn("packet_no", F.row_number().over(Window.partitionBy(roll).orderBy(order)))
    return own.withColumn("packet_id", packet_id(F.col(roll), F.col("packet_no")))


def packet_id(roll: Column, number: Column) -> Column:
    """A roll name's blanks go and it is lower-cased."""
    return F.concat(slug(roll.cast("string")), F.lit("_"), F.when(number < 1000, F.lpad(number.cast("string"), 3, "0")).otherwise(number.cast("string")))


def boundary_key(last: Column, first: Column, snapped: Column | None = None, has_index: Column | None = None) -> Column:
    """Null for a page without a name; with an index for its roll the whole names, as its entry has them if it has one; else the coarse key."""
    coarse = coarse_key(last, first)
    if snapped is not None:
        whole = F.concat(F.coalesce(snapped["ilast"], norm(last)), F.lit("|"), F.coalesce(snapped["ifirst"], norm(first)))
        coarse = F.when(has_index, whole).otherwise(coarse)
    return F.when(has_name(last, first), coarse)


def index_buckets(snapped: DataFrame, roll: str, order: str, confidence: str, threshold: float, least: int) -> DataFrame:
    """Pages with a snap by index entry, with the most frequent middle name of their entries; numbered before small buckets go."""
    own = snapped.where("snap is not null").withColumn("last", F.col("snap.ilast")).withColumn("first", F.col("snap.ifirst")).withColumn("distance", F.col("snap.dist")).withColumn("_m", F.col("snap.imiddle"))
    keys = [roll, "last", "first"]
    best = own.groupBy(*keys).agg(F.max("distance").alias("max_distance"))
    middles = majority(own, keys, "_m", order).select(*keys, F.col("majority").alias("middle"))
    packets = rollup(own, keys, order, confidence, threshold).join(best, keys).join(middles, keys, "left").withColumn("middle", F.coalesce("middle", F.lit("")))
    return number(packets, roll, "first_frame").where(F.col("n_pages") >= least)


def fallback_packets(pages: DataFrame, packets: DataFrame, roll: str, order: str, last: str, first: str, middle: str, confidence: str, threshold: float, least: int) -> DataFrame:
    """The packets of index_buckets and behind them, numbered on, islands of at least so many pages over the pages without a snap, those without a name among them."""
    own = islands(pages.where("snap is null"), roll, order, boundary_key(F.col(last), F.col(first)))
    keys = [roll, "island"]
    found = rollup(own, keys, order, confidence, threshold).where(F.col("n_pages") >= least).join(majority_name(own, keys, last, first, middle, order).drop("votes"), keys)
    # Numbers go on behind the largest one in use: gaps of small buckets stay, so that no number is given twice.
    used = packets.groupBy(roll).agg(F.max("packet_no").alias("_used"))
    more = number(found, roll, "first_frame").join(used, roll, "left").withColumn("packet_no", (F.col("packet_no") + F.coalesce("_used", F.lit(0))).cast("int"))
    more = more.withColumn("packet_id", packet_id(F.col(roll), F.col("packet_no"))).withColumn("max_distance", F.lit(None).cast("int"))
    return packets.unionByName(more.select(*packets.columns))


def mergeable(packets: DataFrame, roll: str, order: str, last: str, first: str, begin: str, end: str) -> DataFrame:
    """Whether a packet may be merged with the one before it: names near (2, 2, sum 3), both last names known, 0 to 3 frames between."""
    w = Window.partitionBy(roll).orderBy(order)
    own = packets
    for c in (last, first, end):
        own = own.withColumn(f"_{c}", F.lag(c).over(w))
    d1, d2 = (F.levenshtein(norm(F.col(c)), norm(F.col(f"_{c}"))) for c in (last, first))
    gap = F.col(begin) - F.col(f"_{end}")
    ok = (norm(F.col(last)) != "") & (norm(F.col(f"_{last}")) != "") & (d1 <= 2) & (d2 <= 2) & (d1 + d2 <= 3) & gap.between(0, 3)
    return own.withColumn("mergeable", F.coalesce(ok, F.lit(False))).drop(f"_{last}", f"_{first}", f"_{end}")


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def top_name(names: list[tuple[str, str, str]]) -> tuple[str, str, str]:
    """(last, first, middle) of pages in order: the most frequent pair, its most frequent known middle name, of equals the one seen first; blank without any."""
    if not names:
        return "", "", ""
    pairs, middles = Counter((a, b) for a, b, _ in names), Counter()
    best = max(pairs, key=pairs.__getitem__)
    middles.update(m for a, b, m in names if (a, b) == best and m)
    return (*best, max(middles, key=middles.__getitem__) if middles else "")


def fold_packets(packets: list[dict], passes: int = MERGE_PASSES) -> list[dict]:
    """W4 on one roll's packets, each with begin, end, names (of its named pages in order), last, first, middle (after the snap), pages (a list), confs (of
    its pages) and flagged. A pass folds from the left; a merged packet takes the majority of its raw names, so its snap is cleared, and the flag of
    either side; passes go on until the number stays. Few names differ from one neighbour to the next, so distances are remembered."""
    known: dict[tuple[str, str], int] = {}

    def distance(a: str, b: str) -> int:
        if a == b or abs(len(a) - len(b)) > 2:
            return 0 if a == b else 3
        if (a, b) not in known:
            known[a, b] = edit_distance(a, b)
        return known[a, b]

    def near(a: dict, b: dict) -> bool:
        if not a["last"] or not b["last"] or not 0 <= b["begin"] - a["end"] <= 3:
            return False
        d, e = distance(a["last"], b["last"]), distance(a["first"], b["first"])
        return d <= 2 and e <= 2 and d + e <= 3

    for _ in range(passes):
        out: list[dict] = []
        for p in packets:
            if out and near(out[-1], p):
                q = out[-1]
                names = q["names"] + p["names"]
                last, first, middle = top_name(names)
                out[-1] = {"begin": q["begin"], "end": p["end"], "names": names, "last": last, "first": first, "middle": middle, "merged": True} | {k: q[k] + p[k] for k in ("pages", "confs")} | {"flagged": q["flagged"] or p["flagged"]}
            else:
                out.append(p)
        done, packets = len(out) == len(packets), out
        if done:
            break
    return packets


def with_snap(packets: DataFrame) -> DataFrame:
    """Packets with ``snap``: last and first of the index entry and its middle name, if it has one, else as they are; last_raw, first_raw, middle_raw, snap_applied (a name
    changed) and snap_distance (null if no entry is near)."""
    own = packets.withColumnsRenamed({"last": "last_raw", "first": "first_raw", "middle": "middle_raw"})
    own = own.withColumns({
        "last": F.coalesce("snap.ilast", "last_raw"), "first": F.coalesce("snap.ifirst", "first_raw"),
        "middle": F.when(blank(F.col("snap.imiddle")), F.col("middle_raw")).otherwise(F.coalesce("snap.imiddle", "middle_raw")),
    })
    applied = (F.col("last") != norm(F.col("last_raw"))) | (F.col("first") != norm(F.col("first_raw")))
    return own.withColumns({"snap_applied": applied & F.col("snap").isNotNull(), "snap_distance": F.col("snap.dist")}).drop("snap")


def snap_packets(packets: DataFrame, index: DataFrame, roll: str) -> DataFrame:
    """with_snap of the nearest index entries."""
    if "middle" not in packets.columns:
        packets = packets.withColumn("middle", F.lit(""))
    return with_snap(snap.nearest(packets, index, roll, "last", "first").drop("_l", "_f"))


def merge_to_fixpoint(pages: DataFrame, roll: str, order: str, last: str, first: str, island: str = "island", index: DataFrame | None = None, confidence: str | None = None, threshold: float = 0.7, middle: str | None = None, frame: str | None = None, merge: bool = True, near: str | None = None) -> DataFrame:
    """(roll, packet_no, packet_id, last, first, middle, begin, end, pages, frames, avg_confidence, flagged). A fold over one roll's packets in order, so the roll is the
    unit of work; rolls are bounded by the film's length. pages: with islands, order an integer frame; frame: its name, if it has another.

    index (of snap.roll_index): J1 before and after. Islands are compared by their snapped names, merged packets by their raw majority, and every packet
    is snapped at the end, which adds last_raw, first_raw, middle_raw, snap_applied and snap_distance. A majority is the name of some page, so the pages are
    snapped once, and the fold takes what it needs from them; near: a column of the pages that holds their snap already, instead of index. confidence: means and flags (any page
    under the threshold) are over all pages of a packet; without it they are null and false. merge: False leaves the islands as they are."""
    kind = dict(pages.dtypes)[roll]
    conf = F.col(confidence).cast("double") if confidence else F.lit(None).cast("double")
    indexed = index is not None or near is not None
    own = pages.select(F.col(roll), F.col(order).alias("_o"), norm(F.col(last)).alias("last"), norm(F.col(first)).alias("first"), (norm(F.col(middle)) if middle else F.lit("")).alias("middle"), F.col(island).alias("_i"), conf.alias("_c"), F.col(frame or order).cast("string").alias("_n"), *([F.col(near).alias("snap")] if near else []))
    if indexed and not near:
        own = snap.nearest(own, index, roll, "last", "first").drop("_l", "_f")
    entry = ("ilast", "ifirst", "imiddle", "dist")
    own = own.select(roll, "_o", "last", "first", "middle", "_i", "_c", "_n", *((F.col(f"snap.{c}").alias(f"_{c}") for c in entry) if indexed else ()))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("_o")
        snaps: dict[tuple[str, str], tuple] = {}
        if indexed:
            found = own[own["_ilast"].notna()]
            snaps = dict(zip(zip(found["last"], found["first"], strict=True), zip(found["_ilast"], found["_ifirst"], found["_imiddle"], found["_dist"].astype(int), strict=True), strict=True))
        packets = []
        for _, group in own.groupby("_i", sort=True):
            names = [x for x in zip(group["last"], group["first"], group["middle"], strict=True) if x[0] or x[1]]
            best = top_name(names)
            to = snaps.get(best[:2], best) if names else best
            confs = group["_c"].dropna().tolist()
            packets.append({"begin": int(group["_o"].iloc[0]), "end": int(group["_o"].iloc[-1]), "names": names, "last": to[0], "first": to[1], "middle": best[2], "pages": group["_n"].tolist(), "confs": confs, "flagged": any(c < threshold for c in confs)})
        rows = []
        for k, p in enumerate(fold_packets(packets) if merge else packets, 1):
            mean = sum(p["confs"]) / len(p["confs"]) if p["confs"] else None
            name = top_name(p["names"])
            rows.append((own[roll].iloc[0], k, *name, p["begin"], p["end"], len(p["pages"]), p["pages"], mean, p["flagged"], *snaps.get(name[:2], (None,) * len(entry))))
        return pd.DataFrame(rows, columns=[roll, "packet_no", "last", "first", "middle", "begin", "end", "pages", "frames", "avg_confidence", "flagged", *entry]).astype({"dist": "Int64"})

    merged = own.groupBy(roll).applyInPandas(run, f"{roll} {kind}, packet_no long, last string, first string, middle string, begin long, end long, pages long, frames array<string>, avg_confidence double, flagged boolean, ilast string, ifirst string, imiddle string, dist int")
    merged = merged.withColumn("packet_id", packet_id(F.col(roll), F.col("packet_no")))
    columns = [roll, "packet_no", "packet_id", "last", "first", "middle", "begin", "end", "pages", "frames", "avg_confidence", "flagged"]
    if not indexed:
        return merged.select(*columns)
    snapped = with_snap(merged.withColumn("snap", F.when(F.col("ilast").isNotNull(), F.struct(*entry))))
    return snapped.select(*columns, "last_raw", "first_raw", "middle_raw", "snap_applied", "snap_distance")


def alphabet_breaks(rows: DataFrame, roll: str, order: str, last: str) -> DataFrame:
    """Rows whose name sorts before the greatest one so far."""
    w = Window.partitionBy(roll).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("greatest", F.max(last).over(w)).where(F.col(last) < F.col("greatest"))


def frame_gaps(rows: DataFrame, roll: str, order: str) -> DataFrame:
    """The step from the frame before, where it is over 1."""
    return rows.withColumn("step", F.col(order) - F.lag(order).over(Window.partitionBy(roll).orderBy(order))).where("step > 1")


def inherit(rows: DataFrame, roll: str, order: str, value: Column) -> Column:
    """The value, else the last known one before."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(roll).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def one_marker(pages: DataFrame, roll: str, order: str, marker: str, confidence: str, head: int = 10, tail: int = 5) -> DataFrame:
    """Of a roll's START marks in its first frames and END marks in its last ones the surest stays, of equals the first START and the last END; ``kept_marker``
    is null for the others, ``downgraded`` says which they are."""
    w = Window.partitionBy(roll)
    own = pages.withColumn("_a", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    allowed = ((F.col(marker) == "START") & (F.col("_a") <= head)) | ((F.col(marker) == "END") & (F.col("_a") > F.col("_n") - tail))
    own = own.withColumn("_ok", F.coalesce(allowed, F.lit(False)))
    best = Window.partitionBy(roll, marker, "_ok").orderBy(F.desc(confidence), F.when(F.col(marker) == "END", -F.col("_a")).otherwise(F.col("_a")))
    own = own.withColumn("_rn", F.row_number().over(best))
    kept = F.when(F.col("_ok") & (F.col("_rn") == 1), F.col(marker))
    return own.withColumn("kept_marker", kept).withColumn("downgraded", F.col(marker).isNotNull() & F.col("kept_marker").isNull()).drop("_a", "_n", "_ok", "_rn")


def transitions(pages: DataFrame, roll: str, order: str, page_class: str, marker: str, run: int = 3) -> DataFrame:
    """The pages whose place breaks a rule, with ``rule``: student pages before START or after END, and each page of a run of unknown ones of such a length."""
    w = Window.partitionBy(roll)
    at = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    student = F.startswith(F.col(page_class), F.lit("student_"))
    own = pages.withColumn("_s", F.max(F.when(F.col(marker) == "START", 1).otherwise(0)).over(at)).withColumn("_e", F.max(F.when(F.col(marker) == "END", 1).otherwise(0)).over(at))
    own = own.withColumn("_any", F.max(F.when(F.col(marker) == "START", 1).otherwise(0)).over(w))
    own = own.withColumn("_u", F.sum(F.when(F.col(page_class) == "unknown", 0).otherwise(1)).over(w.orderBy(order)))
    own = own.withColumn("_long", F.count_if(F.col(page_class) == "unknown").over(Window.partitionBy(roll, "_u")))
    rule = F.when(student & (F.col("_e") == 1), "student after END").when(student & (F.col("_any") == 1) & (F.coalesce("_s", F.lit(0)) == 0), "student before START")
    rule = rule.when((F.col(page_class) == "unknown") & (F.col("_long") >= run), "unknown run")
    return own.withColumn("rule", rule).where("rule is not null").drop("_s", "_e", "_any", "_u", "_long")


def reconcile(pages: DataFrame, keys: list[str], last: str, first: str, middle: str, order: str, most: int = 2) -> DataFrame:
    """A page whose name differs from its packet's majority by at most so many edits in each part takes the majority's; ``overridden`` says so."""
    best = majority_name(pages, keys, last, first, middle, order).select(*keys, F.col("last").alias("_l"), F.col("first").alias("_f"))
    own = pages.join(best, keys, "left")
    near = has_name(F.col(last), F.col(first)) & (F.levenshtein(norm(F.col(last)), F.col("_l"), most) >= 0) & (F.levenshtein(norm(F.col(first)), F.col("_f"), most) >= 0)
    changed = F.coalesce(near & ((norm(F.col(last)) != F.col("_l")) | (norm(F.col(first)) != F.col("_f"))), F.lit(False))
    own = own.withColumn("overridden", changed)
    return own.withColumn(last, F.when(F.col("overridden"), F.col("_l")).otherwise(F.col(last))).withColumn(first, F.when(F.col("overridden"), F.col("_f")).otherwise(F.col(first))).drop("_l", "_f")


def downgrade(page_class: Column, last: Column, first: Column, dob: Column, school: Column, n_rows: Column, least_rows: int = 5) -> Column:
    """A cover without a name is unknown, one without date of birth and school a continuation; an index page of few rows is a cover if it has a name, else unknown."""
    return (
        F.when((page_class == "student_cover") & ~has_name(last, first), "unknown")
        .when((page_class == "student_cover") & blank(dob) & blank(school), "student_continuation")
        .when((page_class == "student_records_index") & (n_rows < least_rows), F.when(has_name(last, first), "student_cover").otherwise("unknown"))
        .otherwise(page_class)
    )


def size_outliers(packets: DataFrame, size: str, low: int = 1, high: int = 15) -> DataFrame:
    """Packets of suspicious size."""
    return packets.where((F.col(size) <= low) | (F.col(size) >= high))
