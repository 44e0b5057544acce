"""Votes, scorecards, samples, budgets, resuming (A10, A14-A18, J8, J9, O6', O7, P13, P16, S12, W8-W10, X8, Z1, Z2, Z18, Z19, Z22-Z24)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import ratio, vote_confidence

# Counters of the scorecard.
CLASS_COUNTERS = {"student_cover": "n_covers", "student_records_index": "n_indexes", "roll_separator": "n_separators", "roll_leader": "n_leaders", "student_continuation": "n_continuation", "student_test_sheet": "n_test_sheet", "unknown": "n_unknown"}
SHIP_AT = 0.70


def vote(members: DataFrame, keys: list[str], form: str, text: str, confidence: str, pos: str) -> DataFrame:
    """A10, M2: members are cleaned, valid and have a normal form. The form with the most members, then the highest sum of confidence, then the first
    one, wins; its name is the text of its most confident member, the first of equals."""
    groups = members.groupBy(*keys, form).agg(
        F.count("*").alias("agreement"), F.sum(confidence).alias("total"), F.max(confidence).alias("top"), F.min(pos).alias("first"), F.min(F.struct(-F.col(confidence), F.col(pos), F.col(text).alias("t"))).alias("lead"), F.array_sort(F.collect_list(pos)).alias("sources")
    )
    w = Window.partitionBy(*keys).orderBy(F.desc("agreement"), F.desc("total"), "first")
    won = groups.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return won.select(*keys, F.col("lead.t").alias("name"), vote_confidence(F.col("agreement"), F.col("top")).alias("confidence"), "agreement", "sources")


def scorecard(rows: DataFrame, group: str, page_class: Column, confidence: Column, spend: Column, counters: dict[str, str] = CLASS_COUNTERS, cover: str = "student_cover", ship_at: float = SHIP_AT) -> DataFrame:
    """Counts by class, spend and shipped covers per group, and a grand total (group null, is_total 1). Missing classes are unknown, missing numbers 0."""
    kind, sure = F.coalesce(page_class, F.lit("unknown")), F.coalesce(confidence, F.lit(0.0))
    own = rows.select(F.col(group), kind.alias("_c"), sure.alias("_s"), F.coalesce(spend, F.lit(0.0)).alias("_u"))
    out = own.rollup(group).agg(
        F.grouping(group).cast("int").alias("is_total"), F.count("*").alias("total"), F.sum("_u").alias("spend"), *(F.count_if(F.col("_c") == k).alias(n) for k, n in counters.items()), F.count_if((F.col("_c") == cover) & (F.col("_s") >= ship_at)).alias("shipped")
    )
    return out.withColumn("ship_rate", ratio(F.col("shipped"), F.col(counters[cover])))


def first_and_last(rows: DataFrame, keys: list[str], order: str, first: int = 40, last: int = 5) -> DataFrame:
    """The first and last rows of a group; all of a small one."""
    w = Window.partitionBy(*keys)
    own = rows.withColumn("_a", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    return own.where((F.col("_a") <= first) | (F.col("_a") > F.col("_n") - last)).drop("_a", "_n")


def within_budget(rows: DataFrame, keys: list[str], order: str, cost: str, ceiling) -> DataFrame:
    """Rows whose cost so far, before them, is under the ceiling; the one that crosses it stays. Budgets are kept per group (a run, a day), so sums run in parallel."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("spent_before", F.coalesce(F.sum(cost).over(w), F.lit(0))).where(F.col("spent_before") < ceiling)


def top_n(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """W10."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def not_done(jobs: DataFrame, done: DataFrame, keys: list[str], failed: Column | None = None) -> DataFrame:
    """The jobs without a record; records that failed don't count as done."""
    done = done if failed is None else done.where(~F.coalesce(failed, F.lit(False)))
    return jobs.join(done.select(*keys).distinct(), keys, "left_anti")


def cascade(rows: DataFrame, gate: Column, enrich: Callable[[DataFrame], DataFrame], plain: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Only gated rows go through the dear step. Split and union: a function under a condition would run on all rows."""
    gate = F.coalesce(gate, F.lit(False))
    return enrich(rows.where(gate)).unionByName(plain(rows.where(~gate)))


def roll_summary(rows: DataFrame, keys: list[str], is_index: Column, error: Column, n_rows: Column, frame: str) -> DataFrame:
    """Rows with an error are counted and left out of the class counts."""
    ok = error.isNull()
    return rows.groupBy(*keys).agg(F.count("*").alias("sampled"), F.count_if(~ok).alias("errors"), F.count_if(ok & is_index).alias("n_index"), F.count_if(ok & ~is_index).alias("n_other"), F.coalesce(F.sum(F.when(ok & is_index, n_rows)), F.lit(0)).cast("long").alias("index_rows"), F.array_sort(F.collect_list(F.when(ok & is_index, F.col(frame)))).alias("index_frames"))


def distinct_counts(rows: DataFrame, groups: DataFrame, group: str, roll: str, is_index: Column) -> DataFrame:
    """Rolls, and rolls with an index, of each group; groups without rows have 0."""
    counted = rows.groupBy(group).agg(F.count_distinct(roll).alias("rolls"), F.count_distinct(F.when(is_index, F.col(roll))).alias("rolls_with_index"))
    return groups.join(counted, group, "left").fillna(0, ["rolls", "rolls_with_index"])


def review_reasons(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """A row per reason that holds."""
    flags = F.array(*(F.when(c, F.lit(n)) for n, c in reasons.items()))
    return rows.withColumn("reason", F.explode(F.filter(flags, lambda x: x.isNotNull())))


def to_pull(wanted: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """The frames that aren't there yet; how many were pulled is their count."""
    return not_done(wanted, there, keys)


def job_list(left: DataFrame, right: DataFrame, order: list[str], seed: int | None = None) -> DataFrame:
    """Every pair of two fixed lists, numbered in order, or in an order drawn by a hash of the pair and a seed, so that a rerun draws alike."""
    jobs = left.crossJoin(right)
    by = [F.xxhash64(F.lit(seed), *order), *order] if seed is not None else order
    return jobs.withColumn("job", F.row_number().over(Window.orderBy(*by)))


def exportable(rows: DataFrame, is_index: Column, n_rows: Column, least: int = 3) -> DataFrame:
    """Index frames with enough rows to be worth exporting."""
    return rows.where(is_index & (n_rows >= least))


def sample_names(rows: DataFrame, keys: list[str], frame: str, names: str, frames: int = 2, per_frame: int = 2, most: int = 4) -> DataFrame:
    """O6': of each group's first index frames the first names that aren't blank. names: an array column."""
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(frame))).where(F.col("_rn") <= frames)
    firsts = F.filter(F.slice(F.coalesce(names, F.array().cast("array<string>")), 1, per_frame), lambda n: F.coalesce(n != "", F.lit(False)))
    listed = ranked.withColumn("_f", firsts).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_rn", "_f"))).alias("_all"))
    return listed.select(*keys, F.slice(F.flatten(F.transform("_all", lambda x: x["_f"])), 1, most).alias("sample_names"))


def budget_guard(spend: DataFrame, keys: list[str], usd: str, ceiling: float) -> DataFrame:
    """What each run has spent, and whether that reaches the ceiling (0: none)."""
    out = spend.groupBy(*keys).agg(F.round(F.sum(usd), 6).alias("spent"))
    return out.withColumn("halt", F.lit(ceiling > 0) & (F.col("spent") >= ceiling)).withColumn("left", F.greatest(F.lit(float(ceiling)) - F.col("spent"), F.lit(0.0)))


def progress(pages: DataFrame, keys: list[str], done: Column, started: str, expected: DataFrame | None = None) -> DataFrame:
    """Per roll the pages done, their share in percent, and the seconds to go at the pace so far. started: seconds since the roll began. expected: (keys, n) if not all pages are rows yet."""
    out = pages.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(done).alias("done"), F.max(F.when(done, F.col(started))).alias("_at"))
    if expected is not None:
        out = out.drop("n").join(expected, keys, "right").fillna(0, ["done"])
    share = F.round(100 * ratio(F.col("done"), F.col("n")), 2)
    eta = F.round(F.try_divide(F.col("_at") * (F.col("n") - F.col("done")), F.col("done")), 3)
    return out.select(*keys, "n", "done", share.alias("percent"), eta.alias("eta_seconds"))


def gauges(pages: DataFrame, status: Column, usd: Column, review: Column, throttled: Column) -> DataFrame:
    """Pages, cost, open reviews and throttles by status."""
    return pages.groupBy(status.alias("status")).agg(F.count("*").alias("pages"), F.round(F.sum(F.coalesce(usd, F.lit(0.0))), 6).alias("usd"), F.count_if(review).alias("open_reviews"), F.count_if(throttled).alias("throttles"))


def audit_errors(rows: DataFrame, keys: list[str], error: Column, at: str, n: int) -> DataFrame:
    """The latest errors of each group, newest first."""
    return top_n(rows.where(error), keys, [F.desc(at)], n)


def audit_totals(rows: DataFrame, by: list[Column], usd: str, n: int | None = None) -> DataFrame:
    """Calls and spend, in all, by model, by purpose or by roll; the dearest first and at most n, if asked for."""
    out = rows.groupBy(*by).agg(F.count("*").alias("calls"), F.round(F.sum(usd), 2).alias("usd"))
    return out if n is None else out.orderBy(F.desc("usd"), *by).limit(n)


def template_hits(pages: DataFrame, templates: DataFrame, page: str, hash_column: str, most: int = 5) -> DataFrame:
    """(page, template, bits): templates, a fixed list, whose 64-bit perceptual hash differs in at most so many bits."""
    own = pages.select(page, F.col(hash_column).alias("_h")).crossJoin(F.broadcast(templates.select("template", F.col("template_hash").alias("_t"))))
    return own.withColumn("bits", F.bit_count(F.col("_h").bitwiseXOR(F.col("_t")))).where(F.col("bits") <= most).select(page, "template", "bits")


def blank_class(deviation: Column, at: Column, n: Column, limit: float = 8.0, head: int = 7, tail: int = 3) -> Column:
    """A frame whose pixels hardly vary is a leader at the roll's ends and unknown inside it; null if they do vary."""
    return F.when(deviation < limit, F.when((at <= head) | (at > n - tail), "roll_leader").otherwise("unknown"))
