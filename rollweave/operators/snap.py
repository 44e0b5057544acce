"""Fuzzy nearest-match joins to a group's index (A6, J1-J3, J10, W11, Z5, Z11, Z15). The group is the equi-key, so no join is a plain product; edit distances run in the
JVM with a bound, over the distinct names of a group, after a length band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import blank, norm, strip


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order; not dropDuplicates, which keeps any."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def roll_index(rows: DataFrame, roll: str, last: str, first: str, pos: str, dob: str | None = None, middle: str | None = None) -> DataFrame:
    """(roll, ilast, ifirst, imiddle, dob, pos, last_raw, first_raw) of the first-seen (last, first, dob); rows without any name are dropped, near duplicates stay."""
    own = rows.where(~(blank(F.col(last)) & blank(F.col(first))))
    side = lambda c: F.coalesce(F.col(c), F.lit("")) if c else F.lit("")
    own = own.select(F.col(roll).alias(roll), norm(F.col(last)).alias("ilast"), norm(F.col(first)).alias("ifirst"), side(middle).alias("imiddle"), side(dob).alias("dob"), F.col(pos).alias("pos"), F.col(last).alias("last_raw"), F.col(first).alias("first_raw"))
    return first_seen(own, [roll, "ilast", "ifirst", *(["dob"] if dob else [])], ["pos"])


def _within(a: Column, b: Column, cap: int) -> Column:
    """The edit distance up to cap, else null."""
    d = F.when(F.abs(F.length(a) - F.length(b)) <= cap, F.levenshtein(a, b, cap))
    return F.when(d >= 0, d)


def _letters(c: Column) -> Column:
    """The characters of a name as bits. One edit changes at most two of them, so names with more than 2n different bits are over n edits apart."""
    return F.aggregate(F.split(c, ""), F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(x), F.lit(64)))))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Dealt by key over all shuffle partitions: few bytes that make many pairs, which adaptive execution would put together into a task or two for their size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _keys(first_optional: bool, last: str, first: str) -> tuple[Column, Column]:
    """What is compared. Without first names (J3) commas at the end of the last name don't count."""
    return norm(F.regexp_replace(strip(F.col(last)), r",+$", "") if first_optional else F.col(last)), norm(F.col(first))


def candidates(pages: DataFrame, index: DataFrame, roll: str, last: str, first: str, caps=(2, 2, 3), swap: bool = False, first_optional: bool = False, visible: Column | None = None, carry: tuple[str, ...] = (), dob: str | None = None, strict: tuple[int, int, int] | None = None) -> DataFrame:
    """All index entries within the caps (last, first, sum) of each distinct (roll, last, first, *carry): _l, _f and cand = struct(dist, pos, swapped, ilast, ifirst, imiddle).
    strict, narrower caps: ``near``, the same struct where the entry is within them unswapped, else null, so that one join serves both.

    carry: columns that ``visible``, a further condition, needs (J10: what came before the page). dob (Z15), one of them: entries with another known date of birth
    are out, those with the same one are 2 nearer, the caps looking at names alone."""
    l, f = _keys(first_optional, last, first)  # noqa: E741
    names = pages.select(roll, l.alias("_l"), f.alias("_f"), *carry).distinct().withColumn("_lb", _letters(F.col("_l"))).withColumn("_fb", _letters(F.col("_f")))
    if "imiddle" not in index.columns:
        index = index.withColumn("imiddle", F.lit(""))
    if dob:
        index = index.withColumnRenamed("dob", "_idob")
    index = index.withColumn("_ilb", _letters(F.col("ilast"))).withColumn("_ifb", _letters(F.col("ifirst")))
    joined = spread(names, roll).join(index.select(roll, "ilast", "ifirst", "imiddle", "pos", "_ilb", "_ifb", *(["_idob"] if dob else []), *(c for c in index.columns if visible is not None and c not in (roll, "ilast", "ifirst", "imiddle", "pos", "_idob", "_ilb", "_ifb", *carry))), roll)
    if visible is not None:
        joined = joined.where(visible)
    joined = joined.where(F.col("_l") != "" if first_optional else (F.col("ifirst") != ""))
    # The letters rule most pairs out before any distance is worked out.
    differ = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    firsts = differ("_fb", "_ifb")
    alike = differ("_lb", "_ilb") + (F.when(F.col("_f") == "", 0).otherwise(firsts) if first_optional else firsts) <= 2 * caps[2]
    if swap:
        alike |= differ("_fb", "_ilb") + differ("_lb", "_ifb") <= 2 * caps[2]
    joined = joined.where(alike)
    d_last = _within(F.col("_l"), F.col("ilast"), caps[0])
    if first_optional:
        dist = d_last + F.when(F.col("_f") == "", 0).otherwise(_within(F.col("_f"), F.col("ifirst"), caps[1]))
    else:
        dist = d_last + _within(F.col("_f"), F.col("ifirst"), caps[1])
    other = _within(F.col("_f"), F.col("ilast"), caps[0]) + _within(F.col("_l"), F.col("ifirst"), caps[1]) if swap else F.lit(None).cast("int")
    joined = joined.withColumn("_d", dist).withColumn("_o", other)
    best, swapped = F.least("_d", "_o"), F.coalesce(F.col("_o") < F.coalesce("_d", F.lit(99)), F.lit(False))
    joined = joined.withColumn("_b", best).where(F.col("_b") <= caps[2])
    if dob:
        known = (F.coalesce(dob, F.lit("")) != "") & (F.coalesce("_idob", F.lit("")) != "")
        joined = joined.where(~known | (F.col(dob) == F.col("_idob"))).withColumn("_b", F.col("_b") - F.when(known, 2).otherwise(0))
    found = lambda dist, turned: F.struct(dist.alias("dist"), "pos", turned.alias("swapped"), "ilast", "ifirst", "imiddle")
    extra = []
    if strict:
        inside = (d_last <= strict[0]) & (F.col("_d") - d_last <= strict[1]) & (F.col("_d") <= strict[2])
        extra = [F.when(inside, found(F.col("_d"), F.lit(False))).alias("near")]
    return joined.select(roll, "_l", "_f", *carry, found(F.col("_b"), swapped).alias("cand"), *extra)


def nearest(pages: DataFrame, index: DataFrame, roll: str, last: str, first: str, carry: tuple[str, ...] = (), **options) -> DataFrame:
    """The pages with ``snap``, the best candidate (least distance, then first in the index, then not swapped), null if none; with ``strict``, also ``near``, the best within those caps."""
    best = candidates(pages, index, roll, last, first, carry=carry, **options).groupBy(roll, "_l", "_f", *carry)
    best = best.agg(F.min("cand").alias("snap"), *([F.min("near").alias("near")] if options.get("strict") else []))
    l, f = _keys(options.get("first_optional", False), last, first)  # noqa: E741
    own = pages.withColumn("_l", l).withColumn("_f", f)
    return own.join(best, [roll, "_l", "_f", *carry], "left")


def hints(pages: DataFrame, index: DataFrame, roll: str, last: str, first: str, n: int = 5, **options) -> DataFrame:
    """The n nearest candidates of each distinct name, ranked."""
    found = candidates(pages, index, roll, last, first, **options)
    w = Window.partitionBy(roll, "_l", "_f").orderBy("cand")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


#: Characters that are easily taken for each other on film, each with what is tried in its place.
CONFUSED = (("0", "O"), ("O", "0"), ("1", "L"), ("1", "I"), ("L", "1"), ("I", "1"), ("5", "S"), ("S", "5"), ("8", "B"), ("B", "8"), ("6", "G"), ("G", "6"), ("RN", "M"), ("M", "RN"))


def dictionary_snap(names: DataFrame, name: str, dictionary: DataFrame, word: str, frequency: str, swaps: tuple = CONFUSED) -> DataFrame:
    """``snapped`` of each name: itself, if the dictionary has it; else its most frequent entry one swap of confused characters away; else the most frequent one
    at most one edit away; else itself. No join compares all with all: both sides meet by the words that dropping one letter leaves."""
    own = names.select(norm(F.col(name)).alias("_w")).distinct()
    words = dictionary.select(norm(F.col(word)).alias("_e"), F.col(frequency).alias("_n")).groupBy("_e").agg(F.max("_n").alias("_n"))
    shorter = lambda c: F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1)))))
    swapped = F.array_distinct(F.array(*(F.replace(F.col("_w"), F.lit(a), F.lit(b)) for a, b in swaps)))
    exact = own.join(words.withColumnRenamed("_e", "_w"), "_w").select("_w", F.struct(F.lit(0).alias("r"), (-F.col("_n")).alias("n"), F.col("_w").alias("e")).alias("c"))
    near = own.select("_w", F.explode(swapped).alias("_e")).join(words, "_e").select("_w", F.struct(F.lit(1).alias("r"), (-F.col("_n")).alias("n"), F.col("_e").alias("e")).alias("c"))
    edits = own.select("_w", F.explode(shorter(F.col("_w"))).alias("_k")).join(words.select("_e", "_n", F.explode(shorter(F.col("_e"))).alias("_k")), "_k").where(F.levenshtein("_w", "_e") <= 1)
    edits = edits.select("_w", F.struct(F.lit(2).alias("r"), (-F.col("_n")).alias("n"), F.col("_e").alias("e")).alias("c"))
    best = exact.unionByName(near).unionByName(edits).groupBy("_w").agg(F.min("c").alias("c"))
    return names.withColumn("_w", norm(F.col(name))).join(best, "_w", "left").withColumn("snapped", F.coalesce("c.e", "_w")).drop("_w", "c")
