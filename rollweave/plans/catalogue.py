"""Named queries over the driver's tables, each by a library operator, with independent SQL. The tables hold no rolls, so each operator runs on a like shape:
roll = brand or user, frame = part key or time, (last, first) = the words of a part's name, nameless = 'error' events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as s
from ..operators import blocks, evaluate, packets, report, snap

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def t(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pages(spark, d) -> DataFrame:
    words = F.split("p_name", " ")
    return t(spark, d, "part").select(F.col("p_partkey").alias("frame"), F.col("p_brand").alias("roll"), F.upper(words[0]).alias("last"), F.upper(words[1]).alias("first"), F.col("p_retailprice").alias("conf"), F.col("p_size").alias("size"))


def index(p: DataFrame, most: int = 10) -> DataFrame:
    return snap.roll_index(p.where(F.col("size") <= most), "roll", "last", "first", "frame")


PG = "pg as (select p_partkey as frame, p_brand as roll, upper(split_part(p_name, ' ', 1)) as last, upper(split_part(p_name, ' ', 2)) as first, p_retailprice as conf, p_size as size from part)"
IX = "ix as (select roll, last as il, first as if_, min(frame) as pos from pg where size <= 10 group by 1, 2, 3)"


def _snap_sql(dist: str, most: int, extra: str = "", swapped: str = "false") -> str:
    return f"""with {PG}, {IX}, c as (select pg.*, il, if_, pos, {dist} as d, {swapped} as sw from pg join ix on pg.roll = ix.roll {extra}),
    b as (select *, row_number() over (partition by frame order by d, pos, sw) as rn from c where d <= {most})"""


_D1 = "case when levenshtein(last, il) <= 2 and levenshtein(first, if_) <= 2 then levenshtein(last, il) + levenshtein(first, if_) else 99 end"
_N = "case when levenshtein(last, il) <= 3 and levenshtein(first, if_) <= 3 then levenshtein(last, il) + levenshtein(first, if_) else 99 end"
_S = "case when levenshtein(first, il) <= 3 and levenshtein(last, if_) <= 3 then levenshtein(first, il) + levenshtein(last, if_) else 99 end"
_J2 = dict(dist=f"least({_N}, {_S})", most=4, swapped=f"({_S}) < ({_N})")


@query(_snap_sql(**_J2) + """, k as (select roll, il as last, if_ as first, count(*) as n_pages, round(avg(conf), 6) as avg_confidence, min(conf) < 950 as flagged, min(frame) as first_frame, max(d) as max_distance from b where rn = 1 group by 1, 2, 3),
    n as (select *, row_number() over (partition by roll order by first_frame) as packet_no from k)
    select roll, packet_no, last, first, n_pages, avg_confidence, flagged, first_frame, max_distance from n where n_pages >= 2""")
def resolve_index_mode(spark, d):
    """Flagship: pages snapped to the roll's index, bucketed by entry, numbered, small buckets dropped."""
    p = pages(spark, d)
    snapped = snap.nearest(p, index(p), "roll", "last", "first", caps=(3, 3, 4), swap=True).drop("last", "first")
    out = packets.index_buckets(snapped, "roll", "frame", "conf", 950.0, 2)
    return out.select("roll", "packet_no", "last", "first", "n_pages", F.round("avg_confidence", 6).alias("avg_confidence"), "flagged", "first_frame", "max_distance")


@query(_snap_sql(_D1, 3) + " select pg.frame, coalesce(il, last) as last, coalesce(if_, first) as first, d as distance, coalesce(d > 0, false) as applied from pg left join (select frame as f, il, if_, d from b where rn = 1) on f = pg.frame")
def snap_packet(spark, d):
    p = pages(spark, d)
    out = snap.nearest(p, index(p), "roll", "last", "first")
    return out.select("frame", F.coalesce("snap.ilast", "last").alias("last"), F.coalesce("snap.ifirst", "first").alias("first"), F.col("snap.dist").alias("distance"), F.coalesce(F.col("snap.dist") > 0, F.lit(False)).alias("applied"))


@query(_snap_sql(**_J2) + " select frame, il as last, if_ as first, d as distance, sw as swapped from b where rn = 1")
def snap_swapped(spark, d):
    p = pages(spark, d)
    out = snap.nearest(p, index(p), "roll", "last", "first", caps=(3, 3, 4), swap=True).where("snap is not null")
    return out.select("frame", F.col("snap.ilast").alias("last"), F.col("snap.ifirst").alias("first"), F.col("snap.dist").alias("distance"), F.col("snap.swapped").alias("swapped"))


_L = "case when levenshtein(last, il) > 2 then 99 when frame % 2 = 0 then levenshtein(last, il) when levenshtein(first, if_) <= 2 then levenshtein(last, il) + levenshtein(first, if_) else 99 end"


@query(_snap_sql(_L, 3) + " select frame, il as last, if_ as first, d as distance from b where rn = 1")
def snap_last_only(spark, d):
    p = pages(spark, d)
    out = snap.nearest(p.withColumn("first", F.when(F.col("frame") % 2 == 0, "").otherwise(F.col("first"))), index(p), "roll", "last", "first", first_optional=True).where("snap is not null")
    return out.select("frame", F.col("snap.ilast").alias("last"), F.col("snap.ifirst").alias("first"), F.col("snap.dist").alias("distance"))


@query(f"with {PG}, {IX} select roll, il as last, if_ as first, pos from ix")
def roll_index_first_seen(spark, d):
    return index(pages(spark, d)).select("roll", F.col("ilast").alias("last"), F.col("ifirst").alias("first"), "pos")


@query(_snap_sql(_D1, 3, "and pos < frame") + " select frame, il as last, if_ as first, d as distance from b where rn = 1")
def prefix_index(spark, d):
    """A page sees only index entries that came before it."""
    p = pages(spark, d)
    out = snap.nearest(p, index(p), "roll", "last", "first", carry=("frame",), visible=F.col("pos") < F.col("frame")).where("snap is not null")
    return out.select("frame", F.col("snap.ilast").alias("last"), F.col("snap.ifirst").alias("first"), F.col("snap.dist").alias("distance"))


@query(f"with {PG}, {IX}, n as (select distinct roll, last, first from pg), c as (select n.*, il, if_, pos, {_D1} as d from n join ix on n.roll = ix.roll), r as (select *, row_number() over (partition by roll, last, first order by d, pos) as rank from c where d <= 3) select roll, last, first, il as hint_last, if_ as hint_first, d as distance, rank from r where rank <= 5")
def topk_hints(spark, d):
    p = pages(spark, d)
    out = snap.hints(p, index(p), "roll", "last", "first")
    return out.select("roll", F.col("_l").alias("last"), F.col("_f").alias("first"), F.col("cand.ilast").alias("hint_last"), F.col("cand.ifirst").alias("hint_first"), F.col("cand.dist").alias("distance"), "rank")


# Events as pages


def events(spark, d) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("tick"), "user_id", "event_type", "value", "props")


EV = "ev as (select event_id, epoch_us(ts) as tick, user_id, event_type, value, props from events)"
_BR = f"{EV}, m as (select *, min(case when event_type = 'signup' then tick end) over (partition by user_id) as s, max(case when event_type = 'purchase' then tick end) over (partition by user_id) as e from ev), br as (select event_id, tick, user_id, event_type, value from m where (s is null or tick > s) and (e is null or tick < e))"


def bracketed(spark, d) -> DataFrame:
    return packets.bracket(events(spark, d), "user_id", "tick", F.col("event_type") == "signup", F.col("event_type") == "purchase")


@query(f"with {_BR} select event_id, user_id from br")
def bracket_window(spark, d):
    return bracketed(spark, d).select("event_id", "user_id")


_IS = """k as (select *, case when event_type <> 'error' then event_type end as key from {src} where event_type <> 'click'),
p as (select *, last_value(key ignore nulls) over (partition by user_id order by tick rows between unbounded preceding and 1 preceding) as prev from k),
i as (select *, sum(case when key is not null and (prev is null or key <> prev) then 1 else 0 end) over (partition by user_id order by tick rows unbounded preceding) as island from p),
isl as (select * from i where island > 0)"""


def runs(rows: DataFrame) -> DataFrame:
    """Clicks are skipped pages; errors are pages without a name."""
    return packets.islands(rows.where("event_type <> 'click'"), "user_id", "tick", F.when(F.col("event_type") != "error", F.col("event_type")))


@query(f"with {EV}, {_IS.format(src='ev')} select user_id, island::bigint as island, max(key) as name, count(*) as n_pages, min(tick) as first_at, max(tick) as last_at from isl group by 1, 2")
def islands_runs(spark, d):
    return runs(events(spark, d)).groupBy("user_id", "island").agg(F.max("key").alias("name"), F.count("*").alias("n_pages"), F.min("tick").alias("first_at"), F.max("tick").alias("last_at"))


@query(f"with {EV}, u as (select * from ev where value < 50 or value is null), {_IS.format(src='u')} select user_id, island::bigint as island, max(key) as name, count(*) as n_pages from isl group by 1, 2 having count(*) >= 3")
def unsnapped_islands(spark, d):
    """Islands over the pages that have no snap, of a least size."""
    left = events(spark, d).where("value < 50 or value is null")
    return runs(left).groupBy("user_id", "island").agg(F.max("key").alias("name"), F.count("*").alias("n_pages")).where("n_pages >= 3")


@query(f"""with {PG}, o as (select *, lag(last) over w as pl, lag(first) over w as pf, lag(frame) over w as pe from pg window w as (partition by roll order by frame))
select frame, coalesce(levenshtein(last, pl) <= 2 and levenshtein(first, pf) <= 2 and levenshtein(last, pl) + levenshtein(first, pf) <= 3 and frame - pe between 0 and 3, false) as mergeable from o""")
def adjacent_merge_candidates(spark, d):
    own = pages(spark, d).withColumn("end_frame", F.col("frame"))
    return packets.mergeable(own, "roll", "frame", "last", "first", "frame", "end_frame").select("frame", "mergeable")


@query()
def merge_fixpoint(spark, d):
    """Rolls are brands; frames are numbered within the roll, so that neighbours are near. Islands and merged packets are snapped to the roll's index."""
    w = Window.partitionBy("roll").orderBy("frame")
    p = pages(spark, d)
    own = p.withColumn("frame", F.row_number().over(w).cast("long"))
    own = packets.islands(own, "roll", "frame", s.coarse_key(F.col("last"), F.col("first")))
    return packets.merge_to_fixpoint(own, "roll", "frame", "last", "first", index=index(p), confidence="conf", threshold=950.0)


@query(f"with {EV}, c as (select user_id, event_type, count(*) as n, min(tick) as o from ev group by 1, 2), r as (select *, row_number() over (partition by user_id order by n desc, o) as rn from c) select user_id, event_type as majority, n as votes from r where rn = 1")
def majority_value(spark, d):
    return packets.majority(events(spark, d), ["user_id"], "event_type", "tick")


@query("""with c as (select l_orderkey, l_linestatus as v, count(*) as n, min(l_linenumber) as o from lineitem where l_returnflag <> 'N' group by 1, 2),
r as (select *, row_number() over (partition by l_orderkey order by n desc, o, v) as rn from c) select l_orderkey, v as majority, n as votes from r where rn = 1""")
def majority_middle(spark, d):
    own = t(spark, d, "lineitem").withColumn("middle", F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).otherwise(""))
    return packets.majority(own, ["l_orderkey"], "middle", "l_linenumber")


@query(f"with {EV}, {_IS.format(src='ev')} select user_id, island::bigint as island, count(*) as n_pages, round(avg(value), 6) as avg_confidence, min(value) < 5 as flagged, array_to_string(list(event_id order by event_id), ',') as frames from isl group by 1, 2")
def packet_rollup(spark, d):
    out = packets.rollup(runs(events(spark, d)), ["user_id", "island"], "event_id", "value", 5.0)
    return out.select("user_id", "island", "n_pages", F.round("avg_confidence", 6).alias("avg_confidence"), "flagged", F.array_join(F.transform("frames", lambda x: x.cast("string")), ",").alias("frames"))


@query(f"with {EV}, {_IS.format(src='ev')} select user_id, island::bigint as island, count(*) as n_pages from isl group by 1, 2 having count(*) >= 2")
def having_min_bucket(spark, d):
    return runs(events(spark, d)).groupBy("user_id", "island").agg(F.count("*").alias("n_pages")).where("n_pages >= 2")


# Ground truth

_FILE = """case p_partkey % 9 when 0 then '(LAST) ' || p_name || '.pdf' when 1 then split_part(p_name, ' ', 1) || '.pdf' when 2 then p_partkey || '.pdf' when 3 then split_part(p_name, ' ', 1) || ' county, ' || split_part(p_name, ' ', 2) || '.pdf'
when 4 then split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || '_' || p_size || '.pdf' when 5 then p_name || ' Q.pdf' when 6 then '12' || split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || ' Ann Lee.PDF' else split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || '.pdf' end"""
_ROLL = "case when p_size = 50 then 'roll 003 ' else 'ROLL 001' end"
_GT = f"""g as (select p_partkey, {_FILE} as name, {_ROLL} as roll from part),
st as (select *, trim(regexp_replace(name, '(?i)\\.pdf$', '')) as stem from g), ba as (select *, trim(regexp_replace(stem, '_[0-9]+$', '')) as base from st),
sp as (select *, contains(base, ',') as comma, trim(substr(base, strpos(base, ',') + 1)) as aft from ba),
wd as (select *, string_split_regex(case when comma then aft else base end, '\\s+') as w from sp),
nm as (select *, case when comma then trim(split_part(base, ',', 1)) else w[1] end as l0, case when comma then w[1] else coalesce(w[2], '') end as f0, array_to_string(case when comma then w[2:] else w[3:] end, ' ') as m0 from wd),
dg as (select *, regexp_replace(l0, '^[0-9]+', '') as l1, regexp_replace(f0, '^[0-9]+', '') as f1 from nm),
rs as (select *, case when upper(trim(roll)) in ('ROLL 003', 'ROLL 005', 'ROLL 006') then 'sham_merge' when regexp_matches(stem, '(?i)\\((LAST|FIRST|MIDDLE)\\)') then 'placeholder'
  when regexp_matches(upper(stem), 'BIRTH|COUNTY|SEX|PLACE|CITY|NAME|LAST|FIRST|MIDDLE|RECORD') then 'ocr_garbage' when regexp_matches(l0, '^[0-9]+$') then 'numeric_only' when trim(l1) = '' or trim(f1) = '' then 'too_short' end as drop_reason from dg)"""


def cleaned(spark, d) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", s.clean_gt(F.expr(_FILE), F.expr(_ROLL)).alias("c")).select("p_partkey", "c.*")


@query(f"with {_GT} select p_partkey, case when drop_reason is null then upper(l1) end as last, case when drop_reason is null then upper(f1) end as first, case when drop_reason is null then upper(m0) end as middle, drop_reason from rs")
def gt_clean(spark, d):
    return cleaned(spark, d)


@query(f"with {_GT} select drop_reason, count(*) as n from rs where drop_reason is not null group by 1")
def drop_reasons(spark, d):
    return evaluate.drop_reasons(cleaned(spark, d))


def packets_and_truth(spark, d) -> tuple[DataFrame, DataFrame]:
    own = pages(spark, d).withColumn("middle", F.lit(""))
    return own.where("size % 2 = 0").select("roll", F.col("frame").alias("packet_pos"), "last", "first", "middle"), own.where("size % 2 = 1").select("roll", F.col("frame").alias("gt_pos"), "last", "first", "middle")


@query(f"with {PG}, a as (select *, row_number() over (partition by roll, last, first order by frame) as k from pg where size % 2 = 0), b as (select *, row_number() over (partition by roll, last, first order by frame) as k from pg where size % 2 = 1) select a.roll, a.frame as packet_pos, b.frame as gt_pos from a left join b on a.roll = b.roll and a.last = b.last and a.first = b.first and a.k = b.k")
def greedy_exact_match(spark, d):
    p, g = packets_and_truth(spark, d)
    return evaluate.exact_match(p, g, "roll").select("roll", "packet_pos", "gt_pos")


@query()
def greedy_fuzzy_match(spark, d):
    return evaluate.greedy_match(*packets_and_truth(spark, d), "roll")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def unmatched_pred(spark, d):
    return t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


@query("select l.doc_id from labels l left join (select doc_id from documents where lang = 'en') e using (doc_id) where e.doc_id is null")
def unmatched_gt(spark, d):
    return t(spark, d, "labels").join(t(spark, d, "documents").where("lang = 'en'"), "doc_id", "left_anti").select("doc_id")


@query("""select count(*) as packets, count(*) filter (where quality = 1) as exact, count(*) filter (where quality = 0 and toxic = 0) as partial,
count(*) - count(*) filter (where quality = 1) - count(*) filter (where quality = 0 and toxic = 0) as unmatched,
coalesce(count(*) filter (where quality = 1)::double / nullif(count(*), 0), 0) as exact_rate, coalesce(count(*) filter (where quality = 1 or toxic = 0)::double / nullif(count(*), 0), 0) as match_rate from labels join documents using (doc_id)""")
def eval_report(spark, d):
    own = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id"), "doc_id")
    return evaluate.report(own.select((F.col("quality") == 1).alias("exact"), ((F.col("quality") == 0) & (F.col("toxic") == 0)).alias("partial")))


# Scalars

_RAW = "case p_partkey % 6 when 0 then '''' || p_name || ', ' when 1 then p_name || ' with' when 2 then p_name || ' COUNTY' when 3 then 'Mr. ' || p_name when 4 then split_part(p_name, ' ', 1) || ' School' else p_name || ' (LAST)' end"
_CLEAN = f"trim(regexp_replace(regexp_replace(trim({_RAW}), '^[''`\"]+', ''), '[,\\s]+$', ''))"
for _n in s.NOISE_SUFFIXES:
    _CLEAN = f"(select case when ends_with(x, '{_n}') then trim(left(x, length(x) - {len(_n)})) else x end from (select {_CLEAN} as x))"


@query(f"select p_partkey, {_CLEAN} as name from part")
def name_clean(spark, d):
    return t(spark, d, "part").select("p_partkey", s.clean_name(F.expr(_RAW.replace("''''", "'\\''"))).alias("name"))


@query(f"""with c as (select p_partkey, {_CLEAN} as x from part) select p_partkey, length(x) >= 3 and regexp_matches(x, '^[A-Za-z][A-Za-z''\\-\\. ,]{{1,60}}[A-Za-z\\.]$')
and not list_has_any(regexp_extract_all(upper(x), '[A-Z]+'), [{', '.join(f"'{g}'" for g in s.GARBAGE_TOKENS)}]) and not regexp_matches(upper(x), '^({'|'.join(p.replace('.', chr(92) + '.') for p in s.PARENT_PREFIXES)})') as valid from c""")
def name_valid(spark, d):
    return t(spark, d, "part").select("p_partkey", s.valid_name(F.expr(_RAW.replace("''''", "'\\''"))).alias("valid"))


@query("""with o as (select o_orderkey, month(o_orderdate) as m, (o_orderkey % 40)::int as dd, (o_orderkey * 7 % 130)::int as y from orders), z as (select *, case when y < 100 then case when y >= 30 then 1900 + y else 2000 + y end else 1880 + y end as yy, case when y < 100 then y else 1880 + y end as ys from o)
select o_orderkey, dd between 1 and 31 and yy between 1900 and 2010 and not (m = dd and dd = ys) as valid from z""")
def dob_valid(spark, d):
    y = F.col("o_orderkey") * 7 % 130
    year = F.when(y < 100, F.lpad(y.cast("string"), 2, "0")).otherwise((y + 1880).cast("string"))
    dob = F.concat_ws("/", F.month("o_orderdate").cast("string"), (F.col("o_orderkey") % 40).cast("string"), year)
    return t(spark, d, "orders").select("o_orderkey", s.valid_dob(dob).alias("valid"))


@query("select p_partkey, p_type <> '' and (contains(lower(p_name), lower(split_part(p_name, ' ', 2))) or false) and p_size > 0 as hit, regexp_replace(lower('Mr. ' || p_name), '^([a-z]\\.\\s+|w\\.\\s+|mr\\.\\s+|mrs\\.\\s+)', '') as bare from part")
def substring_match(spark, d):
    name = F.concat(F.lit("Mr. "), F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", (s.either_contains(F.col("p_name"), F.split("p_name", " ")[1]) & (F.col("p_size") > 0)).alias("hit"), s.strip_title(name).alias("bare"))


@query("""with m as (select l_orderkey, l_returnflag as form, l_returnflag || l_linestatus as name, least(l_quantity * 2, 100) as conf, l_linenumber * 1000000 + l_partkey as pos from lineitem),
g as (select l_orderkey, form, count(*) as n, sum(conf) as total, max(conf) as top, min(pos) as first, arg_min(name, (-conf, pos, name)) as name from m group by 1, 2),
w as (select *, row_number() over (partition by l_orderkey order by n desc, total desc, first) as rn from g)
select l_orderkey, name, round(case when n >= 3 then 0.85 + least(0.10, top * 0.001) when n = 2 then 0.75 + least(0.10, top * 0.001) else 0.40 + least(0.20, top * 0.002) end, 3)::double as confidence, n as agreement from w where rn = 1""")
def source_vote(spark, d):
    own = t(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("form"), F.concat("l_returnflag", "l_linestatus").alias("name"), F.least(F.col("l_quantity") * 2, F.lit(100.0)).alias("conf"), (F.col("l_linenumber") * F.lit(1000000).cast("long") + F.col("l_partkey")).alias("pos"))
    return report.vote(own, ["l_orderkey"], "form", "name", "conf", "pos").select("l_orderkey", "name", "confidence", "agreement")


# Blocks

_TAGS = {"lines": "<p", "tables": "<ul", "cells": "<li", "keys": "<a ", "signatures": "<footer"}


def fingerprints(spark, d) -> DataFrame:
    n = lambda tag: (F.size(F.split("html", tag, -1)) - 1).cast("long")
    return t(spark, d, "pages").select("page_id", F.upper("html").alias("upper"), *(n(tag).alias(c) for c, tag in _TAGS.items()))


_FP = "fp as (select page_id, upper(html) as u, " + ", ".join(f"((length(html) - length(replace(html, '{tag}', ''))) // {len(tag)})::bigint as {c}" for c, tag in _TAGS.items()) + " from pages)"


@query(f"with {_FP} select page_id, {', '.join(_TAGS)} from fp")
def block_fingerprint(spark, d):
    return fingerprints(spark, d).drop("upper")


def _any(phrases) -> str:
    return "(" + " or ".join(f"contains(u, '{p}')" for p in phrases) + ")"


_HITS = "(" + " + ".join(f"contains(u, '{p}')::int" for p in blocks.COVER_PHRASES) + ")"


@query(f"""with {_FP}, c as (select page_id, case when lines = 0 then ['unknown', '0.0'] when tables >= 1 and cells >= 20 then ['student_records_index', '0.95'] when signatures >= 1 and keys >= 3 and lines between 20 and 40 then ['roll_separator', '0.9']
when keys >= 10 and lines >= 80 then ['student_cover', '0.85'] when {_any(blocks.INDEX_PHRASES)} then ['student_records_index', '0.85'] when {_any(blocks.CERTIFICATE_PHRASES)} then ['roll_separator', '0.85']
when lines < 25 and tables = 0 and signatures = 0 then ['roll_separator', '0.8'] when {_any(blocks.TEST_PHRASES)} then ['student_test_sheet', '0.75'] when {_HITS} >= 3 or ({_HITS} >= 2 and lines >= 80) then ['student_cover', '0.8']
when lines between 25 and 80 and {_HITS} < 2 then ['roll_leader', '0.65'] when lines >= 80 and {_HITS} < 2 then ['student_continuation', '0.6'] else ['unknown', '0.3'] end as r from fp) select page_id, r[1] as page_class, r[2]::double as confidence from c""")
def layout_class(spark, d):
    own = fingerprints(spark, d)
    return own.select("page_id", blocks.layout_class(*(F.col(c) for c in ("upper", "lines", "tables", "cells", "keys", "signatures"))).alias("c")).select("page_id", "c.*")


@query("select conv_id, string_agg(text, ' ' order by turn) as page_text from conversations group by 1")
def page_text(spark, d):
    own = t(spark, d, "conversations")
    return blocks.child_text(own.select("conv_id").distinct(), own, ["conv_id"], "turn", "text").withColumnRenamed("child_text", "page_text")


@query("""with c as (select l_orderkey, string_agg(l_returnflag || l_linestatus, ' ' order by l_linenumber, l_returnflag || l_linestatus) as x from lineitem group by 1) select o_orderkey, coalesce(x, '') as child_text from orders left join c on o_orderkey = l_orderkey""")
def edge_text(spark, d):
    children = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("w"))
    return blocks.child_text(t(spark, d, "orders").select("o_orderkey"), children, ["o_orderkey"], "l_linenumber", "w")


@query("with r as (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_partkey) as rn from lineitem where l_returnflag <> 'N') select l_orderkey, l_partkey as best from r where rn = 1")
def best_value(spark, d):
    own = t(spark, d, "lineitem").where("l_returnflag <> 'N'")
    return blocks.best_by(own, ["l_orderkey"], F.col("l_partkey"), [F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey")])


@query("with r as (select *, row_number() over (partition by conv_id order by turn) as rn from conversations where role = 'assistant') select conv_id, text as best from r where rn = 1")
def first_answer(spark, d):
    return blocks.best_by(t(spark, d, "conversations").where("role = 'assistant'"), ["conv_id"], F.col("text"), [F.asc("turn")])


@query("with r as (select *, row_number() over (partition by conv_id order by turn) as rn from conversations where length(text) between 20 and 200) select conv_id, text as best from r where rn = 1")
def first_valid_line(spark, d):
    return blocks.best_by(t(spark, d, "conversations").where(F.length("text").between(20, 200)), ["conv_id"], F.col("text"), [F.asc("turn")])


def cells(spark, d) -> DataFrame:
    """A table per supplier, a row per line number, four columns; row 1 of every other table is a header."""
    own = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("tab"), F.col("l_linenumber").alias("r"), (F.col("l_partkey") % 4 + 1).cast("int").alias("c"), F.col("l_orderkey").alias("o"), "l_returnflag", "l_partkey")
    head = F.element_at(F.array(*map(F.lit, ("Last name", "FIRST", "middle", "Date of birth"))), F.col("c"))
    return own.select("tab", "r", "c", F.struct("o", "l_partkey").alias("o"), F.when((F.col("r") == F.col("tab") % 3 + 1), head).when(F.col("l_returnflag") == "N", F.concat(F.lit("v"), F.col("l_partkey").cast("string"))).otherwise("").alias("text"))


_CELLS = """ce as (select l_suppkey as tab, l_linenumber as r, (l_partkey % 4 + 1)::int as c, l_orderkey as o, l_partkey as pk, case when l_linenumber = l_suppkey % 3 + 1 then ['Last name', 'FIRST', 'middle', 'Date of birth'][(l_partkey % 4 + 1)::int] when l_returnflag = 'N' then 'v' || l_partkey else '' end as text from lineitem)"""
_HEAD = "f as (select tab, r from ce where r between 1 and 3 and trim(text) <> '' group by 1, 2 having count(*) >= 3), hd as (select t.tab, coalesce(min(f.r), 1) as header_row from (select distinct tab from ce) t left join f using (tab) group by 1)"
_COLS = "fc as (select tab, case when contains(upper(text), 'LAST') then 'last' when contains(upper(text), 'FIRST') then 'first' when contains(upper(text), 'MIDDLE') then 'middle' when contains(upper(text), 'DOB') or contains(upper(text), 'BIRTH') then 'dob' end as field, c from ce join hd using (tab) where r = header_row), fld as (select tab, field, min(c) as c from fc where field is not null group by 1, 2)"


@query(f"with {_CELLS} select tab, r, " + ", ".join(f"arg_max(text, (o, pk, text)) filter (where c = {k}) as c{k}" for k in range(1, 5)) + " from ce group by 1, 2")
def grid_pivot(spark, d):
    out = blocks.grid(cells(spark, d), ["tab"], "r", "c", "text", "o", [1, 2, 3, 4])
    return out.select("tab", "r", *(F.col(str(k)).alias(f"c{k}") for k in range(1, 5)))


@query(f"with {_CELLS}, {_HEAD} select tab, header_row from hd")
def grid_header(spark, d):
    return blocks.header_row(cells(spark, d), ["tab"], "r", "text")


@query(f"with {_CELLS}, {_HEAD}, {_COLS}, ok as (select tab from fld where field in ('last', 'first') group by 1 having count(*) = 2), v as (select ce.tab, r, field, arg_max(trim(text), (o, pk, text)) as x from ce join hd using (tab) join fld on fld.tab = ce.tab and fld.c = ce.c where r > header_row and ce.tab in (select tab from ok) group by 1, 2, 3), z as (select tab, r, " + ", ".join(f"coalesce(max(x) filter (where field = '{f}'), '') as {f}" for f, _ in blocks.HINTS) + " from v group by 1, 2) select * from z where last <> '' or first <> ''")
def grid_rows(spark, d):
    own = cells(spark, d).withColumn("o", F.struct("o.o", "o.l_partkey", "text"))
    heads = blocks.header_row(own, ["tab"], "r", "text")
    return blocks.grid_rows(own, heads, blocks.header_columns(own, heads, ["tab"], "r", "c", "text"), ["tab"], "r", "c", "text", "o")


def _boxes(spark, d) -> DataFrame:
    e = lambda k: F.col("embedding")[k].cast("double")
    return t(spark, d, "embeddings").select("label", "vec_id", F.abs(e(0)).alias("top"), F.abs(e(1)).alias("left"), (F.abs(e(2)) / 10).alias("width"), F.abs(e(3)).alias("height"), F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("text")).withColumnRenamed("label", "page").withColumnRenamed("vec_id", "id")


def _near(spark, d, direction: str) -> DataFrame:
    own = _boxes(spark, d)
    first = own.groupBy("page").agg(F.min(F.struct("id", "top", "left", "width", "height")).alias("a"))
    anchors = first.select("page", *(F.col(f"a.{c}").alias(f"a_{c}") for c in ("id", "top", "left", "width", "height")))
    return blocks.nearest_word(own, "page", anchors, direction).select("page", "id", "text")


def _near_sql(ok: str, gap: str, most: str) -> str:
    return f"""with w as (select label as page, vec_id as id, abs(embedding[1]::double) as t, abs(embedding[2]::double) as l, abs(embedding[3]::double) / 10 as wd, abs(embedding[4]::double) as h from embeddings),
    a as (select page, arg_min(w, id) as a from w group by 1), p as (select w.*, {gap} as gap from w join a using (page) where w.id <> a.id and {ok}), r as (select *, row_number() over (partition by page order by gap, id) as rn from p where gap between -0.005 and {most})
    select page, id, 'w' || id as text from r where rn = 1"""


@query(_near_sql("abs(t - a.t) <= a.h", "l - (a.l + a.wd)", "0.30"))
def bbox_right(spark, d):
    return _near(spark, d, "right")


@query(_near_sql("abs(l - a.l) <= a.wd", "t - (a.t + a.h)", "0.05"))
def bbox_below(spark, d):
    return _near(spark, d, "below")


# Reports

_KINDS = {"purchase": "n_covers", "signup": "n_indexes", "view": "n_leaders", "error": "n_unknown"}


@query("select c_nationkey as district, grouping(c_nationkey)::int as is_total, count(*) as total, round(sum(coalesce(value, 0)), 2) as spend, " + ", ".join(f"count(*) filter (where event_type = '{k}') as {n}" for k, n in _KINDS.items()) + ", count(*) filter (where event_type = 'purchase' and coalesce(value, 0) >= 70) as shipped, round(coalesce(count(*) filter (where event_type = 'purchase' and coalesce(value, 0) >= 70)::double / nullif(count(*) filter (where event_type = 'purchase'), 0), 0), 6) as ship_rate from events join customer on user_id = c_custkey group by rollup (c_nationkey)")
def district_scorecard(spark, d):
    own = t(spark, d, "events").join(t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("district")), "user_id")
    out = report.scorecard(own, "district", F.col("event_type"), F.col("value"), F.col("value"), _KINDS, "purchase", 70.0)
    return out.withColumn("spend", F.round("spend", 2)).withColumn("ship_rate", F.round("ship_rate", 6))


@query("select user_id, count(*) as sampled, count(*) filter (where event_type = 'error') as errors, count(*) filter (where event_type = 'view') as n_index, count(*) filter (where event_type not in ('view', 'error')) as n_other, coalesce(sum(event_id % 7) filter (where event_type = 'view'), 0)::bigint as index_rows, coalesce(string_agg(event_id::varchar, ',' order by event_id) filter (where event_type = 'view'), '') as index_frames from events group by 1")
def roll_summary(spark, d):
    out = report.roll_summary(t(spark, d, "events"), ["user_id"], F.col("event_type") == "view", F.when(F.col("event_type") == "error", "e"), F.col("event_id") % 7, "event_id")
    return out.withColumn("index_frames", F.array_join(F.transform("index_frames", lambda x: x.cast("string")), ","))


@query("select n_nationkey as district, count(distinct user_id) as rolls, count(distinct case when event_type = 'view' then user_id end) as rolls_with_index from nation left join customer on c_nationkey = n_nationkey left join events on user_id = c_custkey group by 1")
def district_distinct(spark, d):
    own = t(spark, d, "events").join(t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("district")), "user_id")
    return report.distinct_counts(own, t(spark, d, "nation").select(F.col("n_nationkey").alias("district")), "district", "user_id", F.col("event_type") == "view")


@query(f"with {EV}, r as (select *, row_number() over (partition by user_id order by tick) as a, count(*) over (partition by user_id) as n from ev) select event_id from r where a <= 40 or a > n - 5")
def first_n_last_m(spark, d):
    return report.first_and_last(events(spark, d), ["user_id"], "tick").select("event_id")


@query("with o as (select o_custkey, o_orderkey, round(o_totalprice * 100)::bigint as cents from orders), s as (select *, coalesce(sum(cents) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding), 0) as b from o) select o_orderkey, b::bigint as spent_before from s where b < 50000000")
def budget_cutoff(spark, d):
    own = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return report.within_budget(own, ["o_custkey"], "o_orderkey", "cents", 50000000).select("o_orderkey", "spent_before")


@query("with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) select * from r where rank <= 3")
def top_n_group(spark, d):
    return report.top_n(t(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels where toxic = 0)")
def resume_antijoin(spark, d):
    return report.not_done(t(spark, d, "documents"), t(spark, d, "labels"), ["doc_id"], F.col("toxic") == 1).select("doc_id", "source")


@query("select n_name, r_name as feature, round((n_nationkey + 1) * case r_regionkey when 0 then 0.0015 when 1 then 0.05 when 2 then 0.015 when 3 then 0.004 else 0.015 end, 6)::double as usd from nation, region")
def job_matrix(spark, d):
    """Every fixture with every feature; both sides are fixed lists."""
    feature = F.element_at(F.array(*map(F.lit, ("detect", "forms", "tables", "layout", "queries"))), F.col("r_regionkey") + 1)
    jobs = t(spark, d, "nation").crossJoin(t(spark, d, "region"))
    return jobs.select("n_name", F.col("r_name").alias("feature"), F.round(s.price(feature, F.col("n_nationkey") + 1), 6).alias("usd"))


@query("select n_nationkey, i as n, lpad(i::varchar, 5, '0') || '.tif' as file from nation, unnest(generate_series(1, n_nationkey + 3)) as g(i)")
def key_range(spark, d):
    from ..sources.records import key_range as expand

    own = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.lit(1).cast("long").alias("a"), (F.col("n_nationkey") + 3).cast("long").alias("b"))
    return expand(own, "a", "b").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n", "file")


@query("select 'conversations' as feature, conv_id as id, text from conversations union all select 'documents', doc_id, text from documents where lang = 'fr'")
def union_blocks(spark, d):
    a = t(spark, d, "conversations").select(F.lit("conversations").alias("feature"), F.col("conv_id").alias("id"), "text")
    return a.unionByName(t(spark, d, "documents").where("lang = 'fr'").select(F.lit("documents").alias("feature"), F.col("doc_id").alias("id"), "text"))


@query("select event_id, (props::json ->> '$.k')::bigint as k from events")
def json_props(spark, d):
    """a reply with text around its JSON."""
    reply = F.concat(F.lit("Sure: ```json\n"), F.col("props"), F.lit("\n``` done"))
    return t(spark, d, "events").select("event_id", F.from_json(s.reply_json(reply), "k bigint")["k"].alias("k"))


@query("select doc_id, case when lang = 'en' then 'dear' else 'cheap' end as route, case when lang = 'en' then n_chars * 2 else n_chars end as cost from documents")
def cascade_split(spark, d):
    side = lambda route, by: lambda df: df.select("doc_id", F.lit(route).alias("route"), (F.col("n_chars") * by).alias("cost"))
    return report.cascade(t(spark, d, "documents"), F.col("lang") == "en", side("dear", 2), side("cheap", 1))


@query("select event_type, count(*) as n, round(count(*)::double * 100 / sum(count(*)) over ()::double, 6) as share from events group by 1")
def audit_share(spark, d):
    own = t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return own.withColumn("share", F.round(F.col("n").cast("double") * 100 / F.sum("n").over(Window.partitionBy()).cast("double"), 6))


@query("select epoch_us(date_trunc('hour', ts)) as hour_us, count(*) as n, round(sum(value), 2) as usd from events group by 1")
def audit_hourly(spark, d):
    own = t(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("usd"))
    return own.select(F.unix_micros(F.col("h").cast("timestamp")).alias("hour_us"), "n", "usd")


@query("select user_id, event_type, count(*) as attempts from events group by 1, 2 having count(*) > 1")
def audit_retry(spark, d):
    return t(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("attempts")).where("attempts > 1")


@query("with o as (select c_nationkey, c_custkey, c_mktsegment, max(c_mktsegment) over (partition by c_nationkey order by c_custkey rows between unbounded preceding and 1 preceding) as greatest from customer) select c_custkey, c_mktsegment, greatest from o where c_mktsegment < greatest")
def alpha_break(spark, d):
    return packets.alphabet_breaks(t(spark, d, "customer"), "c_nationkey", "c_custkey", "c_mktsegment").select("c_custkey", "c_mktsegment", "greatest")


@query("with o as (select user_id, event_id, event_id - lag(event_id) over (partition by user_id order by event_id) as step from events) select user_id, event_id, step from o where step > 1")
def frame_gap(spark, d):
    return packets.frame_gaps(t(spark, d, "events"), "user_id", "event_id").select("user_id", "event_id", "step")


@query(f"with {EV} select event_id, last_value(case when event_type <> 'error' then event_type end ignore nulls) over (partition by user_id order by tick rows unbounded preceding) as name from ev")
def inherit_name(spark, d):
    return events(spark, d).withColumn("name", packets.inherit(None, "user_id", "tick", F.when(F.col("event_type") != "error", F.col("event_type")))).select("event_id", "name")


@query("select doc_id, reason from (select d.doc_id, unnest([case when n_chars < 200 then 'short' end, case when lang <> 'en' then 'language' end, case when quality = 0 then 'quality' end]) as reason from documents d left join labels l using (doc_id)) where reason is not null")
def review_queue(spark, d):
    own = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    return report.review_reasons(own, {"short": F.col("n_chars") < 200, "language": F.col("lang") != "en", "quality": F.col("quality") == 0}).select("doc_id", "reason")


from . import page_queries  # noqa: E402, F401  its queries join this catalogue
