"""The thin queries over the driver's tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate as dc, licenses, line_dedup, media, mixing, near_dedup, pii, suffix_dedup, toxicity, url_filter
from .common import prepare, table

#: The chain's categories, in order. The labels table has one toxicity column, so the chain starts from low quality, which comes before it.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("row.doc_id", "source", "lang", "topic", "tokens", "expected", "copies")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return media.ogg_features(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.score(docs, chain).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed", "n_removed_lines", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = dc.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [pii.counted("base", kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    return out.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("all").alias("spans"))


def queries():
    return {f.__name__: f for f in (op1_mix, op2_near_dedup, op3_ogg, op4_suffix_dedup, op5_toxicity, op6_line_dedup, op7_url_filter, op8_decontaminate, op9_license_scan, op10_pii)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _mix_sql() -> str:
    dims = mixing.DIMENSIONS
    legal = "contains(coalesce(text, ''), 'icense') or contains(coalesce(text, ''), 'opyright')"
    out = rf"""with d as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
      case when {legal} then 'legal' when contains(coalesce(text, ''), '@') then 'contact' when contains(coalesce(text, ''), ' | ') then 'table' else 'prose' end as topic,
      len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\x0B\x0C]+'))::bigint as tokens from documents),
    c as (select source, lang, topic, sum(tokens)::double as t from d where tokens > 0 group by all),
    tot as (select sum(t) as total from c)"""
    for d in dims:
        out += f", g_{d} as (select {d}, power(sum(t), {mixing.ALPHA}) as g from c group by {d}), t_{d} as (select {d}, g / (select sum(g) from g_{d}) as goal from g_{d})"
    out += ", r0 as (select c.*, t / (select total from tot) as w from c)"
    n = 0
    for _ in range(mixing.ROUNDS):
        for d in dims:
            out += f", r{n + 1} as (select source, lang, topic, t, w * goal / sum(w) over (partition by {d}) as w from r{n} join t_{d} using ({d}))"
            n += 1
    out += f", p as (select source, lang, topic, round({mixing.RATE} * (select total from tot) * w / t, 6) as ratio from r{n})"
    return out + """, e as (select d.*, case when tokens > 0 then coalesce(ratio, 0.0) else 0.0 end::double as expected, ('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint / 4503599627370496.0 as u
      from d left join p using (source, lang, topic))
    select doc_id, source, lang, topic, tokens, expected, (floor(expected) + case when u < expected - floor(expected) then 1 else 0 end)::bigint as copies from e"""


_NEAR_SQL = rf"""with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end as sh from w),
e as (select doc_id, len(sh) as n, unnest(sh) as g from s),
p as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as c from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p where 100 * c >= 75 * (nx + ny - c)),
u as (select x, y from l union all select y, x from l),
r as (select doc_id as node, doc_id as seen from documents union select r.node, u.y from r join u on u.x = r.seen)
select s.doc_id, len(sh)::bigint as n_shingles, c.cid as component_id, s.doc_id = c.cid as kept
from s join (select node, min(seen) as cid from r group by node) c on c.node = s.doc_id"""

_LINE_SQL = rf"""with t as (select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from t),
h as (select *, ('0x' || substr(md5(line), 1, 7))::bigint as h from l),
f as (select *, coalesce(h <> lag(h) over (partition by doc_id order by i), true)::int as fresh from h),
q as (select *, sum(fresh) over (partition by doc_id order by i rows unbounded preceding) as run from f),
r as (select doc_id, run, any_value(h) as h, count(*) as k from q group by 1, 2),
b as (select *, k > 1 or coalesce(lead(k) over w, 2) > 1 or coalesce((h + {line_dedup.FACTOR}::bigint * lag(h) over w) % {line_dedup.PRIME} % {line_dedup.DIVISOR} = 0, false) as cut from r window w as (partition by doc_id order by run)),
g as (select doc_id, run, coalesce(sum(cut::int) over (partition by doc_id order by run rows between unbounded preceding and 1 preceding), 0) as no from b),
n as (select q.doc_id, i, line, no from q join g on q.doc_id = g.doc_id and q.run = g.run),
c as (select doc_id, no, count(*) as lines, string_agg(line, chr(10) order by i) as chunk from n group by 1, 2),
k as (select *, case when lines >= {line_dedup.LEAST_LINES} and regexp_matches(chunk, '[^ \t\n\x0B\f\r]') then row_number() over (partition by chunk, lines >= {line_dedup.LEAST_LINES} order by doc_id, no) > 1 else false end as gone from c)
select doc_id, sum(lines)::bigint as n_lines, count(*)::bigint as n_chunks, count(*) filter (where gone)::bigint as n_removed,
  coalesce(sum(lines) filter (where gone), 0)::bigint as n_removed_lines,
  sha256(coalesce(string_agg(chunk, chr(10) order by no) filter (where not gone), '')) as kept_sha256 from k group by doc_id"""

_URL_SQL = r"""with u as (select page_id, case when contains(coalesce(url, ''), '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
m as (select *, '.' || host || path as canon,
  case when ends_with('.' || host, '.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
       when ends_with('.' || host, '.example.org') and starts_with(path, '/es/') then 'example.org/es/'
       when ends_with('.' || host, '.com') and starts_with(path, '/fr/') then 'com/fr/'
       when ends_with('.' || host, '.com') and starts_with(path, '/de/') then 'com/de/'
       when ends_with('.' || host, '.org') and starts_with(path, '/') then 'org/' end as rule from p)
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
  when regexp_full_match(canon, '(?s).*spam.*|[^/]*\.ads\..*|[^/]*casino.*|.*/login.*|.*\.zip|.*\.exe|.*/wp-admin/.*') then 'block' else 'allow' end as verdict from m"""

_CONTAMINATION_SQL = rf"""with d as (select doc_id, {_WORDS} as ws from documents),
b as (select item_id, {_WORDS} as ws from benchmark),
g as (select distinct item_id, least(len(ws), {dc.WINDOW}) as m, array_to_string(ws[i:i + least(len(ws), {dc.WINDOW}) - 1], ' ') as gram
  from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), {dc.WINDOW}) + 2)) as i from b where len(ws) > 0)),
m as (select distinct m from g),
x as (select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from d, m where len(ws) >= m),
y as (select doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') as gram from x),
z as (select doc_id, y.m, i, item_id from y join g on y.m = g.m and y.gram = g.gram),
hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + m)) as p from z) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item_id::varchar as item from z) group by 1)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated from d left join hit using (doc_id) left join its using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": _mix_sql(), "op2_near_dedup": _NEAR_SQL, "op6_line_dedup": _LINE_SQL, "op7_url_filter": _URL_SQL, "op8_decontaminate": _CONTAMINATION_SQL}
