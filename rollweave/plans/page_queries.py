"""Named queries of the page jobs: evaluation, grouping, extraction from OCR blocks, checks, reports. Records and blocks are built from the driver's tables; the SQL works on the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as s
from ..operators import evaluate, extract, packets, report, snap
from ..sources import records
from . import jobs
from .catalogue import _FILE, EV, PG, SQL, _GT, events, index, packets_and_truth, pages, query, runs, t

# Greedy matching


def greedy_sql(packets_cte: str, truth_cte: str, name: str = "m") -> str:
    """CTEs that end in ``name`` (roll, packet_pos, gt_pos, grade). packets_cte: (roll, packet_pos, last, first, middle); truth_cte likewise with gt_pos. The recursion walks through each roll's packets and carries what is used."""
    lev = "levenshtein(p.last, g.last) <= 3 + (length(g.last) >= 7)::int and levenshtein(p.first, g.first) <= 3 + (length(g.first) >= 7)::int"
    same = "p.last = g.last and p.first = g.first"
    return f"""{name}p as (select *, row_number() over (partition by roll order by packet_pos) as k from {packets_cte}),
    {name}c as (select p.roll, p.k, p.packet_pos, list(gt_pos order by gt_pos) filter (where {same} and (p.middle = g.middle or p.middle = '' or g.middle = '')) as fit,
      list(gt_pos order by gt_pos desc) filter (where {same}) as named, list(gt_pos order by gt_pos) filter (where {lev}) as near from {name}p p left join {truth_cte} g on p.roll = g.roll group by all),
    {name}r as (select roll, 0::bigint as k, null::bigint as packet_pos, null::bigint as gt_pos, 'none' as grade, []::bigint[] as used from (select distinct roll from {name}p)
      union all select roll, k, packet_pos, gt_pos, grade, case when gt_pos is null then used else list_append(used, gt_pos) end from
        (select roll, k, packet_pos, coalesce(f, n, e) as gt_pos, case when f is not null then 'exact' when coalesce(n, e) is not null then 'partial' else 'none' end as grade, used from
          (select c.roll, c.k, c.packet_pos, r.used, list_filter(c.fit, lambda x: not list_contains(r.used, x))[1] as f, list_filter(c.named, lambda x: not list_contains(r.used, x))[1] as n,
            list_filter(c.near, lambda x: not list_contains(r.used, x))[1] as e from {name}r r join {name}c c on c.roll = r.roll and c.k = r.k + 1))),
    {name} as (select roll, packet_pos, gt_pos, grade from {name}r where k > 0)"""


_MATCH = "pk as (select roll, frame::bigint as packet_pos, last, first, '' as middle from pg where size % 2 = 0), gt as (select roll, frame::bigint as gt_pos, last, first, '' as middle from pg where size % 2 = 1)"
SQL["greedy_fuzzy_match"] = f"with recursive {PG}, {_MATCH}, {greedy_sql('pk', 'gt')} select * from m"


def named_packets(spark, d) -> DataFrame:
    """Parts of even size as packets; every fifth one's raw name has its first letter doubled, its snapped one hasn't; middle names are letters or blank."""
    own = pages(spark, d).where("size % 2 = 0")
    raw = F.when(F.col("frame") % 5 == 0, F.concat(F.left("last", F.lit(1)), "last")).otherwise(F.col("last"))
    middle = F.when(F.col("frame") % 3 == 0, "A").when(F.col("frame") % 3 == 1, "B").otherwise("")
    return own.select("roll", F.col("frame").alias("packet_no"), "last", "first", middle.alias("middle"), raw.alias("last_raw"), F.col("first").alias("first_raw"), middle.alias("middle_raw"), (F.col("frame") % 5 == 0).alias("snap_applied"))


def truth_files(spark, d) -> DataFrame:
    return t(spark, d, "part").where("p_size % 2 = 1").select(F.col("p_brand").alias("roll"), F.expr(_FILE).alias("name"), "p_partkey")


_TRUTH = f"""tf as (select p_brand as roll, {_FILE} as name from part where p_size % 2 = 1), t0 as (select *, row_number() over (partition by roll order by name) as gt_pos from tf),"""
_EVAL = (
    _GT.replace(f"g as (select p_partkey, {_FILE} as name, case when p_size = 50 then 'roll 003 ' else 'ROLL 001' end as roll from part)", "g as (select * from t0)")
    + """, gt as (select roll, gt_pos, upper(l1) as last, upper(f1) as first, upper(m0) as middle from rs where drop_reason is null),
    ml as (select roll, frame::bigint as packet_pos, last, first, case frame % 3 when 0 then 'A' when 1 then 'B' else '' end as middle, case when frame % 5 = 0 then left(last, 1) || last else last end as raw from pg where size % 2 = 0),
    pa as (select roll, packet_pos, raw as last, first, middle from ml), pb as (select roll, packet_pos, last, first, middle from ml)"""
)


@query(f"""with recursive {PG}, {_TRUTH} {_EVAL}, {greedy_sql('pa', 'gt', 'a')}, {greedy_sql('pb', 'gt', 'b')},
    pt as (select roll, count(*) as pages_total, count(*) filter (where size <= 10) as index_frames_total, round(sum(conf / 1000), 6) as usd_total, sum(size)::bigint as tokens_in_total, sum(size * 2)::bigint as tokens_out_total from pg group by 1),
    ix as (select roll, count(distinct (last, first)) as index_rows_total from pg where size <= 10 group by 1),
    pc as (select roll, count(*) as n, count(*) filter (where packet_pos % 5 = 0) as snapped from ml group by 1),
    dc as (select roll, count(*) as raw, count(*) filter (where drop_reason is null) as usable from rs group by 1),
    dr as (select roll, string_agg(drop_reason || '=' || n, ',' order by drop_reason) as reasons from (select roll, drop_reason, count(*) as n from rs where drop_reason is not null group by 1, 2) group by 1),
    ga as (select roll, count(*) filter (where grade = 'exact') as e, count(*) filter (where grade = 'partial') as p, count(*) filter (where grade = 'none') as n from a group by 1),
    gb as (select roll, count(*) filter (where grade = 'exact') as e, count(*) filter (where grade = 'partial') as p, count(*) filter (where grade = 'none') as n from b group by 1),
    up as (select pb.roll, string_agg(last || '|' || first, ',' order by pb.packet_pos) as x from pb join b on b.roll = pb.roll and b.packet_pos = pb.packet_pos where grade = 'none' group by 1),
    ug as (select gt.roll, string_agg(trim(last) || '|' || trim(first), ',' order by gt.gt_pos) as x from gt left join (select roll, gt_pos from b where gt_pos is not null) u on u.roll = gt.roll and u.gt_pos = gt.gt_pos where u.gt_pos is null group by 1)
    select pt.roll, pages_total, pages_total as pages_classified, pc.n as packets_predicted, usable as packets_ground_truth, raw as gt_rows_raw, usable as gt_rows_usable, coalesce(reasons, '') as gt_rows_dropped_reasons,
      ga.e as exact_matches_pre, ga.p as partial_matches_pre, ga.n as no_match_pre, round(ga.e::double / pc.n, 6) as accuracy_exact_pre, round((ga.e + ga.p)::double / pc.n, 6) as accuracy_partial_pre,
      gb.e as exact_matches_post, gb.p as partial_matches_post, gb.n as no_match_post, round(gb.e::double / pc.n, 6) as accuracy_exact_post, round((gb.e + gb.p)::double / pc.n, 6) as accuracy_partial_post,
      index_frames_total, coalesce(index_rows_total, 0) as index_rows_total, snapped as packets_snapped, usd_total, tokens_in_total, tokens_out_total, coalesce(up.x, '') as unmatched_predictions, coalesce(ug.x, '') as unmatched_ground_truth
    from pt join pc using (roll) join dc using (roll) left join ix using (roll) left join dr using (roll) join ga using (roll) join gb using (roll) left join up using (roll) left join ug using (roll)""")
def eval_full(spark, d):
    """The whole report, a row for each roll, over two greedy matches."""
    p = pages(spark, d)
    rows = p.select("roll", F.when(F.col("size") <= 10, "student_records_index").otherwise("student_cover").alias("page_class"), (F.col("conf") / 1000).alias("usd_cost"), F.col("size").alias("tokens_in"), (F.col("size") * 2).alias("tokens_out"))
    totals = evaluate.page_totals(rows, index(p), "roll")
    out = evaluate.evaluate(named_packets(spark, d), evaluate.clean_truth(truth_files(spark, d), "roll", "name"), totals, "roll")
    reasons = F.array_join(F.transform(F.array_sort(F.map_entries("gt_rows_dropped_reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("roll", *(reasons.alias(c) if c == "gt_rows_dropped_reasons" else F.array_join(c, ",").alias(c) if c.startswith("unmatched_") else F.round(c, 6).alias(c) if c.startswith(("accuracy", "usd")) else c for c in evaluate.REPORT))


@query(f"with recursive {PG}, {_MATCH}, {greedy_sql('pk', 'gt')} select pk.roll, packet_pos, last || '|' || first as name from m join pk using (roll, packet_pos) where grade = 'none'")
def unmatched_predictions(spark, d):
    """J12 on matched packets."""
    p, g = packets_and_truth(spark, d)
    return evaluate.unmatched(p, evaluate.greedy_match(p, g, "roll"), "roll", "packet_pos")


@query("""with l as (select quality = 1 as e, toxic = 0 and quality = 0 as p from labels), c as (select count(*) as n, count(*) filter (where e or p) as r from l), x as (select r::double / n as precision, r::double / (2 * n) as recall from c)
select round(precision, 6) as precision, round(recall, 6) as recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) as f1 from x""")
def precision_recall(spark, d):
    """Z20's ratios, taking the truth as twice the labels."""
    own = t(spark, d, "labels").agg(F.count("*").alias("n"), F.count_if(F.expr("quality = 1 or toxic = 0")).alias("r"))
    out = evaluate.precision_recall(own, F.col("r"), F.col("n"), F.col("n") * 2)
    return out.select(*(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


# Votes, keys, packets

_PAIR = "pr as (select p_size as roll, p_partkey as frame, upper(split_part(p_name, ' ', 1)) as l, case when p_partkey % 3 = 0 then '' else upper(split_part(p_name, ' ', 2)) end as f, case p_partkey % 4 when 0 then 'X' when 1 then 'Y' else '' end as m from part)"


def pair_pages(spark, d) -> DataFrame:
    """Rolls by part size; every third page lacks its first name."""
    w, k = F.split("p_name", " "), F.col("p_partkey")
    return t(spark, d, "part").select(F.col("p_size").alias("roll"), k.alias("frame"), w[0].alias("last"), F.when(k % 3 == 0, "").otherwise(w[1]).alias("first"), F.when(k % 4 == 0, "x").when(k % 4 == 1, "y").otherwise("").alias("middle"))


@query(f"""with {_PAIR}, c as (select roll, l, f, count(*) as n, min(frame) as o from pr group by 1, 2, 3), w as (select *, row_number() over (partition by roll order by n desc, o) as rn from c),
    mm as (select roll, l, f, m, count(*) as n, min(frame) as o from pr where m <> '' group by 1, 2, 3, 4), mw as (select *, row_number() over (partition by roll, l, f order by n desc, o) as rn from mm)
    select w.roll, w.l as last, w.f as first, coalesce(m, '') as middle, w.n as votes from w left join mw on mw.roll = w.roll and mw.l = w.l and mw.f = w.f and mw.rn = 1 where w.rn = 1""")
def pair_majority(spark, d):
    """A1, A2: the vote on the pair of names, and the middle name among its pages."""
    return packets.majority_name(pair_pages(spark, d), ["roll"], "last", "first", "middle", "frame")


@query(f"""with {PG}, ix as (select roll, last as il, first as if_, min(frame) as pos from pg where size <= 10 and roll < 'Brand#4' group by 1, 2, 3),
    c as (select pg.frame, il, if_, row_number() over (partition by frame order by levenshtein(last, il) + levenshtein(first, if_), pos) as rn from pg join ix using (roll) where levenshtein(last, il) <= 2 and levenshtein(first, if_) <= 2 and levenshtein(last, il) + levenshtein(first, if_) <= 3)
    select pg.frame, case when roll in (select roll from ix) then coalesce(il, last) || '|' || coalesce(if_, first) else last || '|' || left(first, 3) end as key from pg left join c on c.frame = pg.frame and rn = 1""")
def boundary_keys(spark, d):
    """Whole names where the roll has an index, else the coarse key."""
    p = pages(spark, d)
    ix = index(p.where("roll < 'Brand#4'"))
    own = snap.nearest(p, ix, "roll", "last", "first").join(ix.select("roll").distinct().withColumn("has", F.lit(True)), "roll", "left")
    return own.select("frame", packets.boundary_key(F.col("last"), F.col("first"), F.col("snap"), F.coalesce("has", F.lit(False))).alias("key"))


@query(f"""with {EV}, u as (select * from ev where value < 50 or value is null), k as (select *, case when event_type <> 'error' then upper(event_type) end as key from u where event_type <> 'click'),
    p as (select *, last_value(key ignore nulls) over (partition by user_id order by tick rows between unbounded preceding and 1 preceding) as prev from k),
    i as (select *, sum(case when key is not null and (prev is null or key <> prev) then 1 else 0 end) over (partition by user_id order by tick rows unbounded preceding) as island from p),
    f as (select user_id, island, max(key) as last, count(*) as n, min(tick) as beg from i where island > 0 group by 1, 2 having count(*) >= 3),
    b as (select user_id, event_type as last, count(*) as n, min(tick) as beg from ev where value >= 50 and event_type in ('view', 'purchase') group by 1, 2),
    bn as (select *, row_number() over (partition by user_id order by beg) as no from b), bk as (select * from bn where n >= 2), mx as (select user_id, max(no) as used from bk group by 1),
    fn as (select f.user_id, last, n, row_number() over (partition by f.user_id order by beg) + coalesce(used, 0) as no from f left join mx using (user_id))
    select user_id, upper(last) as last, n as n_pages, no::int as packet_no, user_id || '_' || lpad(no::varchar, 3, '0') as packet_id from bk union all select user_id, last, n, no::int, user_id || '_' || lpad(no::varchar, 3, '0') from fn""")
def fallback_union(spark, d):
    """Packets by index entry, and behind them islands over the pages without one; numbers go on behind the last."""
    own = events(spark, d)
    hit = (F.col("value") >= 50) & F.col("event_type").isin("view", "purchase")
    entry = F.when(hit, F.struct(F.lit(0).alias("dist"), F.upper("event_type").alias("ilast"), F.lit("").alias("ifirst"), F.lit("").alias("imiddle")))
    own = own.withColumn("snap", entry).withColumn("last", F.when(F.col("event_type") != "error", F.upper("event_type")).otherwise("")).withColumn("first", F.lit("")).withColumn("middle", F.lit(""))
    made = packets.index_buckets(own.drop("last", "first", "middle"), "user_id", "tick", "value", 5.0, 2)
    rest = own.where("(value < 50 or value is null) and event_type <> 'click'")
    out = packets.fallback_packets(rest, made, "user_id", "tick", "last", "first", "middle", "value", 5.0, 3)
    return out.select("user_id", "last", "n_pages", "packet_no", "packet_id")


# Page records, blocks

_Q = "case p_partkey % 3 when 0 then 'RECORD_NAME' when 1 then 'TOP_NAME' else 'FULL_NAME' end"


def exploded_blocks(spark, d) -> DataFrame:
    """A page for each part size. Each part gives, in the order of its key: a key with its words and its value, a question (four of five answered), a line, a word with a box; every value's words
    stand under an id that is given twice, first with a wrong text, so that the last one has to count."""
    own = t(spark, d, "part")
    k = F.col("p_partkey")
    conf = (k * 37 % 100).cast("double")
    n = lambda prefix: F.concat(F.lit(prefix), k.cast("string"))
    null = lambda kind: F.lit(None).cast(kind)
    rel = lambda kind, *ids: F.struct(F.lit(kind).alias("Type"), F.array(*ids).alias("Ids"))
    rels = "array<struct<Type:string,Ids:array<string>>>"
    box = "struct<BoundingBox:struct<Top:double,Left:double,Width:double,Height:double>>"

    def block(at, i, kind, text=None, entity=None, links=None, question=None, geometry=None):
        return F.struct(
            F.struct(F.lit(0).alias("rank"), (k * 100 + at).alias("pos")).alias("block_pos"), i.alias("Id"), F.lit(kind).alias("BlockType"), (text if text is not None else null("string")).alias("Text"), conf.alias("Confidence"),
            (F.array(F.lit(entity)) if entity else null("array<string>")).alias("EntityTypes"), null("int").alias("RowIndex"), null("int").alias("ColumnIndex"), (F.array(*links).cast(rels) if links else null(rels)).alias("Relationships"),
            (F.struct(question.alias("Alias"), F.lit("who?").alias("Text")) if question is not None else null("struct<Alias:string,Text:string>")).alias("Query"), (geometry if geometry is not None else null(box)).alias("Geometry"),
        )

    words = F.split("p_name", " ")
    first = F.when(k % 3 == 0, "FULL").when(k % 3 == 1, "MOTHER'S").otherwise("DATE")
    asked = F.expr(_Q)
    where = F.struct(F.struct(((k % 50) / 50.0).alias("Top"), ((k % 7) / 7.0).alias("Left"), F.lit(0.1).alias("Width"), F.lit(0.02).alias("Height")).alias("BoundingBox"))
    made = [
        block(0, n("k"), "KEY_VALUE_SET", entity="KEY", links=[rel("CHILD", n("ka"), n("kb"), F.lit("missing")), rel("VALUE", n("v"))]),
        block(1, n("ka"), "WORD", text=first), block(2, n("kb"), "WORD", text=F.lit("name")),
        block(3, n("v"), "KEY_VALUE_SET", entity="VALUE", links=[rel("CHILD", n("va"), n("vb"))]),
        block(4, n("va"), "WORD", text=F.lit("wrong")), block(5, n("vb"), "WORD", text=words[1]), block(6, n("va"), "WORD", text=words[0]),
        block(7, n("q"), "QUERY", links=[rel("ANSWER", F.when(k % 5 == 0, "missing").otherwise(n("a")))], question=asked),
        block(8, n("a"), "QUERY_RESULT", text=F.concat(words[0], F.lit(" "), words[1], F.lit(","))),
        block(9, n("l"), "LINE", text=F.when(k % 4 == 0, F.col("p_name")).otherwise("STUDENT RECORD")),
        block(10, n("b"), "WORD", text=F.when(k % 11 == 0, "Last").otherwise(words[0]), geometry=where),
        block(11, n("y"), "LAYOUT_TEXT"),
    ]
    return own.select(F.col("p_size").alias("page"), F.explode(F.array(*made)).alias("b")).select("page", "b.*")


def part_blocks(spark, d) -> DataFrame:
    """Blocks are looked at from many sides, so they are kept, as a job keeps its parsed responses."""
    return exploded_blocks(spark, d).cache()


_CAND = f"""pt as (select p_size as page, p_partkey as k, p_name, split_part(p_name, ' ', 1) as w1, split_part(p_name, ' ', 2) as w2, (p_partkey * 37 % 100)::double as conf, {_Q} as alias from part),
    fn as (select page, 0 as pos, arg_max(w1 || ' ' || w2, (conf, -k)) as raw, max(conf) as conf from pt where k % 3 <> 1 and conf > 0 group by 1),
    wd as (select page, k, 6 as o, w1 as text, (k % 50) / 50.0 as t, (k % 7) / 7.0 as l from pt where k % 11 <> 0),
    an as (select page, arg_min((k % 50) / 50.0, k) as t, arg_min((k % 7) / 7.0, k) as l from pt where k % 11 = 0 group by 1),
    bx as (select page, 1 as pos, arg_min(text, (gap, k)) as raw, 50.0 as conf from (select wd.page, text, k, wd.l - (an.l + 0.1) as gap, abs(wd.t - an.t) as dt from wd join an using (page)) where dt <= 0.02 and gap between -0.005 and 0.30 group by 1),
    qs as (select page, case alias when 'RECORD_NAME' then 2 when 'TOP_NAME' then 3 else 4 end as pos, arg_min(w1 || ' ' || w2 || ',', k) as raw, arg_min(conf, k) as conf from pt where k % 5 <> 0 group by 1, 2),
    ln as (select page, 5 as pos, arg_min(p_name, k) as raw, arg_min(conf, k) as conf from pt where k % 4 = 0 group by 1),
    al as (select * from fn union all select * from bx union all select * from qs union all select * from ln),
    ca as (select page, s.pos, s.source, coalesce(al.raw, '') as raw, coalesce(al.conf, 0.0)::double as conf from (select distinct page from pt) cross join (select * from (values (0, 'forms_name'), (1, 'forms_bbox'), (2, 'queries_record'), (3, 'queries_top'), (4, 'queries_full'), (5, 'detect_first')) v(pos, source)) s left join al using (page, pos))"""


@query(f"with {_CAND} select page, pos, source, raw, conf from ca")
def cover_candidates(spark, d):
    """Six candidates for each page, from a block graph."""
    own = jobs.kept(exploded_blocks(spark, d))
    return extract.candidates(own, own, "page")


@query(f"""with {_CAND}, cl as (select *, regexp_replace(trim(raw), ',+$', '') as name from ca), v as (select *, lower(name) as form from cl where regexp_matches(name, '^[A-Za-z][A-Za-z''\\-\\. ,]{{1,60}}[A-Za-z\\.]$')),
    g as (select page, form, count(*) as n, sum(conf) as total, max(conf) as top, min(pos) as first, arg_min(name, (-conf, pos)) as name, string_agg(source, ',' order by pos) as src from v group by 1, 2),
    w as (select *, row_number() over (partition by page order by n desc, total desc, first) as rn from g)
    select page, name as vote_name, round(case when n >= 3 then 0.85 + least(0.10, top * 0.001) when n = 2 then 0.75 + least(0.10, top * 0.001) else 0.40 + least(0.20, top * 0.002) end, 3)::double as vote_confidence, n as vote_agreement, src as vote_sources from w where rn = 1""")
def cover_vote(spark, d):
    """A10, F3, F4, F9, M2 on the candidates."""
    own = jobs.kept(exploded_blocks(spark, d))
    return extract.vote_names(extract.candidates(own, own, "page"), "page").withColumn("vote_sources", F.array_join("vote_sources", ","))


def table_blocks(spark, d) -> DataFrame:
    """A table for each supplier nation: a header and a row for each supplier with its name's two halves; every third row is blank."""
    w = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    own = t(spark, d, "supplier").withColumn("r", F.row_number().over(w) + 1)
    k = F.col("s_suppkey")
    cells = own.select(F.col("s_nationkey").alias("page"), F.col("r").cast("int").alias("r"), F.posexplode(F.array(F.concat(F.lit("L"), k.cast("string")), F.concat(F.lit("F"), (k % 7).cast("string")), F.lit("x"))).alias("c", "w"))
    cells = cells.withColumn("w", F.when(F.col("r") % 3 == 0, "").otherwise(F.col("w"))).withColumn("c", F.col("c") + 1)
    heads = own.select(F.col("s_nationkey").alias("page")).distinct().select("page", F.lit(1).alias("r"), F.posexplode(F.array(F.lit("Last Name"), F.lit("first"), F.lit("Notes"))).alias("c", "w")).withColumn("c", F.col("c") + 1)
    cells = heads.unionByName(cells)
    ident = lambda p: F.concat_ws("_", F.lit(p), "r", "c")
    null = lambda kind: F.lit(None).cast(kind)
    rels = "array<struct<Type:string,Ids:array<string>>>"
    link = lambda ids: F.array(F.struct(F.lit("CHILD").alias("Type"), ids.alias("Ids"))).cast(rels)
    pos = lambda k: F.struct(F.lit(k).alias("rank"), (F.col("r") * 10 + F.col("c")).cast("int").alias("pos")).alias("block_pos")
    rest = (null("double").alias("Confidence"), null("array<string>").alias("EntityTypes"))
    cell = cells.select("page", pos(1), ident("c").alias("Id"), F.lit("CELL").alias("BlockType"), null("string").alias("Text"), *rest, F.col("r").cast("int").alias("RowIndex"), F.col("c").cast("int").alias("ColumnIndex"), link(F.array(ident("w"))).alias("Relationships"))
    word = cells.select("page", pos(2), ident("w").alias("Id"), F.lit("WORD").alias("BlockType"), F.col("w").alias("Text"), *rest, null("int").alias("RowIndex"), null("int").alias("ColumnIndex"), null(rels).alias("Relationships"))
    table = cells.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("r", "c", ident("c").alias("i")))).alias("all"))
    table = table.select("page", F.struct(F.lit(0).alias("rank"), F.lit(0).alias("pos")).alias("block_pos"), F.lit("t").alias("Id"), F.lit("TABLE").alias("BlockType"), null("string").alias("Text"), *rest, null("int").alias("RowIndex"), null("int").alias("ColumnIndex"), link(F.transform("all", lambda x: x["i"])).alias("Relationships"))
    return table.unionByName(cell).unionByName(word).withColumn("Query", null("struct<Alias:string,Text:string>")).withColumn("Geometry", null("struct<BoundingBox:struct<Top:double,Left:double,Width:double,Height:double>>")).cache()


_TABLE = "tb as (select s_nationkey as page, row_number() over (partition by s_nationkey order by s_suppkey) + 1 as r, 'L' || s_suppkey as last, 'F' || (s_suppkey % 7) as first from supplier)"


@query(f"with {_TABLE} select page, r::int as r, last, first, '' as middle, '' as dob from tb where r % 3 <> 0")
def index_tables(spark, d):
    """A22-A24, J7, U1 from block to record."""
    return extract.index_from_tables(table_blocks(spark, d), "page").select("page", "r", "last", "first", "middle", "dob")


@query(f"""with {_CAND}, {_TABLE}, n as (select page, count(*) as rows from tb where r % 3 <> 0 group by 1),
    cl as (select *, regexp_replace(trim(raw), ',+$', '') as name from ca), v as (select *, lower(name) as form from cl where regexp_matches(name, '^[A-Za-z][A-Za-z''\\-\\. ,]{{1,60}}[A-Za-z\\.]$')),
    g as (select page, form, count(*) as n, sum(conf) as total, min(pos) as first, arg_min(name, (-conf, pos)) as name from v group by 1, 2), w as (select *, row_number() over (partition by page order by n desc, total desc, first) as rn from g),
    pg2 as (select distinct p_size as page, case p_size % 3 when 0 then 'student_records_index' when 1 then 'student_cover' else 'roll_leader' end as page_class from part)
    select pg2.page, page_class, case when page_class = 'student_records_index' then coalesce(n.rows, 0) end as index_rows_added, case when page_class = 'student_cover' then coalesce(w.name, '') end as vote_name, page_class = 'student_cover' as has_candidates
    from pg2 left join n using (page) left join w on w.page = pg2.page and w.rn = 1""")
def extracted_pages(spark, d):
    """One wide row per page, by its class."""
    both = part_blocks(spark, d).where("page % 3 = 1").unionByName(table_blocks(spark, d).where("page % 3 = 0"))
    page = F.col("page")
    kinds = F.when(page % 3 == 0, "student_records_index").when(page % 3 == 1, "student_cover").otherwise("roll_leader")
    own = t(spark, d, "part").select(F.col("p_size").alias("page")).distinct().select("page", kinds.alias("page_class"), F.lit("R").alias("roll"), page.alias("seq"))
    out = extract.extract(own, both, "page", "page_class", "roll", "seq", keep=jobs.kept)
    return out.select("page", "page_class", "index_rows_added", "vote_name", F.col("candidate_sources").isNotNull().alias("has_candidates"))


@query("""with fp as (select p_size as page, count(*) as lines, string_agg(upper(case when p_partkey % 4 = 0 then p_name else 'STUDENT RECORD' end), ' ' order by p_partkey) as u, count(*) as keys from part group by 1)
    select page, lines, keys, md5(u) as text_md5, lines * 4 + count_words * 0 as n_words from (select *, 0 as count_words from fp)""")
def page_fingerprint(spark, d):
    """A11, A12 on a block graph; n_words from the map of block types (six words a part, one of them given twice)."""
    out = extract.fingerprint(part_blocks(spark, d), "page")
    words = F.col("block_types")["WORD"] - F.col("lines") * 2
    return out.select("page", "lines", "keys", F.md5("upper").alias("text_md5"), words.alias("n_words"))


@query("select p_size as page, count(*) as n_lines, array_to_string(list(case when p_partkey % 4 = 0 then p_name else 'STUDENT RECORD' end order by p_partkey)[1:5], chr(10)) || case when count(*) > 5 then chr(10) || '... (' || (count(*) - 5) || ' more LINEs)' else '' end as digest from part group by 1")
def text_digest(spark, d):
    """K8, O6."""
    return extract.text_digest(part_blocks(spark, d), "page", 5)


@query("select p_size as page, f as feature, case f when 'detect' then 'lines=' || count(*) when 'forms' then 'kv_keys=' || count(*) when 'tables' then 'tables=0 cells=0' when 'layout' then 'layout_blocks=' || count(*) else 'answers=' || count(*) end as summary from part, (values ('detect'), ('forms'), ('tables'), ('layout'), ('queries')) v(f) group by 1, 2")
def feature_summary(spark, d):
    """A27, over the same blocks under each feature."""
    own = part_blocks(spark, d).withColumn("feature", F.explode(F.array(*map(F.lit, records.check_features(["detect", "forms", "tables", "layout", "queries"])))))
    return extract.feature_summary(own, "page", "feature")


@query("select p_size as page, 'LAYOUT_TEXT' as block_type, count(*) as n from part group by 1")
def layout_histogram(spark, d):
    return extract.layout_histogram(part_blocks(spark, d), "page")


@query("select l_suppkey as page, round(coalesce(avg(l_quantity - 5) filter (where l_quantity >= 5), 0), 6) as mean_confidence, count(*) filter (where l_returnflag <> 'N') as n_words from lineitem group by 1")
def ocr_means(spark, d):
    """Confidence below 0 is none."""
    own = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), (F.col("l_quantity") - 5).alias("conf"), F.when(F.col("l_returnflag") == "N", " \t").otherwise(F.col("l_returnflag")).alias("text"))
    return extract.ocr_summary(own, "page").withColumn("mean_confidence", F.round("mean_confidence", 6))


@query("""select p_partkey, case p_size % 4 when 0 then 'forms,tables,layout,queries,signatures' when 1 then 'tables' when 2 then '' else 'forms,tables,layout,queries,signatures' end as features,
    case p_size % 4 when 0 then 0.0895 when 1 then 0.0165 when 2 then 0.0015 else 0.0895 end::double as usd from part""")
def page_router(spark, d):
    """What the second pass buys for a class, and the price of both passes."""
    kind = F.element_at(F.array(*map(F.lit, ("student_cover", "student_records_index", "roll_leader", "unknown"))), F.col("p_size") % 4 + 1)
    return t(spark, d, "part").select("p_partkey", F.array_join(extract.second_pass(kind), ",").alias("features"), extract.routed_price(kind).alias("usd"))


def voted(spark, d) -> DataFrame:
    """Parts as results: the name with a title, its reverse or nothing against what is expected."""
    k, w = F.col("p_partkey"), F.split("p_name", " ")
    got = F.when(k % 4 == 0, F.concat(F.lit("Mr. "), w[0])).when(k % 4 == 1, F.concat(w[1], F.lit(" "), w[0])).when(k % 4 == 2, "").otherwise(F.col("p_name"))
    return t(spark, d, "part").select(k.alias("label"), F.when(k % 7 == 0, "roll_leader").otherwise("student_cover").alias("expected_class"), F.when(k % 7 == 0, "roll_leader").otherwise("student_cover").alias("page_class"), F.when(k % 9 == 0, "").otherwise(F.col("p_name")).alias("expected_name"), got.alias("vote_name"), (F.col("p_size") / 50).alias("vote_confidence"), (k % 10 / 100).alias("spend_usd"), F.when(k % 7 == 0, 3).alias("index_rows_added"), F.col("p_brand").alias("district"), (F.col("p_size") % 4).alias("vote_agreement"))


_VOTED = """rs as (select p_partkey as k, p_brand, p_size, case when p_partkey % 9 = 0 then '' else lower(p_name) end as e, case p_partkey % 4 when 0 then 'mr. ' || lower(split_part(p_name, ' ', 1)) when 1 then lower(split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)) when 2 then '' else lower(p_name) end as g from part),
    rr as (select *, regexp_replace(g, '^([a-z]\\.\\s+|w\\.\\s+|mr\\.\\s+|mrs\\.\\s+)', '') as b, e <> '' and g <> '' as both_there from rs)"""


@query(f"""with {_VOTED}, x as (select *, both_there and (contains(e, g) or contains(g, e) or contains(e, b) or contains(b, e)) as ok, p_size / 50.0 >= 0.7 as ships from rr where k % 7 <> 0)
    select count(*) as covers, count(*) filter (where ok) as correct, count(*) filter (where ships) as shipped, count(*) filter (where ships and ok) as shipped_correct,
    round(100.0 * count(*) filter (where ships and ok) / count(*) filter (where ships), 6)::double as precision_pct, round(100.0 * count(*) filter (where ok) / count(*), 6)::double as recall_pct from x""")
def replay_score(spark, d):
    """A25, F11, F12."""
    out = extract.replay_score(voted(spark, d))
    return out.withColumn("precision_pct", F.round("precision_pct", 6)).withColumn("recall_pct", F.round("recall_pct", 6))


@query(f"""with {_VOTED} select count(*) as pages, round(sum(k % 10 / 100.0), 2)::double as spend_usd, count(*) filter (where both_there and (contains(e, g) or contains(g, e))) as correct,
    count(*) filter (where both_there and p_size / 50.0 >= 0.6) as shipped, (3 * count(*) filter (where k % 7 = 0))::bigint as index_rows from rr""")
def live_score(spark, d):
    """A26, P9'."""
    return extract.live_score(voted(spark, d)).withColumn("spend_usd", F.round("spend_usd", 2))


@query(f"""with {_VOTED}, x as (select *, row_number() over (partition by p_brand order by p_size desc, k) as rank from rr where k % 7 <> 0 and p_size / 50.0 >= 0.7)
    select p_brand as district, k as label, rank from x where rank <= 3""")
def spot_check(spark, d):
    """W10, K9, P9."""
    return extract.spot_check(voted(spark, d), "district", 3).select("district", "label", "rank")


def replies(spark, d) -> DataFrame:
    """A reply for each order: by its key a cover, an index page with rows, a bad class, a confidence over 1, or no JSON."""
    k = F.col("o_orderkey")
    row = lambda last, first: F.struct(last.alias("last"), first.alias("first"))
    kind = F.when(k % 5 == 1, "student_records_index").when(k % 5 == 2, "odd").otherwise("student_cover")
    reply = F.to_json(F.struct(kind.alias("page_class"), F.struct(F.concat(F.lit("Doe"), k.cast("string")).alias("last")).alias("student"), F.array(row(F.lit(" A "), F.lit("B")), row(F.lit(" "), F.lit("")), row(F.lit(""), F.lit("C"))).alias("index_rows"), F.when(k % 5 == 3, 1.5).otherwise(0.9).alias("confidence_overall"), F.lit(0.8).alias("confidence_name")))
    return t(spark, d, "orders").select(F.format_string("%05d", k).alias("frame"), F.lit("ROLL 001").alias("roll_id"), F.when(k % 5 == 4, "sorry").otherwise(reply).alias("reply"), F.lit("m").alias("model_version"), F.lit("2026-01-01T00:00:00Z").alias("processed_at"), F.lit(5).alias("latency_ms"), (k % 1000).alias("tokens_in"), F.when(k % 2 == 0, k % 100).alias("tokens_out"))


@query("""select format('{:05d}', o_orderkey) as frame, case o_orderkey % 5 when 1 then 'student_records_index' when 2 then 'odd' when 4 then null else 'student_cover' end as page_class,
    case when o_orderkey % 5 = 4 then '' else 'Doe' || o_orderkey end as last, case when o_orderkey % 5 = 1 then 2 else 0 end as n_rows, case when o_orderkey % 5 = 1 then 'A|B,|C' else '' end as rows_text,
    round((o_orderkey % 1000) * 1e-6 + (case when o_orderkey % 2 = 0 then o_orderkey % 100 else 0 end) * 5e-6, 9)::double as usd_cost,
    case o_orderkey % 5 when 2 then 'bad page class odd' when 3 then 'confidence out of range' when 4 then 'no page class' end as error from orders""")
def reply_pages(spark, d):
    """Page records from replies, with the contract's faults."""
    out = extract.page_records(replies(spark, d))
    shown = F.array_join(F.transform("index_rows", lambda r: F.concat(r["last"], F.lit("|"), r["first"])), ",")
    return out.select("frame", "page_class", F.col("student.last").alias("last"), F.size("index_rows").alias("n_rows"), shown.alias("rows_text"), F.round("usd_cost", 9).alias("usd_cost"), "error")


def roll_records(spark, d) -> DataFrame:
    """Page records: a roll for each brand, in the order of the parts; every ninth part is an index page with its own name and a misread one, the others are covers."""
    k, w = F.col("p_partkey"), F.split("p_name", " ")
    is_index = k % 9 == 0
    row = lambda last, first: F.struct(last.alias("last"), first.alias("first"), F.lit("M").alias("middle"), F.lit("").alias("dob"), F.lit("").alias("source_frame"))
    none = F.array().cast(f"array<{records.INDEX_ROW}>")
    student = lambda a, b: F.struct(a.alias("last"), b.alias("first"), F.lit("").alias("middle"), F.lit("").alias("dob"), F.lit("").alias("school"))
    empty = F.lit("")
    return t(spark, d, "part").select(
        F.format_string("%06d", k).alias("frame"), F.concat(F.lit("ROLL "), "p_brand").alias("roll_id"), F.when(is_index, "student_records_index").otherwise("student_cover").alias("page_class"), F.lit(None).cast("struct<marker:string,roll_no:string>").alias("separator"),
        F.when(is_index, student(empty, empty)).otherwise(student(F.when(k % 4 == 0, F.concat(w[0], F.lit("x"))).otherwise(w[0]), w[1])).alias("student"), F.when(is_index, F.array(row(w[0], w[1]), row(w[1], w[0]))).otherwise(none).alias("index_rows"),
        F.lit(0.9).alias("confidence_overall"), (F.col("p_size") / 50).alias("confidence_name"), F.lit(0.001).alias("usd_cost"), F.lit(10).alias("tokens_in"), F.lit(2).alias("tokens_out"),
    )


_ROLLS = """rp as (select 'ROLL ' || p_brand as roll_id, p_partkey as k, upper(split_part(p_name, ' ', 1)) as w1, upper(split_part(p_name, ' ', 2)) as w2, p_size / 50.0 as conf, p_partkey % 9 = 0 as is_index from part),
    ri as (select roll_id, last, first, min(pos) as pos from (select roll_id, w1 as last, w2 as first, k * 10 as pos from rp where is_index union all select roll_id, w2, w1, k * 10 + 1 from rp where is_index) group by 1, 2, 3),
    rc as (select roll_id, k, conf, case when k % 4 = 0 then w1 || 'X' else w1 end as last, w2 as first from rp where not is_index),
    rd as (select rc.*, i.last as il, i.first as ifirst, i.pos, case when levenshtein(rc.last, i.last) <= 3 and levenshtein(rc.first, i.first) <= 3 then levenshtein(rc.last, i.last) + levenshtein(rc.first, i.first) else 99 end as d0,
      case when levenshtein(rc.first, i.last) <= 3 and levenshtein(rc.last, i.first) <= 3 then levenshtein(rc.first, i.last) + levenshtein(rc.last, i.first) else 99 end as d1 from rc join ri i using (roll_id)),
    rb as (select *, row_number() over (partition by k order by least(d0, d1), pos, d1 < d0) as rn from rd where least(d0, d1) <= 4),
    rk as (select roll_id, il as last, ifirst as first, count(*) as pages, round(avg(conf), 6) as avg_confidence, min(conf) < 0.7 as flagged, min(k) as beg, string_agg(format('{:06d}', k), ',' order by k) as frames from rb where rn = 1 group by 1, 2, 3),
    rn as (select *, row_number() over (partition by roll_id order by beg) as packet_no from rk)"""


@query(f"with {_ROLLS} select roll_id, packet_no, lower(replace(roll_id, ' ', '')) || '_' || case when packet_no < 1000 then lpad(packet_no::varchar, 3, '0') else packet_no::varchar end as packet_id, last, first, 'M' as middle, frames, pages, avg_confidence, flagged from rn where pages >= 2")
def regroup_index(spark, d):
    """The job ``regroup --mode index --min-bucket-size 2`` on page records: A6, J2, W3, W7, P8, A2-A5."""
    own = roll_records(spark, d)
    out = jobs.group(own, jobs.index_of(own), jobs.Options(mode="index", min_bucket=2))
    return out.select("roll_id", "packet_no", "packet_id", "last", "first", "middle", F.array_join("frames", ",").alias("frames"), "pages", F.round("avg_confidence", 6).alias("avg_confidence"), "flagged")


@query(f"with {_ROLLS} select roll_id, row_number() over (partition by roll_id order by pos) as position, last, first, (pos // 10)::int as source_frame from ri")
def roll_index_records(spark, d):
    """The rolls' indexes from page records."""
    out = jobs.index_with_positions(jobs.index_of(roll_records(spark, d)))
    return out.select("roll_id", "position", F.upper("last").alias("last"), F.upper("first").alias("first"), F.col("source_frame").cast("int").alias("source_frame"))


@query()
def regroup_boundary(spark, d):
    """The job ``regroup`` in boundary mode, merged to a fixpoint: W1-W4, J1, J4; the tests hold it against a plain loop."""
    own = roll_records(spark, d)
    return jobs.group(own, jobs.index_of(own)).withColumn("frames", F.array_join("frames", ","))


# Checks


@query("""with o as (select o_custkey as roll, o_orderkey as frame, case o_orderkey % 7 when 0 then 'START' when 3 then 'END' end as marker, o_totalprice as conf from orders),
    a as (select *, row_number() over (partition by roll order by frame) as a, count(*) over (partition by roll) as n from o),
    k as (select *, coalesce((marker = 'START' and a <= 10) or (marker = 'END' and a > n - 5), false) as ok from a), r as (select *, row_number() over (partition by roll, marker, ok order by conf desc, case when marker = 'END' then -a else a end) as rn from k)
    select frame, case when ok and rn = 1 then marker end as kept_marker, marker is not null and not (ok and rn = 1) as downgraded from r""")
def one_marker(spark, d):
    """Z7."""
    k = F.col("o_orderkey")
    own = t(spark, d, "orders").select(F.col("o_custkey").alias("roll"), k.alias("frame"), F.when(k % 7 == 0, "START").when(k % 7 == 3, "END").alias("marker"), F.col("o_totalprice").alias("conf"))
    return packets.one_marker(own, "roll", "frame", "marker", "conf").select("frame", "kept_marker", "downgraded")


@query(f"""with {EV}, c as (select user_id, tick, event_id, case when event_type in ('view', 'purchase') then 'student_cover' when event_type = 'error' then 'unknown' else 'other' end as pc, case when event_type = 'signup' then 'START' when value > 300 then 'END' end as mk from ev),
    w as (select *, coalesce(max((mk = 'START')::int) over p, 0) as s, coalesce(max((mk = 'END')::int) over p, 0) as e, max(coalesce(mk = 'START', false)::int) over (partition by user_id) as an, sum((pc <> 'unknown')::int) over (partition by user_id order by tick rows unbounded preceding) as u from c window p as (partition by user_id order by tick rows between unbounded preceding and 1 preceding)),
    l as (select *, count(*) filter (where pc = 'unknown') over (partition by user_id, u) as run from w),
    z as (select event_id, case when pc = 'student_cover' and e = 1 then 'student after END' when pc = 'student_cover' and an = 1 and s = 0 then 'student before START' when pc = 'unknown' and run >= 3 then 'unknown run' end as rule from l) select * from z where rule is not null""")
def class_transitions(spark, d):
    """Z9."""
    kind = F.when(F.col("event_type").isin("view", "purchase"), "student_cover").when(F.col("event_type") == "error", "unknown").otherwise("other")
    own = events(spark, d).withColumn("page_class", kind).withColumn("marker", F.when(F.col("event_type") == "signup", "START").when(F.col("value") > 300, "END"))
    return packets.transitions(own, "user_id", "tick", "page_class", "marker").select("event_id", "rule")


@query(f"""with {_PAIR}, c as (select roll, l, f, count(*) as n, min(frame) as o from pr group by 1, 2, 3), w as (select *, row_number() over (partition by roll order by n desc, o) as rn from c)
    select frame, case when levenshtein(pr.l, w.l) <= 2 and levenshtein(pr.f, w.f) <= 2 then w.l else pr.l end as last, levenshtein(pr.l, w.l) <= 2 and levenshtein(pr.f, w.f) <= 2 and (pr.l <> w.l or pr.f <> w.f) as overridden from pr join w using (roll) where rn = 1""")
def name_reconcile(spark, d):
    """Z6."""
    out = packets.reconcile(pair_pages(spark, d), ["roll"], "last", "first", "middle", "frame")
    return out.select("frame", F.upper("last").alias("last"), "overridden")


@query(f"with {EV}, {{}} select user_id, island::bigint as island, count(*) as n_pages from isl group by 1, 2 having count(*) <= 1 or count(*) >= 15".replace("{}", """k as (select *, case when event_type <> 'error' then event_type end as key from ev where event_type <> 'click'),
    p as (select *, last_value(key ignore nulls) over (partition by user_id order by tick rows between unbounded preceding and 1 preceding) as prev from k),
    i as (select *, sum(case when key is not null and (prev is null or key <> prev) then 1 else 0 end) over (partition by user_id order by tick rows unbounded preceding) as island from p), isl as (select * from i where island > 0)"""))
def packet_outliers(spark, d):
    """Packets of suspicious size."""
    own = runs(events(spark, d)).groupBy("user_id", "island").agg(F.count("*").alias("n_pages"))
    return packets.size_outliers(own, "n_pages")


@query("""select p_partkey, case when p_size % 3 = 0 and (p_partkey % 4) = 0 then 'unknown' when p_size % 3 = 0 and (p_partkey % 4) = 1 then 'student_continuation' when p_size % 3 = 1 and p_partkey % 10 < 5 then case when p_partkey % 4 = 0 then 'unknown' else 'student_cover' end
    when p_size % 3 = 0 then 'student_cover' when p_size % 3 = 1 then 'student_records_index' else 'roll_leader' end as page_class from part""")
def class_downgrade(spark, d):
    """Z16."""
    k, size = F.col("p_partkey"), F.col("p_size")
    kind = F.when(size % 3 == 0, "student_cover").when(size % 3 == 1, "student_records_index").otherwise("roll_leader")
    name, dob = F.when(k % 4 == 0, " ").otherwise(F.col("p_name")), F.when(k % 4 == 1, "").otherwise("1/2/60")
    return t(spark, d, "part").select("p_partkey", packets.downgrade(kind, name, F.lit(""), dob, F.lit(None).cast("string"), k % 10).alias("page_class"))


@query(f"""with {PG}, q as (select *, case when frame % 3 = 0 then '' else (size % 5)::varchar end as dob from pg), ix as (select roll, last as il, first as if_, case when size % 2 = 0 then '' else (size % 5)::varchar end as idob, min(frame) as pos from pg where size <= 10 group by 1, 2, 3, 4),
    c as (select q.frame, il, if_, idob, pos, levenshtein(last, il) as a, levenshtein(first, if_) as b, q.dob <> '' and idob <> '' as known, q.dob = idob as same from q join ix using (roll)),
    o as (select *, a + b - case when known then 2 else 0 end as dist from c where a <= 2 and b <= 2 and a + b <= 3 and (not known or same)), r as (select *, row_number() over (partition by frame order by dist, pos, il, if_) as rn from o)
    select frame, il as last, if_ as first, dist as distance from r where rn = 1""")
def dob_snap(spark, d):
    """Z15."""
    p = pages(spark, d).withColumn("page_dob", F.when(F.col("frame") % 3 == 0, "").otherwise((F.col("size") % 5).cast("string")))
    entries = p.where("size <= 10").withColumn("dob", F.when(F.col("size") % 2 == 0, "").otherwise((F.col("size") % 5).cast("string")))
    ix = snap.roll_index(entries, "roll", "last", "first", "frame", "dob")
    out = snap.nearest(p, ix, "roll", "last", "first", carry=("page_dob",), dob="page_dob").where("snap is not null")
    return out.select("frame", F.col("snap.ilast").alias("last"), F.col("snap.ifirst").alias("first"), F.col("snap.dist").alias("distance"))


@query("""with w as (select p_partkey, upper(case p_partkey % 5 when 0 then replace(split_part(p_name, ' ', 1), 'o', '0') when 1 then replace(split_part(p_name, ' ', 1), 's', '5') when 2 then substr(split_part(p_name, ' ', 1), 2) when 3 then split_part(p_name, ' ', 1) || 'qq' else split_part(p_name, ' ', 1) end) as w from part),
    dc as (select upper(split_part(p_name, ' ', 1)) as e, count(*) as n from part group by 1),
    sw as (select distinct w, unnest([replace(w, '0', 'O'), replace(w, 'O', '0'), replace(w, '1', 'L'), replace(w, '1', 'I'), replace(w, 'L', '1'), replace(w, 'I', '1'), replace(w, '5', 'S'), replace(w, 'S', '5'), replace(w, '8', 'B'), replace(w, 'B', '8'), replace(w, '6', 'G'), replace(w, 'G', '6'), replace(w, 'RN', 'M'), replace(w, 'M', 'RN')]) as e from w),
    c as (select w, 0 as r, n, e from (select distinct w from w) join dc on e = w union all select w, 1, n, e from sw join dc using (e) union all select w, 2, n, e from (select distinct w from w), dc where levenshtein(w, e) <= 1),
    b as (select w, arg_min(e, (r, -n, e)) as e from c group by 1) select p_partkey, coalesce(e, w) as snapped from w left join b using (w)""")
def dictionary_snap(spark, d):
    """Misread letters, one edit, and words out of the dictionary's reach."""
    k, w = F.col("p_partkey"), F.split("p_name", " ")[0]
    name = F.when(k % 5 == 0, F.replace(w, F.lit("o"), F.lit("0"))).when(k % 5 == 1, F.replace(w, F.lit("s"), F.lit("5"))).when(k % 5 == 2, F.substring(w, 2, 99)).when(k % 5 == 3, F.concat(w, F.lit("qq"))).otherwise(w)
    own = t(spark, d, "part")
    words = own.groupBy(w.alias("word")).agg(F.count("*").alias("n"))
    return snap.dictionary_snap(own.select("p_partkey", name.alias("name")), "name", words, "word", "n").select("p_partkey", "snapped")


@query("""select p_partkey, case when ok then split_part(p_name, ' ', 1) else '' end as last, case when ok then split_part(p_name, ' ', 2) else '' end as first, case when dok then dob else '' end as dob, ok as name_ok, dok as dob_ok from
    (select *, p_partkey % 4 not in (1, 2) as ok, p_size between 1 and 12 as dok, p_size || '/5/60' as dob from part)""")
def output_gate(spark, d):
    """Digits in front of names go; unusable names and dates of birth are blanked, each alone."""
    k, w = F.col("p_partkey"), F.split("p_name", " ")
    last = F.when(k % 4 == 0, F.concat(F.lit("12"), w[0])).when(k % 4 == 1, F.concat(w[0], F.lit(" RECORD"))).when(k % 4 == 2, "J0hn").otherwise(w[0])
    own = t(spark, d, "part").select("p_partkey", last.alias("last"), w[1].alias("first"), F.concat(F.col("p_size").cast("string"), F.lit("/5/60")).alias("dob"))
    out = extract.gate(own, "last", "first", "dob")
    return out.select("p_partkey", F.when(F.col("name_ok") & (k % 4 == 0), w0(F.col("last"))).otherwise(F.col("last")).alias("last"), "first", "dob", "name_ok", "dob_ok")


def w0(c):
    return s.strip_digits(c)


@query("""select o_orderkey, case when o_totalprice / 500000 between 0.2 and 0.5 then case when o_orderkey % 3 <> 0 then 'accept' else 'review' end when o_totalprice / 500000 > 0.5 then 'accept' else 'review' end as decision from orders""")
def second_opinion(spark, d):
    """The second model is asked within the band only."""
    own = t(spark, d, "orders").select("o_orderkey", F.lit("a").alias("name"), (F.col("o_totalprice") / 500000).alias("conf"))
    second = extract.band(own, "conf", 0.2, 0.5).withColumn("name", F.when(F.col("o_orderkey") % 3 == 0, "b").otherwise("a"))
    return extract.second_opinion(own, second, ["o_orderkey"], "name", "conf", 0.2, 0.5).select("o_orderkey", "decision")


MATRIX = [
    ("cover_a", "student_cover", ["LAVENDER"], ["SPRING", "LINEN"], ["MINT"], [], "mid_roll", [1, 2]),
    ("test_a", "student_test_sheet", ["SPRING"], ["LAVENDER"], [], ["FOREST"], "first_3_to_6", []),
    ("index_a", "student_records_index", ["FOREST", "LINEN"], [], ["LAVENDER"], [], "last_3_to_last", [3]),
]


def _matrix_sql() -> str:
    rows = []
    for name, parent, titles, headers, phrases, excluded, position, districts in MATRIX:
        title = " + ".join(f"case when contains(top, '{x}') then 8.0 when contains(full_, '{x}') then 4.0 else 0.0 end" for x in titles)
        count = lambda xs, most: f"least({' + '.join([f'contains(full_, {chr(39)}{x}{chr(39)})::int' for x in xs] or ['0'])}, {most})"
        place = {"mid_roll": "case when ord between 7 and n - 4 then 0.4 else 0 end", "first_3_to_6": "case when ord between 3 and 6 then 1.5 else 0 end", "last_3_to_last": "case when ord >= n - 3 then 1.5 else 0 end"}[position]
        bias = f"case when district in ({', '.join(map(str, districts))}) then 1.0 else 0 end" if districts else "0"
        out = " or ".join(f"contains(full_, '{x}')" for x in excluded) or "false"
        rows.append(f"select page, '{name}' as subtype, '{parent}' as parent, case when {out} then 0.0 else {title} + 1.5 * {count(headers, 5)} + 0.8 * {count(phrases, 4)} + {place} + {bias} end as score from pp")
    return f"""with pp as (select p_partkey as page, row_number() over (partition by p_brand order by p_partkey) as ord, count(*) over (partition by p_brand) as n, p_size % 5 as district, upper(split_part(p_name, ' ', 1)) as top, upper(p_name) as full_ from part),
    sc as ({' union all '.join(rows)}), r as (select *, row_number() over (partition by page order by score desc, subtype) as rn, lead(score) over (partition by page order by score desc, subtype) as nxt from sc)
    select page, case when score < 6 or score - nxt < 3 then 'unknown_unrecognized' else subtype end as subtype, case when score < 6 or score - nxt < 3 then 'unknown' else parent end as parent, round(score, 6)::double as score,
    case when score < 6 or score - nxt < 3 then 0.0 else round((score - nxt) / score, 6) end::double as confidence, score < 6 or score - nxt < 3 as refused from r where rn = 1"""


@query(_matrix_sql())
def subtype_scores(spark, d):
    """Z13 with a small matrix."""
    w = Window.partitionBy("p_brand")
    own = t(spark, d, "part").select(F.col("p_partkey").alias("page"), F.row_number().over(w.orderBy("p_partkey")).alias("frame_no"), F.count("*").over(w).alias("n_frames"), (F.col("p_size") % 5).alias("district"), F.upper(F.split("p_name", " ")[0]).alias("top"), F.upper("p_name").alias("full"))
    matrix = spark.createDataFrame(MATRIX, "subtype string, parent string, titles array<string>, headers array<string>, phrases array<string>, excluded array<string>, position string, districts array<int>")
    return extract.subtype_scores(own, matrix, "page")


@query("""with f as (select l_orderkey as page, l_returnflag as last, l_linestatus as first, case when l_partkey % 2 = 0 then l_shipmode_ else '' end as middle, l_linenumber * 1000000 + l_partkey as o from (select *, l_returnflag || l_linestatus as l_shipmode_ from lineitem)),
    l as (select page, last, count(*) as n, min(o) as o from f group by 1, 2), lr as (select *, row_number() over (partition by page order by n desc, o, last) as rn from l), ff as (select page, first, count(*) as n, min(o) as o from f group by 1, 2), fr as (select *, row_number() over (partition by page order by n desc, o, first) as rn from ff),
    m as (select page, middle, count(*) as n, min(o) as o from f where middle <> '' group by 1, 2), mr as (select *, row_number() over (partition by page order by n desc, o, middle) as rn from m)
    select lr.page, last, first, coalesce(middle, '') as middle, least(lr.n, fr.n) as agreement, case when least(lr.n, fr.n) >= 3 then 0.95 when least(lr.n, fr.n) = 2 then 0.8 else 0.5 end::double as confidence, case when least(lr.n, fr.n) >= 3 then 'ship' when least(lr.n, fr.n) = 2 then 'snap' else 'review' end as decision
    from lr join fr on fr.page = lr.page and fr.rn = 1 left join mr on mr.page = lr.page and mr.rn = 1 where lr.rn = 1""")
def component_vote(spark, d):
    """Z14."""
    own = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_returnflag").alias("last"), F.col("l_linestatus").alias("first"), F.when(F.col("l_partkey") % 2 == 0, F.concat("l_returnflag", "l_linestatus")).otherwise("").alias("middle"), (F.col("l_linenumber") * F.lit(1000000).cast("long") + F.col("l_partkey")).alias("o"))
    return extract.component_vote(own, "page", "o")


@query("with tp as (select n_nationkey as template, (n_nationkey::bigint * 7919) % 65536 as h from nation), pp as (select p_partkey, (p_partkey::bigint * 104729) % 65536 as h from part) select p_partkey, template, bit_count(xor(pp.h, tp.h))::int as bits from pp, tp where bit_count(xor(pp.h, tp.h)) <= 3")
def hash_match(spark, d):
    """Pages whose perceptual hash is near a template's."""
    templates = t(spark, d, "nation").select(F.col("n_nationkey").alias("template"), (F.col("n_nationkey").cast("long") * 7919 % 65536).alias("template_hash"))
    own = t(spark, d, "part").select("p_partkey", (F.col("p_partkey").cast("long") * 104729 % 65536).alias("h"))
    return report.template_hits(own, templates, "p_partkey", "h", 3)


@query("with f as (select p_partkey, row_number() over (partition by p_brand order by p_partkey) as a, count(*) over (partition by p_brand) as n, p_size as dev from part) select p_partkey, case when dev < 8 then case when a <= 7 or a > n - 3 then 'roll_leader' else 'unknown' end end as page_class from f")
def blank_frames(spark, d):
    """Z1, on given deviations."""
    w = Window.partitionBy("p_brand")
    return t(spark, d, "part").select("p_partkey", report.blank_class(F.col("p_size"), F.row_number().over(w.orderBy("p_partkey")), F.count("*").over(w)).alias("page_class"))


# Reports


@query("select event_id from events where event_type = 'view' and event_id % 5 >= 3")
def exportable_frames(spark, d):
    """P16."""
    return report.exportable(t(spark, d, "events"), F.col("event_type") == "view", F.col("event_id") % 5).select("event_id")


@query("""with v as (select user_id, event_id, row_number() over (partition by user_id order by event_id) as rn from events where event_type = 'view'), n as (select user_id, rn, 1 as i, 'a' || event_id as x from v where rn <= 2 union all select user_id, rn, 2, 'b' || event_id from v where rn <= 2 and event_id % 2 = 0)
    select user_id, array_to_string(list(x order by rn, i)[1:3], ',') as names from n group by 1""")
def sample_names(spark, d):
    """O6': two names of each of the first two frames, three at most."""
    k = F.col("event_id").cast("string")
    own = t(spark, d, "events").where("event_type = 'view'").withColumn("names", F.array(F.concat(F.lit("a"), k), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("b"), k)).otherwise(""), F.concat(F.lit("c"), k)))
    return report.sample_names(own, ["user_id"], "event_id", "names", most=3).select("user_id", F.array_join("sample_names", ",").alias("names"))


@query("select o_custkey as run, round(sum(o_totalprice), 2) as spent, sum(o_totalprice) >= 2000000 as halt, round(greatest(2000000 - sum(o_totalprice), 0), 2)::double as left_over from orders group by 1")
def budget_guard(spark, d):
    """Z22."""
    out = report.budget_guard(t(spark, d, "orders").withColumnRenamed("o_custkey", "run"), ["run"], "o_totalprice", 2000000.0)
    return out.select("run", F.round("spent", 2).alias("spent"), "halt", F.round("left", 2).alias("left_over"))


@query("with x as (select user_id, count(*) as n, count(*) filter (where event_type <> 'error') as done, max(case when event_type <> 'error' then event_id % 1000 end) as last_s from events group by 1) select user_id, n, done, round(100.0 * done / n, 2)::double as percent, round(case when done > 0 then last_s * (n - done)::double / done end, 3) as eta_seconds from x")
def roll_progress(spark, d):
    """Z23."""
    own = t(spark, d, "events").withColumn("second", F.col("event_id") % 1000)
    return report.progress(own, ["user_id"], F.col("event_type") != "error", "second")


@query("select o_orderstatus as status, count(*) as pages, round(sum(o_totalprice), 2) as usd, count(*) filter (where o_totalprice < 1000) as open_reviews, count(*) filter (where o_orderkey % 5 = 0) as throttles from orders group by 1")
def status_gauges(spark, d):
    """Z24."""
    return report.gauges(t(spark, d, "orders"), F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_totalprice") < 1000, F.col("o_orderkey") % 5 == 0).withColumn("usd", F.round("usd", 2))


@query("select event_type, count(*) as calls, round(sum(value), 2) as usd from events group by 1")
def audit_by_model(spark, d):
    """Calls and spend by model or purpose."""
    return report.audit_totals(t(spark, d, "events"), [F.col("event_type")], "value")


@query("select user_id, count(*) as calls, round(sum(value), 2) as usd from events group by 1 order by usd desc, user_id limit 20")
def audit_top_rolls(spark, d):
    """The dearest rolls, a top-k report."""
    return report.audit_totals(t(spark, d, "events"), [F.col("user_id")], "value", 20)


@query("with e as (select user_id, event_id, row_number() over (partition by user_id order by ts desc) as rank from events where event_type = 'error') select user_id, event_id, rank from e where rank <= 3")
def audit_errors(spark, d):
    """The latest errors of each roll."""
    return report.audit_errors(t(spark, d, "events"), ["user_id"], F.col("event_type") == "error", "ts", 3).select("user_id", "event_id", "rank")


@query("select n_name, r_name, row_number() over (order by n_name, r_name) as job from nation, region")
def job_order(spark, d):
    """Fixture and feature jobs, numbered."""
    return report.job_list(t(spark, d, "nation").select("n_name"), t(spark, d, "region").select("r_name"), ["n_name", "r_name"])


@query("select user_id, event_id from events where event_type <> 'error' and event_id % 3 <> 0")
def frames_to_pull(spark, d):
    """Frames that aren't on disk yet."""
    own = t(spark, d, "events").where("event_type <> 'error'").select("user_id", "event_id")
    return report.to_pull(own, own.where("event_id % 3 = 0"), ["event_id"])


@query("with c as (select conv_id as page, turn as id, text, 1 as f from conversations union all select conv_id, turn, 'x' || text, 2 from conversations where turn % 2 = 1), r as (select *, row_number() over (partition by page, id order by f desc) as rn from c) select page, id::varchar as id, md5(text) as text_md5 from r where rn = 1")
def union_latest(spark, d):
    """Blocks of two features under one label; of one id the later feature's counts."""
    own = t(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").cast("string").alias("Id"), F.struct(F.lit(1).alias("rank"), F.col("turn").alias("pos")).alias("block_pos"), F.col("text").alias("Text"), "turn")
    more = own.where("turn % 2 = 1").withColumn("block_pos", F.struct(F.lit(2).alias("rank"), F.col("turn").alias("pos"))).withColumn("Text", F.concat(F.lit("x"), "Text"))
    return extract.latest(own.unionByName(more), "page").select("page", F.col("Id").alias("id"), F.md5("Text").alias("text_md5"))
