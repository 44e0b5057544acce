"""Page extraction from OCR blocks: candidates, votes, routing, scores, digests.

blocks: as read_blocks gives them, with a page column: page, block_pos (sortable), Id, BlockType, Text, Confidence, EntityTypes, RowIndex, ColumnIndex,
Relationships, Query, Geometry. Every step is a join or an aggregate by page, and blocks are looked at from many sides: give a stored or cached table, not a parse of raw responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import PRICES, blank, clean_name, either_contains, folded, index_rows, price, ratio, strip, strip_title, text, token_cost, valid_name
from ..sources.records import INDEX_ROW, PAGE_CLASSES
from . import blocks as b, report, snap
from .enrich import SECOND_PASS

# Candidate sources in the order that decides ties, aliases of the questions, words of keys that mean somebody else, words that are labels, the fallback's confidence.
SOURCES = ("forms_name", "forms_bbox", "queries_record", "queries_top", "queries_full", "detect_first")
ALIASES = {"RECORD_NAME": "queries_record", "TOP_NAME": "queries_top", "FULL_NAME": "queries_full"}
OTHERS = ("MOTHER", "FATHER", "PARENT", "GUARDIAN")
BOX_CONFIDENCE = 50.0


def latest(blocks: DataFrame, page: str) -> DataFrame:
    """Of blocks with one id the last one, which is what an id refers to."""
    w = Window.partitionBy(page, "Id").orderBy(F.desc("block_pos"))
    return blocks.where("Id is not null").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def resolve(blocks: DataFrame, page: str, of: Column | None = None) -> DataFrame:
    """The blocks (those for which ``of`` holds) with what their relationships lead to: words (the texts of the WORD children, in order), answer (text and conf of the first block that answers) and
    value (the words of the last VALUE block). Ids that lead nowhere are ignored. One join for the first level, none for the values of keys. Blocks are often exploded from a few columns, and
    Spark then takes them for no larger than those, so its joins are kept from sending one side through the driver."""
    own = latest(blocks, page).select(page, F.col("Id").alias("child"), F.col("BlockType").alias("_kind"), text(F.col("Text")).alias("_text"), F.coalesce("Confidence", F.lit(0.0)).alias("_conf"))
    links = b.edges(blocks, page).distinct().join(own.hint("merge"), [page, "child"])
    kind = F.col("type")
    words = F.array_sort(F.collect_list(F.when((kind == "CHILD") & (F.col("_kind") == "WORD"), F.struct("ord", strip(F.col("_text")).alias("w")))))
    first = links.groupBy(page, F.col("parent").alias("Id")).agg(
        strip(F.array_join(F.transform(words, lambda x: x["w"]), " ")).alias("words"),
        F.min(F.when(kind == "ANSWER", F.struct("ord", F.col("_text").alias("text"), F.col("_conf").alias("conf")))).alias("answer"),
        F.max(F.when(kind == "VALUE", F.struct("ord", "child"))).alias("_value"),
    )
    # Each block stands under its own id and, if it has a value, under the value's, where it finds the words.
    twice = F.array(F.struct(F.col("Id").alias("_at"), F.lit(False).alias("_asks")), F.struct(F.coalesce("_value.child", "Id").alias("_at"), F.lit(True).alias("_asks")))
    value = F.max(F.when(~F.col("_asks"), F.col("words"))).over(Window.partitionBy(page, "_at"))
    first = first.select("*", F.inline(twice)).withColumn("value", F.when(F.col("_value").isNotNull(), value)).where("_asks").select(page, "Id", "words", "answer", "value")
    asked = blocks if of is None else blocks.where(of)
    return asked.join(first.hint("merge"), [page, "Id"], "left").withColumn("words", text(F.col("words"))).withColumn("value", text(F.col("value")))


def candidates(pages: DataFrame, blocks: DataFrame, page: str, anchor: str = "LAST", skip: tuple[str, ...] = b.LABEL_WORDS) -> DataFrame:
    """(page, pos, source, raw, conf): six rows for each page of ``pages``, blank at confidence 0 where a source has nothing. Aggregates by page, and one join of words with their page's anchor: no page is gathered whole.

    forms_name (A19): the value of the surest key that speaks of a name and not of a parent's. forms_bbox (J11): the word to the right of the first word that is the anchor, at a fixed
    confidence; only that word counts, even if it has no box. queries_* (A20): the first answer of the alias's first question that has one. detect_first (A21): the first line that is a valid name."""
    kind, conf, upper = F.col("BlockType"), F.coalesce("Confidence", F.lit(0.0)), F.upper("words")
    box = F.col("Geometry.BoundingBox")
    other = F.exists(F.array(*map(F.lit, OTHERS)), lambda o: F.contains(upper, o))
    is_key = (kind == "KEY_VALUE_SET") & F.coalesce(F.array_contains("EntityTypes", "KEY"), F.lit(False))
    named = is_key & F.contains(upper, F.lit("NAME")) & ~other & (F.col("value") != "") & (conf > 0)
    line = strip(F.col("Text"))
    is_word = kind == "WORD"
    first = lambda when, *order_and_rest: F.min(F.when(when, F.struct(*order_and_rest)))
    asked = resolve(blocks, page, is_key | (kind == "QUERY")).groupBy(page).agg(
        first(named, (-conf).alias("o"), "block_pos", F.col("value").alias("raw"), conf.alias("conf")).alias("forms_name"),
        *(first((kind == "QUERY") & (F.col("Query.Alias") == alias) & F.col("answer").isNotNull(), F.col("block_pos").alias("o"), F.col("answer.text").alias("raw"), F.col("answer.conf").alias("conf")).alias(source) for alias, source in ALIASES.items()),
    )
    lines = blocks.where((kind == "LINE") & valid_name(line)).groupBy(page).agg(F.min(F.struct(F.col("block_pos").alias("o"), line.alias("raw"), conf.alias("conf"))).alias("detect_first"))
    anchors = blocks.where(is_word & (F.upper(line) == anchor.upper())).groupBy(page).agg(F.min(F.struct(F.col("block_pos").alias("id"), box.alias("box"))).alias("_anchor"))
    words = blocks.where(is_word & (line != "") & box.isNotNull() & ~F.upper(line).isin(*skip)).select(page, F.col("block_pos").alias("id"), line.alias("raw"), box.alias("box"))
    at = F.col("_anchor.box")
    gap = F.col("box.Left") - (at["Left"] + at["Width"])
    near = words.join(anchors.hint("merge"), page).where((F.col("id") != F.col("_anchor.id")) & (F.abs(F.col("box.Top") - at["Top"]) <= at["Height"]) & gap.between(-0.005, 0.30))
    near = near.groupBy(page).agg(F.min(F.struct(gap.alias("o"), "id", "raw", F.lit(BOX_CONFIDENCE).alias("conf"))).alias("forms_bbox"))
    found = pages.select(page, F.lit(True).alias("_there")).distinct()
    for part in (asked, lines, near):
        found = found.unionByName(part, allowMissingColumns=True)
    found = found.groupBy(page).agg(F.max("_there").alias("_there"), *(F.first(c, ignorenulls=True).alias(c) for c in SOURCES)).where("_there")
    side = lambda s: F.struct(text(F.col(f"{s}.raw")).alias("raw"), F.coalesce(F.col(f"{s}.conf"), F.lit(0.0)).alias("conf"))
    listed = F.array(*(F.struct(F.lit(k).alias("pos"), F.lit(s).alias("source"), side(s).alias("c")) for k, s in enumerate(SOURCES)))
    return found.select(page, F.inline(listed)).select(page, "pos", "source", "c.raw", "c.conf")


def vote_names(found: DataFrame, page: str) -> DataFrame:
    """(page, vote_name, vote_confidence, vote_agreement, vote_sources). Pages without a valid candidate have no row."""
    own = found.withColumn("name", clean_name(F.col("raw"))).where(valid_name(F.col("name"))).withColumn("form", folded(F.col("name")))
    won = report.vote(own, [page], "form", "name", "conf", "pos")
    sources = F.transform("sources", lambda k: F.element_at(F.array(*map(F.lit, SOURCES)), k + 1))
    return won.select(page, F.col("name").alias("vote_name"), F.col("confidence").alias("vote_confidence"), F.col("agreement").alias("vote_agreement"), sources.alias("vote_sources"))


def index_from_tables(blocks: DataFrame, page: str) -> DataFrame:
    """(page, table, r, last, first, middle, dob) of the records in a page's tables."""
    own = resolve(blocks.where(F.col("BlockType").isin("TABLE", "CELL", "WORD")), page)
    cells = latest(own.where("BlockType = 'CELL'"), page).select(page, F.col("Id").alias("child"), F.col("RowIndex").alias("r"), F.col("ColumnIndex").alias("c"), F.col("words").alias("text"))
    cells = b.edges(blocks.where("BlockType = 'TABLE'"), page).where("type = 'CHILD'").join(cells, [page, "child"])
    # Of cells at one place the last one counts. A table is gathered whole: it stands on one page.
    keys = [page, F.col("parent").alias("table")]
    cells = cells.groupBy(*keys, "r", "c").agg(F.max_by("text", "ord").alias("text"))
    tables = cells.groupBy(page, "table", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "text"))).alias("m"))
    tables = tables.groupBy(page, "table").agg(F.map_from_entries(F.collect_list(F.struct("r", "m"))).alias("rows"))
    filled = lambda r: F.size(F.filter(F.map_values(F.try_element_at("rows", F.lit(r))), lambda t: ~blank(t)))
    head = F.when(filled(1) >= 3, 1).when(filled(2) >= 3, 2).when(filled(3) >= 3, 3).otherwise(1)
    tables = tables.withColumn("_head", head).withColumn("_cells", F.array_sort(F.map_entries(F.coalesce(F.try_element_at("rows", F.col("_head")), F.create_map().cast("map<int,string>")))))
    hit = lambda t, marks: F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(F.upper(t), m))
    field = lambda t: F.when(hit(t, b.HINTS[0][1]), "last").when(hit(t, b.HINTS[1][1]), "first").when(hit(t, b.HINTS[2][1]), "middle").when(hit(t, b.HINTS[3][1]), "dob")
    tables = tables.withColumn("_fields", F.transform("_cells", lambda e: F.struct(field(e["value"]).alias("f"), e["key"].alias("c"))))
    column = lambda f: F.array_min(F.transform(F.filter("_fields", lambda x: x["f"] == f), lambda x: x["c"])).alias(f"c_{f}")
    tables = tables.select(page, "table", "rows", "_head", *(column(f) for f, _ in b.HINTS)).where("c_last is not null and c_first is not null")
    rows = tables.select(page, "table", "_head", *(f"c_{f}" for f, _ in b.HINTS), F.explode("rows").alias("r", "m")).where("r > _head")
    value = lambda f: F.coalesce(strip(F.try_element_at("m", F.col(f"c_{f}"))), F.lit("")).alias(f)
    return rows.select(page, "table", "r", *(value(f) for f, _ in b.HINTS)).where("last <> '' or first <> ''")


def extract(pages: DataFrame, blocks: DataFrame, page: str, page_class: str, roll: str, seq: str, visibility: str = "prefix", keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One wide row per page. Index pages get index_rows_added; covers the candidates, the vote, and, for a vote of one word, the entry of the roll's index that is
    nearest by last name; other pages neither. visibility: prefix (entries of pages earlier in the roll) or roll (all of them). keep: stores what several steps read (entries, candidates, votes), so that blocks are resolved
    once for each, not for every step."""
    if visibility not in ("prefix", "roll"):
        raise ValueError(f"unknown visibility {visibility}")
    kind = F.col(page_class)
    ids = lambda c: pages.where(kind == c).select(page, roll, seq)
    own = lambda of: blocks.join(of.select(page).distinct(), page, "left_semi")  # noqa: E731  blocks of other pages aren't resolved
    entries = keep(index_from_tables(own(ids("student_records_index")), page).join(ids("student_records_index"), page))
    added = entries.groupBy(page).agg(F.count("*").alias("index_rows_added"))
    covers = ids("student_cover")
    found = keep(candidates(covers, own(covers), page))
    listed = found.groupBy(page).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "source", "raw", "conf"))), lambda x: F.struct(x["source"].alias("source"), x["raw"].alias("raw"), x["conf"].alias("conf"))).alias("candidate_sources"))
    votes = keep(vote_names(found, page))
    index = entries.select(roll, F.upper("last").alias("ilast"), F.upper("first").alias("ifirst"), F.col("middle").alias("imiddle"), F.struct(F.col(seq).alias("seq"), "table", "r").alias("pos"), F.col("dob").alias("_dob"))
    single = covers.join(votes, page).where(~F.contains("vote_name", F.lit(" "))).select(page, roll, seq, "vote_name", F.lit("").alias("_none"))
    seen = F.col("pos.seq") < F.col(seq) if visibility == "prefix" else F.lit(True)
    near = snap.nearest(single, index, roll, "vote_name", "_none", caps=(2, 2, 3), first_optional=True, visible=seen, carry=(seq,)).where("snap is not null")
    snapped = near.select(page, F.struct(F.col("snap.ilast").alias("last"), F.col("snap.ifirst").alias("first"), F.col("snap.imiddle").alias("middle")).alias("snapped"))
    out = pages.join(added, page, "left").join(listed, page, "left").join(votes, page, "left").join(snapped, page, "left")
    zero = lambda c, v, at: F.when(kind == at, F.coalesce(c, F.lit(v))).alias(c)
    return out.select(*pages.columns, zero("index_rows_added", 0, "student_records_index"), "candidate_sources", zero("vote_name", "", "student_cover"), zero("vote_confidence", 0.0, "student_cover"), zero("vote_agreement", 0, "student_cover"), "vote_sources", "snapped")


def fingerprint(blocks: DataFrame, page: str) -> DataFrame:
    """(page, upper, lines, tables, cells, keys, signatures, block_types): counts, the lines' text in upper case, and a map of all types."""
    kind = F.col("BlockType")
    each = blocks.groupBy(page, "BlockType").agg(F.count("*").alias("n")).groupBy(page).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("BlockType", "n")))).alias("block_types"))
    lines = F.transform(F.array_sort(F.collect_list(F.when(kind == "LINE", F.struct("block_pos", text(F.col("Text")).alias("t"))))), lambda x: x["t"])
    is_key = (kind == "KEY_VALUE_SET") & F.coalesce(F.array_contains("EntityTypes", "KEY"), F.lit(False))
    counts = [F.count_if(kind == k).alias(n) for k, n in (("LINE", "lines"), ("TABLE", "tables"), ("CELL", "cells"), ("SIGNATURE", "signatures"))]
    own = blocks.groupBy(page).agg(F.upper(F.array_join(lines, " ")).alias("upper"), *counts, F.count_if(is_key).alias("keys"))
    return own.join(each, page)


def classify(blocks: DataFrame, page: str) -> DataFrame:
    """M1: (page, page_class, classifier_confidence)."""
    own = fingerprint(blocks, page)
    found = b.layout_class(*(F.col(c) for c in ("upper", "lines", "tables", "cells", "keys", "signatures")))
    return own.select(page, found.alias("c")).select(page, "c.page_class", F.col("c.confidence").alias("classifier_confidence"))


def second_pass(page_class: Column, with_queries: Column | bool = True) -> Column:
    """M3: the features that are bought for a class in the second pass; questions only if there are any."""
    table = F.create_map(*(x for k, v in SECOND_PASS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    own = F.coalesce(F.try_element_at(table, page_class), F.array().cast("array<string>"))
    return F.when(F.lit(with_queries) if isinstance(with_queries, bool) else with_queries, own).otherwise(F.array_remove(own, "queries"))


def routed_price(page_class: Column, with_queries: Column | bool = True) -> Column:
    """What a page costs over both passes: a combined call costs the sum of its features."""
    return F.round(F.lit(PRICES["detect"]) + F.aggregate(second_pass(page_class, with_queries), F.lit(0.0), lambda a, f: a + price(f, F.lit(1))), 6)


REPLY = f"struct<page_class:string,separator:struct<marker:string,roll_no:string>,student:struct<last:string,first:string,middle:string,dob:string,school:string>,roll_meta:struct<filmer:string,date:string,school:string,reel_no_cert:string>,index_rows:array<{INDEX_ROW}>,confidence_overall:double,confidence_name:double,notes:string>"


def page_records(replies: DataFrame, reply: str = "reply", **prices: float) -> DataFrame:
    """Page records from a model's JSON replies (roll_id, frame, reply, model_version, processed_at, latency_ms, tokens_in, tokens_out): blanks for missing
    names, trimmed index rows and only on index pages, cost by tokens; ``error`` names the first rule of the output contract that a reply breaks."""
    own = replies.withColumn("_r", F.from_json(F.col(reply), REPLY, {"mode": "PERMISSIVE"}))
    r = lambda c: F.col(f"_r.{c}")
    outside = lambda c: r(c).isNull() | ~r(c).between(0, 1)
    error = (
        F.when(F.col("_r").isNull() | r("page_class").isNull(), "no page class")
        .when(~r("page_class").isin(*PAGE_CLASSES), F.concat(F.lit("bad page class "), r("page_class")))
        .when(r("separator.marker").isNotNull() & ~r("separator.marker").isin("START", "END"), "bad marker")
        .when(outside("confidence_overall") | outside("confidence_name"), "confidence out of range")
    )
    blanks = lambda at, names: F.struct(*(text(r(f"{at}.{n}")).alias(n) for n in names)).alias(at)
    rows = F.when(r("page_class") == "student_records_index", index_rows(r("index_rows"), F.col("frame"))).otherwise(F.array().cast(f"array<{INDEX_ROW}>"))
    usage = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("latency_ms", "tokens_in", "tokens_out")]
    return own.select(
        "frame", "roll_id", r("page_class").alias("page_class"), F.struct(r("separator.marker").alias("marker"), r("separator.roll_no").alias("roll_no")).alias("separator"),
        blanks("student", ("last", "first", "middle", "dob", "school")), blanks("roll_meta", ("filmer", "date", "school", "reel_no_cert")), rows.cast(f"array<{INDEX_ROW}>").alias("index_rows"),
        r("confidence_overall").alias("confidence_overall"), r("confidence_name").alias("confidence_name"), text(r("notes")).alias("notes"), "model_version", "processed_at",
        *usage, token_cost(F.coalesce("tokens_in", F.lit(0)), F.coalesce("tokens_out", F.lit(0)), **prices).alias("usd_cost"), error.alias("error"),
    )


def name_matches(got: Column, expected: Column, titles: bool = False) -> Column:
    """either holds the other; with titles, also without an initial or honorific in front."""
    plain = either_contains(got, expected)
    return plain | either_contains(strip_title(strip(got)), expected) if titles else plain


def replay_score(results: DataFrame, ship_at: float = 0.70, page_class: str = "expected_class") -> DataFrame:
    """One row over the covers: how many there are, are right, ship, and ship right; recall and precision in percent. results: expected_name, vote_name, vote_confidence."""
    right = F.coalesce(name_matches(F.col("vote_name"), F.col("expected_name"), True), F.lit(False))
    ships = F.coalesce("vote_confidence", F.lit(0.0)) >= ship_at
    out = results.where(F.col(page_class) == "student_cover").agg(F.count("*").alias("covers"), F.count_if(right).alias("correct"), F.count_if(ships).alias("shipped"), F.count_if(ships & right).alias("shipped_correct"))
    return out.withColumn("precision_pct", 100 * ratio(F.col("shipped_correct"), F.col("shipped"))).withColumn("recall_pct", 100 * ratio(F.col("correct"), F.col("covers")))


def live_score(results: DataFrame, ship_at: float = 0.60) -> DataFrame:
    """A26, P9': one row over all pages; a name counts as right or shipped only where one was expected and one was found."""
    both = ~blank(F.col("vote_name")) & ~blank(F.col("expected_name"))
    right, ships = both & name_matches(F.col("vote_name"), F.col("expected_name")), both & (F.coalesce("vote_confidence", F.lit(0.0)) >= ship_at)
    return results.agg(F.count("*").alias("pages"), F.coalesce(F.sum("spend_usd"), F.lit(0.0)).alias("spend_usd"), F.count_if(right).alias("correct"), F.count_if(ships).alias("shipped"), F.coalesce(F.sum("index_rows_added"), F.lit(0)).cast("long").alias("index_rows"))


def feature_summary(blocks: DataFrame, page: str, feature: str) -> DataFrame:
    """(page, feature, summary): what a feature's response holds, as one short text."""
    kind, n = F.col("BlockType"), lambda c: F.count_if(c).cast("string")
    out = blocks.groupBy(page, feature).agg(
        n(kind == "LINE").alias("l"), n((kind == "KEY_VALUE_SET") & F.coalesce(F.array_contains("EntityTypes", "KEY"), F.lit(False))).alias("k"), n(kind == "TABLE").alias("t"), n(kind == "CELL").alias("c"), n(F.startswith(kind, F.lit("LAYOUT_"))).alias("y"), n(kind == "QUERY_RESULT").alias("a")
    )
    said = F.when(F.col(feature) == "detect", F.concat(F.lit("lines="), "l")).when(F.col(feature) == "forms", F.concat(F.lit("kv_keys="), "k"))
    said = said.when(F.col(feature) == "tables", F.concat(F.lit("tables="), "t", F.lit(" cells="), "c")).when(F.col(feature) == "layout", F.concat(F.lit("layout_blocks="), "y"))
    return out.select(page, feature, said.when(F.col(feature) == "queries", F.concat(F.lit("answers="), "a")).otherwise("?").alias("summary"))


def ocr_summary(words: DataFrame, page: str) -> DataFrame:
    """(page, mean_confidence, n_words): words without a confidence (below 0) don't count in the mean, blank ones not in the number."""
    return words.groupBy(page).agg(F.coalesce(F.avg(F.when(F.col("conf") >= 0, F.col("conf"))), F.lit(0.0)).alias("mean_confidence"), F.count_if(~blank(F.col("text"))).alias("n_words"))


def layout_histogram(blocks: DataFrame, page: str) -> DataFrame:
    """(page, block_type, n) of the layout blocks."""
    return blocks.where(F.startswith("BlockType", F.lit("LAYOUT_"))).groupBy(page, F.col("BlockType").alias("block_type")).agg(F.count("*").alias("n"))


def text_digest(blocks: DataFrame, page: str, most: int = 50) -> DataFrame:
    """(page, digest): a page's first lines, and how many more there are."""
    lines = blocks.where("BlockType = 'LINE'").groupBy(page).agg(F.array_sort(F.collect_list(F.struct("block_pos", text(F.col("Text")).alias("t")))).alias("_l"))
    body = F.array_join(F.transform(F.slice("_l", 1, most), lambda x: x["t"]), "\n")
    more = F.when(F.size("_l") > most, F.concat(F.lit("\n... ("), (F.size("_l") - most).cast("string"), F.lit(" more LINEs)"))).otherwise("")
    return lines.select(page, F.size("_l").cast("long").alias("n_lines"), F.concat(body, more).alias("digest"))


def table_digest(cells: DataFrame, page: str, most_rows: int = 12, width: int = 18) -> DataFrame:
    """(page, table, digest): a table's first rows, cells cut to a width. cells: page, table, r, c, text."""
    size = cells.groupBy(page, "table").agg(F.max("r").alias("rows"), F.max("c").alias("cols"))
    lines = cells.where(F.col("r") <= most_rows).groupBy(page, "table", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", F.rpad(F.left(text(F.col("text")), F.lit(width)), width, " ")))).alias("m"))
    lines = lines.join(size, [page, "table"]).withColumn("line", F.array_join(F.transform(F.sequence(F.lit(1), "cols"), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(" " * width))), " | "))
    empty = F.lit(" | ")
    rows = lines.groupBy(page, "table", "rows", "cols").agg(F.map_from_entries(F.collect_list(F.struct("r", "line"))).alias("m"))
    blank_line = F.array_join(F.array_repeat(F.lit(" " * width), F.col("cols")), " | ") if width else empty
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.least("rows", F.lit(most_rows))), lambda r: F.coalesce(F.try_element_at("m", r), blank_line)), "\n")
    more = F.when(F.col("rows") > most_rows, F.concat(F.lit("\n... ("), (F.col("rows") - most_rows).cast("string"), F.lit(" more rows)"))).otherwise("")
    return rows.select(page, "table", "rows", "cols", F.concat(body, more).alias("digest"))


def spot_check(results: DataFrame, group: str, n: int = 30, ship_at: float = 0.70) -> DataFrame:
    """The surest covers that ship, of each district, ranked, with one line of the written check each."""
    own = report.top_n(results.where((F.col("page_class") == "student_cover") & (F.coalesce("vote_confidence", F.lit(0.0)) >= ship_at)), [group], [F.desc("vote_confidence"), F.asc("label")], n)
    line = F.concat(F.lit("| "), "label", F.lit(" | `"), "vote_name", F.lit("` | "), F.format_string("%.3f", "vote_confidence"), F.lit(" | "), F.col("vote_agreement").cast("string"), F.lit(" |"))
    return own.withColumn("line", line)


def gate(rows: DataFrame, last: str, first: str, dob: str) -> DataFrame:
    """Names that aren't valid are blanked, digits in front of them go; a date of birth that isn't valid is blanked alone. ``name_ok`` and ``dob_ok`` say what passed."""
    from ..functions.scalars import strip_digits, valid_dob

    tidy = lambda c: clean_name(strip(strip_digits(strip(F.col(c)))))
    pattern = F.lit(r"^[A-Za-z][A-Za-z'\-. ]{0,38}[A-Za-z]$")
    own = rows.withColumn("_l", tidy(last)).withColumn("_f", tidy(first)).withColumn("dob_ok", valid_dob(F.col(dob)))
    own = own.withColumn("name_ok", F.rlike("_l", pattern) & F.rlike("_f", pattern) & valid_name(F.concat_ws(" ", "_l", "_f")))
    keep = lambda c: F.when(F.col("name_ok"), F.col(c)).otherwise("")
    return own.withColumn(last, keep("_l")).withColumn(first, keep("_f")).withColumn(dob, F.when(F.col("dob_ok"), F.col(dob)).otherwise("")).drop("_l", "_f")


def second_opinion(first: DataFrame, second: DataFrame, keys: list[str], value: str, confidence: str, low: float = 0.5, high: float = 0.75) -> DataFrame:
    """``decision`` of each row: accept over the band, review under it; inside it accept if the second model's answer (asked for those rows only) is the same, else review."""
    other = second.select(*keys, F.col(value).alias("_other"))
    own = first.join(other, keys, "left")
    inside = F.col(confidence).between(low, high)
    decision = F.when(inside, F.when(F.equal_null(value, "_other"), "accept").otherwise("review")).when(F.col(confidence) > high, "accept").otherwise("review")
    return own.withColumn("decision", decision).drop("_other")


def band(rows: DataFrame, confidence: str, low: float = 0.5, high: float = 0.75) -> DataFrame:
    """The rows that a second model is asked for."""
    return rows.where(F.col(confidence).between(low, high))


def subtype_scores(pages: DataFrame, matrix: DataFrame, page: str, least: float = 6.0, margin: float = 3.0) -> DataFrame:
    """(page, subtype, parent, score, confidence, refused). pages: page, frame_no, n_frames, district, top, full (upper-case texts). matrix, a fixed list: subtype, parent,
    titles, headers, phrases, excluded (arrays of upper-case texts), position, districts. A title counts 8 at the top of the page and 4 elsewhere, a header 1.5 (5 at most), a phrase 0.8 (4 at most), a fitting place
    1.5 (0.4 mid-roll), a listed district 1; an excluded text makes 0. Without a clear winner the page is refused."""
    score = lambda c, f: F.aggregate(F.coalesce(c, F.array().cast("array<string>")), F.lit(0.0), lambda a, x: a + f(x))
    hits = lambda c, most: F.least(score(c, lambda x: F.contains("full", x).cast("double")), F.lit(float(most)))
    titles = score(F.col("titles"), lambda x: F.when(F.contains("top", x), 8.0).when(F.contains("full", x), 4.0).otherwise(0.0))
    at, n = F.col("frame_no"), F.col("n_frames")
    place = F.when(F.contains("position", F.lit("first_3_to_6")) & at.between(3, 6), 1.5).when(F.contains("position", F.lit("last_3_to_last")) & (at >= n - 3), 1.5).when((F.col("position") == "mid_roll") & at.between(7, n - 4), 0.4).otherwise(0.0)
    bias = F.when(F.coalesce(F.array_contains("districts", F.col("district")), F.lit(False)), 1.0).otherwise(0.0)
    out = F.coalesce(F.exists("excluded", lambda x: F.contains("full", x)), F.lit(False))
    # The matrix is a fixed list of some dozen subtypes, so each page meets all of it.
    own = pages.crossJoin(F.broadcast(matrix)).withColumn("score", F.when(out, 0.0).otherwise(F.round(titles + 1.5 * hits(F.col("headers"), 5) + 0.8 * hits(F.col("phrases"), 4) + place + bias, 6)))
    first = own.groupBy(page).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "subtype", "parent"))).alias("all"))
    best, second = -F.col("all")[0]["s"], -F.coalesce(F.get("all", F.lit(1))["s"], F.lit(0.0))
    refused = (best < least) | (best - second < margin)
    pick = lambda c, other: F.when(refused, other).otherwise(F.col("all")[0][c])
    return first.select(page, pick("subtype", "unknown_unrecognized").alias("subtype"), pick("parent", "unknown").alias("parent"), best.alias("score"), F.when(refused, 0.0).otherwise(F.round((best - second) / best, 6)).alias("confidence"), refused.alias("refused"))


def component_vote(found: DataFrame, page: str, order: str) -> DataFrame:
    """Last, first and middle voted on apart; agreement is the lesser of the first two's; 3 are worth 0.95, 2 0.80, fewer 0.50. Of equals the one seen first."""
    def top(c: str, n: str) -> DataFrame:
        each = found.where(F.col(c) != "") if c == "middle" else found
        each = each.groupBy(page, c).agg(F.count("*").alias("n"), F.min(order).alias("o"))
        return b.best_by(each, [page], F.struct(c, "n"), [F.desc("n"), F.asc("o"), F.asc(c)]).select(page, F.col(f"best.{c}").alias(c), F.col("best.n").alias(n))

    own = top("last", "_l").join(top("first", "_f"), page).join(top("middle", "_m"), page, "left").withColumn("agreement", F.least("_l", "_f"))
    own = own.withColumn("confidence", F.when(F.col("agreement") >= 3, 0.95).when(F.col("agreement") == 2, 0.80).otherwise(0.50))
    decision = F.when(F.col("agreement") >= 3, "ship").when(F.col("agreement") == 2, "snap").otherwise("review")
    return own.select(page, "last", "first", F.coalesce("middle", F.lit("")).alias("middle"), "agreement", "confidence", decision.alias("decision"))
