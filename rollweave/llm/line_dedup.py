"""Line dedup by content-defined chunks of lines. Native: DataFrame functions only.

A text's lines (split at ``\\n``) are hashed to 28 bits, and equal neighbouring lines make one run. After a run at which the rolling hash of its line and
the last one before it, ``(h + FACTOR * before) mod PRIME``, is 0 modulo DIVISOR a chunk ends, so that boundaries depend on two different lines of content only
and come back in step after an insertion. A run of several equal lines is a chunk of its own, as it has no two lines to choose from. A chunk of at
least LEAST_LINES lines that isn't blank and stands anywhere earlier too is removed. Earlier means a smaller key (null last), or the same
key and a smaller chunk number; of equal places all stay.

First, only chunk hashes are shuffled, to find the repeated ones. Then the chunks with a repeated hash, and only they, travel with their
text and are grouped by the text itself, so what is removed is equal byte by byte. All groupings aggregate before they shuffle, and what goes
back to a document is a list of its own chunks. Joins with the documents are told to merge, so that they run alike at every size, and joins with
an aggregate are dealt anew, so that the places of a very common line or passage can be split.

Chunks miss most short passages, as both their cuts must stand inside. ``drop_repeated_runs`` looks at each pair of consecutive lines that aren't
blank (with the blank ones between) as well, by the same steps: all lines of a repeated run of two or more lines go, whatever cuts are near. A
line's first place in the corpus always stays: a pair goes only if it stands earlier, and there both its lines do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, deal_join

DIVISOR = 4
#: Of the rolling hash. 28-bit hashes times the factor stay within 59 bits.
FACTOR, PRIME = 1103515245, 2147483647
LEAST_LINES = 2
NOT_BLANK = r"[^ \t\n\x0B\f\r]"


def line_hash(line: Column) -> Column:
    """The first 28 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _split(own: DataFrame) -> DataFrame:
    """All columns but _text, and lines, begins, ends. The generators are barriers: without them, lines would be split again for every use."""
    rest = [c for c in own.columns if c != "_text"]
    lines = F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1)
    own = own.select(*rest, F.inline(F.array(F.struct(lines.alias("lines")))))
    own = own.select(*rest, F.inline(F.array(F.struct(F.col("lines"), F.transform("lines", line_hash).alias("h")))))
    stops = F.filter(F.transform("h", lambda x, i: F.when(~F.equal_null(x, F.get("h", i + 1)), i)), lambda i: i.isNotNull())
    own = own.select(*rest, F.inline(F.array(F.struct(F.col("lines"), F.col("h"), stops.alias("stops")))))
    long = F.transform("stops", lambda e, k: e - F.coalesce(F.get("stops", k - 1), F.lit(-1)) > 1)
    own = own.select(*rest, F.inline(F.array(F.struct(F.col("lines"), F.transform("stops", lambda e: F.get("h", e)).alias("h"), F.col("stops"), long.alias("long")))))
    rolled = lambda k: F.coalesce((F.get("h", k) + F.lit(FACTOR).cast("long") * F.get("h", k - 1)) % PRIME % DIVISOR == 0, F.lit(False))
    cut = lambda k: F.get("long", k) | F.coalesce(F.get("long", k + 1), F.lit(True)) | rolled(k)
    ends = F.filter(F.transform("stops", lambda e, k: F.when(cut(k), e)), lambda e: e.isNotNull())
    own = own.select(*rest, F.inline(F.array(F.struct(F.col("lines"), ends.alias("ends")))))
    begins = F.concat(F.array(F.lit(0)), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda x: x + 1))
    return own.select(*rest, F.inline(F.array(F.struct(F.col("lines"), begins.alias("begins"), F.col("ends")))))


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    own = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return own.select("_key", F.xxhash64("_text").alias("_fp"), "_text")


def _text_of(begin: Column, end: Column) -> Column:
    return F.array_join(F.slice("lines", begin + 1, end - begin + 1), "\n")


def _chunks(rows: DataFrame, *extra: str) -> DataFrame:
    """(_key, _fp, no, n_lines, chunk) of each multi-line chunk that isn't blank."""
    spans = rows.select("_key", "_fp", *extra, "lines", F.posexplode(F.arrays_zip("begins", "ends")).alias("no", "at"))
    spans = spans.where(F.col("at.ends") - F.col("at.begins") + 1 >= LEAST_LINES)
    chunks = spans.select("_key", "_fp", *extra, "no", _text_of(F.col("at.begins"), F.col("at.ends")).alias("chunk"))
    return chunks.where(F.col("chunk").rlike(NOT_BLANK))


def repeated_chunks(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(_key, _fp, drop): the numbers of the chunks to remove, for each (key, text) that has any."""
    source = _source(docs, key, text)
    hashed = scratch.put(_chunks(_split(source)).select("_key", "_fp", "no", F.xxhash64("chunk").alias("h")), "hashed")
    repeated = hashed.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    suspects = scratch.put(deal_join(hashed, repeated, ["h"]).groupBy("_key", "_fp").agg(F.collect_set("no").alias("suspects")), "suspects")
    scratch.drop("hashed")
    marked = suspects.select(F.col("_key").alias("_skey"), F.col("_fp").alias("_sfp"), "suspects")
    joined = source.join(marked.hint("merge"), (F.col("_fp") == F.col("_sfp")) & F.equal_null("_key", "_skey")).drop("_skey", "_sfp")
    texts = _chunks(_split(joined), "suspects").where(F.array_contains("suspects", F.col("no"))).select("_key", "_fp", "no", "chunk")
    texts = scratch.put(texts, "texts")
    scratch.drop("suspects")
    place = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("no").alias("no"))
    first = texts.groupBy("chunk").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first != final").select("chunk", "first")
    later = deal_join(texts, first, ["chunk"]).where((F.col("_key").isNull() != F.col("first.n")) | ~F.equal_null("_key", F.col("first.k")) | (F.col("no") != F.col("first.no")))
    found = scratch.put(later.groupBy("_key", "_fp").agg(F.array_sort(F.collect_set("no")).alias("drop")), "drop")
    scratch.drop("texts")
    return found


def _units(rows: DataFrame) -> DataFrame:
    """All columns, and units: the spans (pair, a, b) of the multi-line chunks and of the pairs of consecutive lines that aren't blank."""
    rest = [c for c in rows.columns if c not in ("begins", "ends")]
    full = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(NOT_BLANK), i)), lambda i: i.isNotNull())
    rows = rows.select(*rest, F.inline(F.array(F.struct(F.col("begins"), F.col("ends"), full.alias("full")))))
    span = lambda pair, a, b: F.struct(F.lit(pair).alias("pair"), a.alias("a"), b.alias("b"))
    chunks = F.filter(F.zip_with("begins", "ends", lambda a, b: span(False, a, b)), lambda x: x["b"] - x["a"] + 1 >= LEAST_LINES)
    less = F.greatest(F.size("full") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("full", 1, less), F.slice("full", 2, less), lambda a, b: span(True, a, b))
    return rows.select(*rest, F.inline(F.array(F.struct(F.concat(chunks, pairs).alias("units")))))


def _unit_texts(rows: DataFrame, hashed: bool) -> DataFrame:
    """(_key, _fp, unit, h or chunk) of each unit that isn't blank. Text by text, so that the lines aren't copied for each unit."""
    chunk = lambda x: _text_of(x["a"], x["b"])
    value = lambda x: F.xxhash64(x["pair"], chunk(x)).alias("h") if hashed else chunk(x).alias("chunk")
    units = F.transform(F.filter("units", lambda x: x["pair"] | chunk(x).rlike(NOT_BLANK)), lambda x: F.struct(x.alias("unit"), value(x)))
    return rows.select("_key", "_fp", F.inline(units))


def repeated_spans(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(_key, _fp, drop): the units (pair, a, b) that stand anywhere earlier, for each (key, text) that has any. As repeated_chunks; a chunk is compared with chunks, a pair with pairs."""
    source = _source(docs, key, text)
    hashed = scratch.put(_unit_texts(_units(_split(source)), True), "hashed")
    repeated = hashed.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    suspects = scratch.put(deal_join(hashed, repeated, ["h"]).groupBy("_key", "_fp").agg(F.collect_set("unit").alias("units")), "suspects")
    scratch.drop("hashed")
    marked = suspects.select(F.col("_key").alias("_skey"), F.col("_fp").alias("_sfp"), "units")
    joined = source.join(marked.hint("merge"), (F.col("_fp") == F.col("_sfp")) & F.equal_null("_key", "_skey")).drop("_skey", "_sfp")
    lines = F.split(F.coalesce("_text", F.lit("")), "\n", -1)
    rows = joined.select("_key", "_fp", "units", F.inline(F.array(F.struct(lines.alias("lines")))))
    texts = scratch.put(_unit_texts(rows, False).select("_key", "_fp", "unit", F.col("unit.pair").alias("pair"), F.col("unit.a").alias("a"), "chunk"), "texts")
    scratch.drop("suspects")
    place = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("a").alias("a"))
    first = texts.groupBy("pair", "chunk").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first != final").select("pair", "chunk", "first")
    later = deal_join(texts, first, ["pair", "chunk"]).where((F.col("_key").isNull() != F.col("first.n")) | ~F.equal_null("_key", F.col("first.k")) | (F.col("a") != F.col("first.a")))
    found = scratch.put(later.groupBy("_key", "_fp").agg(F.collect_set("unit").alias("drop")), "drop")
    scratch.drop("texts")
    return found


def drop_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents without their repeated runs of two or more lines, with the new length in characters, all other columns as they are.

    The rows are those of drop_repeated_lines: a text of which the chunks alone leave nothing but blanks goes. One of which the pairs leave
    nothing stays as a row with an empty text, which has no tokens, so that mixing gives it no copies.
    """
    scratch = Scratch(docs.sparkSession, "runs")
    drop = repeated_spans(docs, key, text, scratch)
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    columns = list(names.values())
    own = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    own = own.select(*columns, F.col(names[text]).cast("string").alias("_text"), F.xxhash64(F.col(names[text]).cast("string")).alias("_fp"))
    marked = drop.select(F.col("_key").alias("_dkey"), F.col("_fp").alias("_dfp"), "drop")
    joined = own.join(marked.hint("merge"), (F.col("_fp") == F.col("_dfp")) & F.equal_null(names[key], "_dkey"), "left").select(*columns, "_text", "drop")
    lines = F.when(F.col("drop").isNotNull(), F.split("_text", "\n", -1))
    wide = joined.select(*columns, "_text", "drop", F.inline(F.array(F.struct(lines.alias("lines")))))

    def rest(spans: Column) -> Column:
        gone = F.flatten(F.transform(spans, lambda x: F.sequence(x["a"], x["b"])))
        stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
        return F.when(F.col("drop").isNotNull(), F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))

    chunked = F.filter("drop", lambda x: ~x["pair"])
    # Without a repeated chunk the text stays a row, whatever the pairs leave.
    emptied = (F.size(chunked) > 0) & ~rest(chunked).rlike(NOT_BLANK)
    wide = wide.select(*columns, "drop", F.inline(F.array(F.struct(rest(F.col("drop")).alias("kept"), F.coalesce(emptied, F.lit(False)).alias("emptied")))))
    kept = F.when(F.col("kept").rlike(NOT_BLANK), F.col("kept")).otherwise("")
    changed = {text: F.when(F.col("drop").isNotNull(), kept).otherwise(F.col(names[text]))}
    if length in docs.columns:
        changed[length] = F.when(F.col("drop").isNotNull(), F.length(kept).cast(dict(docs.dtypes)[length])).otherwise(F.col(names[length]))
    return wide.where(~F.col("emptied")).select(*(changed.get(c, F.col(n)).alias(c) for c, n in names.items()))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``row`` (the whole input row as a struct), n_lines, n_chunks, n_removed (chunks), n_removed_lines, kept (text).

    Null counts as an empty text: one empty line, nothing to remove; kept is null then. Repeated rows (same key and text) stand at equal
    places, so they lose the same chunks and keep the same ones. Extra columns don't matter.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    drop = repeated_chunks(docs, key, text, scratch)
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    columns = list(names.values())
    own = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    own = own.select(*columns, F.col(names[text]).cast("string").alias("_text"), F.xxhash64(F.col(names[text]).cast("string")).alias("_fp"))
    marked = drop.select(F.col("_key").alias("_dkey"), F.col("_fp").alias("_dfp"), "drop")
    joined = own.join(marked.hint("merge"), (F.col("_fp") == F.col("_dfp")) & F.equal_null(names[key], "_dkey"), "left")
    wide = _split(joined.select(*columns, "_text", F.coalesce("drop", F.array().cast("array<int>")).alias("drop")))
    columns.append("drop")
    spans = F.transform(F.arrays_zip("begins", "ends"), lambda x, i: F.struct(x["begins"].alias("a"), x["ends"].alias("b"), i.alias("no")))
    wide = wide.select(*columns, "lines", F.inline(F.array(F.struct(spans.alias("spans")))))
    kept = F.filter("spans", lambda x: ~F.array_contains("drop", x["no"]))
    wide = wide.select(*columns, "lines", F.size("spans").cast("long").alias("n_chunks"), F.inline(F.array(F.struct(kept.alias("kept_spans")))))
    kept_lines = F.aggregate("kept_spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"] + 1)
    n_lines = F.size("lines").cast("long")
    kept_text = F.when(F.size("drop") == 0, F.col(names[text]).cast("string")).otherwise(F.array_join(F.transform("kept_spans", lambda x: _text_of(x["a"], x["b"])), "\n"))
    row = F.struct(*(F.col(n).alias(c) for c, n in names.items()))
    return wide.select(F.col(names[key]).alias(key), row.alias("row"), n_lines.alias("n_lines"), "n_chunks", F.size("drop").cast("long").alias("n_removed"), (n_lines - kept_lines).alias("n_removed_lines"), kept_text.alias("kept"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with the kept text (and its length in characters), all other columns as they are. Those of which nothing but blanks is left go."""
    out = line_dedup(docs, key, text).where((F.col("n_removed") == 0) | F.col("kept").rlike(NOT_BLANK))
    changed = {text: F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"row.`{text}`"))}
    if length in docs.columns:
        kind = dict(docs.dtypes)[length]
        changed[length] = F.when(F.col("n_removed") > 0, F.length("kept").cast(kind)).otherwise(F.col(f"row.`{length}`"))
    return out.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
