"""OCR block graphs: text of children, fingerprints, classes, grids, nearest words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import blank

# Phrases of the classes.
COVER_PHRASES = ("1. NAME", "STUDENT NAME", "DATE OF BIRTH", "PLACE OF BIRTH", "BIRTHDATE", "BIRTHPLACE", "SCHOOL DISTRICT OF", "PUPIL LIVES", "MOTHER", "FATHER", "GUARDIAN")
TEST_PHRASES = ("STATEWIDE", "ASSESSMENT PROGRAM", "STUDENT REPORT", "SSAT", "STANFORD", "ACHIEVEMENT TEST")
INDEX_PHRASES = ("STUDENT RECORDS INDEX",)
CERTIFICATE_PHRASES = ("CERTIFICATE OF AUTHENTICITY", "CERTIFICATE OF RECORD")
# Words that are labels and no values; two locality words of the same list are left to the caller.
LABEL_WORDS = (
    "LAST", "FIRST", "MIDDLE", "NAME", "DOB", "BIRTH", "DATE", "PLACE", "BIRTHPLACE", "BIRTHDATE", "SCHOOL", "SEX", "RACE", "AGE", "GRADE", "ADDRESS", "PHONE", "PARENT", "MOTHER", "FATHER",
    "GUARDIAN", "PUPIL", "STUDENT", "RECORD", "OF", "COUNTY", "ROLL", "NUMBER",
)
HINTS = (("last", ("LAST",)), ("first", ("FIRST",)), ("middle", ("MIDDLE",)), ("dob", ("DOB", "BIRTH")))


def edges(blocks: DataFrame, page: str) -> DataFrame:
    """(page, parent, type, ord, child) of nested relationships."""
    own = blocks.select(page, F.col("Id").alias("parent"), F.posexplode("Relationships").alias("k", "r"))
    return own.select(page, "parent", F.col("r.Type").alias("type"), "k", F.posexplode("r.Ids").alias("i", "child")).withColumn("ord", F.struct("k", "i")).drop("k", "i")


def child_text(parents: DataFrame, children: DataFrame, keys: list[str], order: str, text: str, sep: str = " ") -> DataFrame:
    """The children's texts in order; missing children are ignored, parents without any have ''."""
    gathered = children.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), sep).alias("child_text"))
    return parents.join(gathered, keys, "left").withColumn("child_text", F.coalesce("child_text", F.lit("")))


def hits(upper: Column, phrases: tuple[str, ...]) -> Column:
    """A13."""
    return F.size(F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(upper, p)))


def layout_class(upper: Column, lines: Column, tables: Column, cells: Column, keys: Column, signatures: Column) -> Column:
    """M1: struct(page_class, confidence); the first rule that holds decides."""
    cover = hits(upper, COVER_PHRASES)
    rules = (
        (lines == 0, "unknown", 0.0),
        ((tables >= 1) & (cells >= 20), "student_records_index", 0.95),
        ((signatures >= 1) & (keys >= 3) & lines.between(20, 40), "roll_separator", 0.90),
        ((keys >= 10) & (lines >= 80), "student_cover", 0.85),
        (hits(upper, INDEX_PHRASES) > 0, "student_records_index", 0.85),
        (hits(upper, CERTIFICATE_PHRASES) > 0, "roll_separator", 0.85),
        ((lines < 25) & (tables == 0) & (signatures == 0), "roll_separator", 0.80),
        (hits(upper, TEST_PHRASES) > 0, "student_test_sheet", 0.75),
        ((cover >= 3) | ((cover >= 2) & (lines >= 80)), "student_cover", 0.80),
        (lines.between(25, 80) & (cover < 2), "roll_leader", 0.65),
        ((lines >= 80) & (cover < 2), "student_continuation", 0.60),
        (F.lit(True), "unknown", 0.30),
    )
    # The number of the first rule that holds, then its row of the table: the chain of conditions holds no structs.
    number = F.when(rules[0][0], 1)
    for k, (when, _, _) in enumerate(rules[1:], 2):
        number = number.when(when, k)
    table = F.array(*(F.struct(F.lit(name).alias("page_class"), F.lit(confidence).alias("confidence")) for _, name, confidence in rules))
    return F.element_at(table, number)


def best_by(rows: DataFrame, keys: list[str], value: Column, score: list[Column]) -> DataFrame:
    """The value of the row that sorts first by score."""
    w = Window.partitionBy(*keys).orderBy(*score)
    return rows.withColumn("best", value).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*keys, "best")


def grid(cells: DataFrame, table: list[str], row: str, col: str, text: str, order: str, columns: list[int]) -> DataFrame:
    """One line per row, a column per cell; of duplicate cells the last one counts."""
    return cells.groupBy(*table, row).pivot(col, columns).agg(F.max_by(text, F.struct(order, text)))


def header_row(cells: DataFrame, table: list[str], row: str, text: str) -> DataFrame:
    """The first of rows 1 to 3 with at least three cells that aren't blank, else 1."""
    filled = cells.where(F.col(row).between(1, 3) & ~blank(F.col(text))).groupBy(*table, row).agg(F.count("*").alias("n")).where("n >= 3")
    heads = filled.groupBy(*table).agg(F.min(row).alias("header_row"))
    return cells.select(*table).distinct().join(heads, table, "left").withColumn("header_row", F.coalesce("header_row", F.lit(1)))


def header_columns(cells: DataFrame, headers: DataFrame, table: list[str], row: str, col: str, text: str) -> DataFrame:
    """(table, field, col): a header cell claims the first field whose hint it holds; a field goes to its first column."""
    own = cells.join(headers, table).where(F.col(row) == F.col("header_row"))
    field = None
    for name, marks in HINTS:
        found = F.lit(False)
        for m in marks:
            found = found | F.contains(F.upper(text), F.lit(m))
        field = F.when(found, name) if field is None else field.when(found, name)
    return own.withColumn("field", field).where("field is not null").groupBy(*table, "field").agg(F.min(col).alias("col"))


def grid_rows(cells: DataFrame, headers: DataFrame, fields: DataFrame, table: list[str], row: str, col: str, text: str, order: str) -> DataFrame:
    """Rows below the header as records; absent fields are '', rows without any name go, tables without both name columns give none."""
    named = fields.groupBy(*table).agg(F.count_if(F.col("field").isin("last", "first")).alias("n")).where("n = 2").select(*table)
    own = cells.join(headers, table).where(F.col(row) > F.col("header_row")).join(fields.withColumnRenamed("col", col), [*table, col]).join(named, table)
    pick = [F.coalesce(F.max_by(F.when(F.col("field") == f, F.trim(text)), F.when(F.col("field") == f, F.struct(order, text))), F.lit("")).alias(f) for f, _ in HINTS]
    return own.groupBy(*table, row).agg(*pick).where("last <> '' or first <> ''")


def nearest_word(words: DataFrame, page: str, anchors: DataFrame, direction: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Words (page, id, text, top, left, width, height), anchors (page, a_id, a_top, a_left, a_width, a_height): the word nearest to the anchor that
    is no skipped word. skip: the words to leave out; without any, LABEL_WORDS."""
    skip = skip or LABEL_WORDS
    if direction not in ("right", "below"):
        raise ValueError(f"unknown direction {direction}")
    both = words.join(anchors, page).where((F.col("id") != F.col("a_id")) & ~blank(F.col("text")) & ~F.upper("text").isin(*skip, ""))
    if direction == "right":
        both = both.where(F.abs(F.col("top") - F.col("a_top")) <= F.col("a_height")).withColumn("gap", F.col("left") - (F.col("a_left") + F.col("a_width"))).where(F.col("gap").between(-0.005, 0.30))
    else:
        both = both.where(F.abs(F.col("left") - F.col("a_left")) <= F.col("a_width")).withColumn("gap", F.col("top") - (F.col("a_top") + F.col("a_height"))).where(F.col("gap").between(-0.005, 0.05))
    return both.groupBy(page).agg(F.min(F.struct("gap", "id", "text")).alias("n")).select(page, F.col("n.id").alias("id"), F.col("n.text").alias("text"), F.col("n.gap").alias("gap"))
