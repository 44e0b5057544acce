"""Scalar functions over columns: names, dates, codecs, costs (F1-F21, P2, P3, P5, P10, P11, M2, X12). Missing text is '', never null."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Words that make a name unusable, parent marks, noise suffixes, in their order. Two locality words of the same list are left to the caller (``places``).
_GARBAGE = (
    "BIRTH BIRTHDATE BIRTHPLACE BRITHDATE BRITHPLACE PLACE DATE AGE COUNTY STATE CITY SEX RACE GRADE GRADES NAME LAST FIRST MIDDLE RECORD RECORDS "
    "STUDENT PUPIL TEACHER COUNSELOR PARENT GUARDIAN ADDRESS PHONE OCCUPATION SCHOOL DISTRICT ROLL NUMBER REEL REDUCTION CERTIFICATE AUTHENTICITY "
    "DEPARTMENT PHOTOGRAPH COMMENTS OBSERVATIONS SUGGESTIONS SECONDARY ELEMENTARY WITHDREW WITHDRAWN WITHDRAWAL ENROLLED ENROLLMENT ENTRANCE TRANSFER "
    "TRANSFERRED GRADUATED DECEASED BEGAN ENDED RETURNED PROMOTED RETAINED LOST DISEASE ILLNESS ABSENT PRESENT ATTENDANCE ABSENCE ABSENCES PERMITS "
    "PERMIT AUTHORIZATION BIRTHDAY"
)
GARBAGE_TOKENS = tuple(_GARBAGE.split())
PARENT_PREFIXES = ("MR.", "MRS.", "MS.", "DR.", "MOTHER", "FATHER", "GUARDIAN", "PARENT", "STEPFATHER", "STEPMOTHER")
NOISE_SUFFIXES = (" with", " COUNTY", " (LAST)", " (FIRST)", " (MIDDLE)")
NAME_PATTERN = r"^[A-Za-z][A-Za-z'\-\. ,]{1,60}[A-Za-z\.]$"
DOB_PATTERN = r"^\s*(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{2}|\d{4})\s*$"
GT_GARBAGE = ("BIRTH", "COUNTY", "SEX", "PLACE", "CITY", "NAME", "LAST", "FIRST", "MIDDLE", "RECORD")
PRICES = {"detect": 0.0015, "forms": 0.05, "tables": 0.015, "layout": 0.004, "queries": 0.015, "signatures": 0.004}


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def bind(c: Column, use) -> Column:
    """``use`` of the column's value, which is worked out once: a plain column that is used twice stands in the plan twice, and grows with every use on top."""
    return F.element_at(F.transform(F.array(c), use), 1)


def strip(c: Column) -> Column:
    """Trims all white space, not only blanks."""
    return F.regexp_replace(text(c), r"^\s+|\s+$", "")


def norm(c: Column) -> Column:
    """F1."""
    return F.upper(strip(c))


def blank(c: Column) -> Column:
    return strip(c) == ""


def has_name(last: Column, first: Column) -> Column:
    """P5."""
    return ~blank(last) | ~blank(first)


def coarse_key(last: Column, first: Column) -> Column:
    """F8."""
    return F.concat(norm(last), F.lit("|"), F.left(norm(first), F.lit(3)))


def clean_name(c: Column) -> Column:
    """trim, leading quotes, trailing commas, then each noise suffix once, in order."""
    out = F.regexp_replace(F.regexp_replace(strip(c), "^['`\"]+", ""), r"[,\s]+$", "")
    for noise in NOISE_SUFFIXES:
        out = F.regexp_replace(out, r"\s*\Q" + noise + r"\E\z", "")
    return strip(out)


def valid_name(c: Column, places: tuple[str, ...] = ()) -> Column:
    """the name pattern (so at least 3 characters), no unusable word, no parent mark in front. One expression, so that the cleaned name is worked out once."""
    parents = "|".join(re.escape(p) for p in PARENT_PREFIXES)
    garbage = "|".join((*GARBAGE_TOKENS, *map(re.escape, places)))
    return F.rlike(clean_name(c), F.lit(rf"(?s)^(?!(?i:{parents}))(?!.*(?<![A-Za-z])(?i:{garbage})(?![A-Za-z])){NAME_PATTERN.removeprefix('^')}"))


def valid_dob(c: Column) -> Column:
    """month 1-12, day 1-31, two-digit years from 30 on are 19xx, year 1900-2010, not all three alike."""
    part = lambda k: F.regexp_extract(text(c), DOB_PATTERN, k)
    m, d, y = (F.try_to_number(part(k), F.lit("9999")).cast("int") for k in (1, 2, 3))
    year = F.when(F.length(part(3)) == 2, F.when(y >= 30, y + 1900).otherwise(y + 2000)).otherwise(y)
    ok = m.between(1, 12) & d.between(1, 31) & year.between(1900, 2010) & ~((m == d) & (d == y))
    return F.coalesce(ok, F.lit(False))


def strip_digits(c: Column) -> Column:
    """leading digits only; what follows isn't trimmed again."""
    return F.regexp_replace(c, r"^\d+", "")


def clean_gt(name: Column, roll: Column, sham_rolls: tuple[str, ...] = ("ROLL 003", "ROLL 005", "ROLL 006"), whole_words: bool = False) -> Column:
    """struct(last, first, middle, drop_reason) of a ground-truth file name; the tests run in this order.

    whole_words: unusable words count as words only, so that a surname that holds one stays."""
    garbage = "|".join(GT_GARBAGE)
    garbage = rf"(?<![A-Z])(?:{garbage})(?![A-Z])" if whole_words else garbage
    sham = norm(roll).isin(*sham_rolls)

    def split(base: Column) -> Column:
        comma = F.contains(base, F.lit(","))
        words = F.split(F.when(comma, strip(F.regexp_extract(base, r"(?s)^[^,]*,(.*)$", 1))).otherwise(base), r"\s+")
        return F.struct(F.when(comma, strip(F.regexp_extract(base, r"^([^,]*),", 1))).alias("last"), words.alias("words"))

    def parts(x: Column) -> Column:
        word = lambda k: text(F.try_element_at(x["words"], F.lit(k)))
        rest = lambda k: F.array_join(F.slice(x["words"], k, F.size(x["words"])), " ")
        comma = x["last"].isNotNull()
        return F.struct(F.when(comma, x["last"]).otherwise(word(1)).alias("last"), F.when(comma, word(1)).otherwise(word(2)).alias("first"), F.when(comma, rest(2)).otherwise(rest(3)).alias("middle"))

    def judged(stem: Column, x: Column) -> Column:
        reason = (
            F.when(sham, "sham_merge")
            .when(F.rlike(stem, F.lit(r"(?i)\((?:LAST|FIRST|MIDDLE)\)")), "placeholder")
            .when(F.rlike(F.upper(stem), F.lit(garbage)), "ocr_garbage")
            .when(F.rlike(x["last"], F.lit(r"^\d+$")), "numeric_only")
            .when(blank(strip_digits(x["last"])) | blank(strip_digits(x["first"])), "too_short")
        )
        return F.struct(x.alias("x"), reason.alias("drop_reason"))

    def kept(y: Column) -> Column:
        keep = lambda c: F.when(y["drop_reason"].isNull(), F.upper(c))
        return F.struct(keep(strip_digits(y["x"]["last"])).alias("last"), keep(strip_digits(y["x"]["first"])).alias("first"), keep(y["x"]["middle"]).alias("middle"), y["drop_reason"].alias("drop_reason"))

    stem = strip(F.regexp_replace(name, r"(?i)\.pdf$", ""))
    found = bind(stem, lambda st: bind(strip(F.regexp_replace(st, r"_\d+$", "")), lambda b: bind(split(b), lambda w: bind(parts(w), lambda x: judged(st, x)))))
    return bind(found, kept)


@F.pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """lower case without accents, single blanks, no blanks or commas at the ends. Spark has no decomposition to build it from."""

    def one(x: str) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", (x or "").lower()) if not unicodedata.combining(c))
        return " ".join(plain.split()).strip(" ,")

    return s.map(one)


def frame_number(c: Column) -> Column:
    """F10."""
    return F.coalesce(c.try_cast("int"), F.lit(0))


def frame_order(c: Column) -> Column:
    """By what frames are sorted: their names, with the number in front padded, so that a film that outgrows the width of its names keeps its order."""
    number = F.regexp_extract(c, r"^[0-9]*", 0)
    padded = F.concat(F.lpad(number, F.greatest(F.length(number), F.lit(18)), F.lit("0")), F.substr(c, F.length(number) + 1))
    return F.struct(F.when(number == "", c).otherwise(padded).alias("key"), c.alias("frame"))


def strip_title(c: Column) -> Column:
    """F11."""
    return F.regexp_replace(F.lower(text(c)), r"^([a-z]\.\s+|w\.\s+|mr\.\s+|mrs\.\s+)", "")


def either_contains(a: Column, b: Column) -> Column:
    """blanks never match."""
    a, b = F.lower(strip(a)), F.lower(strip(b))
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def reply_json(c: Column) -> Column:
    """the outermost braces of a free-text reply, null without any."""
    return F.nullif(F.regexp_extract(text(c), r"(?s)\{.*\}", 0), F.lit(""))


def scaled_cap(c: Column, most: int, long_from: int = 7) -> Column:
    """F20."""
    return F.lit(most) + F.when(F.length(c) >= long_from, 1).otherwise(0)


def frame_of(path: Column) -> Column:
    """The first five digits of the file's stem, else the stem."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"(\d{5})", 1), F.lit("")), stem)


def index_rows(rows: Column, frame: Column) -> Column:
    """Trimmed index rows with their frame, those without any name dropped."""
    own = F.transform(F.coalesce(rows, F.array()), lambda r: F.struct(*(strip(r[c]).alias(c) for c in ("last", "first", "middle", "dob")), frame.alias("source_frame")))
    return F.filter(own, lambda r: (r["last"] != "") | (r["first"] != ""))


def district_of(district: Column, label: Column, default: int | None = None) -> Column:
    """P10: the column, else the label's d<N>, else the default, else an error."""
    found = F.regexp_extract(text(label), r"d(\d+)", 1)
    other = F.lit(default) if default is not None else F.raise_error(F.concat(F.lit("no district in "), text(label))).cast("int")
    return F.coalesce(district.cast("int"), F.when(found != "", found.cast("int")).otherwise(other))


def page_id(district: Column, roll: Column, frame: Column) -> Column:
    """P11."""
    return F.concat_ws("_", F.concat(F.lit("d"), district), F.concat(F.lit("r"), roll), frame)


def slug(roll: Column) -> Column:
    return F.replace(F.lower(roll), F.lit(" "), F.lit(""))


def vote_confidence(n: Column, top: Column) -> Column:
    """M2: n agreeing members, the highest confidence (0 to 100) among them."""
    small, large = F.least(F.lit(0.10), top * 0.001), F.least(F.lit(0.20), top * 0.002)
    return F.round(F.when(n >= 3, 0.85 + small).when(n == 2, 0.75 + small).when(n == 1, 0.40 + large).otherwise(0.0), 3)


def price(feature: Column, pages: Column) -> Column:
    """An unknown feature is an error."""
    table = F.create_map(*(x for k, v in PRICES.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.try_element_at(table, feature), F.raise_error(F.concat(F.lit("unknown feature "), feature)).cast("double")) * pages


def token_cost(tokens_in: Column, tokens_out: Column, per_in: float = 1.0e-6, per_out: float = 5.0e-6) -> Column:
    return tokens_in * per_in + tokens_out * per_out


def ratio(a: Column, b: Column) -> Column:
    """0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
