import json
import random

import pytest
from pyspark.sql import functions as F

from rollweave.functions import scalars as s
from rollweave.operators import blocks, enrich, evaluate, packets, report, snap
from rollweave.sources import records


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expr.alias("x")).first()["x"]


def many(spark, cases, expr):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(cases)], "k int, v string")
    return [r["x"] for r in rows.select("k", expr(F.col("v")).alias("x")).orderBy("k").collect()]


def test_names(spark):
    assert many(spark, [" 'SMITH, JOHN, ", "Doe with", "Doe COUNTY (LAST)", "", None], s.clean_name) == ["SMITH, JOHN", "Doe", "Doe COUNTY", "", ""]
    assert many(spark, ["SMITH JOHN", "Al", "PLACE OF BIRTH", "Mr. Smith", "J0HN SMITH", "O'Neil Ann-Marie", None], s.valid_name) == [True, False, False, False, False, True, False]
    assert one(spark, s.valid_name(F.col("v"), ("SPRINGFIELD",)), v="SPRINGFIELD HIGH") is False
    assert many(spark, ["3/4/75", "13/1/75", "2/31/1990", "5-6-05", "1.1.1", "1/2/1899", "x"], s.valid_dob) == [True, False, True, True, False, False, False]
    assert many(spark, ["Müller,  JOSÉ ", ""], s.folded) == ["muller, jose", ""]
    assert many(spark, ["00011", "x", None], s.frame_number) == [11, 0, 0]
    assert many(spark, ["/a/b/x00123_2.tif", "/a/b/cover.tif"], s.frame_of) == ["00123", "cover"]
    assert many(spark, ["Mr. Doe", "w. Doe", "Doe"], s.strip_title) == ["doe", "doe", "doe"]
    assert json.loads(many(spark, ['ok ```json {"a": {"b": 1}} ```'], s.reply_json)[0]) == {"a": {"b": 1}}
    assert many(spark, ["no"], s.reply_json) == [None]


@pytest.mark.parametrize(
    ("name", "roll", "want"),
    [
        ("SMITH, JOHN A.pdf", "", ("SMITH", "JOHN", "A", None)),
        ("Smith, John Anthony.pdf", "", ("SMITH", "JOHN", "ANTHONY", None)),
        ("(LAST) Doe Jane.pdf", "", (None, None, None, "placeholder")),
        ("DOE COUNTY, JANE.pdf", "", (None, None, None, "ocr_garbage")),
        ("1959.pdf", "", (None, None, None, "numeric_only")),
        ("Smith.pdf", "", (None, None, None, "too_short")),
        ("DOE, JANE_1.pdf", "", ("DOE", "JANE", "", None)),
        ("611 X, Y.pdf", "", (" X", "Y", "", None)),
        ("SMITH, JOHN.pdf", "ROLL 003", (None, None, None, "sham_merge")),
    ],
)
def test_clean_gt(spark, name, roll, want):
    assert tuple(one(spark, s.clean_gt(F.col("n"), F.col("r")), n=name, r=roll)) == want


def roll_of(spark, rows):
    return spark.createDataFrame([("R", *r) for r in rows], "roll string, last string, first string, frame long")


def test_packet_snap(spark):
    index = snap.roll_index(roll_of(spark, [("SMITH", "", 1), ("SMITH", "JOHN", 2), ("SMYTH", "JOHN", 3), ("ABCDE", "JOHN", 4), ("smith", " john", 5), ("", "", 6)]), "roll", "last", "first", "frame")
    assert index.count() == 4
    pages = roll_of(spark, [("Smith", "John", 1), ("SNITH", "JOHN", 2), ("GRAMT", "ALAN", 3), ("XYZDE", "JOHN", 4)])
    got = {r["frame"]: r["snap"] and (r["snap"]["ilast"], r["snap"]["ifirst"], r["snap"]["dist"]) for r in snap.nearest(pages, index, "roll", "last", "first").collect()}
    assert got == {1: ("SMITH", "JOHN", 0), 2: ("SMITH", "JOHN", 1), 3: None, 4: None}
    swapped = snap.nearest(roll_of(spark, [("JOHN", "SMITH", 1)]), index, "roll", "last", "first", caps=(3, 3, 4), swap=True).first()["snap"]
    assert (swapped["ilast"], swapped["swapped"], swapped["dist"]) == ("SMITH", True, 0)
    alone = snap.nearest(roll_of(spark, [("SMITH", "", 1)]), index, "roll", "last", "first", first_optional=True).first()["snap"]
    assert alone["dist"] == 0
    none = snap.nearest(pages, index.limit(0), "roll", "last", "first")
    assert none.where("snap is not null").count() == 0


def test_mini_roll(spark):
    rows = [("00001", "roll_leader", "", "", ""), ("00005", "roll_separator", "START", "", ""), ("00006", "student_cover", "", "SMITH", "JOHN"), ("00007", "student_continuation", "", "SMITH", "JOHN"), ("00008", "student_test_sheet", "", "JONES", "MARY"), ("00009", "student_cover", "", "JONES", "MARY"), ("01924", "roll_separator", "END", "", "")]
    pages = spark.createDataFrame([("R", *r) for r in rows], "roll string, frame string, page_class string, marker string, last string, first string")
    own = packets.bracket(pages, "roll", "frame", F.col("marker") == "START", F.col("marker") == "END").where(F.col("page_class").isin(*records.STUDENT_CLASSES))
    own = packets.islands(own, "roll", "frame", F.when(s.has_name(F.col("last"), F.col("first")), s.coarse_key(F.col("last"), F.col("first"))))
    got = packets.rollup(own.withColumn("c", F.lit(0.9)), ["roll", "island"], "frame", "c", 0.7).orderBy("island").collect()
    assert [(r["frames"], r["flagged"]) for r in got] == [(["00006", "00007"], False), (["00008", "00009"], False)]
    best = packets.majority(own, ["roll", "island"], "last", "frame").orderBy("island").collect()
    assert [r["majority"] for r in best] == ["SMITH", "JONES"]


def test_merge_to_fixpoint(spark):
    rows = [(1, 1, "SMITH", "JOHN"), (2, 1, "SMITH", "JOHN"), (3, 2, "SMYTH", "JOHN"), (4, 3, "SMITH", "JON"), (20, 4, "SMITH", "JOHN"), (21, 5, "JONES", "MARY")]
    pages = spark.createDataFrame([("R", *r) for r in rows], "roll string, frame long, island long, last string, first string")
    got = packets.merge_to_fixpoint(pages, "roll", "frame", "last", "first").orderBy("packet_no").collect()
    assert [(r["last"], r["begin"], r["end"], r["pages"]) for r in got] == [("SMITH", 1, 4, 4), ("SMITH", 20, 20, 1), ("JONES", 21, 21, 1)]


def test_merge_by_snapped_names(spark):
    """SMXXH JOHN and SMITHER JOHN are 4 edits apart, and both snap to the entry SMITH JOHN; the merged packet's majority snaps again."""
    rows = [(1, 1, "smxxh ", "John", 0.9), (2, 1, "", "", 0.5), (3, 2, "SMITHER", "JOHN", 0.8), (4, 2, "SMITHER", "JOHN", 1.0), (5, 3, "JONES", "MARY", 0.9), (6, 4, "QUUX", "ANN", 0.9), (7, 5, "DOE", "", 0.6)]
    pages = spark.createDataFrame([("R", *r) for r in rows], "roll string, frame long, island long, last string, first string, conf double")
    index = spark.createDataFrame([("R", "SMITH", "JOHN", 1), ("R", "JONES", "MARY", 2)], "roll string, ilast string, ifirst string, pos long")
    out = packets.merge_to_fixpoint(pages, "roll", "frame", "last", "first", index=index, confidence="conf")
    got = [tuple(r) for r in out.select("packet_no", "last", "first", "begin", "end", "pages", F.round("avg_confidence", 6), "flagged", "last_raw", "snap_applied", "snap_distance").orderBy("packet_no").collect()]
    assert got == [
        (1, "SMITH", "JOHN", 1, 4, 4, 0.8, True, "SMITHER", True, 2),
        (2, "JONES", "MARY", 5, 5, 1, 0.9, False, "JONES", False, 0),
        (3, "QUUX", "ANN", 6, 6, 1, 0.9, False, "QUUX", False, None),
        (4, "DOE", "", 7, 7, 1, 0.6, True, "DOE", False, None),
    ]
    assert packets.merge_to_fixpoint(pages, "roll", "frame", "last", "first").count() == 5


def test_merge_is_a_fixpoint_or_five_passes():
    draw = random.Random(1)
    for _ in range(200):
        at, own = 0, []
        for _ in range(draw.randrange(8)):
            at += draw.randrange(1, 5)
            name = (draw.choice(["SMITH", "SMYTH", "SMITT", "JONES", ""]), draw.choice(["JO", "JOE", "AL"]))
            own.append({"begin": at, "end": at, "names": [(*name, "")] if any(name) else [], "last": name[0], "first": name[1], "middle": "", "pages": [at], "confs": [], "flagged": False})
        out = packets.fold_packets(own)
        assert sum(len(p["pages"]) for p in out) == len(own)
        assert len(packets.fold_packets(out, 1)) == len(out) or len(packets.fold_packets(own, 4)) != len(out)


def match_plainly(packets_, truth, most=3):
    """The greedy match as a plain double loop."""
    used, out = set(), []
    for last, first, middle in packets_:
        best, grade = None, "none"
        for k, (a, b, c) in enumerate(truth):
            if k not in used and (a, b) == (last, first):
                best, grade = k, "exact" if c == middle or not c or not middle else "partial"
                if grade == "exact":
                    break
        if best is None:
            cap = lambda x: most + (len(x) >= 7)
            best = next((k for k, (a, b, _) in enumerate(truth) if k not in used and packets.edit_distance(a, last) <= cap(a) and packets.edit_distance(b, first) <= cap(b)), None)
            grade = "none" if best is None else "partial"
        if best is not None:
            used.add(best)
        out.append((best, grade))
    return out


def test_greedy_match(spark):
    names = [("SMITH", "JOHN", ""), ("SMITH", "JOHN", "B"), ("GRANDERSON", "AL", ""), ("NOBODY", "X", "")]
    truth = [("SMITH", "JOHN", "A"), ("SMITH", "JOHN", "B"), ("GRENDIRSEN", "AL", "")]
    assert match_plainly(names, truth) == [(0, "exact"), (1, "exact"), (2, "partial"), (None, "none")]
    p = spark.createDataFrame([("R", k, *n) for k, n in enumerate(names)], "roll string, packet_pos long, last string, first string, middle string")
    g = spark.createDataFrame([("R", k, *n) for k, n in enumerate(truth)], "roll string, gt_pos long, last string, first string, middle string")
    got = evaluate.greedy_match(p, g, "roll").orderBy("packet_pos").collect()
    assert [(r["gt_pos"], r["grade"]) for r in got] == [(0, "exact"), (1, "exact"), (2, "partial"), (None, "none")]
    assert evaluate.greedy_match(p, g.limit(0), "roll").where("grade = 'none'").count() == 4


def test_greedy_match_is_the_plain_one(spark):
    """Many small rolls with few letters, so that all tiers and ties come up; each truth is used once at most."""
    draw = random.Random(2)
    pick = lambda n: [tuple("".join(draw.choice("AB") for _ in range(draw.randrange(1, 10))) for _ in range(2)) + (draw.choice(["", "A", "B"]),) for _ in range(n)]
    rolls = [(f"R{k}", pick(draw.randrange(9)), pick(draw.randrange(7))) for k in range(120)]
    table = lambda at, pos: spark.createDataFrame([(r[0], k, *n) for r in rolls for k, n in enumerate(r[at])], f"roll string, {pos} long, last string, first string, middle string")
    got = {}
    for r in evaluate.greedy_match(table(1, "packet_pos"), table(2, "gt_pos"), "roll").orderBy("roll", "packet_pos").collect():
        got.setdefault(r["roll"], []).append((r["gt_pos"], r["grade"]))
    assert got == {r: match_plainly(p, t) for r, p, t in rolls if p}
    assert all(len({k for k, _ in x if k is not None}) == sum(k is not None for k, _ in x) for x in got.values())


def test_blocks(spark, tmp_path):
    block = lambda i, kind, **more: {"Id": i, "BlockType": kind, **more}
    cells = [("LAST NAME", 1, 1), ("FIRST", 1, 2), ("DOB", 1, 3), ("Doe", 2, 1), ("Jane", 2, 2), ("1/2/60", 2, 3), ("", 3, 1), ("", 3, 2)]
    data = [block("t", "TABLE", Relationships=[{"Type": "CHILD", "Ids": [f"c{k}" for k in range(len(cells))]}])]
    for k, (text, r, c) in enumerate(cells):
        words = text.split()
        data.append(block(f"c{k}", "CELL", RowIndex=r, ColumnIndex=c, Relationships=[{"Type": "CHILD", "Ids": [f"w{k}_{j}" for j in range(len(words))] + ["missing"]}]))
        data += [block(f"w{k}_{j}", "WORD", Text=w) for j, w in enumerate(words)]
    (tmp_path / "d1__tables.json").write_text(json.dumps({"Blocks": data}))
    own = records.read_blocks(spark, str(tmp_path)).cache()
    assert {r["label"] for r in own.select("label").distinct().collect()} == {"d1"}
    links = blocks.edges(own, "label").where("type = 'CHILD'")
    words = links.join(own.where("BlockType = 'WORD'").select("label", F.col("Id").alias("child"), F.col("Text").alias("w")), ["label", "child"])
    parents = own.where("BlockType = 'CELL'").select("label", F.col("Id").alias("parent"), F.col("RowIndex").alias("r"), F.col("ColumnIndex").alias("c"), "block_pos")
    text = blocks.child_text(parents, words, ["label", "parent"], "ord", "w").withColumnRenamed("child_text", "text")
    heads = blocks.header_row(text, ["label"], "r", "text")
    fields = blocks.header_columns(text, heads, ["label"], "r", "c", "text")
    got = blocks.grid_rows(text, heads, fields, ["label"], "r", "c", "text", "block_pos").collect()
    assert [(r["r"], r["last"], r["first"], r["middle"], r["dob"]) for r in got] == [(2, "Doe", "Jane", "", "1/2/60")]


def test_layout_class(spark):
    rows = [("", 0, 0, 0, 0, 0), ("", 30, 1, 25, 0, 0), ("", 30, 0, 0, 4, 1), ("", 90, 0, 0, 12, 0), ("STUDENT RECORDS INDEX", 30, 0, 0, 0, 0), ("X", 5, 0, 0, 0, 0), ("STANFORD ACHIEVEMENT TEST", 30, 0, 0, 0, 0), ("MOTHER FATHER GUARDIAN", 30, 0, 0, 0, 0), ("X", 40, 0, 0, 0, 0), ("X", 90, 0, 0, 0, 0)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, u string, a int, b int, c int, d int, e int")
    got = [r["x"]["page_class"] for r in df.select("k", blocks.layout_class(*map(F.col, "uabcde")).alias("x")).orderBy("k").collect()]
    assert got == ["unknown", "student_records_index", "roll_separator", "student_cover", "student_records_index", "roll_separator", "student_test_sheet", "student_cover", "roll_leader", "student_continuation"]


def test_vote_and_scorecard(spark):
    rows = [(1, "a", "Ann", 80.0, 0), (1, "a", "ANN", 90.0, 1), (1, "b", "Bob", 99.0, 2), (2, "c", "Cy", 100.0, 0)]
    got = report.vote(spark.createDataFrame(rows, "page int, form string, name string, conf double, pos int"), ["page"], "form", "name", "conf", "pos").orderBy("page").collect()
    assert [(r["name"], r["confidence"], r["agreement"], r["sources"]) for r in got] == [("ANN", 0.84, 2, [0, 1]), ("Cy", 0.6, 1, [0])]
    own = spark.createDataFrame([(1, "student_cover", 0.9, 0.1), (1, "student_cover", None, None), (2, None, 0.9, 0.1), (2, "odd", 0.1, 0.1)], "district int, page_class string, conf double, usd double")
    card = {r["district"]: r for r in report.scorecard(own, "district", F.col("page_class"), F.col("conf"), F.col("usd")).collect()}
    assert (card[None]["total"], card[None]["n_covers"], card[None]["shipped"], card[None]["n_unknown"], card[1]["ship_rate"], card[2]["ship_rate"]) == (4, 2, 1, 1, 0.5, 0.0)


def test_budget_samples_and_resume(spark):
    rows = spark.createDataFrame([(1, k, 3) for k in range(10)], "run int, seq int, cost int")
    assert [r["seq"] for r in report.within_budget(rows, ["run"], "seq", "cost", 7).orderBy("seq").collect()] == [0, 1, 2]
    assert [r["seq"] for r in report.first_and_last(rows, ["run"], "seq", 2, 1).orderBy("seq").collect()] == [0, 1, 9]
    done = spark.createDataFrame([(1, None), (2, "x")], "seq int, error string")
    assert report.not_done(rows, done, ["seq"], F.col("error").isNotNull()).count() == 9
    assert report.cascade(rows, F.col("seq") < 3, lambda d: d.withColumn("x", F.lit(1)), lambda d: d.withColumn("x", F.lit(0))).where("x = 1").count() == 3


class Client:
    def extract(self, row):
        if row["seq"] == 3:
            raise ValueError("bad " * 100)
        return {"answer": f"a{row['seq']}"}


def test_enrich(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = spark.createDataFrame([(k,) for k in range(5)], "seq int")
    good, bad = enrich.quarantine(enrich.enrich(rows, Client, "answer string").cache())
    assert good.count() == 4 and len(bad.first()["error"]) == 200
    assert enrich.replay(rows, rows.limit(0).withColumn("answer", F.lit("")), ["seq"]).where("error = 'missing'").count() == 5
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise enrich.Retryable
        return "ok"

    assert enrich.with_retry(flaky, sleep=lambda _: None) == "ok" and len(calls) == 3


def test_readers(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"frame":"00001","roll_id":"R","page_class":"unknown","student":{"last":"A"}}\n')
    page = records.read_pages(spark, str(tmp_path / "p.json")).first()
    assert page["student"]["first"] == "" and page["page_class"] == "unknown"
    (tmp_path / "c.json").write_text('{"page_id":"a"}\nnot json\n\n{"page_id":"b","error":"x"}\n')
    assert records.read_checkpoint(spark, str(tmp_path / "c.json")).count() == 2
    folder = tmp_path / "d1r002"
    folder.mkdir()
    (folder / "00007.tif").write_bytes(b"x")
    (folder / "other.tif").write_bytes(b"x")
    got = records.manifest_of(records.list_files(spark, str(tmp_path), "*.tif")).collect()
    assert [(r["label"], r["district"], r["roll"], r["frame"]) for r in got] == [("d1r002_00007", 1, "002", "00007")]


def test_streamed_progress(spark, tmp_path):
    from rollweave.streaming import rolls

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"frame":"1","roll_id":"R","page_class":"student_cover","usd_cost":0.5}\n{"frame":"2","roll_id":"R","page_class":"roll_separator","separator":{"marker":"END"}}\n')
    out = rolls.roll_progress(rolls.page_stream(spark, str(tmp_path / "in")))
    run = out.writeStream.outputMode("complete").format("memory").queryName("progress").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    row = spark.table("progress").first()
    assert (row["pages"], row["covers"], row["ended"]) == (2, 1, True)


def test_entry_without_the_training_data_part():
    import subprocess
    import sys

    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0
