"""The page jobs end to end, against plain loops, and every command."""

import json
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rollweave.__main__ import main
from rollweave.functions.scalars import frame_order
from rollweave.operators import enrich, evaluate, extract, packets
from rollweave.operators.packets import edit_distance
from rollweave.plans import jobs, page_queries
from rollweave.sources import records

STUDENT = ("student_cover", "student_test_sheet", "student_continuation")


def page(roll, k, kind="student_cover", last="", first="", middle="", marker=None, conf=0.9, rows=()):
    return {
        "frame": f"{k:05d}", "roll_id": roll, "page_class": kind, "separator": {"marker": marker}, "student": {"last": last, "first": first, "middle": middle}, "confidence_overall": 0.9, "confidence_name": conf,
        "index_rows": [{"last": a, "first": b, "middle": m, "dob": "", "source_frame": f"{k:05d}"} for a, b, m in rows], "model_version": "m", "processed_at": "", "latency_ms": 1, "tokens_in": 10, "tokens_out": 2, "usd_cost": 0.5,
    }


def some_rolls(n, seed):
    draw = random.Random(seed)
    names = [("SMITH", "JOHN"), ("SMYTH", "JOHN"), ("JONES", "MARY"), ("JONSON", "MARIA"), ("DOE", "JANE"), ("MARY", "JONES"), ("", "")]
    noisy = lambda x: x if draw.random() < 0.7 or not x else x[: draw.randrange(len(x))] + draw.choice("AXE") + x[draw.randrange(len(x)) :]
    out = []
    for r in range(n):
        at, own = 0, []
        for _ in range(draw.randrange(3, 30)):
            at += draw.choice([1, 1, 1, 2, 5])
            kind = draw.choice(["student_cover"] * 5 + ["student_test_sheet", "student_records_index", "unknown", "roll_separator"])
            last, first = draw.choice(names)
            rows = [(noisy(a), b, draw.choice(["", "M"])) for a, b in draw.sample(names, 3)] if kind == "student_records_index" and r % 4 else []
            own.append(page(f"ROLL {r:03d}", at, kind, noisy(last), noisy(first), draw.choice(["", "Q", "R"]), draw.choice(["START", "END", None]) if kind == "roll_separator" else None, draw.choice([0.5, 0.8, 1.0]), rows))
        out.append(own)
    return out


def write_pages(path, rolls):
    path.write_text("".join(json.dumps(p) + "\n" for r in rolls for p in r))
    return str(path)


# Plain loops


def plain_index(pages):
    seen, out = set(), []
    for p in pages:
        for r in p["index_rows"] if p["page_class"] == "student_records_index" else ():
            key = (r["last"].strip().upper(), r["first"].strip().upper(), r["dob"])
            if (key[0] or key[1]) and key not in seen:
                seen.add(key)
                out.append((key[0], key[1], r["middle"]))
    return out


def plain_nearest(last, first, index, caps, swap):
    best = None
    for pos, (a, b, m) in enumerate(index):
        if not b:
            continue
        for swapped, (x, y) in enumerate(((last, first), (first, last)) if swap else ((last, first),)):
            d, e = edit_distance(x, a), edit_distance(y, b)
            if d <= caps[0] and e <= caps[1] and d + e <= caps[2] and (best is None or (d + e, pos, swapped) < best[0]):
                best = ((d + e, pos, swapped), (a, b, m))
    return best and (*best[1], best[0][0])


def plain_majority(pages):
    named = [(p["student"]["last"].strip().upper(), p["student"]["first"].strip().upper(), p["student"]["middle"].strip().upper()) for p in pages]
    pairs = Counter((a, b) for a, b, _ in named if a or b)
    if not pairs:
        return "", "", ""
    top = max(pairs, key=pairs.get)
    middles = Counter(m for a, b, m in named if (a, b) == top and m)
    return (*top, max(middles, key=middles.get) if middles else "")


def plain_packet(pages, index, threshold=0.7, flagged=False):
    raw = plain_majority(pages)
    return {"pages": pages, "raw": raw, "flagged": flagged or any(p["confidence_name"] < threshold for p in pages)} | plain_snap(raw, index)


def plain_snap(raw, index):
    near = plain_nearest(raw[0], raw[1], index, (2, 2, 3), False)
    if not near:
        return {"name": raw, "applied": False, "distance": None}
    return {"name": (near[0], near[1], near[2].strip() and near[2] or raw[2]), "applied": near[:2] != raw[:2], "distance": near[3]}


def plain_window(pages):
    marks = [(k, p["separator"]["marker"]) for k, p in enumerate(pages) if p["page_class"] == "roll_separator"]
    a = next((k + 1 for k, m in marks if m == "START"), 0)
    b = next((k for k, m in reversed(marks) if m == "END"), len(pages))
    return [p for p in pages[a:b] if p["page_class"] in STUDENT]


def plain_boundary(pages, merge=True):
    index, made, key = plain_index(pages), [], None
    for p in plain_window(pages):
        last, first = p["student"]["last"].strip().upper(), p["student"]["first"].strip().upper()
        if not last and not first:
            if made:
                made[-1].append(p)
            continue
        now = f"{last}|{first[:3]}"
        if index:
            near = plain_nearest(last, first, index, (3, 3, 4), True)
            now = f"{near[0]}|{near[1]}" if near else f"{last}|{first}"
        if now != key:
            made.append([])
            key = now
        made[-1].append(p)
    made = [plain_packet(x, index) for x in made]
    number = lambda p, k: int(p["pages"][k]["frame"])
    for _ in range(5 if merge else 0):
        out = []
        for p in made:
            q = out[-1] if out else None
            if q and q["name"][0] and p["name"][0] and 0 <= number(p, 0) - number(q, -1) <= 3:
                d, e = edit_distance(q["name"][0], p["name"][0]), edit_distance(q["name"][1], p["name"][1])
                if d <= 2 and e <= 2 and d + e <= 3:
                    both = plain_packet(q["pages"] + p["pages"], [], flagged=q["flagged"] or p["flagged"])
                    out[-1] = both
                    continue
            out.append(p)
        same, made = len(out) == len(made), out
        if same:
            break
    return [p | plain_snap(p["raw"], index) for p in made]


def plain_by_index(pages, least, fallback):
    index = plain_index(pages)
    if not index:
        return []
    buckets, rest = {}, []
    for p in plain_window(pages):
        last, first = p["student"]["last"].strip().upper(), p["student"]["first"].strip().upper()
        near = plain_nearest(last, first, index, (3, 3, 4), True) if last or first else None
        if near:
            buckets.setdefault(near[:2], []).append((p, near[2]))
        else:
            rest.append(p)
    out, used = [], 0
    for no, (key, own) in enumerate(sorted(buckets.items(), key=lambda x: x[1][0][0]["frame"]), 1):
        if len(own) >= least:
            middles = Counter(m for _, m in own if m)
            out.append((no, *key, max(middles, key=middles.get) if middles else "", tuple(p["frame"] for p, _ in own)))
            used = no
    if fallback:
        groups, key = [], None
        for p in rest:
            last, first = p["student"]["last"].strip().upper(), p["student"]["first"].strip().upper()
            if last or first:
                if f"{last}|{first[:3]}" != key:
                    groups.append([])
                    key = f"{last}|{first[:3]}"
                groups[-1].append(p)
            elif groups:
                groups[-1].append(p)
        for own in groups:
            if len(own) >= fallback:
                used += 1
                out.append((used, *plain_majority(own), tuple(p["frame"] for p in own)))
    return out


@pytest.fixture(scope="module")
def rolls():
    return some_rolls(40, 11)


@pytest.fixture(scope="module")
def pages(spark, rolls, tmp_path_factory):
    return records.read_pages(spark, write_pages(tmp_path_factory.mktemp("rolls") / "pages.jsonl", rolls)).cache()


@pytest.mark.parametrize("merge", [True, False])
def test_boundary_mode_is_the_plain_loop(pages, rolls, merge):
    got = {}
    for r in jobs.group(pages, jobs.index_of(pages), jobs.Options(merge=merge)).orderBy("roll_id", "packet_no").collect():
        got.setdefault(r["roll_id"], []).append(((r["last"], r["first"], r["middle"]), (r["last_raw"], r["first_raw"], r["middle_raw"]), list(r["frames"]), r["flagged"], round(r["avg_confidence"], 6), r["snap_applied"], r["snap_distance"], r["packet_id"]))
    want = {}
    for own in rolls:
        roll = own[0]["roll_id"]
        for k, p in enumerate(plain_boundary(own, merge), 1):
            confs = [x["confidence_name"] for x in p["pages"]]
            want.setdefault(roll, []).append((p["name"], p["raw"], [x["frame"] for x in p["pages"]], p["flagged"], round(sum(confs) / len(confs), 6), p["applied"], p["distance"], f"{roll.lower().replace(' ', '')}_{k:03d}"))
    assert got == want


@pytest.mark.parametrize(("least", "fallback"), [(1, 0), (2, 1), (2, 2)])
def test_index_mode_is_the_plain_loop(pages, rolls, least, fallback):
    got = {}
    for r in jobs.group(pages, jobs.index_of(pages), jobs.Options(mode="index", min_bucket=least, fallback=fallback)).orderBy("roll_id", "packet_no").collect():
        got.setdefault(r["roll_id"], []).append((r["packet_no"], r["last"], r["first"], r["middle"], tuple(r["frames"])))
    assert got == {own[0]["roll_id"]: x for own in rolls if (x := plain_by_index(own, least, fallback))}


def grown(spark, tmp_path):
    """A roll whose frames outgrow the width of their names, given in another order."""
    own = [page("R", 8, "student_records_index", rows=[("DOE", "JANE", "")]), page("R", 12, "student_records_index", rows=[("ROE", "EVE", ""), ("DOE", "JANE", "")])]
    own += [page("R", k, last=a, first=b) for k, a, b in ((9, "DOE", "JANE"), (10, "ROE", "EVE"), (11, "ROE", "EVE"), (13, "DOE", "JANE"))]
    return records.read_pages(spark, write_pages(tmp_path / "grown.jsonl", [[{**p, "frame": p["frame"].lstrip("0")} for p in reversed(own)]]))


def test_index_of_frames_of_two_widths(spark, tmp_path):
    got = [(r["position"], r["last"], r["source_frame"]) for r in jobs.index_with_positions(jobs.index_of(grown(spark, tmp_path))).orderBy("position").collect()]
    assert got == [(1, "DOE", "8"), (2, "ROE", "12")]


@pytest.mark.parametrize(("mode", "want"), [("index", [("DOE", ["9", "13"]), ("ROE", ["10", "11"])]), ("boundary", [("DOE", ["9"]), ("ROE", ["10", "11"]), ("DOE", ["13"])])])
def test_packets_of_frames_of_two_widths(spark, tmp_path, mode, want):
    own = grown(spark, tmp_path)
    got = jobs.group(own, jobs.index_of(own), jobs.Options(mode=mode)).orderBy("packet_no").collect()
    assert [(r["last"], r["frames"]) for r in got] == want


def test_mean_confidence_is_exact(spark):
    """A mean that ends in 5 is rounded the same way in whatever order its pages come."""
    confs = [k % 50 / 50 for k in range(313)] + [0.98, 0.02, 0.06, 0.02, 0.02, 0.02, 0.02]
    rows = [(seed, k, c) for seed in range(20) for k, c in enumerate(random.Random(seed).sample(confs, len(confs)))]
    own = spark.createDataFrame([*rows, (99, 0, 1e300), (99, 1, 3e300)], "g int, k int, c double")
    want = Fraction(sum(round(c * 50) for c in confs), 50 * len(confs))
    assert want * 10**6 % 1 == Fraction(1, 2)
    got = {r["g"]: r["avg_confidence"] for r in packets.rollup(own, ["g"], "k", "c", 0.7).collect()}
    assert got.pop(99) == 2e300 and set(got.values()) == {float(want)}


def test_frames_of_one_width_are_sorted_as_names(spark):
    names = ["00012", "00012a", "00013", "a0001", "", "00002"]
    got = spark.createDataFrame([(n,) for n in names], "f string").orderBy(frame_order(F.col("f"))).collect()
    assert [r["f"] for r in got] == sorted(names)


def test_full_report(spark, tmp_path):
    """A roll with a known answer: a whole and a misread name, a nameless page, an unmatched packet and an unmatched truth."""
    rows = [page("ROLL 001", 1, "student_records_index", rows=[("Smith", "John", "Q"), ("Jones", "Mary", "")]), page("ROLL 001", 2, "roll_separator", marker="START")]
    rows += [page("ROLL 001", 3, last="Smyth", first="John"), page("ROLL 001", 4, "student_continuation"), page("ROLL 001", 5, last="Jones", first="Mary"), page("ROLL 001", 9, last="Quux", first="Ann", conf=0.1), page("ROLL 001", 20, "roll_separator", marker="END")]
    pages = records.read_pages(spark, write_pages(tmp_path / "p.jsonl", [rows]))
    files = spark.createDataFrame([("ROLL 001", n) for n in ("SMITH, JOHN Q.pdf", "Jones, Mary_2.pdf", "ABEL, ZOE.pdf", "(LAST) x.pdf", "77.pdf")], "roll_id string, name string")
    index, made, report = jobs.regroup(pages, files)
    assert [(r["position"], r["last"], r["source_frame"]) for r in jobs.index_with_positions(index).orderBy("position").collect()] == [(1, "Smith", "00001"), (2, "Jones", "00001")]
    assert [(r["last"], r["middle"], r["frames"], r["flagged"], r["snap_applied"]) for r in made.orderBy("packet_no").collect()] == [("SMITH", "Q", ["00003", "00004"], False, True), ("JONES", "", ["00005"], False, False), ("QUUX", "", ["00009"], True, False)]
    r = report.first().asDict()
    assert tuple(report.columns[1:]) == evaluate.REPORT
    assert (r["pages_total"], r["packets_predicted"], r["gt_rows_raw"], r["gt_rows_usable"], r["gt_rows_dropped_reasons"]) == (7, 3, 5, 3, {"placeholder": 1, "numeric_only": 1})
    assert (r["exact_matches_pre"], r["partial_matches_pre"], r["no_match_pre"], r["exact_matches_post"], r["no_match_post"]) == (1, 1, 1, 2, 1)
    assert (r["accuracy_partial_post"], r["packets_snapped"], r["index_rows_total"], r["usd_total"], r["tokens_in_total"]) == (2 / 3, 1, 2, 3.5, 70)
    assert (r["unmatched_predictions"], r["unmatched_ground_truth"]) == (["QUUX|ANN"], ["ABEL|ZOE"])
    none = jobs.regroup(pages.where("page_class = 'roll_separator'"), files.limit(0))[2].first()
    assert (none["packets_predicted"], none["accuracy_exact_post"], none["unmatched_ground_truth"]) == (0, 0.0, [])


class Vision:
    """Replies by frame; frame 3 fails, frame 4 breaks the contract."""

    def extract(self, row):
        k = int(row["frame"])
        if k == 3:
            raise ValueError("no light")
        reply = {"page_class": "odd" if k == 4 else "student_cover", "student": {"last": "Doe", "first": "Jane"}, "confidence_overall": 0.9, "confidence_name": 0.9}
        return {"reply": json.dumps(reply), "model_version": "m", "processed_at": "t", "latency_ms": 1, "tokens_in": 100, "tokens_out": 10}


class Ocr:
    def detect(self, page):
        return '{"Blocks": []}'

    def analyze(self, page, features, queries):
        return json.dumps({"features": features, "queries": queries})


def by_value():
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def blocks_of(name, boxes=True):
    block = lambda i, kind, **more: {"Id": i, "BlockType": kind, **more}
    rel = lambda kind, *ids: [{"Type": kind, "Ids": list(ids)}]
    box = lambda top, left: {"BoundingBox": {"Top": top, "Left": left, "Width": 0.05, "Height": 0.02}} if boxes else None
    return [
        block("k1", "KEY_VALUE_SET", EntityTypes=["KEY"], Confidence=99.0, Relationships=rel("CHILD", "w1", "w2") + rel("VALUE", "v1")), block("w1", "WORD", Text="MOTHER"), block("w2", "WORD", Text="NAME"),
        block("v1", "KEY_VALUE_SET", EntityTypes=["VALUE"], Relationships=rel("CHILD", "w3")), block("w3", "WORD", Text="Eve"),
        block("k2", "KEY_VALUE_SET", EntityTypes=["KEY"], Confidence=80.0, Relationships=rel("CHILD", "w2") + rel("VALUE", "v2")), block("v2", "KEY_VALUE_SET", Relationships=rel("CHILD", "w4")), block("w4", "WORD", Text=name),
        block("q1", "QUERY", Query={"Alias": "TOP_NAME", "Text": "?"}, Relationships=rel("ANSWER", "a1")), block("a1", "QUERY_RESULT", Text=f"{name},", Confidence=70.0),
        block("q2", "QUERY", Query={"Alias": "FULL_NAME", "Text": "?"}), block("l0", "LINE", Text="DATE OF BIRTH"), block("l1", "LINE", Text=f" {name} ", Confidence=60.0),
        block("x0", "WORD", Text="last", Geometry=box(0.1, 0.1)), block("x1", "WORD", Text="NAME", Geometry=box(0.1, 0.16)), block("x2", "WORD", Text="Roe", Geometry=box(0.105, 0.3)), block("x3", "WORD", Text="Far", Geometry=box(0.5, 0.16)),
    ]


def responses(folder):
    folder.mkdir()
    cells = [("Last", 1, 1), ("First", 1, 2), ("DOB", 1, 3), ("Smith", 2, 1), ("Ann", 2, 2), ("1/2/60", 2, 3)]
    table = [{"Id": "t", "BlockType": "TABLE", "Relationships": [{"Type": "CHILD", "Ids": [f"c{k}" for k in range(len(cells))]}]}]
    for k, (text, r, c) in enumerate(cells):
        table += [{"Id": f"c{k}", "BlockType": "CELL", "RowIndex": r, "ColumnIndex": c, "Relationships": [{"Type": "CHILD", "Ids": [f"cw{k}"]}]}, {"Id": f"cw{k}", "BlockType": "WORD", "Text": text}]
    for label, feature, own in (("d1r001_00001", "tables", table), ("d1r001_00002", "detect", blocks_of("Smyth")), ("d1r001_00003", "forms", blocks_of("Quux", False)), ("d2r001_00004", "layout", [{"Id": "y", "BlockType": "LAYOUT_TITLE"}])):
        (folder / f"{label}__{feature}.json").write_text(json.dumps({"Blocks": own}))
    return str(folder)


def read(spark, path):
    return spark.read.json(str(path))


def test_page_extraction(spark, tmp_path):
    blocks = records.read_blocks(spark, responses(tmp_path / "r")).cache()
    pages = spark.createDataFrame([("d1r001_00001", "student_records_index", 1), ("d1r001_00002", "student_cover", 2), ("d1r001_00003", "student_cover", 3), ("d2r001_00004", "roll_leader", 4)], "label string, page_class string, seq int").withColumn("roll", F.lit("R"))
    found = {}
    for r in extract.candidates(pages.where("page_class = 'student_cover'"), blocks, "label").collect():
        found.setdefault(r["label"], {})[r["source"]] = (r["raw"], r["conf"])
    assert found["d1r001_00002"] == {"forms_name": ("Smyth", 80.0), "forms_bbox": ("Roe", 50.0), "queries_record": ("", 0.0), "queries_top": ("Smyth,", 70.0), "queries_full": ("", 0.0), "detect_first": ("Smyth", 60.0)}
    assert found["d1r001_00003"]["forms_bbox"] == ("", 0.0)
    out = {r["label"]: r for r in extract.extract(pages, blocks, "label", "page_class", "roll", "seq").collect()}
    assert out["d1r001_00001"]["index_rows_added"] == 1 and out["d1r001_00001"]["vote_name"] is None
    two = out["d1r001_00002"]
    assert (two["vote_name"], two["vote_agreement"], two["vote_confidence"], two["vote_sources"]) == ("Smyth", 3, 0.93, ["forms_name", "queries_top", "detect_first"])
    assert tuple(two["snapped"]) == ("SMITH", "ANN", "") and out["d1r001_00003"]["snapped"] is None and out["d2r001_00004"]["candidate_sources"] is None
    early = extract.extract(pages.withColumn("seq", -F.col("seq")), blocks, "label", "page_class", "roll", "seq")
    assert early.where("snapped is not null").count() == 0
    assert extract.extract(pages.withColumn("seq", -F.col("seq")), blocks, "label", "page_class", "roll", "seq", "roll").where("snapped is not null").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidates_of_exploded_blocks(spark, tmp_path):
    """Spark takes exploded blocks for as small as their source: no side of a join may go through the driver."""
    rel = lambda kind, *ids: [{"Type": kind, "Ids": list(ids)}]
    key = lambda i, word, value: {"Id": i, "BlockType": "KEY_VALUE_SET", "EntityTypes": ["KEY"], "Confidence": 50.0, "Relationships": rel("CHILD", word) + rel("VALUE", value)}
    own = {
        "both": [key("k1", "w1", "v"), key("k2", "w1", "v"), {"Id": "v", "BlockType": "KEY_VALUE_SET", "Relationships": rel("CHILD", "w2")}, {"Id": "w1", "BlockType": "WORD", "Text": "NAME"}, {"Id": "w2", "BlockType": "WORD", "Text": "Roe"}],
        "lost": [key("k1", "w1", "gone"), {"Id": "w1", "BlockType": "WORD", "Text": "NAME"}],
        "itself": [key("k1", "w1", "k1"), {"Id": "w1", "BlockType": "WORD", "Text": "NAME"}],
        "other": blocks_of("Smyth"),
    }
    spark.createDataFrame([(k, json.dumps(v)) for k, v in own.items()], "label string, j string").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).select("label", F.posexplode(F.from_json("j", f"array<{records.BLOCK}>")).alias("at", "b"))
    blocks = raw.select("label", F.struct("at").alias("block_pos"), "b.*")
    pages = spark.createDataFrame([("both",), ("lost",), ("itself",), ("empty",)], "label string")
    made = extract.candidates(pages, blocks, "label")
    assert "Broadcast" not in plan(made)
    got = {(r["label"], r["source"]): (r["raw"], r["conf"]) for r in made.collect()}
    assert len(got) == 24 and {k[0]: v for k, v in got.items() if k[1] == "forms_name"} == {"both": ("Roe", 50.0), "lost": ("", 0.0), "itself": ("NAME", 50.0), "empty": ("", 0.0)}
    assert {v for k, v in got.items() if k[1] != "forms_name"} == {("", 0.0)}


@pytest.mark.parametrize("name", ["cover_candidates", "cover_vote"])
def test_cover_queries_are_not_cached_or_broadcast(spark, name):
    made = getattr(page_queries, name)(spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in plan(made) and "InMemoryTableScan" not in plan(made)


def test_enrichment_seams(spark):
    by_value()
    rows = spark.createDataFrame([(1, bytearray(b"x"), ["detect"]), (2, bytearray(b"x"), ["forms", "queries"]), (3, bytearray(b"x"), []), (4, bytearray(b"x"), ["odd"])], "id int, content binary, features array<string>")
    got = {r["id"]: r for r in enrich.ocr(rows, Ocr, "features", queries=[{"Alias": "A", "Text": "?"}]).collect()}
    assert got[1]["usd"] == 0.0015 and got[2]["usd"] == 0.065 and json.loads(got[2]["response"])["features"] == ["forms", "queries"]
    assert got[3]["response"] is None and got[3]["error"] is None and "unknown features" in got[4]["error"]
    with pytest.raises(ValueError):
        enrich.analyze(Ocr(), b"", ("queries",))
    rows = extract.second_pass(F.col("k"), False)
    got = spark.createDataFrame([("student_cover",), ("student_records_index",), ("roll_leader",)], "k string").select("k", rows.alias("f"), extract.routed_price(F.col("k")).alias("usd")).collect()
    assert [(len(r["f"]), r["usd"]) for r in got] == [(4, 0.0895), (1, 0.0165), (0, 0.0015)]
    with pytest.raises(ValueError):
        records.check_features(["detect", "odd"])
    images = records.page_images(spark.createDataFrame([(bytearray(b"no picture"),)], "content binary")).collect()
    assert images[0]["png"] is None and images[0]["error"]


def test_commands(spark, tmp_path, rolls):
    by_value()
    at = lambda name: str(tmp_path / name)
    write_pages(tmp_path / "pages.jsonl", rolls[:5])
    truth = tmp_path / "truth" / "ROLL 001"
    truth.mkdir(parents=True)
    (truth / "SMITH, JOHN.pdf").write_bytes(b"")
    assert main(["regroup", "--pages", at("pages.jsonl"), "--ground-truth", at("truth"), "--mode", "index", "--output-dir", at("o1")], spark) == 0
    assert read(spark, tmp_path / "o1" / "eval").count() == 5 and "packets=" in (tmp_path / "o1" / "summary.txt").read_text()
    assert main(["regroup", "--pages", at("pages.jsonl"), "--roll-id", "none", "--ground-truth", at("truth"), "--output-dir", at("o1")], spark) == 2
    images = tmp_path / "d1r002"
    images.mkdir()
    for k in range(1, 9):
        (images / f"{k:05d}.tif").write_bytes(b"x")
    run = ["run", "--input", at("d1r002"), "--roll-id", "ROLL 002", "--ground-truth", at("truth"), "--extractor", f"{__name__}:Vision", "--concurrency", "2"]
    assert main([*run, "--output-dir", at("o2"), "--budget-ceiling", "0.03"], spark) == 0
    report = read(spark, tmp_path / "o2" / "eval").first()
    assert (report["pages_total"], report["pages_classified"]) == (6, 4)  # six calls fit the budget, one failed, one broke the contract
    assert {r["frame"] for r in read(spark, tmp_path / "o2" / "failed").collect()} == {"00003", "00004"} and read(spark, tmp_path / "o2" / "spend").count() == 4
    responses(tmp_path / "r")
    fixtures = [{"label": "d1r001_00001", "expected_class": "student_records_index"}, {"label": "d1r001_00002", "expected_class": "student_cover", "expected_name": "Smyth Ann"}, {"label": "d1r001_00003", "expected_class": "student_cover", "expected_name": "Foo"}]
    (tmp_path / "fixtures.json").write_text(json.dumps(fixtures))
    named = ["--fixtures-file", at("fixtures.json"), "--responses-dir", at("r"), "--run-label", "x"]
    assert main(["replay", *named, "--output-dir", at("o3")], spark) == 0
    assert "covers: 2" in (tmp_path / "o3" / "x_summary.txt").read_text() and "correct: 1" in (tmp_path / "o3" / "x_summary.txt").read_text()
    assert main(["extract_pipeline", *named, "--output-dir", at("o4")], spark) == 0 and "pages: 3" in (tmp_path / "o4" / "x_summary.txt").read_text()
    for name in ("bake_off", "decode"):
        assert main([name, "--responses-dir", at("r"), "--output-dir", at(name)], spark) == 0
    assert {(r["label"], r["summary"]) for r in read(spark, tmp_path / "bake_off" / "summaries").collect()} >= {("d1r001_00001", "tables=1 cells=6"), ("d1r001_00002", "lines=2"), ("d1r001_00003", "kv_keys=2"), ("d2r001_00004", "layout_blocks=1")}
    (tmp_path / "page.tsv").write_text("level\tconf\ttext\n1\t-1\t\n5\t90\tDoe\n5\t70\tJane\n")
    assert main(["tesseract", "--input", at("page.tsv"), "--output-dir", at("o5")], spark) == 0
    assert tuple(read(spark, tmp_path / "o5" / "ocr").select("mean_confidence", "n_words").first()) == (80.0, 2)
    results = [{"label": "d1r1_1", "page_class": "student_cover", "vote_name": "A B", "vote_confidence": 0.9, "vote_agreement": 2, "spend_usd": 0.1}, {"label": "x", "district": 2, "spend_usd": 0.1}]
    (tmp_path / "results.jsonl").write_text("\n".join(map(json.dumps, results)) + "\n\n")
    assert main(["score", "--results", at("results.jsonl"), "--output-dir", at("o6")], spark) == 0 and "ALL 2 1 1 100.0% 0.200" in (tmp_path / "o6" / "scorecard.txt").read_text()
    assert main(["spot_check", "--results", at("results.jsonl"), "--output-dir", at("o7")], spark) == 0 and read(spark, tmp_path / "o7" / "spot_check").count() == 1
    assert main(["manifest", "--input", at("d1r002"), "--output-dir", at("o8")], spark) == 0 and read(spark, tmp_path / "o8" / "manifest").count() == 8
    (tmp_path / "probe.jsonl").write_text('{"page_id":"d1r002_00001","district":1,"roll":"002","frame":"00001","is_index":true,"row_count":5,"first_3_names":["A","","B"]}\nbroken\n{"page_id":"d1r002_00002","district":1,"roll":"002","frame":"00002","error":"x"}\n')
    assert main(["probe", "--input", at("d1r002"), "--records", at("probe.jsonl"), "--first", "3", "--last", "2", "--output-dir", at("o9")], spark) == 0
    assert sorted(r["frame"] for r in read(spark, tmp_path / "o9" / "todo").collect()) == ["00002", "00003", "00007", "00008"]
    assert read(spark, tmp_path / "o9" / "names").first()["sample_names"] == ["A"]


def test_shipping(tmp_path):
    """Workers that can't import the package get it from the session: run from another folder, without PYTHONPATH."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession, functions as F
from rollweave.functions import scalars as s
from rollweave.shipping import ship
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship(spark)
assert spark.range(1).select(s.folded(F.lit("Ä b,")).alias("x")).first()["x"] == "a b"
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=False, timeout=300).returncode == 0
