"""Command line: ``python -m rollweave <command>``. Each command reads files, runs one job over all rolls in them, and writes JSON lines (and, for reports, a text).

regroup: packets, indexes and reports from page records. run: the same from page images, by an extractor given as module:factory. replay and extract: names from OCR responses, by expected class or
by the classifier. bake_off, decode, tesseract, score, spot_check, manifest, probe: summaries of responses, digests, OCR tables, scorecards, samples, listings."""

from __future__ import annotations

import argparse
import importlib
import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import scalars as s
from .operators import enrich, extract, report
from .plans import jobs
from .shipping import ship
from .sources import records


def session() -> SparkSession:
    spark = SparkSession.builder.appName("rollweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    return spark


def _write(df: DataFrame, folder: str, name: str) -> None:
    records.write_facts(df, f"{folder}/{name}", mode="overwrite")


def _say(folder: str, name: str, lines: list[str]) -> None:
    """K6, K9: a short text for people, from a few rows; printed, and kept where the folder is local."""
    body = "\n".join(lines)
    print(body)
    if "://" not in folder:
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write(body + "\n")


def _truth(spark: SparkSession, at: str, roll: str | None) -> DataFrame:
    """S3: names of the truth's files; the folder's name is the roll, if none is given."""
    files = records.list_files(spark, at, "*.pdf")
    return files.select((F.lit(roll) if roll else F.element_at(F.split("path", "/"), -2)).alias("roll_id"), "name")


def _grouped(spark: SparkSession, a, pages: DataFrame, failed: DataFrame | None = None) -> int:
    options = jobs.Options(mode=a.mode, merge=not a.no_merge, fallback=a.fallback, min_bucket=a.min_bucket_size, threshold=a.confidence_threshold)
    index, made, evaluated = jobs.regroup(pages, _truth(spark, a.ground_truth, a.roll_id), options, failed)
    _write(jobs.index_with_positions(index), a.output_dir, "index")
    _write(made, a.output_dir, "students")
    evaluated = evaluated.cache()
    _write(evaluated, a.output_dir, "eval")
    shown = evaluated.orderBy("roll_id").limit(50).collect()  # for people; all rolls are in the files
    _say(a.output_dir, "summary.txt", [f"{r['roll_id']}: packets={r['packets_predicted']} pre_partial={r['accuracy_partial_pre']:.1%} post_partial={r['accuracy_partial_post']:.1%} exact_post={r['exact_matches_post']} usable={r['gt_rows_usable']} usd={r['usd_total']:.4f}" for r in shown])
    return 0


def _one_roll(pages: DataFrame, roll: str | None) -> DataFrame:
    return pages.where(F.col("roll_id") == roll) if roll else pages


def regroup(spark: SparkSession, a) -> int:
    pages = _one_roll(records.read_pages(spark, a.pages), a.roll_id)
    if pages.isEmpty():
        print(f"no pages in {a.pages}", file=sys.stderr)
        return 2
    return _grouped(spark, a, pages)


def run(spark: SparkSession, a) -> int:
    files = records.list_files(spark, a.input, "*.tif", a.limit)
    if files.isEmpty():
        print(f"no .tif in {a.input}", file=sys.stderr)
        return 2
    module, _, factory = a.extractor.partition(":")
    make = getattr(importlib.import_module(module), factory)
    jobs_ = files.withColumn("roll_id", F.lit(a.roll_id)).withColumn("usd", F.lit(float(a.page_price)))
    if a.budget_ceiling > 0:
        jobs_ = report.within_budget(jobs_, ["roll_id"], "frame", "usd", a.budget_ceiling).drop("spent_before")
    jobs_ = jobs_.drop("usd").repartition(a.concurrency)
    fields = "reply string, model_version string, processed_at string, latency_ms bigint, tokens_in bigint, tokens_out bigint"
    # Stored before it branches: a call that is paid for isn't made twice.
    _write(enrich.enrich(jobs_, make, fields), a.output_dir, "replies")
    replies = spark.read.schema(f"path string, name string, frame string, length bigint, roll_id string, {fields}, error string").json(f"{a.output_dir}/replies")
    good, bad = enrich.quarantine(replies)
    made = extract.page_records(good)
    sound, broken = enrich.quarantine(made)
    _write(sound.drop("error"), a.output_dir, "pages")
    pages = records.read_pages(spark, f"{a.output_dir}/pages")
    _write(records.spend_of(pages), a.output_dir, "spend")
    failed = bad.select("roll_id", "frame", "error").unionByName(broken.select("roll_id", "frame", "error"))
    _write(failed, a.output_dir, "failed")
    return _grouped(spark, a, pages, failed)


def _scored(spark: SparkSession, a, results: DataFrame, live: bool) -> int:
    _write(results, a.output_dir, f"{a.run_label}_results")
    kept = spark.read.schema(results.schema).json(f"{a.output_dir}/{a.run_label}_results")
    out = (extract.live_score(kept, a.ship_at) if live else extract.replay_score(kept, a.ship_at)).first().asDict()
    _say(a.output_dir, f"{a.run_label}_summary.txt", [f"{k}: {round(v, 4) if isinstance(v, float) else v}" for k, v in out.items()])
    return 0


def _fixtures(spark: SparkSession, path: str) -> DataFrame:
    """The fixtures in the file's order, with their roll (of the label) for the index."""
    from pyspark.sql import Window

    own = records.read_manifest(spark, path).withColumn("_at", F.monotonically_increasing_id())
    own = own.withColumn("seq", F.row_number().over(Window.orderBy("_at"))).drop("_at")
    for c in ("expected_class", "expected_name"):
        if c not in own.columns:
            own = own.withColumn(c, F.lit(None).cast("string"))
    return own.withColumn("roll", F.coalesce(F.nullif(F.regexp_extract("label", r"^(d\d+r\w+?)_", 1), F.lit("")), F.lit("all")))


def replay(spark: SparkSession, a) -> int:
    fixtures = _fixtures(spark, a.fixtures_file)
    blocks = records.read_blocks(spark, a.responses_dir).cache()
    out = extract.extract(fixtures, blocks, "label", "expected_class", "roll", "seq", a.visibility, jobs.kept)
    return _scored(spark, a, out, False)


def extract_pipeline(spark: SparkSession, a) -> int:
    fixtures = _fixtures(spark, a.fixtures_file)
    blocks = records.read_blocks(spark, a.responses_dir).cache()
    classes = extract.classify(blocks.where("feature = 'detect'"), "label")
    asked = bool(a.queries_file and records.read_queries(spark, a.queries_file))
    own = fixtures.join(classes, "label", "left").withColumn("page_class", F.coalesce("page_class", F.lit("unknown"))).withColumn("spend_usd", extract.routed_price(F.col("page_class"), asked))
    own = report.within_budget(own.withColumn("_run", F.lit(1)), ["_run"], "seq", "spend_usd", a.budget_ceiling).drop("_run", "spent_before")
    return _scored(spark, a, extract.extract(own, blocks, "label", "page_class", "roll", "seq", a.visibility, jobs.kept), True)


def bake_off(spark: SparkSession, a) -> int:
    features = records.check_features(a.features.split(","))
    out = extract.feature_summary(records.read_blocks(spark, a.responses_dir).where(F.col("feature").isin(features)), "label", "feature")
    _write(out, a.output_dir, "summaries")
    return 0


def decode(spark: SparkSession, a) -> int:
    blocks = records.read_blocks(spark, a.responses_dir).cache()
    if blocks.isEmpty():
        print(f"no <label>__<feature>.json in {a.responses_dir}", file=sys.stderr)
        return 1
    _write(extract.text_digest(blocks.where("feature = 'detect'"), "label"), a.output_dir, "detect")
    _write(extract.layout_histogram(blocks, "label").orderBy("label", "block_type"), a.output_dir, "layout")
    _write(extract.index_from_tables(blocks, "label"), a.output_dir, "tables")
    _write(extract.candidates(blocks, blocks, "label"), a.output_dir, "candidates")
    return 0


def tesseract(spark: SparkSession, a) -> int:
    words = spark.read.csv(a.input, sep="\t", header=True, quote="").select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("page"), F.col("conf").cast("double").alias("conf"), "text")
    _write(extract.ocr_summary(words, "page"), a.output_dir, "ocr")
    return 0


RESULT = "label string, district int, page_class string, vote_name string, vote_confidence double, vote_agreement bigint, vote_sources array<string>, rel_path string, spend_usd double"


def _results(spark: SparkSession, path: str, default: int | None) -> DataFrame:
    own = spark.read.schema(RESULT).json(path).where("label is not null")
    return own.withColumn("district", s.district_of(F.col("district"), F.col("label"), default))


def score(spark: SparkSession, a) -> int:
    card = report.scorecard(_results(spark, a.results, None), "district", F.col("page_class"), F.col("vote_confidence"), F.col("spend_usd"), ship_at=a.ship_at).orderBy("is_total", "district")
    rows = card.collect()  # a row per district
    _say(a.output_dir, "scorecard.txt", ["district total covers shipped rate usd"] + [f"{'ALL' if r['is_total'] else r['district']} {r['total']} {r['n_covers']} {r['shipped']} {r['ship_rate']:.1%} {r['spend']:.3f}" for r in rows])
    return 0


def spot_check(spark: SparkSession, a) -> int:
    _write(extract.spot_check(_results(spark, a.results, 0), "district", a.top_n, a.ship_at), a.output_dir, "spot_check")
    return 0


def manifest(spark: SparkSession, a) -> int:
    _write(records.manifest_of(records.list_files(spark, a.input, "*.tif")), a.output_dir, "manifest")
    return 0


def probe(spark: SparkSession, a) -> int:
    """The sampling job's plan and summary: which frames are still to be looked at, and what the records so far say."""
    files = records.list_files(spark, a.input, "*.tif")
    sample = report.first_and_last(records.manifest_of(files), ["district", "roll"], "frame", a.first, a.last).withColumn("page_id", F.col("label"))
    done = records.read_checkpoint(spark, a.records) if a.records else None
    if done is not None:
        sample = report.not_done(sample, done, ["page_id"], F.col("error").isNotNull())
        is_index = F.coalesce(F.col("is_index"), F.lit(False))
        _write(report.roll_summary(done, ["district", "roll"], is_index, F.col("error"), F.col("row_count"), "frame").orderBy("district", "roll"), a.output_dir, "rolls")
        _write(report.sample_names(done.where("is_index and error is null"), ["district", "roll"], "frame", "first_3_names"), a.output_dir, "names")
    _write(sample, a.output_dir, "todo")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rollweave", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, f, *arguments: tuple[str, dict]) -> None:
        p = sub.add_parser(name)
        p.set_defaults(f=f)
        for flag, more in (*arguments, ("--output-dir", {"required": True})):
            p.add_argument(flag, **more)

    need = {"required": True}
    group = (
        ("--ground-truth", need), ("--mode", {"choices": ["boundary", "index"], "default": "boundary"}), ("--no-merge", {"action": "store_true"}), ("--fallback", {"type": int, "default": 0}),
        ("--min-bucket-size", {"type": int, "default": 1}), ("--confidence-threshold", {"type": float, "default": 0.7}),
    )
    command("regroup", regroup, ("--pages", need), ("--roll-id", {}), *group)
    command("run", run, ("--input", need), ("--roll-id", need), ("--extractor", need), ("--limit", {"type": int}), ("--concurrency", {"type": int, "default": 8}), ("--budget-ceiling", {"type": float, "default": 10.0}), ("--page-price", {"type": float, "default": 0.005}), *group)
    pages = (("--fixtures-file", need), ("--responses-dir", need), ("--run-label", need), ("--visibility", {"choices": ["prefix", "roll"], "default": "prefix"}))
    command("replay", replay, *pages, ("--ship-at", {"type": float, "default": 0.70}))
    command("extract_pipeline", extract_pipeline, *pages, ("--ship-at", {"type": float, "default": 0.60}), ("--queries-file", {}), ("--budget-ceiling", {"type": float, "default": 2.0}))
    command("bake_off", bake_off, ("--responses-dir", need), ("--features", {"default": ",".join(records.FEATURES)}))
    command("decode", decode, ("--responses-dir", need))
    command("tesseract", tesseract, ("--input", need))
    for name, f, more in (("score", score, ()), ("spot_check", spot_check, (("--top-n", {"type": int, "default": 30}),))):
        command(name, f, ("--results", need), ("--ship-at", {"type": float, "default": 0.70}), *more)
    command("manifest", manifest, ("--input", need))
    command("probe", probe, ("--input", need), ("--records", {}), ("--first", {"type": int, "default": 40}), ("--last", {"type": int, "default": 5}))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return a.f(spark or session(), a)


if __name__ == "__main__":
    sys.exit(main())
