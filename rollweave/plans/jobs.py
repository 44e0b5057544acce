"""End-to-end jobs over page records of any number of rolls: index, grouping, evaluation (the CLI's ``run`` and ``regroup``), and page extraction with its scores."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import frame_number, frame_order, has_name
from ..operators import evaluate, packets, snap
from ..sources.records import STUDENT_CLASSES


def kept(df: DataFrame) -> DataFrame:
    """A result that several steps read, written once to the shared folder that the cluster names in spark.checkpoint.dir: it isn't made again, what is lost with an executor is read
    again from there, and later plans begin at it. Names and numbers only, no texts. Local sessions without such a folder write to a temporary one."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.gettempdir()
    path = f"{at.rstrip('/')}/rollweave-jobs/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Options:
    """mode: boundary (name changes) or index (by index entry). fallback: least size of islands over pages without an entry, 0 for none (index mode)."""

    mode: str = "boundary"
    merge: bool = True
    fallback: int = 0
    min_bucket: int = 1
    threshold: float = 0.7


def flat_pages(pages: DataFrame) -> DataFrame:
    """Page records with their names as columns, frames as numbers and, in ``at``, as what they are sorted by, and blanks for nulls."""
    side = lambda c: F.coalesce(F.col(f"student.{c}"), F.lit("")).alias(c)
    return pages.select("roll_id", "frame", frame_number(F.col("frame")).cast("long").alias("frame_no"), frame_order(F.col("frame")).alias("at"), "page_class", F.col("separator.marker").alias("marker"), *map(side, ("last", "first", "middle", "dob")), F.col("confidence_name").alias("confidence"))


def index_of(pages: DataFrame) -> DataFrame:
    """The rolls' indexes from their index pages, first seen by frame and row."""
    rows = pages.where("page_class = 'student_records_index'").select("roll_id", "frame", F.posexplode("index_rows").alias("at", "r"))
    rows = rows.select("roll_id", F.col("r.last").alias("last"), F.col("r.first").alias("first"), F.col("r.middle").alias("middle"), F.col("r.dob").alias("dob"), F.struct(frame_order(F.col("frame")).alias("frame"), "at").alias("pos"), "frame")
    own = snap.roll_index(rows, "roll_id", "last", "first", "pos", "dob", "middle")
    return own.withColumn("source_frame", F.col("pos.frame.frame"))


def student_window(pages: DataFrame) -> DataFrame:
    """The student pages between a roll's first START and its last END. pages: flat."""
    mark = lambda m: (F.col("page_class") == "roll_separator") & F.coalesce(F.col("marker") == m, F.lit(False))
    return packets.bracket(pages, "roll_id", "at", mark("START"), mark("END")).where(F.col("page_class").isin(*STUDENT_CLASSES))


def group(pages: DataFrame, index: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Packets of all rolls: roll_id, packet_no, packet_id, last, first, middle, their raw forms, frames, pages, avg_confidence, flagged, snap_applied, snap_distance."""
    own = student_window(flat_pages(pages))
    own = snap.nearest(own, index, "roll_id", "last", "first", caps=(3, 3, 4), swap=True, strict=(2, 2, 3)).drop("_l", "_f")
    if options.mode == "index":
        own = kept(own.drop("near"))
        own = own.withColumn("snap", F.when(has_name(F.col("last"), F.col("first")), F.col("snap")))
        made = packets.index_buckets(own.drop("last", "first", "middle"), "roll_id", "at", "confidence", options.threshold, options.min_bucket)
        if options.fallback:
            # As the index decides, rolls without one have no packets at all.
            there = own.join(index.select("roll_id").distinct(), "roll_id", "left_semi")
            made = packets.fallback_packets(there, made, "roll_id", "at", "last", "first", "middle", "confidence", options.threshold, options.fallback)
        made = made.withColumn("frames", F.transform("frames", lambda x: x["frame"]))
        raw = {f"{c}_raw": F.col(c) for c in ("last", "first", "middle")}
        made = made.withColumns(raw).withColumn("snap_applied", F.col("max_distance").isNotNull()).withColumn("snap_distance", F.when(F.col("max_distance").isNotNull(), 0))
        return made.select(*PACKET[:7], F.col("n_pages").alias("pages"), *PACKET[8:], F.col("max_distance"))
    if options.mode != "boundary":
        raise ValueError(f"unknown mode {options.mode}")
    known = index.select("roll_id").distinct().withColumn("_index", F.lit(True))
    own = own.join(known, "roll_id", "left").withColumn("_key", packets.boundary_key(F.col("last"), F.col("first"), F.col("snap"), F.coalesce("_index", F.lit(False))))
    own = packets.islands(own, "roll_id", "at", F.col("_key"))
    made = packets.merge_to_fixpoint(own, "roll_id", "frame_no", "last", "first", confidence="confidence", threshold=options.threshold, middle="middle", frame="frame", merge=options.merge, near="near")
    return made.select(*PACKET)


#: Columns of a packet.
PACKET = ["roll_id", "packet_no", "packet_id", "last", "first", "middle", "frames", "pages", "last_raw", "first_raw", "middle_raw", "avg_confidence", "flagged", "snap_applied", "snap_distance"]


def regroup(pages: DataFrame, truth_files: DataFrame, options: Options = Options(), failed: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:  # noqa: B008
    """(index, packets, report) of page records. truth_files: (roll_id, name). The report has a row for each roll. What several steps read is kept, so the job runs as it is called."""
    index = kept(index_of(pages))
    made = kept(group(pages, index, options))
    cleaned = kept(evaluate.clean_truth(truth_files, "roll_id", "name"))
    return index, made, evaluate.evaluate(made, cleaned, evaluate.page_totals(pages, index, "roll_id", failed), "roll_id")


def index_with_positions(index: DataFrame) -> DataFrame:
    """K3: an index as it is written: in order, names as first seen."""
    at = F.row_number().over(Window.partitionBy("roll_id").orderBy("pos"))
    return index.select("roll_id", at.alias("position"), F.col("last_raw").alias("last"), F.col("first_raw").alias("first"), F.col("imiddle").alias("middle"), "dob", "source_frame")
