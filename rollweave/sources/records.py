"""Explicit schemas, readers and sinks (S1-S11, S13-S17, S18 and S19 with an image library, J6, K1-K7, K10, D1-D14, P17). Facts are read fail-fast; checkpoints drop malformed lines. Writing is Spark's commit protocol: files come whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import frame_of

INDEX_ROW = "struct<last:string,first:string,middle:string,dob:string,source_frame:string>"
PAGE = (
    "frame string, roll_id string, page_class string, separator struct<marker:string,roll_no:string>, student struct<last:string,first:string,middle:string,dob:string,school:string>, "
    f"roll_meta struct<filmer:string,date:string,school:string,reel_no_cert:string>, index_rows array<{INDEX_ROW}>, confidence_overall double, confidence_name double, "
    "notes string, model_version string, processed_at string, latency_ms bigint, tokens_in bigint, tokens_out bigint, usd_cost double"
)
BLOCK = (
    "struct<Id:string,BlockType:string,Text:string,Confidence:double,EntityTypes:array<string>,RowIndex:int,ColumnIndex:int,Relationships:array<struct<Type:string,Ids:array<string>>>,"
    "Query:struct<Alias:string,Text:string>,Geometry:struct<BoundingBox:struct<Top:double,Left:double,Width:double,Height:double>>>"
)
PROBE = "page_id string, district int, roll string, frame string, s3_key string, size_bytes bigint, error string, is_index boolean, row_count int, first_3_names array<string>, other_class string, tokens_in bigint, tokens_out bigint, latency_ms bigint"
SPEND = "page_id string, frame string, roll_id string, purpose string, model_id string, tokens_in bigint, tokens_out bigint, usd_total double, latency_ms bigint, page_class string"
PAGE_CLASSES = ("student_cover", "student_test_sheet", "student_continuation", "student_records_index", "roll_separator", "roll_leader", "unknown")
STUDENT_CLASSES = PAGE_CLASSES[:3]
FEATURES = ("detect", "forms", "tables", "layout", "queries")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page facts; names that are missing are '', and a class out of the list is an error."""
    pages = spark.read.schema(PAGE).json(path, mode="FAILFAST")
    known = F.when(F.col("page_class").isin(*PAGE_CLASSES), F.col("page_class")).otherwise(F.raise_error(F.concat(F.lit("bad page_class in frame "), F.col("frame"))))
    name = lambda c: F.coalesce(F.col(f"student.{c}"), F.lit("")).alias(c)
    return pages.withColumn("page_class", known).withColumn("student", F.struct(*(name(c) for c in ("last", "first", "middle", "dob", "school"))))


def read_checkpoint(spark: SparkSession, path: str, schema: str = PROBE) -> DataFrame:
    """JSON lines, malformed ones dropped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED").where("page_id is not null")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of records."""
    return spark.read.json(path, multiLine=True)


def read_queries(spark: SparkSession, path: str) -> list[dict] | None:
    """A question set, a short fixed list; None if there is no such file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return [r.asDict() for r in spark.read.schema("Alias string, Text string").json(path, multiLine=True).collect()]


def check_features(features: list[str]) -> list[str]:
    """The features, if all are known."""
    if bad := [f for f in features if f not in FEATURES]:
        raise ValueError(f"unknown features: {bad}")
    return features


def rolls_of(files: DataFrame) -> DataFrame:
    """(district, roll, frames) of a listing of .../District <N>/.../ROLL <name>/<frame>; other files go."""
    pattern = r"(?i)district\s*(\d+).*/(ROLL [^/]+)/[^/]+$"
    part = lambda k: F.regexp_extract("path", pattern, k)
    return files.where(F.rlike("path", F.lit(pattern))).groupBy(part(1).cast("int").alias("district"), part(2).alias("roll")).agg(F.count("*").alias("frames"))


def page_images(files: DataFrame, most: int = 1500, content: str = "content") -> DataFrame:
    """The files with ``png``, an RGB or gray picture whose longer side is at most so long, ``deviation`` of its gray values, and ``error``. Needs Pillow where the
    executors run; without it every row says so in ``error``."""

    def run(batches):
        for batch in batches:
            out = []
            for raw in batch[content]:
                try:
                    import io

                    from PIL import Image, ImageStat

                    picture = Image.open(io.BytesIO(raw))
                    picture = picture if picture.mode in ("RGB", "L") else picture.convert("RGB")
                    picture.thumbnail((most, most))
                    png = io.BytesIO()
                    picture.save(png, "PNG")
                    out.append((png.getvalue(), float(ImageStat.Stat(picture.convert("L")).stddev[0]), None))
                except Exception as e:  # noqa: BLE001  the error becomes data
                    out.append((None, None, str(e)[:200]))
            import pandas as pd

            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=["png", "deviation", "error"], dtype=object)], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.mapInPandas(run, f"{own}, png binary, deviation double, error string")


def spend_of(pages: DataFrame, purpose: str = "classify") -> DataFrame:
    """The spend table that page records imply."""
    return pages.select(F.concat_ws("_", F.replace(F.lower("roll_id"), F.lit(" "), F.lit("_")), "frame").alias("page_id"), "frame", "roll_id", F.lit(purpose).alias("purpose"), F.col("model_version").alias("model_id"), "tokens_in", "tokens_out", F.col("usd_cost").alias("usd_total"), "latency_ms", "page_class")


def list_files(spark: SparkSession, path: str, pattern: str, limit: int | None = None) -> DataFrame:
    """(path, name, frame) in order, contents not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    files = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), frame_of(F.col("path")).alias("frame"), "length").orderBy("path")
    return files if limit is None else files.limit(limit)


def manifest_of(files: DataFrame) -> DataFrame:
    """District, roll and frame of .../d<N>r<RRR>/<NNNNN>.tif; other files go."""
    pattern = r"d(\d+)r(\d+)/(\d{5})\.tif$"
    part = lambda k: F.regexp_extract("path", pattern, k)
    own = files.where(F.rlike("path", F.lit(pattern)))
    return own.select(F.concat(F.lit("d"), part(1), F.lit("r"), part(2), F.lit("_"), part(3)).alias("label"), part(1).cast("int").alias("district"), part(2).alias("roll"), part(3).alias("frame"), "path").orderBy("path")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of <label>__<feature>.json files, in the features' order, all of them. Where an id is referred to, extract.latest takes its last block."""
    raw = spark.read.schema(f"Blocks array<{BLOCK}>").json(path, multiLine=True).withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    raw = raw.select(F.substring_index("stem", "__", 1).alias("label"), F.substring_index("stem", "__", -1).alias("feature"), "Blocks")
    rank = F.array_position(F.array(*map(F.lit, FEATURES)), F.col("feature"))
    rows = raw.select("label", "feature", F.struct(rank.alias("rank"), F.lit(0).alias("zero")).alias("r"), F.posexplode("Blocks").alias("pos", "b"))
    return rows.select("label", "feature", F.struct(F.col("r.rank").alias("rank"), "pos").alias("block_pos"), "b.*")


def read_ocr_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(conf, text) of an OCR table."""
    return spark.read.csv(path, sep="\t", header=True, quote="").select(F.col("conf").cast("double"), "text")


def key_range(rolls: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each frame from start to end, with its five-digit file name."""
    return rolls.withColumn("n", F.explode(F.sequence(start, end))).withColumn("file", F.format_string("%05d.tif", "n"))


def write_facts(df: DataFrame, path: str, by: str | None = None, mode: str = "append") -> None:
    """JSON lines, one folder per roll or district if asked for."""
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).json(path)
