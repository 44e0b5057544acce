"""Optional streaming front end (Z21): page records arrive as files, packets of a roll are counted as its END mark comes in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.records import PAGE


def page_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files).json(path)


def roll_progress(pages: DataFrame) -> DataFrame:
    """Per roll the pages so far, by class, spend, and whether its END mark has come. For update or complete mode."""
    return pages.groupBy("roll_id").agg(F.count("*").alias("pages"), F.count_if(F.col("page_class") == "student_cover").alias("covers"), F.sum("usd_cost").alias("usd"), F.max(F.coalesce(F.col("separator.marker") == "END", F.lit(False))).alias("ended"))
