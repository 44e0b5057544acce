"""The corpus pipeline: documents through five operators, each stage written as Parquet and read again as the next one's documents.

1 toxicity: documents that the chain rejects go. 2 line dedup: globally repeated runs of two or more lines go from the texts, so a later
copy goes whole: as a row, or with an empty text, to which mixing gives no copies. 3 near duplicates: one document of each group stays. 4 decontamination: contaminated documents go. 5 mixing: what is left
is sampled to the target weights; ``copies`` says how often a document is to be read.

A stage's input may have nulls in any column, empty and very long texts, repeated rows, no rows, and further columns of any name. Toxicity: a null or empty text is scored by the models' intercepts, each
row on its own. Line dedup: null counts as empty and stays; of repeated rows, whose lines stand at equal places, all stay. Near duplicates: null and empty texts are linked with nothing, so they stay; repeated
rows of a key and text come back once; a null key comes last. Decontamination: null and empty texts aren't hit. Mixing: documents without tokens get no copies, so they go; repeated rows draw alike. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollweave.llm import decontaminate as dc, line_dedup, mixing, near_dedup, toxicity
from rollweave.llm.common import Scratch, prepare, table, temporary
from rollweave.llm.queries import CATEGORIES


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.reject(docs, chain, "toxic")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_runs(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dc.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


STAGES = [("toxicity", toxic), ("line dedup", lines), ("near dedup", near), ("decontamination", benchmark), ("mixing", mix)]

#: The toxicity stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with temporary():
            docs = scratch.put(stage(spark, docs, sf_dir), f"{k}")
        if k:
            scratch.drop(f"{k - 1}")
    return docs
