"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes that end a word of the normal form: everything up to 0x7F but digits and letters. A-Z is lower-cased.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

#: Rows and bytes of an Arrow batch, whichever comes first. A batch is held in memory as a whole; one longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: For scratch tables in a local folder. Without its native library Hadoop starts a ``chmod`` process for each file and each task's folder, and its default adds a checksum
#: file with one more. Until such a process is on its way, all of the JVM's memory counts as its own too. Other stores don't read these options.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def prepare(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get. The session keeps the bounds: results are lazy, so they have to hold until the caller runs them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_ARROW = {
    "boolean": pa.bool_(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(),
    "string": pa.string(), "binary": pa.binary(), "date": pa.date32(), "timestamp": pa.timestamp("us", tz="UTC"), "timestamp_ntz": pa.timestamp("us"),
}


def batch_type(name: str) -> pa.DataType:
    """The Arrow type of a key column of this Spark type, as DataFrame.dtypes names it."""
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", name):
        return pa.decimal128(int(m[1]), int(m[2]))
    if name not in _ARROW:
        raise ValueError(f"a key of type {name} isn't supported")
    return _ARROW[name]


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see. The cluster names it in spark.checkpoint.dir; the default serves local tests."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "/tmp/checkpoints"
    return at.rstrip("/")


_open: list[Scratch] = []


class Scratch:
    """Tables written to the shared folder, to cut lineage: what is lost with an executor is read again from there.

    A table's shuffle files go once it is written. ``drop`` deletes a table that no later plan reads, and ``temporary`` what is left once the result,
    which may read it, is stored elsewhere.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_dir(spark)}/rollweave/{name}-{uuid.uuid4().hex}"
        _open.append(self)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.at}/{name}"
        before = self.spark.conf.get(FILE_CLEANUP, "false")
        self.spark.conf.set(FILE_CLEANUP, "true")
        try:
            df.write.mode("overwrite").options(compression="snappy", **PLAIN_FILES).parquet(path)
        finally:
            self.spark.conf.set(FILE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.at}/{name}")

    def _delete(self, at: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary() -> Iterator[None]:
    """Deletes the scratch tables that operators open inside it, once their results have been stored elsewhere inside it too."""
    before = list(_open)
    yield
    for one in [x for x in _open if x not in before]:
        one._delete(one.at)
        _open.remove(one)


def deal_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join whose sides each get a shuffle of their own, by the keys and a hash of them.

    An aggregated side already lies dealt by its keys, and a join that takes it as it lies can't be split: a hot key's rows would be one task's work. With
    the hash among the keys both sides are dealt anew, and adaptive execution splits the partitions that are too large.
    """
    by = F.xxhash64(F.lit(len(keys)), *keys)
    return left.withColumn("_by", by).join(right.withColumn("_by", by).hint("merge"), [*keys, "_by"], how).drop("_by")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(a, b):
    """Null-safe equality of two columns."""
    return F.equal_null(a, b)
