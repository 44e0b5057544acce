"""Single objects of any file system that Hadoop reaches (S20, S21), and text exports (K11). Tables go through Spark's readers; this is for looking at and moving a few files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Names in a credential file, and what the object store's connector calls them.
CREDENTIALS = {"AWS_ACCESS_KEY_ID": "fs.s3a.access.key", "AWS_SECRET_ACCESS_KEY": "fs.s3a.secret.key", "AWS_SESSION_TOKEN": "fs.s3a.session.token", "AWS_REGION": "fs.s3a.endpoint.region"}
REGION = "us-east-1"
LISTED = 1000


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_settings(path: str) -> dict[str, str]:
    """NAME=value lines of a credential file on the driver; blank lines, # comments and a leading ``export`` don't count, nor do quotes around a value. The environment stays as it is."""
    with open(path, encoding="utf-8") as f:
        found = (re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line) for line in f)
        pairs = [(m[1], m[2]) for m in found if m]
    quoted = lambda v: len(v) > 1 and v[0] == v[-1] and v[0] in "'\""
    return {k: v[1:-1] if quoted(v) else re.sub(r"\s+#.*$", "", v) for k, v in pairs}


def use_credentials(spark: SparkSession, settings: dict[str, str], bucket: str | None = None) -> None:
    """What the file names goes to the session's Hadoop settings, for one bucket if named, so that two accounts can be read side by side. Keys must be there."""
    if missing := [k for k in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY") if not settings.get(k)]:
        raise ValueError(f"missing credentials: {', '.join(missing)}")
    conf = spark._jsc.hadoopConfiguration()
    for name, key in CREDENTIALS.items():
        value = settings.get(name) or (REGION if name == "AWS_REGION" else None)
        if value:
            conf.set(key.replace("fs.s3a.", f"fs.s3a.bucket.{bucket}.", 1) if bucket else key, value)


def listed(spark: SparkSession, folder: str, most: int | None = LISTED) -> list[tuple[str, int]]:
    """(path, bytes) of the files under a folder, in order, the first ``most`` of them (None: all); none if the folder isn't there. Many files are list_files' work, which is distributed."""
    fs, at = _at(spark, folder)
    if not fs.exists(at):
        return []
    files, found = fs.listFiles(at, True), []
    while files.hasNext():
        one = files.next()
        found.append((one.getPath().toString(), one.getLen()))
    return sorted(found)[:most]


def folders(spark: SparkSession, root: str) -> list[str]:
    """The names of the folders in a root, in order."""
    fs, at = _at(spark, root)
    return sorted(x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory()) if fs.exists(at) else []


def upload(spark: SparkSession, local: str, to: str) -> None:
    """A local file to the store, over what is there."""
    fs, at = _at(spark, to)
    fs.copyFromLocalFile(False, True, spark._jvm.org.apache.hadoop.fs.Path(local), at)


def download(spark: SparkSession, path: str, local: str) -> None:
    """A file of the store to a local one, without a checksum file beside it."""
    fs, at = _at(spark, path)
    fs.copyToLocalFile(False, at, spark._jvm.org.apache.hadoop.fs.Path(local), True)


def read(spark: SparkSession, path: str) -> bytes:
    """The bytes of one file."""
    fs, at = _at(spark, path)
    fs.getFileStatus(at)  # a missing file is an error here, not an empty table
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def delete(spark: SparkSession, path: str) -> bool:
    """One file; False if it wasn't there. Folders aren't deleted."""
    fs, at = _at(spark, path)
    if fs.exists(at) and fs.getFileStatus(at).isDirectory():
        raise ValueError(f"{path} is a folder")
    return fs.delete(at, False)


def write_texts(rows: DataFrame, label: str, text: str, path: str, mode: str = "append") -> None:
    """Texts as plain lines, a folder for each label: OCR dumps (text) and OCR tables (tab-separated lines). Null texts are empty."""
    rows.select(F.col(label), F.coalesce(F.col(text), F.lit("")).alias("value")).write.mode(mode).partitionBy(label).text(path)
