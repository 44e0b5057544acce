import os

from rollweave.llm.common import Scratch


def test_scratch_tables_have_no_checksum_files(spark):
    """Each of them would start a process that at first looks like a second copy of the JVM."""
    scratch = Scratch(spark, "plain")
    table = scratch.put(spark.range(1000, numPartitions=3), "table")
    path = f"{scratch.at}/table".removeprefix("file:")
    assert len([x for x in os.listdir(path) if x.startswith("part-")]) == 3
    assert not [x for x in os.listdir(path) if x.endswith(".crc")]
    assert sorted(r["id"] for r in table.collect()) == list(range(1000))
    scratch.drop("table")
    assert not os.path.exists(path)
