"""Single objects of the store, credential files and text exports."""

import pytest

from rollweave.sources import store


def test_credential_files(spark, tmp_path):
    at = tmp_path / "keys"
    at.write_text("# mine\n\nexport AWS_ACCESS_KEY_ID=abc\nAWS_SECRET_ACCESS_KEY = 'a=b #c' \nEMPTY=\nNOTE=x # said\nno line\n")
    found = store.read_settings(str(at))
    assert found == {"AWS_ACCESS_KEY_ID": "abc", "AWS_SECRET_ACCESS_KEY": "a=b #c", "EMPTY": "", "NOTE": "x"}
    store.use_credentials(spark, found, "films")
    conf = spark._jsc.hadoopConfiguration()
    assert conf.get("fs.s3a.bucket.films.access.key") == "abc" and conf.get("fs.s3a.bucket.films.endpoint.region") == "us-east-1" and conf.get("fs.s3a.access.key") is None
    with pytest.raises(ValueError, match="AWS_SECRET_ACCESS_KEY"):
        store.use_credentials(spark, {"AWS_ACCESS_KEY_ID": "abc"})


def test_objects(spark, tmp_path):
    mine, root = tmp_path / "mine", str(tmp_path / "store")
    mine.write_bytes(b"\x00\xffone")
    assert store.listed(spark, root) == [] and store.folders(spark, root) == []
    for name in ("b/2", "a/1", "a/3"):
        store.upload(spark, str(mine), f"{root}/{name}")
    assert [p.split("store/")[1] for p, n in store.listed(spark, root) if n == 5] == ["a/1", "a/3", "b/2"]
    assert len(store.listed(spark, root, 2)) == 2 and store.folders(spark, root) == ["a", "b"]
    assert store.read(spark, f"{root}/a/1") == b"\x00\xffone"
    store.download(spark, f"{root}/b/2", str(tmp_path / "back"))
    assert (tmp_path / "back").read_bytes() == mine.read_bytes()
    assert store.delete(spark, f"{root}/a/1") and not store.delete(spark, f"{root}/a/1")
    with pytest.raises(ValueError):
        store.delete(spark, f"{root}/a")
    with pytest.raises(Exception, match="a/1"):
        store.read(spark, f"{root}/a/1")


def test_text_exports(spark, tmp_path):
    at = str(tmp_path / "texts")
    store.write_texts(spark.createDataFrame([("p1", "a\nb"), ("p2", None)], "label string, t string"), "label", "t", at)
    assert sorted((r["label"], r["value"]) for r in spark.read.text(at).collect()) == [("p1", "a"), ("p1", "b"), ("p2", "")]
