"""Object copies with Hadoop-style URIs, missing sources and idempotent re-runs."""

import pytest

from boxframe.operators.transfer import copy_objects
from boxframe.sources.fs import arrow_fs


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_copy_with_uri_forms(spark, tmp_path, scheme):
    src = tmp_path / "src" / "train"
    src.mkdir(parents=True)
    (src / "00ab.jpg").write_bytes(b"0123456789")
    parsed = spark.createDataFrame([("train", "00ab"), ("train", "00ab"), ("train", "ffff")], "split string, image_id string")
    m = {r.image_id: r for r in copy_objects(parsed, f"{scheme}{tmp_path}/src/", f"{scheme}{tmp_path}/dst/").collect()}
    assert set(m) == {"00ab", "ffff"}  # duplicates copied once
    assert m["00ab"].ok and m["00ab"].bytes == 10 and m["00ab"].error is None
    assert not m["ffff"].ok and "FileNotFoundError" in m["ffff"].error
    assert (tmp_path / "dst" / "train" / "00ab.jpg").read_bytes() == b"0123456789"
    assert not list((tmp_path / "dst" / "train").glob("*.tmp-*"))  # no temp files left behind


def test_arrow_fs_forms(tmp_path):
    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}", f"file:///{str(tmp_path).lstrip('/')}"):
        fs, path = arrow_fs(uri)
        assert path == str(tmp_path)


def test_same_size_target_is_replaced(spark, tmp_path):
    (tmp_path / "src" / "train").mkdir(parents=True)
    (tmp_path / "dst" / "train").mkdir(parents=True)
    (tmp_path / "src" / "train" / "0a.jpg").write_bytes(b"NEWNEW")
    (tmp_path / "dst" / "train" / "0a.jpg").write_bytes(b"OLDOLD")
    parsed = spark.createDataFrame([("train", "0a")], "split string, image_id string")
    assert copy_objects(parsed, f"{tmp_path}/src/", f"{tmp_path}/dst/").first().ok
    assert (tmp_path / "dst" / "train" / "0a.jpg").read_bytes() == b"NEWNEW"


def test_one_client_per_store(monkeypatch):
    from boxframe.sources import fs

    made = []
    monkeypatch.setattr(fs, "arrow_fs", lambda uri, options=None: (made.append(uri) or object(), uri))
    stores = fs.Stores({"s3": {"anonymous": True}})
    got = [stores.resolve(u) for u in ("s3://a/x", "s3://a/y", "s3://b/x", "/l/x", "file:///l/y", "gs://a/x")]
    assert stores.created == len(made) == 4
    assert got[0][0] is got[1][0] is not got[2][0] and [p for _, p in got] == ["a/x", "a/y", "b/x", "/l/x", "/l/y", "a/x"]


def test_anonymous_store_options():
    pafs = pytest.importorskip("pyarrow.fs")
    fs, path = arrow_fs("s3://bucket/key/x.jpg", {"s3": {"anonymous": True, "region": "us-east-1"}})
    assert isinstance(fs, pafs.S3FileSystem) and path == "bucket/key/x.jpg"


def test_existence_manifest_with_a_frequent_line(spark):
    from boxframe.operators.transfer import existence_manifest, transfer_summary

    parsed = spark.createDataFrame([("train", "")] * 50 + [("train", "0a"), ("test", "0a")], "split string, image_id string")
    listing = spark.createDataFrame([("p/0a.jpg",)], "path string")
    got = {r.split: (r.n_ok, r.n_total) for r in transfer_summary(existence_manifest(parsed, listing, "p/")).collect()}
    assert got == {"train": (1, 51), "test": (1, 1)}
