"""The copying sink: one manifest row per object, nothing left of attempts that failed."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from boxframe.sources.copy_sink import CopyWriter, copy_with_manifest


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if not f.startswith("."))


def _source(tmp_path, n=20):
    (tmp_path / "src" / "train").mkdir(parents=True)
    for k in range(n):
        (tmp_path / "src" / "train" / f"{k:04x}.jpg").write_bytes(bytes([k]) * (k + 1))


def test_copies_and_publishes(spark, tmp_path):
    _source(tmp_path)
    rows = [("train", f"{k:04x}") for k in range(21)] * 2
    parsed = spark.createDataFrame(rows, "split string, image_id string")
    got = copy_with_manifest(parsed, f"{tmp_path}/src/", f"{tmp_path}/dst/", f"{tmp_path}/manifest", num_partitions=3)
    by = {r.image_id: r for r in got.collect()}
    assert got.count() == 21 and sum(r.ok for r in by.values()) == 20
    assert not by["0014"].ok and "FileNotFoundError" in by["0014"].error and by["0013"].bytes == 20
    assert _files(tmp_path / "dst") == [f"train/{k:04x}.jpg" for k in range(20)]
    assert (tmp_path / "dst" / "train" / "0007.jpg").read_bytes() == bytes([7]) * 8
    assert not any(os.path.basename(d) == "_attempts" for d, _, _ in os.walk(tmp_path))


def test_a_failing_job_leaves_nothing(spark, tmp_path):
    _source(tmp_path)
    parsed = spark.range(20).select(F.lit("train").alias("split"), F.lpad(F.hex("id"), 4, "0").alias("image_id"))
    broken = parsed.withColumn("image_id", F.when(F.col("image_id") == "000F", F.raise_error(F.lit("lost"))).otherwise(F.lower("image_id")))
    with pytest.raises(PySparkException):
        copy_with_manifest(broken, f"{tmp_path}/src/", f"{tmp_path}/dst/", f"{tmp_path}/manifest", num_partitions=2)
    assert not any(os.path.basename(d) == "_attempts" for d, _, _ in os.walk(tmp_path))
    assert _files(tmp_path / "manifest") == [] if (tmp_path / "manifest").exists() else True


def test_only_committed_attempts_count(tmp_path):
    """A task that ran twice, and one that died half way, give one manifest row per object."""
    _source(tmp_path, 4)
    batch = pa.RecordBatch.from_pydict({
        "split": ["train"] * 4, "image_id": [f"{k:04x}" for k in range(4)],
        "src": [f"{tmp_path}/src/train/{k:04x}.jpg" for k in range(4)], "dst": [f"{tmp_path}/dst/train/{k:04x}.jpg" for k in range(4)]})

    def dies():
        yield batch.slice(0, 2)
        raise RuntimeError("executor lost")

    writer = CopyWriter({"dst_root": f"{tmp_path}/dst/", "manifest": f"{tmp_path}/manifest"})
    with pytest.raises(RuntimeError):
        writer.write(dies())
    writer.write(iter([batch]))
    (tmp_path / "dst" / "_attempts" / writer.run / "half").write_bytes(b"half a copy")
    message = writer.write(iter([batch]))
    writer.commit([message, None])
    assert pq.read_table(tmp_path / "manifest").num_rows == 4
    assert _files(tmp_path / "dst") == [f"train/{k:04x}.jpg" for k in range(4)] and not any(os.path.basename(d) == "_attempts" for d, _, _ in os.walk(tmp_path))
