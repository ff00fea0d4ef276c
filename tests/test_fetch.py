"""Late pixel fetch and listings by tasks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxframe.operators import fetch
from boxframe.operators.fetch import decode_png, fetch_images, image_paths, load_batches
from boxframe.operators.images import encode_png, image_rows
from boxframe.plans import catalog
from boxframe.plans.jobs import preprocess_job
from boxframe.sources.listing import LevelReader, walk
from boxframe.sources.readers import read_images
from tests.conftest import SF_SMALL


def _png(px, kind, filters, bits=8):
    """A PNG whose rows use the given filters in turn, written by the specification's formulas."""
    import struct
    import zlib

    h = px.shape[0]
    step = px.reshape(h, px.shape[1], -1).shape[2] * bits // 8
    rows = px.astype(">u2" if bits == 16 else np.uint8).reshape(h, -1).view(np.uint8).astype(int)
    raw = b""
    for y in range(h):
        f = filters[y % len(filters)]
        line = []
        for i in range(rows.shape[1]):
            a = rows[y, i - step] if i >= step else 0
            b = rows[y - 1, i] if y else 0
            c = rows[y - 1, i - step] if y and i >= step else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((rows[y, i] - [0, a, b, (a + b) // 2, paeth][f]) & 255)
        raw += bytes([f]) + bytes(int(v) for v in line)

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    head = struct.pack(">IIBBBBB", px.shape[1], h, bits, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_decode_png_against_the_image_source(spark, tmp_path):
    rng = np.random.default_rng(1)
    bodies = {}
    for kind, channels in ((0, 1), (2, 3), (6, 4)):
        px = rng.integers(0, 256, (9, 7, channels), dtype=np.uint8)
        bodies[f"k{kind}"] = _png(px, kind, [0, 1, 2, 3, 4])
    bodies["flat"] = encode_png(np.full((3, 2, 3), 5, np.uint8))
    bodies["bad"] = b"not an image"
    bodies["short"] = bodies["k2"][:60]
    for k, b in bodies.items():
        (tmp_path / f"{k}.png").write_bytes(b)
    want = {r.ImageID: r for r in image_rows(read_images(spark, str(tmp_path)), ".png").collect()}
    ids = spark.createDataFrame([(k,) for k in [*bodies, "gone"]] + [(None,)], "ImageID string")
    got = {r.ImageID: r for r in fetch_images(image_paths(ids, str(tmp_path), ".png")).collect()}
    assert got["gone"].error == "image not found" and got[None].data is None
    for k in bodies:
        if k != "short":  # the source keeps what it could read of a cut file
            assert tuple(got[k]) == tuple(want[k]), k
    wide = decode_png(_png(rng.integers(0, 65536, (4, 5, 3)).astype(np.uint16), 2, [0, 4], bits=16))
    assert wide.shape == (4, 5, 3)


def test_read_ahead_is_bounded_and_in_order(tmp_path):
    from boxframe.sources.fs import Stores

    for i in range(30):
        (tmp_path / str(i)).write_bytes(bytes([i]))
    taken = []

    def paths():
        for i in range(30):
            taken.append(i)
            yield f"{tmp_path}/{i}"

    for n, body in enumerate(fetch.read_ahead(paths(), Stores(), ahead=3)):
        assert body == bytes([n]) and len(taken) <= n + 4


def _exchanges(df) -> list[str]:
    formatted = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [part for part in formatted.split("\n\n") if ") Exchange" in part or ") BroadcastExchange" in part]


@pytest.mark.parametrize("name", ["training_images", "loader_batches"])
def test_no_pixels_in_any_exchange(spark, name):
    parts = _exchanges(catalog.run(spark, SF_SMALL, name))
    assert parts
    for part in parts:
        inputs = part.split("Input [")[1].split("]")[0]
        names = {c.strip().split("#")[0] for c in inputs.split(":", 1)[1].split(",")} if ":" in inputs else set()
        assert not names & {"data", "tensor", "tensors", "image"}, part


def test_preprocess_job_reads_pixels_late(spark, tmp_path, monkeypatch):
    """No table that the job writes on its way, and no exchange, holds pixels; the session keeps its batch size."""
    from boxframe.plans import jobs

    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"i{k}.png").write_bytes(encode_png(np.full((10 + k, 20, 3), k, np.uint8)))
    csv = tmp_path / "a.csv"
    csv.write_text("ImageID,XMin,YMin,XMax,YMax,LabelName\n" + "".join(f"i{k},0.1,0.1,0.5,0.5,/m/a\n" for k in range(7)))
    seen = []
    cut = jobs.cut_lineage

    def watch(df, name="table"):
        seen.extend(_exchanges(df))
        return cut(df, name)

    monkeypatch.setattr(jobs, "cut_lineage", watch)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = preprocess_job(spark, str(csv), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p"), str(tmp_path / "q"), ext_in=".png")
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert seen and all("data#" not in part for part in seen)
    assert out.processed.count() == 6 and [(r.ImageID, r.error) for r in out.quarantine.collect()] == [("i6", "image not found")]


def test_load_batches_moves_failures_out(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(encode_png(np.full((2, 3, 3), [0, 0, 255], np.uint8)))
    (tmp_path / "b.png").write_bytes(b"broken")
    items = spark.createDataFrame([(0, [("a", 1), ("b", 2), ("c", 3)]), (1, [("b", 1)]), (2, [])], "shard int, items array<struct<ImageID:string,n:int>>")
    got = {r.shard: r for r in load_batches(items, str(tmp_path)).collect()}
    assert [tuple(i) for i in got[0]["items"]] == [("a", 1)] and got[0].failed == ["b", "c"]
    assert got[0].shapes == [[3, 2, 3]] and got[0].tensors[0][:6] == [1.0] * 6 and set(got[0].tensors[0][6:]) == {0.0}
    assert got[1].n_items == 0 and got[2].failed == []


def test_a_callers_decoder(spark, tmp_path):
    (tmp_path / "x.raw").write_bytes(bytes(range(12)))
    ids = spark.createDataFrame([("x",)], "ImageID string")
    row = fetch_images(image_paths(ids, str(tmp_path), ".raw"), decoder=lambda b: np.frombuffer(b, np.uint8).reshape(2, 2, 3)).first()
    assert (row.height, row.width, row.nChannels, bytes(row.data)) == (2, 2, 3, bytes(range(12)))


# ----------------------------------------------------------------- listings


def test_walk_lists_all_levels(spark, tmp_path):
    want = {}
    for d in ("", "a", "a/b", "a/b/c", "d d", "empty"):
        (tmp_path / d).mkdir(parents=True, exist_ok=True)
        for k in range(3 if d != "empty" else 0):
            p = tmp_path / d / f"f{k}é.png"
            p.write_bytes(b"x" * (k + 1))
            want[str(p)] = k + 1
    assert {r.path: r.length for r in walk(spark, str(tmp_path)).collect()} == want
    flat = {r.path for r in walk(spark, str(tmp_path), recursive=False).collect()}
    assert flat == {p for p in want if p.rsplit("/", 1)[0] == str(tmp_path)}
    assert walk(spark, str(tmp_path / "none")).collect() == []
    assert {r.path for r in walk(spark, f"file://{tmp_path}").collect()} == {f"file://{p}" for p in want}


def test_folders_are_dealt_over_partitions(spark, tmp_path):
    """Each folder is listed once; a level of many folders takes many tasks."""
    for k in range(40):
        (tmp_path / f"d{k}").mkdir()
        (tmp_path / f"d{k}" / "x.png").write_bytes(b"1")
    reader = LevelReader({"prefixes": __import__("json").dumps([f"{tmp_path}/d{k}" for k in range(40)]), "per_task": "4"})
    parts = reader.partitions()
    assert len(parts) == 10 and sorted(u for p in parts for u in p.uris) == sorted(f"{tmp_path}/d{k}" for k in range(40))
    assert [b.num_rows for b in reader.read(parts[0])] == [4]
    found = walk(spark, str(tmp_path), per_task=4)
    assert found.count() == 40 and found.select(F.countDistinct("path")).first()[0] == 40


def test_tensors_can_be_used_in_the_pass_that_makes_them(spark, tmp_path, monkeypatch):
    """what follows the tensors runs in the same Python pass, over several training batches at a time, with equal rows."""
    rng = np.random.default_rng(6)
    for k in range(40):
        shape = [(3 + k % 5, 4, 3), (2, 3), (2, 5, 4)][k % 3]
        (tmp_path / f"i{k}.png").write_bytes(encode_png(rng.integers(0, 256, shape, np.uint8)) if k % 11 else b"broken")
    rows = [(s, [(f"i{(7 * s + j) % 44}", j) for j in range(s % 6)] if s % 7 else None) for s in range(30)]
    items = spark.createDataFrame(rows, "shard int, items array<struct<ImageID:string,n:int>>").repartition(2)
    monkeypatch.setattr(fetch, "LOADED_BYTES", 500)
    whole = {r.shard: r for r in load_batches(items, str(tmp_path)).collect()}
    assert set(whole) == set(range(30))
    for s, wanted in rows:
        wanted = wanted or []
        good = [i for i in wanted if int(i[0][1:]) < 40 and int(i[0][1:]) % 11]
        r = whole[s]
        assert [tuple(i) for i in r["items"]] == good and r.n_items == len(good) and r.failed == [i[0] for i in wanted if i not in good]
        for (name, _), shape, tensor in zip(good, r.shapes, r.tensors):
            px = decode_png((tmp_path / f"{name}.png").read_bytes())
            px = np.repeat(px[..., None], 3, 2) if px.ndim == 2 else px[..., :3]
            want = np.transpose(px[..., ::-1], (2, 0, 1)).astype(np.float32) / np.float32(255)
            assert shape == list(want.shape) and np.array_equal(np.array(tensor, np.float32), want.ravel())

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("n_items"), pa.array([sum(map(len, t)) for t in part.column("tensors").to_pylist()], pa.int64())], names=["shard", "n_items", "n"])

    got = {r.shard: (r.n_items, r.n) for r in load_batches(items, str(tmp_path), then=(sizes, "shard int, n_items int, n bigint")).collect()}
    assert got == {s: (r.n_items, sum(map(len, r.tensors))) for s, r in whole.items()}


def test_no_tensor_leaves_the_pass_of_loader_batches(spark):
    """a 24 KB tensor an image went through Spark's rows, to be counted there."""
    plan = catalog.run(spark, SF_SMALL, "loader_batches")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "n_values" in plan and "tensors" not in plan


def test_packs_stay_open(tmp_path, monkeypatch):
    """a training batch's images lie in many packs, which are not opened for each."""
    from boxframe.sources import packs
    from boxframe.sources.fs import Stores

    root, places = f"{tmp_path}/x.pack", []
    for k in range(5):
        pack = packs.PackWriter(root, f"p{k}")
        for i in range(4):
            places.append((f"{root}/p{k}.bin!{pack.at}+2/{i}", bytes([k, i])))
            pack.add(str(i), bytes([k, i]))
        pack.close()
    opened = []

    class Counted(Stores):
        def resolve(self, uri):
            opened.append(uri)
            return super().resolve(uri)

    for most, times in ((256, 5), (2, 20)):
        monkeypatch.setattr(packs, "OPEN", most)
        opened.clear()
        reader = packs.PackReader(Counted())
        assert [reader.read(p) for i in range(4) for p, _ in places[i::4]] == [b for i in range(4) for _, b in places[i::4]]
        assert len(opened) == times and len(reader.files) == min(most, 5)


def test_cores_get_as_many_tasks_each(spark):
    """one task more than cores took twice as long as half of one less."""
    cores = spark.sparkContext.defaultParallelism
    for n, per_task, tasks in ((cores * 10 + 1, 10, 2 * cores), (cores * 10, 10, cores), (5 * cores, 100, cores), (1, 10, 1), (0, 10, 1)):
        rows = spark.range(n).select(F.col("id").cast("string").alias("path"))
        assert fetch.spread(rows, per_task).rdd.getNumPartitions() <= tasks
        assert fetch.spread(rows.withColumnRenamed("path", "x"), per_task).rdd.getNumPartitions() == tasks
        assert fetch.spread(rows, per_task).count() == n
