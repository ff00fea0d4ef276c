"""A sink that copies objects and publishes its manifest only when the whole job commits.

Tasks copy to attempt names under ``_attempts/{run}`` of the target folder and
rename; each writes its manifest rows to a part of its own there. The driver's
``commit`` publishes the parts of the successful attempts, so the manifest has
one row per object however often tasks ran, and removes the attempts folders;
``abort`` only removes them. What a killed task left goes with the folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from boxframe.functions.ids import object_key
from boxframe.schemas import MANIFEST
from boxframe.session import ship_package
from boxframe.sources.fs import Stores, arrow_fs
from boxframe.sources.packs import PackReader, PackWriter, body_of, is_pack

COLUMNS = ("split", "image_id", "src", "dst")
PARTS = pa.schema([*[(c, pa.string()) for c in COLUMNS], ("ok", pa.bool_()), ("bytes", pa.int64()), ("error", pa.string())])
CHUNK = 1 << 22


def copy_one(stores: Stores, src: str, dst: str, attempt: str, made: set[str]) -> int:
    """Copy ``src`` to ``dst`` by way of ``attempt`` (a path of the same store); the number of bytes."""
    from pyarrow import fs as pafs

    source, path = stores.resolve(src)
    target, final = stores.resolve(dst)
    info = source.get_file_info(path)
    if info.type != pafs.FileType.File:
        raise FileNotFoundError(src)
    for folder in (attempt.rsplit("/", 1)[0], final.rsplit("/", 1)[0]):
        if folder not in made:
            target.create_dir(folder, recursive=True)
            made.add(folder)
    with source.open_input_stream(path) as r, target.open_output_stream(attempt) as w:
        while chunk := r.read(CHUNK):
            w.write(chunk)
    if target.get_file_info(attempt).size != info.size:
        raise OSError("length mismatch after copy")
    target.move(attempt, final)
    return int(info.size)


@dataclass
class Part(WriterCommitMessage):
    name: str  # of the attempt's manifest part
    moves: list[tuple[str, str]] | None = None  # of its pack's files


class CopyWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.run = uuid.uuid4().hex
        self.dst_root, self.manifest = options["dst_root"].rstrip("/"), options["manifest"].rstrip("/")
        self.stores = json.loads(options["stores"]) if options.get("stores") else None

    def _attempts(self, root: str) -> str:
        return f"{root}/_attempts/{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        stores, made = Stores(self.stores), set()
        packs = PackReader(stores)
        own = uuid.uuid4().hex
        # A task's objects of a packed folder are one pack, published with the manifest.
        pack = PackWriter(self.dst_root, own, self.stores, f"_attempts/{self.run}") if is_pack(self.dst_root) else None
        attempts = stores.resolve(self._attempts(self.dst_root))[1]
        fs, folder = arrow_fs(self._attempts(self.manifest), self.stores)
        fs.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.parquet"
        with fs.open_output_stream(f"{folder}/{name}") as out, pq.ParquetWriter(out, PARTS) as parts:
            for batch in iterator:
                found = {c: batch.column(c).to_pylist() for c in COLUMNS}
                ok, sizes, errors = [], [], []
                places = batch.column("at").to_pylist() if "at" in batch.schema.names else [None] * batch.num_rows
                for src, dst, at in zip(found["src"], found["dst"], places):
                    try:
                        if pack:
                            body = body_of(src, at, packs, stores)
                            pack.add(dst[len(self.dst_root) + 1 :], body)
                            sizes.append(len(body)), ok.append(True), errors.append(None)
                            continue
                        if at is not None:
                            raise ValueError(f"{self.dst_root}: copies of packed objects go to a packed folder")
                        sizes.append(copy_one(stores, src, dst, f"{attempts}/{uuid.uuid4().hex}", made))
                        ok.append(True), errors.append(None)
                    except Exception as e:  # noqa: BLE001 - the manifest records it
                        ok.append(False), sizes.append(None), errors.append(f"{type(e).__name__}: {e}")
                parts.write_batch(pa.RecordBatch.from_pydict(found | {"ok": ok, "bytes": sizes, "error": errors}, schema=PARTS))
        if pack:
            pack.finish()
        return Part(name, pack and pack.moves())

    def commit(self, messages: list[Part | None]) -> None:
        fs, folder = arrow_fs(self._attempts(self.manifest), self.stores)
        target = arrow_fs(self.manifest, self.stores)[1]
        for message in messages:
            if message is not None:
                for file, final in message.moves or ():
                    arrow_fs(self.dst_root, self.stores)[0].move(file, final)
                fs.move(f"{folder}/{message.name}", f"{target}/{message.name}")
        self._clean()

    def abort(self, messages: list[Part | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        from pyarrow import fs as pafs

        for root in {self.manifest, self.dst_root}:
            fs, folder = arrow_fs(self._attempts(root), self.stores)
            if fs.get_file_info(folder).type == pafs.FileType.Directory:
                fs.delete_dir(folder)
            parent = folder.rsplit("/", 1)[0]
            if fs.get_file_info(parent).type == pafs.FileType.Directory and not fs.get_file_info(pafs.FileSelector(parent)):
                fs.delete_dir(parent)


class ObjectCopy(DataSource):
    """``df.write.format("object_copy")``: rows ``split, image_id, src, dst, at`` (``at``: the address of a packed source); options ``dst_root``, ``manifest``, ``stores``."""

    @classmethod
    def name(cls) -> str:
        return "object_copy"

    def schema(self) -> str:
        return "split string, image_id string, src string, dst string, at string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return CopyWriter(self.options)


def copy_with_manifest(parsed: DataFrame, src_root: str, dst_root: str, manifest: str, ext: str = ".jpg", src_by_split: bool = True,
                       num_partitions: int | None = None, options: dict | None = None) -> DataFrame:
    """Copy the listed objects (see ``transfer.copy_objects``) as one job; returns the manifest it published.

    A packed source needs a packed target. Duplicates are copied once; a run adds its rows to the manifest folder.
    """
    spark = parsed.sparkSession
    ship_package(spark)
    spark.dataSource.register(ObjectCopy)
    d = parsed.select("split", "image_id").dropDuplicates(["split", "image_id"])
    rows = d.select("split", "image_id", object_key(src_root, "split" if src_by_split else None, "image_id", ext).alias("src"),
                    object_key(dst_root, "split", "image_id", ext).alias("dst"))
    from boxframe.operators.transfer import with_places

    rows = with_places(rows, src_root, "split" if src_by_split else None, ext)
    writer = rows.repartition(num_partitions or spark.sparkContext.defaultParallelism, "src").write.format("object_copy")
    writer = writer.option("dst_root", dst_root).option("manifest", manifest)
    if options:
        writer = writer.option("stores", json.dumps(options))
    writer.mode("append").save()
    return spark.read.schema(MANIFEST).parquet(manifest)
