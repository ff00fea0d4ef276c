"""Object listings made by tasks: a data source whose partitions are key prefixes (folders).

One read lists one level below a set of prefixes: each reader partition holds a
few of them, opens its own filesystem handle and returns the names it finds,
files and sub-folders. ``walk`` reads level after level; the sub-folders of a
level are written as a table, and the next read's partitions are cut from it.
So the driver sees folders only, never files, and folders with many sub-folders
spread over the cluster. A folder's own names are listed by one task, in batches;
stores whose client can list parts of a folder plug in by ``lister``. The indexes of a
packed folder (``sources.packs``) are a level of their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from boxframe.session import scratch_path, ship_package
from boxframe.sources.fs import arrow_fs
from boxframe.sources.packs import INDEX, is_pack, list_pack

SCHEMA = "path string, length bigint, folder boolean"
#: Prefixes of a reader partition, and names of a batch.
PER_TASK = 32
BATCH = 10_000
Lister = Callable[[str, dict | None], Iterator[tuple[str, int | None, bool]]]


def list_level(uri: str, options: dict | None = None) -> Iterator[tuple[str, int | None, bool]]:
    """``(path, length, is folder)`` of the names directly below a folder; a missing folder has none."""
    from pyarrow import fs as pafs

    if uri.endswith(INDEX):
        yield from list_pack(uri, options)
        return
    fs, path = arrow_fs(uri, options)
    head = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if is_pack(uri):  # its index files are listed as the next level, by tasks
            if info.path.endswith(INDEX) and not info.base_name.startswith("_"):
                yield head + info.path, info.size, True
        elif info.type in (pafs.FileType.File, pafs.FileType.Directory):
            yield head + info.path, info.size, info.type == pafs.FileType.Directory


class Prefixes(InputPartition):
    def __init__(self, uris: list[str]) -> None:
        super().__init__(None)
        self.uris = uris


class LevelReader(DataSourceReader):
    """Lists the names below the prefixes that the option ``prefixes`` holds as JSON, or that the table ``prefix_table`` has."""

    def __init__(self, options: dict) -> None:
        self.prefixes = json.loads(options.get("prefixes", "[]"))
        self.table = options.get("prefix_table")
        self.per_task = int(options.get("per_task", PER_TASK))
        self.stores = json.loads(options["stores"]) if options.get("stores") else None
        self.lister = options.get("lister", f"{__name__}:list_level")

    def partitions(self) -> list[InputPartition]:
        uris = self.prefixes
        if self.table:
            import pyarrow.dataset as ds

            fs, path = arrow_fs(self.table, self.stores)
            uris = ds.dataset(path, filesystem=fs, format="parquet").to_table(columns=["path"]).column("path").to_pylist()
        return [Prefixes(uris[i : i + self.per_task]) for i in range(0, len(uris), self.per_task)] or [Prefixes([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from importlib import import_module

        module, name = self.lister.split(":")
        lister: Lister = getattr(import_module(module), name)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()))], names=["path", "length", "folder"])

        for uri in partition.uris:
            for row in lister(uri, self.stores):
                rows.append(row)
                if len(rows) >= BATCH:
                    yield batch()
                    rows = []
        yield batch()


class ObjectLevel(DataSource):
    """``spark.read.format("object_level")``: one level of a listing (see ``LevelReader`` for its options)."""

    @classmethod
    def name(cls) -> str:
        return "object_level"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LevelReader(self.options)


def walk(spark: SparkSession, root: str, recursive: bool = True, stores: dict | None = None, per_task: int = PER_TASK,
         lister: str | None = None) -> DataFrame:
    """``path, length`` of the files below ``root``, listed by tasks level by level.

    ``stores`` configures filesystems (see ``sources.fs.arrow_fs``); ``lister``
    (``module:function``) replaces ``list_level`` for other clients. Levels are
    written to the shared checkpoint folder, so a lost executor lists its part of
    one level again.
    """
    ship_package(spark)
    spark.dataSource.register(ObjectLevel)
    reader = spark.read.format("object_level").option("per_task", per_task)
    if stores:
        reader = reader.option("stores", json.dumps(stores))
    if lister:
        reader = reader.option("lister", lister)
    level, files = reader.option("prefixes", json.dumps([root.rstrip("/")])).load(), []
    while True:
        path = scratch_path(spark, "listing")
        level.write.parquet(path)
        table = spark.read.schema(SCHEMA).parquet(path)
        files.append(table.where("not folder").select("path", "length"))
        folders = table.where("folder").select("path")
        if not (recursive or is_pack(root) and len(files) == 1) or not folders.limit(1).count():
            return reduce(DataFrame.unionByName, files)
        wanted = scratch_path(spark, "prefixes")
        folders.write.parquet(wanted)
        level = reader.option("prefixes", "[]").option("prefix_table", wanted).load()
