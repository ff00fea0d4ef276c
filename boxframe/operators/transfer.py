"""Bulk object copy with a per-object manifest, and its summary."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.ids import object_key
from boxframe.schemas import MANIFEST
from boxframe.session import ship_package
from boxframe.sources.packs import is_pack, locate


def _copy_batches(options: dict | None, dst_root: str):
    packed, name = is_pack(dst_root), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not packed:
            yield from _copy_partition(batches, options)
            return
        from pyspark import TaskContext

        from boxframe.sources.packs import PackWriter

        pack = PackWriter(dst_root, f"{name}-{TaskContext.get().partitionId():06d}", options)
        yield from _copy_partition(batches, options, pack, len(dst_root.rstrip("/")) + 1)
        pack.close()

    return run


def _copy_partition(batches: Iterator[pd.DataFrame], options: dict | None = None, pack=None, head: int = 0) -> Iterator[pd.DataFrame]:
    """Copy each ``src`` to ``dst``: temp name, length check, rename.

    One filesystem handle per task and store (scheme and authority). An object
    is always copied: an old target of the same size proves nothing about its
    content. A retried task copies again, to the same bytes. Targets of a packed
    folder go to ``pack``, named by ``dst`` from place ``head`` on; ``at`` has where sources in packs lie.
    """
    from pyarrow import fs as pafs

    from boxframe.sources.fs import Stores
    from boxframe.sources.packs import PackReader, body_of

    stores = Stores(options)
    packs = PackReader(stores)
    resolve = stores.resolve
    made: set[tuple[int, str]] = set()

    for pdf in batches:
        ok, nbytes, errors = [], [], []
        for src, dst, at in zip(pdf["src"], pdf["dst"], pdf["at"]):
            try:
                if pack or at is not None:
                    body = body_of(src, at, packs, stores)
                    if pack:
                        pack.add(dst[head:], body)
                        ok.append(True), nbytes.append(len(body)), errors.append(None)
                        continue
                sfs, spath = resolve(src)
                dfs, dpath = resolve(dst)
                size = len(body) if at is not None else None
                if size is None:
                    info = sfs.get_file_info(spath)
                    if info.type != pafs.FileType.File:
                        raise FileNotFoundError(src)
                    size = info.size
                parent = dpath.rsplit("/", 1)[0]
                if parent and (id(dfs), parent) not in made:
                    dfs.create_dir(parent, recursive=True)
                    made.add((id(dfs), parent))
                tmp = f"{dpath}.tmp-{uuid.uuid4().hex}"
                with pa.BufferReader(body) if at is not None else sfs.open_input_stream(spath) as r, dfs.open_output_stream(tmp) as w:
                    while True:
                        chunk = r.read(1 << 22)
                        if not chunk:
                            break
                        w.write(chunk)
                if dfs.get_file_info(tmp).size != size:
                    dfs.delete_file(tmp)
                    raise OSError("length mismatch after copy")
                dfs.move(tmp, dpath)
                ok.append(True), nbytes.append(int(size)), errors.append(None)
            except Exception as e:  # noqa: BLE001 - the manifest records it
                ok.append(False), nbytes.append(None), errors.append(f"{type(e).__name__}: {e}")
        out = pdf[["split", "image_id", "src", "dst"]].copy()
        out["ok"] = ok
        out["bytes"] = pd.array(nbytes, dtype="Int64")
        out["error"] = errors
        yield out


def copy_objects(parsed: DataFrame, src_root: str, dst_root: str, ext: str = ".jpg",
                 num_partitions: int | None = None, src_by_split: bool = True, options: dict | None = None) -> DataFrame:
    """Copy the listed objects ``{src_root}{split}/{id}{ext}`` -> ``{dst_root}{split}/{id}{ext}``.

    Duplicates are copied once. ``src_by_split=False`` reads a flat source
    folder (``{src_root}{id}{ext}``). ``options`` configures the stores, by
    scheme or ``scheme://authority`` (see ``sources.fs.arrow_fs``). The id list is hash-repartitioned so copies
    spread over all executors; the result is the manifest
    ``split, image_id, src, dst, ok, bytes, error``. Either folder may be packed (``sources.packs``).
    """
    d = parsed.select("split", "image_id").dropDuplicates(["split", "image_id"])
    d = d.select(
        "split",
        "image_id",
        object_key(src_root, "split" if src_by_split else None, "image_id", ext).alias("src"),
        object_key(dst_root, "split", "image_id", ext).alias("dst"),
    )
    d = with_places(d, src_root, "split" if src_by_split else None, ext)
    ship_package(parsed.sparkSession)
    n = num_partitions or parsed.sparkSession.sparkContext.defaultParallelism
    return d.repartition(n, "src").mapInPandas(_copy_batches(options, dst_root), schema=MANIFEST)


def with_places(d: DataFrame, src_root: str, split: str | None, ext: str) -> DataFrame:
    """Objects to copy with ``at``, their address if the source folder is packed, else NULL."""
    if is_pack(src_root):
        return locate(d, src_root, object_key("", split, "image_id", ext), "at")
    return d.withColumn("at", F.lit(None).cast("string"))


def existence_manifest(parsed: DataFrame, listing: DataFrame, prefix: str, ext: str = ".jpg",
                       path_col: str = "path") -> DataFrame:
    """Manifest whose ``ok`` says whether ``{prefix}{id}{ext}`` is in an object listing."""
    hits = listing.select(F.col(path_col).alias("_p")).distinct().withColumn("_hit", F.lit(True))
    key = object_key(prefix, None, "image_id", ext)
    # Lines of one name (an empty id, for one) count once in the join, however many there are.
    names = parsed.select(key.alias("dst")).distinct()
    found = names.join(hits, names["dst"] == hits["_p"], "left").select("dst", F.col("_hit").isNotNull().alias("ok"))
    d = parsed.groupBy("split", "image_id").agg(F.count(F.lit(1)).cast("int").alias("_n")).withColumn("dst", key)
    j = d.join(found, "dst").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return j.select("split", "image_id", "dst", "ok")


def transfer_summary(manifest: DataFrame, by: str | None = "split") -> DataFrame:
    """Successes and totals (per ``by`` column, or overall)."""
    aggs = [F.sum(F.col("ok").cast("int")).cast("bigint").alias("n_ok"), F.count(F.lit(1)).alias("n_total")]
    return manifest.groupBy(by).agg(*aggs) if by else manifest.agg(*aggs)
