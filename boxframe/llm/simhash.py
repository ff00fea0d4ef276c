"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into two halves of 32 bits; of two fingerprints
that differ in at most ``2t + 1`` bits, one half differs in at most t. The
anchors of a half are a covering code: the perfect Hamming code of length 31
(covering radius 1) times one free bit. A fingerprint is replicated to every
anchor within radius + t of its half, so the anchor next to either of two
near halves holds both, and fingerprints are compared per anchor only. With
t = 1 (3 bits) that is 17 replicas a half at most, over 2^27 anchors.

Equal fingerprints count once. Per anchor only links that span the linked
fingerprints are kept (a star or a tree, never all pairs). An anchor with more
than ``cell`` fingerprints is cut into chunks, and every pair of chunks becomes
a cell of its own, so no task holds an unbounded group and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import cut_lineage, map_arrow, slices
from boxframe.llm.components import components

SEED = 42
CELL = 2_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned fingerprint of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    ends, n, ones, digest = ends[width - 1 :].tolist(), len(words) - width + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 100_000):
        m = min(100_000, n - at)
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at : at + m], ends[at : at + m], strict=True)), np.uint64, m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``fp`` (the 64 bits as a signed BIGINT), one row per input row; NULL and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            fps = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    return map_arrow(docs.select(docs[id_col], docs[text_col].alias("__text")), run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, fp bigint")


#: For every syndrome of the Hamming code: the flips (as masks of 31 bits) that lead to a code word within two bits.
_FLIPS = [[1 << (s - 1)] + [1 << (i - 1) | 1 << (s ^ i) - 1 for i in range(1, 32) if i < (s ^ i)] if s else [0] for s in range(32)]
#: Parity masks: bit k of the syndrome is the parity of the positions whose number has bit k.
_CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]


def anchors(half: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within ``radius`` (1 or 2) bits of each 32-bit half: (index of the half, anchor).

    The low 31 bits are decoded by the Hamming code; the top bit is free.
    """
    low, top = half & np.uint64(0x7FFFFFFF), half & np.uint64(0x80000000)
    syndrome = np.zeros(len(half), np.int64)
    for k, mask in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(low & np.uint64(mask)) & 1).astype(np.int64) << k
    rows, found = [], []
    for s in range(32):
        at = np.flatnonzero(syndrome == s)
        if not len(at):
            continue
        flips = [(f, 0) for f in _FLIPS[s] if f.bit_count() <= radius]
        flips += [(f, 1) for f in _FLIPS[s] if f.bit_count() + 1 <= radius]
        for f, free in flips:
            rows.append(at)
            found.append((low[at] ^ np.uint64(f)) | (top[at] ^ np.uint64(free << 31)))
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(found) if found else np.zeros(0, np.uint64)


def replicas(prints: DataFrame, bits: int) -> DataFrame:
    """(anchor, fp) for every anchor that a fingerprint is replicated to; the half is the anchor's bit 32."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with a code of radius 1 cover up to 3 bits")
    radius = 1 + bits // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            for start in range(0, len(fps), 20_000):
                part = fps[start : start + 20_000]
                for which in (0, 1):
                    half = part >> np.uint64(32) if which else part & np.uint64(0xFFFFFFFF)
                    rows, found = anchors(half, radius)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((found | np.uint64(which << 32)).view(np.int64)), pa.array(part[rows].view(np.int64))], ["anchor", "fp"])

    return map_arrow(prints.select("fp"), run, "anchor bigint, fp bigint")


def spanning_links(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of ``fps`` (distinct) under at most ``bits`` differing bits: a breadth-first tree."""
    left, a, b = np.ones(len(fps), bool), [], []
    for seed in range(len(fps)):
        if not left[seed]:
            continue
        left[seed], todo = False, [seed]
        while todo:
            i = todo.pop()
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = rest[np.bitwise_count(fps[rest] ^ fps[i]) <= bits]
            left[near] = False
            todo += near.tolist()
            a.append(np.full(len(near), fps[i]))
            b.append(fps[near])
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def compare_cells(cells: Iterator[pa.RecordBatch], bits: int, near: int = 16) -> Iterator[pa.RecordBatch]:
    """Links of sorted (cell key columns..., fp) batches; a cell's rows stand together. Cells may cross batches."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(keys)))
        run = np.repeat(np.arange(len(first)), size)
        large = size > near
        out_a, out_b = [], []
        for d in range(1, near):  # small cells: each row with the next few of its cell
            at = np.flatnonzero((run[d:] == run[:-d]) & ~large[run[d:]]) if len(run) > d else np.zeros(0, np.int64)
            if not len(at):
                break
            hit = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= bits]
            out_a.append(fps[hit])
            out_b.append(fps[hit + d])
        for k in np.flatnonzero(large):
            a, b = spanning_links(np.unique(fps[first[k] : first[k] + size[k]]), bits)
            out_a.append(a)
            out_b.append(b)
        a = np.concatenate(out_a) if out_a else fps[:0]
        b = np.concatenate(out_b) if out_b else fps[:0]
        a, b = a.view(np.int64), b.view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    keys, fps = None, None
    for batch in cells:
        cols = [np.asarray(c).astype(np.int64) for c in batch.columns]
        k, f = np.stack(cols[:-1], axis=1), cols[-1].view(np.uint64)
        keys, fps = (k, f) if keys is None else (np.concatenate([keys, k]), np.concatenate([fps, f]))
        if not len(keys):
            continue
        cut = np.flatnonzero((keys != keys[-1]).any(axis=1))  # the last cell may go on
        cut = cut[-1] + 1 if len(cut) else 0
        if cut:
            yield links(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if keys is not None and len(keys):
        yield links(keys, fps)


def near_links(prints: DataFrame, bits: int = 3, cell: int = CELL) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints of ``prints`` (fp) that differ in at most ``bits`` bits."""
    placed = replicas(prints.select("fp").distinct(), bits)
    counts = placed.groupBy("anchor").count().filter("count > 1")
    counts = cut_lineage(counts.filter(F.col("count") > cell), "heavy")
    heavy = counts.count()
    if heavy:
        chunks = placed.join(counts, "anchor", "left").withColumn("__n", F.ceil(F.coalesce("count", F.lit(1)) / cell).cast("int"))
        own = F.pmod(F.xxhash64("fp"), F.col("__n")).cast("int")
        pairs = chunks.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        cells = pairs.select("anchor", F.least("__own", "__other").alias("i"), F.greatest("__own", "__other").alias("j"), "fp")
    else:
        cells = placed.select("anchor", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    sorted_cells = cells.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", "fp")
    return map_arrow(sorted_cells, lambda batches: compare_cells(batches, bits), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``fp`` and ``component_id`` (the smallest id reachable over links) of every row.

    Texts without words share fingerprint 0 and link like any other. Rows with
    a NULL id get the component of their fingerprint; NULL if no id is
    reachable. Repeated rows give repeated results.
    """
    prints = cut_lineage(fingerprints(docs, shingle, id_col, text_col), "prints")
    roots = components(near_links(prints, bits))
    least = prints.groupBy("fp").agg(F.min(id_col).alias("__id"))
    root = F.coalesce("root", "fp")
    rooted = cut_lineage(least.join(roots, least.fp == roots.node, "left").select("fp", root.alias("__root"), "__id"), "rooted")
    linked = rooted.groupBy("__root").agg(F.min("__id").alias("component_id"))
    by_fp = rooted.join(linked, "__root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(by_fp, prints.fp == F.col("__fp")).select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document per group: the one whose id names the group. Rows with a NULL id stay.

    Repeated rows of one id are copies of each other: one of them stays.
    """
    found = near_duplicates(docs.filter(F.col(id_col).isNotNull()), shingle, bits, id_col, text_col)
    chosen = found.filter(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    kept = docs.join(chosen, id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
