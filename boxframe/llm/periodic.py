"""Periodic runs of words: scale-tiled search in the tasks, fragments stitched by a shuffle on (document, period).

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``max(least, 2q)`` words that no neighbouring word
extends. A document can hold runs of any period up to half its length, so the
search goes by octaves of the period:

1. Tiles. For the periods ``P <= q < 2P`` a document is cut into overlapping
   tiles of about ``max(TILE, 4P)`` words, each with a margin of ``2P`` words
   before and ``4P`` behind. A tile is solved without the others.
2. Boundaries. Within a tile, a boundary stands every ``stride(P)`` words. The
   first boundary in a run of period ``q`` has a known number of words that
   equal those ``q`` further on; one comparison of whole arrays finds the
   (boundary, period) pairs that do. At these boundaries two Z-functions, of the
   words behind the boundary and, backwards, of the words before it, say how far
   each period reaches to both sides. A reach of ``q`` words or more together
   is a fragment of a run. Blocks that are themselves powers are left to
   their shorter period.
3. Stitching. Fragments go out as intervals of positions that match the word
   ``q`` further on. Intervals of one run overlap or touch, those of different
   runs of one period don't, so Spark sorts the fragments of (document, period)
   and merges them; lengths are judged on whole runs only.

Each octave costs time in proportion to the text, periods included, also for
texts that are one repeated word: inside a stretch of period ``p`` longer
periods can't start a run (Fine and Wilf), so covered boundaries are skipped.

Defined cases: NULL text is no words; NULL ids are allowed; rows of one id with
different texts are told apart by a hash of the text, equal rows give equal
results; other columns are ignored, whatever their names; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.common import map_arrow, slices

#: Words per tile, margins not counted.
TILE = 16_384
SLICE_CHARS = 2_000_000
RUN = "struct<start:bigint,period:bigint,length:bigint>"
Rewrite = Callable[[object, list[bytes]], list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and the five ASCII control blanks, in UTF-8 (``bytes.split`` knows just these blanks)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def z_array(s: list[int], upto: int) -> list[int]:
    """``z[i]``: how many items of ``s`` from ``i`` on equal those from 0 on, for ``0 < i < upto``."""
    n, z, left, right = len(s), [0] * upto, 0, 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _sure(period: np.ndarray, step: int, least: int) -> np.ndarray:
    """How many words at the first boundary of a run of this period equal those a period further on, at least."""
    return np.maximum(least, 2 * period) - step - period + 1


def stride(octave: int, least: int) -> int:
    """Words between boundaries: half the octave, less where short runs would leave the filter fewer than 5 words."""
    step = max(octave // 2, 4)
    periods = np.arange(octave, 2 * octave)
    while step > 1 and _sure(periods, step, least).min() < 5:
        step //= 2
    return step


def _steps(q: int) -> list[int]:
    """``q`` divided by each of its prime divisors."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return [*out, q // rest] if rest > 1 else out


def _reach(w: np.ndarray, at: int, q: int, end: int) -> int:
    """First position from ``at`` on, up to ``end``, whose word differs from the one ``q`` before it."""
    step = 64
    while at < end:
        stop = min(end, at + step)
        differ = w[at:stop] != w[at - q : stop - q]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = stop, step * 4
    return end


def _reach_back(w: np.ndarray, at: int, q: int, start: int) -> int:
    """The same backwards: the smallest position down to ``start`` from which all words equal those ``q`` behind them."""
    step = 64
    while at > start:
        stop = max(start, at - step)
        differ = w[stop:at] != w[stop + q : at + q]
        k = int(differ[::-1].argmax())
        if differ[len(differ) - 1 - k]:
            return at - k
        at, step = stop, step * 4
    return start


def _solve_tile(w: np.ndarray, lo: int, hi: int, hits: list[tuple[int, list[int]]], octave: int, least: int,
                open_left: bool, open_right: bool) -> list[tuple[int, int, int]]:
    """``(period, first, end)`` of the stretches of a tile ``w[lo:hi]`` at the boundaries and periods of ``hits``.

    Stretches that end at an open side of the tile are fragments and kept
    whatever their length; others must be whole runs.
    """
    out: list[tuple[int, int, int]] = []
    known: dict[int, tuple[int, int]] = {}
    cover = (0, 0, 0)  # period and extent of the stretch that covered the last boundary's surroundings
    before, behind = 2 * octave, 4 * octave
    for c, periods in hits:
        near, far = max(lo, c - before), min(hi, c + behind)
        todo = [q for q in periods if not (q in known and known[q][0] <= c and known[q][1] > c + q)]
        if cover[0] and cover[1] <= near and cover[2] >= far:
            todo = [q for q in todo if q < cover[0]]
        if not todo:
            continue
        top = min(far, c + 2 * octave)
        z = z_array(w[c:far].tolist(), top - c)
        back = w[near:c][::-1].tolist()
        zb = z_array([*back, -1, *w[near:top][::-1].tolist()], len(back) + 1 + top - c)
        for q in todo:
            if q >= top - c or (cover[0] and q >= cover[0] and cover[1] <= near and cover[2] >= far):
                continue
            right, left = z[q], zb[len(back) + 1 + top - c - q]
            if left + right < q:
                continue
            first, end = c - left, c + q + right
            if first == near > lo:
                first = _reach_back(w, first, q, lo)
            if end == far < hi:
                end = _reach(w, end, q, hi)
            known[q] = (first, end)
            if first <= near and end >= far:
                cover = (q, first, end)
            if any(z[d] >= q - d for d in _steps(q)):
                continue  # the block is a power of a shorter one
            cut = (open_left and first == lo) or (open_right and end == hi)
            if cut or end - first >= max(least, 2 * q):
                out.append((q, first, end))
    return out


def fragments(texts: list[np.ndarray], least: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """``(text, period, first, last)``: positions from ``first`` to before ``last`` match the word a period further on.

    ``texts`` are word codes. All tiles of an octave are laid end to end, so
    that one comparison of arrays serves all texts.
    """
    longest = max((len(x) for x in texts), default=0)
    octave = 1
    while max(least, 2 * octave) <= longest:
        step = stride(octave, least)
        size = max(tile, 4 * octave) // step * step
        # Margins: twice the octave before, four times behind, and a few words for the short-run rule.
        before, behind = -(-(2 * octave + least) // step) * step, 4 * octave + least + step
        parts, where, place = [], [], 0
        for i, codes in enumerate(texts):
            n = len(codes)
            if n < max(least, 2 * octave):
                continue
            for own in range(0, n, size):
                start, stop = max(0, own - before), min(n, own + size + behind)
                room = -(-(stop - start) // step) * step
                piece = np.full(room, -1, np.int32)
                piece[: stop - start] = codes[start:stop]
                parts.append(piece)
                where.append((i, place, start, stop, own, min(own + size, n), n))
                place += room
        if parts:
            yield from _solve_octave(np.concatenate(parts), where, octave, step, least)
        octave *= 2


def _solve_octave(w: np.ndarray, where: list[tuple], octave: int, step: int, least: int) -> Iterator[tuple[int, int, int, int]]:
    n, count = len(w), len(w) // step
    limit, low = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for k, (_, place, start, stop, own, own_end, _) in enumerate(where):
        a, b = (place + own - start) // step, (place + own_end - start + step - 1) // step
        limit[a:b] = place + stop - start
        low[a:b] = k
    wide = np.concatenate((w, np.full(2 * octave + 8, -2, np.int32)))
    ahead = np.lib.stride_tricks.as_strided(wide[octave:], (count, octave), (step * 4, 4))
    block = max(1, 4_000_000 // octave)
    found_c, found_q = [], []
    for at in range(0, count, block):
        rows, shift = np.nonzero(ahead[at : at + block] == wide[at * step : min(at + block, count) * step : step, None])
        c, q = (rows + at) * step, shift + octave
        sure = _sure(q, step, least)
        keep = c + q + sure <= limit[c // step]
        c, q, sure = c[keep], q[keep], sure[keep]
        for k in range(1, 8):
            keep = (k >= sure) | (wide[c + k] == wide[np.minimum(c + q + k, n)])
            c, q, sure = c[keep], q[keep], sure[keep]
        found_c.append(c), found_q.append(q)
    c, q = np.concatenate(found_c), np.concatenate(found_q)
    if not len(c):
        return
    edges = np.flatnonzero(np.diff(c, prepend=-1)).tolist()
    tiles: dict[int, list[tuple[int, list[int]]]] = {}
    for a, b in zip(edges, [*edges[1:], len(c)]):
        at = int(c[a])
        tiles.setdefault(int(low[at // step]), []).append((at, q[a:b].tolist()))
    for k, hits in tiles.items():
        i, place, start, stop, _, _, length = where[k]
        move = start - place
        for period, first, end in _solve_tile(w, place, place + stop - start, hits, octave, least, start > 0, stop < length):
            yield i, period, first + move, end + move - period


def _search(least: int, tile: int, rewrite: Rewrite | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_CHARS):
            ids, hashes = batch.column(0), batch.column(1)
            names: dict[bytes, int] = {}
            texts = []
            for key, text in zip(ids.to_pylist() if rewrite else ids, batch.column(2).to_pylist()):
                words = words_of(text)
                if rewrite and words:
                    words = rewrite(key, words)
                texts.append(np.fromiter((names.setdefault(x, len(names)) for x in words), np.int32, len(words)))
            rows = list(fragments(texts, least, tile))
            if rows:
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), hashes.take(at), *[pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]],
                    names=["doc_id", "_text", "period", "first", "last"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("_text"), F.col("text").cast("string").alias("text"))


def find_runs(docs: DataFrame, least: int = 12, rewrite: Rewrite | None = None, tile: int = TILE) -> DataFrame:
    """``doc_id, _text, start, period, length``: every run of ``docs`` (doc_id, text), one row each.

    ``_text`` is the text's xxhash64. ``rewrite(doc_id, words)`` may change a
    document's words (UTF-8) before the search.
    """
    keyed = _keyed(docs)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    found = map_arrow(keyed, _search(least, tile, rewrite),
                      f"doc_id {kind}, _text bigint, period bigint, first bigint, last bigint")
    order = Window.partitionBy("doc_id", "_text", "period").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("_new", F.when(reached.isNull() | (F.col("first") > reached), 1).otherwise(0))
    marked = marked.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy("doc_id", "_text", "period", "_run").agg(F.min("first").alias("start"), F.max("last").alias("_last"))
    runs = runs.withColumn("length", F.col("_last") + F.col("period") - F.col("start"))
    long = F.col("length") >= F.greatest(F.lit(least), 2 * F.col("period"))
    return runs.where(long).select("doc_id", "_text", "start", "period", "length")


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """``words`` without those that a run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int32)
    for r in runs:
        gone[r["start"] + r["period"]] += 1
        gone[r["start"] + r["length"]] -= 1
    return [x for x, g in zip(words, np.cumsum(gone).tolist()) if not g]


def _collapse(rewrite: Rewrite | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_CHARS):
            ids = batch.column(0)
            texts = []
            for key, text, runs in zip(ids.to_pylist() if rewrite else ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text)
                if rewrite and words:
                    words = rewrite(key, words)
                texts.append(b" ".join(kept_words(words, runs or [])).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([ids, batch.column(2), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])

    return run


def collapse(docs: DataFrame, least: int = 12, rewrite: Rewrite | None = None, tile: int = TILE) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row of ``docs``.

    ``runs`` are structs (start, period, length) by start, then period, empty
    without any; ``collapsed`` is the words outside of repeats (a run keeps its
    first period), joined by one space. A document's runs are fewer than its words.
    """
    keyed = _keyed(docs)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    listed = find_runs(docs, least, rewrite, tile).groupBy("doc_id", "_text").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    listed = listed.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "runs")
    both = keyed.join(listed, keyed["doc_id"].eqNullSafe(listed["_id"]) & (keyed["_text"] == listed["_hash"]), "left")
    both = both.select("doc_id", "text", F.coalesce("runs", F.array().cast(f"array<{RUN}>")).alias("runs"))
    return map_arrow(both, _collapse(rewrite), f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def report(collapsed: DataFrame) -> DataFrame:
    """Digests of ``collapse``: number of runs, the longest one (ties: smallest start, then period), two SHA-256."""

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    top = collapsed.withColumn("_best", F.when(F.size("runs") > 0, best))
    length, period = F.col("_best.length"), -F.col("_best.p")
    return top.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.s")).alias("start"), length.alias("length"),
        period.alias("period"), F.expr("(1000 * _best.length) div (-_best.p)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
