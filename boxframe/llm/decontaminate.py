"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document is contaminated by a benchmark item if some stretch of its words is
within edit distance ``(1 - similarity) * n`` of the item's n words (words:
lower-cased runs of letters and digits; of scripts that don't put spaces
between words, every letter). Items of fewer than ``Search.least`` words are
searched without edits.

1. Windows of the item's size are laid over every whole text. By the
   pigeonhole principle a stretch within k edits of n words holds a run of
   ``ceil((n - k) / (k + 1))`` unchanged words of the item, so only windows
   that line up a shared run of that length (3 words at most) with its place
   in an item of their size can match; the others are left out without loss.
2. The CGK random walk embeds windows and items: at step t the current word is
   written, and a random bit of (t, word) tells whether to move on to the next.
   Small edit distances become small Hamming distances.
3. Bit sampling: in each of ``walks * tables`` tables, windows and items meet
   if they agree at ``samples`` sampled positions of the embedding. The number
   of tables sets the recall.
4. Every candidate is verified by the exact edit distance of the item to the
   best stretch around the window (unless the stretch lacks too many of the
   item's words to come within reach).

Items are searched in blocks of bounded size, each broadcast for a pass over
the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from boxframe.llm.common import map_arrow, slices, worker_state

#: Letters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecd\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u17dc\u17dd"
            "\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
            "\U00020000-\U000323af")
WORDS = re.compile(rf"[^\W_{UNSPACED}]+|[{UNSPACED}]")
BLOOM = 1 << 20
SYMBOLS = 256  # words are hashed to so many symbols for the walk's random bits


def hit_type(item: str) -> str:
    """Type of a row's hits; ``item``: type of the item ids."""
    return f"array<struct<item:{item},first:int,last:int,distance:int>>"


@dataclass(frozen=True)
class Search:
    similarity: float = 0.8
    least: int = 5  # words an item must have to be searched with edits
    walks: int = 8
    tables: int = 6
    samples: int = 3
    block: int = 20_000  # items per pass
    seed: int = 7


def edits_allowed(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


def edits_of(n: int, how: Search) -> int:
    """Edits allowed of an item of n words; short items are searched exactly."""
    return edits_allowed(n, how.similarity) if n >= how.least else 0


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of ``text`` nearest to ``item`` in edit distance; ties: the earliest end, then the longest."""

    def rows(p: np.ndarray, t: np.ndarray, free: bool) -> np.ndarray:
        steps = np.arange(len(t) + 1)
        row = np.zeros(len(t) + 1, np.int64) if free else steps
        for i in range(len(p)):
            now = np.empty_like(row)
            now[0] = i + 1
            now[1:] = np.minimum(row[:-1] + (t != p[i]), row[1:] + 1)
            row = np.minimum.accumulate(now - steps) + steps
        return row

    last = rows(item, text, True)
    end = int(last.argmin())
    back = rows(item[::-1], text[:end][::-1], False)
    return int(last[end]), end - int(len(back) - 1 - back[::-1].argmin()), end


class Index:
    """Seeds, embeddings and tables of a block of items."""

    def __init__(self, items: list[tuple[int, str]], how: Search) -> None:
        self.how, self.vocabulary = how, {}
        words = [(i, WORDS.findall((t or "").lower())) for i, t in items]
        words = [(i, w) for i, w in words if w]
        self.ids = [i for i, _ in words]
        self.items = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.int64) for _, w in words]
        self.n = np.array([len(x) for x in self.items], np.int64)
        rng = np.random.default_rng(how.seed)
        longest = 3 * int(self.n.max(initial=1))
        # The walk's random bits; words beyond the vocabulary are symbol 0, never equal to an item's word.
        self.bits = rng.integers(0, 2, (how.walks, longest, SYMBOLS), dtype=np.uint8)
        self.draws = rng.random((how.walks, how.tables, how.samples))
        # What to write of each step: for every size and walk, step -> (table, sample).
        self.wanted: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
        for n in set(self.n.tolist()):
            for w in range(how.walks):
                steps: dict[int, list[tuple[int, int]]] = {}
                for table, sample in np.ndindex(how.tables, how.samples):
                    steps.setdefault(int(self.draws[w, table, sample] * 3 * n), []).append((table, sample))
                self.wanted[n, w] = steps
        self.mix = rng.integers(1, 1 << 62, how.samples + 1, dtype=np.int64) | 1
        # Seeds by run length: sorted keys, and for each key its (item size, offset) places.
        self.seeds = {}
        run = [min(3, -(-(n - edits_of(n, how)) // (edits_of(n, how) + 1))) for n in self.n.tolist()]
        for q in sorted(set(run)):
            rows = [(*x[o : o + q].tolist(), len(x), o) for x, r in zip(self.items, run, strict=True) if r == q for o in range(len(x) - q + 1)]
            rows = np.unique(np.array(rows, np.int64), axis=0)
            keys = self.key(rows[:, :q].T)
            order = np.argsort(keys, kind="stable")
            bloom = np.zeros(BLOOM, bool)
            bloom[keys % BLOOM] = True
            self.seeds[q] = keys[order], rows[order, q], rows[order, q + 1], bloom
        self.tables = {}
        for n in np.unique(self.n).tolist():
            at = np.flatnonzero(self.n == n)
            for w, sig in enumerate(self.signatures(np.stack([self.items[i] for i in at]), n)):
                for t in range(how.tables):
                    order = np.argsort(sig[t], kind="stable")
                    self.tables[n, w, t] = sig[t][order], at[order]

    def key(self, words: np.ndarray) -> np.ndarray:
        """One non-negative number per column of words."""
        out = np.zeros(words.shape[1], np.int64)
        for row in words:
            out = (out * 1_000_003 + row) & 0x3FFFFFFFFFFFFFFF
        return out

    def signatures(self, x: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """For every walk: (tables, rows) of the sampled symbols of the embedded rows of ``x``, each mixed into a number."""
        how = self.how
        padded = np.concatenate([x, np.full((len(x), 1), -1, np.int64)], axis=1)  # behind the end the walk stands still
        rows = np.arange(len(x))
        for w in range(how.walks):
            wanted = self.wanted[n, w]
            out, at = np.zeros((how.tables, len(x)), np.int64), np.zeros(len(x), np.int64)
            for t in range(max(wanted) + 1):
                now = padded[rows, at]
                for table, sample in wanted.get(t, ()):
                    out[table] += (now + 2) * self.mix[sample]
                at = np.minimum(at + self.bits[w, t][now % SYMBOLS], n)
            yield out

    def windows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item size, start) of the windows over ``words`` that a seed lines up with an item of their size."""
        sizes, starts = [], []
        for q, (keys, n, offset, bloom) in self.seeds.items():
            if len(words) < q:
                continue
            key = self.key(np.stack([words[k : len(words) - q + 1 + k] for k in range(q)]))
            at = np.flatnonzero(bloom[key % BLOOM])
            low, high = np.searchsorted(keys, key[at]), np.searchsorted(keys, key[at], side="right")
            count = high - low
            which = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(at) else low
            sizes.append(n[which])
            starts.append(np.repeat(at, count) - offset[which])
        if not sizes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate(sizes), np.concatenate(starts)], axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def search(self, words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Hits over concatenated texts, each ending (and followed by a 0) before its entry in ``ends``: (text, item, first, last, distance)."""
        if not self.items:
            return []
        sizes, starts = self.windows(words)
        # A window belongs to the text of its middle; what lies outside of that text is no word.
        text = np.searchsorted(ends, np.clip(starts + sizes // 2, 0, len(words) - 1), side="right")
        begin = np.concatenate(([0], ends[:-1]))
        pairs = []
        for n in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == n)
            for part in range(0, len(mine), 20_000):
                of = mine[part : part + 20_000]
                where = starts[of][:, None] + np.arange(n)
                inside = (where >= begin[text[of]][:, None]) & (where < ends[text[of]][:, None])
                x = np.where(inside, words[np.clip(where, 0, len(words) - 1)], 0)
                for w, sig in enumerate(self.signatures(x, n)):
                    for t in range(self.how.tables):
                        keys, item = self.tables[n, w, t]
                        low, high = np.searchsorted(keys, sig[t]), np.searchsorted(keys, sig[t], side="right")
                        count = high - low
                        hit = np.flatnonzero(count)
                        for i in range(int(count.max(initial=0))):
                            more = hit[count[hit] > i]
                            pairs.append(np.stack([of[more], item[low[more] + i]], axis=1))
        if not pairs:
            return []
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        plain: dict[int, list[int]] = {}
        for window, item in np.unique(np.concatenate(pairs), axis=0).tolist():
            p, n, d = self.items[item], int(self.n[item]), int(text[window])
            k = edits_of(n, self.how)
            first, last = int(starts[window]), int(starts[window]) + n
            lo, hi = int(begin[d]), int(ends[d])
            if lo <= first and last <= hi and np.array_equal(words[first:last], p):
                got = (0, first - lo, last - lo)
            elif found.get((d, item), (k,))[0] == 0:
                continue
            else:
                a, b = max(lo, first - k), min(hi, last + k)
                # Every word of the item that the stretch lacks is an edit: a bound that loses nothing.
                near = set(words[a:b].tolist())
                if item not in plain:
                    plain[item] = p.tolist()
                if sum([w not in near for w in plain[item]]) > k:
                    continue
                distance, s, e = best_stretch(p, words[a:b])
                if distance > k:
                    continue
                got = (distance, a + s - lo, a + e - lo)
            if (d, item) not in found or got < found[d, item]:
                found[d, item] = got
        return [(d, self.ids[item], s, e - 1, distance) for (d, item), (distance, s, e) in sorted(found.items())]


def scan_block(docs: DataFrame, items: list[tuple], how: Search, text_col: str, id_type: DataType) -> DataFrame:
    """``docs`` with ``__hits``: the block's items found in each row's text."""
    shared, mark = docs.sparkSession.sparkContext.broadcast(items), uuid4().hex
    names, column, id_kind = docs.columns, docs.columns.index(text_col), to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = worker_state(mark, lambda: Index(shared.value, how))
        get = index.vocabulary.get
        for batch in slices(batches, text_col, max_chars=8_000_000, max_rows=20_000):
            words, ends = [], []
            for text in batch.column(column).to_pylist():
                if text:
                    words += [get(w, 0) for w in WORDS.findall(text.lower())]
                ends.append(len(words))
                words += (0, 0, 0)  # no seed runs across texts
            hits: list[list] = [[] for _ in ends]
            at = np.array(ends, np.int64)
            # Texts begin behind the three zeros of the one before; counted from there.
            flat = np.array(words, np.int64)
            begin = np.concatenate(([0], at[:-1] + 3))
            for d, item, first, last, distance in index.search(flat, at + 3):
                assert 0 <= first and last < at[d] - begin[d] + 3
                hits[d].append({"item": item, "first": first, "last": min(last, int(at[d] - begin[d]) - 1), "distance": distance})
            kind = pa.list_(pa.struct([("item", id_kind), ("first", pa.int32()), ("last", pa.int32()), ("distance", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, kind)], [*names, "__hits"])

    schema = ", ".join([*[f"`{c}` {t}" for c, t in docs.dtypes], f"`__hits` {hit_type(id_type.simpleString())}"])
    return map_arrow(docs, run, schema)


def scan(docs: DataFrame, benchmark: DataFrame, how: Search = Search(), text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", hits_col: str = "hits") -> DataFrame:
    """``docs`` (all rows, all columns) with ``hits``: item, first and last word, edit distance of its best match, per item found.

    NULL and empty texts have none. Items with fewer than ``Search.least``
    words are found where all their words stand, in a row; items without words
    or with NULL text are not searched; repeated items are found each. Item ids
    may be of any simple type. A
    column named like ``hits_col`` is replaced. Shuffles nothing; one pass over
    the texts per block of items.
    """
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    id_type = items.schema["i"].dataType
    blocks = max(1, -(-items.count() // how.block))
    out = docs.select(*[c for c in docs.columns if c != hits_col]).withColumn("__all", F.array().cast(hit_type(id_type.simpleString())))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = sorted({(r.i, r.t) for r in part.collect()}, key=lambda x: (x[0] is None, 0 if x[0] is None else x[0], x[1]))
        out = scan_block(out, rows, how, text_col, id_type).withColumn("__all", F.concat("__all", "__hits")).drop("__hits")
    return out.withColumnRenamed("__all", hits_col)


def keep_clean(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """The rows of ``docs`` in which no item was found."""
    return scan(docs, benchmark, how, hits_col="__found").filter(F.size("__found") == 0).select(*docs.columns)
