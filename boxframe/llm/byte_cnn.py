"""Quality by a convolutional network over a text's bytes, written in numpy.

A byte is looked up in a table of ``DIM`` numbers; ``FILTERS`` learned filters
of ``WIDTH`` bytes are laid over the text every ``STEP`` bytes. The text is
covered by overlapping chunks of ``2 * BLOCK`` bytes, one every ``BLOCK`` bytes;
each filter's largest answer in a chunk (max pooling, negatives are zero) and
the logarithm of the chunk's bytes are its features. A hidden layer combines
them (so few active filters in a full chunk, a repeated word, can count); the
mean of the chunks' hidden units goes through a linear layer and the logistic
function into one probability. Whole texts are scored, a convolution at a time
over bounded slices of texts.

Table, filters and layers are learned together (Adam, logistic loss; the
gradient reaches a filter at each chunk's largest answer; both classes weigh
``Fit.balance`` between their true sizes, 0, and equal shares, 1). The fit takes at
most ``Fit.per_class`` labelled rows of each class, chosen by a hash of their
id, and of each text at most
``Fit.pieces`` chunks spread by hash over the whole text, so what reaches
the driver is bounded by about ``2 * per_class * pieces`` kilobytes.

Defined cases: NULL text is the empty text, which is one chunk without bytes;
NULL ids are never trained on; of rows with one id one is trained on (that of the
smallest text hash), all are scored; labels repeated for an id count once (the
smallest); labels other than 0 and 1 are left out; without labels of both
classes the score is the label's rate. Other columns are carried through
``score`` untouched unless they are named like its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import map_arrow, slices, worker_state

DIM, WIDTH, STEP, FILTERS, HIDDEN = 8, 16, 4, 48, 24
BLOCK = 512
LEAD = WIDTH - STEP  # zeros before a text, so that no window sees two texts
PIECE = 2 * BLOCK + LEAD  # bytes that the windows of a chunk see
GROUPS = WIDTH // STEP


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit: bounds of the sample, passes, steps."""

    per_class: int = 1_200
    pieces: int = 4
    passes: int = 12
    batch: int = 64  # texts
    rate: float = 0.008
    l2: float = 1e-4
    balance: float = 0.5
    seed: int = 7


@dataclass
class Network:
    table: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    shift: np.ndarray  # FILTERS
    hidden: np.ndarray  # FILTERS + 2 x HIDDEN, the last two rows for the logarithm of the bytes and a constant
    layer: np.ndarray  # HIDDEN
    bias: float
    mark: str = field(default_factory=lambda: uuid4().hex)


def answers(net: Network, data: np.ndarray) -> np.ndarray:
    """Every filter's answer at every ``STEP``-th byte of ``data`` (bytes, of a multiple of ``STEP``)."""
    x = net.table[data].reshape(-1, STEP * DIM)
    rows = len(x) - GROUPS + 1
    out = x[:rows] @ net.filters[: STEP * DIM]
    for g in range(1, GROUPS):
        out += x[g : g + rows] @ net.filters[g * STEP * DIM : (g + 1) * STEP * DIM]
    return out


def hidden_units(net: Network, peaks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's features (pooled filters, logarithm of its bytes, 1) and hidden units."""
    feats = np.column_stack((peaks, np.log1p(sizes) / 7, np.ones(len(peaks)))).astype(np.float64)
    return feats, np.maximum(feats @ net.hidden.astype(np.float64), 0)


def probabilities(net: Network, texts: list[bytes], part: int = 128) -> np.ndarray:
    """Score of each text. Texts are laid end to end in blocks, ``part`` blocks at a time; zeros separate them."""
    blocks = [-(-(len(t) + LEAD) // BLOCK) for t in texts]
    data = np.zeros(sum(blocks) * BLOCK + LEAD, np.uint8)
    at = 0
    for t, n in zip(texts, blocks):
        data[at + LEAD : at + LEAD + len(t)] = np.frombuffer(t, np.uint8)
        at += n * BLOCK
    total, per = sum(blocks), BLOCK // STEP
    top = np.empty((total, FILTERS), np.float32)
    for a in range(0, total, part):
        b = min(total, a + part)
        got = answers(net, data[a * BLOCK : b * BLOCK + LEAD])
        top[a:b] = got.reshape(b - a, per, FILTERS).max(axis=1)
    ends = np.cumsum(blocks)
    starts = ends - blocks
    # A chunk is a block and the next one of its text; a text of one block is one chunk.
    chunk = top.copy()
    chunk[:-1] = np.maximum(top[:-1], top[1:])
    last = ends - 1
    chunk[last] = top[last]
    many = np.array(blocks) > 1
    sizes = np.minimum(PIECE, np.repeat([len(t) + LEAD for t in texts], blocks) - BLOCK * (np.arange(total) - np.repeat(starts, blocks)))
    units = hidden_units(net, np.maximum(chunk + net.shift, 0), sizes)[1]
    units[last[many]] = 0
    sums = np.add.reduceat(units, starts, axis=0)
    mean = sums / np.maximum(1, np.array(blocks) - 1)[:, None]
    return 1 / (1 + np.exp(-np.clip(mean @ net.layer.astype(np.float64) + net.bias, -40, 40)))


def pieces_of(text: bytes, seed: int, most: int) -> list[bytes]:
    """At most ``most`` of a text's chunks (all of a text with fewer), spread over the whole text, drawn by ``seed``."""
    count = max(1, -(-(len(text) + LEAD) // BLOCK) - 1)
    text = bytes(LEAD) + text
    if count <= most:
        starts = range(count)
    else:
        starts = sorted(np.random.default_rng(seed).choice(count, most, replace=False).tolist())
    return [text[s * BLOCK : s * BLOCK + PIECE] for s in starts]


def fit(pieces: list[list[bytes]], labels: list[int], weights: list[float], how: Fit = Fit()) -> Network:
    """Fit on the chunks, label and weight of each text."""
    y, share = np.array(labels, np.float64), np.array(weights, np.float64)
    rng = np.random.default_rng(how.seed)
    net = Network(rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, 0.25, (WIDTH * DIM, FILTERS)).astype(np.float32),
                  np.zeros(FILTERS, np.float32), rng.normal(0, 0.15, (FILTERS + 2, HIDDEN)).astype(np.float32),
                  rng.normal(0, 0.2, HIDDEN).astype(np.float32), 0.0)
    net.table[0] = 0
    if not len(y) or y.min() == y.max():
        rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        net.layer[:], net.bias = 0, float(np.log(rate / (1 - rate)))
        return net
    share *= len(y) / share.sum()
    params = [net.table, net.filters, net.shift, net.hidden, net.layer, np.zeros(1, np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    rows = PIECE // STEP - GROUPS + 1
    passes = how.passes
    for turn in range(passes):
        order = rng.permutation(len(y))
        for a in range(0, len(order), how.batch):
            chosen = order[a : a + how.batch]
            owner = np.repeat(np.arange(len(chosen)), [len(pieces[i]) for i in chosen])
            data = np.zeros((len(owner), PIECE), np.uint8)
            for r, p in enumerate(p for i in chosen for p in pieces[i]):
                data[r, : len(p)] = np.frombuffer(p, np.uint8)
            x = net.table[data].reshape(len(owner), PIECE // STEP, STEP * DIM)
            out = sum(x[:, g : g + rows] @ net.filters[g * STEP * DIM : (g + 1) * STEP * DIM] for g in range(GROUPS))
            best = out.argmax(axis=1)  # pieces x FILTERS
            peak = np.take_along_axis(out, best[:, None, :], axis=1)[:, 0] + net.shift
            count = np.bincount(owner, minlength=len(chosen))
            feats, units = hidden_units(net, np.maximum(peak, 0), np.array([len(p) for i in chosen for p in pieces[i]]))
            mean = np.zeros((len(chosen), HIDDEN))
            np.add.at(mean, owner, units)
            mean /= count[:, None]
            score = 1 / (1 + np.exp(-(mean @ net.layer + params[5][0])))
            slope = (score - y[chosen]) * share[chosen] / len(chosen)
            inner = (slope[:, None] * net.layer / count[:, None])[owner] * (units > 0)  # pieces x HIDDEN
            back = (inner @ net.hidden[:FILTERS].T) * (peak > 0)  # pieces x FILTERS
            seen = data[np.arange(len(owner))[:, None, None], best[:, :, None] * STEP + np.arange(WIDTH)]  # pieces x FILTERS x WIDTH
            look = net.table[seen].reshape(len(owner), FILTERS, WIDTH * DIM)
            into = back[:, :, None] * net.filters.T[None]  # pieces x FILTERS x WIDTH * DIM
            table = np.zeros_like(net.table)
            flat = into.reshape(-1, DIM)
            for d in range(DIM):
                table[:, d] = np.bincount(seen.ravel(), flat[:, d], 256)
            table[0] = 0
            grads = [table, np.einsum("pf,pfk->kf", back, look), back.sum(axis=0), feats.T @ inner, mean.T @ slope,
                     np.array([slope.sum()])]
            step += 1
            rate = how.rate * min(1.0, 2 * (1 - step / (passes * -(-len(order) // how.batch) + 1)))
            for p, g, m, v in zip(params, grads, first, second):
                g = g + how.l2 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    net.bias = float(params[5][0])
    return net


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column, how: Fit = Fit()) -> Network:
    """Fit on ``docs`` (doc_id, text) whose ``labels`` row (doc_id, ``label``) is 0 or 1 and whose id is ``usable``.

    ``usable`` is a condition on ``doc_id``. The sampled ids (at most twice
    ``per_class``) are joined to the documents, where the chunks are cut.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(usable)
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("_y"))
    sizes = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    mixed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(how.seed))
    chosen = [known.where(F.col("_y") == y).orderBy(mixed, "doc_id").limit(how.per_class) for y in (0, 1)]
    sample = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "_y")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), texts["doc_id"] == sample["_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [pieces_of(t.encode("utf-8", "surrogatepass"), h & (2**63 - 1), how.pieces)
                     for t, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(parts, pa.list_(pa.binary()))],
                                             names=["_key", "_y", "_h", "_parts"])

    rows = map_arrow(found.select(F.col("doc_id").cast("string").alias("_key"), "_y", "text", F.xxhash64("text", "doc_id").alias("_h")), cut,
                     "_key string, _y int, _h bigint, _parts array<binary>")
    rows = rows.groupBy("_key").agg(F.min_by(F.struct("_y", "_parts"), "_h").alias("r")).select("_key", "r.*").collect()
    rows.sort(key=lambda r: r["_key"])
    taken = {y: max(1, sum(r["_y"] == y for r in rows)) for y in (0, 1)}
    return fit([[bytes(p) for p in r["_parts"]] for r in rows], [r["_y"] for r in rows],
               [sizes[r["_y"]] ** (1 - how.balance) / taken[r["_y"]] for r in rows], how)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """All columns of ``docs`` and ``score``: the probability of label 1 for the whole text, to 6 digits."""
    state = docs.sparkSession.sparkContext.broadcast(net)
    kept = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_state(f"byte-cnn-{state.value.mark}", lambda: state.value)
        for batch in slices(batches, "text", 1_000_000):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            got = np.round(probabilities(model, texts), 6)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, "score"])

    named = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"_{i}") for i, c in enumerate(kept)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema)
    return map_arrow(named, run, f"{schema}, score double").toDF(*kept, "score")
