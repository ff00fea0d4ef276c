"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language: its score for a language is a sum of
hashed feature weights (the word, its affixes, its letter n-grams, the lexicon
of frequent words it is in), and neighbouring words are coupled by learned
transitions, so text that switches its language keeps each stretch's own.
Forward-backward gives the words' exact posteriors over whole texts; a text's
language has the largest share of posterior mass, words weighted by letters.

The fit is by gradient ascent on the likelihood of a bounded sample of labelled
texts (``Fit.texts`` a language, chosen by the hash of their id; all languages
that are there). At first all
words of a text bear its label; then each text's words are labelled anew by
the model (leaning to the text's label), so that switches are learned.

Long texts: the words are cut into pieces of 64. The pieces' transfer matrices
give the messages at their borders, and the words within all pieces are then
done at once. That is forward-backward still, without any cut in the chain.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.common import held_out, map_arrow, slices, worker_state

WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
PIECE = 64
CACHE = 500_000
UNKNOWN = "und"


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit."""

    texts: int = 250  # labelled texts per language, at most
    words: int = 4_000  # words of each that are learned from, about; of longer texts windows spread over the whole text
    steps: int = 14  # before and after the words are labelled anew
    rate: float = 0.3
    l2: float = 1e-6
    lexicon: int = 150  # frequent words per language
    lean: float = 1.0  # of a word towards its text's label when labelled anew


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    lexicon: dict[str, tuple[int, ...]]  # word -> languages in whose lexicon it is
    transitions: np.ndarray  # log potentials, from x to


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Buckets of a lower-cased word."""
    framed = f"^{word}$"
    names = [f"w{word}", *[f"p{word[:k]}" for k in (1, 2, 3)], *[f"s{word[-k:]}" for k in (1, 2, 3)]]
    names += [framed[i : i + 3] for i in range(len(word))]
    names += [f"l{k}" for k in lexicon.get(word, ())]
    return [crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in names]


def pieces(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts of these lengths into pieces: (text, first word, words) of each, in order."""
    count = -(-lengths // PIECE)
    text = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(np.cumsum(lengths) - lengths, count) + number * PIECE
    return text, first, np.minimum(PIECE, lengths[text] - number * PIECE)


def grid(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(PIECE, pieces, ...) of the words' values, and where there is a word; elsewhere 1."""
    at = first[None, :] + np.arange(PIECE)[:, None]
    there = np.arange(PIECE)[:, None] < size[None, :]
    out = values[np.where(there, at, 0)]
    out[~there] = 1.0
    return out, there


def messages(e: np.ndarray, there: np.ndarray, p: np.ndarray, into: np.ndarray, outof: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within all pieces: scaled forward and backward messages and the scales, from the messages at their borders."""
    steps, m, k = e.shape
    alpha, scale = np.empty_like(e), np.ones((steps, m))
    a = into
    for s in range(steps):
        a = np.where(there[s][:, None], (a @ p) * e[s], a)
        scale[s] = a.sum(axis=1)
        a = a / scale[s][:, None]
        alpha[s] = a
    beta = np.empty_like(e)
    b = outof
    for s in range(steps - 1, -1, -1):
        beta[s] = b
        b = np.where(there[s][:, None], ((e[s] * b) @ p.T) / scale[s][:, None], b)
        b = b / b.max(axis=1, keepdims=True)
    return alpha, beta, scale


def posteriors(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors (PIECE, pieces, languages) of the words of texts of these lengths; where there is a word; each piece's text and first word."""
    k = emissions.shape[1]
    text, first, size = pieces(lengths)
    e, there = grid(np.exp(emissions - emissions.max(axis=1, keepdims=True)), first, size)
    p = np.exp(transitions - transitions.max())
    m = len(text)
    # The transfer matrix of every piece.
    b = np.broadcast_to(np.eye(k), (m, k, k)).copy()
    for s in range(PIECE):
        b = np.where(there[s][:, None, None], (b.reshape(-1, k) @ p).reshape(m, k, k) * e[s][:, None, :], b)
        if s % 8 == 7:
            b /= b.sum(axis=(1, 2), keepdims=True)
    # Messages at the borders, over the pieces of each text in turn.
    number = np.arange(m) - np.searchsorted(text, text)
    last = np.append(text[1:] != text[:-1], True) if m else np.zeros(0, bool)
    order = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[order], np.arange(number.max(initial=-1) + 2))
    into, outof = np.full((m, k), 1.0 / k), np.ones((m, k))
    for c in range(1, len(cuts) - 1):
        at = order[cuts[c] : cuts[c + 1]]
        x = np.einsum("mi,mij->mj", into[at - 1], b[at - 1])
        into[at] = x / x.sum(axis=1, keepdims=True)
    for c in range(len(cuts) - 2, 0, -1):
        at = order[cuts[c] : cuts[c + 1]]
        x = np.einsum("mij,mj->mi", b[at], outof[at])
        outof[at - 1] = x / x.max(axis=1, keepdims=True)
    assert (outof[last] == 1).all()
    alpha, beta, _ = messages(e, there, p, into, outof)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    post[~there] = 0.0
    return post, there, text, first


def windows_of(words: list[str], most: int) -> list[str]:
    """``words``, or of a longer text windows of ``PIECE`` words (``most`` words in all, about), chosen by the hash of words and place."""
    if len(words) <= most:
        return words
    starts = range(0, len(words), PIECE)
    chosen = sorted(starts, key=lambda a: (crc32(" ".join([str(a), *words[a : a + PIECE]]).encode("utf-8", "surrogatepass")), a))
    return [w for a in sorted(chosen[: max(1, most // PIECE)]) for w in words[a : a + PIECE]]


def fit(texts: list[str], labels: list[str], how: Fit = Fit()) -> Model | None:
    """Fit on labelled texts; None if there is no word to learn from."""
    known = sorted(set(labels))
    number = {x: i for i, x in enumerate(known)}
    vocabulary: dict[str, int] = {}
    words, y, lengths = [], [], []
    seen = [Counter() for _ in known]
    for text, label in zip(texts, labels, strict=True):
        found = windows_of(WORDS.findall(text.lower()), how.words)
        if not found:
            continue
        seen[number[label]].update(set(found))
        words += [vocabulary.setdefault(w, len(vocabulary)) for w in found]
        lengths.append(len(found))
        y.append(number[label])
    if not words:
        return None
    lexicon: dict[str, tuple[int, ...]] = {}
    for i, c in enumerate(seen):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: how.lexicon]:
            lexicon[w] = (*lexicon.get(w, ()), i)
    rows = [features(w, lexicon) for w in vocabulary]
    flat = np.concatenate([np.array(r) for r in rows])
    size = np.array([len(r) for r in rows])
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    word, length, k = np.array(words), np.array(lengths), len(known)
    doc_label = np.repeat(np.array(y), length)
    label = doc_label
    w, t = np.zeros((BUCKETS, k)), np.zeros((k, k))
    gw, gt = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6)
    # Pieces are sequences of their own here.
    text, first, n = pieces(length)
    at = np.minimum(first[None, :] + np.arange(PIECE)[:, None], len(word) - 1)
    for step in range(2 * how.steps):
        scores = np.add.reduceat(w[flat], start, axis=0)
        e = scores[word]
        if step == how.steps:  # label the words anew
            e = e.copy()
            e[np.arange(len(word)), doc_label] += how.lean
            post, there, _, _ = posteriors(e, length, t)
            label = np.empty(len(word), np.int64)
            label[at[there]] = post.argmax(axis=2)[there]
            e = scores[word]
        p = np.exp(t - t.max())
        g, there = grid(np.exp(e - e.max(axis=1, keepdims=True)), first, n)
        alpha, beta, scale = messages(g, there, p, np.full((len(n), k), 1.0 / k), np.ones((len(n), k)))
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        want = np.eye(k)[label[at]]
        grad = np.zeros((len(word), k))
        grad[at[there]] = (want - post)[there]
        # Gradient of the words' scores, then of their features.
        by_word = np.stack([np.bincount(word, grad[:, j], len(vocabulary)) for j in range(k)], axis=1)
        spread = np.repeat(by_word, size, axis=0)
        gradient = np.stack([np.bincount(flat, spread[:, j], BUCKETS) for j in range(k)], axis=1) / len(word) - how.l2 * w
        pair = np.zeros((k, k))
        for s in range(1, PIECE):
            x = (alpha[s - 1][:, :, None] * p[None] * (g[s] * beta[s])[:, None, :])[there[s]]
            pair -= (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            now, before = label[at[s][there[s]]], label[at[s - 1][there[s]]]
            np.add.at(pair, (before, now), 1.0)
        pair /= len(word)
        gw += gradient**2
        gt += pair**2
        w += how.rate * gradient / np.sqrt(gw)
        t += how.rate * pair / np.sqrt(gt)
    return Model(known, w.astype(np.float32), lexicon, t)


def sample(docs: DataFrame, how: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], list[str]]:
    """The bounded training sample: texts and labels of rows that are not held out, with a text and a language."""
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    sizes = usable.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).collect()
    texts, labels = [], []
    if not sizes:
        return texts, labels
    # About twice as many rows as are wanted, by a hash threshold per language; then the exact number by rank.
    hashed = F.crc32(F.concat(F.lit("sample"), F.col(id_col).cast("string")))
    bound = F.create_map(*[x for r in sizes for x in (F.lit(r[0]), F.lit(int(min(1.0, 2 * how.texts / r[1]) * 2**32)))])
    some = usable.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"), hashed.alias("h")).filter(
        F.col("h") < F.coalesce(bound[F.col("l")], F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "i", "t"))
    for r in some.withColumn("r", rank).filter(F.col("r") <= how.texts).orderBy("l", "h", "i", "t").collect():
        texts.append(r["t"])
        labels.append(r["l"])
    return texts, labels


class Labeller:
    """Labels whole texts by a model; keeps the scores of words in a bounded cache."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.scores = np.zeros((CACHE, len(model.languages)))
        self.letters = np.zeros(CACHE)

    def numbers(self, found: list[list[str]]) -> list[list[int]]:
        """Places of the words' scores in the cache; all words of a call fit, else the cache is begun anew and grown."""
        known = self.known
        fresh = {w for words in found for w in words if w not in known}
        if len(known) + len(fresh) > len(self.scores):
            known.clear()
            fresh = {w for words in found for w in words}
            if len(fresh) > len(self.scores):
                self.scores, self.letters = np.zeros((len(fresh), self.scores.shape[1])), np.zeros(len(fresh))
        if fresh:
            rows, sizes, at = [], [], len(known)
            for w in fresh:
                known[w] = len(known)
                got = features(w, self.model.lexicon)
                rows += got
                sizes.append(len(got))
            start = np.cumsum([0, *sizes[:-1]])
            self.scores[at : at + len(fresh)] = np.add.reduceat(self.model.weights[np.array(rows)], start, axis=0)
            self.letters[at : at + len(fresh)] = [len(w) for w in fresh]
        return [[known[w] for w in words] for words in found]

    def label(self, texts: list[str | None], spans: bool = False) -> list[tuple[str, float, list]]:
        """(language, share of the posterior mass, spans) of each text; spans: language, first and last word of every stretch."""
        found = [WORDS.findall(t.lower()) if t else [] for t in texts]
        lengths = np.array([len(x) for x in found], np.int64)
        if not lengths.sum():
            return [(UNKNOWN, 0.0, []) for _ in texts]
        numbers = self.numbers(found)
        word = np.fromiter((i for x in numbers for i in x), np.int64, int(lengths.sum()))
        names = self.model.languages
        post, there, text, first = posteriors(self.scores[word], lengths, self.model.transitions)
        at = np.minimum(first[None, :] + np.arange(PIECE)[:, None], len(word) - 1)
        weight = np.where(there, self.letters[word[at]], 0.0)
        mass = np.zeros((len(texts), len(names)))
        np.add.at(mass, text, np.einsum("smk,sm->mk", post, weight))
        share = mass / np.maximum(mass.sum(axis=1, keepdims=True), 1e-300)
        best = share.argmax(axis=1)
        out = [(names[b], min(1.0, float(s[b])), []) if n else (UNKNOWN, 0.0, []) for b, s, n in zip(best, share, lengths, strict=True)]
        if spans:
            labels = np.empty(len(word), np.int64)
            labels[at[there]] = post.argmax(axis=2)[there]
            ends = np.cumsum(lengths)
            for i, (end, n) in enumerate(zip(ends.tolist(), lengths.tolist(), strict=True)):
                own = labels[end - n : end]
                cuts = np.flatnonzero(np.diff(own)) + 1
                for a, b in zip(np.append(0, cuts).tolist() if n else [], np.append(cuts, n).tolist(), strict=False):
                    out[i][2].append({"lang": names[own[a]], "first": a, "last": b - 1})
        return out


SPANS = "array<struct<lang:string,first:int,last:int>>"


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """id, ``lang_pred``, ``score`` (its share of the words' posterior mass) and, if asked, ``spans`` of every row.

    NULL texts and texts without a letter are ``und`` with score 0, as are all
    if there was nothing to learn from. Equal shares: the first language in
    alphabetical order. Repeated rows give equal results.
    """
    shared, mark = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = worker_state(mark, lambda: Labeller(shared.value)) if shared.value is not None else None
        for batch in slices(batches, "__text", max_chars=1_000_000):
            texts = batch.column(1).to_pylist()
            got = labeller.label(texts, spans) if labeller else [(UNKNOWN, 0.0, [])] * len(texts)
            columns = [batch.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())]
            if spans:
                columns.append(pa.array([x[2] for x in got], pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, [id_col, "lang_pred", "score", *(["spans"] if spans else [])])

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, lang_pred string, score double" + (f", spans {SPANS}" if spans else "")
    return map_arrow(docs.select(docs[id_col], docs[text_col].alias("__text")), run, schema)


def train(docs: DataFrame, how: Fit = Fit()) -> Model | None:
    return fit(*sample(docs, how), how)
