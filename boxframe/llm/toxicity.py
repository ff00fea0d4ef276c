"""Toxicity by a counterfactual-regularised classifier.

A text is cut into segments (sentences, of 40 words at most); a segment's logit
is linear in the hashed words and word beginnings of its distinct words, and
the text's logit is that of its most toxic segment. The weights are fitted on
labelled texts by gradient steps on the logistic loss of each text's currently
most toxic segment (multiple-instance learning), plus an L2 penalty, plus the
counterfactual penalty: for every training segment that names a group, the
group's term is swapped for others of its category, and the squared change of
the logit is penalised. So the score can't lean on which group is named, and
neutral mentions don't raise it.

The fit uses a bounded sample of labelled rows (``Fit.toxic`` and
``Fit.clean`` rows, chosen by the hash of their id and weighted back to the
true class sizes). Scoring covers every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import held_out, map_arrow, slices, worker_state

#: Neutral terms for groups of people, by category. A term is swapped for others of its category.
GROUPS = (
    ("women", "men", "transgender", "nonbinary"),
    ("woman", "man"),
    ("girl", "boy"), ("girls", "boys"),
    ("she", "he"), ("her", "his"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "african", "european", "latino", "indigenous", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "turkish", "russian", "polish"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
)

WORDS = re.compile(r"[^\W\d_]+")
BREAKS = re.compile(r"[.!?\n]+")
SEGMENT = 40
CACHE = 150_000


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit: bounds of the sample per class, steps and penalties."""

    toxic: int = 2_000
    clean: int = 4_000
    steps: int = 60
    rate: float = 0.5
    l2: float = 2e-4
    swap: float = 0.5  # weight of the counterfactual penalty
    swaps: int = 16  # swapped copies per group term, at most; categories have fewer terms, so every other one is swapped in
    support: int = 5  # texts that must hold a bucket
    clear: float = 3.0  # pooled standard errors between the classes' rates of a bucket
    least: float = 0.01  # smaller weights become zero


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]  # of buckets; others weigh nothing
    bias: float


def features(word: str) -> list[int]:
    """Buckets (32-bit hashes) of a lower-cased word: the word, its letters' beginnings of 4 to 6."""
    names = [f"w:{word}", *[f"{k}:{word[:k]}" for k in (4, 5, 6) if len(word) >= k]]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in names]


def segments(text: str) -> list[list[str]]:
    """Lower-cased words of each segment of a whole text; segments without words are left out."""
    out = []
    for part in BREAKS.split(text.lower()):
        words = WORDS.findall(part)
        for at in range(0, len(words), SEGMENT):
            out.append(words[at : at + SEGMENT])
    return out


_OTHERS = {t: [o for o in g if o != t] for g in GROUPS for t in g}


def swapped(words: list[str], swaps: int) -> list[list[str]]:
    """Counterfactual copies of a segment: every group term replaced by the others of its category in turn."""
    named = [w for w in words if w in _OTHERS]
    if not named:
        return []
    return [[_OTHERS[w][k % len(_OTHERS[w])] if w in _OTHERS else w for w in words] for k in range(min(swaps, max(len(_OTHERS[w]) for w in named)))]


def fit(texts: list[str], labels: list[int], weights: list[float], how: Fit = Fit()) -> Model:
    """Fit on labelled texts (each with a weight). Without both classes the model scores the label's rate."""
    y, share = np.array(labels, float), np.array(weights, float)
    if not len(y) or y.min() == y.max():
        rate = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        return Model({}, float(np.log(rate / (1 - rate))))
    share /= share.sum()
    usable, first = select(texts, y, how)
    number = {k: i for i, k in enumerate(usable)}
    known: dict[str, list[int]] = {}

    def buckets(words: list[str]) -> list[int]:
        """Places of the usable buckets of a segment's distinct words."""
        out = []
        for w in dict.fromkeys(words):
            if w not in known:
                known[w] = [number[k] for k in features(w) if k in number]
            out += known[w]
        return out

    flat, seg_end, doc_end, swaps = [], [], [], []
    for text in texts:
        for words in segments(text) or [[]]:
            own = buckets(words)
            flat += own
            seg_end.append(len(flat))
            swaps += [(np.array(buckets(other), np.int64), np.array(own, np.int64)) for other in swapped(words, how.swaps)]
        doc_end.append(len(seg_end))
    index, seg_end, doc_end = np.array(flat, np.int64), np.array(seg_end), np.array(doc_end)
    doc_of = np.repeat(np.arange(len(y)), np.diff(np.concatenate(([0], doc_end))))
    seg_start, doc_start = np.concatenate(([0], seg_end[:-1])), np.concatenate(([0], doc_end[:-1]))
    w, b, gw, gb = first, -2.0, np.full(len(first), 1e-8), 1e-8
    for _ in range(how.steps):
        sums = np.concatenate(([0.0], np.cumsum(w[index])))
        logits = sums[seg_end] - sums[seg_start]
        top = np.maximum.reduceat(logits, doc_start)
        # The most toxic segment of every text (the first of equals).
        best = np.flatnonzero(logits == top[doc_of])
        pick = best[np.unique(doc_of[best], return_index=True)[1]]
        err = (1 / (1 + np.exp(-np.clip(logits[pick] + b, -30, 30))) - y) * share
        grad = how.l2 * w
        for i in range(len(pick)):
            np.add.at(grad, index[seg_start[pick[i]] : seg_end[pick[i]]], err[i])
        for a, c in swaps:
            change = 2 * how.swap / len(swaps) * (w[a].sum() - w[c].sum())
            np.add.at(grad, a, change)
            np.add.at(grad, c, -change)
        gw += grad**2
        w -= how.rate * grad / np.sqrt(gw)
        g = err.sum()
        gb += g**2
        b -= how.rate * g / np.sqrt(gb)
    return Model({int(k): float(v) for k, v in zip(usable, w, strict=True) if abs(v) >= how.least}, float(b))


def select(texts: list[str], y: np.ndarray, how: Fit) -> tuple[list[int], np.ndarray]:
    """Buckets that are clearly more frequent in toxic texts, and their first weights (damped log odds).

    Buckets of few texts or of no clear class would only be learned by heart.
    """
    toxic: Counter = Counter()
    for text, label in zip(texts, y, strict=True):
        if label:
            toxic.update({k for w in set(WORDS.findall(text.lower())) for k in features(w)})
    toxic = Counter({k: n for k, n in toxic.items() if n >= 2})
    clean: Counter = Counter()
    for text, label in zip(texts, y, strict=True):
        if not label:
            clean.update({k for w in set(WORDS.findall(text.lower())) for k in features(w) if k in toxic})
    buckets = sorted(k for k, n in toxic.items() if n + clean[k] >= how.support)
    a, c = np.array([toxic[k] for k in buckets], float), np.array([clean[k] for k in buckets], float)
    n1, n0 = (y > 0).sum(), (y == 0).sum()
    pooled = (a + c) / (n1 + n0)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / n1 + 1 / n0))
    usable = a / n1 - c / n0 > how.clear * error
    odds = np.log((a / n1 + 1e-3) / (c / n0 + 1e-3))
    return [k for k, u in zip(buckets, usable, strict=True) if u], np.maximum(0.5 * odds, 0.0)[usable]


def sample(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> tuple[list[str], list[int], list[float]]:
    """The bounded training sample: texts, labels, weights. Held-out ids, NULL ids and NULL labels are left out.

    An id with several labels counts once, with the largest.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").alias("__toxic"))
    sizes = {int(r[0]): int(r[1]) for r in marks.groupBy("__toxic").count().collect()}
    picked, texts, ys, shares = [], [], [], []
    for y, bound in ((1, how.toxic), (0, how.clean)):
        picked.append(marks.filter(F.col("__toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    ids = picked[0].unionByName(picked[1])
    got = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "__toxic").collect()
    chosen = {y: sum(r["__toxic"] == y for r in got) for y in (0, 1)}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["text"] or "")):
        texts.append(r["text"] or "")
        ys.append(int(r["__toxic"]))
        shares.append(sizes[r["__toxic"]] / chosen[r["__toxic"]])
    return texts, ys, shares


class Scorer:
    """Scores whole texts by a model; keeps the values of words in a bounded cache."""

    def __init__(self, model: Model) -> None:
        self.w, self.b, self.value = model.weights, model.bias, {}

    def words_value(self, words: set[str]) -> float:
        value, total = self.value, 0.0
        for x in words:
            v = value.get(x)
            if v is None:
                if len(value) >= CACHE:
                    value.clear()
                v = value[x] = sum([self.w.get(k, 0.0) for k in features(x)])
            total += v
        return total

    def score(self, text: str | None) -> tuple[float, str]:
        """(score, the most toxic segment's words); a text without words has no segment and the bias alone."""
        best, worst = None, []
        for words in segments(text or ""):
            v = self.words_value(set(words))
            if best is None or v > best:
                best, worst = v, words
        z = max(-30.0, min(30.0, self.b + (best or 0.0)))
        return 1 / (1 + exp(-z)), " ".join(worst)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns, ``score`` (0 to 1) and ``worst`` (words of the most toxic segment) of every row.

    NULL and empty texts get the bias' score and an empty ``worst``; repeated
    rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most as large as the bounded sample
    columns, mark = [id_col, *keep], uuid4().hex
    names = columns if text_col in columns else [*columns, text_col]  # a kept text travels once
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_state(mark, lambda: Scorer(shared.value))
        for batch in slices(batches, names[at]):
            got = [scorer.score(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array([x[0] for x in got], pa.float64()), pa.array([x[1] for x in got], pa.string())],
                [*columns, "score", "worst"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in columns], "score double", "worst string"])
    return map_arrow(docs.select(*names), run, schema)


def train(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Model:
    return fit(*sample(docs, labels, how), how)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns) with a score under ``threshold``; texts are scored in the same pass."""
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])  # own names: none can clash
    first, *others = inner.columns
    scored = score(inner, model, first, f"c{docs.columns.index('text')}", tuple(others))
    return scored.filter(F.col("score") < threshold).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
