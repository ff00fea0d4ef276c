"""CRF language id: exact posteriors, held-out accuracy, code-switched spans, edge rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.llm import langid, queries
from boxframe.llm.common import held_out
from boxframe.llm.langid import Fit

SYLLABLES = {"aa": ["ka", "lo", "mi", "zu"], "bb": ["ther", "ing", "wo", "sch"], "cc": ["éé", "ñu", "qui", "eau"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def brute_posteriors(e, t):
    """Sums over all label sequences."""
    n, k = e.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(e[i, x] for i, x in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:], strict=False))
                        + np.log(np.exp(t[:, path[0]]).sum()))
        for i, x in enumerate(path):
            out[i, x] += weight
    return out / out.sum(axis=1, keepdims=True)


def flat_posteriors(e, lengths, t):
    post, there, text, first = langid.posteriors(e, lengths, t)
    out = np.zeros_like(e)
    at = first[None, :] + np.arange(langid.PIECE)[:, None]
    out[at[there]] = post[there]
    return out


def test_posteriors_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 5, 0, 7, 3])
    e, t = rng.normal(size=(16, 3)) * 2, rng.normal(size=(3, 3))
    got = flat_posteriors(e, lengths, t)
    at = 0
    for n in lengths:
        if n:
            assert got[at : at + n] == pytest.approx(brute_posteriors(e[at : at + n], t), abs=1e-9)
        at += n


def test_long_texts_have_no_cuts():
    """Pieces against one plain forward-backward."""
    rng = np.random.default_rng(4)
    lengths = np.array([500, 64, 1, 65, 128, 1000])
    n = int(lengths.sum())
    e, t = rng.normal(size=(n, 4)) * 3, rng.normal(size=(4, 4))
    got, p, at = flat_posteriors(e, lengths, t), np.exp(t), 0
    for m in lengths:
        x = np.exp(e[at : at + m])
        alpha, beta = np.zeros((m, 4)), np.ones((m, 4))
        a = np.ones(4) / 4
        for i in range(m):
            a = (a @ p) * x[i]
            a /= a.sum()
            alpha[i] = a
        for i in range(m - 2, -1, -1):
            b = p @ (x[i + 1] * beta[i + 1])
            beta[i] = b / b.sum()
        want = alpha * beta
        assert got[at : at + m] == pytest.approx(want / want.sum(axis=1, keepdims=True), abs=1e-8)
        at += m


def trained(rng, **how):
    texts, labels = [], []
    for lang in SYLLABLES:
        for _ in range(40):
            parts = [text_of(rng, lang, rng.randint(5, 60))]
            if rng.random() < 0.3:
                parts.insert(1, text_of(rng, rng.choice(sorted(SYLLABLES)), 15))
                parts.append(text_of(rng, lang, 30))
            texts.append(". ".join(parts))
            labels.append(lang)
    return texts, labels, langid.fit(texts, labels, Fit(**how))


def test_switches():
    rng = random.Random(6)
    *_, model = trained(rng)
    text = ". ".join([text_of(rng, "aa", 100), text_of(rng, "cc", 30), text_of(rng, "bb", 80)])
    (lang, score, spans), = langid.Labeller(model).label([text], True)
    assert lang in ("aa", "bb") and 0.3 < score < 0.7
    assert [s["lang"] for s in spans] == ["aa", "cc", "bb"]
    assert abs(spans[1]["first"] - 100) <= 1 and abs(spans[1]["last"] - 129) <= 1 and spans[-1]["last"] == 209
    assert model.transitions.diagonal().min() > (model.transitions - 9 * np.eye(3)).max()


def test_all_languages_and_whole_texts(spark):
    """More than 100 languages are all in the sample; late words of a long text are learned."""
    docs = spark.range(520).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id")).alias("text"),
                                   F.concat(F.lit("l"), (F.col("id") % 130).cast("string")).alias("lang"))
    assert len(set(langid.sample(docs)[1])) == len({r.lang for r in docs.filter(~held_out(F.col("doc_id"))).collect()}) > 100
    words = ["early"] * 10_000 + ["late"] * 10_000
    some = langid.windows_of(words, 4_000)
    assert 3_900 < len(some) <= 4_000 and 1_000 < some.count("late") < 3_000 and langid.windows_of(words[:50], 50) == words[:50]
    model = langid.fit(["early " * 5_000 + "late " * 5_000, "other " * 50], ["a", "b"], Fit(steps=2))
    assert "late" in model.lexicon


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op1_langid(spark, sf).collect()
    assert len(got) == len(langs) and all(0 <= r.score <= 1 for r in got)
    seen = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out and langs[r.doc_id]]
    assert sum(seen) / len(seen) > 0.98


def test_edge_rows(spark):
    rng = random.Random(7)
    texts, labels, _ = trained(rng, steps=3)
    rows = [(i, t, x, 0.5) for i, (t, x) in enumerate(zip(texts, labels, strict=True))]
    odd = [(1000, None, "aa", 0.0), (1001, "", None, 0.0), (1002, "12 34 !? _", "bb", 0.0), (1003, "kalomi " * 50_000, "aa", 0.0),
           (None, "schingther woing", "bb", 1.0), (None, "schingther woing", "bb", 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score double")
    model = langid.train(docs)
    got = langid.identify(docs, model, spans=True).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score, by[i].spans) == ("und", 0.0, []) for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "aa" and by[1003].spans[-1].last == 49_999
    assert [r.lang_pred for r in got if r.doc_id is None] == ["bb", "bb"]
    assert langid.train(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
