"""Toxicity: held-out accuracy, counterfactual penalty and edge rows."""

import random
from dataclasses import replace

import pytest

from boxframe.llm import queries, toxicity
from boxframe.llm.toxicity import Fit

SMALL = Fit(steps=60)


def labelled(rng, n, biased):
    """Insults make a text toxic; in the biased set toxic texts also name one group far more often."""
    filler = "the a house river tree walk green small paper stone light song over under water".split()
    texts, labels = [], []
    for i in range(n):
        y = i % 2
        words = [rng.choice(filler) for _ in range(rng.randint(6, 60))]
        if y:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]) if rng.random() < 0.7 else "weak")
        if rng.random() < (0.8 if y and biased else 0.1):
            words.insert(rng.randrange(len(words)), "muslims")
        if rng.random() < 0.2:
            words.insert(rng.randrange(len(words)), "christians")
        texts.append(" ".join(words))
        labels.append(y)
    return texts, labels


def test_swap_penalty_closes_the_gap():
    rng = random.Random(2)
    texts, labels = labelled(rng, 600, True)
    gaps = {}
    for weight in (0.0, 5.0):
        scorer = toxicity.Scorer(toxicity.fit(texts, labels, [1.0] * len(texts), replace(SMALL, swap=weight)))
        gaps[weight] = scorer.words_value({"muslims"}) - scorer.words_value({"christians"})
        assert scorer.score("what an idiot")[0] > 0.5
    assert gaps[0.0] > 0.5 and abs(gaps[5.0]) < gaps[0.0] / 4


def test_most_toxic_segment_counts():
    rng = random.Random(4)
    texts, labels = labelled(rng, 400, False)
    scorer = toxicity.Scorer(toxicity.fit(texts, labels, [1.0] * len(texts), SMALL))
    long = ". ".join("the green river over paper stone" for _ in range(3000))
    assert scorer.score(long)[0] < 0.3 < scorer.score(long + ". what an idiot. " + long)[0]
    assert "idiot" in scorer.score(long + ". what an idiot.")[1]


def test_degenerate_fits():
    assert toxicity.Scorer(toxicity.fit([], [], [])).score("x")[0] == pytest.approx(0.01)
    assert toxicity.Scorer(toxicity.fit(["a"], [0], [1.0])).score(None)[0] < 0.3


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op2_toxicity(spark, sf).collect()]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    seen = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic = [p for y, p in seen if y == 1]
    clean = [p for y, p in seen if y == 0]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_edge_rows(spark):
    rng = random.Random(1)
    texts, ys = labelled(rng, 200, False)
    texts += [None, "", "\n", "idiot " * 20_000]
    docs = spark.createDataFrame([(i, t, 1.0, "en") for i, t in enumerate(texts)] + [(None, "an idiot", None, None)] * 2, "doc_id bigint, text string, toxic double, lang string")
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(ys)] + [(0, 1, 1 - ys[0]), (None, 1, 1), (200, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels, SMALL)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(texts) + 2 and all(r.worst == "" for r in got if r.doc_id in (200, 201, 202))
    assert len({r.score for r in got if r.doc_id is None}) == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id in (200, 201, 202)").count() == 3
    assert kept.filter("doc_id = 203 or doc_id is null").count() == 0
    clash = docs.withColumnRenamed("toxic", "score").withColumnRenamed("lang", "worst")
    assert toxicity.keep_clean(clash, model).columns == clash.columns and toxicity.keep_clean(clash, model).count() == kept.count()
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0)).bias < 0
