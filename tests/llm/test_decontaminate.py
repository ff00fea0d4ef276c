"""Decontamination: embedding, recall against brute force, exact distances, edge rows."""

import random

import numpy as np

from boxframe.llm import decontaminate, queries
from boxframe.llm.decontaminate import Index, Search, best_stretch, edits_allowed


def plain_distance(item, text):
    """Edit distance of item to its nearest stretch of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item):
        now = [i + 1]
        for j, t in enumerate(text):
            now.append(min(row[j] + (p != t), row[j + 1] + 1, now[-1] + 1))
        row = now
    return min(row)


def edited(rng, words, k, vocabulary):
    out = list(words)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1:
            out.insert(at, rng.choice(vocabulary))
        elif len(out) > 1:
            del out[at]
    return out


def test_best_stretch():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 9))]
        text = [rng.randrange(5) for _ in range(rng.randint(0, 20))]
        d, a, b = best_stretch(np.array(item), np.array(text, dtype=np.int64))
        assert d == plain_distance(item, text)
        assert 0 <= a <= b <= len(text) and plain_distance(item, text[a:b]) == d


def corpus(rng, n=250):
    vocabulary = [f"w{i}" for i in range(600)] + ["the", "of", "and"] * 60
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 7, 9, 14, 20, 33, 50, 60])))) for i in range(40)]
    docs = []
    for d in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        if d % 2:
            item = rng.choice(items)[1].split()
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, item, rng.randint(0, edits_allowed(len(item), 0.8)), vocabulary)
        docs.append((d, " ".join(words)))
    return items, docs


def brute(items, docs, similarity=0.8):
    found = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, t in items:
            item = t.split()
            distance = plain_distance(item, words)
            if distance <= edits_allowed(len(item), similarity):
                found[d, i] = distance
    return found


def test_recall_and_precision(spark):
    items, docs = corpus(random.Random(8))
    want = brute(items, docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for how in (Search(), Search(block=9)):
        got = {(r.doc_id, h.item): h for r in decontaminate.scan(df, bench, how).collect() for h in r.hits}
        assert set(got) <= set(want)
        assert len(got) >= 0.95 * len(want) > 80
        exact = {k for k, v in want.items() if v == 0}
        assert exact <= set(got)
        words = {d: t.split() for d, t in docs}
        for (d, i), h in got.items():
            assert h.distance >= want[d, i]
            assert plain_distance(dict(items)[i].split(), words[d][h.first : h.last + 1]) == h.distance


def test_windows_lose_nothing():
    """Before hashing, every match has a window lined up by a shared run."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    for n in (5, 6, 9, 10, 14, 15, 20, 33, 60):
        item = [rng.choice(vocabulary) for _ in range(n)]
        index = Index([(1, " ".join(item))], Search())
        for _ in range(50):
            text = edited(rng, item, edits_allowed(n, 0.8), vocabulary)
            words = np.array([index.vocabulary.get(w, 0) for w in ["x"] * 20 + text + ["y"] * 20], np.int64)
            sizes, starts = index.windows(words)
            assert len(starts)


def test_edge_rows(spark):
    item = "Seven words stand here, in one row"
    rows = [(1, None, 0), (2, "", 1), (3, "x " + item.upper() + "!", 2), (3, "x " + item.upper() + "!", 2), (None, item, 3), (4, "seven words stand", 4),
            (5, "pad " * 60_000 + item, 5), (6, "seven words stand here in one", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hits int")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too few"), (None, item), (4, "")], "item_id bigint, text string")
    out = decontaminate.scan(docs, bench)
    assert out.columns == ["doc_id", "text", "hits"]
    got = out.collect()
    found = {r.doc_id: [(h.item, h.first, h.last, h.distance) for h in r.hits] for r in got}
    assert len(got) == len(rows) and found[1] == found[2] == found[4] == []
    assert found[3] == [(1, 1, 7, 0), (None, 1, 7, 0)] and found[5][0] == (1, 60_000, 60_006, 0)
    assert found[6] == [(1, 0, 5, 1), (None, 0, 5, 1)]
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert decontaminate.scan(docs.limit(0), bench).count() == 0
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == len(rows)


def test_short_and_unspaced_items(spark):
    """Items under the minimum are found exactly, those without spaces letter by letter."""
    chinese, thai = "人工智能正在改变我们的世界", "ภาษาไทยไม่มีช่องว่าง"
    items = [(1, "paris"), (2, "Forty two"), (3, "in the year 1815"), (4, chinese), (5, thai), (6, "東京")]
    texts = ["He moved to Paris, then on.", "It is forty-two. Forty and two", "In the year of 1815", "x in the YEAR 1815 y", f"前言。{chinese}，结束。",
             f"前言。{chinese[:5]}地{chinese[5:]}结束", f"x {thai}", "彼は東京に住む", "京東 parisian forty"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = decontaminate.scan(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {r.doc_id: [(h.item, h.first, h.last, h.distance) for h in r.hits] for r in out}
    assert got[0] == [(1, 3, 3, 0)] and got[1] == [(2, 2, 3, 0)] and got[2] == [] and got[3] == [(3, 1, 4, 0)]
    assert got[4] == [(4, 2, 14, 0)] and [(i, n) for i, *_, n in got[5]] == [(4, 1)]
    assert [(i, n) for i, *_, n in got[6]] == [(5, 0)] and got[7] == [(6, 2, 3, 0)] and got[8] == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    items = [(r.item_id, " ".join(decontaminate.WORDS.findall(r.text.lower()))) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r.doc_id: " ".join(decontaminate.WORDS.findall(r.text.lower())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, x in items if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op7_decontamination(spark, sf).collect()}
    assert verbatim and {k for k, v in got.items() if v == 0} == verbatim
    sizes = {i: len(x.split()) for i, x in items}
    assert all(v <= edits_allowed(sizes[i], 0.8) for (_, i), v in got.items())


def test_items_of_any_id_type(spark):
    docs = spark.createDataFrame([(1, "say the quick brown fox jumps over it"), (2, "nothing here")], "doc_id bigint, text string")
    items = spark.createDataFrame([("x-1", "the quick brown fox jumps"), (None, "nothing"), ("y", None)], "item_id string, text string")
    got = {r.doc_id: [h["item"] for h in r.hits] for r in decontaminate.scan(docs, items).collect()}
    assert got == {1: ["x-1"], 2: [None]}
