"""Spelling variants: near pairs, forms and roots against brute force; edge rows."""

import random
import re
import zlib
from collections import Counter

from boxframe.llm import queries, variants

SF = "/root/testdata/sf0.001"


def edits(word, letters):
    """All strings one edit away from a word."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
    out |= {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def brute(counts, factor=2):
    letters = sorted({c for w in counts for c in w})
    out = {}
    for w, n in counts.items():
        near = [x for x in edits(w, letters) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= factor * n else None
        out[w] = [form, n, len(near), counts[form] if form else None]
    rows = set()
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, k, m))
    return rows


def test_group_variants_against_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(150)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "longerword", "longerwords", "lngerwords", "éééééé"]
    counts = {w: rng.choice([3, 3, 4, 6, 7, 12, 25, 50]) for w in base}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = [tuple(r) for r in variants.group_variants(df).collect()]
    assert len(got) == len(counts) and set(got) == brute(counts)
    assert max(r[4] for r in got) > 3 and any(r[1] and r[1] != r[2] for r in got)


def test_query_against_brute_force(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = re.sub("[A-Z]+", lambda m: m.group().lower(), w)
            h = zlib.crc32(f"{r.doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = [tuple(r) for r in queries.op13_spelling_variants(spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(counts) > 500 and set(got) == brute(counts)


def test_counts_and_edge_rows(spark):
    rows = [(1, "Häuser häuser HÄUSER x_y2z"), (1, "Häuser häuser HÄUSER x_y2z"), (2, None), (3, ""), (None, "häuser İ×ÿ"), (4, "1234 !?")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.selectExpr("doc_id", "text", "1 as n", "'w' as word")
    got = {r.word: r.n for r in variants.count_words(docs).collect()}
    # only A-Z is lower-cased
    assert got == {"häuser": 5, "hÄuser": 2, "x": 2, "y": 2, "z": 2, "×ÿ": 1}
    ids = {r.word: r.n for r in variants.count_words(docs, lambda key, word: f"{word}{key}").collect()}
    assert ids["häuserNone"] == 1 and ids["häuser1"] == 4
    assert variants.group_variants(variants.count_words(docs.limit(0))).collect() == []
    alone = variants.group_variants(variants.count_words(docs)).collect()
    assert [tuple(r) for r in alone] == [("häuser", None, "häuser", 5, 0, None)]


def test_tasks_hand_counts_on(spark, monkeypatch):
    run = variants._count(None)
    monkeypatch.setattr(variants, "HELD", 1)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c a", "a d"])], names=["doc_id", "text"])
    parts = list(run(iter([batch, batch])))
    total = Counter()
    for p in parts:
        for w, n in zip(p.column(0).to_pylist(), p.column(1).to_pylist()):
            total[w] += n
    assert len(parts) >= 2 and total == {"a": 6, "b": 2, "c": 2, "d": 2}


def test_words_are_never_broadcast(spark, monkeypatch):
    """However small the planner takes the tables to be, no join gathers words at the driver."""
    plans = []
    cut = variants.cut_lineage

    def watch(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(variants, "cut_lineage", watch)
    counts = spark.createDataFrame([("hello", 90), ("hallo", 9), ("halle", 3), ("world", 5)], "word string, n bigint")
    found = variants.group_variants(counts)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert {r.word: (r.form, r.root) for r in found.collect()} == {
        "hello": (None, "hello"), "hallo": ("hello", "hello"), "halle": ("hallo", "hello"), "world": (None, "world")}
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4 and not any("Broadcast" in p for p in plans)
