"""Byte-level network: scoring against a plain loop, gradients, held-out accuracy, edge rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.llm import byte_cnn, queries
from boxframe.llm.byte_cnn import BLOCK, DIM, FILTERS, HIDDEN, LEAD, PIECE, STEP, WIDTH, Fit, Network

SF = "/root/testdata/sf0.1"


def network(seed=1):
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, 0.3, (WIDTH * DIM, FILTERS)).astype(np.float32),
                  rng.normal(0, 0.1, FILTERS).astype(np.float32), rng.normal(0, 0.2, (FILTERS + 2, HIDDEN)).astype(np.float32),
                  rng.normal(0, 0.3, HIDDEN).astype(np.float32), 0.2)
    net.table[0] = 0
    return net


def plain(net, text):
    """One text, window by window and chunk by chunk."""
    blocks = -(-(len(text) + LEAD) // BLOCK)
    data = bytes(LEAD) + text + bytes(blocks * BLOCK + WIDTH - len(text))
    feats = []
    for c in range(max(1, blocks - 1)):
        end = min(blocks, c + 2) * BLOCK
        got = [net.table[list(data[s : s + WIDTH])].reshape(-1) @ net.filters for s in range(c * BLOCK, end, STEP)]
        size = min(PIECE, len(text) + LEAD - c * BLOCK)
        chunk = [*np.maximum(np.max(got, axis=0) + net.shift, 0), np.log1p(size) / 7, 1]
        feats.append(np.maximum(chunk @ net.hidden, 0))
    return 1 / (1 + np.exp(-(np.mean(feats, axis=0) @ net.layer + net.bias)))


def test_scores_against_a_plain_loop():
    net, rng = network(), random.Random(2)
    texts = [b"", b"a", *[bytes(rng.randrange(256) for _ in range(n)) for n in (15, 16, 495, 496, 497, 512, 1024, 1100, 3000, 9000)]]
    got = byte_cnn.probabilities(net, texts, part=3)
    assert np.allclose(got, [plain(net, t) for t in texts], atol=1e-4)
    alone = [byte_cnn.probabilities(net, [t])[0] for t in texts]
    assert np.allclose(got, alone, atol=1e-6)


def test_end_of_a_long_text_counts():
    net = network()
    a = b"plain words here. " * 30_000
    assert byte_cnn.probabilities(net, [a])[0] != byte_cnn.probabilities(net, [a[:-400] + b"$%&!" * 100])[0]


def test_pieces_are_spread_over_the_text():
    text = bytes(range(256)) * 400
    starts = [text.find(p) // BLOCK for s in range(50) for p in byte_cnn.pieces_of(text, s, 4)]
    assert len(byte_cnn.pieces_of(text, 1, 4)) == 4 and all(len(p) <= PIECE for p in byte_cnn.pieces_of(text, 1, 4))
    assert byte_cnn.pieces_of(b"", 1, 4) == [bytes(LEAD)] and len(starts) == 200


def test_fit_learns_a_pattern_and_degenerate_fits():
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(240):
        words = [rng.choice(["river", "tree", "stone", "light", "paper"]) for _ in range(60)]
        if i % 2 == 0:
            words = [w + "%%#" for w in words]
        texts.append(" ".join(words).encode())
        labels.append(i % 2)
    net = byte_cnn.fit([byte_cnn.pieces_of(t, 1, 4) for t in texts], labels, [1.0] * 240, Fit(passes=6))
    got = byte_cnn.probabilities(net, [b"green house%%# under%%# water%%# tree%%# " * 8, b"green house under water tree " * 8])
    assert got[0] < 0.3 < 0.7 < got[1]
    assert byte_cnn.probabilities(byte_cnn.fit([], [], []), [b"x"])[0] == pytest.approx(0.5)
    assert byte_cnn.probabilities(byte_cnn.fit([[b"a"]], [1], [1.0]), [b"x", b""])[1] == pytest.approx(0.99)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op12_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    bad = [p for y, p in held if y == 0]
    good = [p for y, p in held if y == 1]
    assert len(bad) > 80 and sum(good) / len(good) >= 0.98
    assert 1 - sum(bad) / len(bad) >= 0.8


def test_edge_rows(spark):
    rows = [(1, "good text", "x"), (1, "good text", "x"), (2, None, "y"), (3, "", None), (None, "z" * 5000, "w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` string").withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 0), (9, 0), (3, None), (3, 7)], "doc_id bigint, quality int")
    net = byte_cnn.train(docs, labels, "quality", F.lit(True), Fit(passes=1))
    got = byte_cnn.score(docs, net)
    assert got.columns == ["doc_id", "text", "a.b", "score"] and got.count() == 5
    by = {}
    for r in got.collect():
        by.setdefault((r.doc_id, r.text), set()).add(r.score)
    assert all(len(s) == 1 for s in by.values()) and by[2, None] == by[3, ""]
    assert byte_cnn.score(docs.limit(0), net).collect() == []
    empty = byte_cnn.train(docs.limit(0), labels.limit(0), "quality", F.lit(True))
    assert byte_cnn.score(docs, empty).first().score == 0.5
