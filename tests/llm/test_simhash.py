"""SimHash fingerprints, anchors and components against brute force."""

import random
import re

import numpy as np
import xxhash

from boxframe.llm import components, queries, simhash

TEXTS = [None, "", " \n", "One", "one two", "a b c d", "A B C\x0bD", "é É x y", "x " * 300, "many words " * 40_000]


def plain_fingerprint(text, k=3):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs, bits=3):
    """(id, fp) -> id -> smallest id reachable."""
    fps = sorted({f for _, f in pairs})
    arr = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= bits):
            parent[find(int(j))] = find(i)
    where = {f: find(i) for i, f in enumerate(fps)}
    least = {}
    for d, f in pairs:
        if d is not None:
            least[where[f]] = min(least.get(where[f], d), d)
    return {d: least.get(where[f]) for d, f in pairs}


def test_fingerprint():
    for t in TEXTS:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_anchor_codes_cover():
    """Every half has an anchor within one bit, and halves one bit apart share one."""
    rng = np.random.default_rng(1)
    half = rng.integers(0, 1 << 32, 300, dtype=np.uint64)
    rows, found = simhash.anchors(half, 1)
    assert set(rows.tolist()) == set(range(300))
    rows, found = simhash.anchors(half, 2)
    assert all(int(np.bitwise_count(half[r] ^ a)) <= 2 for r, a in zip(rows, found, strict=True))
    home, code = simhash.anchors(half, 1)
    for b in range(32):
        rows2, found2 = simhash.anchors(half ^ np.uint64(1 << b), 2)
        reach = {(int(r), int(a)) for r, a in zip(rows2, found2, strict=True)}
        covered = {int(r) for r, a in zip(home, code, strict=True) if (int(r), int(a)) in reach}
        assert covered == set(range(300))


def with_noise(rng, n, flips):
    base = [rng.getrandbits(64) for _ in range(n)]
    out = base[:]
    for f in base:
        for _ in range(rng.randint(0, 4)):
            for _ in range(flips):
                f ^= 1 << rng.randrange(64)
            out.append(f)
    return out


def test_links_against_brute_force(spark):
    rng = random.Random(11)
    fps = with_noise(rng, 150, 2) + with_noise(rng, 150, 3) + with_noise(rng, 100, 4)
    hub = rng.getrandbits(64)
    fps += [hub ^ 1 << i ^ 1 << j for i in range(0, 64, 5) for j in range(i, 64, 3)] + [0, 0, 7]
    pairs = [(i, f) for i, f in enumerate(fps)]
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in pairs], "doc_id bigint, fp bigint")
    want = brute_components(pairs)
    for cell in (20, 2_000):
        links = simhash.near_links(df, 3, cell)
        got = {r.node: r.root for r in components.components(links).collect()}
        root = {i: got.get(f - (1 << 64) if f >> 63 else f, f - (1 << 64) if f >> 63 else f) for i, f in pairs}
        groups, wanted = {}, {}
        for i, _ in pairs:
            groups.setdefault(root[i], set()).add(i)
            wanted.setdefault(want[i], set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values())), cell


def test_chain_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)}
    assert components.components(edges.limit(0)).count() == 0


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i + 1, t, "x") for i, t in enumerate(TEXTS)] + [(None, "one", "y"), (4, "One", None), (4, "One", None), (None, "lonely text of no id here", "z")], "doc_id bigint, text string, fp string")
    out = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert len(out) == len(TEXTS) + 4
    assert all(c == 1 for d, _, c in out if d in (1, 2, 3))
    assert sorted(c for d, _, c in out if d is None and c is not None) == [4]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id is null").count() == 2 and kept.filter("doc_id in (1, 2, 3)").count() == 1 and kept.filter("doc_id = 4").count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = queries.op4_simhash(spark, "/root/testdata/sf0.01").collect()
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    want = brute_components(list(prints.items()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {d: (f"{f:016x}", want[d]) for d, f in prints.items()}
