"""Splits and batch plans: disjoint, complete, independent of partitioning."""

from pyspark.sql import functions as F

from boxframe.operators.batches import assemble_batches, epoch_plan, plan_batches, rows_page
from boxframe.operators.split import sample_one, split_by_hash, split_exact


def _ids(spark, n=2000):
    return spark.range(n).select(F.format_string("%016x", F.col("id") * 7919).alias("ImageID"))


def test_hash_split_is_layout_independent(spark):
    df = _ids(spark)
    a = {r.ImageID: r.split for r in split_by_hash(df).collect()}
    b = {r.ImageID: r.split for r in split_by_hash(df.repartition(13)).collect()}
    assert a == b and set(a.values()) == {"train", "test"}
    assert 0.75 < sum(v == "train" for v in a.values()) / len(a) < 0.85


def test_exact_split_sizes_and_layout(spark):
    df = _ids(spark, 1234)
    a = {r.ImageID: r.split for r in split_exact(df).collect()}
    b = {r.ImageID: r.split for r in split_exact(df.repartition(5)).collect()}
    assert a == b
    assert sum(v == "train" for v in a.values()) == int(0.8 * 1234)


def test_batches_disjoint_complete_bounded(spark):
    df = _ids(spark, 1001)
    plan = plan_batches(df, world_size=3, batch_size=8).collect()
    assert sorted(r.ImageID for r in plan) == sorted(r.ImageID for r in df.collect())
    seen = {}
    for r in plan:
        seen.setdefault((r.shard, r.batch_no), []).append(r.pos)
    for (shard, b), poss in seen.items():
        assert sorted(poss) == list(range(len(poss))) and len(poss) <= 8
    per_shard = {}
    for (shard, b), poss in seen.items():
        per_shard.setdefault(shard, []).append((b, len(poss)))
    for shard, bs in per_shard.items():
        bs.sort()
        assert [b for b, _ in bs] == list(range(len(bs)))
        assert all(n == 8 for _, n in bs[:-1])
    dropped = plan_batches(df, world_size=3, batch_size=8, drop_last=True).collect()
    assert all(n == 8 for n in __import__("collections").Counter((r.shard, r.batch_no) for r in dropped).values())
    a = assemble_batches(plan_batches(df, world_size=3, batch_size=8), ["ImageID"]).collect()
    assert sum(r.n_items for r in a) == 1001


def test_epochs_reshuffle_but_keep_shards(spark):
    df = _ids(spark, 300)
    p = epoch_plan(df, epochs=2, world_size=2, batch_size=4).collect()
    e1 = {r.ImageID: (r.shard, r.batch_no, r.pos) for r in p if r.epoch == 1}
    e2 = {r.ImageID: (r.shard, r.batch_no, r.pos) for r in p if r.epoch == 2}
    assert e1.keys() == e2.keys() and len(e1) == 300
    assert all(e1[k][0] == e2[k][0] for k in e1)
    assert any(e1[k][1:] != e2[k][1:] for k in e1)


def test_page_and_sample(spark):
    df = _ids(spark, 50).withColumn("k", F.col("ImageID"))
    pages = [sorted(r.ImageID for r in rows_page(df, ["k"], s, 10).collect()) for s in range(0, 50, 10)]
    flat = [x for p in pages for x in p]
    assert flat == sorted(r.ImageID for r in df.collect())
    assert sample_one(df).count() == 1


def test_hot_image_is_split_without_losing_boxes(spark):
    from boxframe.operators.boxes import explode_annotations, group_annotations

    rows = [("hot", i, float(i)) for i in range(50)] + [("cold", 100 + i, float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "ImageID string, box_id long, XMin double")
    g = group_annotations(df, ("XMin",), order_by="box_id", max_per_row=10).collect()
    hot = [r for r in g if r.ImageID == "hot"]
    cold = [r for r in g if r.ImageID == "cold"]
    assert len(cold) == 1 and cold[0].chunk == 0 and [a.XMin for a in cold[0].annotations] == [0.0, 1.0, 2.0]
    assert 2 <= len(hot) <= 5 and {r.chunk for r in hot} <= set(range(5))
    assert sorted(a.XMin for r in hot for a in r.annotations) == [float(i) for i in range(50)]
    assert explode_annotations(spark.createDataFrame(g)).count() == 53


def test_groupings_get_tasks_by_their_rows(spark, monkeypatch):
    """A table of more rows than the session's partitions should hold is dealt over more of them."""
    from pyspark.sql import functions as F

    from boxframe.operators import boxes as B

    df = spark.createDataFrame([(f"i{i % 90}", i, float(i)) for i in range(360)], "ImageID string, box_id long, XMin double")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for most in (3, 100_000):
        monkeypatch.setattr(B, "ROWS_PER_TASK", 500_000)
        want = sorted(map(str, B.group_annotations(df, ("XMin",), order_by="box_id", max_per_row=most).collect()))
        monkeypatch.setattr(B, "ROWS_PER_TASK", 10)
        dealt = B.group_annotations(df, ("XMin",), order_by="box_id", max_per_row=most)
        assert sorted(map(str, dealt.collect())) == want
        used = dealt.select("annotations", F.spark_partition_id().alias("p")).collect()
        assert len({r.p for r in used}) > tasks
        assert 360 > 10 * tasks and B.deal(df, 10 * tasks, "ImageID") is df


def test_padded_shards_are_equal_and_complete(spark):
    from collections import Counter

    df = _ids(spark, 103)
    p = plan_batches(df, world_size=4, batch_size=5, pad=True).collect()
    per_shard = Counter(r.shard for r in p)
    assert len(set(per_shard.values())) == 1
    originals = sorted(r.ImageID for r in p if not r.padded)
    assert originals == sorted(r.ImageID for r in df.collect())
    for s in per_shard:
        rows = sorted((r.batch_no, r.pos) for r in p if r.shard == s)
        assert rows == sorted({(i // 5, i % 5) for i in range(per_shard[s])})


def test_exact_split_edge_sizes(spark):
    for n, frac in ((1, 0.8), (5, 0.8), (10, 0.5), (37, 0.0), (37, 1.0)):
        df = _ids(spark, n)
        got = {r.ImageID: r.split for r in split_exact(df, train_fraction=frac).collect()}
        assert len(got) == n
        assert sum(v == "train" for v in got.values()) == int(frac * n)
        # the train rows are exactly the first ones in md5(seed:key) order
        import hashlib

        order = sorted(got, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
        assert all(got[i] == "train" for i in order[: int(frac * n)])


def test_partition_by_shard_colocates(spark):
    from boxframe.operators.batches import partition_by_shard

    p = partition_by_shard(plan_batches(_ids(spark, 500), world_size=4, batch_size=8))
    rows = p.select("shard", F.spark_partition_id().alias("pid")).distinct().collect()
    owners = {}
    for r in rows:
        owners.setdefault(r.shard, set()).add(r.pid)
    assert all(len(v) == 1 for v in owners.values()) and len(owners) == 4


def test_exact_split_follows_changed_files(spark, tmp_path):
    """The same path, overwritten with more rows, is split by its own count."""
    path = str(tmp_path / "t")
    for n in (10, 1000):
        spark.range(n).selectExpr("cast(id as string) as ImageID").write.mode("overwrite").parquet(path)
        got = split_exact(spark.read.parquet(path)).groupBy("split").count().collect()
        assert {r.split: r["count"] for r in got} == {"train": n * 8 // 10, "test": n - n * 8 // 10}


def test_pages_of_repeated_rows(spark):
    df = spark.createDataFrame([(k,) for k in (1, 1, 2, 2, 3, 3)], "k int")
    assert sorted(r.k for r in rows_page(df, ["k"], 0, 4).collect()) == [1, 2]
    assert sorted(r.k for r in rows_page(df, ["k"], 2, 4).collect()) == [2, 3]


def test_pad_fills_empty_shards(spark):
    df = spark.createDataFrame([(f"i{k}",) for k in range(3)], "ImageID string")
    got = plan_batches(df, world_size=8, batch_size=2, pad=True).collect()
    sizes = {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert set(sizes) == set(range(8)) and len(set(sizes.values())) == 1
    assert {r.ImageID for r in got if not r.padded} == {"i0", "i1", "i2"}


def test_equal_batches(spark):
    df = spark.createDataFrame([(f"i{k}",) for k in range(100)], "ImageID string")
    for drop_last in (False, True):
        got = plan_batches(df, world_size=3, batch_size=8, drop_last=drop_last, equal=True).collect()
        assert len({max(r.batch_no for r in got if r.shard == s) for s in range(3)}) == 1
    assert plan_batches(df.limit(1), world_size=3, batch_size=8, equal=True).count() == 0


def test_labels_back_to_names(spark):
    from boxframe.operators.labels import build_vocabulary, decode_labels, encode_labels

    df = spark.createDataFrame([(1, "/m/b"), (2, "/m/a"), (3, "/m/b")], "k int, LabelName string")
    vocab = build_vocabulary(df)
    coded = encode_labels(df, vocab).drop("LabelName")
    assert sorted(map(tuple, decode_labels(coded, vocab).collect())) == [(1, "/m/b"), (2, "/m/a"), (3, "/m/b")]
    assert decode_labels(spark.createDataFrame([(1, 99)], "k int, label bigint"), vocab).first().LabelName is None


def test_two_level_offsets(spark):
    """Long prefixes (two levels) number like short ones, per group, with totals."""
    from boxframe.functions.hashing import hash_order_key
    from boxframe.operators.ranking import rank_by_hash

    df = spark.range(3000).selectExpr("cast(id as string) as k", "id % 3 as g").withColumn("o", hash_order_key("k"))
    got = [{(r.k, r.rn, r.n) for r in rank_by_hash(df, "o", "k", ["g"], prefix_hex=h, with_total="n").collect()} for h in (1, 4, 5, 7)]
    assert got[0] == got[1] == got[2] == got[3]
    by = sorted((r.g, r.o, r.k) for r in df.collect())
    want, last = set(), {}
    for g, _, k in by:
        last[g] = last.get(g, 0) + 1
        want.add((k, last[g], 1000))
    assert got[0] == want


def _plain_pages(rows, start, size):
    before, upto = rows[:start], rows[: start + size]
    return sorted(set(upto) - set(before))


def test_pages_by_rank_selection(spark):
    """Pages agree with slices of the sorted rows, however narrow the search must get."""
    import random

    rng = random.Random(3)
    rows = sorted((rng.choice(["a", "b", "c", "d"]), rng.randrange(40)) for _ in range(900))
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "s string, k int")
    for start, size in ((0, 25), (300, 40), (880, 100), (900, 5), (5000, 5), (10, 0)):
        for few in (20_000, 30):
            got = sorted(tuple(r) for r in rows_page(df, ["s", "k"], start, size, few=few).collect())
            assert got == _plain_pages(rows, start, size), (start, size, few)


def test_pages_are_disjoint_with_ties_and_nulls(spark):
    rows = [(None, i) for i in range(20)] + [(1.5, i) for i in range(50)] + [(2.0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k double, v int")
    pages = [[tuple(r) for r in rows_page(df, ["k"], s, 15, few=5).collect()] for s in range(0, 105, 15)]
    assert sorted((x for p in pages for x in p), key=str) == sorted(rows, key=str)
    assert all(r[0] is None for r in pages[0]) and len(pages[-1]) == 10


def test_a_deep_page_has_no_single_task(spark):
    df = spark.range(0, 300_000, 1, 6).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    page = rows_page(df, ["k", "id"], 100_000, 50)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan
    want = [r.id for r in df.orderBy("k", "id").offset(100_000).limit(50).collect()]
    assert sorted(r.id for r in page.collect()) == sorted(want)
