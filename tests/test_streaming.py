from boxframe.streaming import incremental_download


def test_incremental_download_processes_new_files_once(spark, tmp_path):
    src = tmp_path / "src" / "train"
    src.mkdir(parents=True)
    for i in ("00aa", "00bb", "00cc"):
        (src / f"{i}.jpg").write_bytes(i.encode())
    lists = tmp_path / "lists"
    lists.mkdir()
    (lists / "a.txt").write_text("train/00aa\ntrain/00bb\nnope/1\n")
    ckpt, manifest, dst = str(tmp_path / "ckpt"), str(tmp_path / "manifest"), str(tmp_path / "dst") + "/"
    q = incremental_download(spark, str(lists), str(tmp_path / "src") + "/", dst, manifest, ckpt)
    q.awaitTermination(120)
    first = {r.image_id for r in spark.read.parquet(manifest).collect()}
    assert first == {"00aa", "00bb"}
    (lists / "b.txt").write_text("train/00cc\n")
    q = incremental_download(spark, str(lists), str(tmp_path / "src") + "/", dst, manifest, ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(manifest).collect()
    assert sorted(r.image_id for r in rows) == ["00aa", "00bb", "00cc"]
    assert all(r.ok for r in rows)
    assert (tmp_path / "dst" / "train" / "00cc.jpg").read_bytes() == b"00cc"
