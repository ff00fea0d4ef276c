"""The pipeline against brute-force versions of its stages, and its edge rows."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from boxframe.llm import decontaminate, toxicity
from boxframe.llm.decontaminate import edits_allowed
from tests.llm.test_decontaminate import plain_distance
from tests.llm.test_line_dedup import brute as later_lines
from tests.llm.test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "bpe"]


def test_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text or "" for r in table.collect()}
    scorer = toxicity.Scorer(toxicity.train(table, spark.read.parquet(f"{SF}/labels.parquet")))
    docs = {d: t for d, t in docs.items() if scorer.score(t)[0] < 0.3}
    gone = later_lines(list(docs.items()))
    after = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) if gone[d] else t for d, t in docs.items()}
    docs = {d: t for d, t in after.items() if t.split() or not gone[d]}
    group = brute_components([(d, plain_fingerprint(t)) for d, t in docs.items()])
    docs = {d: t for d, t in docs.items() if group[d] == d}
    items = [decontaminate.WORDS.findall(r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = {d: decontaminate.WORDS.findall(t.lower()) for d, t in docs.items()}

    def leaked(d):
        own = set(words[d])  # an item within reach shares most of its words
        return any(sum(w in own for w in i) >= 0.8 * len(i) and plain_distance(i, words[d]) <= edits_allowed(len(i), 0.8) for i in items)

    docs = {d: t for d, t in docs.items() if not leaked(d)}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in docs.items()}
    assert 0 < len(got) < len(group)


def test_stages_keep_columns_and_edge_rows(spark):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, removed int, fp bigint, hits int"
    rows = [(1, None, None, None, None, 0.1, 1, 2, 3), (2, "", "en", "s", 0, 0.1, 1, 2, 3), (3, "a clean line of five words here", "en", "s", 31, None, None, None, None),
            (None, "no id but a text of its own", "en", "s", 5, 0.1, 1, 2, 3), (4, "word " * 50_000, "en", "s", 5, 0.1, 1, 2, 3)]
    docs = spark.createDataFrame(rows + rows[2:3], kind)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "bpe":
            assert out.columns == docs.columns, name
        n = out.count()
        # Texts without words are one group for SimHash, and repeated rows are copies.
        assert n == (4 if name == "simhash" else 6), (name, n)
