"""The registered queries of this subpackage and their DuckDB SQL.

Every query applies its operator, with production parameters, to its whole
table. Queries without SQL are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.llm import (bpe, byte_cnn, decontaminate, html_extract, langid, licenses, line_dedup, periodic, quality, sharding, simhash,
                          toxicity, variants)
from boxframe.llm.common import held_out, read_table

#: Texts that score this much are toxic.
TOXIC = 0.3
#: Texts that score this much are good.
QUALITY = 0.3
Query = Callable[[SparkSession, str], DataFrame]

#: 64 shards for the placement query.
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def vocabulary_path() -> str:
    """The public tokenizer file of the BPE queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.array_join("rejected_by", ",").alias("rejected_by"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), vocabulary_path(),
                                columns=("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", F.col("hit.item").alias("item_id"), F.col("hit.first").alias("first_word"),
        F.col("hit.last").alias("last_word"), F.col("hit.distance").alias("distance"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, SHARDS).select("doc_id", "slot", "shard")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_lines(docs).select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def looped(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten from word ``g % n`` on as a repeat of a period that the id's crc32 fixes."""
    h = crc32(str(doc_id).encode("utf-8"))
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return periodic.report(periodic.collapse(docs, least=12, rewrite=looped))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = byte_cnn.train(docs, read_table(spark, sf_dir, "labels"), "quality", ~held)
    return byte_cnn.score(docs, net).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                                            F.when(F.col("score") >= QUALITY, 1).otherwise(0).alias("predicted"))


def misspelt(doc_id: object, word: str) -> str:
    """The word without one letter, for one (document, word) in 97 by their crc32."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode("utf-8", "surrogatepass"))
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = variants.count_words(read_table(spark, sf_dir, "documents"), misspelt)
    return variants.group_variants(counts, letters=5, occurrences=3, factor=2)


QUERIES: dict[str, Query] = {
    "op1_langid": op1_langid,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_license_scan": op6_license_scan,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {}
