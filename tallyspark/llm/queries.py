"""The thin ``opN_<name>`` queries over the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, codes, divergence, exact, lines, mixing, quality, rules, sharding, simhash, suffixes, tokencount, urls
from tallyspark.llm.common import table


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = rules.judge(docs.select("doc_id", "text"), rules.train(docs, table(spark, sf_dir, "labels")))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("_doc.doc_id", *measures, "base_failed", "kept", "probability")


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), "kept_sha256")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select(
        "_doc.doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce(F.col("_doc.text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN, with_ids=False)
    return encoded.select("_doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("byte_bpe_50k.json"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries, in the operators' order."""
    found = [(k, v) for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {**dict(sorted(found, key=lambda kv: int(kv[0][2:].split("_")[0]))), "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": urls.SQL,
        "op7_line_dedup": lines.SQL,
        "op9_exact_dedup": exact.SQL,
        "op11_source_divergence": divergence.SQL,
        "op13_vector_codes": codes.SQL,
    }
