"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, BPE encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next one's ``docs``. All stages but the last
return the columns of ``documents``; the last returns a row per document of the mix with its
token ids, their count and digests. ``run`` applies them to the table ``documents``.

What the stages decide: documents that the quality rules reject go; later copies of three-line
windows are cut from the texts (a document that has no word left goes); of each component of near
copies the document with the smallest doc_id stays; the mix takes documents up to twice (such a
document has two rows) or not at all, by its source's target.

Nulls, empty and repeated rows are treated as the operators' modules say; extra columns are
carried to the last stage, which returns a fixed set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, lines, mixing, rules, simhash
from tallyspark.llm.common import WORD, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_documents(docs, rules.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(docs)
    return cut.where((F.col("n_removed") == 0) | F.col("_doc.text").rlike(WORD)).select("_doc.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mix(docs, keep_documents=True).rows().select("_doc.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    return encoded.select("_doc.doc_id", "_doc.lang", "_doc.source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", byte_bpe),
]

#: The classifier, XXH64 fingerprints and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{k}")
    return docs
