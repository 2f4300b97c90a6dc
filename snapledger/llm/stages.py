"""The operators as stages of a corpus pipeline: documents in, documents out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, jaccard, langid, suffix
from .common import held_out, ready

#: Columns of documents; others do not pass through the pipeline.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The rank file of the token stage.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; those without a letter go as well."""
    ready(spark)
    known = docs.filter(~held_out("doc_id", 5, 0))
    return langid.identify(docs, known, carry=COLUMNS).filter(~F.col("rejected")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that share at least four fifths of their five-word
    shingles: that with the smallest id, one without an id only if its group has no other."""
    ready(spark)
    return jaccard.first_rows(docs, COLUMNS).select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that an earlier one has in a 100-byte string."""
    ready(spark)
    cut = suffix.remove_repeats(docs, carry=["doc_id", "lang", "source"], as_text=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                      F.length("kept").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ready(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_passages(docs, benchmark, carry=COLUMNS).filter("n_hit = 0").select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    ready(spark)
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return with_digests(coded)


def with_digests(coded: DataFrame) -> DataFrame:
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
