"""A corpus from raw documents to packed sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last keep the columns of ``documents``.

Null and empty texts and texts without a letter go in the first stage.
Repeated rows are copies of one another: one stays. Extra columns pass
through, whatever their names, up to the last stage, whose columns are those
of the pieces. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import decontamination, langid, ngram_join, packing, suffix_dedup
from tiermill.llm.common import crc_of_id, read_table
from tiermill.session import cut_lineage

#: Least words of a repeated passage.
PASSAGE_WORDS = 51


def _small_batches(spark: SparkSession) -> None:
    """Rows that go to Python at once: the operators work on a megabyte of text at a time, more only fills memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go."""
    _small_batches(spark)
    model = langid.fit(docs.where(crc_of_id("doc_id") % 5 != 0))
    return langid.accepted(docs, model)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    _small_batches(spark)
    return ngram_join.one_per_component(docs, words=5, percent=80)


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of over fifty words are cut out, the first one stays."""
    _small_batches(spark)
    out = suffix_dedup.remove_repeats(docs, length=PASSAGE_WORDS, unit="words", keep="first")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    _small_batches(spark)
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their places."""
    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2, remember=150_000)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_array", suffix_array),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: No SQL expresses the trained language model or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
