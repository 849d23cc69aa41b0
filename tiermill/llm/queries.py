"""Thin queries over the operators: production parameters, whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import (
    decontamination,
    html_text,
    langid,
    ngram_join,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    sentence_pieces,
    sharding,
    spotsigs,
    suffix_dedup,
    toxicity,
)
from tiermill.llm.common import crc_of_id, read_table, with_key


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.fingerprint_with_next(read_table(spark, sf_dir, "documents"))
    return found.withColumn("length_class", spotsigs.length_class(F.col("n_signatures")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"), length=400, keep="none")


def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_rows(read_table(spark, sf_dir, "documents"), shards=24)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(crc_of_id("doc_id") % 3 != 1))
    return quality.score(docs, model).select(
        "doc_id", (crc_of_id("doc_id") % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_key(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    found = ngram_join.components(rows, words=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), path, capacity=4096, end_id=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(crc_of_id("doc_id") % 5 != 0))
    return quality.score(docs, model).select(
        "doc_id", (crc_of_id("doc_id") % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_of_id("doc_id") % 5 != 0))
    return langid.identify(docs, model).select(
        "doc_id", (crc_of_id("doc_id") % 5 == 0).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(read_table(spark, sf_dir, "documents"), path)
    return sentence_pieces.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.nodes(*prefix_trie.rebuilt(turns))


def _repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of the tenth of the documents whose words from some place on repeat with some period."""
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(read_table(spark, sf_dir, "documents"), least=12, rewrite=_repeated_tail)
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    comma, line = F.lit(","), F.lit("\n")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), comma, r["length"].cast("string"), comma, r["period"].cast("string"), line))
    found = found.withColumn("best", F.array_max(ranked))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_label_propagation": op3_label_propagation,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_language_id": op10_language_id,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

#: CRC-32 of a decimal number's text, bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(ch)::BIGINT for ch in string_split(conv_id::VARCHAR, '')]),
    lambda c, b: list_reduce(
        list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""

ORACLE_SQL: dict[str, str] = {
    "op12_prefix_trie": f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT DISTINCT conv_id AS c, conv_id - conv_id % 100 AS source, {_CRC32} % 6 AS h FROM own),
turns AS (
    SELECT c, pos, role, text FROM convs JOIN own ON own.conv_id = source AND pos < h
    UNION ALL
    SELECT c, pos, role, text FROM convs JOIN own ON own.conv_id = c AND pos >= h),
placed AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, length(text) AS size,
           list({{'role': role, 'text': text}}) OVER (PARTITION BY c ORDER BY pos) AS path
    FROM turns),
walks AS (
    SELECT c, d, size, path FROM placed
    UNION ALL
    SELECT c, 0, 0, [] FROM convs),
lengths AS (SELECT c, max(d) AS n FROM walks GROUP BY c),
named AS (
    SELECT w.*, min(w.c) OVER (PARTITION BY w.d, w.path) AS node, w.d = n AS is_end
    FROM walks w JOIN lengths USING (c)),
nodes AS (
    SELECT node, d, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS adds,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends
    FROM named GROUP BY node, d),
steps AS (
    SELECT DISTINCT b.node, b.d, a.node AS parent FROM named b JOIN named a ON a.c = b.c AND a.d = b.d - 1),
children AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM steps GROUP BY ALL),
below AS (SELECT DISTINCT a.node, a.d, b.node AS node_b, b.d AS d_b FROM named a JOIN named b ON a.c = b.c AND b.d >= a.d),
sums AS (
    SELECT below.node, below.d, sum(adds) AS saved, count(*) FILTER (k.n_children IS NULL) AS leaves
    FROM below JOIN nodes x ON x.node = node_b AND x.d = d_b
    LEFT JOIN children k ON k.parent = node_b AND k.d = d_b
    GROUP BY ALL)
SELECT nodes.node AS conv_id, nodes.d::BIGINT AS depth, steps.parent AS parent_conv_id, n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       ends AS ends_sha256
FROM nodes JOIN sums USING (node, d)
LEFT JOIN steps USING (node, d)
LEFT JOIN children ON children.parent = nodes.node AND children.d = nodes.d
""",
}
