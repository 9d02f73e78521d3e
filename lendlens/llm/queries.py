"""One query per operator, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm import (
    alignment,
    decontaminate,
    fingerprints,
    lexical,
    licences,
    minhash,
    packing,
    pii,
    quality,
    suffix,
    tokens,
    toxicity,
    warc,
)
from lendlens.llm.common import read


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.kept(suffix.deduplicate(read(spark, sf_dir, "documents")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > tokens.LIMIT)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read(spark, sf_dir, "documents"), *paths)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    field = quality.fit(documents, read(spark, sf_dir, "labels"))
    return quality.judged(quality.mark(documents, field)).drop("boilerplate")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_repeats,
        op3_warc,
        op4_tokens,
        op5_toxicity,
        op6_minhash,
        op7_pii,
        op8_packing,
        op9_licences,
        op10_decontaminate,
        op11_alignment,
        op12_quality,
        op13_lexical,
    )
}

ORACLE = {
    "op3_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
          FROM pages
        ), f AS (
          SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op13_lexical": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
          FROM documents
        ), b AS (
          SELECT item_id, unnest(list_distinct(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
          FROM benchmark
        ), s AS (
          SELECT doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0
        ), g AS (
          SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM s
        ), t AS (
          SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM s) GROUP BY ALL
        ), f AS (
          SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term
        ), w AS (
          SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, g
        ), r AS (
          SELECT item_id, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
          FROM b JOIN t USING (term) JOIN w USING (term) JOIN s USING (doc_id), g GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM r WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
}
