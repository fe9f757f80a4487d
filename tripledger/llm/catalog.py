"""The registered queries of this subpackage, and the DuckDB statements of those SQL can express.

Each query reads its whole table, applies its operator with production parameters, and derives the
contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    exact_dedup,
    language_model,
    licences,
    mixing,
    near_dedup,
    pages,
    pieces,
    pii,
    quality,
    repetition,
    spelling,
    toxicity,
    whitening,
)
from .sources import table, tokenizer


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score",
                        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.groups_of_equals(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.language_scores(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extracted(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text",
                        F.length("text").cast("bigint").alias("n_chars"))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.measure(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *repetition.COUNTS, "base_failed", "kept", *repetition.SHARES)


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.replicated(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "row.source", F.length("row.text").cast("bigint").alias("n_chars"),
                        "copies", "copy", "place", F.round("target", 9).alias("target_share"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score",
                        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        (F.col("id") == F.col("component_id")).alias("kept"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["base"])
    added = F.filter("spans", lambda s: ~s["base"])

    def number(spans, kind: str, name: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(name)
    counts = [number(base, kind, f"n_{kind}") for kind in pii.BASE]
    counts.append(F.size(added).cast("bigint").alias("n_added"))
    counts += [number(added, kind, f"n_added_{kind}") for kind in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def licence_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of scanned documents."""
    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(
            places, lambda p: p["label"]))), ",")
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), "score")


def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_digest(licences.licences(table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language_model": op3_language_model,
    "op4_pages": op4_pages,
    "op5_repetition": op5_repetition,
    "op6_poisson_mixing": op6_poisson_mixing,
    "op7_quality": op7_quality,
    "op8_near_dedup": op8_near_dedup,
    "op9_pieces": op9_pieces,
    "op10_personal_data": op10_personal_data,
    "op11_licences": op11_licences,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""",
    "op6_poisson_mixing": """
        WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        total AS (SELECT sum(n) AS all_rows FROM sizes),
        by_size AS (SELECT n, sum(n) AS part, sum(pow(n, 0.7)) AS mass, pow(n, 0.7) / n AS pull
                    FROM sizes GROUP BY n),
        tried AS (SELECT part, mass, (all_rows - 4.0 * coalesce(sum(part) OVER (
                      ORDER BY pull DESC, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(mass) OVER (ORDER BY pull DESC, n ROWS BETWEEN CURRENT ROW
                                    AND UNBOUNDED FOLLOWING) * pull > 4.0 AS over
                  FROM by_size, total),
        rest AS (SELECT (any_value(all_rows) - 4.0 * coalesce(sum(part) FILTER (over), 0))
                        / sum(mass) FILTER (NOT over) AS factor FROM tried, total),
        means AS (SELECT source, n, least(factor * (pow(n, 0.7) / n), 4.0) AS mean FROM sizes, rest),
        targets AS (SELECT source, n * mean / (SELECT sum(n * mean) FROM means) AS target FROM means),
        steps AS (SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1)))
                         OVER (PARTITION BY source ORDER BY k) AS reached
                  FROM means, (SELECT unnest(range(0, 32)) AS k)),
        rows AS (SELECT doc_id, text, source, ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')
                        || ':' || coalesce(text, '')), 1, 13))::BIGINT / 4503599627370496.0 AS number
                 FROM documents),
        copies AS (SELECT doc_id, text, r.source, target, (k + 1)::INTEGER AS copy
                   FROM rows r JOIN steps s ON r.source IS NOT DISTINCT FROM s.source
                   AND r.number >= s.reached
                   JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, source, length(text) AS n_chars, round(target, 9) AS target_share,
               (count(*) OVER (PARTITION BY doc_id, text))::INTEGER AS copies, copy,
               md5('7 place:' || copy || ':' || coalesce(doc_id::VARCHAR, '') || ':'
                   || coalesce(text, '')) AS place
        FROM copies""",
}
