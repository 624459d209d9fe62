"""One query per operator, over whole tables, and their expected results as SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import (
    bpe, digest, mixing, pages, personal_data, prefix_trie, quality_model, quality_rules, secret_scan, sharding, simhash, toxicity,
    turn_repair,
)
from lumbung.llm.conversation_sql import REPAIR, TRIE
from lumbung.llm.tables import ids_and_texts, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op2_secret_novelty(spark: SparkSession, folder: str) -> DataFrame:
    base = ("assign", "access", "hex")
    found = ids_and_texts(table(spark, folder, "documents")).select("doc_id", secret_scan.spans("text").alias("found"))
    return found.select(
        "doc_id",
        *[F.size(of_kinds("found", kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(span_text(of_kinds("found", *base)), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )


def op3_rare_window_digest(spark: SparkSession, folder: str) -> DataFrame:
    found = digest.digests(table(spark, folder, "documents"))
    columns = ("fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), *columns)


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = ids_and_texts(table(spark, folder, "documents")).select("doc_id", bpe.there_and_back("text").alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("coded.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op5_fair_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op7_rule_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def op9_boosted_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.with_spans(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[F.size(of_kinds("base", kind)).cast("long").alias(f"n_{kind}") for kind in personal_data.BASE],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"),
    )


def op10_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.reports(table(spark, folder, "conversations"), planted=True)


def op12_hashed_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_simhash_golay": op1_simhash_golay,
    "op2_secret_novelty": op2_secret_novelty,
    "op3_rare_window_digest": op3_rare_window_digest,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_fair_toxicity": op5_fair_toxicity,
    "op6_jump_shards": op6_jump_shards,
    "op7_rule_cascade": op7_rule_cascade,
    "op8_source_mix": op8_source_mix,
    "op9_boosted_personal_data": op9_boosted_personal_data,
    "op10_page_text": op10_page_text,
    "op11_turn_repair": op11_turn_repair,
    "op12_hashed_quality": op12_hashed_quality,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op11_turn_repair": REPAIR,
    "op13_prefix_trie": TRIE,
    "op8_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source,
                coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                ('0x' || substr(md5('mixing-1:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT
                    / 4503599627370496.0::DOUBLE AS u
            FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                [3, 1, 2][(row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1] AS weight
            FROM d GROUP BY source
        ), o AS (
            SELECT *, 2 * source_size AS most, 1.5 * (sum(source_size) OVER ())::DOUBLE AS wanted,
                sum(weight) OVER () AS all_weights
            FROM s
        ), b AS (
            SELECT *,
                coalesce(sum(most) OVER w, 0) AS most_before, coalesce(sum(weight) OVER w, 0) AS weight_before
            FROM o WINDOW w AS (ORDER BY most::DOUBLE / weight, source COLLATE C NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), f AS (
            SELECT *, weight * (wanted - most_before) / (all_weights - weight_before)::DOUBLE >= most AS is_full FROM b
        ), t AS (
            SELECT source, source_size,
                CASE WHEN is_full THEN most::DOUBLE
                ELSE weight * (wanted - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())
                    / (all_weights - sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER ())::DOUBLE END AS target
            FROM f
        ), r AS (
            SELECT doc_id, size, source_size, target, u,
                CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), c AS (
            SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies FROM r
        )
        SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
    """,
}
