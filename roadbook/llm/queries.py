"""Registered queries of the operators, with the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadbook.llm import (
    bpe, decontaminate, exact_dedup, html, langid, licenses, merkle, minhash, quality, simhash, token_counts, warc,
    whitening,
)
from roadbook.llm.frames import held_out, table, written
from roadbook.session import scratch_path

#: Texts of more tokens than this are marked.
TOKEN_LIMIT = 4096


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def bpe_digests(docs: DataFrame, path: str, keep: list[str] = ()) -> DataFrame:
    """Per row: id, token count, and digests of the tokens and of the text decoded from them."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), path, keep_text=False)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
        *keep,
    )


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, incoming = exact_dedup.split_at(table(spark, sf_dir, "documents"))
    return exact_dedup.find_duplicates(history, incoming).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return known.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records, _ = written(warc.read_records(spark, path, with_payload=False), "records")
    captures, _ = written(
        warc.assemble(records).select(
            "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "copies",
            F.try_element_at("metadata.fields", F.lit("page_id")).try_cast("long").alias("page_id"),
        ),
        "captures",
    )
    stored = captures.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("stored_page"))
    return captures.join(stored, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("stored_page").alias("refers_to"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", F.col("main_text").alias("text"), "n_chars")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # a deviation beyond the range of a long is null
    return white.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = minhash.Rule(shingle=3, percent=85)
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), rule=rule)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed={"n_chars": tampered})
    folded = merkle.fold(F.col("other_leaf"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_main_text": op9_main_text,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_minhash": op12_minhash,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM plain
    """,
    "op8_warc": """
        WITH digests AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), stored AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM digests
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
        FROM stored
    """,
    # a step of a path is a letter, for a sibling to the left, to the right or none, and the sibling
    "op13_merkle": """
        WITH RECURSIVE touched AS (
            SELECT *, xor(list_reduce(
                       [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                       lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))
                   ), 4294967295) % 7 = 0 AS tampered
            FROM documents
        ), sized AS (
            SELECT doc_id, coalesce('=' || lang, '') AS grp,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
                   coalesce(strlen((n_chars + CASE WHEN tampered THEN 1 ELSE 0 END)::VARCHAR) || ':'
                       || (n_chars + CASE WHEN tampered THEN 1 ELSE 0 END), '-') AS other_chars,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM touched
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY grp) AS n
            FROM (SELECT doc_id, grp, sha256(head || chars || tail) AS leaf, sha256(head || other_chars || tail) AS other FROM sized)
        ), up AS (
            SELECT grp, 0 AS level, pos, leaf AS d, n FROM leaves
            UNION ALL
            SELECT grp, level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2
            FROM up WHERE n > 1 GROUP BY grp, level, pos // 2, n
        ), tops AS (
            SELECT grp, d, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
        ), above AS (
            SELECT 0 AS level, pos, d, n FROM tops
            UNION ALL
            SELECT level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2
            FROM above WHERE n > 1 GROUP BY level, pos // 2, n
        ), steps AS (
            SELECT l.grp, l.pos, list(CASE WHEN s.d IS NULL THEN 'N' WHEN s.pos % 2 = 0 THEN 'L' || s.d ELSE 'R' || s.d END
                                      ORDER BY h.level) AS path
            FROM leaves l JOIN (SELECT DISTINCT grp, level FROM up WHERE n > 1) h ON l.grp = h.grp
            LEFT JOIN up s ON s.grp = l.grp AND s.level = h.level AND s.pos = xor(l.pos >> h.level, 1)
            GROUP BY l.grp, l.pos
        ), top_steps AS (
            SELECT t.grp, list(CASE WHEN s.d IS NULL THEN 'N' WHEN s.pos % 2 = 0 THEN 'L' || s.d ELSE 'R' || s.d END
                               ORDER BY h.level) AS path
            FROM tops t, (SELECT DISTINCT level FROM above WHERE n > 1) h
            LEFT JOIN above s ON s.level = h.level AND s.pos = xor(t.pos >> h.level, 1)
            GROUP BY t.grp
        ), proofs AS (
            SELECT l.doc_id, l.leaf, l.other, t.d AS subroot, (SELECT d FROM above WHERE n = 1) AS root,
                   coalesce(s.path, []::VARCHAR[]) || coalesce(u.path, []::VARCHAR[]) AS path
            FROM leaves l JOIN tops t ON t.grp = l.grp
            LEFT JOIN steps s ON s.grp = l.grp AND s.pos = l.pos
            LEFT JOIN top_steps u ON u.grp = l.grp
        ), folded AS (
            SELECT *, list_reduce([other] || path, lambda d, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || d)
                                                                       WHEN 'R' THEN sha256(d || s[2:]) ELSE sha256(d) END) AS folded_root
            FROM proofs
        )
        SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
