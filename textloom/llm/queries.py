"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import ann, gif, langid, mincut, packing, pieces, pii, secrets, simhash, warc
from textloom.llm.common import limited, new_path, scratch, table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return limited(table(spark, sf_dir, name))


def op1_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return mincut.extract(_table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op2_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id 20 divides, among all others."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a GIF, its frames decoded and painted, digested."""
    stored = gif.with_media(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return gif.media_digest(stored, carry=["doc_id", "n_bytes"])


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the class that links of three bits or fewer put it in."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's language, by filters learned from the labelled documents that aren't held out."""
    documents = _table(spark, sf_dir, "documents")
    apart = langid.held_out(F.col("doc_id"))
    filters = langid.fit(documents.where(~apart), F.col("doc_id"))
    found = langid.predict_column(documents.select("doc_id", apart.alias("held_out"), "text"), filters, carry=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded with the 32k merge-type model."""
    return pieces.encoding_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])


def op7_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's personal data: fixed forms, and what their contexts find."""
    return pii.report(pii.find(_table(spark, sf_dir, "documents"), carry=["doc_id"]), ["doc_id"])


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's secrets: fixed forms, and random strings by the test battery."""
    return secrets.report(secrets.scan(_table(spark, sf_dir, "documents"), carry=["doc_id"]), ["doc_id"])


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text tokenised, cut and packed into sequences of 1024 tokens."""
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to monolithic archives, normalised, and read back through the index."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = new_path(spark, "op10-normalised")
    with scratch(spark) as keep:  # the monolithic archives go once they are normalised
        monolithic = new_path(spark, "op10-monolithic")
        warc.write_archives(warc.with_dedup(pages), monolithic)
        archives = warc.normalise_archives(spark, monolithic, folder)
        keep.append(archives)
    return warc.read_pages(limited(archives)).drop("url")


QUERIES = {
    "op1_min_cut_text": op1_min_cut_text,
    "op2_one_bit_search": op2_one_bit_search,
    "op3_gif_media": op3_gif_media,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_contextual_pii": op7_contextual_pii,
    "op8_secret_scan": op8_secret_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_warc_normalise": op10_warc_normalise,
}

ORACLES: dict[str, str] = {
    "op2_one_bit_search": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, x: a + x) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 20
    """,
    "op10_warc_normalise": """
        WITH hashed AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
        ), bits AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS winner,
                array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')), '') AS b
            FROM hashed
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                1 + 16 * CAST(b[5 * i + 1] AS INT) + 8 * CAST(b[5 * i + 2] AS INT) + 4 * CAST(b[5 * i + 3] AS INT)
                + 2 * CAST(b[5 * i + 4] AS INT) + CAST(b[5 * i + 5] AS INT)]), '') AS payload_digest,
            CASE WHEN page_id IS DISTINCT FROM winner THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
        FROM bits
    """,
}
