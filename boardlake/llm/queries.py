"""Registered queries of the corpus operators and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table and returns the operator's full result as the columns of its contract.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from boardlake.llm.chunk_dedup import chunk_dedup
from boardlake.llm.fill_middle import fill_middle_digest
from boardlake.llm.langid import language_id
from boardlake.llm.mixing import SHARE, mixing_plan
from boardlake.llm.packing import pack_documents
from boardlake.llm.sampling import sampled_digest
from boardlake.llm.simhash import simhash_components
from boardlake.llm.token_counts import token_counts
from boardlake.llm.token_files import token_file_index
from boardlake.llm.toxicity import toxicity
from boardlake.llm.vector_codes import ENTRIES, PARTS, ROUNDS, vector_codes
from boardlake.llm.vector_join import vector_components
from boardlake.llm.warc import archived_pages


#: Folder of the public tokenizer files.
TOKENIZER_DIR = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file: from its package, else in TOKENIZER_DIR."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZER_DIR, name)
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    return simhash_components(_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token-id files, read back: offsets, lengths and id checksums."""
    return token_file_index(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op3_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vector_components(_table(spark, sf_dir, "embeddings"))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by chunk recipes."""
    return chunk_dedup(_table(spark, sf_dir, "documents"))


def op5_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all documents, decoded again."""
    return sampled_digest(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt on two thirds of the ids."""
    return language_id(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back."""
    return archived_pages(_table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt on three quarters of the labelled ids."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected and drawn copies of all documents, raked to tempered margins, SHARE of the corpus's tokens in all."""
    return mixing_plan(_table(spark, sf_dir, "documents"), share=SHARE)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    found = pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in fill-in-the-middle form, and restored from it."""
    return fill_middle_digest(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, with their exact errors."""
    return vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_vector_join": op3_vector_join,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_sampled_pieces": op5_sampled_pieces,
    "op6_language_id": op6_language_id,
    "op7_warc": op7_warc,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_packing": op11_packing,
    "op12_fill_middle": op12_fill_middle,
    "op13_vector_codes": op13_vector_codes,
}


def _vector_codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds written out one by one; all vectors have one length, which ``parts`` divides."""
    steps = [f"""kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({4096} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), pieces AS MATERIALIZED (
            SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
            FROM kept, range({parts}) AS t(p)
        ), c0 AS MATERIALIZED (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM pieces
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries}
        )"""]
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, label, pieces.p, x, min(({distance}, e)) AS best FROM pieces JOIN c{r} USING (p) GROUP BY ALL
        )""")
        if r < rounds:
            steps.append(f"""m{r} AS (
            SELECT p, best[2] AS e, k, sum(x[k + 1])::BIGINT AS s, count(*) AS n
            FROM a{r}, range((SELECT max(len(x)) FROM pieces)) AS t(k) GROUP BY p, best[2], k
        ), n{r} AS (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM m{r} GROUP BY p, e
        ), c{r + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (p, e)
        )""")
    return f"""
        WITH {", ".join(steps)}, coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
            FROM a{rounds} GROUP BY vec_id, label
        ), books AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded, books"""


#: Queries that SQL can't express have no entry; their tests hold them against brute force.
ORACLE = {
    "op3_vector_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        ), ok AS (
            SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
            WHERE label IS NOT NULL AND e IS NOT NULL
              AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b
              ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
             AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
        ), reach(u, v) AS (
            SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
        ), comp AS (
            SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
        ), n AS (
            SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u
        )
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM comp LEFT JOIN n USING (vec_id)""",
    "op4_chunk_dedup": """
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents
        ), g AS (
            SELECT norm, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM d GROUP BY norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)""",
    "op7_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
    "op12_fill_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || doc_id) AS h FROM documents
        ), k AS (
            SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
        ), c AS (
            SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
                   array_to_string(units[greatest(a, b) + 1:], '') AS suffix FROM k
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                           ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM c""",
    "op13_vector_codes": _vector_codes_sql(),
}
