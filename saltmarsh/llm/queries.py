"""One query for each training-data operator: (spark, sf_dir) -> the operator's result over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

#: A text that imitates the template's own marks and escapes.
HOSTILE = r"\### Assistant: </turn> ok"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import digest_documents

    return digest_documents(table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import digests, format_chats

    from pyspark.sql import functions as F

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(who).alias("role")) for i, who in enumerate(("user", "assistant")))))
    probe = spark.range(1).select(said.alias("said")).select(F.lit(-7).cast("long").alias("conv_id"), "said.turn", "said.role", F.lit(HOSTILE).alias("text"))
    return digests(format_chats(rows.unionByName(probe)))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_ledger import history, scan_secrets, span_digests

    return span_digests(scan_secrets(history(table(spark, sf_dir, "documents"))))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .ppm_language import held_out, predict_languages, train

    docs = table(spark, sf_dir, "documents")
    predicted = predict_languages(docs.select("doc_id", "text"), train(docs))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .canonical_digest import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .simhash_pivots import simhash_components

    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_dedup import chunk_report

    return chunk_report(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pruned_graph import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_secret_scans": op4_secret_scans,
    "op5_language_id": op5_language_id,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_token_counts": op9_token_counts,
    "op10_simhash": op10_simhash,
}



def _chat_sql() -> str:
    def dec(x: str) -> str:
        return f"replace(replace(replace({x}, '\\t', '</turn>'), '\\h', '###'), '\\b', '\\')"

    def ctl(x: str) -> str:
        return f"replace(replace({x}, '</turn>', '\\t'), '###', '\\h')"

    full = ctl("replace(text, '\\', '\\b')")
    role = "replace(" + ctl("replace(role, '\\', '\\b')") + ", ':', '\\c')"
    clean = lambda x: f"NOT contains({x}, '###') AND NOT contains({x}, '</turn>') AND {dec(x)} = text"
    return f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '{HOSTILE}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
), turns AS (
  SELECT *, 4 + length({role}) + 2 + 8 + CASE WHEN {clean("text")} THEN length(text)
    WHEN {clean(ctl("text"))} THEN length({ctl("text")}) ELSE length({full}) END AS size
  FROM src
), convs AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(size) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM convs"""


def _secrets_sql() -> str:
    from .secret_ledger import RULES

    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {i} AS rank, '{r.name}' AS kind, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps,
    list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) AS sizes, list_transform(regexp_extract_all(t, '{pattern}', {r.group}), lambda x: length(x)) AS counted, {r.least} AS least
  FROM texts WHERE regexp_matches(t, '{pattern}')""")
    union = "\n  UNION ALL\n  ".join(parts)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS (
  {union}
), spans AS (
  SELECT doc_id, rank, kind, counted[k] AS counted, least, CAST(list_sum(gaps[1:k]) + coalesce(list_sum(sizes[1:k-1]), 0) AS BIGINT) AS start, sizes[k] AS size
  FROM (SELECT *, unnest(range(1, len(sizes) + 1)) AS k FROM hits)
), kept AS (SELECT doc_id, rank, kind, start, kind || ':' || start || ':' || (start + size) AS said FROM spans WHERE counted >= least),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '') AS base, string_agg(said, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN by_doc USING (doc_id)"""


ORACLE_SQL: dict[str, str] = {"op2_chat_formatting": _chat_sql(), "op4_secret_scans": _secrets_sql()}
