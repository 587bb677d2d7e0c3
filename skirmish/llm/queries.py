"""The operators as queries over the tables of a folder: (spark, sf_dir) -> DataFrame, with SQL where that can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skirmish.llm import credentials, decontamination, embeddings, infilling, langid, line_dedup, lm, packing, privacy, simhash, token_counts, toxicity, whitening
from skirmish.llm.common import read

WORD_VOCABULARY = "word_bpe_49k.json"


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), want_text=False)
    return kept.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def line_store_takedowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, those that `labels` call poor are deleted again, and the others are cut by what is left."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    store = line_dedup.LineStore(spark, shards=line_dedup.store_shards(docs.count()))
    store.insert(docs)
    poor = labels.where("quality = 0").select("doc_id")
    store.delete(poor)
    # Rows part from the poor ones once their texts are digests.
    kept = store.apply(docs, want_text=False).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    return kept.join(poor, "doc_id", "left_anti")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digest(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.digest(read(spark, sf_dir, "documents"))


def op12_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_lm": op6_lm,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_embeddings": op10_embeddings,
    "op11_infilling": op11_infilling,
    "op12_privacy": op12_privacy,
    "op13_whitening": op13_whitening,
    "line_store_takedowns": line_store_takedowns,
}


def _secrets_sql() -> str:
    """Positions come from what lies between the matches, as in the operator; everything else is its own."""
    kinds = r"""(0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
                (1, 'access', 'AKIA[A-Z0-9]+', 20), (2, 'hex', '[0-9a-f]+', 24), (3, 'bare', '[A-Za-z0-9+_-]+', 20)"""
    return f"""
        WITH kinds(k, name, pattern, least) AS (VALUES {kinds}),
        docs AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN 'none' ELSE 'is ' || source END AS owner FROM documents),
        found AS (
            SELECT rn, doc_id, owner, k, name, pattern, least, regexp_extract_all(t, pattern) AS matches, string_split_regex(t, pattern) AS gaps
            FROM docs CROSS JOIN kinds WHERE regexp_matches(t, pattern)
        ),
        each AS (
            SELECT rn, doc_id, owner, k, name, pattern, least, generate_subscripts(matches, 1) AS i, unnest(matches) AS m,
                   unnest(gaps[1:len(matches)]) AS gap FROM found
        ),
        placed AS (
            SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rn, k ORDER BY i) AS e,
                   CASE k WHEN 0 THEN regexp_extract(m, pattern, 2) ELSE m END AS value FROM each
        ),
        judged AS (
            SELECT rn, doc_id, owner, k, name, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, value,
                   length(regexp_replace(value, '[^0-9]', '', 'g')) >= 3 AND regexp_matches(value, '[A-Za-z]')
                   AND len(list_distinct(string_split(value, ''))) >= 8 AS random
            FROM placed WHERE length(value) >= least
        ),
        spans AS (
            SELECT * FROM judged j WHERE k < 3 OR random AND NOT EXISTS (
                SELECT 1 FROM judged b WHERE b.rn = j.rn AND b.k < 3 AND b.s < j.e AND b.e > j.s)
        ),
        owners AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT owner) AS n_repos FROM spans GROUP BY value),
        known AS (
            SELECT s.*, CASE WHEN n_owners >= 4 OR n_repos >= 10 AND n_owners > 1 THEN 'example' WHEN random THEN 'live' ELSE 'weak' END AS verdict,
                   name || ':' || s.s || ':' || s.e AS said
            FROM spans s JOIN owners o ON s.value = o.value WHERE k < 3 OR n_owners <= 2
        ),
        held AS (
            SELECT rn, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
                   count(*) FILTER (k = 3) AS n_bare, count(*) FILTER (verdict = 'live') AS n_live,
                   count(*) FILTER (verdict = 'example') AS n_example, count(*) FILTER (verdict = 'weak') AS n_weak,
                   string_agg(said, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(said, ',' ORDER BY s, k) AS spans
            FROM known GROUP BY rn
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               coalesce(n_bare, 0) AS n_bare, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
               coalesce(n_weak, 0) AS n_weak, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN held ON docs.rn = held.rn"""


def _lines_sql(documents: str) -> str:
    return rf"""
        WITH lines AS (
            SELECT doc_id, i, line,
                   lower_ascii AS key
            FROM (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {documents})),
                 LATERAL (SELECT translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii)
        ),
        repeated AS (
            SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ),
        marked AS (
            SELECT l.doc_id, l.i, l.line, r.key IS NOT NULL AND l.doc_id <> r.last_doc AS gone
            FROM lines l LEFT JOIN repeated r ON l.key = r.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id"""


ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": _lines_sql("documents"),
    "line_store_takedowns": _lines_sql("documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)"),
    "op3_secrets": _secrets_sql(),
    "op10_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        pairs AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
        links AS (SELECT x, count(*) AS n FROM pairs GROUP BY x),
        least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.y, vec_id)) AS component_id,
               least(vec_id, coalesce(least.y, vec_id)) = vec_id AS kept
        FROM embeddings LEFT JOIN links ON links.x = vec_id LEFT JOIN least ON least.x = vec_id""",
    "op11_infilling": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn FROM documents
        ),
        h AS (
            SELECT doc_id, t, units, len(units) AS n, CAST('0x' || drawn[1:8] AS BIGINT) AS h1, CAST('0x' || drawn[9:16] AS BIGINT) AS h2,
                   CAST('0x' || drawn[17:24] AS BIGINT) AS h3, CAST('0x' || drawn[25:32] AS BIGINT) AS h4 FROM cut
        ),
        parts AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts""",
}
