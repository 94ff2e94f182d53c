"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paxflow.llm import secret_scan
from paxflow.llm.decontaminate import contaminated
from paxflow.llm.exact_dedup import exact_dedup
from paxflow.llm.language import languages
from paxflow.llm.lm import lm_scores
from paxflow.llm.merkle import manifest_digest
from paxflow.llm.mixing import mix_plan
from paxflow.llm.ngram_join import jaccard_components
from paxflow.llm.pii import pii_digest, pii_spans
from paxflow.llm.secret_scan import secret_digest, secret_spans
from paxflow.llm.substring import remove_repeats, removal_digest
from paxflow.llm.token_store import token_digests
from paxflow.llm.toxicity import toxicity
from paxflow.llm.whitening import whitened


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_digest(secret_spans(documents(spark, sf)))


def op2_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(documents(spark, sf))


def op3_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores(documents(spark, sf))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_shards(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(documents(spark, sf), tokenizer_file())


def op6_pii_anchors(spark: SparkSession, sf: str) -> DataFrame:
    return pii_digest(pii_spans(documents(spark, sf)))


def op7_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix_plan(documents(spark, sf))


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(documents(spark, sf))


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return removal_digest(remove_repeats(documents(spark, sf)))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_digest(documents(spark, sf))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op13_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return languages(documents(spark, sf))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_ngram_join": op2_ngram_join,
    "op3_lm_scores": op3_lm_scores,
    "op4_toxicity": op4_toxicity,
    "op5_token_shards": op5_token_shards,
    "op6_pii_anchors": op6_pii_anchors,
    "op7_mix_sources": op7_mix_sources,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_whitening": op12_whitening,
    "op13_language_id": op13_language_id,
}

def _located(kind: str, order: int, pattern: str) -> str:
    """All leftmost matches of a pattern with their positions: lengths of the pieces between them and of themselves, added up."""
    return f"""
        SELECT doc_id, '{kind}' AS kind, {order} AS ord, hit, before + length(gap) AS start, before + length(gap) + length(hit) AS stop FROM (
            SELECT doc_id, hits[i] AS hit, gaps[i] AS gap,
                   coalesce(sum(length(gaps[i]) + length(hits[i])) OVER (
                       PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
                SELECT doc_id, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps FROM d)))"""


def _any_case(*words: str) -> str:
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


_ASSIGN = (
    f"(?:{_any_case('password', 'passwd', 'secret', 'token')}|{_any_case('api')}_?{_any_case('key')})"
    # a quote inside SQL text is doubled
    r"""["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
)
# The patterns of the contract and of the entropy scan, written out here so that they check the operator's own.
_ACCESS, _HEX, _CANDIDATE = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9+/=_-]{20,}"
_NO_SECRETS = (
    r"^[-_/=+]*([A-Za-z]+|[0-9]{1,8})([-_/=+]+([A-Za-z]+|[0-9]{1,8}))*[-_/=+]*$",
    "^[0-9]+$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)example|placeholder|changeme|xxxxx|0123456789|abcdefgh",
)
_SECRETS_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    assign AS ({_located("assign", 0, "@ASSIGN@")}),
    candidates AS ({_located("candidate", 3, _CANDIDATE)}),
    tested AS (
        SELECT doc_id, hit, start, CASE WHEN regexp_matches(hit, '^[0-9a-fA-F]+$') THEN {secret_scan.HEX_BITS} ELSE {secret_scan.MIXED_BITS} END AS bits
        FROM candidates WHERE {" AND ".join(f"NOT regexp_matches(hit, '{p}')" for p in _NO_SECRETS)}),
    windows AS (
        SELECT doc_id, start AS cand, start + w AS pos FROM (
            SELECT *, unnest(range(0, length(hit) - {secret_scan.WINDOW - 1})) AS w FROM tested)
        WHERE list_aggregate(string_split(substr(hit, w + 1, {secret_scan.WINDOW}), ''), 'entropy') >= bits - 1e-9),
    marked AS (
        SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id, cand ORDER BY pos) <= {secret_scan.WINDOW} THEN 0 ELSE 1 END AS new FROM windows),
    islands AS (SELECT doc_id, cand, pos, sum(new) OVER (PARTITION BY doc_id, cand ORDER BY pos) AS island FROM marked),
    spans AS (
        SELECT doc_id, kind, ord, start, stop FROM assign WHERE length(regexp_extract(hit, '[A-Za-z0-9+/_.=-]+$')) >= 12
        UNION ALL SELECT doc_id, kind, ord, start, stop FROM ({_located("access", 1, _ACCESS)})
        UNION ALL SELECT doc_id, kind, ord, start, stop FROM ({_located("hex", 2, _HEX)})
        UNION ALL SELECT doc_id, 'entropy', 3, min(pos), max(pos) + {secret_scan.WINDOW} FROM islands GROUP BY doc_id, cand, island),
    listed AS (SELECT doc_id, kind, ord, start, kind || ':' || start || ':' || stop AS span FROM spans),
    sums AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
               coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (ord < 3), '') AS base, string_agg(span, ',' ORDER BY start, ord) AS spans
        FROM listed GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
    FROM d LEFT JOIN sums USING (doc_id)
""".replace("@ASSIGN@", _ASSIGN)

SQL = {
    "op1_secret_scan": _SECRETS_SQL,
    "op2_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
            FROM d),
        n AS (SELECT d.doc_id, count(shingle) AS n_shingles FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
        o AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (
            SELECT x, y FROM o JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id
            WHERE 100 * both_have >= 80 * (p.n_shingles + q.n_shingles - both_have)),
        r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reached = l.x),
        c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id),
        k AS (SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY x)
        SELECT doc_id, n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM n JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
    """,
    # The water level is the largest over all numbers of capped sources, taken in the order of cap per weight.
    "op7_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                   md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS draw
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM d GROUP BY source),
        c AS (
            SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weight,
                   coalesce(sum(2 * source_size) OVER w, 0) AS capped, coalesce(sum(weight) OVER w, 0) AS capped_weight
            FROM s
            WINDOW w AS (ORDER BY source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT max((budget - capped::DOUBLE) / (all_weight - capped_weight)::DOUBLE) AS level FROM c),
        t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight) AS target FROM s, l),
        p AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END AS whole,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id NULLS LAST, size
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size / 2.0::DOUBLE AS middle
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        e AS (
            SELECT *, CAST(whole + CASE WHEN size > 0 AND middle <= target - whole * source_size THEN 1 ELSE 0 END AS INTEGER) AS epochs
            FROM p)
        SELECT doc_id, size, source_size, target, CAST(epochs * size AS BIGINT) AS taken, epochs FROM e
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS pos, words FROM d WHERE len(words) >= 13),
        r AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS run FROM w),
        f AS (SELECT doc_id, pos, doc_id > min(doc_id) OVER (PARTITION BY run) AS repeated FROM r),
        g AS (SELECT doc_id, list_distinct(flatten(list(range(pos, pos + 13)))) AS gone FROM f WHERE repeated GROUP BY doc_id),
        k AS (
            SELECT d.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
                   CASE WHEN gone IS NULL THEN words ELSE
                       list_transform(list_filter(range(1, len(words) + 1), lambda x: NOT list_contains(gone, x)), lambda x: words[x]) END AS kept
            FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
    """,
    "op11_merkle_manifest": r"""
    WITH RECURSIVE fields AS (
        SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS digits,
               list_transform(range(256), lambda i: list_reduce(range(8),
                   lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS crc
        FROM documents),
    sized AS (
        SELECT *, coalesce(list_aggregate(list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
                   lambda v: coalesce(CAST(strlen(v) AS VARCHAR) || ':' || v, '-')), 'string_agg', ''), '') AS head,
               xor(4294967295, list_reduce(digits, lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS BIGINT) + 1]), 4294967295)) % 5 = 0 AS asked
        FROM fields),
    leaves AS (
        SELECT doc_id, source, sha256(head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
               sha256(head || CASE WHEN text IS NULL THEN '-' WHEN asked THEN CAST(strlen(low) AS VARCHAR) || ':' || low
                              ELSE CAST(strlen(text) AS VARCHAR) || ':' || text END) AS changed
        FROM sized),
    placed AS (
        SELECT *, coalesce('=' || source, '-') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
               count(*) OVER (PARTITION BY source) AS n
        FROM leaves),
    nodes AS (
        SELECT tree, 0 AS lvl, idx, leaf AS h, n FROM placed
        UNION ALL
        SELECT tree, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 16, n),
    runs AS (SELECT tree, lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs, any_value(n) AS n FROM nodes GROUP BY ALL),
    subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS lvl, place AS idx, subroot AS h, trees AS n FROM subroots
        UNION ALL
        SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM tops WHERE n > 1 GROUP BY lvl, idx // 16, n),
    top_runs AS (SELECT lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs, any_value(n) AS n FROM tops GROUP BY ALL),
    inner_way AS (
        SELECT doc_id, tree, leaf, idx AS id, 0 AS lvl, idx, n, changed AS h, '' AS proof FROM placed
        UNION ALL
        SELECT doc_id, w.tree, leaf, id, w.lvl + 1, idx // 16, (w.n + 15) // 16,
               sha256(array_to_string(hs[1:idx % 16], '') || h || array_to_string(hs[idx % 16 + 2:], '')),
               proof || array_to_string(hs[1:idx % 16], '') || array_to_string(hs[idx % 16 + 2:], '')
        FROM inner_way w JOIN runs r ON r.tree = w.tree AND r.lvl = w.lvl AND r.run = idx // 16 WHERE w.n > 1),
    outer_way AS (
        SELECT doc_id, w.tree, leaf, id, subroot, 0 AS lvl, place AS idx, trees AS n, h, proof FROM inner_way w JOIN subroots s ON s.tree = w.tree WHERE w.n = 1
        UNION ALL
        SELECT doc_id, tree, leaf, id, subroot, w.lvl + 1, idx // 16, (w.n + 15) // 16,
               sha256(array_to_string(hs[1:idx % 16], '') || h || array_to_string(hs[idx % 16 + 2:], '')),
               proof || array_to_string(hs[1:idx % 16], '') || array_to_string(hs[idx % 16 + 2:], '')
        FROM outer_way w JOIN top_runs r ON r.lvl = w.lvl AND r.run = idx // 16 WHERE w.n > 1)
    SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
    FROM outer_way w, (SELECT h FROM tops WHERE n = 1) t WHERE w.n = 1
""",
}
