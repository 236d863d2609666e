"""The registered queries of this subpackage, one per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelake.llm import (
    bpe, exact_dedup, filter_audit, html_extract, merkle, minhash_join, mixing, private_data, quality_rules, sharding, token_counts,
    token_files, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_extract.query,
    "op2_quality_rules": quality_rules.query,
    "op3_token_counts": token_counts.query,
    "op4_minhash_join": minhash_join.query,
    "op5_mixing": mixing.query,
    "op6_token_files": token_files.query,
    "op7_private_data": private_data.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_bpe": bpe.query,
    "op10_sharding": sharding.query,
    "op11_url_filter": url_filter.query,
    "op12_merkle": merkle.query,
    "op13_filter_audit": filter_audit.query,
}

# DuckDB twins of the queries that SQL can express; the others are held against brute force in tests/llm.
SQL: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op11_url_filter": rf"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after FROM pages),
        p AS (
            SELECT page_id, translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        rules AS (SELECT * FROM (VALUES {", ".join(map(str, url_filter.RULES))}) AS r(verdict, rule_host, rule_path)),
        fit AS (
            SELECT page_id, host, path, max(struct_pack(n := length(rule_host || rule_path), h := length(rule_host),
                                            rule := rule_host || rule_path, verdict := verdict)) AS best
            FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY ALL)
        SELECT page_id, host, path, best.rule AS rule,
               CASE WHEN best.rule IS NOT NULL THEN best.verdict
                    WHEN list_has_any(string_split_regex(host, '[.-]'), {url_filter.WORDS}) THEN 'block' ELSE 'allow' END AS verdict
        FROM fit
    """,
    "op13_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        m AS (
            SELECT d.part,
                   CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * list_unique(w) < 80 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 16 ELSE 0 END AS mask,
                   coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
            FROM d LEFT JOIN (
                SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
                FROM labels GROUP BY doc_id) l USING (doc_id)),
        c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
        f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)),
        o AS (
            SELECT a.name || b.name || g.name || h.name || i.name AS filter_order, [a.bit, b.bit, g.bit, h.bit, i.bit] AS bits
            FROM f a, f b, f g, f h, f i WHERE a.bit | b.bit | g.bit | h.bit | i.bit = 31),
        s AS (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM o),
        x AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before FROM s),
        r AS (
            SELECT part, filter_order, step, bit,
                   sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                   sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM c, x GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM r
    """,
}
