"""The same results as SQL, where SQL can express them."""

from __future__ import annotations

from strataload.llm.tables import LOWER, UPPER
from strataload.llm.url_filter import BASE_RULES, METHOD_RULES


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Lloyd's rounds as a chain of tables: every part against every entry, then the floors of the means."""
    steps = [
        f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, label, embedding FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), v AS MATERIALIZED (
          SELECT vec_id, (i - 1) // (len(embedding) // {parts}) AS part, (i - 1) % (len(embedding) // {parts}) AS place,
            floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
          FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
        ), first AS (
          SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}
        ), book0 AS MATERIALIZED (
          SELECT part, entry, place, x FROM v JOIN first USING (vec_id)
        )"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
          SELECT vec_id, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
            SELECT vec_id, v.part, entry, sum((v.x - b.x) * (v.x - b.x)) AS d
            FROM v JOIN book{r} b ON v.part = b.part AND v.place = b.place GROUP BY vec_id, v.part, entry
          ) GROUP BY vec_id, part
        )""")
        if r < rounds:
            steps.append(f"""mean{r} AS (
          SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM v JOIN near{r} USING (vec_id, part)
          GROUP BY part, entry, place
        ), book{r + 1} AS MATERIALIZED (
          SELECT b.part, b.entry, b.place,
            CASE WHEN n IS NULL THEN x ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS x
          FROM book{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
        )""")
    return ", ".join(steps) + f""", coded AS (
          SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
          FROM near{rounds} GROUP BY vec_id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
          (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)
    """


def _url_verdicts() -> str:
    """Every rule against every URL, without an index."""
    base = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in BASE_RULES)
    method = ", ".join(f"('{r.pattern}', '{r.verdict}')" for r in METHOD_RULES)
    return rf"""
        WITH u AS (
          SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
            coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages
        ), b(rule_host, rule_path, verdict) AS (VALUES {base}
        ), m(pattern, verdict) AS (VALUES {method}
        )
        SELECT page_id, host, path, fit.name AS rule, coalesce(fit.verdict, other.verdict, 'allow') AS verdict,
          other.name AS method_rule
        FROM (
          SELECT page_id, host, path,
            (SELECT arg_max({{'name': rule_host || rule_path, 'verdict': verdict}}, length(rule_host || rule_path)) FROM b
             WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS fit,
            (SELECT arg_max({{'name': pattern, 'verdict': verdict}}, (length(pattern), pattern)) FROM m
             WHERE host <> '' AND regexp_matches(host || path, pattern)) AS other
          FROM u
        )
    """


ORACLES = {
    "op8_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
          FROM documents
        ), g AS (
          SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
    "op10_url_filters": _url_verdicts(),
    "op11_cover_codes": _vector_codes(),
    "op13_infill": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
            regexp_extract_all(body, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
          FROM documents
        ), u AS (
          SELECT doc_id, body, tokens, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(tokens) + 1) AS a,
            ('0x' || substr(h, 9, 8))::BIGINT % (len(tokens) + 1) AS b,
            CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
          FROM d
        ), c AS (
          SELECT doc_id, body, n, form, array_to_string(tokens[:least(a, b)], '') AS prefix,
            array_to_string(tokens[least(a, b) + 1:greatest(a, b)], '') AS middle,
            array_to_string(tokens[greatest(a, b) + 1:], '') AS suffix
          FROM u
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
          CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
          sha256(body) AS restored_sha256
        FROM c
    """,
}
