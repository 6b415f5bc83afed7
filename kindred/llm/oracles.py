"""DuckDB statements that registered queries must equal."""

OP2 = """
WITH sizes AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sizes GROUP BY source
), rising AS (
    SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / weight AS ratio FROM totals
), levels AS (
    SELECT *,
           (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
    FROM rising
), targets AS (
    SELECT source, source_size,
           least(cap::DOUBLE, coalesce((SELECT arg_min(lvl, ratio) FROM levels WHERE ratio >= lvl) * weight,
                                       cap::DOUBLE)) AS target
    FROM levels
), split AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM targets
), running AS (
    SELECT s.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS missing,
           sum(size) OVER (PARTITION BY s.source ORDER BY k, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM sizes s JOIN split t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN upto - size / 2 < missing THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""

OP5 = """
WITH items AS (
    SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT item, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM windows
), docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), places AS (
    SELECT row, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM docs, lengths WHERE len(w) >= n)
), found AS (
    SELECT DISTINCT row, i, p.n, item FROM places p JOIN windows USING (win)
), hits AS (
    SELECT row, count(DISTINCT place) AS n_hit
    FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS place FROM found) GROUP BY row
), named AS (
    SELECT row, count(DISTINCT item) AS n_items,
           string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT row, item FROM found) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""


def _op8() -> str:
    from kindred.llm.license_scan import GAP, RULES, SENTENCES

    known = ", ".join(f"('{name}', '{sentence}')" for name, sentence in SENTENCES.items())
    steps = ", ".join(
        f"('{rule}', '{licence}', {k}, '{name}', {len(names)})"
        for rule, (licence, names) in RULES.items()
        for k, name in enumerate(names)
    )
    return f"""
WITH RECURSIVE known(known, sentence) AS (VALUES {known}),
steps(rule, licence, step, wanted, n_steps) AS (VALUES {steps}),
docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           [s FOR s IN [trim(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) FOR t IN string_split(
               regexp_replace(lower(text), '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10))] IF s <> '']
           AS sentences
    FROM documents
), places AS (
    SELECT row, pos, known
    FROM (SELECT row, unnest(sentences) AS sentence,
                 unnest(generate_series(1, len(sentences))) AS pos FROM docs) JOIN known USING (sentence)
), chains AS (
    SELECT row, pos, rule, licence, step, n_steps
    FROM places JOIN steps ON wanted = known AND step = 0
    UNION
    SELECT c.row, p.pos, c.rule, c.licence, s.step, c.n_steps
    FROM chains c JOIN steps s ON s.rule = c.rule AND s.step = c.step + 1
    JOIN places p ON p.row = c.row AND p.known = s.wanted
                  AND p.pos > c.pos AND p.pos <= c.pos + 1 + {GAP}
), matched AS (
    SELECT row, count(*) AS n_matches FROM chains WHERE step = n_steps - 1 GROUP BY row
), named AS (
    SELECT row, string_agg(licence, ',' ORDER BY licence) AS licenses
    FROM (SELECT DISTINCT row, licence FROM chains WHERE step = n_steps - 1) GROUP BY row
), counted AS (
    SELECT row, count(*) AS n_known FROM places GROUP BY row
)
SELECT doc_id, coalesce(len(sentences), 0)::BIGINT AS n_sentences, coalesce(n_known, 0)::BIGINT AS n_known,
       coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses
FROM docs LEFT JOIN counted USING (row) LEFT JOIN matched USING (row) LEFT JOIN named USING (row)
"""


OP10 = """
WITH heads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM heads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""

OP11 = """
WITH rules(rule_host, rule_path, action) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parsed AS (
    SELECT row_number() OVER () AS row, page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), fitting AS (
    SELECT row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(action, length(rule_host || rule_path)) AS action
    FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                           AND starts_with(path, rule_path)
    GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parsed LEFT JOIN fitting USING (row)
"""

OP13 = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''),
               '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
           sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, text, u, len(u) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h
    FROM units
), cuts AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h[3] % 100 >= 50 THEN 'plain'
                WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(u[1 : least(h[1] % (n + 1), h[2] % (n + 1))], '') AS prefix,
           array_to_string(u[1 + least(h[1] % (n + 1), h[2] % (n + 1))
                             : greatest(h[1] % (n + 1), h[2] % (n + 1))], '') AS middle,
           array_to_string(u[1 + greatest(h[1] % (n + 1), h[2] % (n + 1)) :], '') AS suffix
    FROM numbers
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cuts
"""

ORACLES = {
    "op2_mix_sources": OP2,
    "op5_decontamination": OP5,
    "op8_license_scan": _op8(),
    "op10_warc_revisits": OP10,
    "op11_url_filter": OP11,
    "op13_fill_middle": OP13,
}
