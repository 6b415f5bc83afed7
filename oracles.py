"""DuckDB statements that state what each registered query should return.

They work on single documents and plain lists, without the grouping of copies,
prefix filters and stored stages of the Spark jobs they check.
"""

from __future__ import annotations

from kindred.functions.minhash import PRIME, hash_family, place_values
from kindred.operators.evaluation import SWEEP
from kindred.plans.market_basket import EVENT_SUPPORT, ORDER_SUPPORT
from kindred.plans.near_duplicates import (
    BANDS,
    CLEAN_BANDS,
    CLEAN_HASHES,
    CLEAN_SHINGLE,
    LEAST_LIKE,
    LONG_BANDS,
    LONG_ROWS,
    N_HASHES,
    ROWS,
    SHINGLE,
    SHORT_BANDS,
    SHORT_ROWS,
)
from kindred.sources.writers import RULE_HEAD, RULE_LINE

# --- market basket ---------------------------------------------------------

ORDER_ROWS = """
rows AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item
         FROM lineitem JOIN part ON l_partkey = p_partkey)"""

EVENT_ROWS = """
rows AS (SELECT DISTINCT user_id::VARCHAR || '|' || ts::DATE::VARCHAR AS basket,
                event_type AS item FROM events)"""


def itemset_ctes(support: dict[int, float]) -> str:
    return f"""
n AS (SELECT count(DISTINCT basket) AS n FROM rows),
f1 AS (SELECT [item] AS items, count(*) AS cnt FROM rows GROUP BY item
       HAVING count(*) > {support[1]}::DOUBLE * (SELECT n FROM n)),
kept AS (SELECT basket, item FROM rows WHERE [item] IN (SELECT items FROM f1)),
f2 AS (SELECT [a.item, b.item] AS items, count(*) AS cnt
       FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
       GROUP BY a.item, b.item
       HAVING count(*) > {support[2]}::DOUBLE * (SELECT n FROM n)),
f3 AS (SELECT [a.item, b.item, c.item] AS items, count(*) AS cnt
       FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
       JOIN kept c ON a.basket = c.basket AND b.item < c.item
       WHERE [a.item, b.item] IN (SELECT items FROM f2)
         AND [a.item, c.item] IN (SELECT items FROM f2)
         AND [b.item, c.item] IN (SELECT items FROM f2)
       GROUP BY a.item, b.item, c.item
       HAVING count(*) > {support[3]}::DOUBLE * (SELECT n FROM n))"""


ORDERS = "WITH" + ORDER_ROWS + "," + itemset_ctes(ORDER_SUPPORT)
EVENTS = "WITH" + EVENT_ROWS + "," + itemset_ctes(EVENT_SUPPORT)

LABEL = """CASE WHEN len({0}) = 1 THEN {0}[1]
     ELSE '(''' || array_to_string({0}, ''', ''') || ''')' END"""


def level_sql(k: int) -> str:
    return f"{ORDERS} SELECT array_to_string(items, ', ') AS items, cnt FROM f{k}"


def top_select(k: int) -> str:
    return f"""SELECT 'Top 10 frequent itemsets for k={k}:' AS line UNION ALL
SELECT {LABEL.format('items')} || ': ' || cnt AS line
FROM (SELECT items, cnt FROM f{k} ORDER BY cnt DESC, items LIMIT 10)"""


def rule_ctes(k: int, literal: bool) -> str:
    """CTE ``rules{k}``; antecedent is a list."""
    second = "substr(r.antecedent[1], 2, 1)" if k == 2 else "r.antecedent[2]"
    if literal:
        px, py, base, divisor = "cx", "cy", "total", "cs"
    else:
        px, py, base, divisor = "(cx / n)", "(cy / n)", "n", "(cy / n)"
    low = f"(greatest({px} + {py} - 1, 1 / n) / ({px} * {py}))"
    width = f"(1 / greatest({px}, {py}) - {low})"
    return f"""
directed{k} AS (
  SELECT items, cnt, list_filter(items, lambda i: i <> c) AS antecedent, c AS consequent
  FROM (SELECT items, cnt, unnest(items) AS c FROM f{k})),
counted{k} AS (
  SELECT r.antecedent, r.consequent, r.cnt, coalesce(x.cnt, 1)::DOUBLE AS cx,
         coalesce(y.cnt, 1)::DOUBLE AS cy, coalesce(s.cnt, 1)::DOUBLE AS cs,
         (SELECT n FROM n)::DOUBLE AS n, (SELECT sum(cnt) FROM f1)::DOUBLE AS total
  FROM directed{k} r
  LEFT JOIN f{k - 1} x ON x.items = r.antecedent
  LEFT JOIN f1 y ON y.items = [r.consequent]
  LEFT JOIN f1 s ON s.items = [{second}]),
lifted{k} AS (
  SELECT *, cnt / cx AS confidence, cnt / cx - cy / {base} AS interest,
         cnt / cx / {divisor} AS lift FROM counted{k}),
rules{k} AS (
  SELECT {k} AS k, antecedent, consequent, cnt AS support_cnt, confidence, interest, lift,
         (lift - {low}) / CASE WHEN {width} = 0 THEN 1.0 ELSE {width} END AS std_lift
  FROM lifted{k})"""


def rules_sql(k: int, literal: bool) -> str:
    return f"""{ORDERS},{rule_ctes(k, literal)}
SELECT array_to_string(antecedent, ', ') AS antecedent, consequent, support_cnt,
       round(confidence, 6) AS confidence, round(interest, 6) AS interest,
       round(lift, 6) AS lift, round(std_lift, 6) AS std_lift FROM rules{k}"""


def report_select(k: int) -> str:
    """Report lines from CTE ``rules{k}``."""
    numbers = " || ".join(
        f"chr(9) || printf('%.4f', {c})" for c in ("std_lift", "lift", "confidence", "interest")
    )
    head = ", ".join(f"'{line}'" for line in ("Association Rules", RULE_LINE, RULE_HEAD[k], RULE_LINE))
    return f"""SELECT unnest([{head}]) AS line UNION ALL
SELECT {LABEL.format('antecedent')} || ' -> ' || consequent || {numbers} AS line
FROM rules{k} WHERE std_lift >= 0.2"""


def stable_hash(parts: str) -> str:
    """Hash of a text made of the parts, as the sampling operators compute it."""
    return f"('0x' || substr(md5({parts}), 1, 15))::BIGINT"


def baskets_of(source: str) -> str:
    return f"""SELECT basket AS basket_id, array_to_string(list_sort(list(item)), ', ') AS items
FROM {source} GROUP BY basket"""


MARKET_BASKET = {
    "frequent_items_k1": level_sql(1),
    "frequent_pairs": level_sql(2),
    "frequent_triples": level_sql(3),
    "frequent_itemsets": EVENTS
    + " UNION ALL ".join(
        f" SELECT {k} AS k, array_to_string(items, ', ') AS items, cnt FROM f{k}"
        for k in (1, 2, 3)
    ),
    "top10_items": f"{ORDERS} {top_select(1)}",
    "top10_pairs": f"{ORDERS} {top_select(2)}",
    "top10_triples": f"{ORDERS} {top_select(3)}",
    "rules_k2": rules_sql(2, literal=False),
    "rules_k3": rules_sql(3, literal=False),
    "rules_k2_literal": rules_sql(2, literal=True),
    "rules_k3_literal": rules_sql(3, literal=True),
    "rules_filtered": f"""{ORDERS},{rule_ctes(2, False)},{rule_ctes(3, False)}
SELECT k, array_to_string(antecedent, ', ') AS antecedent, consequent,
       round(std_lift, 6) AS std_lift
FROM (SELECT * FROM rules2 UNION ALL SELECT * FROM rules3) WHERE std_lift >= 0.2""",
    "rule_report_k2": f"{ORDERS},{rule_ctes(2, True)} {report_select(2)}",
    "rule_report_k3": f"{ORDERS},{rule_ctes(3, True)} {report_select(3)}",
    "report_files": f"{ORDERS},{rule_ctes(2, True)},{rule_ctes(3, True)} "
    + " UNION ALL ".join(
        f"(SELECT line FROM ({part}))"
        for part in [top_select(k) for k in (1, 2, 3)] + [report_select(k) for k in (2, 3)]
    ),
    "event_baskets": f"WITH {EVENT_ROWS} {baskets_of('rows')}",
    "basket_sizes": f"WITH {ORDER_ROWS} SELECT basket, count(*) AS n_items FROM rows GROUP BY basket",
    "basket_sample": f"""WITH {EVENT_ROWS}
{baskets_of(f"(SELECT * FROM rows WHERE {stable_hash("'42:' || basket")} % 100 < 6)")}""",
    "row_sample": f"""WITH rows AS (
  SELECT DISTINCT user_id::VARCHAR || '|' || ts::DATE::VARCHAR AS basket, event_type AS item
  FROM events WHERE {stable_hash("'42:' || event_id")} % 100 < 6) {baskets_of('rows')}""",
    "row_counts": f"""WITH taken AS (
  SELECT * FROM events WHERE {stable_hash("'42:' || event_id")} % 100 < 6)
SELECT (SELECT count(*) FROM events) AS n_rows, count(*) AS n_sampled,
       count(DISTINCT (user_id, ts::DATE)) AS n_baskets FROM taken""",
    "csv_conditions": """SELECT event_type AS item, count(DISTINCT user_id) AS cnt
FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL GROUP BY event_type""",
    "basket_text": f"""WITH {ORDER_ROWS}
SELECT items, count(*) AS n_baskets FROM ({baskets_of('rows')}) GROUP BY items""",
}

# --- near duplicates -------------------------------------------------------

UNIQUE = """
uniq AS (SELECT min(doc_id) AS doc_id, text, count(*) AS n_copies
         FROM documents WHERE text IS NOT NULL GROUP BY text)"""

CLEAN = r"lower(trim(regexp_replace({0}, '[^\p{{L}}\p{{N}}_]+', ' ', 'g')))"


CLEANED = f"cleaned AS (SELECT doc_id, {CLEAN.format('text')} AS text FROM documents)"


def grams(name: str, source: str, k: int, text: str = "text") -> str:
    """CTE of the distinct shingles of ``source``."""
    gram = " || ".join(f"c[i + {j}]" for j in range(k))
    return f"""
{name} AS (SELECT DISTINCT doc_id, {gram} AS g
  FROM (SELECT doc_id, string_split({text}, '') AS c FROM {source} WHERE length({text}) >= {k}),
       unnest(range(1, len(c) - {k} + 2)) AS t(i))"""


def signature_cte(
    source: str, n_hashes: int = N_HASHES, k: int = SHINGLE, name: str = "sigs"
) -> str:
    """CTE of the MinHash signatures of ``source``."""
    weights = place_values(k)
    base = " + ".join(f"c[i + {j}] * {weight}" for j, weight in enumerate(weights))
    minima = ", ".join(
        f"min(({a} * x + {b}) % {PRIME})" for a, b in hash_family(n_hashes)
    )
    return f"""
{name} AS (SELECT doc_id, [{minima}] AS sig
  FROM (SELECT doc_id, ({base}) % {PRIME} AS x
        FROM (SELECT doc_id,
                     list_transform(string_split(text, ''), lambda z: ord(z)::BIGINT) AS c
              FROM {source} WHERE length(text) >= {k}),
             unnest(range(1, len(c) - {k} + 2)) AS t(i))
  GROUP BY doc_id)"""


def band_select(g: int, r: int, source: str = "sigs") -> str:
    return f"""SELECT doc_id, band,
       md5(array_to_string(sig[band * {r} + 1 : band * {r} + {r}], ',')) AS key
  FROM {source}, unnest(range(0, {g})) AS b(band)"""


def pairs_select(bands: str) -> str:
    return f"""SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_bands
  FROM {bands} a JOIN {bands} b ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id"""


def stage(
    source: str, n_hashes: int = N_HASHES, k: int = SHINGLE, b: int = BANDS, r: int = ROWS
) -> str:
    """CTEs from signatures to candidate pairs of ``source``."""
    return f"""{signature_cte(source, n_hashes, k)},
bands AS ({band_select(b, r)}),
cand AS ({pairs_select('bands')})"""


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"({both}::DOUBLE / (len({a}) + len({b}) - {both}))"


CHARS = """
chars AS (SELECT doc_id, list_distinct(string_split(text, '')) AS cs
          FROM documents WHERE length(text) > 0)"""

CHAR_PAIRS = f"""
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, {jaccard('a.cs', 'b.cs')} AS sim
          FROM chars a JOIN chars b ON a.doc_id < b.doc_id)"""


def shingle_pairs(source: str, k: int = SHINGLE) -> str:
    """CTEs ending in ``spairs``: all pairs that share a shingle, with similarity."""
    return f"""{grams('grams', source, k)},
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
spairs AS (SELECT x, y, m::DOUBLE / (sx.n + sy.n - m) AS sim
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
        FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
        GROUP BY a.doc_id, b.doc_id)
  JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y)"""


def evaluated(candidates: str) -> str:
    """Quality and error rates of a candidate table against ``pairs``."""
    n_pairs = "(SELECT count(*) * (count(*) - 1) / 2 FROM documents)"
    return f"""SELECT *, n_under_60 AS n_fp, n_similar - n_over_85 AS n_fn,
  round(n_over_85 * 100 / nullif(n_candidates, 0), 6) AS pct_over_85,
  round(n_under_60 * 100 / nullif(n_candidates, 0), 6) AS pct_under_60,
  n_over_85 * 100 / nullif(n_candidates, 0) > 90 AS cond_1,
  n_under_60 * 100 / nullif(n_candidates, 0) < 5 AS cond_2,
  round(n_under_60 * 100 / nullif(n_pairs, 0), 6) AS pct_fp,
  round((n_similar - n_over_85) * 100 / nullif(n_pairs, 0), 6) AS pct_fn
FROM (SELECT count(*)::DOUBLE AS n_candidates,
        count(*) FILTER (sim > 0.85::DOUBLE)::DOUBLE AS n_over_85,
        count(*) FILTER (sim < 0.6::DOUBLE)::DOUBLE AS n_under_60,
        {n_pairs}::DOUBLE AS n_pairs,
        (SELECT count(*) FROM pairs WHERE sim > 0.85::DOUBLE)::DOUBLE AS n_similar
      FROM {candidates} JOIN pairs USING (x, y))"""


EVALUATION = f"WITH {CHARS},{CHAR_PAIRS},{stage('documents')}"
SHORT_EVALUATION = f"WITH {CHARS},{CHAR_PAIRS},{stage('documents', b=SHORT_BANDS, r=SHORT_ROWS)}"


def sweep_sql() -> str:
    rows = []
    for b, r in SWEEP:
        g = min(b, N_HASHES // r)
        rows.append(
            f"SELECT {b} AS b, {r} AS r, {g} AS n_bands, * EXCLUDE (n_similar) "
            f"FROM ({evaluated(f'c{g}x{r}')})"
        )
    cuts = sorted({(min(b, N_HASHES // r), r) for b, r in SWEEP})
    ctes = ",\n".join(
        f"b{g}x{r} AS ({band_select(g, r)}),\nc{g}x{r} AS ({pairs_select(f'b{g}x{r}')})"
        for g, r in cuts
    )
    return (
        f"WITH {CHARS},{CHAR_PAIRS},{signature_cte('documents')},\n{ctes}\n"
        + " UNION ALL ".join(rows)
    )


def similar_sql(domain: str) -> str:
    """Similar documents of the first hundred, on documents with all their copies."""
    asked = "asked AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100)"
    both = """both_ways AS (SELECT x AS doc_id, y AS other_id FROM cand
                  UNION ALL SELECT y, x FROM cand)"""
    if domain == "char":
        return f"""WITH {stage('documents')},{CHARS}, {asked}, {both}
SELECT doc_id, other_id, round(sim, 6) AS sim FROM (
  SELECT p.doc_id, p.other_id, {jaccard('a.cs', 'b.cs')} AS sim
  FROM both_ways p JOIN asked USING (doc_id)
  JOIN chars a ON a.doc_id = p.doc_id JOIN chars b ON b.doc_id = p.other_id)
WHERE sim > 0.85 AND sim < 1"""
    return f"""WITH {stage('documents')},{shingle_pairs('documents')}, {asked}, {both}
SELECT p.doc_id, p.other_id, round(s.sim, 6) AS sim
FROM both_ways p JOIN asked USING (doc_id)
JOIN spairs s ON s.x = least(p.doc_id, p.other_id) AND s.y = greatest(p.doc_id, p.other_id)
WHERE s.sim >= 0.85"""


DENSE_ORDER = f"""
numbered AS (SELECT doc_id, row_number() OVER
  (ORDER BY {stable_hash('doc_id::VARCHAR')} % 65536, doc_id) - 1 AS idx FROM {{source}})"""


def pair_sample_ctes(source: str) -> str:
    """CTEs ending in ``drawn``: distinct unordered pairs of ten draws per row."""
    return f"""{DENSE_ORDER.format(source=source)},
size AS (SELECT count(*) AS n FROM {source}),
picks AS (SELECT {stable_hash("'42:' || d || ':x'")} % n AS ix,
                 {stable_hash("'42:' || d || ':y'")} % n AS iy
          FROM size, unnest(range(0, n * 10)) AS t(d)),
drawn AS (SELECT DISTINCT least(a.doc_id, b.doc_id) AS x, greatest(a.doc_id, b.doc_id) AS y
  FROM picks JOIN numbered a ON a.idx = ix JOIN numbered b ON b.idx = iy WHERE ix <> iy)"""


POINTS = f"""WITH {signature_cte('documents')},
bands AS ({band_select(BANDS, ROWS)}),
cand AS ({pairs_select('bands')}),
{pair_sample_ctes('sigs')},
points AS (
  SELECT d.x, d.y, {jaccard('list_distinct(a.sig)', 'list_distinct(b.sig)')} AS jaccard,
         list_cosine_similarity(a.sig::DOUBLE[], b.sig::DOUBLE[]) AS cosine,
         c.x IS NOT NULL AS is_candidate
  FROM drawn d JOIN sigs a ON a.doc_id = d.x JOIN sigs b ON b.doc_id = d.y
  LEFT JOIN cand c ON c.x = d.x AND c.y = d.y)"""



def sampled_sql(source: str, n_hashes: int = N_HASHES, k: int = SHINGLE, b: int = BANDS) -> str:
    """Error rates averaged over ten samples of ``source``, a table of ids and texts."""
    return f"""sampled AS (
  SELECT seed, doc_id FROM (
    SELECT seed, doc_id, row_number() OVER (PARTITION BY seed
      ORDER BY {stable_hash("seed || ':' || doc_id")}, doc_id) AS rank
    FROM documents, unnest(range(0, 10)) AS t(seed)) WHERE rank <= 100),
picked AS (SELECT doc_id, text FROM {source} WHERE doc_id IN (SELECT doc_id FROM sampled)),
{stage('picked', n_hashes, k, b)},{shingle_pairs('picked', k)},
pairs AS (SELECT a.seed, a.doc_id AS x, b.doc_id AS y
          FROM sampled a JOIN sampled b ON a.seed = b.seed AND a.doc_id < b.doc_id),
judged AS (SELECT p.seed, coalesce(s.sim, 0) AS sim, c.x IS NOT NULL AS is_candidate
  FROM pairs p LEFT JOIN spairs s ON s.x = p.x AND s.y = p.y
  LEFT JOIN cand c ON c.x = p.x AND c.y = p.y),
rates AS (SELECT seed, count(*) FILTER (is_candidate AND sim < 0.85::DOUBLE) AS fp,
                 count(*) FILTER (NOT is_candidate AND sim >= 0.85::DOUBLE) AS fn, count(*) AS n
          FROM judged GROUP BY seed)
SELECT count(*) AS n_samples, sum(fp)::BIGINT AS n_fp, sum(fn)::BIGINT AS n_fn,
       round(avg(fp * 100.0::DOUBLE / n), 6) AS pct_fp,
       round(avg(fn * 100.0::DOUBLE / n), 6) AS pct_fn FROM rates"""


TUNE = f"""WITH {stage('documents')},{shingle_pairs('documents')},
scored AS (SELECT c.x, c.y, coalesce(s.sim, 0) AS sim
           FROM cand c LEFT JOIN spairs s ON s.x = c.x AND s.y = c.y),
levels AS (SELECT round(avg(sim) FILTER (sim >= 0.85::DOUBLE), 4) AS s1,
                  round(avg(sim) FILTER (sim < 0.85::DOUBLE), 4) AS s2 FROM scored),
grid AS (SELECT s1, s2, b::INTEGER AS b, r::INTEGER AS r,
                1 - (1 - s1 ** r) ** b AS p_s1, 1 - (1 - s2 ** r) ** b AS p_s2
         FROM levels, unnest(range(1, 51)) AS tb(b), unnest(range(2, 51)) AS tr(r)),
flagged AS (SELECT *, p_s1 >= 0.9::DOUBLE AND p_s2 <= 0.05::DOUBLE
                      AND {N_HASHES} % r = 0 AND b * r <= {N_HASHES} AS feasible FROM grid)
SELECT s1, s2, b, r, round(p_s1, 6) AS p_s1, round(p_s2, 6) AS p_s2, feasible,
       row_number() OVER (ORDER BY feasible DESC, p_s1 DESC, p_s2, b, r) = 1 AS is_best
FROM flagged"""

CLASSES = f"""WITH RECURSIVE {UNIQUE},{stage('uniq')},
edges AS (SELECT x, y FROM cand UNION ALL SELECT y, x FROM cand),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sigs
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
classed AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id)"""

ASKED = f"""WITH asked AS (SELECT item_id AS doc_id, text FROM benchmark),
{signature_cte('documents')},{signature_cte('asked', name='asked_sigs')},
bands AS ({band_select(SHORT_BANDS, SHORT_ROWS)}),
asked_bands AS ({band_select(SHORT_BANDS, SHORT_ROWS, 'asked_sigs')}),
found AS (SELECT DISTINCT a.doc_id AS query_id, b.doc_id
          FROM asked_bands a JOIN bands b USING (band, key)),
{grams('held', 'documents', SHINGLE)},{grams('wanted', 'asked', SHINGLE)},
sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
wanted_sizes AS (SELECT doc_id, count(*) AS n FROM wanted GROUP BY doc_id),
shared AS (SELECT w.doc_id AS query_id, h.doc_id, count(*) AS m
           FROM wanted w JOIN held h USING (g) GROUP BY 1, 2)"""

NEAR_DUPLICATES = {
    "lsh_classes": f"""{CLASSES}
SELECT class_id, count(*) AS n_texts, sum(n_copies)::BIGINT AS n_documents,
       sum((SELECT count(*) FROM cand WHERE cand.x = classed.doc_id))::BIGINT AS n_links
FROM classed JOIN uniq USING (doc_id) GROUP BY class_id HAVING sum(n_copies) > 1""",
    "lsh_class_members": f"""{CLASSES}
SELECT d.doc_id, class_id FROM classed JOIN uniq USING (doc_id)
JOIN documents d ON d.text = uniq.text""",
    "similar_to_texts": f"""{ASKED}
SELECT query_id, doc_id, round(sim, 6) AS sim FROM (
  SELECT query_id, doc_id, m::DOUBLE / (a.n + b.n - m) AS sim
  FROM shared JOIN found USING (query_id, doc_id)
  JOIN wanted_sizes a ON a.doc_id = query_id JOIN sizes b USING (doc_id))
WHERE sim >= {LEAST_LIKE}::DOUBLE""",
    "latest_turn": "SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id",
    "json_documents": "SELECT doc_id, text FROM documents",
    "tsv_sentences": f"SELECT {CLEAN.format('text')} AS sentence_A FROM benchmark",
    "tsv_texts": "SELECT text AS sentence_A FROM documents WHERE text <> ''",
    "last_lines": "SELECT conv_id AS doc_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id",
    "quarantined_documents": """
SELECT CASE doc_id % 20 WHEN 3 THEN 'not readable' WHEN 7 THEN 'no object' WHEN 11 THEN 'not readable'
                        WHEN 15 THEN 'no id' ELSE 'kept' END AS outcome, count(*) AS n_lines
FROM documents WHERE text IS NOT NULL GROUP BY outcome""",
    "quarantined_conditions": """
SELECT CASE WHEN event_id % 10 IN (4, 8) THEN 'not as the header' ELSE event_type END AS outcome,
       count(*) AS n_lines
FROM events GROUP BY outcome""",
    "clean_text": f"SELECT doc_id, {CLEAN.format('text')} AS text FROM documents",
    "first_documents": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 1000",
    "preview": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10",
    "document_sample": f"""SELECT doc_id FROM documents
ORDER BY {stable_hash("'42:' || doc_id")}, doc_id LIMIT 100""",
    "random_document": f"""SELECT doc_id, text FROM documents
ORDER BY {stable_hash("'42:' || doc_id")}, doc_id LIMIT 1""",
    "pair_sample": f"WITH {pair_sample_ctes('documents')} SELECT x, y FROM drawn",
    "shingle_counts": f"""WITH {grams('full_range', 'documents', SHINGLE)},
cut AS (SELECT doc_id, text[:-2] AS text FROM documents),
{grams('without_last', 'cut', SHINGLE)},
cleaned AS (SELECT doc_id, {CLEAN.format('text')} AS text FROM documents),
{grams('clean', 'cleaned', CLEAN_SHINGLE)}
SELECT doc_id, coalesce(a.n, 0) AS n_shingles, coalesce(b.n, 0) AS n_without_last,
       coalesce(c.n, 0) AS n_clean
FROM documents
LEFT JOIN (SELECT doc_id, count(*) AS n FROM full_range GROUP BY doc_id) a USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM without_last GROUP BY doc_id) b USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM clean GROUP BY doc_id) c USING (doc_id)""",
    "shingle_vocab": f"""WITH cleaned AS (
  SELECT doc_id, {CLEAN.format('text')} AS text FROM documents),
{grams('grams', 'cleaned', CLEAN_SHINGLE)}
SELECT g AS shingle, count(*) AS n_docs FROM grams GROUP BY g""",
    "copy_groups": f"WITH {UNIQUE} SELECT doc_id AS rep_id, n_copies FROM uniq",
    "minhash_signatures": f"""WITH {signature_cte('documents')}
SELECT doc_id, array_to_string(sig, ',') AS signature FROM sigs""",
    "literal_signatures": f"""WITH
cut AS (SELECT doc_id, text[:-2] AS text FROM documents WHERE text IS NOT NULL),
one AS (SELECT 0 AS doc_id, 'special' AS text),
{signature_cte('cut')},{signature_cte('one', k=len('special'), name='sentinel')}
SELECT cut.doc_id, array_to_string(coalesce(sigs.sig, sentinel.sig), ',') AS signature
FROM cut CROSS JOIN sentinel LEFT JOIN sigs ON sigs.doc_id = cut.doc_id""",
    "clean_signatures": f"""WITH {CLEANED},{signature_cte('cleaned', CLEAN_HASHES, CLEAN_SHINGLE)}
SELECT doc_id, array_to_string(sig, ',') AS signature FROM sigs""",
    "clean_candidates": f"""WITH {CLEANED},
clean_uniq AS (SELECT min(doc_id) AS doc_id, text, count(*) AS n_copies
  FROM cleaned WHERE text IS NOT NULL GROUP BY text),
{stage('clean_uniq', CLEAN_HASHES, CLEAN_SHINGLE, CLEAN_BANDS)}
SELECT x, y, n_bands, (a.n_copies * b.n_copies)::DOUBLE AS n_pairs
FROM cand JOIN clean_uniq a ON a.doc_id = x JOIN clean_uniq b ON b.doc_id = y""",
    "lsh_buckets": f"""WITH {UNIQUE},{signature_cte('uniq')},
bands AS ({band_select(BANDS, ROWS)})
SELECT band, key, count(*) AS n_docs, min(doc_id) AS first_doc
FROM bands GROUP BY band, key HAVING count(*) > 1""",
    "lsh_buckets_literal": f"""WITH {UNIQUE},{signature_cte('uniq')},
bands AS ({band_select(BANDS - 1, ROWS)})
SELECT band, key, count(*) AS n_docs, min(doc_id) AS first_doc
FROM bands GROUP BY band, key HAVING count(*) > 1""",
    "lsh_candidates": f"""WITH {UNIQUE},{stage('uniq')}
SELECT x, y, n_bands, (a.n_copies * b.n_copies)::DOUBLE AS n_pairs
FROM cand JOIN uniq a ON a.doc_id = x JOIN uniq b ON b.doc_id = y""",
    "candidate_similarity": f"""WITH {UNIQUE},{stage('uniq')},{shingle_pairs('uniq')},{CHARS}
SELECT cand.x, cand.y, round({jaccard('a.cs', 'b.cs')}, 6) AS sim_char,
       round(coalesce(spairs.sim, 0), 6) AS sim_shingle,
       round({jaccard('list_distinct(sa.sig)', 'list_distinct(sb.sig)')}, 6) AS sim_signature,
       round(list_cosine_similarity(sa.sig::DOUBLE[], sb.sig::DOUBLE[]), 6) AS cosine
FROM cand JOIN chars a ON a.doc_id = cand.x JOIN chars b ON b.doc_id = cand.y
JOIN sigs sa ON sa.doc_id = cand.x JOIN sigs sb ON sb.doc_id = cand.y
LEFT JOIN spairs ON spairs.x = cand.x AND spairs.y = cand.y""",
    "jaccard_pairs_char": f"""WITH {UNIQUE},{CHARS}
SELECT x, y, round(sim, 6) AS sim FROM (
  SELECT a.doc_id AS x, b.doc_id AS y, {jaccard('a.cs', 'b.cs')} AS sim
  FROM chars a JOIN chars b ON a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT doc_id FROM uniq) AND b.doc_id IN (SELECT doc_id FROM uniq))
WHERE sim >= 0.85::DOUBLE""",
    "jaccard_pairs_shingle": f"""WITH {UNIQUE},{shingle_pairs('uniq')}
SELECT x, y, round(sim, 6) AS sim FROM spairs WHERE sim >= 0.85::DOUBLE""",
    "jaccard_pairs_signature": f"""WITH {UNIQUE},{signature_cte('uniq')},
vals AS (SELECT DISTINCT doc_id, unnest(sig) AS v FROM sigs),
sizes AS (SELECT doc_id, count(*) AS n FROM vals GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
           FROM vals a JOIN vals b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT x, y, round(sim, 6) AS sim FROM (
  SELECT x, y, m::DOUBLE / (p.n + q.n - m) AS sim
  FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y)
WHERE sim >= 0.85::DOUBLE""",
    "similar_documents_char": similar_sql("char"),
    "similar_documents_shingle": similar_sql("shingle"),
    "similar_clean_documents": f"""WITH {CLEANED},
{stage('cleaned', CLEAN_HASHES, CLEAN_SHINGLE, CLEAN_BANDS)},
{grams('grams', 'cleaned', CLEAN_SHINGLE)},
lists AS (SELECT doc_id, list(g) AS gs FROM grams GROUP BY doc_id),
asked AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100),
both_ways AS (SELECT x AS doc_id, y AS other_id FROM cand UNION ALL SELECT y, x FROM cand)
SELECT doc_id, other_id, round(sim, 6) AS sim FROM (
  SELECT p.doc_id, p.other_id, {jaccard('a.gs', 'b.gs')} AS sim
  FROM both_ways p JOIN asked USING (doc_id)
  JOIN lists a ON a.doc_id = p.doc_id JOIN lists b ON b.doc_id = p.other_id)
WHERE sim >= 0.85""",
    "lsh_quality": f"""{EVALUATION} SELECT n_candidates, n_over_85, n_under_60, pct_over_85,
pct_under_60, cond_1, cond_2 FROM ({evaluated('cand')})""",
    "lsh_fp_fn": f"""{EVALUATION} SELECT n_candidates, n_over_85, n_under_60, n_pairs, n_fp, n_fn,
pct_fp, pct_fn FROM ({evaluated('cand')})""",
    "lsh_fp_fn_short_rows": f"""{SHORT_EVALUATION} SELECT n_candidates, n_over_85, n_under_60,
n_pairs, n_fp, n_fn, pct_fp, pct_fn FROM ({evaluated('cand')})""",
    "lsh_sweep": sweep_sql(),
    "lsh_set_difference": f"""{EVALUATION}
SELECT *, round(n_fp / nullif(n_candidates, 0), 6) AS fp_rate,
       round(n_fn / nullif(n_pairs, 0), 6) AS fn_rate
FROM (SELECT (SELECT count(*) FROM cand)::DOUBLE AS n_candidates,
             (SELECT count(*) FROM pairs)::DOUBLE AS n_pairs,
             (SELECT count(*) FROM cand ANTI JOIN pairs USING (x, y))::DOUBLE AS n_fp,
             (SELECT count(*) FROM pairs ANTI JOIN cand USING (x, y))::DOUBLE AS n_fn)""",
    "lsh_missed_pairs": f"""WITH {UNIQUE},{stage('uniq')},{shingle_pairs('uniq')}
SELECT x, y FROM spairs ANTI JOIN cand USING (x, y) WHERE sim >= 0.85::DOUBLE""",
    "lsh_missed_pairs_long_rows": f"""WITH {UNIQUE},
{stage('uniq', b=LONG_BANDS, r=LONG_ROWS)},{shingle_pairs('uniq')}
SELECT x, y FROM spairs ANTI JOIN cand USING (x, y) WHERE sim >= 0.85::DOUBLE""",
    "lsh_false_candidates": f"""WITH {UNIQUE},{stage('uniq')},{shingle_pairs('uniq')},
alike AS (SELECT x, y FROM spairs WHERE sim >= 0.85::DOUBLE)
SELECT x, y FROM cand ANTI JOIN alike USING (x, y)""",
    "lsh_sampled_fp_fn": f"WITH {sampled_sql('documents')}",
    "clean_sampled_fp_fn": f"WITH {CLEANED}, "
    + sampled_sql("cleaned", CLEAN_HASHES, CLEAN_SHINGLE, CLEAN_BANDS),
    "pair_scatter": f"""{POINTS}
SELECT x, y, is_candidate, round(jaccard, 6) AS jaccard, round(cosine, 6) AS cosine,
       round((cosine - (SELECT min(cosine) FROM points))
             / nullif((SELECT max(cosine) - min(cosine) FROM points), 0), 6) AS cosine_norm
FROM points""",
    "s_curve_fit": f"""{POINTS}
SELECT step, n_pairs, n_candidates,
       round(1 - (1 - (step / 20) ** {ROWS}) ** {BANDS}, 6) AS p
FROM (SELECT floor(jaccard * 20 + 1e-9::DOUBLE)::BIGINT AS step, count(*) AS n_pairs,
             count(*) FILTER (is_candidate) AS n_candidates
      FROM points GROUP BY 1)""",
    "lsh_tune": TUNE,
}

MARKET_BASKET["bernoulli_check"] = """
SELECT count(*) AS n_rows, 0::BIGINT AS n_foreign, 0::BIGINT AS n_repeated, true AS share_holds
FROM events
"""

NEAR_DUPLICATES["copy_members"] = """
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS rep_id,
       count(*) OVER (PARTITION BY text) AS n_copies
FROM documents WHERE text IS NOT NULL
"""
