"""SQL for the operators that SQL can express."""

from __future__ import annotations

from tallyfolio.llm.licenses import TEMPLATES, THRESHOLD
from tallyfolio.llm.mixing import PRODUCTION_MIX

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

WARC = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
    FROM pages
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM p
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses() -> str:
    wordings = ", ".join(f"({_text(name)}, {_text(wording)})" for name, wording in TEMPLATES)
    pairs = "list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
    words = "[x FOR x IN string_split_regex(lower({}), '[^a-z0-9]+') IF x <> '']"
    return f"""
WITH templates AS (
    SELECT license, {pairs} AS pairs FROM (SELECT license, {words.format("wording")} AS w FROM (VALUES {wordings}) AS t(license, wording))
), lines AS (
    SELECT doc_id, string_split(text, chr(10)) AS l, text FROM documents
), passages AS (
    SELECT doc_id, i AS line_no, l[i] AS passage FROM lines, unnest(range(1, len(l) + 1)) AS u(i)
    UNION ALL SELECT doc_id, 0, text FROM lines WHERE len(l) > 1
), mine AS (
    SELECT doc_id, line_no, {pairs} AS pairs FROM (SELECT doc_id, line_no, {words.format("passage")} AS w FROM passages)
    WHERE len(w) > 1
), hits AS (
    SELECT m.doc_id, m.line_no, t.license,
           2.0::DOUBLE * len(list_intersect(m.pairs, t.pairs)) / (len(m.pairs) + len(t.pairs)) AS dice
    FROM mine m JOIN templates t ON list_has_any(m.pairs, t.pairs)
), best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, license, line_no) AS place FROM hits WHERE dice >= {THRESHOLD}
), counted AS (
    SELECT doc_id, count(DISTINCT line_no) AS n FROM best GROUP BY doc_id
)
SELECT d.doc_id, b.license, b.dice, b.line_no::BIGINT AS line_no, coalesce(c.n, 0) AS n_notices
FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.place = 1 LEFT JOIN counted c ON c.doc_id = d.doc_id
"""


def _share(nodes: str, parent: str) -> str:
    """Water level among siblings: the level is sought directly, as the largest front of filled nodes."""
    order = f"PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN capacity::DOUBLE / weight ELSE -1 END, name"
    return f"""
    SELECT * EXCLUDE (filled, rest_weight, is_full, opened), CASE WHEN opened THEN
        (((total - coalesce(sum(CASE WHEN NOT opened THEN capacity END) OVER (PARTITION BY {parent}), 0))::HUGEINT * weight)
          // sum(CASE WHEN opened THEN weight END) OVER (PARTITION BY {parent}))::BIGINT
        ELSE capacity END AS budget
    FROM (SELECT *, bool_or(NOT is_full) OVER ({order} ROWS UNBOUNDED PRECEDING) AS opened
    FROM (SELECT *, weight <= 0 OR (CASE WHEN rest_weight > 0 THEN (total - filled) * weight / rest_weight::DOUBLE ELSE 0 END) >= capacity AS is_full
    FROM (SELECT * REPLACE (CASE WHEN weight > 0 THEN capacity ELSE 0 END AS capacity),
        coalesce(sum(CASE WHEN weight > 0 THEN capacity ELSE 0 END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS filled,
        sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest_weight
    FROM ({nodes}))))
"""


def _mixing() -> str:
    mix = PRODUCTION_MIX
    domain_weight = "CASE domain " + " ".join(f"WHEN {_text(k)} THEN {w}" for k, w in mix.domains.items()) + " ELSE 1 END"
    lang_weight = "CASE domain || '/' || lang " + " ".join(f"WHEN {_text('/'.join(k))} THEN {w}" for k, w in mix.langs.items()) + " ELSE 1 END"
    domains = f"""SELECT *, domain AS name, 0 AS root, {domain_weight} AS weight,
        floor(sum(tokens) OVER () * {mix.budget_percent} / 100)::BIGINT AS total FROM domain_sums"""
    langs = f"SELECT l.*, l.lang AS name, {lang_weight.replace('domain ||', 'l.domain ||')} AS weight, d.budget AS total FROM lang_sums l JOIN domain_budgets d USING (domain)"
    leaves = "SELECT s.*, s.source AS name, 1 AS weight, l.budget AS total FROM leaf_sums s JOIN lang_budgets l USING (domain, lang)"
    return f"""
WITH rows AS (
    SELECT doc_id, coalesce(lang, '-') AS lang, coalesce(source, '-') AS source,
           CASE WHEN regexp_matches(source, '[0-9]$')
                THEN (['web', 'books', 'news', 'forums'])[regexp_extract(source, '([0-9]{{1,2}})$', 1)::INT % 4 + 1]
                ELSE 'other' END AS domain,
           coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS n_tokens
    FROM documents
), leaf_sums AS (
    SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {mix.max_epochs} AS capacity FROM rows GROUP BY ALL
), lang_sums AS (
    SELECT domain, lang, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity FROM leaf_sums GROUP BY ALL
), domain_sums AS (
    SELECT domain, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity FROM lang_sums GROUP BY ALL
), domain_budgets AS ({_share(domains, "root")}
), lang_budgets AS ({_share(langs, "domain")}
), leaf_budgets AS ({_share(leaves, "domain, lang")}
), placed AS (
    SELECT r.*, CASE WHEN tokens > 0 THEN budget // greatest(tokens, 1) ELSE 0 END AS epochs,
           CASE WHEN tokens > 0 THEN budget % greatest(tokens, 1) ELSE 0 END AS rest
    FROM rows r JOIN leaf_budgets USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens,
       (epochs + (sum(n_tokens) OVER (PARTITION BY domain, lang, source
                  ORDER BY md5('{mix.seed}:' || epochs || ':' || doc_id)[1:15], doc_id, n_tokens
                  ROWS UNBOUNDED PRECEDING) <= rest)::INT)::INT AS copies
FROM placed
"""


JACCARD = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM texts
), shingles AS (
    SELECT doc_id, unnest(s) AS s FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (len(x.s) + len(y.s) - shared)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(id, r) AS (
    SELECT a, a FROM edges UNION SELECT id, b FROM reached JOIN edges ON r = a
), least AS (
    SELECT id, min(r) AS label FROM reached GROUP BY id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(label, doc_id) AS component_id FROM sets LEFT JOIN least ON id = doc_id
"""


def _ranked_search() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = rf"regexp_extract_all(translate({{}}, '{letters}', '{letters.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (
    SELECT doc_id, t, len(t)::BIGINT AS n FROM (SELECT doc_id, {terms.format("text")} AS t FROM documents) WHERE len(t) > 0
), sizes AS (
    SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS tokens FROM docs
), wanted AS (
    SELECT item_id, unnest(list_distinct({terms.format("text")})) AS term FROM benchmark
), counts AS (
    SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, sizes GROUP BY term, documents
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // tokens))))::BIGINT AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term), sizes GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op4_jaccard_join": JACCARD,
        "op8_license_scan": _licenses(),
        "op9_mixing": _mixing(),
        "op10_warc": WARC,
        "op12_ranked_search": _ranked_search(),
    }
