"""SQL that DuckDB runs over the same tables, where SQL can express an operator."""

from __future__ import annotations

from textmart.llm.queries import URL_RULES


def url_rules() -> str:
    """Fits of each rule as rows (rule host, rule path, rule, verdict)."""
    return ", ".join(f"('{r[: r.index('/')]}', '{r[r.index('/') :]}', '{r}', '{v}')" for r, v in URL_RULES)


def lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def share(count: str, total: str, kept: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5 * {kept})"


ORACLES: dict[str, str] = {
    "op8_segment_search": (
        "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings "
        "WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)), "
        "s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c "
        "ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)) "
        "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score "
        "FROM s QUALIFY rank <= 10"
    ),
    "op5_url_filter": (
        "WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, "
        "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages), "
        f"r(rule_host, rule_path, rule, verdict) AS (VALUES {url_rules()}), "
        "f AS (SELECT page_id, host, path, rule, verdict FROM u LEFT JOIN r "
        "ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) "
        "QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, "
        "length(rule_host) DESC, rule) = 1) "
        "SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f"
    ),
    "op11_warc": (
        "WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages), "
        "m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS top FROM p) "
        "SELECT page_id, payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, "
        "CASE WHEN top <> page_id THEN top END AS refers_to FROM m"
    ),
    "op12_divergence": (
        "WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, "
        f"regexp_extract_all({lower('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents), "
        "o AS (SELECT r, lang, source, unnest(ts) AS term FROM d), "
        "k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 30), "
        "g AS (SELECT DISTINCT lang, source FROM d), "
        "c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL), "
        "l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY ALL), "
        "t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL), "
        f"s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share('coalesce(c.n, 0)', 'coalesce(t.total, 0)', 'l.v')} AS p, "
        f"{share('k.n', 'l.total', 'l.v')} AS q FROM g JOIN k USING (lang) JOIN l USING (lang) "
        "LEFT JOIN t ON t.lang = g.lang AND t.source = g.source "
        "LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term), "
        "f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM s a JOIN s b "
        "ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL), "
        "u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b "
        "ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source "
        "UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) "
        "SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50"
    ),
    "op13_collocations": (
        f"WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {lower('text')} AS low FROM documents), "
        "p AS (SELECT r, lang, unnest(regexp_split_to_array(low, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t), "
        "w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p), "
        "n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY ALL), "
        "s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), "
        "g AS (SELECT lang, ws[i : least(i + 4, len(ws))] AS win FROM s), "
        "e AS (SELECT lang, win, unnest(range(1, len(win) + 1)) AS m FROM g), "
        "c AS (SELECT lang, array_to_string(win[1 : m], ' ') AS phrase, m, count(*) AS a FROM e GROUP BY ALL HAVING count(*) >= 100), "
        "k AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM c WHERE m > 1), "
        "x AS (SELECT k.lang, k.phrase, k.m, k.a, k.k, l.a AS l, r.a AS r, n.n, "
        "(1000::HUGEINT * k.a * n.n) // (l.a::HUGEINT * r.a) AS score FROM k JOIN n ON n.lang = k.lang "
        "JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1 : k.k], ' ') "
        "JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1 :], ' ')), "
        "b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1), "
        "o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b y WHERE y.lang = b.lang AND y.m > b.m AND y.a >= b.a "
        "AND contains(' ' || y.phrase || ' ', ' ' || b.phrase || ' '))), "
        "z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o) "
        "SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE rank <= 2000"
    ),
}
