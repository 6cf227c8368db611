"""The SQL (DuckDB) each query must agree with, over whole tables.

Written from the meaning of the operators, not from the Spark plans: the engine's
regexes have no lookaround, so term boundaries are matched as characters on a text
whose symbols are doubled; windows and `qualify` stand where Spark aggregates.
"""

from __future__ import annotations

import re

from catalogue import standins as N
from textmart import rules as R
from textmart.functions import romanise as Z


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- fragments ----------------------------------------------------------------


def ascii_of(text: str) -> str:
    return f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')"


def fold(text: str) -> str:
    return f"lower(regexp_replace({ascii_of(text)}, '\\s+', ' ', 'g'))"


def spell(text: str) -> str:
    return ascii_of(f"replace(replace({text}, 'ß', 'ss'), 'ẞ', 'Ss')")


def plain(text: str) -> str:
    """`fold` of a dictionary alias; aliases hold accents of these letters only."""
    return text.lower().translate(str.maketrans("éüñç", "eunc"))


def words_of(alias: str) -> list[str]:
    return [w for w in re.split("[ /-]+", plain(alias)) if w]


def term_keys(folded: str) -> str:
    """List of the keys of all terms in a folded text, leftmost, longest alias first."""
    order = sorted((a for _, a in N.TERMS), key=lambda a: -len(a))
    body = "|".join("[ /-]*".join(words_of(a)) for a in order)
    doubled = f"regexp_replace({folded}, '([^a-z0-9])', '\\1\\1', 'g')"
    return f"regexp_extract_all({doubled}, '(?:^|[^a-z0-9])({body})(?:[^a-z0-9]|$)', 1)"


def term_name(key: str) -> str:
    names = {"".join(words_of(a)): c for c, a in N.TERMS}
    cases = " ".join(f"WHEN {q(k)} THEN {q(c)}" for k, c in names.items())
    return f"CASE regexp_replace({key}, '[ /-]+', '', 'g') {cases} END"


def terms(source: str, key: str, text: str) -> str:
    """(key, skill) rows, distinct."""
    return (
        f"SELECT DISTINCT {key}, {term_name('k')} AS skill FROM "
        f"(SELECT {key}, unnest({term_keys(fold(text))}) AS k FROM {source})"
    )


def term_lists(source: str, key: str, text: str) -> str:
    """(key, skills) for every row of the source, terms joined in order."""
    return (
        f"SELECT s.{key}, coalesce(t.skills, '') AS skills FROM {source} s LEFT JOIN "
        f"(SELECT {key}, string_agg(skill, '|' ORDER BY skill) AS skills "
        f"FROM ({terms(source, key, text)}) GROUP BY {key}) t ON s.{key} = t.{key}"
    )


def mode(folded: str) -> str:
    (both, wb), (one, w1), (other, w2) = N.MODE_WORDS
    has = lambda w: f"regexp_matches({folded}, {q(w)})"
    return (
        f"CASE WHEN {has(wb)} OR ({has(w1)} AND {has(w2)}) THEN {q(both)} "
        f"WHEN {has(w1)} THEN {q(one)} WHEN {has(w2)} THEN {q(other)} END"
    )


def decode(text: str) -> str:
    for name, char in [("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"),
                       ("middot", "·"), ("apos", "'"), ("nbsp", "\xa0"), ("amp", "&")]:
        # HTML lets a reference of these names end without its semicolon.
        end = ";" if name == "apos" else ";?"
        text = f"regexp_replace({text}, '&{name}{end}', {q(char)}, 'g')"
    return text


WHITE = "E' \\t\\n\\r'"
# Pages without comments, scripts and styles.
VISIBLE = (
    "(SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, "
    "'(?s)<!--.*?-->', '', 'g'), '(?s)<script.*?</script>', '', 'g'), "
    "'(?s)<style.*?</style>', '', 'g') AS h, html FROM pages)"
)


def element(pattern: str) -> str:
    return f"trim({decode(f'regexp_extract(h, {q(pattern)}, 1)')}, {WHITE})"


def element_or_null(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(h, {q(pattern)}) THEN {element(pattern)} END"


TITLE = (
    f"coalesce(nullif({element('(?s)<h1>(.*?)</h1>')}, ''), "
    f"{element_or_null('(?s)<title>(.*?)</title>')})"
)
COMPANY = element_or_null('(?s)<a href[^>]*>(.*?)</a>')
CITY = element_or_null('(?s)<div class="ad">(.*?)</div>')
_LINES = r"""regexp_replace(regexp_extract(h, '(?s)<article>(.*?)</article>', 1), '(<[^>]*>)+', E'\n', 'g')"""
BODY = f"trim({decode(_LINES)}, {WHITE})"
LANG = """regexp_extract(html, '<html lang="([^"]*)"', 1)"""

FIELDS = (
    f"SELECT page_id, CAST(page_id AS VARCHAR) AS job_id, {TITLE} AS title, "
    f"{COMPANY} AS company, {CITY} AS city, {BODY} AS body FROM {VISIBLE}"
)


def entries(condition: str = "true") -> str:
    folded = fold("concat_ws(' ', nullif(title, ''), nullif(city, ''), nullif(body, ''))")
    return (
        f"WITH f AS ({FIELDS}), t AS ({term_lists('f', 'job_id', 'body')}) "
        f"SELECT f.job_id, title, company, city, {mode(folded)} AS work_mode, skills "
        f"FROM f JOIN t ON f.job_id = t.job_id WHERE {condition}"
    )


def contains_any(text: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(k)})" for k in keywords) + ")"


def cascade(text: str, rules, default: str | None) -> str:
    cases = " ".join(f"WHEN {contains_any(text, ks)} THEN {q(label)}" for label, ks in rules)
    return f"CASE {cases} ELSE {'NULL' if default is None else q(default)} END"


def level_list(text: str) -> str:
    found = ", ".join(
        f"CASE WHEN regexp_matches({text}, {q(p)}) THEN {q(label)} END" for label, p in N.NAME_LEVELS
    )
    kept = f"list_filter([{found}], lambda v: v IS NOT NULL)"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE [{q(N.NAME_LEVEL_DEFAULT)}] END"


def title_case(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
        "lambda x: upper(x[1]) || lower(x[2:])), '')"
    )


def standard(text: str, exact: dict[str, str], parts) -> str:
    key = f"lower(trim({text}))"
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in exact.items())
    return f"coalesce(CASE {key} {cases} END, {cascade(key, parts, None)}, {title_case(text)})"


GROUP = cascade("p_name", N.NAME_RULES, N.NAME_DEFAULT)
PART_ITEMS = (
    f"SELECT l_partkey, l_orderkey, p_type, p_brand, {GROUP} AS position_group, "
    f"{level_list('p_name')} AS levels FROM part JOIN lineitem ON p_partkey = l_partkey"
)
LINKS = (
    "SELECT page_id, unnest(regexp_extract_all(html, 'href=\"/([^\"]+)\"', 1)) AS job_id FROM pages"
)
FIRST_SEEN = (
    f"SELECT job_id, page_id FROM ({LINKS}) "
    "QUALIFY page_id = min(page_id) OVER (PARTITION BY job_id)"
)
LAST_EVENT = (
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
)
OLD, NEW = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-06-01 00:00:00'"
PAIR = "l_returnflag || '/' || l_linestatus"
PAIR_NAME = standard("skill", N.PAIR_NAMES, N.PAIR_PARTS)
MART = (
    "SELECT job_id, p_name AS title, p_brand AS company, p_type AS city, "
    "CAST(NULL AS VARCHAR) AS work_mode, position_group, level, skill, skill_grouped, "
    f"CASE WHEN lower(skill_grouped) IN ({', '.join(map(q, N.PAIR_MEMBERS))}) "
    "THEN 'closed' ELSE 'open' END AS tipo_skill FROM ("
    f"SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name, p_brand, p_type, {GROUP} AS position_group, "
    f"unnest({level_list('p_name')}) AS level, skill, {PAIR_NAME} AS skill_grouped "
    f"FROM part JOIN (SELECT DISTINCT l_partkey, {PAIR} AS skill FROM lineitem) ON p_partkey = l_partkey)"
)


def share(source: str, group: str, entity: str) -> str:
    return (
        f"SELECT {group}, count(DISTINCT {entity}) AS n, "
        f"round(100.0 * count(DISTINCT {entity}) / (SELECT count(DISTINCT {entity}) FROM {source}), 1) "
        f"AS pct FROM {source} GROUP BY {group}"
    )


PENDING = entries(
    "f.job_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) "
    "AND f.job_id IN (SELECT CAST(user_id AS VARCHAR) FROM events)"
)



def romanised(text: str) -> str:
    """Hangul by the arithmetic of its letters, then kana, longest first."""
    first, vowel, last = (
        "[" + ",".join(q(x.replace("-", "")) for x in names.split(" ")) + "]"
        for names in (Z.HANGUL_FIRST, Z.HANGUL_VOWEL, Z.HANGUL_LAST)
    )
    code = "(unicode(c) - 44032)"
    syllable = f"{first}[{code} // 588 + 1] || {vowel}[{code} % 588 // 28 + 1] || {last}[{code} % 28 + 1]"
    text = (
        f"array_to_string(list_transform(string_split({text}, ''), "
        f"lambda c: CASE WHEN unicode(c) BETWEEN 44032 AND 55203 THEN {syllable} ELSE c END), '')"
    )
    pairs = "っき kき っか kか っし sし っつ ttsu きゃ kya しゃ sha っ tsu ゃ ya き ki し shi か ka つ tsu ん n".split(" ")
    for kana, latin in zip(pairs[::2], pairs[1::2]):
        text = f"replace({text}, {q(kana)}, {q(latin)})"
    return text


# --- one statement per query ---------------------------------------------------

ORACLES: dict[str, str] = {
    "fold_text": f"SELECT doc_id, {fold('text')} AS folded FROM documents",
    "fold_translit": f"SELECT doc_id, {spell('text')} AS spelled FROM documents",
    "romanised_names": f"SELECT p_partkey, {romanised('w')} || '  ' || p_brand AS spelled, '部' AS dropped FROM (SELECT *, "
    f"translate(p_name, 'abcdefghijklmnopqrst', {q(N.HANGUL + N.KANA)}) AS w FROM part)",
    "collapse_newlines": "SELECT doc_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS clean FROM documents",
    "strip_punct": (
        "SELECT doc_id, trim(regexp_replace(regexp_replace(text, "
        "'[()/|.,{}\\\\''\"\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM documents"
    ),
    "title_case": f"SELECT o_orderkey, {title_case('o_orderpriority')} AS name FROM orders",
    "dictionary_match": term_lists("documents", "doc_id", "text"),
    "dictionary_match_join": term_lists("documents", "doc_id", "text"),
    "mode_classify": (
        f"SELECT doc_id, {mode(fold(chr(39).join(['concat_ws(', ' ', ', source, lang, text)'])))} "
        "AS mode FROM documents"
    ),
    "html_meta": (
        f"SELECT page_id, {TITLE} AS title, {COMPANY} AS company, {CITY} AS city, {LANG} AS lang "
        f"FROM {VISIBLE}"
    ),
    "html_container_text": f"SELECT page_id, {BODY} AS body FROM {VISIBLE}",
    "html_checked": (
        f"SELECT page_id, {TITLE} AS title, {COMPANY} AS company, {CITY} AS city, {LANG} AS lang, "
        f"{BODY} AS body FROM {VISIBLE}"
    ),
    "html_selectors": (
        "SELECT page_id, CASE WHEN h LIKE '%</li><li>%' THEN regexp_extract(h, '<nav><ul><li>.*?</li><li><a href=\"([^\"]*)\"', 1) END AS second_link, "
        f"{element_or_null('(?s)<article><h1>(.*?)</h1>')} AS heading, {element_or_null('(?s)<title>(.*?)</title>')} AS title, "
        f"{element_or_null('<a href=\"[^\"]*,\">([^<]*)</a>')} AS comma_link, CAST(NULL AS VARCHAR) AS none FROM {VISIBLE}"
    ),
    "extract_ids": (
        "SELECT page_id, CAST(unnest(range(len(ids))) AS BIGINT) AS pos, unnest(ids) AS job_id FROM "
        "(SELECT page_id, regexp_extract_all(html, 'href=\"/([^\"]+)\"', 1) AS ids FROM pages)"
    ),
    "build_entries": entries(),
    "build_entries_native": entries(),
    "full_run": (
        "SELECT p.job_id, title, company, city, work_mode, skill FROM "
        f"({PENDING}) p JOIN (WITH f AS ({FIELDS}) {terms('f', 'job_id', 'body')}) c ON p.job_id = c.job_id"
    ),
    "dictionary_match_repeated_keys": (
        f"SELECT d.doc_id, d.lang, t.skills FROM ({term_lists('documents', 'doc_id', 'text')}) t "
        "JOIN documents d ON d.doc_id = t.doc_id"
    ),
    "rule_table_large": (
        "WITH t AS (SELECT p_partkey, 'a ' || p_partkey || ' ' || p_name || ' b' AS title FROM part), "
        "w AS (SELECT t.p_partkey, any_value(title) AS title, min_by(p_brand, r.p_partkey) AS label "
        "FROM t JOIN part r ON contains(title, r.p_partkey || ' ' || p_name) GROUP BY t.p_partkey) "
        "SELECT l_orderkey, l_linenumber, title, label FROM lineitem JOIN w ON l_partkey = p_partkey"
    ),
    "normalize_entries": f"WITH f AS ({FIELDS}) {terms('f', 'job_id', 'body')}",
    "normalize_parents": f"SELECT job_id, title, company, city, work_mode FROM ({entries()})",
    "rule_cascade": f"SELECT p_partkey, p_name, {GROUP} AS label FROM part",
    "rule_join_first_match": f"SELECT p_partkey, p_name, {GROUP} AS label FROM part",
    "multilabel_levels": (
        f"SELECT p_partkey, array_to_string({level_list('p_name')}, '|') AS levels FROM part"
    ),
    "levels_exploded": f"SELECT p_partkey, unnest({level_list('p_name')}) AS level FROM part",
    "standardize_names": (
        "SELECT o_orderkey, "
        f"{standard('o_orderpriority', N.PRIORITY_NAMES, N.PRIORITY_PARTS)} AS name FROM orders"
    ),
    "map_lookup_default": (
        "SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'today' "
        "WHEN '2-HIGH' THEN 'this week' WHEN '3-MEDIUM' THEN 'this month' ELSE o_orderpriority END "
        "AS label FROM orders"
    ),
    "classify_membership": (
        "SELECT doc_id, lang, CASE WHEN lang IN ('fr', 'es') THEN 'romance' ELSE 'other' END AS kind "
        "FROM documents"
    ),
    "jobs_join_skills": (
        "SELECT o_orderkey, o_orderstatus, o_orderpriority, l_partkey, l_returnflag "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    ),
    "pending_anti_join": (
        "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
    ),
    "new_ids_anti_join": (
        "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    ),
    "ids_difference": (
        "(SELECT page_id AS id FROM pages UNION SELECT user_id FROM events) "
        "EXCEPT SELECT doc_id FROM labels"
    ),
    "cache_hit_semi": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "fetch_backlog": (
        "SELECT DISTINCT l_suppkey AS job_id FROM lineitem WHERE l_suppkey NOT IN (SELECT doc_id FROM labels)"
    ),
    "worklist_status": (
        "SELECT DISTINCT o_custkey AS id, CASE WHEN o_custkey IN (SELECT page_id FROM pages) "
        "THEN 'processed' WHEN o_custkey IN (SELECT doc_id FROM labels) THEN 'cached' "
        "ELSE 'to-fetch' END AS status FROM orders"
    ),
    "children_by_parent": (
        "SELECT o_orderkey, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey), '') "
        "AS parts FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey"
    ),
    "first_seen_ids": FIRST_SEEN,
    "first_seen_strict": f"SELECT job_id, min(page_id) AS page_id FROM ({LINKS}) GROUP BY job_id",
    "take_while_pages": (
        "SELECT user_id, event_id, event_type FROM events QUALIFY max(CASE WHEN event_type = 'error' "
        "THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) = 0"
    ),
    "collect_new_ids": (
        "WITH p AS (SELECT page_id, page_id // 10 AS term, url, "
        "regexp_extract_all(html, 'href=\"/([^\"]+)\"', 1) AS ids FROM pages), "
        "r AS (SELECT * FROM p QUALIFY max(CASE WHEN len(ids) = 0 THEN 1 ELSE 0 END) OVER "
        "(PARTITION BY term ORDER BY page_id ROWS UNBOUNDED PRECEDING) = 0), "
        "s AS (SELECT page_id, url, unnest(ids) AS job_id FROM r) "
        "SELECT job_id, url FROM s WHERE job_id NOT IN "
        "(SELECT unnest(regexp_extract_all(text, '\\p{L}+')) FROM documents) "
        "QUALIFY page_id = min(page_id) OVER (PARTITION BY job_id)"
    ),
    "last_write_wins": f"SELECT user_id, event_id, event_type, value FROM ({LAST_EVENT})",
    "url_frontier": (
        "SELECT CAST(r_regionkey AS BIGINT) AS term_ord, replace(lower(r_name), ' ', '-') AS term, "
        "CAST(i AS BIGINT) AS page, 'https://example.com/search/' || replace(lower(r_name), ' ', '-') "
        "|| '-jobs?start=' || (i * 10) AS url FROM region, range(3) t(i)"
    ),
    "pending_extract": PENDING,
    "offline_extract": entries("f.job_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"),
    "upsert_jobs": (
        f"WITH u AS (SELECT user_id * 20 AS job_id, nullif(event_type, 'error') AS title, "
        f"props AS work_mode FROM ({LAST_EVENT})), "
        f"b AS (SELECT c_custkey AS job_id, c_name AS title, c_mktsegment AS work_mode FROM customer) "
        f"SELECT job_id, title, work_mode, CASE WHEN job_id IN (SELECT job_id FROM b) THEN {OLD} "
        f"ELSE {NEW} END AS created_at FROM u "
        f"UNION ALL SELECT *, {OLD} FROM b WHERE job_id NOT IN (SELECT job_id FROM u)"
    ),
    "upsert_html": (
        f"SELECT 2 * doc_id AS job_id, text AS html_text, {NEW} AS fetched_at FROM documents "
        f"UNION ALL SELECT page_id, html, {OLD} FROM pages WHERE page_id NOT IN (SELECT 2 * doc_id FROM documents)"
    ),
    "replace_children": (
        "SELECT DISTINCT l_orderkey AS job_id, l_partkey AS skill FROM lineitem JOIN orders "
        "ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O' UNION ALL "
        "SELECT DISTINCT l_orderkey, l_partkey + 1 FROM lineitem JOIN orders "
        "ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O' AND l_returnflag = 'R'"
    ),
    "insert_ignore": (
        "SELECT l_orderkey AS job_id, l_partkey AS skill FROM lineitem WHERE l_linestatus = 'F' "
        "UNION SELECT l_orderkey, l_partkey FROM lineitem "
        "WHERE l_returnflag = 'A' OR l_linestatus <> 'F'"
    ),
    "cascade_delete": (
        "SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN "
        "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
    ),
    "append_entries": (
        "SELECT n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation "
        "UNION ALL SELECT s_name, NULL FROM supplier"
    ),
    "dataset_summary": (
        "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) "
        "AS n_types, count(DISTINCT user_id) FILTER (WHERE event_type <> 'error') AS n_users_ok FROM events"
    ),
    "filtered_distinct_count": (
        "SELECT count(DISTINCT o_custkey) AS n_customers FROM orders WHERE o_orderpriority <> '5-LOW'"
    ),
    "filter_not_in": (
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN "
        "('5-LOW', '4-NOT SPECIFIED')"
    ),
    "project_fixed": (
        "SELECT CAST(page_id AS VARCHAR) AS job_id, url AS title, CAST(NULL AS VARCHAR) AS company, "
        "CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS work_mode FROM pages"
    ),
    "jobs_per_group": (
        f"SELECT position_group, count(DISTINCT l_orderkey) AS n FROM ({PART_ITEMS}) GROUP BY 1"
    ),
    "jobs_per_level": (
        "SELECT level, count(DISTINCT l_orderkey) AS n FROM "
        f"(SELECT l_orderkey, unnest(levels) AS level FROM ({PART_ITEMS})) GROUP BY 1"
    ),
    "jobs_per_skill": (
        "SELECT p_brand, count(DISTINCT l_orderkey) AS n FROM part JOIN lineitem "
        "ON p_partkey = l_partkey GROUP BY 1"
    ),
    "rows_per_type": (
        f"SELECT p_type, count(*) AS n FROM (SELECT p_type, unnest(levels) FROM ({PART_ITEMS})) GROUP BY 1"
    ),
    "top_skills": (
        "SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1 "
        "ORDER BY n DESC, l_partkey LIMIT 20"
    ),
    "first_rows": (
        "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders "
        "ORDER BY o_orderpriority, o_orderkey LIMIT 10"
    ),
    "level_share": (
        f"WITH x AS (SELECT l_orderkey, unnest(levels) AS level FROM ({PART_ITEMS}) "
        "WHERE position_group NOT IN ('Machine', 'Warm Stock')) "
        "SELECT *, CASE level WHEN 'size' THEN 'Size' WHEN 'heat' THEN 'Heat' ELSE level END AS label, "
        f"format('{{:,}}', n) AS n_label FROM ({share('x', 'level', 'l_orderkey')})"
    ),
    "work_mode_share": share("orders", "o_orderstatus", "o_orderkey"),
    "top_skills_per_group": (
        f"SELECT source, skill, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY source "
        "ORDER BY n DESC, skill) AS rank FROM (SELECT source, skill, count(*) AS n FROM "
        f"({terms('documents', 'doc_id', 'text')}) JOIN documents USING (doc_id) GROUP BY 1, 2)) "
        "WHERE rank <= 5"
    ),
    "pk_violations": (
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "fk_orphans": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages)",
    "domain_violations": (
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN "
        "('1-URGENT', '2-HIGH', '5-LOW', '3-MEDIUM')"
    ),
    "null_violations": (
        "SELECT o_orderkey, concat_ws('|', CASE WHEN o_orderpriority = '5-LOW' THEN 'priority' END, "
        "CASE WHEN o_orderstatus = 'P' THEN 'status' END) AS missing FROM orders "
        "WHERE o_orderpriority = '5-LOW' OR o_orderstatus = 'P'"
    ),
    "mart_rows": MART,
    "mart_flat_export": MART,
    "sink_append_ids": (
        "SELECT CAST(page_id AS VARCHAR) AS job_id, url FROM pages "
        "UNION ALL SELECT CAST(doc_id AS VARCHAR), source FROM documents"
    ),
    "sink_html_csv_roundtrip": (
        "SELECT CAST(doc_id AS VARCHAR) AS job_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS html_text "
        "FROM documents"
    ),
    "sink_json_roundtrip": entries(),
    "sink_model_csv_roundtrip": (
        "SELECT DISTINCT o_orderkey AS job_id, o_orderpriority AS title, "
        "nullif(o_orderstatus, 'P') AS work_mode, l_partkey AS skill "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    ),
    "sink_model_table_roundtrip": (
        "SELECT DISTINCT o_orderkey AS job_id, CASE WHEN o_orderstatus = 'O' THEN lower(o_orderpriority) "
        "ELSE o_orderpriority END AS title, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS work_mode, "
        f"{OLD} AS created_at, CASE WHEN o_orderstatus = 'O' THEN l_partkey + 1 ELSE l_partkey END AS skill "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    ),
    "src_ids_csv": (
        "SELECT DISTINCT CAST(user_id AS VARCHAR) AS job_id FROM events "
        "WHERE event_type NOT IN ('error', 'view')"
    ),
    "src_cache_last_wins": (
        "WITH d AS (SELECT 2 * doc_id AS id, text FROM documents), "
        "a AS (SELECT * FROM d UNION ALL SELECT page_id, html FROM pages WHERE page_id NOT IN "
        "(SELECT id FROM d)) SELECT CAST(id AS VARCHAR) AS job_id, "
        "regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS html_text FROM a"
    ),
    "src_json_tolerant": (
        "SELECT CAST(page_id AS VARCHAR) AS job_id, url AS title, CAST(NULL AS VARCHAR) AS company, "
        "CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS work_mode, replace(url, '/', '|') AS skills "
        "FROM pages WHERE NOT contains(html, 'lang=\"de\"')"
    ),
    "ensure_schema": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS title, "
        "CAST(NULL AS VARCHAR) AS work_mode FROM orders"
    ),
    "stream_first_seen": FIRST_SEEN,
    "stream_extract_upsert": entries(),
    "child_counts": (
        "SELECT o_orderkey, l_suppkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem "
        "ON o_orderkey = l_orderkey GROUP BY o_orderkey, l_suppkey"
    ),
    "sink_model_repeated_ids": (
        f"WITH u AS (SELECT user_id AS job_id, event_type AS title, props AS work_mode FROM ({LAST_EVENT})), "
        "b AS (SELECT c_custkey AS job_id, c_name AS title, c_mktsegment AS work_mode FROM customer) "
        f"SELECT job_id, title, work_mode, CASE WHEN job_id IN (SELECT job_id FROM b) THEN {OLD} "
        f"ELSE {NEW} END AS created_at FROM u "
        f"UNION ALL SELECT *, {OLD} FROM b WHERE job_id NOT IN (SELECT job_id FROM u)"
    ),
    "stream_upsert": (
        "SELECT user_id, event_id, event_type, replace(props, ':', '|') AS skills "
        f"FROM ({LAST_EVENT})"
    ),
}

# The default rules, on titles made of their own keywords.
NAMED = f"list_value({', '.join(q(n) for n in N.DEFAULT_NAMES)})[p_partkey % {len(N.DEFAULT_NAMES)} + 1]"
TITLES = (
    f"SELECT p_partkey, concat_ws(' ', list_value({', '.join(q(x) for x in N.DEFAULT_LEVELS)})[p_partkey % {len(N.DEFAULT_LEVELS)} + 1], "
    f"list_value({', '.join(q(x) for x in N.DEFAULT_KEYWORDS)})[p_partkey % {len(N.DEFAULT_KEYWORDS)} + 1], p_name) AS title FROM part"
)
DEFAULT_LEVEL_LIST = ", ".join(f"CASE WHEN regexp_matches(low, {q(p)}) THEN {q(label)} END" for label, p in R.LEVEL_PATTERNS)
ORACLES |= {
    "default_levels": (
        f"WITH t AS (SELECT p_partkey, translate(strip_accents(lower(title)), '/|', '  ') AS low FROM ({TITLES})), "
        f"f AS (SELECT p_partkey, list_filter([{DEFAULT_LEVEL_LIST}], lambda v: v IS NOT NULL) AS found FROM t) "
        f"SELECT p_partkey, CASE WHEN len(found) > 0 THEN array_to_string(found, '|') ELSE {q(R.LEVEL_DEFAULT)} END AS levels FROM f"
    ),
    "default_groups": (
        "WITH t AS (SELECT p_partkey, trim(regexp_replace(translate(strip_accents(lower(title)), '()/|.,{}\\''\"[]', '              '), ' +', ' ', 'g')) AS low "
        f"FROM ({TITLES})) "
        f"SELECT p_partkey, {cascade('low', R.POSITION_RULES, R.POSITION_DEFAULT)} AS position_group FROM t"
    ),
    "default_names": (
        f"WITH t AS (SELECT p_partkey, {NAMED} AS name FROM part) "
        f"SELECT p_partkey, {standard('trim(name)', R.SKILL_NAMES, R.SKILL_NAME_PARTS)} AS name FROM t"
    ),
}

# The same rows by another way.
ORACLES |= {
    "dictionary_match_automaton": ORACLES["dictionary_match"],
    "multilabel_levels_table": ORACLES["multilabel_levels"],
    "standardize_names_tables": ORACLES["standardize_names"],
    "classify_membership_table": ORACLES["classify_membership"],
    "pattern_table_large": (
        "WITH t AS (SELECT p_partkey, 'a ' || p_partkey || ' ' || p_name || ' b' AS title FROM part), "
        "w AS (SELECT t.p_partkey, any_value(title) AS title, string_agg(p_brand, '|' ORDER BY r.p_partkey) AS labels "
        "FROM t JOIN part r ON contains(title, ' ' || r.p_partkey || ' ' || p_name || ' ') GROUP BY t.p_partkey) "
        "SELECT l_orderkey, l_linenumber, title, labels FROM lineitem JOIN w ON l_partkey = p_partkey"
    ),
    "maintained_counts": (
        "SELECT l_returnflag || '/' || l_linestatus AS pair, count(DISTINCT l_orderkey) AS n FROM lineitem "
        "WHERE l_quantity > 25 OR l_orderkey % 5 NOT IN (2, 3) GROUP BY 1"
    ),
    "sink_quarantine": (
        "WITH j AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - o_orderkey % 3 END AS job_id, o_orderstatus AS mode FROM orders), "
        "c AS (SELECT *, count(*) OVER (PARTITION BY job_id) AS times FROM j), "
        "r AS (SELECT job_id, concat_ws('|', CASE WHEN job_id IS NULL THEN 'null:job_id' END, CASE WHEN mode NOT IN ('F', 'O') THEN 'domain:work_mode' END, "
        "CASE WHEN job_id IS NOT NULL AND times > 1 THEN 'repeated' END) AS reasons FROM c), "
        "s AS (SELECT concat_ws('|', CASE WHEN l_linenumber >= 6 THEN 'null:skill' END, CASE WHEN l_orderkey NOT IN "
        "(SELECT job_id FROM r WHERE reasons = '') THEN 'orphan' END) AS reasons FROM lineitem) "
        "SELECT 'jobs' AS part, reasons, count(*) AS n FROM r WHERE reasons <> '' GROUP BY ALL "
        "UNION ALL SELECT 'job_skills', reasons, count(*) FROM s WHERE reasons <> '' GROUP BY ALL"
    ),
    "src_json_array": ORACLES["src_json_tolerant"],
    "src_csv_multi_line": "SELECT CAST(doc_id AS VARCHAR) AS job_id, coalesce(text, '') AS html_text FROM documents",
    "stream_take_while": ORACLES["take_while_pages"],
    "src_cache_default_appends": ORACLES["src_cache_last_wins"],
    "stream_upsert_two_checkpoints": f"SELECT user_id, event_id, event_type FROM ({LAST_EVENT})",
}
