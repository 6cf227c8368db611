"""One query per operator. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogue import standins as N
from textmart import schemas as S
from textmart import sources
from textmart.functions import classify as C
from textmart.functions import dictionary as D
from textmart.functions import html as H
from textmart.functions import text as X
from textmart.functions.literals import explode_computed
from textmart.operators import incremental as I
from textmart.operators import maintained as K
from textmart.operators import marts as M
from textmart.operators import model as O
from textmart.plans import analyse, collect, extract
from textmart.session import scratch_path
from textmart.sizes import dealt, spread
from textmart.streaming import first_seen as SF
from textmart.streaming import take_while as TW
from textmart.streaming import upserts as SU

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows are costly to work on."""
    return spread(table(spark, folder, name).select(*columns))


def joined(col: str | Column, separator: str = "|") -> Column:
    """Arrays are compared as text."""
    return F.array_join(F.transform(col, lambda v: v.cast("string")), separator)


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- text ---------------------------------------------------------------------


@query
def fold_text(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", X.fold(F.col("text")).alias("folded"))


@query
def fold_translit(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", X.transliterate(F.col("text")).alias("spelled"))


@query
def romanised_names(spark, sf):
    """Part names written in two other scripts, spelled; and the characters that have no spelling."""
    written = F.translate("p_name", "abcdefghijklmnopqrst", N.HANGUL + N.KANA)
    parts = table(spark, sf, "part").select("p_partkey", F.concat(written, F.lit(" 部 "), "p_brand").alias("name"))
    return parts.select(
        "p_partkey", X.transliterate(F.col("name")).alias("spelled"), joined(X.not_spelled(F.col("name"))).alias("dropped")
    )


@query
def collapse_newlines(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", X.collapse_newlines(F.col("text")).alias("clean"))


@query
def strip_punct(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", X.strip_punctuation(F.col("text")).alias("clean"))


@query
def title_case(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", X.title_case(F.col("o_orderpriority")).alias("name"))


@query
def dictionary_match(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    found = D.match_dictionary(docs, "doc_id", "text", N.dictionary(spark))
    return found.select("doc_id", joined("skills").alias("skills"))


@query
def dictionary_match_join(spark, sf):
    """The form for dictionaries too large for a literal, on the same texts."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    found = D.match_dictionary(docs, "doc_id", "text", N.dictionary(spark), literal_limit=0, automaton_limit=0)
    return found.select("doc_id", joined("skills").alias("skills"))


@query
def dictionary_match_automaton(spark, sf):
    """The form between the two: a trie of the aliases, walked over Arrow batches."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    found = D.match_dictionary(docs, "doc_id", "text", N.dictionary(spark), literal_limit=0)
    return found.select("doc_id", joined("skills").alias("skills"))


@query
def mode_classify(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "source", "lang", "text")
    mode = C.work_mode(F.col("source"), F.col("lang"), F.col("text"), words=N.MODE_WORDS)
    return docs.select("doc_id", mode.alias("mode"))


# --- HTML ---------------------------------------------------------------------


@query
def html_meta(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "html")
    places = {n: f for n, f in N.PAGE.places().items() if n != "body"}
    return _meta(H.native_fields(pages, "page_id", "html", {**places, "lang": N.LANG}), "lang")


def _meta(raw, *more):
    return raw.select(
        "page_id",
        X.first_nonempty(F.col("title_0"), F.col("title_1")).alias("title"),
        X.first_nonempty(F.col("company_0"), F.col("company_1")).alias("company"),
        F.col("city_0").alias("city"),
        *more,
    )


@query
def html_container_text(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "html")
    return H.native_fields(pages, "page_id", "html", {"body": N.PAGE.body})


@query
def html_selectors(spark, sf):
    """Fields by selectors with combinators and attribute operators."""
    pages = texts(spark, sf, "pages", "page_id", "html")
    return H.read_fields(pages, "page_id", "html", {n: H.Field.of(*f) for n, f in N.SELECTED.items()})


@query
def html_checked(spark, sf):
    """The default path: native where a page is regular, parsed where it is not."""
    pages = texts(spark, sf, "pages", "page_id", "html")
    places = {**N.PAGE.places(), "lang": N.LANG}
    return _meta(H.read_fields(pages, "page_id", "html", places), "lang", "body")


@query
def extract_ids(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "html")
    ids = H.extract_ids(F.col("html"), N.LINK_PATTERN)
    rows = pages.select("page_id", F.posexplode(ids).alias("pos", "job_id"))
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query
def build_entries(spark, sf):
    return _entries(spark, texts(spark, sf, "pages", "page_id", "html"))


@query
def full_run(spark, sf):
    """Ids -> pending pages -> entries, stored once -> both relations in the table sink -> joined."""
    path = scratch_path(spark, "model")
    entries = _raw_extract(spark, sf, listed=True)
    jobs, skills = extract.staged(entries)
    jobs = jobs.withColumn("created_at", moment("2024-06-01 00:00:00"))
    current = (jobs.where("false"), skills.where("false"))
    sources.write_model(jobs, skills, "database", path, current=current)
    return M.join_children(
        spark.read.parquet(f"{path}/jobs").drop("created_at"), spark.read.parquet(f"{path}/job_skills"), "job_id"
    )


@query
def dictionary_match_repeated_keys(spark, sf):
    """The join form on rows that share their keys: a language is no key of a document."""
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    found = D.match_dictionary(docs, "lang", "text", N.dictionary(spark), literal_limit=0, automaton_limit=0)
    return found.select("doc_id", "lang", joined("skills").alias("skills"))


@query
def rule_table_large(spark, sf):
    """The join form on a rule for each part: its number and name, labelled by its brand. A
    line item's title holds its own part's keyword, and those of numbers that end alike."""
    part = table(spark, sf, "part")
    rules = part.select(
        F.col("p_partkey").cast("int").alias("priority"),
        F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_name").alias("keyword"),
        F.col("p_brand").alias("label"),
    )
    titles = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    named = part.select("p_partkey", F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_name").alias("text"))
    titles = titles.join(named, titles["l_partkey"] == named["p_partkey"]).select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("a "), "text", F.lit(" b")).alias("title")
    )
    return C.classify_by_rules(titles, "title", rules, "label", "none", limit=100)


@query
def build_entries_native(spark, sf):
    return _entries(spark, texts(spark, sf, "pages", "page_id", "html"), path="native")


def _raw_entries(spark, pages, path="checked"):
    cache = pages.select(F.col("page_id").cast("string").alias("job_id"), F.col("html").alias("html_text"))
    return extract.build_entries(
        cache, N.dictionary(spark), N.PAGE, path=path, mode_words=N.MODE_WORDS
    )


def _entries(spark, pages, path="checked"):
    return _raw_entries(spark, pages, path).withColumn("skills", joined("skills"))


@query
def normalize_entries(spark, sf):
    return O.normalize(_raw_entries(spark, texts(spark, sf, "pages", "page_id", "html")))[1]


@query
def normalize_parents(spark, sf):
    return O.normalize(_raw_entries(spark, texts(spark, sf, "pages", "page_id", "html")))[0]


# --- classification -----------------------------------------------------------


@query
def rule_cascade(spark, sf):
    part = table(spark, sf, "part")
    rules = C.cascade_from_table(N.name_rules(spark))
    label = C.rule_cascade(F.col("p_name"), rules, N.NAME_DEFAULT)
    return part.select("p_partkey", "p_name", label.alias("label"))


@query
def rule_join_first_match(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return C.rule_join_first_match(part, "p_name", N.name_rules(spark), "label", N.NAME_DEFAULT)


def _name_levels(name: Column) -> Column:
    return C.multilabel(name, N.NAME_LEVELS, N.NAME_LEVEL_DEFAULT)


def _name_group(name: Column) -> Column:
    return C.rule_cascade(name, N.NAME_RULES, N.NAME_DEFAULT)


@query
def multilabel_levels(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", joined(_name_levels(F.col("p_name"))).alias("levels"))


@query
def multilabel_levels_table(spark, sf):
    """The same patterns as a table."""
    rules = spark.createDataFrame([(i, p, label) for i, (label, p) in enumerate(N.NAME_LEVELS)], "priority INT, pattern STRING, label STRING")
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    found = C.multilabel_by_table(part, "p_name", rules, "levels", N.NAME_LEVEL_DEFAULT)
    return found.select("p_partkey", joined("levels").alias("levels"))


@query
def pattern_table_large(spark, sf):
    """A pattern for each part, its number and name as whole words; a line item's title holds its own part's."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_name").alias("text"))
    rules = part.select(F.col("p_partkey").cast("int").alias("priority"), F.concat(F.lit(r"\b"), "text", F.lit(r"\b")).alias("pattern"), F.col("p_brand").alias("label"))
    titles = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    titles = titles.join(part, "p_partkey").select("l_orderkey", "l_linenumber", F.concat(F.lit("a "), "text", F.lit(" b")).alias("title"))
    found = C.multilabel_by_table(titles, "title", rules, "labels", "none")
    return found.withColumn("labels", joined("labels"))


@query
def standardize_names_tables(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    exact = spark.createDataFrame(list(N.PRIORITY_NAMES.items()), "key STRING, value STRING")
    parts = spark.createDataFrame([(i, k, label) for i, (label, ks) in enumerate(N.PRIORITY_PARTS) for k in ks], "priority INT, keyword STRING, label STRING")
    return C.standardize_by_tables(orders, "o_orderpriority", exact, parts, "name").select("o_orderkey", "name")


@query
def classify_membership_table(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    members = spark.createDataFrame([(m,) for m in [*N.ROMANCE, *N.ROMANCE, None]], "member STRING")
    return C.member_by_table(docs, "lang", members, "kind", "romance", "other")


@query
def levels_exploded(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", _name_levels(F.col("p_name")).alias("levels"))
    return M.explode_labels(part, "levels", "level")


@query
def standardize_names(spark, sf):
    orders = table(spark, sf, "orders")
    name = C.standardize_name(F.col("o_orderpriority"), N.PRIORITY_NAMES, N.PRIORITY_PARTS)
    return orders.select("o_orderkey", name.alias("name"))


@query
def map_lookup_default(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.map_join(
        orders, "o_orderpriority", N.priority_map(spark), "label", F.col("o_orderpriority")
    )


@query
def classify_membership(spark, sf):
    docs = table(spark, sf, "documents")
    kind = C.member_or_not(F.col("lang"), N.ROMANCE, "romance", "other")
    return docs.select("doc_id", "lang", kind.alias("kind"))


# --- joins and incremental batches --------------------------------------------


def _default_titles(spark, sf):
    """Titles that hold each keyword of the default rules in turn, a level, and a part's name."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    of = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("p_partkey") % len(values)).cast("int"))
    return part.select("p_partkey", "p_name", F.concat_ws(" ", of(N.DEFAULT_LEVELS), of(N.DEFAULT_KEYWORDS), "p_name").alias("title"))


@query
def default_levels(spark, sf):
    return _default_titles(spark, sf).select("p_partkey", joined(C.levels(F.col("title"))).alias("levels"))


@query
def default_groups(spark, sf):
    return _default_titles(spark, sf).select("p_partkey", C.position_group(F.col("title")).alias("position_group"))


@query
def default_names(spark, sf):
    """The default names of skills: each name of the exact map and each part of the substring rules in turn."""
    part = table(spark, sf, "part").select("p_partkey")
    name = F.get(F.array(*map(F.lit, N.DEFAULT_NAMES)), (F.col("p_partkey") % len(N.DEFAULT_NAMES)).cast("int"))
    return part.select("p_partkey", C.standardize_name(name).alias("name"))


@query
def maintained_counts(spark, sf):
    """Orders per ship mode and return flag over four batches; later ones take orders' small items away."""
    store = scratch_path(spark, "counts")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", F.concat_ws("/", "l_returnflag", "l_linestatus").alias("pair"))
    for batch in range(4):
        part = F.col("l_orderkey") % 2 == batch if batch < 2 else F.col("l_orderkey") % 5 == batch
        touched = items.where(part)
        pairs = touched if batch < 2 else touched.where("l_quantity > 25")
        K.apply_batch(store, batch, touched.select("l_orderkey"), pairs, "pair", "l_orderkey")
    return K.counts(spark, store, "pair", "n")


@query
def jobs_join_skills(spark, sf):
    jobs = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    skills = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_returnflag"
    )
    return M.join_children(jobs, skills, "o_orderkey")


@query
def pending_anti_join(spark, sf):
    ids = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return I.not_in(ids, sources.read_processed_ids(done, "o_orderkey"), "o_orderkey")


@query
def new_ids_anti_join(spark, sf):
    ids = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return I.not_in_store(ids, table(spark, sf, "labels"), "doc_id")


@query
def ids_difference(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("id"))
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"))
    return I.difference(pages.unionByName(users), table(spark, sf, "labels").select(F.col("doc_id").alias("id")))


@query
def cache_hit_semi(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return I.in_cache(docs, table(spark, sf, "labels"), "doc_id")


@query
def fetch_backlog(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("job_id"))
    cache = table(spark, sf, "labels").select(F.col("doc_id").alias("job_id"))
    return extract.fetch_backlog(ids, cache)


@query
def worklist_status(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    processed = table(spark, sf, "pages").select(F.col("page_id").alias("id"))
    cached = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return I.worklist_status(ids, processed, cached, "id", may_fetch=True)


@query
def children_by_parent(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey"
    )
    lists = O.children_by_parent(orders, items, "o_orderkey", "l_partkey", "parts")
    return lists.select("o_orderkey", joined("parts", ",").alias("parts"))


def _links(spark, sf, pattern=N.LINK_PATTERN):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", H.extract_ids(F.col("html"), pattern).alias("ids"))


@query
def child_counts(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    return O.child_counts(orders, items, "o_orderkey", "l_suppkey", "n")


@query
def first_seen_ids(spark, sf):
    return I.first_seen(_links(spark, sf), "ids", "page_id")


@query
def first_seen_strict(spark, sf):
    return I.first_seen_strict(_links(spark, sf), "ids", "page_id")


@query
def take_while_pages(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return I.take_while(events, "user_id", "event_id", F.col("event_type") != "error")


@query
def collect_new_ids(spark, sf):
    """Ten pages make a term; the words of the documents are stored ids."""
    pages = table(spark, sf, "pages").select(
        F.floor(F.col("page_id") / 10).alias("term_ord"),
        (F.col("page_id") - 10 * F.floor(F.col("page_id") / 10)).alias("page"),
        "url",
        "html",
    )
    docs = table(spark, sf, "documents")
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)))
    stored = explode_computed(docs, [], words, "job_id")
    return collect.collect_ids(pages, stored, N.LINK_PATTERN)


@query
def last_write_wins(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return O.latest(events, "user_id", "event_id")


@query
def url_frontier(spark, sf):
    regions = table(spark, sf, "region")
    slug = F.regexp_replace(F.lower("r_name"), " ", "-")
    terms = regions.select(F.col("r_regionkey").cast("long").alias("term_ord"), slug.alias("term"))
    urls = I.url_frontier(terms, "https://example.com/search/%s-jobs?start=%d", 3, 10, ["term_ord"])
    return urls.withColumn("page", F.col("page").cast("long"))


@query
def pending_extract(spark, sf):
    """Listed, cached and unprocessed: event users, pages, labelled ids."""
    return _raw_extract(spark, sf, listed=True).withColumn("skills", joined("skills"))


@query
def offline_extract(spark, sf):
    return _raw_extract(spark, sf, listed=False).withColumn("skills", joined("skills"))


def _raw_extract(spark, sf, listed):
    cache = texts(spark, sf, "pages", "page_id", "html").select(
        F.col("page_id").cast("string").alias("job_id"), F.col("html").alias("html_text")
    )
    jobs = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    how = dict(layout=N.PAGE, mode_words=N.MODE_WORDS)
    if listed:
        ids = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("job_id"))
        return extract.extract_pending(ids, cache, jobs, N.dictionary(spark), **how)
    return extract.extract_offline(cache, jobs, N.dictionary(spark), **how)


# --- merging ------------------------------------------------------------------


def _customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("job_id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("work_mode"),
        moment("2024-01-01 00:00:00").alias("created_at"),
    )


def _event_updates(spark, sf):
    """The last event of each user; a last 'error' carries a NULL title."""
    last = O.latest(table(spark, sf, "events"), "user_id", "event_id")
    return last.select(
        (F.col("user_id") * 20).alias("job_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("title"),
        F.col("props").alias("work_mode"),
        moment("2024-06-01 00:00:00").alias("created_at"),
    )


@query
def upsert_jobs(spark, sf):
    return O.upsert(
        _customers(spark, sf), _event_updates(spark, sf), "job_id", ["title", "work_mode"], ["created_at"]
    )


@query
def upsert_html(spark, sf):
    """Documents arrive as newer texts of pages and as new ids."""
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("job_id"),
        F.col("html").alias("html_text"),
        moment("2024-01-01 00:00:00").alias("fetched_at"),
    )
    newer = table(spark, sf, "documents").select(
        (2 * F.col("doc_id")).alias("job_id"),  # every second page stays old
        F.col("text").alias("html_text"),
        moment("2024-06-01 00:00:00").alias("fetched_at"),
    )
    return O.upsert_pages(pages, newer)


def _order_parts(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill"), "l_returnflag", "l_linestatus"
    )


def _order_pairs(items):
    return dealt(items.select("job_id", "skill"), "job_id", "skill").distinct()


@query
def replace_children(spark, sf):
    """Open orders arrive with their returned items, numbered anew, as new children;
    returned items of other orders are orphans."""
    items = _order_parts(spark, sf)
    old = _order_pairs(items)
    parents = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("job_id")
    )
    new = items.where("l_returnflag = 'R'").select("job_id", (F.col("skill") + 1).alias("skill"))
    return O.replace_children(old, parents, new, "job_id", "skill")


@query
def insert_ignore(spark, sf):
    items = _order_parts(spark, sf)
    base = _order_pairs(items.where("l_linestatus = 'F'"))
    new = items.where("l_returnflag = 'A' OR l_linestatus <> 'F'").select("job_id", "skill")
    return O.insert_ignore(base, new, ["job_id", "skill"])


@query
def cascade_delete(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey"
    )
    deleted = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return O.cascade_delete(items, deleted, "o_orderkey")


@query
def append_entries(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region"))
    return O.append(nations, table(spark, sf, "supplier").select(F.col("s_name").alias("name")))


# --- aggregates ---------------------------------------------------------------


@query
def dataset_summary(spark, sf):
    return M.summary(
        table(spark, sf, "events"), "user_id", "event_type", "event_type", "error",
        ("n_rows", "n_users", "n_types", "n_users_ok"),
    )


@query
def filtered_distinct_count(spark, sf):
    orders = table(spark, sf, "orders")
    return M.distinct_where(orders, "o_custkey", ~F.col("o_orderpriority").eqNullSafe("5-LOW"), "n_customers")


@query
def filter_not_in(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return M.excluding(orders, "o_orderpriority", ["5-LOW", "4-NOT SPECIFIED"])


@query
def project_fixed(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("job_id"), F.col("url").alias("title"), "html"
    )
    return O.project(pages, S.JOBS_CSV)


def _part_items(spark, sf):
    """Parts as titles of the orders that hold them."""
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        _name_group(F.col("p_name")).alias("position_group"),
        _name_levels(F.col("p_name")).alias("levels"),
        "p_type",
        "p_brand",
    )
    items = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    return M.join_children(part, items, "l_partkey")


@query
def jobs_per_group(spark, sf):
    counts = M.entities_per_group(_part_items(spark, sf), "position_group", "l_orderkey")
    return M.ranked(counts, "n", "position_group")


@query
def jobs_per_level(spark, sf):
    rows = M.explode_labels(_part_items(spark, sf), "levels", "level")
    return M.ranked(M.entities_per_group(rows, "level", "l_orderkey"), "n", "level")


@query
def jobs_per_skill(spark, sf):
    counts = M.entities_per_group(_part_items(spark, sf), "p_brand", "l_orderkey")
    return M.ranked(counts, "n", "p_brand")


@query
def rows_per_type(spark, sf):
    rows = M.explode_labels(_part_items(spark, sf), "levels", "level")
    return M.ranked(M.rows_per_group(rows, "p_type"), "n", "p_type")


@query
def top_skills(spark, sf):
    counts = M.entities_per_group(_part_items(spark, sf), "l_partkey", "l_orderkey")
    return M.top(counts, "n", "l_partkey", 20)


@query
def first_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return M.first_rows(orders, 10, "o_orderpriority", "o_orderkey")


@query
def level_share(spark, sf):
    """Groups left out of both sides; an order counts in each of its levels."""
    rows = M.excluding(_part_items(spark, sf), "position_group", ["Machine", "Warm Stock"])
    shares = M.share_of_entities(M.explode_labels(rows, "levels", "level"), "level", "l_orderkey")
    labelled = shares.withColumn("label", C.lookup_or_self(F.col("level"), {"size": "Size", "heat": "Heat"}))
    return labelled.withColumn("n_label", X.thousands(F.col("n")))


@query
def work_mode_share(spark, sf):
    return M.ranked(
        M.share_of_entities(table(spark, sf, "orders"), "o_orderstatus", "o_orderkey"), "n", "o_orderstatus"
    )


@query
def top_skills_per_group(spark, sf):
    """The flagship: dictionary match over all texts, top 5 terms per source."""
    docs = texts(spark, sf, "documents", "doc_id", "source", "text")
    found = D.match_dictionary(docs, "doc_id", "text", N.dictionary(spark))
    terms = explode_computed(found, ["doc_id", "source"], "skills", "skill")
    # A text's terms are distinct and doc_id is a key, so the pairs need no shuffle.
    counts = M.entities_per_group(terms, ["source", "skill"], "doc_id", unique=True)
    top = M.top_per_group(counts, "source", "n", "skill", 5)
    return top.withColumn("rank", F.col("rank").cast("long"))


# --- constraint checks --------------------------------------------------------


@query
def pk_violations(spark, sf):
    return O.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return O.orphans(docs, table(spark, sf, "pages").select(F.col("page_id").alias("doc_id")), "doc_id")


@query
def domain_violations(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '3-MEDIUM')").alias("o_orderpriority")
    )
    return O.domain_violations(orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query
def null_violations(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
    )
    found = O.null_violations(orders, ["priority", "status"])
    return found.select("o_orderkey", joined("missing").alias("missing"))


# --- sources and sinks: written to the shared scratch folder and read back ------


def _mart(spark, sf):
    """Parts as jobs, "returnflag/linestatus" pairs of their items as skills."""
    jobs = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("job_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("company"),
        F.col("p_type").alias("city"),
        F.lit(None).cast("string").alias("work_mode"),
    )
    skills = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("job_id"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("skill"),
    )
    return analyse.build_mart(
        jobs,
        skills.distinct(),
        group_of=_name_group,
        levels_of=_name_levels,
        name_of=lambda c: C.standardize_name(c, N.PAIR_NAMES, N.PAIR_PARTS),
        type_of=lambda c: C.member_or_not(c, N.PAIR_MEMBERS, "closed", "open"),
    )


@query
def mart_rows(spark, sf):
    return _mart(spark, sf)


@query
def mart_flat_export(spark, sf):
    path = scratch_path(spark, "mart")
    sources.write_mart_csv(_mart(spark, sf), path)
    return spark.read.schema(S.MART).option("header", True).option("escape", '"').csv(path)


@query
def sink_append_ids(spark, sf):
    path = scratch_path(spark, "ids")
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("job_id"), "url")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"), F.col("source").alias("url")
    )
    sources.append_ids_csv(pages, path)
    sources.append_ids_csv(docs, path)
    return sources.read_job_ids_csv(spark, path)


@query
def sink_html_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "html")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"), F.col("text").alias("html_text")
    )
    sources.write_html_csv(docs, path)
    return sources.read_html_cache_csv(spark, path)


@query
def sink_json_roundtrip(spark, sf):
    path = scratch_path(spark, "entries")
    sources.write_entries_json(_raw_entries(spark, texts(spark, sf, "pages", "page_id", "html")), path)
    return sources.read_entries_json_lines(spark, path).withColumn("skills", joined("skills"))


def _order_model(spark, sf):
    jobs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderpriority").alias("title"),
        F.expr("nullif(o_orderstatus, 'P')").alias("work_mode"),
    )
    return jobs, _order_pairs(_order_parts(spark, sf))


@query
def sink_model_csv_roundtrip(spark, sf):
    """The local sink: both relations as CSV, joined again after reading."""
    path = scratch_path(spark, "model")
    jobs, skills = _order_model(spark, sf)
    sources.write_model(jobs, skills, "local", path, columns=["title", "work_mode"])
    read = lambda name, schema: spark.read.schema(schema).option("header", True).csv(f"{path}/{name}")
    return M.join_children(
        read("jobs", "job_id LONG, title STRING, work_mode STRING"),
        read("job_skills", "job_id LONG, skill LONG"),
        "job_id",
    )


@query
def sink_model_repeated_ids(spark, sf):
    """A user's events arrive as versions of one job; the last of each counts."""
    path = scratch_path(spark, "model")
    batch = table(spark, sf, "events").select(
        F.col("user_id").alias("job_id"), F.col("event_type").alias("title"), F.col("props").alias("work_mode"),
        moment("2024-06-01 00:00:00").alias("created_at"), "event_id",
    )
    children = _order_parts(spark, sf).select("job_id", "skill").distinct()
    sources.write_model(
        batch, children, "database", path, current=(_customers(spark, sf), children),
        columns=["title", "work_mode"], seq="event_id",
    )
    return spark.read.parquet(f"{path}/jobs")


@query
def sink_model_table_roundtrip(spark, sf):
    """The table sink: open orders are upserted, their children replaced."""
    path = scratch_path(spark, "model")
    jobs, skills = _order_model(spark, sf)
    base = jobs.withColumn("created_at", moment("2024-01-01 00:00:00"))
    batch = jobs.where("work_mode = 'O'").select(
        "job_id", F.lower("title").alias("title"), F.lit(None).cast("string").alias("work_mode"),
        moment("2024-06-01 00:00:00").alias("created_at"),
    )
    new = _order_parts(spark, sf).select("job_id", (F.col("skill") + 1).alias("skill"))
    sources.write_model(
        batch, new, "database", path, current=(base, skills), columns=["title", "work_mode"]
    )
    return M.join_children(
        spark.read.parquet(f"{path}/jobs"), spark.read.parquet(f"{path}/job_skills"), "job_id"
    )


@query
def sink_quarantine(spark, sf):
    """Orders and items as a model with offences: the quarantined rows with their reasons."""
    path = scratch_path(spark, "model")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    jobs = orders.select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") - F.col("o_orderkey") % 3).alias("job_id"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("work_mode"),
    )
    skills = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.when(F.col("l_linenumber") < 6, F.col("l_partkey")).alias("skill"))
    sources.write_checked_model(jobs, skills, "local", path, "quarantine", {"work_mode": ["F", "O"]}, columns=["title", "work_mode"])
    bad = spark.read.parquet(f"{path}/quarantine/jobs").select(F.lit("jobs").alias("part"), "reasons")
    bad = bad.unionAll(spark.read.parquet(f"{path}/quarantine/job_skills").select(F.lit("job_skills"), "reasons"))
    return bad.groupBy("part", joined("reasons").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query
def src_ids_csv(spark, sf):
    """Blank and missing ids are dropped; the set form is distinct."""
    path = scratch_path(spark, "ids")
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", "").when(
            F.col("event_type") != "view", F.col("user_id").cast("string")
        ).alias("job_id"),
        F.col("props").alias("url"),
    )
    sources.append_ids_csv(events, path)
    return sources.read_job_ids_csv(spark, path).select("job_id").distinct()


def _many_tasks(scan):
    """At least five tasks, and as many as the scan has: they grow with it, a task's bytes do not."""
    return scan.repartition(max(5, scan.rdd.getNumPartitions()))


@query
def src_cache_last_wins(spark, sf):
    """Two appends of the cache: the later text of an id wins, whatever its blanks."""
    path = scratch_path(spark, "html")
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit(" "), F.col("page_id").cast("string")).alias("job_id"),
        F.col("html").alias("html_text"),
    )
    docs = table(spark, sf, "documents").select(
        (2 * F.col("doc_id")).cast("string").alias("job_id"), F.col("text").alias("html_text")
    )
    # Many tasks write each append, under names in no order.
    sources.write_html_csv(_many_tasks(pages), path, batch=0)
    sources.write_html_csv(_many_tasks(docs), path, batch=1)
    return sources.read_html_cache_csv(spark, path)


@query
def src_json_tolerant(spark, sf):
    """One JSON array per page; those of German pages are broken off and give no row."""
    path = scratch_path(spark, "entries")
    pages = table(spark, sf, "pages")
    entry = F.to_json(
        F.array(
            F.struct(
                F.col("page_id").cast("string").alias("job_id"),
                F.col("url").alias("title"),
                F.split("url", "/").alias("skills"),
            )
        )
    )
    broken = F.when(F.contains("html", F.lit('lang="de"')), F.expr("left(entry, length(entry) - 9)"))
    lines = pages.select("html", entry.alias("entry"))
    lines.select(broken.otherwise(F.col("entry")).alias("value")).write.text(path)
    return sources.read_entries_json_lines(spark, path).withColumn("skills", joined("skills"))


@query
def src_cache_default_appends(spark, sf):
    """Two appends without a number or a column that orders them: the later one wins."""
    path = scratch_path(spark, "html")
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit(" "), F.col("page_id").cast("string")).alias("job_id"),
        F.col("html").alias("html_text"),
    )
    docs = table(spark, sf, "documents").select(
        (2 * F.col("doc_id")).cast("string").alias("job_id"), F.col("text").alias("html_text")
    )
    sources.write_html_csv(_many_tasks(pages), path)
    sources.write_html_csv(_many_tasks(docs), path)
    return sources.read_html_cache_csv(spark, path)


@query
def src_json_array(spark, sf):
    """Two files of one JSON array each, read in ranges of 64 KB: that of German pages is cut off and gives no row."""
    folder = scratch_path(spark, "arrays")
    pages = table(spark, sf, "pages")
    entry = F.to_json(F.struct(F.col("page_id").cast("string").alias("job_id"), F.col("url").alias("title"), F.split("url", "/").alias("skills")))
    german = F.contains("html", F.lit('lang="de"'))
    for name, part, tail in (("whole", ~german, "]"), ("cut", german, "")):
        rows = pages.where(F.coalesce(part, F.lit(name == "whole"))).select(F.col("page_id").alias("n"), entry.alias("value"))
        first = F.row_number().over(Window.orderBy("n")) == 1  # one file is written by one task
        lines = rows.select("n", F.concat(F.when(first, "[").otherwise(","), F.col("value")).alias("value"))
        end = spark.range(1).select(F.lit(1 << 60).alias("n"), F.lit(tail).alias("value"))
        lines.unionAll(end).coalesce(1).sortWithinPartitions("n").select("value").write.mode("append").text(folder)
    return sources.read_entries_json_array(spark, folder, 64 << 10).withColumn("skills", joined("skills"))


@query
def src_csv_multi_line(spark, sf):
    """Pages of a cache that keeps its newlines inside quotes."""
    folder = scratch_path(spark, "cache")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("job_id"), F.col("text").alias("html_text"))
    writer = docs.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return sources.read_html_cache_csv(spark, folder, multi_line=True)


@query
def ensure_schema(spark, sf):
    """The tables, created twice, in a database of their own below the scratch folder."""
    path = scratch_path(spark, "schema")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    sources.ensure_schema(spark, database)
    sources.ensure_schema(spark, database)
    jobs = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.col("o_orderpriority").alias("title"),
        F.lit(None).cast("string").alias("company"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("work_mode"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )
    jobs.write.insertInto(f"{database}.jobs")
    return spark.table(f"{database}.jobs").select("job_id", "title", "work_mode")


# --- streams ------------------------------------------------------------------


def _feed(spark, sf, slices):
    """The pages as a growing folder: each slice of the table arrives later."""
    folder = scratch_path(spark, "feed")
    pages = table(spark, sf, "pages").select(
        "page_id", H.extract_ids(F.col("html"), N.LINK_PATTERN).alias("ids")
    )
    top = pages.agg(F.max("page_id")).first()[0] + 1
    for i in range(slices):
        part = pages.where((F.col("page_id") >= top * i / slices) & (F.col("page_id") < top * (i + 1) / slices))
        part.write.mode("append").parquet(folder)
        yield spark.readStream.schema(part.schema).parquet(folder)


@query
def stream_first_seen(spark, sf):
    """The stream is stopped and restarted between the arrivals of its input."""
    store, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "checkpoint")
    for stream in _feed(spark, sf, 3):
        SF.stream_first_seen(stream, "ids", "page_id", store, checkpoint)
    return SF.read_store(spark, store).select("job_id", "page_id")


@query
def stream_take_while(spark, sf):
    """A user's events are its pages, numbered in order; they arrive in three parts across that order."""
    store, checkpoint, folder = (scratch_path(spark, n) for n in ("read", "checkpoint", "feed"))
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    pages = events.withColumn("page", number.cast("long"))
    for i in (2, 0, 1):
        pages.where(F.col("event_id") % 3 == i).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(pages.schema).parquet(folder)
        TW.stream_take_while(stream, "user_id", "page", F.col("event_type") != "error", store, checkpoint)
    return spark.read.parquet(store).select("user_id", "event_id", "event_type")


@query
def stream_extract_upsert(spark, sf):
    """Pages arrive in three parts, the stream is restarted for each; entries with their terms."""
    store, checkpoint = scratch_path(spark, "entries"), scratch_path(spark, "checkpoint")
    folder = scratch_path(spark, "feed")
    pages = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("job_id"), F.col("html").alias("html_text"), "page_id"
    )
    for i in range(3):
        part = pages.where(F.col("page_id") % 3 == i)
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        SU.stream_extract_upsert(
            stream, N.dictionary(spark), "page_id", store, checkpoint, layout=N.PAGE, mode_words=N.MODE_WORDS
        )
    now = SU.current(spark, store, "job_id").drop("created_at", "batch_id")
    return now.withColumn("skills", joined("skills"))


@query
def stream_upsert(spark, sf):
    """Two arrivals of events, compacted in between; the last event of a user wins."""
    store, checkpoint = scratch_path(spark, "upserts"), scratch_path(spark, "checkpoint")
    folder = scratch_path(spark, "feed")
    events = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.split("props", ":").alias("skills"),
        F.col("ts").alias("created_at"),
    )
    half = events.agg(F.avg("event_id")).first()[0]
    for part in (events.where(F.col("event_id") < half), events.where(F.col("event_id") >= half)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        SU.stream_upsert(stream, "user_id", "event_id", store, checkpoint)
        if not SU.has_snapshot(spark, store):
            SU.compact(spark, store, "user_id")
    now = SU.current(spark, store, "user_id")
    return now.select("user_id", "event_id", "event_type", joined("skills").alias("skills"))


@query
def stream_upsert_two_checkpoints(spark, sf):
    """Two streams with checkpoints of their own write to one store: what each stored stays."""
    store = scratch_path(spark, "upserts")
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").alias("created_at"))
    half = events.agg(F.avg("event_id")).first()[0]
    for part in (events.where(F.col("event_id") < half), events.where(F.col("event_id") >= half)):
        folder = scratch_path(spark, "feed")
        part.write.parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        SU.stream_upsert(stream, "user_id", "event_id", store, scratch_path(spark, "checkpoint"))
    return SU.current(spark, store, "user_id").select("user_id", "event_id", "event_type")
