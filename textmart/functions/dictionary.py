"""Dictionary matching: text -> sorted distinct canonical names.

The dictionary is a table (canonical, alias, pos). Matching is on folded text,
leftmost first, longest alias first, whole terms only, and a matched stretch is
consumed: "spark sql" does not also count as "spark". Words of an alias may be
joined, spaced, hyphenated or slashed in the text.

Three forms give the same answer:

* `Matcher`: the whole dictionary as one regex literal plus a key literal. No
  join, no shuffle; for dictionaries up to `sizes.MAX_LITERAL_ROWS` aliases.
* `match_by_automaton`: the aliases as a trie in the shared folder, walked over Arrow
  batches. No join, no shuffle; also on a stream; up to `MAX_ALIAS_BYTES` of aliases.
* `match_by_join`: candidate stretches of each text are joined to the dictionary
  on their key; for dictionaries of any size.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from textmart.functions import automaton
from textmart.functions.literals import no_strings, string_map
from textmart.functions.text import fold, fold_text
from textmart.session import scratch_path
from textmart.sizes import MAX_LITERAL_ROWS, broadcast_if_small, collect_if_small
from textmart.sources import files

# Between the words of an alias. Folded text holds no other whitespace than blanks.
SEPARATORS = " /-"
# Aliases beyond this go to the join form. A byte of them takes up to 20 bytes in a
# worker; usually far less, since aliases share beginnings.
MAX_ALIAS_BYTES = 32 << 20
_BOUNDARY = ("(?<![a-z0-9])", "(?![a-z0-9])")


@dataclass(frozen=True)
class Matcher:
    """A compiled dictionary."""

    pattern: str
    canonical_by_key: dict[str, str]

    def match(self, text: Column) -> Column:
        """Raw text -> array of canonical names; NULL and '' give an empty array."""
        return self.match_folded(fold(text))

    def match_folded(self, folded: Column) -> Column:
        nothing = no_strings()
        if not self.canonical_by_key:
            return nothing
        names = string_map(self.canonical_by_key)
        spans = F.regexp_extract_all(folded, F.lit(self.pattern), F.lit(0))
        keys = F.array_distinct(F.transform(spans, lambda m: F.translate(m, SEPARATORS, "")))
        found = F.transform(keys, lambda k: F.try_element_at(names, k))
        return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(found))), nothing)


def _words(folded_alias: str) -> list[str]:
    return [w for w in re.split(f"[{re.escape(SEPARATORS)}]+", folded_alias) if w]


def _quoted(word: str) -> str:
    return re.sub(r"([^a-z0-9])", r"\\\1", word)


def compile_dictionary(aliases: list[tuple[str, str]]) -> Matcher:
    """(canonical, alias) pairs in dictionary order -> Matcher."""
    by_length = sorted(aliases, key=lambda pair: -len(fold_text(pair[1])))
    branches: dict[str, list[str]] = {}
    names: dict[str, str] = {}
    for canonical, alias in by_length:
        words = _words(fold_text(alias))
        if not words:
            continue
        # Aliases with different first characters cannot compete for a position,
        # so one branch per first character keeps the longest-first order and
        # spares the regex most of the alternatives.
        tail = f"[{re.escape(SEPARATORS)}]*".join(_quoted(w) for w in words)
        head = re.match(r"\\?.", tail).group(0)
        branches.setdefault(head, []).append(tail[len(head) :])
        names["".join(words)] = canonical
    body = "|".join(f"{head}(?:{'|'.join(tails)})" for head, tails in branches.items())
    return Matcher(f"{_BOUNDARY[0]}(?:{body}){_BOUNDARY[1]}", names)


def load_matcher(dictionary: DataFrame, limit: int | None = MAX_LITERAL_ROWS) -> Matcher | None:
    """Compile a dictionary table, or None if it is too large to be a literal (no limit: never)."""
    picked = dictionary.select("canonical", "alias", "pos").dropna(subset=["alias", "canonical"])
    rows = picked.collect() if limit is None else collect_if_small(picked, limit)
    if rows is None:
        return None
    ordered = sorted(rows, key=lambda r: r["pos"])
    return compile_dictionary([(r["canonical"], r["alias"]) for r in ordered])


def match_dictionary(
    df: DataFrame,
    key: str,
    text: str,
    dictionary: DataFrame,
    out: str = "skills",
    literal_limit: int = MAX_LITERAL_ROWS,
    automaton_limit: int = MAX_ALIAS_BYTES,
) -> DataFrame:
    """Add the array of canonical names found in `text`, by whichever form fits.

    All forms answer row by row: repeated and NULL values of `key` play no part. A
    stream has no join form (it would group unbounded rows): a dictionary beyond
    `automaton_limit` bytes of aliases is refused there.
    """
    matcher = load_matcher(dictionary, literal_limit)
    if matcher is not None:
        return df.withColumn(out, matcher.match(F.col(text)))
    if alias_bytes(dictionary) <= automaton_limit:
        return match_by_automaton(df, text, dictionary, out)
    if df.isStreaming:
        raise ValueError(f"a stream's dictionary has at most {automaton_limit} bytes of aliases")
    named = df.withColumn("_text_id", _text_id(F.col(text)))
    found = _matches(named.select("_text_id", text), text, dictionary, out)
    return (
        named.join(found, "_text_id", "left")
        .select(*df.columns, F.coalesce(out, no_strings()).alias(out))
    )


# --- the automaton ----------------------------------------------------------


def alias_bytes(dictionary: DataFrame) -> int:
    return dictionary.agg(F.sum(F.octet_length("alias"))).first()[0] or 0


def match_by_automaton(df: DataFrame, text: str, dictionary: DataFrame, out: str = "skills") -> DataFrame:
    """`df` with the array of canonical names, from a trie that is built now and kept in the scratch folder.

    The trie is built in one task: check `alias_bytes` first. Rows go through Python
    in Arrow batches, with all their columns, a text folded natively before it.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "dictionary")
    system, path = files.shared(folder)
    system.create_dir(path)
    aliases = _ordered_aliases(dictionary.dropna(subset=["alias", "canonical"]))
    if not aliases.mapInArrow(automaton.builder(f"{folder}/trie"), "bytes LONG").collect():
        return df.withColumn(out, no_strings())
    folded = f"folded_{uuid.uuid4().hex}"
    rest = [c for c in df.columns if c != out]
    schema = StructType([*[df.schema[c] for c in rest], StructField(out, ArrayType(StringType()))])
    rows = df.select(*[F.col(f"`{c}`") for c in rest], fold(F.col(text)).alias(folded))
    named = rows.mapInArrow(automaton.walker(f"{folder}/trie", folded, out), schema)
    return named.select(*[F.col(f"`{c}`") for c in df.columns], *([] if out in df.columns else [out]))


def _ordered_aliases(dictionary: DataFrame) -> DataFrame:
    """(alias: its words with joints between them, canonical) in the order they are tried, in one partition."""
    folded = dictionary.select("canonical", "pos", fold(F.col("alias")).alias("folded"))
    words = F.split(F.btrim("folded", F.lit(SEPARATORS)), "[ /-]+")
    keyed = folded.select(
        F.array_join(words, chr(automaton.JOINT)).cast("binary").alias("alias"),
        _key(F.col("folded")).alias("key"),
        F.struct((-F.length("folded")).alias("neg_length"), "pos").alias("rank"),
        "canonical",
    ).where("key <> ''")
    # Where two canonicals share a key, the alias tried last names it.
    owner = keyed.groupBy("key").agg(F.max_by("canonical", "rank").alias("canonical"))
    once = keyed.groupBy("alias", "key").agg(F.min("rank").alias("rank")).join(owner, "key")
    return once.repartition(1).sortWithinPartitions("rank", "alias").select("alias", "canonical")


def _text_id(text: Column) -> Column:
    """Equal for equal texts only (a 256-bit digest); NULL for NULL."""
    return F.sha2(text.cast("binary"), 256)


# --- the join form -----------------------------------------------------------

# A word or a single symbol, with the separators before it.
_TOKEN = r"([ /-]*(?:[a-z0-9]+|[^a-z0-9 /-]))"


def _tokens(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit(_TOKEN), F.lit(1))


def _opens_apart(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(*SEPARATORS)


def _is_word(token: Column) -> Column:
    end = F.substring(token, -1, 1)
    return end.between("a", "z") | end.between("0", "9")


def _key(span: Column) -> Column:
    return F.translate(span, SEPARATORS, "")


def _joints(span: Column) -> Column:
    """Offsets inside the key of `span` at which a separator stands in it."""
    words = F.split(F.btrim(span, F.lit(SEPARATORS)), "[ /-]+")
    start = F.struct(
        F.lit(0).alias("at"), F.expr("CAST(array() AS ARRAY<INT>)").alias("joints")
    )
    return F.aggregate(
        F.slice(words, 1, F.size(words) - 1),
        start,
        lambda acc, w: F.struct(
            (acc["at"] + F.length(w)).alias("at"),
            F.array_append(acc["joints"], acc["at"] + F.length(w)).alias("joints"),
        ),
        lambda acc: acc["joints"],
    )


def _dictionary_keys(dictionary: DataFrame) -> DataFrame:
    """One row per alias: key, allowed joints, rank (small = tried first), canonical."""
    folded = dictionary.select("canonical", "pos", fold(F.col("alias")).alias("folded"))
    keyed = folded.select(
        _key(F.col("folded")).alias("key"),
        _joints(F.col("folded")).alias("alias_joints"),
        F.struct((-F.length("folded")).alias("neg_length"), "pos").alias("rank"),
        "canonical",
        F.size(_tokens(F.col("folded"))).alias("n_tokens"),
    ).where("key <> ''")
    # Where two canonicals share a key, the alias tried last names it.
    owner = keyed.groupBy("key").agg(F.max_by("canonical", "rank").alias("canonical"))
    return keyed.drop("canonical").join(owner, "key")


def _heads(dictionary: DataFrame) -> DataFrame:
    """(head, longest): each token a stretch of some alias can begin with, and the most tokens it has.

    Where the words of an alias are joined in the text, its first token holds several
    of them: "spark sql" begins with "spark" or "sparksql".
    """
    alnum = lambda w: w.rlike("^[a-z0-9]+$")
    start = F.struct(F.lit("").alias("before"), F.lit(True).alias("open"), no_strings().alias("heads"))

    def step(acc: Column, word: Column) -> Column:
        first = F.regexp_extract(word, "^(?:[a-z0-9]+|.)", 0)
        fits = acc["open"] & ((acc["before"] == "") | alnum(first))
        return F.struct(
            F.concat(acc["before"], word).alias("before"),
            (fits & (first == word) & alnum(word)).alias("open"),
            F.when(fits, F.array_append(acc["heads"], F.concat(acc["before"], first)))
            .otherwise(acc["heads"])
            .alias("heads"),
        )

    folded = dictionary.select(fold(F.col("alias")).alias("folded"))
    words = F.split(F.btrim("folded", F.lit(SEPARATORS)), "[ /-]+")
    heads = folded.select(
        F.size(_tokens(F.col("folded"))).alias("n_tokens"),
        F.explode(F.aggregate(words, start, step, lambda acc: acc["heads"])).alias("head"),
    )
    return heads.where("head <> ''").groupBy("head").agg(F.max("n_tokens").alias("longest"))


def match_by_join(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, out: str = "skills"
) -> DataFrame:
    """(key, canonical array) for each row with a match, without a pattern literal."""
    named = df.select(key, text, _text_id(F.col(text)).alias("_text_id"))
    found = _matches(named.select("_text_id", text), text, dictionary, out)
    return named.select(key, "_text_id").join(found, "_text_id").select(key, out)


def _matches(
    texts: DataFrame, text: str, dictionary: DataFrame, out: str, head_limit: int = MAX_LITERAL_ROWS
) -> DataFrame:
    """(_text_id, canonical array) for each distinct text with a match.

    A stretch of tokens is a candidate if its first token can begin an alias, up to as
    many tokens as the longest alias so begun has; its key is looked up by an equi-join,
    the alias decides where separators may stand, and the survivors of one text are
    consumed left to right. Only distinct matches, not candidates, are grouped per text,
    so a group is bounded by its own text, however often the text is repeated. A very
    frequent key is split by AQE's skew join or avoided by the broadcast. Up to `head_limit` different
    first tokens are found within a text, more by a join with all its tokens.
    """
    dictionary = dictionary.dropna(subset=["alias", "canonical"])
    entries = _dictionary_keys(dictionary)
    heads = _heads(dictionary)  # (head, longest)
    entries = broadcast_if_small(entries.drop("n_tokens").withColumnRenamed("key", "_key"))
    key = "_text_id"

    tokens = texts.where(F.col(key).isNotNull()).select(key, _tokens(fold(F.col(text))).alias("tokens"))
    placed = F.transform("tokens", lambda token, i: F.struct(i.alias("at"), F.btrim(token, F.lit(SEPARATORS)).alias("head")))

    def begins(s: Column) -> Column:
        return (s["at"] == 0) | _opens_apart(F.get("tokens", s["at"])) | ~_is_word(F.get("tokens", s["at"] - 1))

    def ahead(s: Column, longest: Column) -> Column:
        return F.struct(s["at"].alias("at"), longest.alias("longest"), F.slice("tokens", s["at"] + 1, longest + 1).alias("ahead"))

    few = collect_if_small(heads, head_limit)
    if few is not None:
        # Tokens that are no head go no further than their own text.
        longest = string_map({r["head"]: str(r["longest"]) for r in few})
        known = F.filter(placed, lambda s: s["head"].isin([r["head"] for r in few]) & begins(s)) if few else F.filter(placed, lambda s: F.lit(False))
        tokens = tokens.select(key, "tokens", known.alias("starts"))
        reach = lambda s: F.try_element_at(longest, s["head"]).cast("int")
        # The outer form: a filter on the array's size would compute it again below.
        starts = tokens.select(key, F.inline_outer(F.transform("starts", lambda s: ahead(s, reach(s))))).where("at IS NOT NULL")
    else:
        # A text's tokens meet the heads by their places; a start that is one then takes
        # from the text as many tokens as the longest alias of its own head.
        starts = tokens.select(key, F.inline_outer(F.filter(placed, begins))).where("at IS NOT NULL").select(key, "at", "head").join(broadcast_if_small(heads), "head")
        by_text = starts.groupBy(key).agg(F.collect_list(F.struct("at", "longest")).alias("starts"))
        starts = tokens.dropDuplicates([key]).join(by_text, key).select(
            key, F.inline(F.transform("starts", lambda s: ahead(s, s["longest"])))
        )
    after = F.get("ahead", F.col("n"))
    candidates = (
        starts.withColumn(
            "n", F.explode_outer(F.sequence(F.lit(1), F.least(F.col("longest"), F.size("ahead"))))
        )
        .where(after.isNull() | _opens_apart(after) | ~_is_word(after))
        .select(
            key,
            "at",
            (F.col("at") + F.col("n")).alias("end"),
            F.array_join(F.slice("ahead", 1, F.col("n")), "").alias("span"),
        )
    )
    hits = candidates.withColumn("_key", _key(F.col("span"))).join(entries, "_key").where(
        F.size(F.array_except(_joints(F.col("span")), "alias_joints")) == 0
    )
    per_text = hits.groupBy(key).agg(
        F.array_sort(F.collect_set(F.struct("at", "rank", "end", "canonical"))).alias("spans")
    )
    start = F.struct(F.lit(0).alias("free_from"), no_strings().alias("names"))
    consumed = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.when(
            s["at"] >= acc["free_from"],
            F.struct(
                s["end"].alias("free_from"),
                F.array_union(acc["names"], F.array(s["canonical"])).alias("names"),
            ),
        ).otherwise(acc),
        lambda acc: acc["names"],
    )
    return per_text.select(key, F.array_sort(consumed).alias(out))
