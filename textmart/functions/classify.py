"""Rule classification: ordered, multi-label and map rules held as data."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from textmart import rules as R
from textmart.functions import patterns
from textmart.functions.literals import explode_computed, let, no_strings, string_map
from textmart.functions.text import (
    fold,
    join_nonempty,
    strip,
    strip_punctuation,
    title_case,
    transliterate,
)
from textmart.session import scratch_path
from textmart.sizes import MAX_LITERAL_ROWS, broadcast_if_small, collect_if_small


def _any_of(keywords: Iterable[str]) -> str:
    """Regex for "contains one of": one small expression instead of a long OR."""
    return "|".join(re.sub(r"([^A-Za-z0-9 ])", r"\\\1", k) for k in keywords)


# --- one of several codes ----------------------------------------------------


def work_mode(*parts: Column, words: Sequence[tuple[str, str]] = R.MODE_WORDS) -> Column:
    """'hibrido', 'remoto', 'presencial' or NULL from title, city and description.

    `words` are three (label, pattern) pairs. A word of the first decides; so do
    words of the second and the third together.
    """
    (both, both_words), (one, one_words), (other, other_words) = words

    def decide(text: Column) -> Column:
        has_one, has_other = text.rlike(one_words), text.rlike(other_words)
        return (
            F.when(text.rlike(both_words) | (has_one & has_other), both)
            .when(has_one, one)
            .when(has_other, other)
        )

    return let(join_nonempty(*parts), lambda whole: let(fold(whole), decide))


# --- ordered rules, first match wins -----------------------------------------


def rule_cascade(
    text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str | None
) -> Column:
    """rules = (label, keywords) in order; the first rule with a contained keyword wins."""
    label = F.lit(default)
    for name, keywords in reversed(rules):
        label = F.when(text.rlike(_any_of(keywords)), name).otherwise(label)
    return label


def position_group(
    title: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = R.POSITION_RULES,
    default: str = R.POSITION_DEFAULT,
) -> Column:
    """Title -> position group. A title equal to a group's name stays as it is."""
    shown = F.coalesce(title, F.lit("None"))
    names = list(dict.fromkeys([name for name, _ in rules] + [default]))
    group = let(
        strip(F.lower(shown)),
        lambda low: let(
            strip_punctuation(transliterate(low)),
            lambda text: rule_cascade(text, rules, default),
        ),
    )
    return F.when(shown.isin(names), shown).otherwise(group)


def cascade_from_table(
    table: DataFrame, limit: int = MAX_LITERAL_ROWS
) -> list[tuple[str, list[str]]] | None:
    """(priority, keyword, label) rows -> ordered rules; None if too many for literals.

    Rules of one priority are tried in the order of their labels. Rows without a
    keyword are no rules; an empty keyword is in every text.
    """
    picked = table.select("priority", "keyword", "label").dropna(subset=["keyword"])
    rows = collect_if_small(picked, limit)
    if rows is None:
        return None
    grouped: dict[tuple[int, str], list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["priority"], r["label"])):
        grouped.setdefault((r["priority"], r["label"]), []).append(r["keyword"])
    return [(label, keywords) for (_, label), keywords in grouped.items()]


def classify_by_rules(
    df: DataFrame, text: str, table: DataFrame, out: str, default: str | None,
    limit: int = MAX_LITERAL_ROWS,
) -> DataFrame:
    """First matching rule of a rule table of any size: as literals if it fits, else by a join."""
    rules = cascade_from_table(table, limit)
    if rules is None:
        return rule_join_first_match(df, text, table, out, default)
    return df.withColumn(out, rule_cascade(F.col(text), rules, default))


# Lengths of keyword beginnings to join on; few, and each of at most twice the last.
_PIECE_LENGTHS = (1, 2, 4, 8, 16, 32)


def rule_join_first_match(
    df: DataFrame, text: str, table: DataFrame, out: str, default: str | None
) -> DataFrame:
    """`rule_cascade` for rule tables of any size, as an equi-join.

    A text contains a keyword only if it contains the keyword's beginning, so texts
    and rules meet on a beginning of 1, 2, 4, 8, 16 or 32 letters, the longest that
    the keyword has, and `contains` is tested on the pairs that share it. Texts are
    made distinct first: titles repeat, and a title that a third of all postings
    bear is classified once.
    """
    length = F.greatest(
        *[F.when(F.length("keyword") >= n, n).otherwise(0) for n in _PIECE_LENGTHS]
    )
    table = table.dropna(subset=["keyword"])
    everywhere = table.where("keyword = ''").agg(F.min(F.struct("priority", "label")).alias("r")).first()["r"]
    rules = (
        table.where(F.length("keyword") > 0)
        .select("priority", "keyword", "label", length.alias("n"))
        .withColumn("piece", F.substr(F.col("keyword"), F.lit(1), F.col("n")))
    )
    sizes = [r["n"] for r in rules.select("n").distinct().collect()]
    fallback = F.lit(default)
    if everywhere is not None:  # an empty keyword is in every text
        fallback = F.when(F.col(text).isNotNull(), everywhere["label"]).otherwise(fallback)
    if not sizes:
        return df.withColumn(out, fallback)
    rules = broadcast_if_small(rules.drop("n"))

    def pieces_of(text: Column) -> Column:
        of_size = lambda n: F.when(
            F.length(text) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(text) - n + 1),
                lambda i: F.substr(text, i, F.lit(n)),
            ),
        )
        return F.array_distinct(F.flatten(F.array_compact(F.array(*[of_size(n) for n in sizes]))))

    texts = df.select(F.col(text).alias("text")).distinct()
    rank = F.struct("priority", "label")
    before = (
        F.lit(True) if everywhere is None
        else rank < F.struct(F.lit(everywhere["priority"]).alias("priority"), F.lit(everywhere["label"]).alias("label"))
    )
    winners = (
        explode_computed(texts, ["text"], pieces_of(F.col("text")), "piece")
        .join(rules, "piece")
        .where(F.contains("text", "keyword") & before)
        .groupBy("text")
        .agg(F.min(rank)["label"].alias("_label"))
    )
    labelled = df.join(winners, df[text] == winners["text"], "left").drop(winners["text"])
    return labelled.withColumn(out, F.coalesce(F.col("_label"), fallback)).drop("_label")


# --- several labels ----------------------------------------------------------


def multilabel(text: Column, patterns: Sequence[tuple[str, str]], default: str) -> Column:
    """All labels whose pattern is found, in pattern order; [default] if none."""
    hits = [F.when(text.rlike(pattern), F.lit(label)) for label, pattern in patterns]
    return let(
        F.array_compact(F.array(*hits)),
        lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default))),
    )


def levels(title: Column) -> Column:
    return let(
        F.lower(F.coalesce(title, F.lit("None"))),
        lambda low: let(
            F.translate(transliterate(low), "/|", "  "),
            lambda text: multilabel(text, R.LEVEL_PATTERNS, R.LEVEL_DEFAULT),
        ),
    )


def multilabel_by_table(
    df: DataFrame, text: str, table: DataFrame, out: str, default: str, limit: int = MAX_LITERAL_ROWS
) -> DataFrame:
    """`multilabel` by a table (priority, pattern, label) of any size, labels in order of (priority, label).

    From each pattern follow strings of which a text that it matches must contain one
    (`patterns.required`). They are indexed by their rarest piece of three characters (shorter
    strings by themselves); distinct texts meet them on their own pieces, and a pattern is
    tested where its string is contained. Patterns that require nothing are tested on each
    text; there may be at most `limit` of them, more are refused. NULL texts and
    patterns match nothing; a rule that repeats counts once.
    """
    rules = table.dropna(subset=["pattern"]).select("priority", "pattern", "label").distinct()
    parsed = StructType([*rules.schema.fields, StructField("strings", ArrayType(StringType()))])
    rules = rules.mapInArrow(patterns.literals, parsed)
    # Stored once: each use below would parse all patterns again.
    path = scratch_path(df.sparkSession, "patterns")
    rules.write.parquet(path)
    rules = df.sparkSession.read.schema(parsed).parquet(path)
    free = collect_if_small(rules.where(F.size("strings") == 0).drop("strings"), limit)
    if free is None:
        raise ValueError(f"more than {limit} patterns can match any text: none of their characters is required")

    size = 3
    strings = rules.select("priority", "pattern", "label", F.explode("strings").alias("string"))
    pieces = F.when(F.length("string") < size, F.array("string")).otherwise(_pieces(F.col("string"), F.lit(size)))
    cut = strings.select("*", F.explode(F.array_distinct(pieces)).alias("piece"))
    common = cut.groupBy("piece").agg(F.countDistinct("string").alias("n"))
    rarest = cut.join(common, "piece").groupBy("priority", "pattern", "label", "string").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    rarest = broadcast_if_small(rarest)

    texts = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    low = F.lower("text")
    lengths = [r[0] for r in rarest.select(F.length("piece")).distinct().collect()]  # 1 to 3
    own = F.array_distinct(F.flatten(F.array(*[_pieces(low, F.lit(n)) for n in lengths]))) if lengths else no_strings()
    met = explode_computed(texts.withColumn("low", low), ["text", "low"], own, "piece").join(rarest, "piece")
    # A pattern with several strings in a text is tested once.
    met = met.where(F.contains("low", "string")).select("text", "priority", "pattern", "label").distinct()
    found = met.where(F.expr("text RLIKE pattern")).select("text", "priority", "label", "pattern")
    if free:
        hits = F.array_compact(F.array(*[
            F.when(F.col("text").rlike(r["pattern"]), F.struct(F.lit(r["priority"]).alias("priority"), F.lit(r["label"]).alias("label"), F.lit(r["pattern"]).alias("pattern")))
            for r in free
        ]))
        found = found.unionByName(texts.select("text", F.explode(hits).alias("h")).select("text", "h.*"))
    labels = found.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("priority", "label"))).alias("_hits"))
    labels = labels.select(F.col("text").alias("_text"), F.transform("_hits", lambda h: h["label"]).alias("_labels"))
    named = df.join(labels, F.col(text) == F.col("_text"), "left")
    return named.withColumn(out, F.coalesce("_labels", F.array(F.lit(default)))).drop("_text", "_labels")


def _pieces(text: Column, n: Column) -> Column:
    """All stretches of n characters."""
    nothing = no_strings()
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n))).otherwise(nothing)


# --- maps and sets -----------------------------------------------------------


def lookup(col: Column, mapping: dict[str, str]) -> Column:
    """Value of a small literal map, NULL if the key is not in it."""
    return F.try_element_at(string_map(mapping), col)


def lookup_or_self(col: Column, mapping: dict[str, str]) -> Column:
    """Display label of a code; the code itself if it is unknown."""
    return F.coalesce(lookup(col, mapping), col)


def map_join(
    df: DataFrame, key: str, table: DataFrame, out: str, default: Column | None = None
) -> DataFrame:
    """`lookup` against a (key, value) table of any size.

    The table must have unique keys; it is broadcast only if its size allows.
    """
    side = broadcast_if_small(
        table.select(F.col("key").alias("_map_key"), F.col("value").alias("_map_value"))
    )
    value = F.col("_map_value")
    filled = value if default is None else F.coalesce(value, default)
    return (
        df.join(side, F.col(key) == F.col("_map_key"), "left")
        .withColumn(out, filled)
        .drop("_map_key", "_map_value")
    )


def standardize_name(
    name: Column,
    exact: dict[str, str] = R.SKILL_NAMES,
    contained: Sequence[tuple[str, Sequence[str]]] = R.SKILL_NAME_PARTS,
) -> Column:
    """Exact map on the spelled name, then ordered substring rules, then title case."""
    shown = F.coalesce(name, F.lit("None"))

    def named(key: Column) -> Column:
        return F.coalesce(
            lookup(key, exact), rule_cascade(key, contained, None), title_case(strip(shown))
        )

    return let(strip(F.lower(shown)), lambda low: let(transliterate(low), named))


def standardize_by_tables(df: DataFrame, name: str, exact: DataFrame, parts: DataFrame, out: str) -> DataFrame:
    """`standardize_name` by tables of any size: exact (key, value), then parts (priority, keyword, label), then title case."""
    shown = F.coalesce(F.col(name), F.lit("None"))
    keyed = df.withColumn("_spelled", transliterate(strip(F.lower(shown))))
    mapped = map_join(keyed, "_spelled", exact, "_exact")
    ruled = classify_by_rules(mapped, "_spelled", parts, "_part", None)
    return ruled.withColumn(out, F.coalesce("_exact", "_part", title_case(strip(shown)))).drop("_spelled", "_exact", "_part")


def member_by_table(df: DataFrame, column: str, members: DataFrame, out: str, yes: str, no: str) -> DataFrame:
    """`member_or_not` by a table (member) of any size; NULL and repeated members play no part."""
    key = F.lower(transliterate(F.coalesce(F.col(column), F.lit("None"))))
    side = members.select(F.col("member").alias("key"), F.lit(yes).alias("value")).dropna().distinct()
    return map_join(df.withColumn("_member", key), "_member", side, out, F.lit(no)).drop("_member")


def member_or_not(col: Column, members: Iterable[str], yes: str, no: str) -> Column:
    """Two-way class by membership of the spelled, lowered value."""
    key = F.lower(transliterate(F.coalesce(col, F.lit("None"))))
    return F.when(key.isin(list(members)), yes).otherwise(no)


def skill_type(skill: Column) -> Column:
    return member_or_not(skill, R.SOFT_SKILLS, R.SOFT, R.TECHNICAL)
