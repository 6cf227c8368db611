"""Surrogates for personal data: keyed, of the same type and format, distinct, and the same wherever
the same entity occurs. DataFrame functions only.

Found: e-mail addresses, IPv4 addresses, telephone, card and social security numbers,
names after a title, and secrets (access keys, long hexadecimal strings, passwords).

Each entity has a canonical form that its spellings share: lower case, or for numbers the
digits. A surrogate takes the place of each digit and letter from a keyed hash of type,
canonical form and attempt, so all spellings of an entity change alike and keep their
punctuation and case. Kept are the end of an address's domain, a leading country digit,
a card's first digit (and its last one is a valid check digit), the letters that mark an
access key. IPv4 parts stay within 1 to 254. Names are made of syllables of their
script (Latin, Cyrillic, Greek); a given name ends as names of the title's gender do ("Dr"
tells none); a surname, the last word, has a form of its own, so that "Mrs Anna Smith" and
"Mr Smith" share a surname. Particles stay, initials change without being distinct.

Collision check: over all distinct entities of a type no two may get one surrogate, and
none may get what occurs as an entity itself. Those that do try again with the next
attempt, until no collision is left (of those that share one, that with the lowest
attempt, then the first in order of text, keeps it). So that a free form is always found,
forms widen with the attempt: names by a syllable, addresses and passwords by a letter,
telephone numbers by a digit (from the second on); a password's signs are drawn like letters from the first.
Types of fixed length get longer only after FORMAT_ATTEMPTS attempts. Only entities beyond attempt 0 are
sent back to their texts, so that the texts are not shuffled for the others.

Defined cases: a null text stays null, an empty one empty. Overlapping finds: the one
that begins first counts. Repeated rows change alike. An empty table stays empty. Other
columns are kept; `n_entities` and `new_text` are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.functions.literals import let
from textmart.llm.common import written

TITLES = {
    "M": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος", "Κύριε"],
    "F": ["Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Г-жа", "Госпожа", "Κυρία"],
    "N": ["Mx", "Dr", "Prof", "Professor", "Professorin", "Doktor", "Doctor", "Д-р", "Доктор", "Профессор", "Δρ", "Καθ"],
}
ALL_TITLES = sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)
# Titles in capitals are followed by names in capitals only; "MS" is mostly a product's.
CAPITAL_TITLES = sorted({t.upper() for t in ALL_TITLES} - {"MS"}, key=len, reverse=True)
ANY_TITLE, ANY_CAPITAL = "|".join(ALL_TITLES), "|".join(CAPITAL_TITLES)
LOWERS = r"[\p{Ll}\p{M}]"
NAME_PART = rf"(?:\p{{Lu}}['’])?\p{{Lu}}{LOWERS}++(?:['’]?\p{{Lu}}{LOWERS}++)*+(?!\p{{Lu}}\p{{Lu}})"
NAME_WORD = rf"{NAME_PART}(?:-{NAME_PART})*+"
CAPITAL_PART = r"(?:\p{Lu}['’]|Ma?c)?\p{Lu}{2,}+"
CAPITALS = rf"{CAPITAL_PART}(?:-{CAPITAL_PART})*+(?![\p{{Ll}}])"
PARTICLE = r"(?:v[ao]n(?: de[rnm])? |vom |zu[rm]? |von und zu |de(?: la| los| las)? |del |della |d[aiu] |dos |das |ter |ten |af |bin |ibn |al[- ]|el[- ]|d['’])"
TITLE_NEXT = rf"(?!(?:{ANY_TITLE}|{ANY_CAPITAL})(?![\p{{L}}]))"
# Initials and particles before a name word; in what follows a word, "zu" and "das" are no particles.
BEFORE = rf"(?:\p{{Lu}}\. ?)*+{PARTICLE}?"
LATER = PARTICLE.replace("zu[rm]? |", "").replace("das |", "")
NEXT = rf"(?: (?:\p{{Lu}}\. ?)*+{LATER}?{TITLE_NEXT}{NAME_WORD})"
# Nothing tells where a name in capitals ends within a text in capitals: three words at most.
IN_CAPITALS = rf"{TITLE_NEXT}{CAPITALS}(?: {TITLE_NEXT}{CAPITALS}){{0,2}}+"
TITLE_RUN, CAPITAL_RUN = rf"(?:(?:{ANY_TITLE})\.? )", rf"(?:(?:{ANY_CAPITAL})\.? )"
NAME = rf"(?:{TITLE_RUN}++{BEFORE}(?:{IN_CAPITALS}{NEXT}*+|{TITLE_NEXT}{NAME_WORD}{NEXT}*+(?: {TITLE_NEXT}{CAPITALS})?+)|{CAPITAL_RUN}++(?:\p{{Lu}}\. ?)*+{IN_CAPITALS})"
# What is replaced in a name: words, and initials for themselves.
TOKEN = rf"{CAPITALS}|{NAME_WORD}|\p{{Lu}}(?=\.)"
# In this order where several fit at one place. None begins within a word or number.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "key": r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex": r"[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",
    "ipv4": r"(?<!\d\.)(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "card": r"(?:\d{16}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3})(?!\d)",
    "phone": r"(?:\+\d{1,3}[ -]?(?:\(\d{1,4}\)[ -]?)?\d{2,4}(?:[ -]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": NAME,
    "password": r"(?<==)(?<=(?i:password=))[^\s\"']{4,}+",
}
# The first character decides which can fit, so that most places are passed over at once.
FIRST = {r"[0-9a-fA-F+(]": ("key", "hex", "ipv4", "card", "phone", "ssn"), r"\p{Lu}": ("name",)}
ANY = "(?<![A-Za-z0-9])(?:" + "|".join(
    [PATTERNS["email"]]
    + [f"(?={first})(?:" + "|".join(PATTERNS[n] for n in names) + ")" for first, names in FIRST.items()]
    + [PATTERNS["password"]]
) + ")"
DIGITS, LOWER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
LETTERS = {"Cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω"}
# The attempt from which forms get longer where that breaks a type's format.
FORMAT_ATTEMPTS = 16
SYLLABLES = {
    "cyrillic": (list("бвгдзклмнпрст"), list("аеиоу"), {"M": ["ан", "ор", "ил"], "F": ["ана", "ина", "ея"], "N": ["ин", "ей", "аль"], "S": ["енко", "ук", "ич"]}),
    "greek": (list("βγδκλμνπρστ"), list("αειου"), {"M": ["ος", "ης", "ας"], "F": ["η", "ια", "ω"], "N": ["ις", "ων", "ευς"], "S": ["ίδης", "άκης", "ίου"]}),
    "latin": (list("bdfgklmnprstvz"), list("aeiou"), {"M": ["an", "us", "or"], "F": ["a", "ina", "elle"], "N": ["is", "ey", "in"], "S": ["son", "mann", "ez"]}),
}


def kind_of(surface: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        # A password is known only by what stands before it: what no other pattern fits.
        if name != "password":
            whole = rf"^(?:{PATTERNS[name]})$"
            kind = F.when(surface.rlike(whole), name).otherwise(kind)
    return F.coalesce(kind, F.lit("password"))


def may_hold(text: Column) -> Column:
    """False only for texts in which no pattern is found; far cheaper than the patterns."""
    might = text.rlike("[0-9@]|(?i:password=)|[a-fA-F]{32}")
    starts = {t[:4] for t in ALL_TITLES + CAPITAL_TITLES}
    for start in sorted(t for t in starts if not any(t != u and t.startswith(u) for u in starts)):
        might = might | text.contains(start)
    return might


def found_in(text: Column) -> Column:
    """The entities of a text, in order, as they are written."""
    return F.regexp_extract_all(text, F.lit(ANY), 0)


def canonical(kind: Column, surface: Column) -> Column:
    number = F.concat(F.when(surface.startswith("+"), "+").otherwise(""), F.regexp_replace(surface, r"\D", ""))
    return F.when(kind.isin("phone", "card", "ssn"), number).when(kind.isin("key", "password"), surface).otherwise(F.lower(surface))


def name_parts(surface: Column) -> tuple[Column, Column]:
    """Titles, and the rest of a name."""
    title = F.regexp_extract(surface, rf"^(?:{TITLE_RUN}++|{CAPITAL_RUN}++)", 0)
    return title, F.substring(surface, F.length(title) + 1, F.length(surface))


def gender_of(title: Column) -> Column:
    def one(gender: str) -> Column:
        names = "|".join(sorted({x for t in TITLES[gender] for x in (t, t.upper())}, key=len, reverse=True))
        return title.rlike(rf"(?:^| )(?:{names})\.? ")

    return F.when(one("F"), "F").when(one("M"), "M").otherwise("N")


def name_kinds(title: Column, words: Column) -> Column:
    """The words with their kinds: the last is the surname, initials have one of their own."""

    def of(word: Column, i: Column) -> Column:
        kind = F.when(i == F.size(words) - 1, "surname").when(F.length(word) == 1, "initial").otherwise(F.concat(F.lit("given"), gender_of(title)))
        return F.struct(kind.alias("kind"), F.lower(word).alias("entity"), word.alias("word"))

    return F.transform(words, of)


def entities_of(surface: Column) -> Column:
    """(kind, canonical) of what gets a surrogate of its own in a find: one, or a name's words.

    Initials are too few to be distinct and are no entities.
    """
    title, rest = name_parts(surface)
    kinds = let(F.regexp_extract_all(rest, F.lit(TOKEN), 0), lambda words: name_kinds(title, words))
    parts = F.transform(F.filter(kinds, lambda w: w.kind != "initial"), lambda w: F.struct(w.kind.alias("kind"), w.entity.alias("entity")))

    def of(kind: Column) -> Column:
        whole = F.array(F.struct(kind.alias("kind"), canonical(kind, surface).alias("entity")))
        return F.when(kind == "name", parts).otherwise(whole)

    return let(kind_of(surface), of)


def seed(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), entity), 256)


def pick(values: Column | str, from_seed: Column, place: Column | int) -> Column:
    """One of the values (characters of a string, or elements of an array), by the seed and a place."""
    place = place if isinstance(place, Column) else F.lit(place)
    if isinstance(values, str):
        return F.substring(F.lit(values), F.pmod(F.xxhash64(from_seed, place), F.lit(len(values))).cast("int") + 1, F.lit(1))
    return F.get(values, F.pmod(F.xxhash64(from_seed, place), F.size(values)).cast("int"))


def replaced(surface: Column, from_seed: Column, kept: Callable[[Column, Column], Column], hexadecimal: Column, spelled: Column) -> Column:
    """Each letter and digit exchanged for one of its class and script; `kept(place, order)` says which stay.

    A character is drawn by its place, or, where an entity can be `spelled` with other punctuation,
    by its order among letters and digits.
    """

    def one(c: Column, i: Column) -> Column:
        p = i + 1
        order = F.when(spelled, F.length(F.regexp_replace(F.substring(surface, F.lit(1), p), "[^0-9A-Za-z]", ""))).otherwise(p)
        return let(order, lambda o: F.when(kept(p, o), c).otherwise(exchanged(o, c)))

    def exchanged(order: Column, c: Column) -> Column:
        # The letters to draw from and whether the drawn one is a capital.
        letters = F.when(hexadecimal & c.rlike("[0-9a-fA-F]"), HEX).when(c.rlike(r"[0-9]|[^\p{L}]"), DIGITS)
        for script, alphabet in LETTERS.items():
            letters = letters.when(c.rlike(rf"\p{{Is{script}}}"), alphabet)
        drawn_one = let(letters.otherwise(LOWER), lambda values: F.substring(values, F.pmod(F.xxhash64(from_seed, order), F.length(values)).cast("int") + 1, F.lit(1)))
        made = F.when(c.rlike(r"\p{Lu}"), F.upper(drawn_one)).otherwise(drawn_one)
        return F.when(c.rlike(r"[\p{L}\p{N}]"), made).otherwise(c)

    return F.array_join(F.transform(F.split(surface, ""), one), "")


def drawn(values: str, from_seed: Column, count: Column) -> Column:
    """As many keyed characters as `count` says; none where it is below one."""
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: pick(values, from_seed, i + 100_000)), "")


def with_check_digit(number: Column) -> Column:
    """The card number with its last digit set so that the sum of the check is divisible by ten."""
    digits = F.regexp_replace(number, r"\D", "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    last = F.length(body)

    def part(p: Column) -> Column:
        d = F.substring(body, p, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((last - p) % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), last), part), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(number, F.lit(1), F.length(number) - 1), F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def name_of(entity: Column, sort: Column, from_seed: Column, attempt: Column) -> Column:
    """A capitalised name of the entity's script with an ending of its sort (M, F, N or S); a syllable more for each attempt."""

    def parts(script: str) -> Column:
        heads, tails, endings = SYLLABLES[script]
        sorts = F.create_map(*[x for k, ends in endings.items() for x in (F.lit(k), F.array(*map(F.lit, ends)))])
        return F.struct(F.lit("".join(heads)).alias("heads"), F.lit("".join(tails)).alias("tails"), sorts.alias("sorts"))

    def made(of: Column) -> Column:
        letter = lambda values, i: F.substring(values, F.pmod(F.xxhash64(from_seed, i), F.length(values)).cast("int") + 1, F.lit(1))
        more = F.when(attempt > 0, F.sequence(F.lit(1), attempt)).otherwise(F.array().cast("array<int>"))
        syllables = F.array_join(F.transform(more, lambda i: F.concat(letter(of.heads, 2 * i + 4), letter(of.tails, 2 * i + 5))), "")
        first = F.array_join(F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: letter(F.when(i % 2 == 0, of.heads).otherwise(of.tails), i)), "")
        return F.initcap(F.concat(first, syllables, letter(of.heads, F.lit(4)), pick(F.element_at(of.sorts, sort), from_seed, 5)))

    script = F.when(entity.rlike(r"\p{IsCyrillic}"), parts("cyrillic")).when(entity.rlike(r"\p{IsGreek}"), parts("greek")).otherwise(parts("latin"))
    return let(script, made)


def surrogate(key: str, kind: Column, entity: Column, surface: Column, attempt: Column) -> Column:
    """What stands for `surface`, a spelling of the entity, at an attempt."""
    return let(seed(key, kind, entity, attempt), lambda s: seeded(s, kind, entity, surface, attempt))


def seeded(s: Column, kind: Column, entity: Column, surface: Column, attempt: Column) -> Column:
    """One exchange of characters serves all kinds but addresses and names; what differs is chosen before and after it."""
    part = lambda i: (1 + F.pmod(F.xxhash64(s, F.lit(i)), F.lit(254))).cast("string")
    domain_end = F.length(surface) - F.length(F.substring_index(surface, ".", -1))
    # Forms with few or no free characters get longer soon, those of a fixed length only if no other is found.
    soon, late = attempt - 1, attempt - FORMAT_ATTEMPTS

    def kept(p: Column, o: Column) -> Column:
        leading = (kind == "card") | ((kind == "phone") & surface.startswith("+"))
        return F.when(leading, o == 1).when(kind == "email", p > domain_end).when(kind == "key", p <= 4).otherwise(F.lit(False))

    plain = ~kind.isin("phone", "card", "ssn", "email", "key", "hex")
    template = F.when(plain & (attempt > 0), F.regexp_replace(surface, r"[^\p{L}\p{N}]", "x")).otherwise(surface)
    body = replaced(template, s, kept, kind == "hex", kind.isin("phone", "card", "ssn"))
    after = F.when(kind == "email", F.lit(0)).when(kind.isin("phone", "password"), soon).otherwise(late)
    more = let(after, lambda n: F.when(kind.isin("card", "phone", "ssn"), drawn(DIGITS, s, n)).when(kind == "hex", drawn(HEX, s, n)).otherwise(drawn(LOWER, s, n)))

    def finished(made: Column) -> Column:
        token = F.concat(made, more)
        return (
            F.when(kind == "card", F.concat(with_check_digit(made), more))
            .when(kind == "email", F.concat(drawn(LOWER, s, attempt), made))
            .when(kind == "key", F.concat(made, F.upper(more)))
            .when((kind == "hex") & surface.rlike("[A-F]") & ~surface.rlike("[a-f]"), F.upper(token))
            .otherwise(token)
        )

    address = F.concat(F.concat_ws(".", part(0), part(1), part(2), part(3)), F.when(late > 0, F.concat(F.lit("."), drawn(DIGITS, s, late))).otherwise(""))
    sort = F.when(kind == "surname", "S").otherwise(F.substring(kind, 6, 1))
    return F.when(kind == "ipv4", address).when((kind == "surname") | kind.startswith("given"), name_of(entity, sort, s, attempt)).otherwise(let(body, finished))


def mention(kind: Column, entity: Column) -> Column:
    return F.concat_ws("\x1f", kind, entity)


def exceptions(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, attempt) of the distinct (kind, entity) that need an attempt beyond 0."""

    def tried(frame: DataFrame) -> DataFrame:
        made = F.lower(surrogate(key, F.col("kind"), F.col("entity"), F.col("entity"), F.col("attempt")))
        made = F.when(F.col("kind") == "key", F.upper(made)).otherwise(made)
        return frame.withColumn("made", made)

    # Distinctness is checked without regard to case, within a type (given names and surnames apart).
    # Entities are few bytes and much work: dealt to a stated number of tasks, which stay as many.
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = entities.select("kind", "entity", F.lit(0).alias("attempt")).repartition(tasks, "kind", "entity")
    state = written(tried(spread), "surrogates")
    while True:
        holder = state.groupBy("kind", "made").agg(F.min(F.struct("attempt", "entity")).alias("holder"), F.count(F.lit(1)).alias("sharers"))
        shared = holder.where("sharers > 1").select("kind", "made", F.col("holder.entity").alias("holder"))
        real = state.select("kind", F.lower("entity").alias("real")).distinct()
        crossed = state.select("kind", "entity", "made").join(real.select("kind", F.col("real").alias("made_low")), (F.lower("made") == F.col("made_low")) & (state.kind == real.kind), "left_semi")
        losers = state.join(shared, ["kind", "made"]).where("entity != holder").select("kind", "entity")
        losers = written(losers.unionAll(crossed.select("kind", "entity")).distinct(), "collisions")
        if losers.isEmpty():
            return state.where("attempt > 0").select("kind", "entity", "attempt")
        again = state.join(losers, ["kind", "entity"]).select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        same = state.join(losers, ["kind", "entity"], "left_anti")
        state = written(same.unionByName(tried(again)), "surrogates")


def entity_mentions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, kind, entity): the entities of each text, each once."""
    finds = docs.where(may_hold(F.col(text))).select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.explode(F.array_distinct(found_in(F.col(text)))).alias("surface"))
    parts = finds.select("_key", "_hash", F.explode(entities_of(F.col("surface"))).alias("e"))
    return parts.select("_key", "_hash", "e.kind", "e.entity").distinct()


def woven(pieces: Column, made: Column) -> Column:
    """The pieces with what was made between them."""
    return F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), made.alias("made")), lambda z: F.array(z.piece, F.coalesce(z.made, F.lit(""))))), "")


def rendered(text: Column, found: Column, attempts: Column, secret: str) -> Column:
    """The text with surrogates for what was found; `attempts` maps mentions to attempts beyond 0."""

    def of(w: Column) -> Column:
        attempt = F.coalesce(F.try_element_at(attempts, mention(w.kind, w.entity)), F.lit(0))
        made = surrogate(secret, w.kind, w.entity, w.word, attempt)
        capitals = w.named & (F.length(w.word) > 1) & (w.word == F.upper(w.word))
        return let(made, lambda m: F.when(capitals, F.upper(m)).otherwise(m))

    def one(surface: Column) -> Column:
        title, rest = name_parts(surface)
        words = let(F.regexp_extract_all(rest, F.lit(TOKEN), 0), lambda ws: name_kinds(title, ws))
        named = F.transform(words, lambda w: F.struct(w.kind.alias("kind"), w.entity.alias("entity"), w.word.alias("word"), F.lit(True).alias("named")))

        def kinds(kind: Column) -> Column:
            whole = F.array(F.struct(kind.alias("kind"), canonical(kind, surface).alias("entity"), surface.alias("word"), F.lit(False).alias("named")))
            made = F.transform(F.when(kind == "name", named).otherwise(whole), of)
            return let(made, lambda m: F.when(kind == "name", F.concat(title, woven(F.split(rest, TOKEN, -1), m))).otherwise(F.get(m, F.lit(0))))

        return let(kind_of(surface), kinds)

    return woven(F.split(text, ANY, -1), F.transform(found, one))


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", new_text: str = "new_text", n_entities: str = "n_entities") -> DataFrame:
    """The rows with the text's surrogate form and the number of entities found."""
    mentions = written(entity_mentions(docs, key, text), "mentions")
    beyond = written(exceptions(mentions.select("kind", "entity").distinct(), secret), "attempts")
    # The attempts of a text's own entities: as many as it mentions at most.
    own = mentions.join(beyond, ["kind", "entity"]).groupBy("_key", "_hash").agg(F.map_from_entries(F.collect_list(F.struct(mention(F.col("kind"), F.col("entity")), "attempt"))).alias("_attempts"))
    own = written(own, "attempts_by_text")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (new_text, n_entities) or c in (key, text)]
    # Names of its own for what is added: no column of the table has them.
    id_, hash_, found_, attempts_ = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "hash", "found", "attempts"))
    nothing = F.array().cast("array<string>")
    found = F.when(may_hold(F.col(text)), found_in(F.col(text))).otherwise(nothing)
    keyed = docs.select(*rest, F.col(key).alias(id_), F.xxhash64(text).alias(hash_), found.alias(found_))
    own = own.select(F.col("_key").alias(f"{id_}_"), F.col("_hash").alias(f"{hash_}_"), F.col("_attempts").alias(attempts_))
    met = keyed.join(own, F.col(id_).eqNullSafe(F.col(f"{id_}_")) & (F.col(hash_) == F.col(f"{hash_}_")), "left")
    attempts = F.coalesce(attempts_, F.create_map().cast("map<string,int>"))
    made = F.when(F.size(found_) > 0, rendered(F.col(text), F.col(found_), attempts, secret)).otherwise(F.col(text))
    result = {new_text: made, n_entities: F.size(found_).cast("long")}
    return met.select(*[c for c, name in zip(rest, [c for c in docs.columns if c not in (new_text, n_entities) or c in (key, text)]) if name not in result], *[c.alias(n) for n, c in result.items()])
