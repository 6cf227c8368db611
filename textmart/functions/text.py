"""Text normalisation as native column expressions.

Two folds exist because they differ on characters that have no decomposition:
`fold` drops them (an en dash between two words glues the words), while
`transliterate` spells them (the dash becomes "-", "ß" becomes "ss").
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmart.functions.literals import string_map
from textmart.functions.romanise import ranges, repertoire, romanise

# What counts as whitespace, besides the blank, once the text is ASCII
# (the separators 0x1C-0x1F are included, Java's \s leaves them out).
ASCII_SPACE = "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
# Characters a strip removes at both ends of a Unicode text.
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of characters that have no compatibility decomposition,
# or whose spelling differs from it.
SPELLINGS = {
    "ß": "ss", "ẞ": "Ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,",
    "•": "*", "·": "*", "«": "<<", "»": ">>", "‹": "<", "›": ">",
    "¡": "!", "¿": "?", "§": "SS", "¶": "P", "©": "(c)", "®": "(r)", "™": "(tm)",
    "°": "deg", "±": "+-", "×": "x", "÷": "/", "€": "EUR", "£": "PS", "¥": "Y=",
    "¢": "C/", "¦": "|", "¬": "!", "´": "'", "¨": '"', "¯": "-", "¸": ",", "µ": "u",
    "\xad": "",
}

# Spellings of the Cyrillic and Greek small letters. Capitals are spelled alike,
# with a capital first.
CYRILLIC = (
    "а a б b в v г g д d е e ё io ж zh з z и i й i к k л l м m н n о o п p р r с s т t у u ф f х kh ц ts "
    "ч ch ш sh щ shch ъ \" ы y ь ' э e ю iu я ia є ie і i ї yi"
)
GREEK = (
    "α a β b γ g δ d ε e ζ z η e θ th ι i κ k λ l μ m ν n ξ x ο o π p ρ r ς s σ s τ t υ u φ ph χ kh ψ ps ω o "
    "ά a έ e ή e ί i ό o ύ u ώ o ϊ i ϋ u"
)


def _letters(pairs: str) -> dict[str, str]:
    cells = pairs.split(" ")
    small = dict(zip(cells[::2], cells[1::2]))
    return {k.upper(): v.capitalize() for k, v in small.items() if len(k.upper()) == 1} | small


# Last code point scanned for decompositions to ASCII: beyond it there are none.
_LAST_CODE_POINT = 0x1FFFF
# End of the common Latin blocks.
_LATIN_END = 0x17F


@lru_cache(maxsize=None)
def _decompositions() -> dict[str, str]:
    """Non-ASCII character -> the ASCII part of its compatibility decomposition."""
    table = {}
    for cp in range(0x80, _LAST_CODE_POINT + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ascii_part = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode()
        if ascii_part:
            table[chr(cp)] = ascii_part
    return table


@lru_cache(maxsize=None)
def _spelling_table() -> dict[str, str]:
    return {**_digits(), **_decompositions(), **_letters(CYRILLIC), **_letters(GREEK), **SPELLINGS}


def _digits() -> dict[str, str]:
    """Decimal digits of all scripts."""
    return {chr(cp): str(unicodedata.decimal(chr(cp))) for cp in range(0x80, _LAST_CODE_POINT + 1) if chr(cp).isdecimal()}


def _to_ascii(col: Column, table: dict[str, str], scripts: bool = False) -> Column:
    """Map single characters, then drop what is still not ASCII.

    One-to-one mappings go through a single `translate`. The one-to-many ones
    (ligatures, fractions, the ellipsis) are looked up character by character, only
    in rows that hold one. Pure ASCII rows, told by byte length = char length, skip
    it all. With `scripts`, those of `romanise` are spelled before, in the same rows.
    """
    single = {k: v for k, v in table.items() if len(v) == 1}
    many = {k: v for k, v in table.items() if len(v) != 1}
    # Testing a large class costs time per character. Rows of common Latin letters
    # alone are told apart by one range first.
    near = "".join(re.escape(c) for c in many if ord(c) <= _LATIN_END)
    far = "".join(re.escape(c) for c in many if ord(c) > _LATIN_END)
    latin = rf"\x00-\x{{{_LATIN_END:x}}}"
    maybe_many = rf"[{near}[^{latin}]]"
    has_many = rf"[{near}]|(?=[^{latin}])[{far}{repertoire() if scripts else ''}]"
    pieces = F.regexp_extract_all(romanise(col) if scripts else col, F.lit(rf"([{latin}&&[^{near}]]+|[\s\S])"), F.lit(1))
    literal = string_map(many)
    spelled = F.array_join(
        F.transform(pieces, lambda p: F.coalesce(F.try_element_at(literal, p), p)), ""
    )
    mapped = F.translate(
        F.when(col.rlike(maybe_many) & col.rlike(has_many), spelled).otherwise(col),
        "".join(single),
        "".join(single.values()),
    )
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(
        F.regexp_replace(mapped, r"[^\x00-\x7F]+", "")
    )


def fold(col: Column) -> Column:
    """Decompose, drop non-ASCII, collapse whitespace to one blank, lower. No trim."""
    return F.lower(_one_blank(_to_ascii(col, _decompositions())))


def _one_blank(col: Column) -> Column:
    """Whitespace runs become one blank. A pattern of blanks alone is half the cost
    of one with the whole whitespace class."""
    blanks = F.translate(col, ASCII_SPACE, " " * len(ASCII_SPACE))
    return F.regexp_replace(blanks, " {2,}", " ")


def transliterate(col: Column) -> Column:
    """Spell letters, digits and punctuation in ASCII; keeps case and whitespace.

    Covers decomposable characters, the tables above, the scripts of `romanise` and decimal
    digits of all scripts. Other characters are dropped; `not_spelled` tells which.
    """
    return _to_ascii(col, _spelling_table(), scripts=True)


def not_spelled(col: Column) -> Column:
    """The distinct characters that `transliterate` drops, in order of their first place.

    Combining accents (U+0300 to U+036F) belong to the letter before and count as spelled.
    """
    known = repertoire() + ranges(_spelling_table()) + r"\x{300}-\x{36f}"
    dropped = F.regexp_extract_all(col, F.lit(rf"((?=[^\x00-\x7F])[^{known}])"), F.lit(1))
    return F.when(F.octet_length(col) == F.char_length(col), F.expr("CAST(array() AS ARRAY<STRING>)")).otherwise(F.array_distinct(dropped))


def fold_text(value: str) -> str:
    """`fold` for one driver-side value (a rule or a dictionary alias), from the same tables."""
    spelled = {ord(c): a for c, a in _decompositions().items()} | dict.fromkeys(map(ord, ASCII_SPACE), " ")
    plain = "".join(c for c in value.translate(spelled) if c.isascii())
    words = plain.split(" ")
    # Inner runs of blanks are one blank; a run at an end stays as one.
    return " ".join(w for i, w in enumerate(words) if w or i in (0, len(words) - 1)).lower()


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's trim removes blanks only)."""
    return F.btrim(col, F.lit(STRIP_CHARS))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def join_nonempty(*cols: Column) -> Column:
    """Join the parts that are neither NULL nor empty with one blank."""
    return F.concat_ws(" ", *[blank_to_null(c) for c in cols])


def first_nonempty(*cols: Column) -> Column:
    """The first part that is neither NULL nor empty after stripping.

    The last part counts even if empty. If it is absent, an earlier part made of
    blanks alone still gives ''.
    """
    earlier, last = cols[:-1], cols[-1]
    return F.coalesce(
        *[blank_to_null(strip(c)) for c in earlier],
        strip(last),
        *[F.when(c != "", strip(c)) for c in earlier],
    )


def collapse_newlines(col: Column) -> Column:
    return F.regexp_replace(col, r"[\r\n]+", " ")


def strip_punctuation(col: Column) -> Column:
    """Punctuation that would hide a keyword becomes a blank; '&' and '-' stay."""
    spaced = F.regexp_replace(col, r"[()/|.,{}\\'\"\[\]]", " ")
    return strip(_one_blank(spaced))


def title_case(col: Column) -> Column:
    """Upper-case every cased letter that follows no cased letter, lower the others.

    `initcap` splits on blanks only, so it leaves "ci/cd" as "Ci/cd".
    """
    cased = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
    runs = F.regexp_extract_all(col, F.lit(f"([{cased}]+|[^{cased}]+)"), F.lit(1))

    def cap(run: Column) -> Column:
        head = F.upper(F.substring(run, 1, 1))
        return F.concat(
            F.substring(head, 1, 1),
            F.lower(F.substring(head, 2, 2147483647)),
            F.lower(F.substring(run, 2, 2147483647)),
        )

    return F.array_join(F.transform(runs, cap), "")


def thousands(col: Column) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(col, 0)


def percent(part: Column, total: Column, digits: int = 1) -> Column:
    """100 * part / total as a DOUBLE; NULL when the total is zero."""
    return F.round(F.try_divide(F.lit(100.0) * part, total), digits)


def percent_label(value: Column) -> Column:
    """12.3 -> '12.3%'."""
    return F.format_string("%.1f%%", value)
