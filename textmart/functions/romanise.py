"""Other scripts in Latin letters: Hangul, kana, Hebrew, Arabic and Devanagari, as column expressions.

A character is looked up by its code point in one literal array, a Hangul syllable by the
arithmetic of its three letters. What depends on neighbours (a small kana, a doubled
consonant, an inherent vowel) leaves a mark, which a few replacements over the whole
text settle, the longest form first. Only texts that hold such a script are taken apart.

Vowels that Hebrew and Arabic do not write are not added. A mark does not reach into Hangul or
characters that are not spelled here.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmart.functions.literals import let, string_array, string_map

# Letters of a Hangul syllable in the order of Unicode; "-" is none.
HANGUL_FIRST = "g gg n d dd r m b bb s ss - j jj c k t p h"
HANGUL_VOWEL = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i"
HANGUL_LAST = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h"
# Kana by row; the vowels of a row are a i u e o, "-" where it has none.
HIRAGANA = {
    "": "あいうえお", "k": "かきくけこ", "g": "がぎぐげご", "s": "さしすせそ", "z": "ざじずぜぞ", "t": "たちつてと",
    "d": "だぢづでど", "n": "なにぬねの", "h": "はひふへほ", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ", "m": "まみむめも",
    "y": "や-ゆ-よ", "r": "らりるれろ", "w": "わゐ-ゑを", "v": "--ゔ--",
}
KANA_SOUNDS = {"si": "shi", "zi": "ji", "ti": "chi", "di": "ji", "tu": "tsu", "du": "zu", "hu": "fu"}
# Hebrew, Arabic (with the letters of Persian and Urdu) and their vowel signs.
HEBREW = (
    "א a ב b ג g ד d ה h ו v ז z ח kh ט t י y ך k כ k ל l ם m מ m ן n נ n ס s ע ' ף p פ p ץ ts צ ts ק q ר r ש sh ת t "
    "ְ e ֱ e ֲ a ֳ o ִ i ֵ e ֶ e ַ a ָ a ֹ o ֺ o ֻ u "
    "װ v ױ oy ײ y ׳ ' ״ \" ־ -"
)
ARABIC = (
    "ء ' آ a أ a ؤ w' إ i ئ y' ا a ب b ة h ت t ث th ج j ح h خ kh د d ذ dh ر r ز z س s ش sh ص s ض d ط t ظ z ع ' غ gh "
    "ف f ق q ك k ل l م m ن n ه h و w ى a ي y ٱ a پ p چ ch ژ zh ک k گ g ی y ے e ہ h ھ h ۃ h ٹ t ڈ d ڑ r ں n "
    "ً an ٌ un ٍ in َ a ُ u ِ i ٰ a ، , ؛ ; ؟ ? ۔ . ٪ % ٫ . ٬ ,"
)
# Devanagari consonants, vowels and vowel signs in the order of Unicode from the given
# code point; consonants with a dot below; other signs.
DEVANAGARI_CONSONANTS = (0x915, "k kh g gh n ch chh j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v sh sh s h")
DEVANAGARI_VOWELS = (0x905, "a a i i u u r l e e e ai o o o au")
DEVANAGARI_SIGNS = (0x93E, "a i i u u r r e e e ai o o o au")
DEVANAGARI_DOTTED = "क q ख kh ग g ज z ड r ढ rh फ f य y"
DEVANAGARI_OTHERS = "ँ n ं n ः h ऽ ' । . ॥ . ॐ om ॠ r ॡ l"
# Hebrew letters that a point changes.
HEBREW_POINTED = "שׁ sh שׂ s וּ u וֹ o"
# Signs without a sound of their own (points, stretching, silence).
SILENT = "ּֽֿׁׂـ゙゚ْٓﾞﾟ़"

# Marks that a character leaves for its neighbours; they come from the private use area, whose
# characters in the text go first.
_SMALL_Y, _SMALL_TSU, _SMALL_VOWEL, _DOUBLE, _INHERENT, _NO_VOWEL, _SIGN, _EDGE = map(chr, range(0xE000, 0xE008))
_MARKS = f"{_SMALL_Y}-{_EDGE}"
# The stretches of code points that are looked up, and the Hangul syllables.
_BLOCKS = [(0x590, 0x6FF), (0x900, 0x97F), (0x3000, 0x30FF), (0xFF61, 0xFF9F)]
_HANGUL = r"\x{ac00}-\x{d7a3}"


def _pairs(text: str) -> dict[str, str]:
    cells = text.split(" ")
    return dict(zip(cells[::2], cells[1::2]))


def _row(first: int, names: str) -> dict[str, str]:
    return {chr(first + i): n for i, n in enumerate(names.split(" "))}


def _kana() -> dict[str, str]:
    table = {}
    for consonant, row in HIRAGANA.items():
        for kana, vowel in zip(row, "aiueo"):
            if kana != "-":
                table[kana] = KANA_SOUNDS.get(consonant + vowel, consonant + vowel)
    table |= {"ん": "n", "っ": _SMALL_TSU, "ゎ": "wa", "ゕ": "ka", "ゖ": "ke"}
    table |= {k: _SMALL_Y + s for k, s in zip("ゃゅょ", ("ya", "yu", "yo"))}
    table |= {k: _SMALL_VOWEL + s for k, s in zip("ぁぃぅぇぉ", "aiueo")}
    # Katakana stand 0x60 after hiragana; the half-width forms decompose to them.
    table |= {chr(ord(k) + 0x60): s for k, s in table.items()}
    table |= _pairs("ー - 、 , 。 . 「 \" 」 \" 『 \" 』 \" 〜 ~ 〇 0") | {"・": " "}
    return table | {chr(cp): table[unicodedata.normalize("NFKC", chr(cp))] for cp in range(0xFF61, 0xFF9E)}


@lru_cache(maxsize=None)
def spellings() -> dict[str, str]:
    """Character -> its spelling, marks included, without the Hangul syllables."""
    consonants = {k: s + _INHERENT for k, s in _row(*DEVANAGARI_CONSONANTS).items()}
    return {
        **_kana(), **_pairs(HEBREW), **_pairs(ARABIC), **dict.fromkeys(SILENT, ""),
        **consonants, **_row(*DEVANAGARI_VOWELS), **_pairs(DEVANAGARI_OTHERS),
        **{k: _SIGN + s for k, s in _row(*DEVANAGARI_SIGNS).items()},
        **{chr(cp): _dotted()[unicodedata.normalize("NFD", chr(cp))] for cp in range(0x958, 0x960)},
        "्": _NO_VOWEL, "ّ": _DOUBLE,
    }


def _dotted() -> dict[str, str]:
    return {k + "़": s + _INHERENT for k, s in _pairs(DEVANAGARI_DOTTED).items()}


@lru_cache(maxsize=None)
def two_characters() -> dict[str, str]:
    """Spellings of letters with a sign of their own: dots, points, marks of voice."""
    table = spellings()
    voiced = {}
    for kana in [c for c in table if 0x3041 <= ord(c) <= 0x30FE or 0xFF66 <= ord(c) <= 0xFF9D]:
        for sign in "゙゚ﾞﾟ":
            whole = unicodedata.normalize("NFKC", kana + sign)
            if len(whole) == 1 and whole in table:
                voiced[kana + sign] = table[whole]
    return voiced | _dotted() | _pairs(HEBREW_POINTED)


def ranges(chars) -> str:
    """A class for a pattern, without its brackets, of single characters and runs of them."""
    codes, runs = sorted(map(ord, chars)), []
    for cp in codes:
        if runs and runs[-1][1] + 1 == cp:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" if a < b else rf"\x{{{a:x}}}" for a, b in runs)


@lru_cache(maxsize=None)
def repertoire() -> str:
    """The class, without brackets, of all characters that `romanise` spells."""
    return ranges(spellings()) + _HANGUL


def _hangul(syllable: Column) -> Column:
    def letter(names: str, index: Column) -> Column:
        return F.get(string_array(n.replace("-", "") for n in names.split(" ")), index.cast("int"))

    code = F.ascii(syllable) - 0xAC00
    return F.concat(
        F.lit(_EDGE),
        letter(HANGUL_FIRST, F.floor(code / 588)),
        letter(HANGUL_VOWEL, F.floor(code % 588 / 28)),
        letter(HANGUL_LAST, code % 28),
        F.lit(_EDGE),
    )


# What the marks come to, in this order.
_SETTLE = [
    # Devanagari: a vowel sign or silence takes the place of the vowel that a consonant has.
    (f"{_INHERENT}[{_SIGN}{_NO_VOWEL}]", ""),
    (_INHERENT, "a"),
    # Arabic: the letter before is doubled, with or without its vowel sign between.
    (f"(kh|gh|sh|th|dh|ch|zh|[a-z])([aiu]?){_DOUBLE}", "$1$1$2"),
    # Kana: a small y or vowel takes the place of the vowel before it, a small tsu doubles what comes.
    (f"(sh|ch|j)i{_SMALL_Y}y", "$1"),
    (f"i{_SMALL_Y}y", "y"),
    (f"(sh|ch|ts|[bdfghjkmnprstvyz])[aiueo]{_SMALL_VOWEL}", "$1"),
    (f"u{_SMALL_VOWEL}", "w"),
    (f"{_SMALL_TSU}(?=ch)", "t"),
    (f"{_SMALL_TSU}(?=([bdfghjkmprstvwyz]))", "$1"),
    (_SMALL_TSU, "tsu"),
    (f"[{_MARKS}]", ""),
]


def romanise(col: Column) -> Column:
    """Spell the scripts of this module in ASCII; all other characters stay as they are.

    NULL stays NULL. Texts without such a script are only searched for one.
    """
    table, pairs, known = spellings(), two_characters(), repertoire()
    cells, starts = [], []
    for first, last in _BLOCKS:
        starts.append((first, last, len(cells)))
        cells += [table.get(chr(cp), "") for cp in range(first, last + 1)]
    of_two = "|".join(f"[{ranges(p[0] for p in pairs if p[1] == sign)}]{sign}" for sign in sorted({p[1] for p in pairs}))

    def one(char: Column) -> Column:
        code = F.ascii(char)
        at = F.lit(None).cast("int")
        for first, last, offset in starts:
            at = F.when(code.between(first, last), code - first + offset).otherwise(at)
        return F.when(code.between(0xAC00, 0xD7A3), _hangul(char)).otherwise(F.get(string_array(cells), at))

    def spelled(piece: Column) -> Column:
        return (
            F.when(~piece.rlike(f"^[{known}]"), F.concat(F.lit(_EDGE), piece, F.lit(_EDGE)))
            .when(F.char_length(piece) == 1, one(piece))
            .otherwise(F.try_element_at(string_map(pairs), piece))
        )

    clean = F.regexp_replace(col, f"[{_MARKS}]", "")
    pieces = F.regexp_extract_all(clean, F.lit(f"({of_two}|[{known}]|[^{known}]+)"), F.lit(1))
    out = let(pieces, lambda p: F.array_join(F.transform(p, spelled), ""))
    for pattern, by in _SETTLE:
        out = F.regexp_replace(out, pattern, by)
    held = rf"(?=[^\x00-\x{{58f}}])[{known}]"
    return F.when((F.octet_length(col) > F.char_length(col)) & col.rlike(held), out).otherwise(col)
