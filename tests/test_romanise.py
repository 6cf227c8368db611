"""Other scripts: whole blocks against brute force, words against their known spelling."""

import unicodedata

from pyspark.sql import functions as F

from textmart.functions import romanise as R
from textmart.functions import text as X

WORDS = {
    "서울 한국어": "seoul hangugeo",
    "とうきょう がっこう しゃしん ちょっと": "toukyou gakkou shashin chotto",
    "マッチ コーヒー ファイル チェック ウィンドウ": "matchi ko-hi- fairu chekku windou",
    "データ・エンジニア": "de-ta enjinia",
    "ﾃﾞｰﾀ ﾊﾟｽ": "de-ta pasu",
    "がっ": "gatsu",
    "नमस्ते हिन्दी क़लम": "namaste hindi qalama",
    "مهندس بيانات، مُحَمَّد": "mhnds byanat, muhammad",
    "שלום שׂר": "shlvm sr",
    "٣٤۵ ९": "345 9",
    "Дата Ωμέγα São – ß": "Data Omega Sao - ss",
}


def test_words(rows):
    assert rows(list(WORDS), X.transliterate) == list(WORDS.values())


def test_every_hangul_syllable(rows):
    parts = [names.split(" ") for names in (R.HANGUL_FIRST, R.HANGUL_VOWEL, R.HANGUL_LAST)]
    values, want = [], []
    for cp in range(0xAC00, 0xD7A4):
        letters = [ord(c) - base for c, base in zip(unicodedata.normalize("NFD", chr(cp)), (0x1100, 0x1161, 0x11A7))]
        values.append(chr(cp))
        want.append("".join(p[i] for p, i in zip(parts, letters)).replace("-", ""))
    assert rows(values, X.transliterate) == want


def test_kana_digraphs_by_brute_force(rows):
    """Each pair of kana: both spellings, but for a small second one and a doubling first one."""
    plain = [k for k, s in R.spellings().items() if 0x3041 <= ord(k) <= 0x3096 and s.isascii() and k not in "ゎゕゖ"]
    sound = {k: R.spellings()[k] for k in plain}
    values, want = [], []
    for k in plain:
        for small, vowel in zip("ゃゅょ", "auo"):
            values.append(k + small)
            s = sound[k]
            if s in ("shi", "chi", "ji"):
                want.append(s[:-1] + vowel)
            else:
                want.append((s[:-1] if s.endswith("i") else s) + "y" + vowel)
        values.append("っ" + k)
        s = sound[k]
        want.append(("t" if s.startswith("ch") else s[0] if s[0] not in "aiueon" else "tsu") + s)
    assert rows(values, X.transliterate) == want


def test_devanagari_syllables_by_brute_force(rows):
    consonants, signs = R._row(*R.DEVANAGARI_CONSONANTS), R._row(*R.DEVANAGARI_SIGNS)
    values, want = [], []
    for c, s in consonants.items():
        values += [c, c + "्", c + "़्", *(c + v for v in signs)]
        dotted = R._dotted().get(c + "़", s).rstrip(R._INHERENT)
        want += [s + "a", s, dotted, *(s + v for v in signs.values())]
    assert rows(values, X.transliterate) == want


def test_nothing_known_is_dropped_and_the_rest_is_told(rows):
    silent = set(R.SILENT) | {"्", "ّ"}
    chars = [c for c in R.spellings() if c not in silent and c not in "っッｯ"]
    assert [c for c, s in zip(chars, rows(chars, X.transliterate)) if not s] == []
    assert rows(["漢字 kana かな 漢", "São", "", None, "กข", "é"], X.not_spelled) == [
        ["漢", "字"], [], [], None, ["ก", "ข", ""], [],
    ]


def test_other_texts_stay(rows):
    values = [None, "", "plain", "São Paulo – ß", "漢字", "x", "xy 한"]
    assert rows(values, R.romanise)[:6] == values[:6]
    assert rows(values, X.transliterate) == [None, "", "plain", "Sao Paulo - ss", "", "x", "xy han"]
    # All fields of a row that are looked at more than once agree.
    assert rows(["한"] * 3, lambda c: F.concat(X.transliterate(c), X.transliterate(c))) == ["hanhan"] * 3
