import random
import re
import unicodedata

from pyspark.sql import functions as F

from textmart.functions import text as X


def brute_fold(s):
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"\s+", " ", s).lower()


def unicode_samples():
    rng = random.Random(7)
    blocks = [(0, 0x250), (0x1E00, 0x2200), (0x2460, 0x2500), (0xFB00, 0xFB10), (0xFF00, 0xFFEF),
              (0x1D400, 0x1D7FF), (0x300, 0x370), (0x400, 0x460)]
    out = []
    for _ in range(300):
        lo, hi = rng.choice(blocks)
        chars = [chr(rng.randrange(lo, hi)) for _ in range(20)]
        out.append("".join(c for c in chars if not 0xD800 <= ord(c) <= 0xDFFF))
    return out


def test_fold_equals_decomposition(rows):
    values = ["", "São  Paulo\t\nÀ", "a b", "½ ﬁn ª º ² ³ ™ …", "straße – ok", "\x1ca\x1d\x1eb"]
    values += unicode_samples()
    assert rows(values, X.fold) == [brute_fold(v) for v in values]


def test_fold_is_idempotent_and_keeps_null(rows):
    values = unicode_samples() + [None]
    once = rows(values, X.fold)
    assert rows(once, X.fold) == once
    assert once[-1] is None


def test_every_mapped_character(rows):
    chars = list(X._decompositions())
    assert rows(chars, X.fold) == [brute_fold(c) for c in chars]


def test_folds_differ_on_undecomposable(rows):
    values = ["Straße", "a – b", "it’s", "søk", "cœur", "naïve", "“x”"]
    assert rows(values, X.transliterate) == ["Strasse", "a - b", "it's", "sok", "coeur", "naive", '"x"']
    assert rows(values, X.fold) == ["strae", "a b", "its", "sk", "cur", "naive", "x"]


def test_strip_is_unicode(rows):
    values = [" \t x 　\n", "x", " x"]
    assert rows(values, X.strip) == [v.strip() for v in values]


def test_join_and_fallback(rows):
    parts = [("a", "", "c"), (None, None, None), ("a", None, "c"), ("", "", "")]
    schema = "x STRING, y STRING, z STRING"
    assert rows(parts, X.join_nonempty, schema) == ["a c", "", "a c", ""]
    pairs = [(" a ", "b"), ("", " b"), (None, "b"), (None, None), ("  ", None), ("", ""), (None, "")]
    assert rows(pairs, X.first_nonempty, "x STRING, y STRING") == ["a", "b", "b", None, "", "", ""]


def test_newlines_and_punctuation(rows):
    assert rows(["a\r\n\r\nb\nc"], X.collapse_newlines) == ["a b c"]
    assert rows(["Eng(a)/b|c.,{d}\\'e\"[f] & g-h "], X.strip_punctuation) == ["Eng a b c d e f & g-h"]


def test_title_case(rows):
    values = ["ci/cd", "node.js", "k8s", "don't", "1-URGENT", "4-NOT SPECIFIED", "análise estatística",
              "éa", "中a b", "ßa", "ªb", "", "ÉCOLE d'été"]
    assert rows(values, X.title_case) == [v.title() for v in values]


def test_number_formats(rows):
    assert rows([1234567, 12], X.thousands, "n LONG") == ["1,234,567", "12"]
    assert rows([(1, 3), (1, 0)], X.percent, "a LONG, b LONG") == [33.3, None]
    assert rows([33.3, 100.0], X.percent_label, "p DOUBLE") == ["33.3%", "100.0%"]
    assert rows([3], lambda c: F.lit(1) + c, "n INT") == [4]
