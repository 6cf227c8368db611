"""Required strings, and tables of patterns against testing each pattern."""

import random
import re

import pytest

from textmart.functions import classify as C
from textmart.functions.patterns import required

PATTERNS = [
    (r"\b(senior|sr)\b", ["senior", "sr"]), (r"s[eê]nior\b|\bstaff\b", ["nior", "staff"]), ("colou?r", ["color", "colour"]), ("(?i)DATA +lake", ["data", "lake"]), ("a.*bcd", ["bcd"]),
    ("(ab)+c", ["ab"]), ("x*", []), (".", []), ("", []), (r"\p{L}bc", []), ("[a[b]]c", []), ("(?:mid[- ]level)x{2,3}", ["mid level", "mid-level"]), ("a|", []), ("(?=zz)q+uv", ["uv"]), ("bad(", []), ("é1", ["1"]),
]


@pytest.mark.parametrize(("pattern", "want"), PATTERNS)
def test_required_strings(pattern, want):
    got = required(pattern)
    assert got == want or {len(got) > 0, len(want) > 0} == {True} and min(map(len, got)) >= min(map(len, want))


def random_pattern(rng, depth=0):
    def atom():
        kind = rng.randrange(7 if depth < 2 else 3)
        if kind < 3:
            return "".join(rng.choice("abcABé1 ") for _ in range(rng.randrange(1, 4)))
        if kind == 3:
            return "[" + "".join(rng.sample("abc1", rng.randrange(1, 4))) + "]"
        return "(?:" + random_pattern(rng, depth + 1) + ")" + rng.choice(["", "?", "*", "+", "{2}", "{0,1}"])

    return "|".join("".join(atom() + rng.choice(["", "", ".", r"\b"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 3)))


def test_required_strings_are_in_every_match():
    rng = random.Random(5)
    used = 0
    for _ in range(3000):
        pattern = rng.choice(["", "(?i)"]) + random_pattern(rng)
        need = required(pattern)
        used += bool(need)
        for _ in range(8):
            text = "".join(rng.choice("abcABCé1 ") for _ in range(rng.randrange(0, 9)))
            if re.search(pattern, text) and need:
                assert any(s in text.lower() for s in need), (pattern, text, need)
    assert used > 1000


def test_a_table_of_patterns_equals_testing_each(spark):
    rng = random.Random(6)
    rules = [(i % 50, random_pattern(rng), f"L{i % 30}") for i in range(300)] + [(i, rf"\bname{i}x?\b", f"N{i}") for i in range(5000)]
    rules += [(1, "abc", "Z"), (1, "abc", "A"), (1, "abc", "A"), (2, None, "none"), (0, "(?i)NAME77", "case"), (3, r"\p{Lu}9", "free")]
    texts = ["".join(rng.choice("abcABé1 ") for _ in range(rng.randrange(0, 12))) for _ in range(60)] + ["name77 and NAME4", "name4999x", "", None, "É9", "name77 and NAME4"]
    table = spark.createDataFrame(rules, "priority INT, pattern STRING, label STRING")
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").repartition(3)
    got = {r.i: r.o for r in C.multilabel_by_table(df, "t", table, "o", "dflt").collect()}
    compiled = [(p, label, re.compile(r.replace(r"\p{Lu}", "[A-ZÉ]"))) for p, r, label in set(rules) if r is not None]
    for i, text in enumerate(texts):
        want = [label for _, label in sorted((p, label) for p, label, r in compiled if text is not None and r.search(text))]
        assert got[i] == (want or ["dflt"]), (text, got[i], want)
    with pytest.raises(ValueError, match="can match any text"):
        C.multilabel_by_table(df, "t", table, "o", "dflt", limit=2)
    nothing = C.multilabel_by_table(df, "t", table.limit(0), "o", "dflt").collect()
    assert [r.o for r in nothing] == [["dflt"]] * len(texts)
