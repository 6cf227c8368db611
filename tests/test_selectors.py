"""Selectors with combinators against a walk over a tree."""

import random
import re
from html.parser import HTMLParser

import pytest

from textmart.functions import html as H
from textmart.functions.selectors import Path

VOID = {"br", "img"}


class Tree(HTMLParser):
    """All elements in document order as (parent, tag, attributes)."""

    def __init__(self, page):
        super().__init__()
        self.elements, self.stack = [], [None]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.elements.append((self.stack[-1], tag, dict(attrs)))
        if tag not in VOID:
            self.stack.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        depths = [d for d, e in enumerate(self.stack) if e is not None and self.elements[e][1] == tag]
        if depths:
            del self.stack[depths[-1] :]


TESTS = {
    "[class]": lambda a: "class" in a,
    "[title=q]": lambda a: a.get("title") == "q",
    '[title="q r" ]': lambda a: a.get("title") == "q r",
    "[title='Q R' i]": lambda a: (a.get("title") or "").lower() == "q r",
    "[title~=r]": lambda a: "r" in (a.get("title") or "").split(),
    "[title|=q]": lambda a: re.match(r"q(-|$)", a.get("title") or "") is not None,
    "[title^='q']": lambda a: (a.get("title") or "").startswith("q"),
    "[title$=r]": lambda a: (a.get("title") or "").endswith("r"),
    "[title*=' ']": lambda a: " " in (a.get("title") or ""),
    "[title*='']": lambda a: False,
    ".a": lambda a: "a" in (a.get("class") or "").split(),
    ".b": lambda a: "b" in (a.get("class") or "").split(),
    "#x": lambda a: a.get("id") == "x",
}


def brute(elements, steps):
    """First element that ends the steps [(relation, tag, tests)], read from the right."""

    def before(e):
        return [i for i in range(e) if elements[i][0] == elements[e][0]]

    def fits(e, k):
        relation, tag, tests = steps[k]
        parent, name, attrs = elements[e]
        if tag not in ("", "*", name) or not all(TESTS[t](attrs) for t in tests):
            return False
        if k == 0:
            return True
        if relation == ">":
            return parent is not None and fits(parent, k - 1)
        if relation == "+":
            return bool(before(e)) and fits(before(e)[-1], k - 1)
        if relation == "~":
            return any(fits(i, k - 1) for i in before(e))
        while parent is not None:
            if fits(parent, k - 1):
                return True
            parent = elements[parent][0]
        return False

    return next((e for e in range(len(elements)) if fits(e, len(steps) - 1)), None)


def random_steps(rng):
    steps = []
    for k in range(rng.choice([1, 2, 2, 3, 4])):
        tag = rng.choice(["div", "p", "b", "*", "br", ""])
        tests = rng.sample(list(TESTS), rng.choice([0, 0, 1, 1, 2]) or (tag == ""))
        steps.append((rng.choice(" >+~") if k else "", tag, tests))
    return steps


def written(rng, steps):
    blank = lambda r: r if r == " " else rng.choice([r, f" {r} "])
    return "".join((blank(r) if r else "") + tag + "".join(tests) for r, tag, tests in steps)


def test_equals_a_tree_walk_on_random_markup(spark):
    rng = random.Random(5)
    attributes = ["", ' class="a"', " class='b a'", ' title="q r"', ' title="Q r"', " title=q-r", " title", ' id="x" title=q', ' class=b title="x r"']
    pages = []
    for _ in range(300):
        parts, n = [], 0
        for _ in range(rng.randrange(2, 40)):
            if rng.random() < 0.6:
                tag = rng.choice(["div", "p", "b", "br", "img"])
                parts.append(f"<{tag} n={n}{rng.choice(attributes)}{rng.choice(['', '', ' /'])}>")
                n += 1
            else:
                parts.append(rng.choice(["</div>", "</p>", "</b>", "text", "<!-- c -->"]))
        pages.append("".join(parts))
    wanted = {}
    for i in range(80):
        lists = [random_steps(rng) for _ in range(rng.choice([1, 1, 1, 2]))]
        wanted[f"s{i}"] = (", ".join(written(rng, s) for s in lists), lists)
    fields = {name: H.Field(Path.of(text), "attr:n") for name, (text, _) in wanted.items()}
    df = spark.createDataFrame(list(enumerate(pages)), "id INT, html STRING").repartition(8)
    got = {r["id"]: r for r in H.parse_fields(df, "id", "html", fields).collect()}
    hits = 0
    for i, page in enumerate(pages):
        elements = Tree(page).elements
        for name, (text, lists) in wanted.items():
            found = [e for e in (brute(elements, s) for s in lists) if e is not None]
            want = elements[min(found)][2]["n"] if found else None
            hits += want is not None
            assert got[i][name] == want, (page, text, want, got[i][name])
    assert hits > 2000


def test_text_and_defined_cases(spark):
    page = '<div id=m><p>one</p><ul><li>a<li>b</ul><p class="x y">two <b>bold</b></p></div><p>out</p>'
    fields = {
        "last": H.Field.of("div > ul ~ p"),
        "text": H.Field.of("div > ul ~ p", "text"),
        "list": H.Field.of("table, div p + ul > li"),
        "after": H.Field.of("#m + p"),
        "simple": H.Field.of("p.x"),
        "none": H.Field.of("ul + div"),
        "none_text": H.Field.of("ul + div", "text"),
    }
    rows = H.read_fields(spark.createDataFrame([(1, page), (2, None), (3, "")], "id INT, html STRING"), "id", "html", fields).orderBy("id").collect()
    assert rows[0].asDict() == {
        "id": 1, "last": "twobold", "text": "two \nbold", "list": "ab", "after": "out", "simple": "twobold", "none": None, "none_text": "",
    }
    for row in rows[1:]:
        assert row["last"] is None and row["text"] == ""


def test_what_is_refused(spark):
    for text in ("", "a >", "> a", "a, ", "a:hover", "a >> b", "[a=", "a > + b", ".", "a[b=c d]"):
        with pytest.raises(ValueError):
            Path.of(text)
    df = spark.createDataFrame([(1, "<p>")], "id INT, html STRING")
    with pytest.raises(ValueError):
        H.native_fields(df, "id", "html", {"x": H.Field.of("a b")})
