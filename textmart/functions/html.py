"""Fields of HTML pages.

Two paths read the same `Selector`s:

* `native_fields` is column expressions over regular markup: a selected element
  has its own end tag, holds no element of the same name and no stray end tag;
* `parse_fields` walks the tags with the standard library's parser in Arrow
  batches, for any markup.

`read_fields` sends each page down the first path if it is regular and down the
second if not, so it is exact for both. Selectors with combinators (`selectors.Path`) are
read by the second path alone.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmart.functions.literals import let, string_map
from textmart.functions.selectors import Frame, Path
from textmart.functions.text import STRIP_CHARS, strip

# The parser goes to the Python workers with the query, so they need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_IN_TAG = r"""(?:[^>"']+|"[^"]*"|'[^']*')*+"""
_TAG = rf"<[a-zA-Z/!?]{_IN_TAG}>"
# Markup whose content is no text of the page.
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_MARK = "<!>"


# A compound that the native path reads: tag, classes, attributes equal to a value.
_SIMPLE = re.compile(r"""(\w*)((?:\.[\w-]+)*)((?:\[[\w-]+=(?:"[^"\]]*"|'[^'\]]*'|[^\s\]"']*)\])*)""")


@dataclass(frozen=True)
class Selector:
    """One compound selector: tag, classes and attribute values."""

    tag: str
    classes: tuple[str, ...]
    attrs: tuple[tuple[str, str], ...]

    @staticmethod
    def of(text: str) -> Selector:
        m = _SIMPLE.fullmatch(text)
        if m is None:
            raise ValueError(f"not a compound selector: {text!r}")
        attrs = re.findall(r"\[([\w-]+)=['\"]?([^\]'\"]*)['\"]?\]", m.group(3))
        return Selector(m.group(1), tuple(re.findall(r"[\w-]+", m.group(2))), tuple(attrs))

    def start_tag(self) -> str:
        """Regex of the start tag; its first group is the tag name.

        Names are compared without case, values with it.
        """
        checks = "".join(
            rf"""(?=[^>]*\s(?i:class)\s*=\s*["'](?:[^"'>]*\s)?{re.escape(c)}[\s"'])"""
            for c in self.classes
        ) + "".join(
            rf"""(?=[^>]*\s(?i:{re.escape(k)})\s*=\s*["']{re.escape(v)}["'])"""
            for k, v in self.attrs
        )
        return rf"<((?i:{self.tag or '[a-z][a-z0-9]*'}))(?=[\s/>]){checks}{_IN_TAG}>"

    def matches(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return (
            self.tag in ("", tag)
            and set(self.classes) <= set((attrs.get("class") or "").split())
            and all(attrs.get(k) == v for k, v in self.attrs)
        )


@dataclass(frozen=True)
class Field:
    """Where a value stands: selector, and how to read the element.

    how: 'text' (text nodes one per line, '' if absent), 'strip' (trimmed text
    nodes without separator, NULL if absent) or 'attr:<name>'.
    """

    selector: Selector | Path
    how: str = "strip"

    @staticmethod
    def of(selector: str, how: str = "strip") -> Field:
        simple = _SIMPLE.fullmatch(selector)
        return Field(Selector.of(selector) if simple else Path.of(selector), how)


# --- native path -------------------------------------------------------------


def visible_markup(html: Column) -> Column:
    """Comments, scripts and styles replaced by a mark that still parts text nodes."""
    return F.regexp_replace(html, _HIDDEN, _MARK)


def decode_entities(text: Column) -> Column:
    """Character references, each decoded once.

    Named ones may lack the semicolon where HTML allows it and no letter or digit
    follows ("&amp" at the end of a cut text); numeric ones must have it.
    """
    common = ["amp;", "quot;", "lt;", "gt;", "nbsp;"]
    names = common + [n for n in html5 if n not in common]
    table = string_map({f"&{n}": html5[n] for n in names})
    pieces = F.regexp_extract_all(text, F.lit(r"(&#?[0-9a-zA-Z]+;?|[^&]+|&)"), F.lit(1))

    def numeric(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        base_16 = piece.rlike("^&#[xX]")
        code = F.when(base_16, F.conv(digits, 16, 16)).otherwise(F.conv(digits, 10, 16))
        known = code.rlike("^(?:[1-9A-F][0-9A-F]{0,2}|(?!D[89A-F])[1-9A-F][0-9A-F]{3}"
                           "|[1-9A-F][0-9A-F]{4}|10[0-9A-F]{4})$")  # fmt: skip
        char = F.when(
            known, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        ).otherwise("�")
        return F.when(piece.rlike("^&#(?:[0-9]+|[xX][0-9a-fA-F]+);$"), char).otherwise(piece)

    def decode(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("&"), piece)
            .when(piece.startswith("&#"), numeric(piece))
            .otherwise(F.coalesce(F.try_element_at(table, piece), piece))
        )

    return F.array_join(F.transform(pieces, decode), "")


def _text_nodes(inner: Column) -> Column:
    """Text between tags, not yet decoded."""
    return F.filter(F.split(inner, f"(?:{_TAG})+"), lambda n: n != "")


def _collapsed(node: Column) -> Column:
    """A node of whitespace alone becomes one newline or one blank."""
    return F.when(
        node.rlike(r"^[ \t\n\r\f\x0B]+$"),
        F.when(F.contains(node, F.lit("\n")), "\n").otherwise(" "),
    ).otherwise(node)


def _element(markup: Column, selector: Selector) -> Column:
    """The first match with its tags, NULL if there is none."""
    return F.regexp_substr(markup, F.lit(rf"(?s){selector.start_tag()}.*?</(?i:\1)\s*>"))


def _inner(element: Column) -> Column:
    return F.regexp_extract(element, rf"(?s)^<{_IN_TAG}>(.*)</[^<]*$", 1)


def _attribute(markup: Column, field: Field) -> Column:
    tag = F.regexp_substr(markup, F.lit(f"(?s){field.selector.start_tag()}"))
    name = re.escape(field.how.removeprefix("attr:"))
    quoted = rf"""(?s)\s(?i:{name})\s*=\s*(["'])(.*?)\1"""
    return let(tag, lambda t: F.when(t.rlike(quoted), F.regexp_extract(t, quoted, 2)))


def _is_attribute(field: Field) -> bool:
    return field.how.startswith("attr:")


def _source(markup: Column, field: Field) -> Column:
    """What a field is read from: the markup of its element, or the raw attribute."""
    return _attribute(markup, field) if _is_attribute(field) else _element(markup, field.selector)


def _decoded(sources: list[Column], fields: list[Field]) -> Column:
    """Decoded text nodes of all fields, one array each; an attribute is one node.

    One expression for all fields, since the decoder is by far the largest part of
    the plan.
    """
    nodes = [
        F.when(s.isNotNull(), F.array(s)) if _is_attribute(f) else _text_nodes(_inner(s))
        for s, f in zip(sources, fields)
    ]
    return F.transform(F.array(*nodes), lambda of_field: F.transform(of_field, decode_entities))


def _value(nodes: Column, field: Field) -> Column:
    if _is_attribute(field):
        return F.get(nodes, F.lit(0))
    if field.how == "text":
        lines = F.array_join(F.transform(nodes, _collapsed), "\n")
        return F.coalesce(strip(lines), F.lit(""))
    return F.array_join(F.transform(nodes, strip), "")


def native_fields(df: DataFrame, key: str, html: str, fields: dict[str, Field]) -> DataFrame:
    """(key, one STRING per field) by column expressions, for regular markup and simple selectors."""
    if any(isinstance(f.selector, Path) for f in fields.values()):
        raise ValueError("selectors with combinators are read by parse_fields or read_fields")
    markup = df.select(key, visible_markup(F.col(html)).alias("_markup"))
    specs = list(fields.values())
    sources = [_source(F.col("_markup"), f) for f in specs]
    nodes = markup.select(key, _decoded(sources, specs).alias("_nodes"))
    return nodes.select(
        key,
        *[_value(F.get("_nodes", F.lit(i)), f).alias(n) for i, (n, f) in enumerate(fields.items())],
    )


# --- which pages are regular ---------------------------------------------------

# Names of elements without content.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Markup in the visible part that the native path does not read as a parser does:
# elements of other text rules, hidden ones left open, declarations, attributes
# without quotes or with a ">" inside. Patterns start with one character, which
# the regex engine looks for before it tries any alternative.
_ODD_MARKUP = (
    r"<(?:(?i:textarea|xmp|iframe|noembed|noframes|plaintext|pre|rt|rp)\b"
    r"|/?(?i:script|style|template)\b|!(?!>|(?i:doctype))|\?"
    r"""|[a-zA-Z][^<>]*=\s*(?:"[^"<]*>|'[^'<]*>|(?<=\s(?i:ATTRIBUTES)\s{0,9}=\s{0,9})[^\s"']))"""
)
# References that a parser decodes and `decode_entities` does not: those without a
# semicolon, zero, and the range read as Windows characters.
_ODD_REFERENCE = (
    r"&(?:#?[0-9a-zA-Z]+(?![0-9a-zA-Z;])|#[xX]?0*(?![0-9a-fA-F])"
    r"|#0*(?:12[89]|1[3-5][0-9]);|#[xX]0*[89][0-9a-fA-F];)"
)


def _open_after(inner: Column) -> Column:
    """Names of the elements still open at the end, innermost first, as '|b|p|'.

    NULL if an end tag closes nothing inside, as it may close something outside.
    """
    tags = F.regexp_extract_all(
        F.lower(inner), F.lit(r"<(/?[a-z][a-z0-9]*)(?=[\s/>])(?![^<>]*/>)"), F.lit(1)
    )
    names = F.filter(tags, lambda t: ~F.ltrim(t, F.lit("/")).isin(*sorted(_VOID)))

    def step(path: Column, tag: Column) -> Column:
        name = F.concat(F.lit("|"), F.ltrim(tag, F.lit("/")), F.lit("|"))
        at = F.instr(path, name)
        closed = F.when(at > 0, F.substr(path, at + F.length(name) - 1))
        return F.when(tag.startswith("/"), closed).otherwise(
            F.concat(F.lit("|"), tag, path)
        )

    return F.aggregate(names, F.lit("|"), step)


def _is_regular(markup: Column, source: Column, field: Field) -> Column:
    # References are looked for only where there can be one.
    if _is_attribute(field):
        return F.coalesce(~(F.contains(source, F.lit("&")) & source.rlike(_ODD_REFERENCE)), F.lit(True))
    name = F.concat(F.lit("|"), F.lower(F.regexp_extract(source, "^<([a-zA-Z0-9]+)", 1)), F.lit("|"))
    text = F.array_join(F.split(_inner(source), f"(?:{_TAG})+"), " ")
    plain = F.when(F.contains(source, F.lit("&")), ~text.rlike(_ODD_REFERENCE)).otherwise(True)
    whole = (F.instr(_open_after(_inner(source)), name) == 0) & plain
    absent = ~markup.rlike(field.selector.start_tag())
    return F.coalesce(F.when(source.isNull(), absent).otherwise(whole), F.lit(False))


def read_fields(df: DataFrame, key: str, html: str, fields: dict[str, Field]) -> DataFrame:
    """(key, one STRING per field) for any markup: native where the page is regular.

    Both paths are one pass. Only the pages that are not regular are handed to the
    Python workers; of the others they get a NULL, and the values stay in the JVM.
    A selector with combinators needs the parser on all pages, which then reads all fields.
    """
    if any(isinstance(f.selector, Path) for f in fields.values()):
        return parse_fields(df, key, html, fields)
    used = {"class"} | {k for f in fields.values() for k, _ in f.selector.attrs}
    used |= {f.how.removeprefix("attr:") for f in fields.values() if _is_attribute(f)}
    odd = _ODD_MARKUP.replace("ATTRIBUTES", "|".join(map(re.escape, sorted(used))))
    m = F.col("_markup")
    read = df.select(key, html, visible_markup(F.col(html)).alias("_markup")).select(
        key, html, "_markup", *[_source(m, f).alias(f"_s_{n}") for n, f in fields.items()]
    )
    regular = F.coalesce(~m.rlike(odd), F.lit(True))
    for name, field in fields.items():
        regular = regular & _is_regular(m, F.col(f"_s_{name}"), field)
    judged = read.select(
        key,
        F.when(~regular, F.col(html)).alias("_odd"),
        _decoded([F.col(f"_s_{n}") for n in fields], list(fields.values())).alias("_nodes"),
    )
    parsed = judged.withColumn("_parsed", _page_reader(fields)(F.col("_odd")))
    native = F.col("_odd").isNull()
    return parsed.select(
        key,
        *[
            F.when(native, _value(F.get("_nodes", F.lit(i)), f))
            .otherwise(F.col(f"_parsed.{n}"))
            .alias(n)
            for i, (n, f) in enumerate(fields.items())
        ],
    )


def extract_ids(html: Column, pattern: str) -> Column:
    """All ids of a result page, in page order, duplicates kept."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


# --- any markup --------------------------------------------------------------

_NO_TEXT = frozenset("script style template rt rp".split())


class _FieldReader(HTMLParser):
    """Collects the text nodes of the first element each selector selects."""

    def __init__(self, fields: list[Field]):
        super().__init__(convert_charrefs=True)
        self.fields = fields
        self.open: list[str] = []
        # For each selector with combinators, the frames of the open elements below one for all.
        self.frames = {i: [Frame()] for i, f in enumerate(fields) if isinstance(f.selector, Path)}
        self.buffer: list[str] = []
        self.nodes: list[list[str] | None] = [None] * len(fields)
        self.attrs: list[str | None] = [None] * len(fields)
        self.depth: list[int] = [0] * len(fields)

    def handle_starttag(self, tag, attrs):
        self.flush()
        given = dict(attrs)
        if tag not in _VOID:
            self.open.append(tag)
        for i, field in enumerate(self.fields):
            if self.nodes[i] is None and self.selected(i, field.selector, tag, given):
                self.nodes[i] = []
                self.depth[i] = 0 if tag in _VOID else len(self.open)
                if field.how.startswith("attr:"):
                    self.attrs[i] = given.get(field.how.removeprefix("attr:"))

    def selected(self, i: int, selector: Selector | Path, tag: str, attrs: dict[str, str | None]) -> bool:
        if isinstance(selector, Selector):
            return selector.matches(tag, attrs)
        parent = self.frames[i][-1]
        own = selector.state(tag, attrs, parent)
        if tag not in _VOID:
            self.frames[i].append(Frame(own, parent.inside | own))
        return own & selector.ends != 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            for frames in self.frames.values():
                del frames[len(self.open) + 1 :]
            for i, depth in enumerate(self.depth):
                if depth > len(self.open):
                    self.depth[i] = 0

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def flush(self):
        text = "".join(self.buffer)
        self.buffer.clear()
        if not text or not any(self.depth) or not _NO_TEXT.isdisjoint(self.open):
            return
        if not text.strip(" \t\n\r\f\x0b") and not {"pre", "textarea"} & set(self.open):
            text = "\n" if "\n" in text else " "
        for i, depth in enumerate(self.depth):
            if depth:
                self.nodes[i].append(text)

    def values(self, html: str) -> list[str | None]:
        self.feed(html)
        self.close()
        self.flush()
        return [self._value(i) for i in range(len(self.fields))]

    def _value(self, i: int) -> str | None:
        how, nodes = self.fields[i].how, self.nodes[i]
        if how == "text":
            return "\n".join(nodes or []).strip(STRIP_CHARS)
        if how == "strip":
            return None if nodes is None else "".join(n.strip(STRIP_CHARS) for n in nodes)
        return self.attrs[i]


def _page_reader(fields: dict[str, Field]):
    """Pandas UDF: page -> one struct of fields; NULL pages give NULL fields."""
    names, specs = list(fields), list(fields.values())
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    @F.pandas_udf(schema)
    def read(pages: pd.Series) -> pd.DataFrame:
        absent = [None] * len(specs)
        rows = [absent if p is None else _FieldReader(specs).values(p) for p in pages]
        return pd.DataFrame(rows, columns=names, dtype=object)

    return read


def parse_fields(
    df: DataFrame, key: str, html: str, fields: dict[str, Field]
) -> DataFrame:
    """(key, one STRING per field) for any markup, in one pass over each page."""
    page = F.coalesce(F.col(html), F.lit(""))
    parsed = df.select(key, _page_reader(fields)(page).alias("_parsed"))
    return parsed.select(key, *[F.col(f"_parsed.{n}") for n in fields])
