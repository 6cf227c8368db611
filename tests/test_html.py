import random

from pyspark.sql import functions as F

from textmart import rules as R
from textmart.functions import html as H
from textmart.plans.extract import POSTING, page_fields

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>.show-more-less-html__markup{}</style></head><body>
<!-- <h2 class="top-card-layout__title topcard__title">no</h2> -->
<script>var x = '<h2 class="top-card-layout__title topcard__title">no</h2>';</script>
<h2 class="other topcard__title  top-card-layout__title" data-x="a>b"> Engenheiro <b>de</b> Dados &amp; BI </h2>
<img data-ghost-classes="artdeco-entity-image--ghost" alt="{alt}" src="x">
<a class="topcard__org-name-link" href="/c"> Link &lt;Org&gt; </a>
<span class="topcard__flavor topcard__flavor--bullet">
   São Paulo, SP </span>
<div class="show-more-less-html__markup x">
  <p>Spark<b>SQL</b> &#233; b&#xE1;sico &amp;lt; &nbsp;fim</p>
  <ul><li>Py<i>thon</i></li><li>remoto</li></ul>
  <script>hidden()</script>caf<!-- c -->e<br><br/>&nbsp;
</div><div class="show-more-less-html__markup">second</div></body></html>"""

FIELDS = {
    "title": H.Field.of(R.TITLE_SELECTORS[0]),
    "alt": H.Field.of(R.COMPANY_IMAGE, "attr:alt"),
    "org": H.Field.of(R.COMPANY_LINK),
    "city": H.Field.of(R.CITY_SELECTOR),
    "body": H.Field.of(R.BODY_SELECTOR, "text"),
    "none": H.Field.of("div.absent"),
    "none_text": H.Field.of("div.absent", "text"),
}
BODY = "Spark\nSQL\n é básico &lt; \xa0fim\n\n\n\nPy\nthon\nremoto\n\n\n\ncaf\ne"


def frame(spark, *pages):
    return spark.createDataFrame([(str(i), p) for i, p in enumerate(pages)], "id STRING, html STRING")


def native(df):
    return H.native_fields(df, "id", "html", FIELDS)


def parsed(df):
    return H.parse_fields(df, "id", "html", FIELDS)


def checked(df):
    return H.read_fields(df, "id", "html", FIELDS)


def ordered(df):
    return [r.asDict() for r in df.orderBy("id").collect()]


def test_both_paths_on_a_posting(spark):
    df = frame(spark, PAGE.replace("{alt}", " Acme &amp; Co "), "<p>nothing</p>", "")
    for out in (native(df), parsed(df), checked(df)):
        full, nothing, empty = ordered(out)
        assert full["title"] == "EngenheirodeDados & BI"
        assert full["alt"] == " Acme & Co "
        assert full["org"] == "Link <Org>"
        assert full["city"] == "São Paulo, SP"
        assert full["none"] is None and full["none_text"] == ""
        assert [w.strip() for w in full["body"].split("\n") if w.strip()] == [
            w.strip() for w in BODY.split("\n") if w.strip()
        ]
        for row in (nothing, empty):
            assert row["title"] is None and row["body"] == ""
    assert ordered(native(df)) == ordered(parsed(df)) == ordered(checked(df))


def test_company_falls_back_to_the_link(spark):
    pages = [PAGE.replace("{alt}", a) for a in (" Acme ", "", "  ")]
    pages.append(pages[0].replace("<img", "<pic"))
    df = frame(spark, *pages)
    for path in ("native", "parser", "checked"):
        rows = page_fields(df, POSTING, "id", "html", path).orderBy("id").collect()
        assert [r["company"] for r in rows] == ["Acme", "Link <Org>", "Link <Org>", "Link <Org>"]
        assert {r["title"] for r in rows} == {"EngenheirodeDados & BI"}


ODD = [
    ('<div class="a">x<div>y</div>z</div>w', "x\ny\nz"),
    ('<div class="a">x<p>y', "x\ny"),
    ('<div class="a">x</span>y</div>', "x\ny"),
    ('<section><div class="a">x<b>y</section>z</div>', "x\ny"),
    ('<div class="a"></div><div class="a">late</div>', ""),
    ('<div class="a">x<template>t</template><style>s</style> y</div>', "x\n y"),
    ('<div class="a">a &lt b &copy; c</div>', "a < b © c"),
    ("<div class=a>x</div>", "x"),
    ('<div data-x="a>b" class="a">x</div>', "x"),
    ('<DIV CLASS="b a">x<BR/>y<b/>z</DIV>', "x\ny\nz"),
    ('<div class="A">x</div><div class="a">y</div>', "y"),
    ('<div class="a">x<pre>  </pre>y</div>', "x\n  \ny"),
    ('<div class="a">x<ruby>k<rt>r</rt></ruby></div>', "x\nk"),
    ('<div class="a">x<b>y</b></b>z</div>', "x\ny\nz"),
    ('<b><div class="a">x</b>y</div>', "x"),
    ('<!-- <div class="a">no</div> --><div class="a">yes</div>', "yes"),
    ('<div class="a">x <i> </i>\n<i>\n</i> y</div>', "x \n \n\n\n\n\n y"),
    ('<div class="a">&#128; &#0; &#xD800; &#xE9;</div>', "€ \ufffd \ufffd é"),
    ('<div class="a">R&D a&b=c</div>', "R&D a&b=c"),
    ('<div class="a">x<b>&#32; </b>y</div>', "x\n \ny"),
    ('<div class="a"><b>cut &amp</b> &ampx &lt</div>', "cut &\n &x <"),
    ('<div class="aa">x</div>', ""),
    ('<p class="x"><span class="a">s</span></p>', ""),
    (None, ""),
]


def test_any_markup(spark):
    fields = {"t": H.Field.of("div.a", "text"), "s": H.Field.of("div.a"), "c": H.Field.of(".a")}
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(ODD)], "id INT, html STRING")
    parsed = H.parse_fields(df, "id", "html", fields).orderBy("id").collect()
    assert [r["t"] for r in parsed] == [t for _, t in ODD]
    assert H.read_fields(df, "id", "html", fields).orderBy("id").collect() == parsed
    assert parsed[22]["c"] == "s" and parsed[21]["s"] is None and parsed[0]["s"] == "xyz"


def test_checked_path_equals_parser_on_random_markup(spark):
    rng = random.Random(11)
    pieces = ["<div>", "</div>", '<div class="a">', "<b>", "</b>", "<p>", "</p>", "<br>", "<br/>", "text", " ",
              "\n", "&amp;", "&lt", "&#233;", "<i/>", '<a href="x?a=1&b=2">', "</a>", "<!-- c -->", "<script>s<b></script>",
              '<span class="a b" title="q">', "</span>", "x < y", "<ul>", "<li>", "</ul>", "&nbsp;", "é"]
    pages = ["".join(rng.choices(pieces, k=rng.randrange(3, 25))) for _ in range(1500)]
    fields = {
        "t": H.Field.of("div.a", "text"),
        "s": H.Field.of("span.a"),
        "any": H.Field.of(".a", "text"),
        "title": H.Field.of("span.b", "attr:title"),
    }
    df = spark.createDataFrame(list(enumerate(pages)), "id INT, html STRING").repartition(8)
    want = {r["id"]: r for r in H.parse_fields(df, "id", "html", fields).collect()}
    got = {r["id"]: r for r in H.read_fields(df, "id", "html", fields).collect()}
    wrong = [(pages[i], want[i], got[i]) for i in want if want[i] != got[i]]
    assert not wrong, wrong[:3]


def test_decode_entities_once(rows):
    values = ["cut &amp", "&amp;amp", "&copy 2", "&ampx;", "&amp;lt;", "&lt;&gt;&quot;&#39;&apos;", "&#x1F600;&#233;", "&nope; & x", "", None]
    want = ["cut &", "&amp", "© 2", "&ampx;", "&lt;", "<>\"''", "\U0001f600é", "&nope; & x", "", None]
    assert rows(values, H.decode_entities) == want


def test_extract_ids_keeps_duplicates_in_order(rows):
    page = "".join(f'<a data-entity-urn="urn:li:jobPosting:{i}">' for i in (5, 3, 5)) + "jobPosting:9"
    assert rows([page, ""], lambda c: H.extract_ids(c, R.ID_PATTERN)) == [["5", "3", "5"], []]
    assert rows(["x"], lambda c: F.size(H.extract_ids(c, R.ID_PATTERN))) == [0]
