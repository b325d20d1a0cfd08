import html as stdlib_html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.functions.text import capitalize, cut_before, decode_entities, split_at_patterns, strip
from regmill.operators import extract as X
from regmill.operators.frontier import code_list, last_page, pager
from regmill.operators import regions
from regmill.operators.regions import kind_regions, parse_scope, regions_of, scoped_regions
from regmill.rules import NAMED_ENTITIES, REGULATION_PATTERNS, UNICODE_SPACES, local_frame


def values(spark, fn, texts):
    rows = local_frame(spark, [(t,) for t in texts], "x string")
    return [r[0] for r in rows.select(fn(F.col("x"))).collect()]


def pages(spark, *markup):
    return local_frame(spark, list(enumerate(markup)), "id int, html string")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=UNICODE_SPACES + "ab", max_size=8), min_size=1, max_size=30))
def test_strip_equals_python(spark, texts):
    assert values(spark, strip, texts) == [t.strip() for t in texts]


def test_entities(spark):
    texts = [f"a&{n};b" for n, _ in NAMED_ENTITIES if n != "nbsp"] + ["&#65;&#8364;&#128512;", "&#x41;&#X20ac;", "&#00000000065;", "&unknown;&;x;", "&amp;lt;", "plain", "a & b", "&#;"]
    assert values(spark, decode_entities, texts) == [stdlib_html.unescape(t) for t in texts]
    assert values(spark, decode_entities, ["&#55296;|&#1114112;|&#x110000;", None]) == ["�|�|�", None]


def test_cut_capitalize_split(spark):
    assert values(spark, lambda c: cut_before(c, "Share This"), ["a Share This b", "none", None]) == ["a ", "none", None]
    with pytest.raises(ValueError):
        cut_before(F.lit("x"), "")
    assert values(spark, capitalize, ["rED notice", "x", ""]) == ["Red notice", "X", ""]
    texts = ["abc Part 1 30 CFR 2", "abc Part 1", "x and 30 y", "none", None]
    cut = values(spark, lambda c: F.concat_ws("|", *split_at_patterns(c, REGULATION_PATTERNS)), texts)
    assert cut == ["abc Part 1 |30 CFR 2", "abc |Part 1", "x |and 30 y", "", ""]


LINKS = """<script>x='<a href="/no">'</script><!-- <a href="/no2"> --><A class=z HREF='/one'>1</A>
<a href="/two?a=1&amp;b=2">2</a><a name=x>3</a><a href="">4</a><a data-href="/no3">5</a><a href=/bare>6</a>"""


def test_links_keep_document_order(spark):
    rows = X.extract_links(pages(spark, LINKS, "<p>none</p>", None)).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.href) for r in rows] == [(0, 0, "/one"), (0, 1, "/two?a=1&b=2"), (0, 3, "/bare")]


def test_paragraphs_unclosed_and_in_scripts(spark):
    page = '<article><script>"</p>"</script><p>One<p class="x">Two <b>bold</b></p><p><i>Three</i></p><p>Tail</article><footer>No</footer>'
    got = X.body_text(pages(spark, page), "leaves").first().body
    assert got == "OneThreeTail"
    assert X.body_text(pages(spark, page), "first").first().body == "One"
    lines = X.body_text(pages(spark, "<p> a http://x </p><p>b</p>"), "lines", "http").first().body
    assert lines == "a \nb\n"
    own = pages(spark, "<p>see http://s.example/1 x</p>").withColumn("own", F.lit("http://s.example/1"))
    assert X.body_text(own, "region", F.col("own")).first().body == "see "
    with pytest.raises(ValueError):
        X.body_text(pages(spark, "x"), "other")


TABLE = """<table><tbody><tr><td> a </td><td>b&amp;c</td></tr><tr></tr><tr><td><b>d</b></td></tr></tbody></table>
<table><tbody><tr><td>second</td></tr></tbody></table>"""


def test_table_rows_are_ragged(spark):
    rows = X.extract_table(pages(spark, TABLE)).orderBy("row_no").collect()
    assert [(r.row_no, r.cells) for r in rows] == [(0, ["a", "b&c"]), (1, []), (2, ["d"])]


def test_listing_kinds(spark):
    table = """<tbody><tr><td>03/02/2023</td><td><a href="/r1">T &amp; 1</a></td></tr><tr><td>x</td><td>no link</td></tr>
    <tr><td>1/2/2023</td><td><a href="/r2">T2</a></td></tr></tbody>"""
    rows = X.extract_listing(pages(spark, table), "table", "https://h.example").orderBy("pos").collect()
    assert [(r.pos, r.date, r.title, r.link) for r in rows] == [
        (0, "03/02/2023", "T & 1", "https://h.example/r1"),
        (2, "1/2/2023", "T2", "https://h.example/r2"),
    ]
    cards = "<ul><li><a href='/c1'> Card </a></li><li>plain</li></ul>"
    rows = X.extract_listing(pages(spark, cards), "cards", "https://h.example").collect()
    assert [(r.title, r.link) for r in rows] == [("Card", "https://h.example/c1")]


def test_ordinals_first_and_codes(spark):
    page = pages(spark, "<table>1</table><table>2</table><table>3</table>", "<p>none</p>")
    got = X.nth_region(page, "table", F.lit(-2)).orderBy("id").collect()
    assert [r.region for r in got] == ["2", None]
    select = '<select><option>all</option><option value="AF">a</option><option selected value="">e</option></select>'
    codes = code_list(pages(spark, select), "html").collect()
    assert [(c.pos, c.code) for c in codes] == [(0, "AF"), (1, "")]
    boxes = f'<!-- <option value="no"> --><select id="sex"><option value="F">f</option></select>{select.replace("<select", "<select class=x id=nat")}'
    one = code_list(pages(spark, boxes), "html", select="nat").collect()
    assert [c.code for c in one] == ["AF", ""] and code_list(pages(spark, boxes), "html", select="age").count() == 0
    dated = X.labelled_date(local_frame(spark, [("Date: March 3, 2010, x",), ("none",)], "t string"), "t")
    assert [r.date for r in dated.collect()] == [" March 3 2010", None]


NESTED = """<div class="view-content"><div class="x"><table><tbody><tr><td class="views-field views-field-title">
<a href="/a">a</a></td><td class="views-field">n</td></tr></tbody></table></div>tail</div>
<div class="view-content">second<br></div><div class="other view-content big">third</div><a href="/out">o</a>"""


def test_regions_nest(spark):
    assert regions_of(NESTED, ".view-content")[0].endswith("</div>tail")
    assert [r.strip() for r in regions_of(NESTED, "all .view-content")][1:] == ["second<br>", "third"]
    assert regions_of(NESTED, ".view-content[-1]") == ["third"] and regions_of(NESTED, "div[9]") == []
    assert regions_of(NESTED, ".view-content[2]") == ["second<br>"] and regions_of(NESTED, "div[-9]") == []
    with pytest.raises(ValueError):
        regions_of(NESTED, "div[x]")
    assert regions_of(NESTED, "div.view-content > tbody > .views-field views-field-title")[0].strip() == '<a href="/a">a</a>'
    assert regions_of(NESTED, ".missing") == []
    assert regions_of("<ul><li>a<li>b</ul>c", "all ul") == ["<li>a<li>b"]
    assert regions_of("<div class='a'>open", ".a") == ["open"]
    assert regions_of('<div title="1 > 2" class="a">x</div>', ".a") == ["x"]
    scoped = pages(spark, NESTED, NESTED, None).select(
        "id", "html", F.when(F.col("id") == 0, "all .view-content > all a").otherwise(F.lit(None)).alias("scope")
    )
    rows = scoped_regions(scoped.where("html is not null")).orderBy("id", "region_no").collect()
    assert [(r.id, r.region_no) for r in rows] == [(0, 0), (1, 0)]
    assert rows[0].region == "a" and rows[1].region == NESTED


def test_plain_text(spark):
    assert values(spark, H.plain, ["<b>a</b> &lt;i&gt;<br/>c", None]) == ["a <i>c", None]


def test_pager_items_of_any_length(spark):
    long = "<b>x</b>" * 20000
    page = f'<li>{long}</li><li class="page"> <i>12</i> </li>\n<li class="a next-page b"><a href="?p=2">n</a></li><a title="Go to last page" href="?p=11">l</a>'
    shown = last_page(pager(pages(spark, page, "<li>1</li>"), "shown"), "last", "shown").orderBy("id").collect()
    assert [r.n_pages for r in shown] == [12, None]
    wide = pages(spark, f'<li>{long}</li><li class="next-page">n</li>')
    assert len(pager(wide, "shown").first().last) == 20000
    titled = last_page(pager(pages(spark, page, "none"), "titled"), "last", "last_value").orderBy("id").collect()
    assert [r.n_pages for r in titled] == [12, None]


def test_unclosed_tags_take_linear_time():
    import time

    from regmill.operators.regions import regions_of

    page = "<div class='a'>" + "<p>text <b>x</b>" * 8000 + "</div>"
    start = time.perf_counter()
    (found,) = regions_of(page, "div.a")
    assert len(found) == 16 * 8000 and time.perf_counter() - start < 0.5


# --- the region step against a walk per step over the markup cut out so far ----


def inner_by_walk(markup: str, tag: str, classes: list[str], only_first: bool) -> list[str]:
    """Inner markup of matching elements; a closing tag also ends what was left open inside it."""
    spans: list[list[int]] = []
    open_tags: list[tuple[str, int]] = []
    n_open: dict[str, int] = {}
    for token in regions.TAG.finditer(markup):
        name = token[2].lower()
        if not token[1]:
            hit = -1
            if not (only_first and spans) and regions._is_match(name, token[3], tag, classes):
                hit = len(spans)
                spans.append([token.end(), -1])
            if name in regions.VOID or token[3].endswith("/"):
                if hit >= 0:
                    spans[hit][1] = token.end()
            else:
                open_tags.append((name, hit))
                n_open[name] = n_open.get(name, 0) + 1
        elif n_open.get(name):
            while True:
                t, hit = open_tags.pop()
                n_open[t] -= 1
                if hit >= 0:
                    spans[hit][1] = token.start()
                if t == name:
                    break
        if only_first and spans and spans[0][1] >= 0:
            break
    return [markup[a : b if b >= 0 else len(markup)] for a, b in spans]


def children_by_walk(markup: str) -> list[str]:
    """Elements and bare texts at the top of a piece of markup, in order; what is left open ends with it."""
    pieces: list[str] = []
    n_open: dict[str, int] = {}
    open_tags: list[str] = []
    start = 0

    def cut(end: int) -> None:
        nonlocal start
        if end > start:
            pieces.append(markup[start:end])
        start = end

    for token in regions.TAG.finditer(markup):
        name = token[2].lower()
        if not token[1]:
            if not open_tags:
                cut(token.start())
            if name not in regions.VOID and not token[3].endswith("/"):
                open_tags.append(name)
                n_open[name] = n_open.get(name, 0) + 1
            elif not open_tags:
                cut(token.end())
        elif n_open.get(name):
            while True:
                t = open_tags.pop()
                n_open[t] -= 1
                if t == name:
                    break
            if not open_tags:
                cut(token.end())
    cut(len(markup))
    return pieces


def select_by_walk(markup: str, ordinal: int | None, tag: str, classes: list[str]) -> list[str]:
    if tag == "*":
        return children_by_walk(markup)
    hits = inner_by_walk(markup, tag, classes, ordinal == 1)
    if ordinal is None:
        return hits
    at = ordinal - 1 if ordinal > 0 else len(hits) + ordinal
    return hits[at : at + 1] if at >= 0 else []


def regions_by_walks(markup: str, scope: str) -> list[str]:
    found = [markup]
    for step in parse_scope(scope):
        found = [inner for piece in found for inner in select_by_walk(piece, *step)]
    return found


PIECES = ["<div>", "</div>", '<div class="a b">', "<div class=a>", "<td>", "</td>", "<td/>", "<br>", "<p>", "</p>", "x", " ", "<", "<a 'q>", "</i>", "<DIV CLASS='b'>"]
SCOPES = [
    "div", "all div", "div[2]", "div[-1]", "div[-2]", "div[0]", "*", "div > *", "all * > all div", "td > *", ".a", "all .a", "all div.a b", "div > all td",
    "all div > all div", "td[-3] > *", "* > div[2] > *", ".b[-1] > p",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25), st.sampled_from(SCOPES))
def test_one_walk_equals_a_walk_per_step(parts, scope):
    markup = "".join(parts)
    assert regions_of(markup, scope) == regions_by_walks(markup, scope)


def test_kinds_of_regions_come_from_one_walk(spark):
    page = "<!-- <div>no</div> --><div class=a><td>1</td><td>2</td></div>tail"
    asked = [("list", "div.a > all td"), ("text", None), ("none", "div.zz"), ("all", "")]
    rows = [(0, page, asked), (1, "", asked), (2, None, asked), (3, page, []), (4, page, None)]
    found = kind_regions(local_frame(spark, rows, "id int, html string, scopes array<struct<kind string, scope string>>"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    clean = page[page.index("-->") + 3 :]
    want = [(0, "all", 0, clean), (0, "list", 0, "1"), (0, "list", 1, "2"), (0, "text", 0, clean), (1, "all", 0, ""), (1, "text", 0, "")]
    assert sorted(map(tuple, found.select("id", "kind", "region_no", "region").collect())) == want


def test_the_walk_ends_with_the_elements_asked_for():
    """Steps that count from the start need no tags behind their last element; others need the whole page."""
    page = '<div class="a"><p>1</p></div><p>2</p><div class="a"><p>3</p></div>' + "<p>x</p>" * 50
    read = lambda *scopes: len(regions.Elements(page, [parse_scope(s)[0] for s in scopes]).starts)
    assert read("div.a") == 2 and read("div.a", "p[2]") == 3 and read("div.a[2] > p") == 5
    assert {read(s) for s in ("all div", "div[-1]", "*", "div[3]")} == {55}
    assert regions_of(page, "div.a[2] > p") == ["3"] and regions_of("<div><p>1", "div > p") == ["1"]
