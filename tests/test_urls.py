from urllib.parse import unquote, urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill.functions import urls as U
from regmill.rules import local_frame

BASES = [
    "https://www.agency.example",
    "https://www.agency.example/",
    "https://www.agency.example/a/b.html",
    "http://host.example:8080/a/b/?x=1#top",
    "https://host.example/a//b/c",
]
HREFS = [
    "", "/x", "/x.", "x.pdf", "d/x.pdf?y=1", "?q=1", "#f", "//other.example/z", "https://other.example/p",
    "../k", "./m", "../../../k", "/a/../b", "/a/./b/", "c/..", "c/.", ".", "..", "/..", "a/../../b#frag",
    "mailto:x@y.example", "/path/file.PDF", "x//y", "/x//y", "c/../d?u=../v",
]


def column(spark, fn, values, *names):
    rows = local_frame(spark, values, ", ".join(f"{n} string" for n in names))
    return [r[0] for r in rows.select(fn(*[F.col(n) for n in names])).collect()]


def test_resolve_equals_urljoin(spark):
    cases = [(b, h) for b in BASES for h in HREFS]
    got = column(spark, U.resolve, cases, "base", "href")
    want = [urljoin(b, h) for b, h in cases]
    bad = [(c, g, w) for c, g, w in zip(cases, got, want) if g != w]
    assert not bad


segment = st.text(alphabet="abc.%20", min_size=0, max_size=4)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(segment, min_size=1, max_size=5).map("/".join).filter(lambda p: not p.startswith("//")), min_size=1, max_size=40))
def test_resolve_relative_paths(spark, paths):
    cases = [("https://host.example/p/q/r.html", p) for p in paths]
    assert column(spark, U.resolve, cases, "base", "href") == [urljoin(b, h) for b, h in cases]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab+%2054é/zZ", max_size=12), min_size=1, max_size=40))
def test_double_decode_equals_unquote(spark, names):
    got = column(spark, U.twice_decoded, [(n,) for n in names], "x")
    want = [unquote(unquote(n)) for n in names]
    # bytes that are no UTF-8 become replacement characters in both, their number may differ
    assert [g for g, w in zip(got, want) if "�" not in w] == [w for w in want if "�" not in w]


def test_file_names(spark):
    cases = [
        ("/a/My%2520File.pdf", "base", "My File.pdf"),
        ("/a/x+y.pdf", "base", "x+y.pdf"),
        ("/a/bad%zz.pdf", "base", "bad%zz.pdf"),
        ("/a/x.pdf?sfvrsn=1", "noq", "x.pdf"),
        ("/file/123/download", "dl", "123.pdf"),
        ("/file/report.pdf/download?inline", "dl", "report.pdf"),
        ("/media/9321/download?inline", "media", "9321.pdf"),
        ("/sys_attachment.do?sys_id=ab12", "id", "ab12.pdf"),
    ]
    got = column(spark, U.file_name, [c[:2] for c in cases], "link", "rule")
    assert got == [c[2] for c in cases]
    always = column(spark, lambda a, b: U.file_name(a, b, True), [("/f/r.pdf/download", "dl")], "link", "rule")
    assert always == ["r.pdf.pdf"]


def test_site_folder_stem_and_base(spark):
    assert column(spark, lambda u: U.site_folder(u, " admin"), [("https://WWW.sec.example:81/x",)], "u") == [
        "WWW_sec_example:81 admin"
    ]
    stems = column(spark, U.stem, [("/a/lr123.htm",), ("/a/b",), ("/a/x.y.z",), ("/a/.rc",)], "u")
    assert stems == ["lr123", "b", "x.y", ".rc"]
    pairs = [("https://h.example/x", "https://h.example"), ("/x", "https://h.example")]
    assert column(spark, U.without_base, pairs, "href", "base") == ["/x", "/x"]
    named = [(None, "x.pdf"), ("lr1", "x.pdf")]
    assert column(spark, U.with_stem, named, "p", "n") == ["x.pdf", "lr1 x.pdf"]
