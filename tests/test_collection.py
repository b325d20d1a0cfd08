"""Site rules on invented pages of each shape, and the archive flow."""

from pyspark.sql import functions as F

from regmill import rules
from regmill.operators.ordered import since_mark
from regmill.plans import collection, releases
from regmill.plans.catalog import derived
from regmill.rules import local_frame

PAGES = "site string, year int, seq bigint, url string, html string"
DOC = 'class="document--set file--attachment field field--name-field-document field--type-file field--label-hidden clearfix field__item"'
TITLE = 'class="views-field views-field-title"'
LISTED = [
    ("faa", 2020, 1, "u1", '<a href="https://www.faa.gov/a/x.pdf">1</a><a href="/a/y.pdf">2</a><a href="/a/z.PDF">3</a>'),
    ("ferc_table", 2020, 2, "u2",
     '<a href="/out.pdf"></a><div class="col content__body--main"><div class="table--responsive"><table><tbody>'
     '<tr><td><a href="/in.pdf">i</a></td></tr></tbody><tbody><tr><td><a href="/second.pdf">s</a></td></tr></tbody></table></div></div>'),
    ("ferc_audit", 2020, 3, "u3",
     '<div class="toggle__content toggle__content--show"><a href="/1">a</a></div><div class="toggle__content"><a href="/no">n</a></div>'
     '<div class="toggle__content toggle__content--show"><a href="/2">b</a></div>'),
    ("cms_manufacturer", 2020, 4, "u4",
     '<div class="view-content"><table><tbody><tr><td><a href="/d1">a</a></td></tr></tbody><tbody><tr><td><a href="/d2">b</a></td></tr></tbody></table></div>'),
    ("cms_manufacturer", None, None, "https://www.cms.gov/d1", '<a href="/f/one.pdf">1</a><a href="/f/one.txt">t</a>'),
    ("cms_manufacturer", None, None, "https://www.cms.gov/d2", '<a href="https://www.cms.gov/f/two%2520b.pdf">2</a>'),
    ("cms_part_c_d_list", 2020, 5, "u5", '<li class="field__item"><a href="/l1.pdf">1</a><a href="/skip.pdf">2</a></li><li><a href="/no.pdf">n</a></li>'),
    ("fincen", 2020, 6, "u6",
     f'<div class="view-content"><table><tbody><tr><td {TITLE}><a href="/fc/1">1</a><a href="/fc/no">n</a></td></tr>'
     f'<tr><td {TITLE}><a href="/fc/2.pdf">2</a></td></tr></tbody><tbody><tr><td {TITLE}><a href="/fc/late">l</a></td></tr></tbody></table></div>'),
    ("transportation", 2020, 7, "u7",
     f'<div class="table-responsive"><table><tbody><tr><td {TITLE}><a href="/order/1">1</a></td></tr></tbody>'
     f'<tbody><tr><td {TITLE}><a href="/order/2">2</a></td></tr></tbody></table></div>'),
    ("transportation", None, None, "https://www.transportation.gov/order/1", f'<div {DOC}><a href="/t/o1.pdf">1</a><a href="/t/no.pdf">n</a></div>'),
    ("pmddtc", 2020, 8, "u8", '<a href="/sys_attachment.do?sys_id=ab12">1</a><a href="/other?id=9">2</a>'),
    ("declinations", 2020, 9, "u9", '<a href="/file/77/download">1</a><a href="/file/77/download?inline">2</a>'),
    ("declinations", 2020, 10, "u10", '<a href="/other/77/download">same name, later</a>'),
]


def files_to_fetch(spark, pages, manifest):
    return collection.site_files_to_fetch(
        pages, rules.site_rules(spark), rules.year_rules(spark), rules.denied_links(spark), manifest
    )


def test_places_and_rules_of_sites(spark):
    """Categories and years part files only where the site keeps folders for them; denied endings, old pages."""
    media = "https://ofac.treasury.gov/media/{}/download?inline"
    pages = local_frame(
        spark,
        [
            ("nrc", "reactors", 2020, 1, "u1", '<a href="/d/doc1.pdf">1</a><a href="/d/held.pdf">h</a>'),
            ("nrc", "materials", 2020, 2, "u2", '<a href="/m/doc1.pdf">1</a><a href="/m/held.pdf">h</a>'),
            ("ams", None, 2019, 3, "u3", '<a href="/r/same.pdf">s</a>'),
            ("ams", None, 2020, 4, "u4", '<a href="/r/same.pdf">s</a>'),
            ("treasury", None, 2005, 5, "u5", f'<a href="{media.format(1)}">out</a><table></table>'),
            ("treasury", None, 2015, 6, "u6", f'<a href="{media.format(2)}">out</a><table><tr><td><a href="{media.format(3)}">in</a></td></tr></table>'),
            ("treasury", None, 2016, 7, "u7", f'<table><tr><td><a href="{media.format(3)}">other year</a></td></tr></table>'),
            ("bsee", None, 2017, 8, "u8", '<a href="/x/cp-matrix-522.pdf">denied</a><a href="/x/kept.pdf">k</a>'),
        ],
        "site string, category string, year int, seq bigint, url string, html string",
    )
    manifest = local_frame(
        spark, [("www_nrc_gov", "reactors", None, "held.pdf")], "folder string, category string, year int, file_name string"
    )
    rows = {(r.site, r.category, r.year, r.file_name, r.seq) for r in files_to_fetch(spark, pages, manifest).collect()}
    assert rows == {
        ("nrc", "reactors", None, "doc1.pdf", 1), ("nrc", "materials", None, "doc1.pdf", 2),
        ("nrc", "materials", None, "held.pdf", 2), ("ams", None, None, "same.pdf", 3),
        ("treasury", None, 2005, "1.pdf", 5), ("treasury", None, 2015, "3.pdf", 6), ("treasury", None, 2016, "3.pdf", 7),
        ("bsee", None, None, "kept.pdf", 8),
    }


def test_every_site_shape(spark):
    manifest = local_frame(spark, [("www_faa_gov", None, "y.pdf")], "folder string, year int, file_name string")
    got = files_to_fetch(spark, local_frame(spark, LISTED, PAGES), manifest)
    assert sorted((r.site, r.folder, r.file_name, r.seq) for r in got.collect()) == sorted([
        ("faa", "www_faa_gov", "x.pdf", 1),
        ("ferc_table", "www_ferc_gov", "in.pdf", 2),
        ("ferc_audit", "www_ferc_gov_Audits", "1", 3),
        ("ferc_audit", "www_ferc_gov_Audits", "2", 3),
        ("cms_manufacturer", "www_cms_govManufacturer", "one.pdf", 4),
        ("cms_manufacturer", "www_cms_govManufacturer", "two b.pdf", 4),
        ("cms_part_c_d_list", "www_cms_govPart_C_D", "l1.pdf", 5),
        ("fincen", "www_fincen_gov", "1", 6),
        ("fincen", "www_fincen_gov", "2.pdf", 6),
        ("transportation", "www_transportation_gov", "o1.pdf", 7),
        ("pmddtc", "www_pmddtc_state_gov", "ab12.pdf", 8),
        ("declinations", "www_justice_gov_declinations", "77.pdf", 9),
    ])


ARCHIVE = [
    ("litigation", 2014, 1, "a1",
     '<table><tr><td><a href="/early.pdf">no page before</a><a href="/litigation/litreleases/2014/lr1.htm">1</a></td></tr></table>'
     '<table><tr><td><a href="/litigation/litreleases/out.htm">last table is not read before 2016</a></td></tr></table>'),
    ("litigation", 2016, 2, "a2",
     '<table><tr><td><a href="/x.pdf">other table</a></td></tr></table><table><tr><td><a href="https://www.sec.gov/c/comp1.pdf">c</a>'
     '<a href="/litigation/litreleases/2016/lr2.htm">2</a><a href="/c/comp2.pdf">c2</a><a href="/n/a%2520b.txt">t</a></td></tr></table>'),
    ("admin", 2021, 3, "a3", '<a href="/litigation/admin/adminarchive/adminarc2020.htm">denied</a><a href="/litigation/admin/2021/34-1.htm">k</a>'),
]


def test_archive_flow_and_texts(spark):
    pages = local_frame(spark, ARCHIVE, PAGES)
    manifest = local_frame(spark, [("www_sec_gov litigation", 2016, "a b.txt"), ("www_sec_gov litigation", 2016, "lr2.txt")],
                           "folder string, year int, file_name string")
    targets = collection.targets_to_fetch(
        pages, rules.routed_sites(spark), rules.year_rules(spark), rules.denied_links(spark), manifest
    )
    rows = sorted((r.site, r.year, r.route, r.file_name) for r in targets.collect())
    assert rows == [
        ("admin", 2021, "page_text", "34-1.txt"),
        ("litigation", 2014, "page_text", "lr1.txt"),
        ("litigation", 2014, "pdf_relative", "early.pdf"),
        ("litigation", 2016, "page_text", "lr2.txt"),
        ("litigation", 2016, "pdf_absolute", "lr1 comp1.pdf"),
        ("litigation", 2016, "pdf_relative", "lr2 comp2.pdf"),
    ]
    linked = local_frame(
        spark,
        [("litigation", 2014, None, "https://www.sec.gov/litigation/litreleases/2014/lr1.htm",
          "<table><tr><td>1</td><td> text http://www.sec.gov/litigation/litreleases/2014/lr1.htm end</td><td>3</td><td>4</td></tr></table>"),
         ("admin", 2021, None, "https://www.sec.gov/litigation/admin/2021/34-1.htm", '<div class="grid_10 push_2"> In <b>re</b> </div>')],
        PAGES,
    )
    texts = collection.page_texts(targets, linked, rules.year_rules(spark), rules.routed_sites(spark)).collect()
    assert sorted((r.site, r.file_name, r.text) for r in texts) == [
        ("admin", "34-1.txt", "In\nre\n\n"), ("litigation", "lr1.txt", "text \n"),
    ]


def test_page_texts_line_per_child(spark):
    """Each child of the chosen element is a line cut on its own; the last crawl of a page and the last page of a file win."""
    root = "https://www.sec.gov"
    children = '<p>first</p><p>see {0}://other.example/x</p><p>at http://www.sec.gov/{1} end</p>last <br>tail'
    targets = local_frame(
        spark,
        [(s, 2021, 1, 0, k, "page_text", s, f"{n}.txt", f"{root}/{u}") for s, k, n, u in (
            ("litigation", 1, "a", "l1"), ("admin", 2, "b", "a1"), ("admin", 3, "c", "c1"), ("admin", 4, "c", "c2"), ("admin", 5, "c", "gone"))],
        "site string, year int, seq bigint, region_no bigint, pos int, route string, folder string, file_name string, target string",
    )
    box = '<div class="grid_10 push_2">{}</div>'
    pages = local_frame(
        spark,
        [
            ("litigation", 2021, 1, f"{root}/l1", box.format(children.format("http", "l1"))),
            ("admin", 2021, 1, f"{root}/a1", box.format("old")),
            ("admin", 2021, 2, f"{root}/a1", box.format(children.format("http", "a1"))),
            ("admin", 2021, 1, f"{root}/c1", box.format("<b>one</b>")),
            ("admin", 2021, 1, f"{root}/c2", box.format("<b>two</b>")),
        ],
        PAGES,
    )
    texts = collection.page_texts(targets, pages, rules.year_rules(spark), rules.routed_sites(spark)).collect()
    assert {(r.site, r.file_name): r.text for r in texts} == {
        ("litigation", "a.txt"): "first\nsee \nat \nlast\n\ntail\n",
        ("admin", "b.txt"): "first\nsee http://other.example/x\nat \nlast\n\ntail\n",
        ("admin", "c.txt"): "two\n",
    }


def test_release_listing_spans_pages(spark):
    rule = rules.RELEASE_RULES["hhs"]
    card = '<ul class="usa-card-group padding-y-0"><li><a href="/{0}">T{0}</a></li><li><a href="/{0}b">T{0}b</a></li></ul>'
    pages = local_frame(spark, [(2, card.format("c")), (1, card.format("a"))], "seq bigint, html string")
    listing = releases.release_listing(pages, rule)
    assert [r.title for r in listing.orderBy("pos").collect()] == ["Ta", "Tab", "Tc", "Tcb"]
    marks = local_frame(spark, [("hhs", "Tc")], "source string, mark string")
    fresh = since_mark(listing, marks, ["source"], "title", "pos")
    assert sorted(r.title for r in fresh.collect()) == ["Ta", "Tab"]
    missing = releases.release_details(local_frame(spark, [("u", "<p>no article</p>")], "url string, html string"), rule)
    assert missing.where(F.col("message_body").isNotNull()).count() == 0


def test_rule_driven_files_read_and_parse_pages_once(spark, tmp_path, monkeypatch):
    local_frame(spark, LISTED, PAGES).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    kept, real = [], collection.written

    def held(df, label):
        kept.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(collection, "written", held)
    files = collection.site_files(pages, rules.site_rules(spark), rules.year_rules(spark), rules.denied_links(spark))
    (plan,) = kept
    # an adaptive plan shows its first form only
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan parquet") == 1
    assert "ArrowEvalPython" not in files._jdf.queryExecution().executedPlan().toString()
    assert files.where("name_rule is null").count() == 0 and files.count() > 0


def test_marked_listing_is_parsed_once(spark):
    """The mark is looked for in rows that were written, so pages are not parsed again to cut at it."""
    read = spark.sparkContext.accumulator(0)

    def page(n):
        read.add(1)
        return f'<table><tbody><tr><td>1/2/2020</td><td><a href="/r{n}">t{n}</a></td></tr></tbody></table>'

    listing = spark.range(6).select(F.col("id").alias("seq"), F.udf(page, "string")("id").alias("html"))
    rule = rules.RELEASE_RULES["fda"]._replace(root="https://x", listing_scope=None, detail_scope=None, body="first")
    details = local_frame(spark, [(f"https://x/r{n}", f"<p>b{n}</p>") for n in range(6)], "url string, html string")
    marks = local_frame(spark, [(rule.source, "t4")], "source string, mark string")
    documents, _ = releases.release_documents(listing, details, rule, "ab" * 32, marks)
    assert sorted(r.message_title for r in documents.collect()) == ["t0", "t1", "t2", "t3"]
    assert read.value == 6


def test_pages_are_dealt_out_over_all_cores(spark, tmp_path):
    """A table in few splits still gives every core pages to parse."""
    orders = "1L AS o_orderkey", "1L AS o_custkey", "'F' AS o_orderstatus", "'2-HIGH' AS o_orderpriority", "DATE'1995-01-02' AS o_orderdate"
    spark.range(1).selectExpr(*orders).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    for made in (derived.archived_texts, derived.order_pages, derived.card_pages):
        assert made(spark, str(tmp_path)).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
