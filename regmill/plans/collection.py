"""Document collection: pages to the files still to be fetched, and page texts.

Pages are rows (site, year, seq, url, html) and, where a site lists by category, category; `seq` is the
crawl order. What differs between sites comes from rule tables, so one job serves them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.functions import urls as U
from regmill.functions.text import cut_before, strip
from regmill.operators import links as L
from regmill.operators.extract import extract_links
from regmill.operators.frontier import apply_year_rules, year_scope
from regmill.operators.ordered import forward_fill
from regmill.operators.regions import kind_regions, page_regions, scoped_regions
from regmill.operators.scale import first_by
from regmill.session import written

PLACE = ["folder", "category", "year", "file_name"]
ORDER = ["seq", "region_no", "pos"]


def scoped_links(pages: DataFrame) -> DataFrame:
    """Links of each page inside the regions its `scope` column selects; without a scope, of the whole page."""
    return extract_links(scoped_regions(pages), "region", clean=True)


def _not_held(named: DataFrame, manifest: DataFrame) -> DataFrame:
    """First target of each place that the manifest lacks; page texts always stay, as they are rewritten."""
    rewritten = F.col("route") == "page_text"
    placed = named.withColumns(
        {
            "_visit": F.when(rewritten, F.concat_ws(":", *ORDER)),
            "_held": F.when(~rewritten, F.col("file_name")),
        }
    )
    fresh = first_by(placed, ["folder", "year", "_visit", "_held"], [F.col(c) for c in ORDER])
    held = manifest.select("folder", "year", F.col("file_name").alias("_held")).distinct()
    return fresh.join(held, ["folder", "year", "_held"], "left_anti").drop("_visit", "_held")


# --- sites that list documents, directly or one page further ------------------


def _with_category(df: DataFrame) -> DataFrame:
    return df if "category" in df.columns else df.withColumn("category", F.lit(None).cast("string"))


def _allowed(links: DataFrame, denied: DataFrame) -> DataFrame:
    """Links that neither an exact address nor an ending of their site's list denies; the lists are rule rows."""
    exact = L.deny_links(links, denied.where(F.col("kind") == "exact"), ["site"])
    endings = denied.where(F.col("kind") == "ending").groupBy("site").agg(F.collect_set("value").alias("_denied"))
    marked = exact.join(endings, "site", "left")
    ends = F.exists("_denied", lambda e: F.endswith(F.col("href"), e))
    return marked.where(~F.coalesce(ends, F.lit(False))).drop("_denied")


def site_files(pages: DataFrame, rules: DataFrame, year_rules: DataFrame, denied: DataFrame) -> DataFrame:
    """Document links of all sites under their rules, named and placed.

    A year rule of a site stands above the site's region of listing links. `year` is that of the file's folder, null
    for sites without folders per year; `category` is null where pages have none.

    Pages are read once: a page gives the links of its listing region and, where its site is followed one step
    further, those of its detail region. They are written once and then read for the one-step and the two-step sites;
    the second step joins narrow link rows, one per target of a site and year.
    """
    ruled = year_scope(_with_category(pages).join(rules, "site"), year_rules)
    constants = ["site", "category", "root", "name_rule", "label", "by_year"]
    listing = F.struct(F.lit("listing").alias("kind"), "scope")
    detail = F.struct(F.lit("detail").alias("kind"), F.nullif("detail_scope", F.lit("")).alias("scope"))
    scopes = F.array_compact(F.array(listing, F.when(F.col("detail_scope").isNotNull(), detail)))
    choices = ["first_only", "beginnings", "endings", "detail_scope", "detail_first_only"]
    asked = ruled.select(*constants, "year", "seq", "url", "html", *choices, scopes.alias("scopes"))
    links = extract_links(kind_regions(asked), "region", clean=True)
    listed = F.col("kind") == "listing"
    first = F.when(listed, F.col("first_only")).otherwise(F.col("detail_first_only"))
    begins, ends = (L.one_of(F.col("href"), **{k: F.col(k)}) for k in ("beginnings", "endings"))
    wanted = links.where((~first | (F.col("pos") == 0)) & F.when(listed, begins).otherwise(ends))
    held = written(_allowed(wanted, denied), "site-links")

    begun = held.where(listed)
    direct = begun.where(F.col("detail_scope").isNull() & ends)
    hops = begun.where(F.col("detail_scope").isNotNull())
    hops = hops.withColumn("url", U.resolve(F.col("root"), F.col("href")))
    hops = first_by(hops, ["site", "category", "year", "url"], [F.col(c) for c in ORDER]).drop("href")

    found = held.where(~listed)
    found = found.select("site", "url", "href", F.col("region_no").alias("_region"), F.col("pos").alias("_pos"))

    columns = [*constants, "year", *ORDER, "href", "_region", "_pos"]
    nothing = F.lit(0)
    both = direct.withColumns({"_region": nothing.cast("bigint"), "_pos": nothing}).select(*columns)
    both = both.unionByName(hops.join(found, ["site", "url"]).select(*columns))
    target = U.resolve(F.col("root"), U.without_base(F.col("href"), F.col("root")))
    return both.withColumn("target", target).withColumns(
        {
            "file_name": U.file_name(F.col("target"), F.col("name_rule")),
            "folder": U.site_folder(F.col("root"), F.col("label")),
            "year": F.when(F.col("by_year"), F.col("year")),
        }
    )


def site_files_to_fetch(
    pages: DataFrame, rules: DataFrame, year_rules: DataFrame, denied: DataFrame, manifest: DataFrame
) -> DataFrame:
    """The same without what is held (folder, year, file_name, maybe category); the first target of a place wins."""
    files = site_files(pages, rules, year_rules, denied)
    return L.not_held(files, _with_category(manifest), PLACE, [*ORDER, "_region", "_pos"])


# --- sites whose archives link page texts, text files and PDFs ----------------


def routed_links(pages: DataFrame, sites: DataFrame, year_rules: DataFrame, denied: DataFrame) -> DataFrame:
    """Links of archive pages with route and target; the region of the links depends on site and year."""
    ruled = apply_year_rules(pages, year_rules).drop("template", "text_scope")
    links = scoped_links(ruled.drop("url")).join(sites, "site")
    allowed = L.deny_links(links, denied.where(F.col("kind") == "exact"), ["site"])
    routed = L.route_links(allowed, F.col("root"), F.col("page_prefix"))
    return L.resolve_links(routed, F.col("root"))


def named_targets(routed: DataFrame) -> DataFrame:
    """Folder and file name of each target; a PDF carries the stem of the page before it."""
    stem = F.when(F.col("route") == "page_text", U.stem(F.col("target")))
    parents = forward_fill(routed.withColumn("_stem", stem), "_stem", ["site"], ORDER, "parent").drop("_stem")
    plain = U.file_name(F.col("target"), F.lit("base"))
    name = (
        F.when(F.col("route") == "page_text", F.concat("parent", F.lit(".txt")))
        .when(F.col("route") == "text_file", plain)
        .otherwise(U.with_stem(F.col("parent"), plain))
    )
    return parents.withColumns({"file_name": name, "folder": U.site_folder(F.col("root"), F.col("label"))})


def targets_to_fetch(
    pages: DataFrame, sites: DataFrame, year_rules: DataFrame, denied: DataFrame, manifest: DataFrame
) -> DataFrame:
    """Files that are not held, first of each place, and every page text.

    Links are written once, so that markup is parsed once and the ordered steps run over the
    narrow link table.
    """
    links = written(routed_links(pages, sites, year_rules, denied), "links")
    return _not_held(named_targets(links), manifest)


def page_texts(targets: DataFrame, pages: DataFrame, year_rules: DataFrame, sites: DataFrame) -> DataFrame:
    """Texts of linked pages: one trimmed line per region, cut at the site's marker or the page's own address.

    `pages` are the linked pages (site, year, url, html and, where pages are read again, seq). The last
    crawl of a page counts, and of the pages that share a file the last one listed, as each write replaces
    the one before. Texts are made before the join, so that the join does not move markup.
    """
    crawl = F.coalesce("seq", F.lit(-1)) if "seq" in pages.columns else F.lit(-1)
    pages = pages.select("site", "year", "url", crawl.cast("bigint").alias("_crawl"), "html")
    ruled = apply_year_rules(pages, year_rules).drop("template", "scope").join(sites.select("site", "marker"), "site")
    scopes = F.array(F.struct(F.lit("text").alias("kind"), F.col("text_scope").alias("scope")))
    regions = page_regions(ruled.withColumn("scopes", scopes)).where(F.size("regions") > 0)
    cut = F.coalesce("marker", F.regexp_replace("url", "^https://", "http://"))
    lines = F.transform("regions", lambda r: F.concat(cut_before(strip(H.plain(r["region"])), cut), F.lit("\n")))
    page = ["site", "year", "url"]
    texts = regions.select(*page, "_crawl", F.array_join(lines, "").alias("text"))
    texts = texts.groupBy(*page).agg(F.max_by("text", F.struct("_crawl", "text")).alias("text"))
    wanted = targets.where(F.col("route") == "page_text")
    wanted = wanted.select("site", "year", "folder", "file_name", F.col("target").alias("url"), *ORDER)
    there = wanted.join(pages.select(*page).distinct(), page, "left_semi")
    last = first_by(there, ["folder", "year", "file_name"], [F.col(c).desc() for c in ORDER])
    return last.drop(*ORDER).join(texts, page)
