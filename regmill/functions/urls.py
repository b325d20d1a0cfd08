"""URL expressions: resolution, file naming, site folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
DOT_SEGMENT = r"(^|/)\.{1,2}(/|$)"


def origin(url: Column) -> Column:
    return F.regexp_extract(url, ORIGIN, 1)


def netloc(url: Column) -> Column:
    """Host with its port and case kept."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def _fold(path: Column, drop_empty: bool) -> Column:
    """Remove dot segments; only paths that hold one pay for the array work."""
    parts = F.split(path, "/")
    if drop_empty:
        last = F.size(parts) - 1
        parts = F.filter(parts, lambda s, i: (s != "") | (i == 0) | (i == last))

    def step(kept: Column, seg: Column) -> Column:
        up = F.when(F.size(kept) > 0, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(seg == "..", up).when(seg == ".", kept).otherwise(F.concat(kept, F.array(seg)))

    folded = F.aggregate(parts, F.lit([]).cast("array<string>"), step)
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    joined = F.array_join(F.when(ends_in_dots, F.concat(folded, F.array(F.lit("")))).otherwise(folded), "/")
    rooted = F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(DOT_SEGMENT) | (F.contains(path, F.lit("//")) if drop_empty else F.lit(False)), rooted).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page `base` (RFC 3986 reference resolution)."""
    root = origin(base)
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(href == "", base)
        .when(href.rlike(SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, SCHEME, 0), href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(F.startswith(href, F.lit("?")), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, _fold(href_path, False), tail))
        .otherwise(F.concat(root, _fold(F.concat(folder, href_path), True), tail))
    )


def without_base(href: Column, base: Column) -> Column:
    """An on-site absolute link loses the site root; others stay as they are."""
    return F.when(F.startswith(href, base), F.substring(href, F.length(base) + 1, F.length(href))).otherwise(href)


def basename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def stem(url: Column) -> Column:
    """File name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(basename(url), r"(?<=[^.])\.[^.]*$", "")


def percent_decode(c: Column) -> Column:
    """One round of percent decoding: '+' stays, escapes that are not hexadecimal stay."""
    safe = F.replace(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(c, F.lit("%")), F.coalesce(F.try_url_decode(safe), c)).otherwise(c)


def twice_decoded(c: Column) -> Column:
    return percent_decode(percent_decode(c))


def _with_pdf(name: Column, always: bool) -> Column:
    added = F.concat(name, F.lit(".pdf"))
    return added if always else F.when(F.endswith(name, F.lit(".pdf")), name).otherwise(added)


def file_name(link: Column, rule: Column, always_suffix: bool = False) -> Column:
    """Name under which a target is kept; `rule` is base, noq, dl, media or id."""
    no_query = F.substring_index(link, "?", 1)
    before_download = F.substring_index(link, "/download", 1)
    media = F.try_element_at(F.split(F.substring_index(link, "/download?inline", 1), "/media/"), F.lit(2))
    return (
        F.when(rule == "base", twice_decoded(basename(link)))
        .when(rule == "noq", twice_decoded(basename(no_query)))
        .when(rule == "dl", _with_pdf(twice_decoded(basename(before_download)), always_suffix))
        .when(rule == "media", F.concat(media, F.lit(".pdf")))
        .when(rule == "id", F.concat(F.substring_index(link, "id=", -1), F.lit(".pdf")))
    )


def with_stem(parent: Column, name: Column) -> Column:
    """Name prefixed by the stem of the page it belongs to, when there is one."""
    return F.when(parent.isNull(), name).otherwise(F.concat(parent, F.lit(" "), name))


def site_folder(url: Column, label: Column | str = "") -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    return F.concat(F.replace(netloc(url), F.lit("."), F.lit("_")), label)


def any_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))
