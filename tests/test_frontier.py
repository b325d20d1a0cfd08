import itertools
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill import rules
from regmill.operators import frontier as O
from regmill.operators.quota import quota_remainder, quota_split, unknown_sex_leaf
from regmill.rules import local_frame


def test_site_years(spark):
    years = O.expand_years(rules.site_years(spark), 2024).groupBy("site").agg(
        F.min("year").alias("lo"), F.max("year").alias("hi"), F.count("*").alias("n")
    )
    got = {r.site: (r.lo, r.hi, r.n) for r in years.collect()}
    assert got["dol"] == (2009, 2024, 16)
    assert got["litigation"] == (1995, 2023, 29)
    assert got["bsee"] == (1997, 2011, 15)
    empty = O.expand_years(local_frame(spark, [("x", 2030, 0)], rules.SITE_YEAR_SCHEMA), 2024)
    assert empty.count() == 0


def test_year_rules(spark):
    years = O.expand_years(rules.site_years(spark), 2024).select("site", "year")
    got = {(r.site, r.year): r for r in O.apply_year_rules(years, rules.year_rules(spark)).collect()}
    assert got["litigation", 2015].scope == "table[-2]" and got["litigation", 2016].scope == "table[-1]"
    assert got["litigation", 2019].template.endswith("litarchive2019.shtml")
    assert got["litigation", 2020].template.endswith("litarchive2020.htm")
    assert ("bsee", 2009) not in got
    assert got["bsee", 1997].template.endswith("4th-quarter-of-1997-civil-penalties")
    assert got["onrr_pdf", 2017].template == "/document/Penalty.Collections.pdf"
    assert got["onrr", 2023].template == "/document/2023_Penalties.pdf"
    assert got["treasury", 2008].scope is None and got["treasury", 2009].scope == "table"
    assert (got["admin", 2009].text_scope, got["enforce", 2009].text_scope) == ("tr[-3] > *", "tr[-2] > *")
    assert all(("fcc", y) not in got for y in range(2002, 2025))


def test_cross_frontier(spark):
    base = local_frame(spark, [("https://www.nrc.gov/",)], "root string")
    got = O.cross_frontier(base, category=rules.NRC_CATEGORIES, letter=O.letters())
    letters = [chr(c) for c in range(97, 123)]
    assert sorted((r.category, r.letter) for r in got.collect()) == sorted(itertools.product(rules.NRC_CATEGORIES, letters))


def test_page_counts(spark):
    captions = [("Showing 1 to 100 of 1,234 entries", 13), ("1 to 5 of 100 entries", 1), ("of 101 entries", 2), ("none", None)]
    frame = local_frame(spark, [(c,) for c, _ in captions], "c string")
    assert [r.n_pages for r in O.page_count(frame, "c", 100).collect()] == [n for _, n in captions]
    hrefs = local_frame(spark, [("?page=7",), ("?a=1&page=9",), ("x",)], "h string")
    assert [r.n_pages for r in O.last_page(hrefs, "h", "first_value").collect()] == [8, None, None]
    assert [r.n_pages for r in O.last_page(hrefs, "h", "last_value").collect()] == [8, 10, None]
    shown = local_frame(spark, [(" 12 ",), ("next",)], "h string")
    assert [r.n_pages for r in O.last_page(shown, "h", "shown").collect()] == [12, None]


@pytest.mark.parametrize("n, start, want", [(3, 0, [0, 1, 2]), (0, 0, []), (3, 2, [2, 3]), (1, 2, []), (2, 2, [2])])
def test_expand_pages(spark, n, start, want):
    pages = O.expand_pages(local_frame(spark, [(n,)], "n bigint"), "n", start)
    assert [r.page for r in pages.orderBy("page").collect()] == want


def test_progress(spark):
    frame = local_frame(spark, [("1 - 20 of 45",), ("41 - 45 of 45",), ("junk",)], "c string")
    assert [(r.reached, r.total, r.done) for r in O.progress(frame, "c").collect()] == [
        (20, 45, False), (45, 45, True), (None, None, None),
    ]


def test_bands(spark):
    ages = local_frame(spark, [(a,) for a in (20, 21, 50, 51, 60, 61, 101, None)], "age int")
    queried = O.band(ages, "age", rules.age_bands(spark, rules.AGE_BANDS_AS_QUERIED)).collect()
    assert Counter(r.age for r in queried) == {20: 1, 21: 1, 51: 1, 60: 2, 61: 1}
    whole = O.band(ages, "age", rules.age_bands(spark)).collect()
    assert Counter(r.age for r in whole) == {20: 1, 21: 1, 50: 1, 51: 1, 60: 1, 61: 1}


def leaves_by_loop(people, bands, quota):
    out = Counter()
    for country in {p[0] for p in people}:
        held = [p for p in people if p[0] == country]
        if len(held) <= quota:
            out[country, None, None, None, None] = len(held)
            continue
        for sex in ("F", "M"):
            of_sex = [p for p in held if p[1] == sex]
            if not of_sex:
                continue
            if len(of_sex) <= quota:
                out[country, sex, None, None, None] = len(of_sex)
                continue
            for lo, hi, splits in bands:
                of_age = [p for p in of_sex if p[2] is not None and lo <= p[2] <= hi]
                if splits and len(of_age) > quota:
                    for p in of_age:
                        if p[3] is not None:
                            out[country, sex, lo, hi, p[3]] += 1
                elif of_age:
                    out[country, sex, lo, hi, None] = len(of_age)
    return dict(out)


PEOPLE = st.lists(
    st.tuples(
        st.sampled_from(["AA", "AA", "BB", "CC"]),
        st.sampled_from(["F", "M", "M", "U", None]),
        st.one_of(st.none(), st.sampled_from([20, 21, 21, 50, 51, 60, 61])),
        st.sampled_from(["US", "FR", None]),
    ),
    max_size=80,
)


@settings(max_examples=12, deadline=None)
@given(PEOPLE, st.integers(1, 9), st.sampled_from([rules.AGE_BANDS, rules.AGE_BANDS_AS_QUERIED]))
def test_quota_split(spark, people, quota, bands):
    frame = local_frame(spark, people, "country string, sex string, age int, warrant string")
    got = quota_split(frame, rules.age_bands(spark, bands), quota, rules.SEXES).collect()
    assert {tuple(r)[:5]: r.n for r in got} == leaves_by_loop(people, bands, quota)
    assert len(got) == len({tuple(r)[:5] for r in got})
    assert all(r.overflow == (r.n > quota) for r in got)
    rest = quota_remainder(frame, rules.age_bands(spark, bands), quota, rules.SEXES).collect()
    if bands is rules.AGE_BANDS:
        assert sum(r.n for r in got) + sum(r.n for r in rest) == len(people)


def test_filters_of_a_hot_country_do_not_meet(spark):
    people = [("AA", "FM"[i % 2], 20 + i % 40, "US") for i in range(400)]
    frame = local_frame(spark, people, "country string, sex string, age int, warrant string")
    plan = quota_split(frame, rules.age_bands(spark), 5, rules.SEXES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    # every shuffled step is keyed by a whole filter
    assert "Aggregate [country" in plan and "age_hi" in plan.split("Join", 2)[1].splitlines()[0]


def test_exactly_the_quota_is_not_split(spark):
    people = [("AA", "M", 30, "US")] * rules.NOTICE_QUOTA
    frame = local_frame(spark, people, "country string, sex string, age int, warrant string")
    assert [r.n for r in quota_split(frame, rules.age_bands(spark), rules.NOTICE_QUOTA, rules.SEXES).collect()] == [160]
    one_more = frame.unionByName(frame.limit(1))
    leaf = quota_split(one_more, rules.age_bands(spark), rules.NOTICE_QUOTA, rules.SEXES).collect()
    assert [(r.sex, r.age_lo, r.warrant, r.n, r.overflow) for r in leaf] == [("M", 30, "US", 161, True)]
    unknown = frame.withColumn("sex", F.lit("U"))
    assert [tuple(r) for r in unknown_sex_leaf(unknown, 160).collect()] == [("U", 160, True)]
    assert [tuple(r) for r in unknown_sex_leaf(unknown, 161).collect()] == [("U", 160, False)]


def test_open_rules_have_no_last_year_and_rejects_come_back(spark):
    rule = local_frame(spark, [("a", 2000, None, "x/{year}")], "site string, year_lo int, year_hi int, template string")
    years = local_frame(spark, [("a", 1999), ("a", 2101), ("a", 9999), ("b", 2001)], "site string, year int")
    assert [(r.year, r.template) for r in O.apply_year_rules(years, rule).orderBy("year").collect()] == [
        (2101, "x/2101"),
        (9999, "x/9999"),
    ]
    assert sorted(map(tuple, O.without_rule(years, rule).collect())) == [("a", 1999), ("b", 2001)]
