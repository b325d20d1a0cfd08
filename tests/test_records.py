import hashlib
import hmac

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill import rules, schemas
from regmill.functions.identity import keyed_id
from regmill.operators import records as R
from regmill.plans import notices, penalties
from regmill.plans.releases import keyed_documents
from regmill.rules import local_frame
from regmill.sources.readers import decode_json

KEY = "00ff10" * 8


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=90), min_size=1, max_size=20), st.sampled_from([KEY, "ab" * 64, "cd" * 100]))
def test_ids_equal_hmac(spark, messages, key):
    got = local_frame(spark, [(m,) for m in messages], "m string").select(keyed_id(F.col("m"), key)).collect()
    want = [hmac.new(bytes.fromhex(key), m.encode(), hashlib.sha256).hexdigest().upper() for m in messages]
    assert [r[0] for r in got] == want


def test_message_has_eight_fields_in_order(spark):
    fields = [f for f in rules.DOCUMENT_FIELDS if f not in rules.ID_EXCLUDES]
    assert fields == [
        "message_title", "message_body", "doc_source_type", "doc_source", "doc_source_url", "doc_source_pdf_url",
        "time_master", "time_document",
    ]
    assert [f.name for f in schemas.DOCUMENT] == rules.DOCUMENT_FIELDS
    row = tuple(f"<{f}>" for f in fields)
    missing = row[:1] + (None,) + row[2:]
    frame = local_frame(spark, [row, missing], ", ".join(f"{f} string" for f in fields))
    messages = R.canonical_message(frame).collect()
    assert [m.message for m in messages] == ["".join(row), None]
    good, bad = keyed_documents(frame, KEY)
    assert good.count() == 1 and [r.reason for r in bad.collect()] == ["no release page"]
    last = local_frame(spark, [row[:-1] + (None,)], ", ".join(f"{f} string" for f in fields))
    assert [r.reason for r in keyed_documents(last, KEY)[1].collect()] == ["field missing"]
    stamped = R.stamp(good).select("time_collected", "time_uploaded").first()
    assert stamped.time_collected == stamped.time_uploaded


def test_dates(spark):
    texts = ["March 3, 2010", "march 03, 2010", "03/02/2023", "3/2/2023", "March 3 2010", "March 2010", "(February 10 2011", "junk", None]
    frame = R.repair_dates(local_frame(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", rules.date_fixes(spark))

    def parsed(fmt):
        return [r.d for r in R.normalize_dates(frame, "t", fmt, "d").orderBy("i").collect()]

    day = "2010-03-03T00:00:00"
    assert parsed("month_day_comma_year") == [day, day] + [None] * 7
    assert parsed("month_day_slash_year") == [None, None, "2023-03-02T00:00:00", "2023-03-02T00:00:00"] + [None] * 5
    assert parsed("month_day_year") == [None] * 4 + [day, "2010-03-25T00:00:00", "2011-02-10T00:00:00", None, None]
    births = ["1980/05/03", "1980/5/3", "1980", "1980/05", "1980/02/30", None]
    got = R.normalize_dob(local_frame(spark, [(b,) for b in births], "date_of_birth string")).collect()
    assert [r.entity_dob for r in got] == ["1980-05-03T00:00:00.000Z"] * 2 + ["1980-01-01T00:00:00.000Z"] + [None] * 3


def test_dates_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        frame = local_frame(spark, [("October 15, 2017",)], "t string")  # midnight did not exist there
        assert R.normalize_dates(frame, "t", "month_day_comma_year", "d").first().d == "2017-10-15T00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_amounts(spark):
    texts = ["$1,234.50", "1,000", "n/a", "", None, "9" * 30]
    got = R.parse_amount(local_frame(spark, [(t,) for t in texts], "t string"), "t", "v").collect()
    assert [r.v for r in got] == [123450, 1000, None, None, None, None]


def test_merge_lets_right_nulls_win(spark):
    left = local_frame(spark, [("k1", "a", "l"), ("k2", "b", "l")], "k string, name string, only_left string")
    right = local_frame(spark, [("k1", None, "r")], "k string, name string, only_right string")
    rows = R.merge_right(left, right, "k").collect()
    assert [(r.k, r.name, r.only_left, r.only_right) for r in rows] == [("k1", None, "l", "r")]


RESPONSE = """{"total": 4, "query": {"resultPerPage": 160}, "_embedded": {"notices": [
 {"entity_id": "1/1", "name": "A", "date_of_birth": "1980", "_links": {"self": {"href": "/1"}, "thumbnail": {"href": "/t1"}}},
 {"entity_id": "1/2", "name": "B", "_links": {"self": {"href": "/2"}}},
 {"entity_id": "1/3", "name": "C", "_links": {"thumbnail": {"href": "/t3"}}},
 {"entity_id": "1/4", "name": "D", "_links": {"self": {"href": "/4"}}}]}}"""
DETAILS = [
    ("/1", """{"entity_id": "1/1", "name": null, "forename": "F", "date_of_birth": "1980/05/03", "height": 1.8,
     "hairs_id": ["BRO", "BLA"], "languages_spoken_ids": ["ENG"], "nationalities": ["US"],
     "arrest_warrants": [{"charge": "c1", "issuing_country_id": "US"}, {"charge": "c2"}]}"""),
    ("/2", """{"entity_id": "1/2", "name": "B", "date_of_birth": "1980/05", "arrest_warrants": [{"charge": "c"}]}"""),
    ("/4", """{"entity_id": "1/4", "name": "D", "date_of_birth": "1970", "arrest_warrants": []}"""),
]


def notice_inputs(spark):
    responses = decode_json(local_frame(spark, [(RESPONSE,)], "r string"), "r", schemas.NOTICE_RESPONSE)
    details = decode_json(local_frame(spark, DETAILS, "detail_url string, r string"), "r", schemas.NOTICE_DETAIL)
    return responses, details.select("detail_url", "body.*")


def test_red_and_yellow_notices(spark):
    documents, rejects = notices.notice_documents(*notice_inputs(spark), "red", KEY)
    (row,) = documents.collect()
    assert (row.entity_id, row.entity_last_name, row.relationship_details) == ("1/1", None, "c1")
    assert row.entity_notes == "Physical description: height: 1.8; hair_colour: BLA; languages_spoken: ENG;"
    assert row.entity_profile_image_url == "/t1" and row.doc_source_type == "Red Notice"
    assert row.document_id == hmac.new(bytes.fromhex(KEY), b"1/1", hashlib.sha256).hexdigest().upper()
    gone = {"height", "weight", "hair_colour", "_links", "date_of_birth", "arrest_warrants", "issuing_country_id", "charge"}
    assert not gone & set(documents.columns)
    assert sorted((r.entity_id, r.reason) for r in rejects.collect()) == [
        ("1/2", "birth date"), ("1/3", "no link to the detail"), ("1/4", "no warrant"),
    ]

    documents, rejects = notices.notice_documents(*notice_inputs(spark), "yellow", KEY)
    rows = {r.entity_id: r for r in documents.collect()}
    assert sorted((r.entity_id, r.reason) for r in rejects.collect()) == [
        ("1/2", "birth date"), ("1/3", "no link to the detail"),
    ]
    assert set(rows) == {"1/1", "1/4"} and rows["1/4"].entity_notes is None
    sparse = R.to_sparse(documents.select("entity_id", "entity_notes", "entity_dob"), "entity_id").collect()
    assert {r.entity_id: r.document for r in sparse}["1/4"] == '{"entity_id":"1/4","entity_dob":"1970-01-01T00:00:00.000Z"}'


def test_rejects_are_all_that_is_no_document(spark):
    responses, details = notice_inputs(spark)
    broken = decode_json(local_frame(spark, [("{oops",), (None,)], "r string"), "r", schemas.NOTICE_RESPONSE)
    documents, rejects = notices.notice_documents(responses.unionByName(broken), details.where("detail_url <> '/1'"), "red", KEY)
    assert documents.count() == 0
    reasons = sorted((r.entity_id or "", r.reason) for r in rejects.collect())
    assert reasons == [("", "undecodable response")] * 2 + [
        ("1/1", "no detail"), ("1/2", "birth date"), ("1/3", "no link to the detail"), ("1/4", "no warrant"),
    ]


def test_attributes_keep_their_form(spark):
    """One value or a list, and numbers as printed."""
    body = '{"entity_id": "1", "weight": 80, "height": 1.80, "hairs_id": "BRO", "eyes_colors_id": ["BLU", "GRN"], "languages_spoken_ids": []}'
    details = decode_json(local_frame(spark, [(body,)], "r string"), "r", schemas.NOTICE_DETAIL).select("body.*")
    note = R.fold_attributes(details.withColumnsRenamed(rules.NOTICE_RENAMES)).first().entity_notes
    assert note in {f"Physical description: height: {h}; weight: 80; hair_colour: BRO; eyes_colour: GRN;" for h in ("1.8", "1.80")}


def test_rename_needs_every_key(spark):
    with pytest.raises(ValueError, match="charge"):
        R.rename_notice(local_frame(spark, [(1,)], "a int"), "red")


MERGED = "doc string, year int, table_no int, row_no int, `Violation Regulation(s)` string, `Business Name` string, `Case Number` string, Payments string"
SPLIT = "doc string, year int, table_no int, row_no int, Violation string, `Regulation(s)` string, `Business Name` string, `Case Number` string, Payments string"


@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_penalty_records_merged_header(spark, chunk):
    rows = [
        ("d", 2021, 1, 0, "Late Part 5 and 30 CFR 1", None, None, None),
        ("d", 2021, 1, 1, "no pattern", None, None, None),
        ("d", 2021, 1, 2, "third Subpart B", "Acme", "CP-1", "$1,234"),
        ("d", 2021, 1, 3, "Wrong CFR 9", "Beta", "CP-2", "n/a"),
        ("d", 2021, 1, 4, "tail 30 CFR 1", None, None, None),
        ("d", 2021, 2, 0, "other 30 CFR 7", "Gamma", "CP-3", "5"),
    ]
    good, bad = penalties.penalty_records(local_frame(spark, rows, MERGED), chunk=chunk)
    got = [(r.message_id, r.message_summary, r.message_tags, r.message_value) for r in good.orderBy("message_id").collect()]
    assert got == [
        ("CP-1", "Late Part 5 and third ", "30 CFR 1 Subpart B ", 1234),
        ("CP-3", "other ", "30 CFR 7 ", 5),
    ]
    assert [(r.message_id, r.reason) for r in bad.collect()] == [("CP-2", "no amount")]
    kept, _ = penalties.penalty_records(local_frame(spark, rows, MERGED), chunk=chunk, on_no_match="violation")
    assert kept.orderBy("message_id").first().message_summary == "Late Part 5 and no patternthird "


def test_penalty_records_split_header(spark):
    rows = [
        ("d", 2020, 1, 0, "v1 ", None, None, None, None),
        ("d", 2020, 1, 1, None, "30 CFR 1", "Acme", "CP-1", "$10"),
    ]
    good, _ = penalties.penalty_records(local_frame(spark, rows, SPLIT))
    row = good.first()
    assert (row.message_summary, row.message_tags, row.message_title) == ("v1 ", "30 CFR 1 ", "PENALTY COLLECTIONS FY 2020")
    assert row.time_master == row.time_document == "2020-12-31T00:00:00.000Z"


def test_attributes_of_any_json_type(spark):
    values = ["1.70", '["BLA", "BRO"]', "[2, 1.75]", '{"b": 1, "a": [2]}', '[{"b": 1, "a": 2}]', "[note without end", "[]", "plain", "true", None]
    shown = ["1.70", "BRO", "1.75", '{"b": 1, "a": [2]}', '{"b":1,"a":2}', "[note without end", None, "plain", "true", None]
    frame = local_frame(spark, list(enumerate(values)), "id int, height string")
    notes = lambda df: [r.entity_notes for r in R.fold_attributes(df).orderBy("id").collect()]
    want = [v and f"{rules.FOLD_PREFIX}height: {v};" for v in shown]
    assert notes(frame) == want
    typed = ["1.7", "BRO", "1.75", '{"a":[2],"b":1}', '{"a":2,"b":1}', None, None, None, "true", None]
    variants = frame.withColumn("height", F.try_parse_json("height"))
    assert notes(variants) == [v and f"{rules.FOLD_PREFIX}height: {v};" for v in typed]
