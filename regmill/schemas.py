"""Record layouts."""

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


_clock = [StructField("time_collected", TimestampType()), StructField("time_uploaded", TimestampType())]

DOCUMENT = StructType(
    _strings(
        "message_title", "message_body", "doc_source_type", "document_id",
        "doc_source", "doc_source_url", "doc_source_pdf_url",
    )
    + _clock
    + _strings("time_master", "time_document")
)

PENALTY = StructType(
    _strings("message_title", "entity_full_name", "message_id", "message_summary", "message_tags")
    + [StructField("message_value", LongType())]
    + _strings("doc_source_type", "doc_source", "doc_source_url", "doc_source_pdf_url", "time_master")
    + _clock
    + _strings("time_document")
)

_link = StructType(_strings("href"))

NOTICE = StructType(
    _strings("entity_id", "name", "forename", "date_of_birth")
    + [
        StructField("nationalities", ArrayType(StringType())),
        StructField("_links", StructType([StructField("self", _link), StructField("thumbnail", _link)])),
    ]
)

NOTICE_RESPONSE = StructType(
    [
        StructField("total", LongType()),
        StructField("query", StructType([StructField("resultPerPage", LongType())])),
        StructField("_embedded", StructType([StructField("notices", ArrayType(NOTICE))])),
    ]
)

WARRANT = StructType(_strings("charge", "issuing_country_id"))

NOTICE_DETAIL = StructType(
    _strings("entity_id", "name", "forename", "date_of_birth", "sex_id", "place_of_birth", "country_of_birth_id")
    # one value or a list, by notice; as text, both keep their printed form
    + _strings("height", "weight", "languages_spoken_ids", "hairs_id", "eyes_colors_id")
    + [StructField("nationalities", ArrayType(StringType()))]
    + _strings("distinguishing_marks")
    + [StructField("arrest_warrants", ArrayType(WARRANT))]
)
