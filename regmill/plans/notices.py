"""Notices: search responses merged with detail responses become sparse keyed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.operators import records as R


def notice_documents(
    responses: DataFrame, details: DataFrame, kind: str, key_hex: str
) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects with their reason). `responses` holds decoded search results in `body`, `details` one row per
    notice URL.

    Documents and rejects together are all notices, and all responses without a readable list of them.
    """
    notices = R.explode_notices(responses, unlinked=True)
    merged = R.merge_right(notices, details, "detail_url", found="_detail")
    checks = {
        "no link to the detail": F.col("detail_url").isNotNull(),
        "no detail": F.col("_detail").isNotNull(),
    }
    if kind == "red":
        merged = R.promote_first(merged.withColumn("_warrants", F.col("arrest_warrants")), "arrest_warrants", empty=True)
        checks["no warrant"] = F.size("_warrants") > 0
    checks |= {"birth date": F.col("entity_dob").isNotNull(), "entity id": F.col("entity_id").isNotNull()}
    good, bad = R.split_rejects(R.normalize_dob(merged), checks)
    good, bad = (x.drop("_detail", "_warrants") for x in (good, bad))
    undecoded = responses.where(F.col("body._embedded.notices").isNull()).select(F.lit("undecodable response").alias("reason"))
    sourced = R.of_source(R.rename_notice(good, kind), kind)
    documents = R.document_id(R.fold_attributes(sourced), "entity_id", key_hex)
    return documents, bad.unionByName(undecoded, allowMissingColumns=True)
