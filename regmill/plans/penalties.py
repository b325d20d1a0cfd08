"""Penalty tables: rows of extracted tables become typed penalty records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.operators import records as R
from regmill.operators.ordered import CHUNK, assemble_records


def text_pieces(rows: DataFrame, on_no_match: str = "drop") -> DataFrame:
    """Violation and regulation of each row, from one merged column or from two."""
    if "Violation Regulation(s)" in rows.columns:
        return R.split_regulation(rows, "Violation Regulation(s)", on_no_match)
    return rows.withColumns(
        {"violation": F.col("Violation"), "regulation": F.concat(F.col("`Regulation(s)`"), F.lit(" "))}
    )


def penalty_records(
    rows: DataFrame, order: tuple[str, ...] = ("row_no",), chunk: int = CHUNK, on_no_match: str = "drop"
) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of table rows (doc, year, table_no, row_no and the printed columns)."""
    assembled = assemble_records(
        text_pieces(rows, on_no_match),
        by=["doc", "year", "table_no"],
        order=list(order),
        pieces={"message_summary": F.col("violation"), "message_tags": F.col("regulation")},
        closes=F.col("Business Name").isNotNull(),
        closing={
            "entity_full_name": F.col("Business Name"),
            "message_id": F.col("Case Number"),
            "payment": F.col("Payments"),
        },
        chunk=chunk,
    )
    valued = R.fiscal_stamp(R.parse_amount(assembled, "payment", "message_value"), "year")
    return R.split_rejects(R.of_source(valued, "onrr"), {"no amount": F.col("message_value").isNotNull()})
