"""Where the flows end: files and page texts in layouts, records in versioned indexes, complete to their last field.

Every load is named by a token or by its load and batch number, so a job that is started again after a lost driver adds
nothing twice. Load times are stamped here, after ids were made, and `as_of` fixes them for a rerun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from regmill import schemas
from regmill.operators import folders, layout
from regmill.operators import links as L
from regmill.operators import records as R
from regmill.operators.versions import append_versions
from regmill.plans.collection import ORDER, PLACE

FOLDERS = PLACE[:-1]


def held_files(spark: SparkSession, root: str, files: DataFrame, before: int | None = None) -> DataFrame:
    """The places that committed loads of a layout hold, for `links.not_held` and the collection flows."""
    fields = [StructField(c, files.schema[c].dataType) for c in FOLDERS]
    return layout.manifest(files.sparkSession, root, fields, PLACE[-1], before).select(*PLACE)


def load_files(files: DataFrame, contents: DataFrame, root: str, token: str) -> tuple[int, DataFrame]:
    """Add the collected files (folder, category, year, file_name, target, …) that the layout lacks.

    `contents` has a row per target that was fetched (target, content). The load's number, and the files whose
    contents are missing: they are not held and come again in the next load. Places are settled
    before contents are joined, so contents of held and repeated files do not move.
    """
    spark = files.sparkSession
    number = folders.claim_load(spark, root, token)
    order = [c for c in (*ORDER, "_region", "_pos") if c in files.columns]
    held = held_files(spark, root, files, number)
    wanted = L.not_held_filtered(files, held, PLACE, order).select(*PLACE, "target", *ORDER)
    fetched = wanted.join(contents.select("target", "content"), "target")
    layout.write_load(fetched, root, token, FOLDERS, PLACE[-1], ORDER)
    missing = wanted.join(contents.select("target"), "target", "left_anti")
    return number, missing


def stored_files(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """What a layout of files shows: the file of the first load that had it."""
    content = files.select("target", *PLACE, *ORDER).schema.fields + [StructField("content", schemas.StringType())]
    return layout.read_layout(spark, root, StructType(content), FOLDERS, PLACE[-1])


def load_page_texts(texts: DataFrame, root: str, token: str) -> int:
    """Add page texts (folder, year, file_name, text); the last load's text of a file is shown."""
    return layout.write_load(texts, root, token, ["folder", "year"], "file_name", ["text"], wins=layout.LAST)


def as_records(df: DataFrame, schema: StructType, key: list[str]) -> DataFrame:
    """The fields of a record layout in its order and types, after the key; a field that is not there is null."""
    fields = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in schema]
    own = [c for c in key if c not in schema.names]
    return df.select(*own, *[c.cast(f.dataType).alias(f.name) for c, f in zip(fields, schema, strict=True)])


def load_documents(
    documents: DataFrame, root: str, batch_id: int = 0, load: int = 0, source: str = "main", as_of: Column | None = None
) -> None:
    """Write release documents in full, with their versions; repeated ids go to the audit."""
    rows = as_records(R.stamp(documents, as_of), schemas.DOCUMENT, ["document_id"])
    order = ["time_document", "doc_source_pdf_url", "message_title"]
    append_versions(rows, root, batch_id, ["document_id"], order, "doc_source_pdf_url", load, source)


def load_penalties(
    records: DataFrame,
    root: str,
    key_hex: str,
    source_url: str,
    document_url: str,
    batch_id: int = 0,
    load: int = 0,
    as_of: Column | None = None,
) -> None:
    """Write penalty records in full under the keyed id of case number and name."""
    message = F.concat(F.coalesce("message_id", F.lit("")), F.coalesce("entity_full_name", F.lit("")))
    rows = records.withColumns(
        {"doc_source_url": F.lit(source_url), "doc_source_pdf_url": F.lit(document_url), "message": message}
    )
    rows = as_records(R.stamp(R.document_id(rows, "message", key_hex), as_of), schemas.PENALTY, ["document_id"])
    order = ["time_document", "message_summary", "message_value"]
    append_versions(rows, root, batch_id, ["document_id"], order, "doc_source_pdf_url", load, "penalties")


def load_notices(
    documents: DataFrame,
    root: str,
    kind: str,
    source_url: str,
    as_of: Column | None = None,
    batch_id: int = 0,
    load: int = 0,
) -> None:
    """Write notices as sparse records: only the keys that have a value, with all four times and the source's address."""
    now = F.current_timestamp() if as_of is None else as_of
    times = {n: now for n in ("time_master", "time_collected", "time_uploaded", "time_document")}
    full = documents.withColumns(times | {"doc_source_url": F.lit(source_url)})
    sparse = R.to_sparse(full, "document_id").withColumn("url", F.lit(source_url))
    append_versions(sparse, root, batch_id, ["document_id"], ["document"], "url", load, kind)
