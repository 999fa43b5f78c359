"""Landing tables: append-only parquet with a log of committed batches.

A batch's files go to a folder of their own below ``data``; the batch counts once its
entry, a small file, stands in ``commits``.  Readers follow the entries and never list
data files, so what a failed or repeated write left behind is not seen.  A batch that is
written again finds its entry, so a job or query that is replayed leaves the table as it
was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailflow import values
from mailflow.clock import moment
from mailflow.functions import ids, payload

COMMIT = "batch_id string, folder string"
BATCH = "in_batch"  # names the batches' folders


def commits_dir(table_dir: str) -> str:
    return f"{table_dir}/commits"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.mkdirs(path)


def make_table(spark: SparkSession, table_dir: str) -> None:
    """An empty table, so that a reader may follow it before the first batch."""
    make_folder(spark, commits_dir(table_dir))


def committed(spark: SparkSession, table_dir: str, batch_id) -> str | None:
    """The data folder of a committed batch, or None."""
    entry, system = _path(spark, f"{commits_dir(table_dir)}/{batch_id}.json")
    if not system.exists(entry):
        return None
    return spark.read.schema(COMMIT).json(entry.toString()).first().folder


def commit(spark: SparkSession, table_dir: str, batch_id, folder: str) -> None:
    """Write the batch's entry under a hidden name and rename it: it is seen whole."""
    make_table(spark, table_dir)
    hidden, system = _path(spark, f"{commits_dir(table_dir)}/.{batch_id}-{uuid.uuid4().hex[:8]}")
    out = system.create(hidden, True)
    out.write(bytearray(json.dumps({"batch_id": str(batch_id), "folder": folder}).encode()))
    out.close()
    entry, _ = _path(spark, f"{commits_dir(table_dir)}/{batch_id}.json")
    if not system.rename(hidden, entry):
        raise OSError(f"cannot commit batch {batch_id} of {table_dir}")


def write_batch(rows: DataFrame, table_dir: str, batch_id, partition_by: list[str] | None = None) -> DataFrame:
    """Write one batch and return it as stored; a committed batch is kept as it is."""
    spark = rows.sparkSession
    folder = committed(spark, table_dir, batch_id)
    if folder is None:
        folder = f"{BATCH}={batch_id}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{table_dir}/data/{folder}", partitionBy=partition_by)
        commit(spark, table_dir, batch_id, folder)
    return read_folders(spark, table_dir, [folder], rows.schema)


def read_folders(spark: SparkSession, table_dir: str, folders: list[str], schema=None) -> DataFrame:
    """The rows of some batches."""
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{table_dir}/data")
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*[f"{table_dir}/data/{f}" for f in folders]).drop(BATCH)


def read_table(spark: SparkSession, table_dir: str, schema=None) -> DataFrame:
    """All committed batches of a table; give the schema to skip looking into files.
    The driver holds one entry per batch."""
    entries = spark.read.schema(COMMIT).json(commits_dir(table_dir))
    return read_folders(spark, table_dir, sorted(r.folder for r in entries.collect()), schema)


def kept_text(content: Column, text: Column) -> Column:
    """The text to store beside a payload: none where every field can be read
    from the payload, the whole of it where it is no JSON or of no known format."""
    unread = content.isNull() | (payload.route_format(content) == values.UNKNOWN)
    return F.when(unread, text)


def raw_rows(rows: DataFrame, as_of=None) -> DataFrame:
    """Named contents as PENDING raw rows.  ``rows`` has file_name and
    file_text; upload_timestamp is taken from the rows or from ``as_of``."""
    uploaded = F.col("upload_timestamp") if "upload_timestamp" in rows.columns else as_of
    content = F.col("file_content")
    return rows.withColumn("file_content", payload.parse_whole(F.col("file_text"))).select(
        ids.row_id("EMAIL_", F.col("file_name"), F.col("file_text")).alias("file_id"),
        "file_name",
        F.lit(None).cast("string").alias("file_path"),
        F.octet_length("file_text").cast("bigint").alias("file_size"),
        moment(uploaded).alias("upload_timestamp"),
        content,
        kept_text(content, F.col("file_text")).alias("file_text"),
        F.lit(values.PENDING).alias("processing_status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def land_raw(rows: DataFrame, table_dir: str, batch_id=0, as_of=None) -> DataFrame:
    """Append raw contents to the landing table; returns the table."""
    landed = write_batch(raw_rows(rows, as_of), table_dir, batch_id)
    return read_table(rows.sparkSession, table_dir, landed.schema)


def processed_rows(mails: DataFrame, as_of=None) -> DataFrame:
    """Mails that are already structured (sender, subject, body)."""
    extracted = F.col("extracted_timestamp") if "extracted_timestamp" in mails.columns else as_of
    return mails.select(
        ids.row_id(
            "PROC_", F.col("sender_email"), F.col("subject"), F.col("email_body"),
            moment(extracted).cast("string"),
        ).alias("email_id"),
        "sender_email",
        "subject",
        "email_body",
        moment(extracted).alias("extracted_timestamp"),
    )


def land_processed(mails: DataFrame, table_dir: str, batch_id=0, as_of=None) -> DataFrame:
    """Append structured mails to the processed table; returns the table."""
    landed = write_batch(processed_rows(mails, as_of), table_dir, batch_id)
    return read_table(mails.sparkSession, table_dir, landed.schema)


def with_id(df: DataFrame, prefix: str, cols: list[str], name: str = "row_id") -> DataFrame:
    """Add an id made of a prefix and a hash of the given columns."""
    return df.withColumn(name, ids.row_id(prefix, *[F.col(c).cast("string") for c in cols]))
