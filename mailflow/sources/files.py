"""Reading mail files: JSON, plain text and RFC-822 messages."""

from __future__ import annotations

from collections.abc import Iterator
from email import message_from_bytes
from email.header import decode_header, make_header

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailflow import values
from mailflow.functions import ids
from mailflow.functions.payload import header_time, parse_whole

# Texts up to this size always fit one VARIANT.
VARIANT_BYTES = 16 << 20
LISTING_TASKS = 4  # per core
OPEN_COST = 64 << 10  # bytes that a file counts for besides its own when files are dealt to tasks


def _metadata():
    return [
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("upload_timestamp"),
    ]


def _as_raw_rows(files: DataFrame, content) -> DataFrame:
    """Whole-file rows in the shape of the raw file table."""
    return files.select(
        ids.row_id("EMAIL_", F.col("file_path"), F.col("file_text")).alias("file_id"),
        "file_name",
        "file_path",
        "file_size",
        "upload_timestamp",
        content.alias("file_content"),
        "file_text",
        F.lit(values.PENDING).alias("processing_status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _whole_files(reader, path: str, pattern: str | None) -> DataFrame:
    reader = reader.option("wholetext", True).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.schema("value string").format("text").load(path)
    return files.select(F.col("value").alias("file_text"), *_metadata())


def read_json_mail(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per JSON file; text that is no JSON has a NULL content.

    Spark lists no files of zero length, so an empty file gives no row.
    """
    files = _whole_files(spark.read, path, pattern)
    return _as_raw_rows(files, parse_whole(F.col("file_text")))


def read_text_mail(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per plain text file, wrapped as a raw-text payload."""
    files = _whole_files(spark.read, path, pattern)
    wrapped = F.to_json(F.struct(F.col("file_text").alias("raw_text")))
    return _as_raw_rows(files, F.parse_json(wrapped))


def stream_raw_files(
    spark: SparkSession, path: str, pattern: str | None = None, files_per_trigger: int = 10_000
) -> DataFrame:
    """New JSON mail files as they appear, each exactly once."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    files = _whole_files(reader, path, pattern)
    return _as_raw_rows(files, parse_whole(F.col("file_text")))


def small_files(spark: SparkSession) -> dict[str, str]:
    """Session settings for a stream of very many small files.  Spark's own give every file
    of a batch a task to be listed in, and a few files to a task that reads them, which
    then writes a file of its own."""
    return {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(OPEN_COST),
    }


def explode_mail_batch(raw: DataFrame) -> DataFrame:
    """One row per mail: a file holding a JSON array gives a row per element.

    ``batch_pos`` is the element's place; rows from an array get their own file
    id so that the mails stay distinguishable, and no copy of the file's text.
    An empty array gives one row without content that keeps the text, so that the
    file gets a status.  Text that is no JSON as a whole is kept in one row; only
    arrays too large for one VARIANT are read element by element, and counted.
    """
    rest = [c for c in raw.columns if c not in ("file_content", "file_id", "file_text")]
    content, text = F.col("file_content"), F.col("file_text")
    large = content.isNull() & (F.octet_length(text) > VARIANT_BYTES) & F.rtrim(text).endswith("]")
    listed = F.when(large, F.from_json(text, "array<variant>"))
    # The text is one JSON value if it is the first of exactly two elements of an array.
    ended = F.json_array_length(F.concat(F.lit("["), text, F.lit(", 0]"))) == 2
    whole = F.when(ended & (F.size(listed) == F.json_array_length(text)), listed)
    elements = F.coalesce(F.try_variant_get(content, "$", "array<variant>"), whole)
    batch = F.col("_elements").isNotNull()
    filled = F.coalesce(F.size("_elements") > 0, F.lit(False))
    exploded = raw.withColumn("_elements", elements).select(
        F.col("file_id").alias("_file"),
        *rest,
        F.when(~filled, text).alias("file_text"),
        filled.alias("_batch"),
        F.posexplode(
            F.when(filled, F.col("_elements")).when(batch, F.array(F.lit(None).cast("variant"))).otherwise(F.array(content))
        ).alias("batch_pos", "file_content"),
    )
    own_id = F.when(F.col("_batch"), F.concat_ws("#", "_file", "batch_pos"))
    return exploded.select(
        F.coalesce(own_id, "_file").alias("file_id"), *rest, "batch_pos", "file_content", "file_text"
    )


def read_rfc822(spark: SparkSession, path: str, pattern: str = "*.eml") -> DataFrame:
    """RFC-822 message files as binary rows for ``parse_rfc822``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(F.col("path").alias("message_id"), "content")


def _text(data: bytes, charset: str | None) -> str:
    """The part's text in its own charset; UTF-8 where none or no known one is named."""
    try:
        return data.decode(charset or "utf-8", errors="ignore")
    except LookupError:
        return data.decode("utf-8", errors="ignore")


def _parse_message(content: bytes) -> dict:
    message = message_from_bytes(content)
    plain = next((p for p in message.walk() if p.get_content_type() == "text/plain"), None)
    part = plain if message.is_multipart() else message
    data = part.get_payload(decode=True) if part is not None else b""

    def header(name):
        value = message.get(name)
        return None if value is None else str(make_header(decode_header(value)))

    return {
        "sender": header("From"),
        "subject": header("Subject"),
        "date_header": header("Date"),
        "body": _text(data or b"", part.get_content_charset() if part is not None else None),
    }


def parse_rfc822(messages: DataFrame) -> DataFrame:
    """RFC-822 bytes in ``content`` to sender, subject, date and text body.

    A message that cannot be read gives a row with its error, not a failed job.
    """
    keep = [f for f in messages.schema.fields if f.name != "content"]
    names = [f.name for f in keep]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["content"]:
                try:
                    rows.append({**_parse_message(bytes(content)), "error_message": None})
                except Exception as error:  # one bad message must not stop the batch
                    rows.append({"error_message": type(error).__name__})
            parsed = pd.DataFrame(
                rows, columns=["sender", "subject", "date_header", "body", "error_message"]
            )
            yield pd.concat([batch[names].reset_index(drop=True), parsed], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    schema += ", sender string, subject string, date_header string, body string, error_message string"
    return messages.mapInPandas(read, schema).select(
        *names,
        F.coalesce("sender", F.lit("unknown")).alias("sender"),
        F.coalesce("subject", F.lit(values.DEFAULT_SUBJECT)).alias("subject"),
        header_time(F.col("date_header")).alias("email_date"),
        "body",
        "error_message",
    )
