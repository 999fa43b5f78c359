"""Raw files to mails: one projection, no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mailflow import schemas, values
from mailflow.functions import bodies, ids, payload
from mailflow.functions.payload import text_at

BAD_JSON = "content is not valid JSON"
NO_FILE = "file is empty"


def _by_format(fmt: Column, choices: dict[str, Column], default: Column) -> Column:
    """CASE over the route: only the branch of a row's format is evaluated."""
    items = list(choices.items())
    first, rest = items[0], items[1:]
    case = reduce(
        lambda acc, kv: acc.when(fmt == kv[0], kv[1]), rest, F.when(fmt == first[0], first[1])
    )
    return case.otherwise(default)


def _content(raw: DataFrame) -> tuple[Column, Column]:
    """Payload as VARIANT and as text, from whichever of the two is stored."""
    stored = dict(raw.dtypes)
    if stored.get("file_content") == "variant":
        content = F.col("file_content")
        text = F.coalesce("file_text", F.to_json(content)) if "file_text" in stored else F.to_json(content)
        return content, text
    source = "file_text" if "file_text" in stored else "file_content"
    return payload.parse_whole(F.col(source)), F.col(source)


def parse_mail(
    raw: DataFrame, decode: str = "none", flat: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """One mail per raw file, whatever its format, with the row's outcome.

    ``decode="base64url"`` decodes API bodies and keeps the stored text where it
    does not decode.  ``flat`` also recognises flat API rows.  ``keep`` names
    further raw columns to carry along.
    """
    content, text = _content(raw)
    carried = [c for c in (keep or []) if c != "file_id"]
    stored = [n for n in ("file_content", "file_text") if n in raw.columns and n not in carried]
    routed = raw.select("file_id", *carried, *stored, content.alias("_c")).withColumn(
        "email_format", payload.route_format(F.col("_c"), flat)
    )
    c, fmt = F.col("_c"), F.col("email_format")
    # The whole text is only needed where no known field holds the body.
    read = routed.withColumn(
        "_headers", F.when(fmt == values.API, payload.headers_at(c))
    ).withColumn("_text", F.when(c.isNull() | (fmt == values.UNKNOWN), text))
    h = F.col("_headers")
    nothing = F.lit(None).cast("string")

    sender = {
        values.API: payload.header(h, "From"),
        values.SIMPLE: text_at(c, "$.sender"),
        values.MARKETING: text_at(c, "$.sender"),
        values.EXCHANGE: text_at(c, "$.SenderEmailAddress"),
        values.FLAT: F.coalesce(text_at(c, "$.sender"), F.lit(values.DEFAULT_SENDER)),
    }
    subject = {
        values.API: payload.header(h, "Subject"),
        values.SIMPLE: text_at(c, "$.subject"),
        values.MARKETING: text_at(c, "$.subject"),
        values.EXCHANGE: text_at(c, "$.Subject"),
        values.FLAT: F.coalesce(text_at(c, "$.subject"), F.lit(values.DEFAULT_SUBJECT)),
    }
    data = F.coalesce(text_at(c, "$.payload.parts[0].body.data"), text_at(c, "$.payload.body.data"))
    if decode == "base64url":
        data = F.coalesce(bodies.decode_base64url(data), data)
    body = {
        values.API: data,
        values.SIMPLE: text_at(c, "$.email_text"),
        values.MARKETING: text_at(c, "$.email_text"),
        values.EXCHANGE: text_at(c, "$.Body"),
        values.RAW_TEXT: text_at(c, "$.raw_text"),
        values.FLAT: F.coalesce(text_at(c, "$.body"), F.lit("")),
    }
    listed = F.coalesce(
        F.try_variant_get(c, "$.recipients", schemas.RECIPIENTS),
        payload.address_list(text_at(c, "$.recipients")),
    )
    no_recipients = F.array().cast(schemas.RECIPIENTS)
    recipients = {
        values.API: payload.address_list(payload.header(h, "To")),
        values.SIMPLE: listed,
        values.MARKETING: listed,
        values.EXCHANGE: F.array_compact(F.array(text_at(c, "$.ToRecipients"))),
    }
    internal = text_at(c, "$.internalDate")
    stamp = text_at(c, "$.timestamp")
    date = {
        values.API: F.coalesce(
            payload.epoch_millis(internal),
            payload.iso_time(internal),
            payload.header_time(payload.header(h, "Date")),
        ),
        values.SIMPLE: payload.iso_time(text_at(c, "$.email_date")),
        values.MARKETING: payload.iso_time(text_at(c, "$.email_date")),
        values.EXCHANGE: payload.iso_time(text_at(c, "$.DateTimeReceived")),
        values.FLAT: F.coalesce(payload.epoch_millis(stamp), payload.iso_time(stamp)),
    }
    message = {values.API: text_at(c, "$.messageId"), values.FLAT: text_at(c, "$.id")}
    thread = {values.API: text_at(c, "$.threadId"), values.FLAT: text_at(c, "$.thread_id")}
    attached = F.try_variant_get(c, "$.attachments", schemas.ATTACHMENTS)
    ok = c.isNotNull()
    error = F.when(F.length(F.trim("_text")) == 0, NO_FILE).otherwise(BAD_JSON)
    return read.select(
        ids.row_id("PROC_", F.col("file_id")).alias("email_id"),
        "file_id",
        *carried,
        "email_format",
        _by_format(fmt, sender, nothing).alias("sender_email"),
        _by_format(fmt, recipients, F.when(ok, no_recipients)).alias("recipient_emails"),
        _by_format(fmt, subject, nothing).alias("subject"),
        _by_format(fmt, body, F.when(ok, F.col("_text"))).alias("email_body"),
        _by_format(fmt, date, F.lit(None).cast("timestamp_ntz")).alias("email_date"),
        F.when(fmt.isin(values.SIMPLE, values.MARKETING), attached).alias("attachments"),
        F.when(fmt == values.MARKETING, values.MARKETING.upper()).alias("email_classification"),
        _by_format(fmt, message, nothing).alias("message_id"),
        _by_format(fmt, thread, nothing).alias("thread_id"),
        F.when(ok, values.COMPLETED).otherwise(values.FAILED).alias("status"),
        F.when(~ok, F.when(F.col("_text").isNull(), NO_FILE).otherwise(error)).alias("error_message"),
    )


def extract_body(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded text body of API payloads, searched through the part tree."""
    content, _ = _content(raw)
    message = F.try_variant_get(content, "$.payload", "variant")
    return raw.select("file_id", *(keep or []), bodies.extract_body(message).alias("body"))


def headers_map(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Headers of API payloads as a map (last duplicate wins)."""
    content, _ = _content(raw)
    with_headers = raw.select(
        "file_id", *(keep or []), payload.headers_at(content).alias("_headers")
    )
    return with_headers.withColumn("headers", payload.headers_map(F.col("_headers"))).drop("_headers")


def pending_files(
    raw: DataFrame, pattern: str = ".*", limit: int | None = None
) -> DataFrame:
    """The PENDING files whose whole name matches the pattern, or the next ``limit``."""
    due = raw.filter(
        (F.col("processing_status") == values.PENDING)
        & F.col("file_name").rlike(f"^(?:{pattern})$")
    )
    return due if limit is None else due.orderBy("upload_timestamp", "file_id").limit(limit)


def parse_batch(
    raw: DataFrame, pattern: str = ".*", limit: int | None = None, **options
) -> DataFrame:
    """Parse the pending files, or the next ``limit`` of them."""
    return parse_mail(pending_files(raw, pattern, limit), **options)


def apply_status(raw: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Raw files with the status and error of their latest outcome."""
    by_time = "outcome_time" in outcomes.columns
    latest = F.col("outcome_time") if by_time else F.lit(0)
    new = outcomes.groupBy("file_id").agg(
        F.max_by(F.struct("status", "error_message"), latest).alias("_new")
    )
    kept = [c for c in raw.columns if c not in ("processing_status", "error_message")]
    return raw.join(new, "file_id", "left").select(
        *kept,
        F.coalesce("_new.status", "processing_status").alias("processing_status"),
        F.when(F.col("_new").isNotNull(), F.col("_new.error_message"))
        .otherwise(F.col("error_message"))
        .alias("error_message"),
    )
