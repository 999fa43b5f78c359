"""Parsing: payloads are composed from the tables, parsed, and compared with the
columns they were composed from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.catalog.registry import query
from mailflow.functions import payload
from mailflow.operators import parse


def flat_columns(parsed: DataFrame) -> DataFrame:
    """Arrays as text, ids of the run left out."""
    attachments = F.array_join(
        F.transform("attachments", lambda a: F.concat_ws(":", a["name"], a["size"].cast("string"))), ","
    )
    return parsed.select(
        "file_id", "email_format", "sender_email",
        F.array_join("recipient_emails", ",").alias("recipients"),
        "subject", "email_body", "email_date", attachments.alias("attachments"),
        "email_classification", "status", "error_message",
    )


# Expected columns per format, over base.
TEAM = "concat('team@', source, '.example.com,desk@example.com')"
FILE = "concat('file', doc_id, ':', doc_id * 10)"
SHAPES = {
    "api": ("'gmail_api'", "sender", TEAM, "subject", "body",
            "date_trunc('milliseconds', upload_timestamp)", "NULL::VARCHAR", "NULL::VARCHAR"),
    "simple": ("'simple_format'", "sender", TEAM, "subject", "body", "upload_timestamp", FILE, "NULL::VARCHAR"),
    "marketing": ("'marketing'", "sender", TEAM, "subject", "body", "upload_timestamp", FILE, "'MARKETING'"),
    "exchange": ("'exchange'", "sender", "'desk@example.com'", "subject", "body", "upload_timestamp",
                 "NULL::VARCHAR", "NULL::VARCHAR"),
    "raw_text": ("'raw_text'", "NULL::VARCHAR", "''", "NULL::VARCHAR", "body", "NULL::TIMESTAMP",
                 "NULL::VARCHAR", "NULL::VARCHAR"),
    "unknown": ("'unknown'", "NULL::VARCHAR", "''", "NULL::VARCHAR", "concat('{\"doc_id\":', doc_id, '}')",
                "NULL::TIMESTAMP", "NULL::VARCHAR", "NULL::VARCHAR"),
    "flat": ("'flat'", "coalesce(sender, 'unknown@unknown.com')", "''",
             "CASE WHEN doc_id % 5 <> 0 THEN subject ELSE 'No Subject' END", "body",
             "date_trunc('milliseconds', upload_timestamp)", "NULL::VARCHAR", "NULL::VARCHAR"),
}
COLUMNS = ["email_format", "sender_email", "recipients", "subject", "email_body", "email_date",
           "attachments", "email_classification"]


def shape_sql(shape: str, where: str = "true") -> str:
    cols = ", ".join(f"{e} AS {c}" for e, c in zip(SHAPES[shape], COLUMNS))
    return (
        f"SELECT concat('F', doc_id) AS file_id, {cols}, 'COMPLETED' AS status,"
        f" NULL::VARCHAR AS error_message FROM base WHERE {where}"
    )


BROKEN = """
SELECT concat('F', doc_id), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'FAILED',
  CASE WHEN doc_id % 17 = 0 THEN 'content is not valid JSON' ELSE 'file is empty' END
FROM base WHERE doc_id % 17 = 0 OR doc_id % 19 = 0"""
BY_NUMBER = ["api", "simple", "marketing", "exchange", "raw_text", "simple", "unknown"]
ALL_SHAPES = " UNION ALL ".join(
    shape_sql(s, f"fmt_no = {i} AND doc_id % 17 <> 0 AND doc_id % 19 <> 0")
    for i, s in enumerate(BY_NUMBER)
) + " UNION ALL " + BROKEN


@query("parse_mail", tb.sql(tb.BASE, select=ALL_SHAPES))
def parse_all(spark, sf):
    """All formats in one table, with unreadable and missing payloads."""
    return flat_columns(parse.parse_mail(tb.raw(spark, sf).drop("file_content")))


@query(
    "route_format",
    tb.sql(tb.BASE, select=f"SELECT file_id, email_format FROM ({ALL_SHAPES})"),
)
def route(spark, sf):
    """Which parser each payload goes to."""
    raw = tb.raw(spark, sf)
    return raw.select("file_id", payload.route_format(F.col("file_content")).alias("email_format"))


def one_shape(name: str, shape: str, text, **options):
    @query(name, tb.sql(tb.BASE, select=shape_sql(shape)))
    def run(spark, sf):
        b = tb.base(spark, sf)
        composed = tb.raw_from(b, text(b) if text is tb.api_json else text())
        return flat_columns(parse.parse_mail(composed, **options))


one_shape("parse_api", "api", tb.api_json)
one_shape("parse_simple", "simple", lambda: tb.simple_json(values.SIMPLE))
one_shape("parse_marketing", "marketing", lambda: tb.simple_json(values.MARKETING))
one_shape("parse_exchange", "exchange", tb.exchange_json)
one_shape("parse_raw_text", "raw_text", tb.raw_text_json)
one_shape("parse_unknown", "unknown", tb.unknown_json)
one_shape("parse_flat", "flat", tb.flat_json, flat=True)


def base64url(text: Column) -> Column:
    return F.rtrim(F.translate(F.base64(F.encode(text, "UTF-8")), "+/\r\n", "-_"), F.lit("="))


@query(
    "parse_decoded",
    tb.sql(tb.BASE, select="""
SELECT concat('F', doc_id) AS file_id, body AS email_body FROM base"""),
)
def parse_decoded(spark, sf):
    """API bodies in URL-safe base64; every third one is stored as plain text."""
    b = tb.base(spark, sf)
    stored = F.when(F.col("doc_id") % 3 != 0, base64url(F.col("body"))).otherwise(F.col("body"))
    composed = tb.raw_from(b, tb.api_json(b, stored))
    return parse.parse_mail(composed, decode="base64url").select("file_id", "email_body")


def part_tree(n: Column, data: Column) -> Column:
    """Payloads with the text at different places of the part tree."""

    def leaf(mime, content):
        return F.concat(
            F.lit(f'{{"mimeType":"{mime}","body":{{"data":"'), content, F.lit('"}}')
        )

    def node(*children):
        parts = F.concat_ws(",", *children)
        return F.concat(F.lit('{"mimeType":"multipart/mixed","parts":['), parts, F.lit("]}"))

    html, plain = leaf("text/html", F.lit("PGI-")), leaf("text/plain", data)
    deep = node(html, node(node(node(node(plain)))))
    return tb.pick(
        n,
        [
            F.concat(F.lit('{"body":{"data":"'), data, F.lit('"}}')),
            node(plain, html),
            node(html, node(html, plain), leaf("text/plain", F.lit("bGF0ZXI"))),
            deep,
            node(html),
            leaf("text/plain", F.lit("????")),
        ],
    )


@query(
    "extract_body",
    tb.sql(tb.BASE, select="""
SELECT concat('F', doc_id) AS file_id,
  CASE doc_id % 6 WHEN 4 THEN 'No readable content found' WHEN 5 THEN 'Content extraction failed'
  ELSE body END AS body
FROM base"""),
)
def extract_body(spark, sf):
    """First text part of part trees up to five levels deep."""
    b = tb.base(spark, sf)
    tree = part_tree(F.col("doc_id") % 6, base64url(F.col("body")))
    text = F.concat(F.lit('{"payload":'), tree, F.lit("}"))
    return parse.extract_body(tb.raw_from(b, text))


@query(
    "headers_map",
    tb.sql(tb.BASE, select="""
SELECT concat('F', doc_id) AS file_id, 3 AS headers, sender AS from_header, subject AS subject_header,
  concat('relay', doc_id % 3) AS received
FROM base"""),
)
def headers_map(spark, sf):
    """Header lists with a repeated header as maps."""
    b = tb.base(spark, sf)

    def h(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    relay = F.concat(F.lit("relay"), (F.col("doc_id") % 3).cast("string"))
    headers = F.array(
        h("From", F.lit("first@example.com")), h("Received", F.lit("relay9")),
        h("Subject", F.col("subject")), h("Received", relay), h("From", F.col("sender")),
    )
    text = F.to_json(F.struct(F.struct(headers.alias("headers")).alias("payload")))
    mapped = parse.headers_map(tb.raw_from(b, text))
    m = F.col("headers")
    return mapped.select(
        "file_id",
        F.size(m).alias("headers"),
        m["From"].alias("from_header"),
        m["Subject"].alias("subject_header"),
        m["Received"].alias("received"),
    )


@query(
    "row_outcomes",
    tb.sql(tb.BASE, select=f"""
SELECT status, error_message, cast(count(*) AS BIGINT) AS files FROM ({ALL_SHAPES}) GROUP BY ALL"""),
)
def row_outcomes(spark, sf):
    """Files per outcome and error; unreadable ones do not stop the rest."""
    parsed = parse.parse_mail(tb.raw(spark, sf).drop("file_content"))
    return parsed.groupBy("status", "error_message").agg(F.count("*").alias("files"))


@query(
    "parse_batch",
    tb.sql(tb.BASE, tb.RAW, select=f"""
SELECT p.file_id, p.email_format, p.subject, p.status FROM ({ALL_SHAPES}) p
JOIN (SELECT file_id FROM raw WHERE processing_status = 'PENDING'
        AND regexp_full_match(file_name, '(simple|gmail|note)_.*[.]json')
      ORDER BY upload_timestamp, file_id LIMIT 50) USING (file_id)"""),
)
def parse_batch(spark, sf):
    """The next 50 pending files of three sources."""
    raw = tb.raw(spark, sf).drop("file_content")
    parsed = parse.parse_batch(raw, "(simple|gmail|note)_.*[.]json", values.PARSE_BATCH)
    return parsed.select("file_id", "email_format", "subject", "status")


@query(
    "parse_pending",
    tb.sql(tb.BASE, tb.RAW, select=f"""
SELECT p.file_id, p.email_format, p.email_body, p.status FROM ({ALL_SHAPES}) p
JOIN raw r USING (file_id) WHERE r.processing_status = 'PENDING'"""),
)
def parse_pending(spark, sf):
    """Every pending file."""
    raw = tb.raw(spark, sf).drop("file_content")
    return parse.parse_batch(raw, limit=None).select("file_id", "email_format", "email_body", "status")


@query(
    "apply_status",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT file_id, file_name,
  CASE WHEN processing_status <> 'PENDING' THEN processing_status
       WHEN has_content THEN 'COMPLETED' ELSE 'FAILED' END AS processing_status,
  CASE WHEN processing_status <> 'PENDING' THEN error_message
       WHEN doc_id % 17 = 0 THEN 'content is not valid JSON'
       WHEN doc_id % 19 = 0 THEN 'file is empty' END AS error_message
FROM raw"""),
)
def apply_status(spark, sf):
    """File table after parsing everything pending."""
    raw = tb.raw(spark, sf).drop("file_content")
    outcomes = parse.parse_batch(raw, limit=None).select("file_id", "status", "error_message")
    known = raw.select("file_id", "file_name", "processing_status", "error_message")
    return parse.apply_status(known, outcomes)
