"""Sources and landing: files are written from the tables into the shared work
folder and read back."""

from __future__ import annotations

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.catalog.registry import query
from mailflow.clock import ago
from mailflow.functions import payload
from mailflow.operators import parse
from mailflow.session import work_dir
from mailflow.sources import files, landing, pull


def write_files(rows, folder: str) -> str:
    """One text file per row.

    A writer of Spark's is opened, checked and moved for every file, which takes longer
    than the file itself; where the folder's file system is known to Arrow, tasks write the
    files themselves.  A task that is run again writes the same files again.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(tasks)
    try:
        system, path = FileSystem.from_uri(folder)
        system.create_dir(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        rows.write.option("maxRecordsPerFile", 1).text(folder)
        return folder

    def write(part):
        system, path = FileSystem.from_uri(folder)
        task = TaskContext.get().partitionId()
        for n, (value,) in enumerate(part):
            with system.open_output_stream(f"{path}/part-{task:05d}-{n:09d}.txt") as file:
                file.write(bytes(value or b"") + b"\n")

    rows.select(F.col(rows.columns[0]).cast("binary")).foreachPartition(write)
    return folder


def item_number():
    return F.regexp_extract("file_text", "item([0-9]+)", 1).cast("bigint")


def _item_json():
    """Simple-format mail of a benchmark item; some items are broken JSON."""
    good = F.to_json(
        F.struct(
            F.lit(values.SIMPLE).alias("email_type"),
            F.concat(F.lit("item"), F.col("item_id").cast("string"), F.lit("@example.com")).alias("sender"),
            F.col("text").alias("email_text"),
        )
    )
    broken = F.concat(F.lit('{"sender": "item'), F.col("item_id").cast("string"))
    return F.when(F.col("item_id") % 9 == 4, broken).otherwise(good)


ITEM_MAILS = """
SELECT item_id, CASE WHEN item_id % 9 <> 4 THEN concat('item', item_id, '@example.com') END AS sender_email,
  CASE WHEN item_id % 9 <> 4 THEN text END AS email_body,
  CASE WHEN item_id % 9 <> 4 THEN 'COMPLETED' ELSE 'FAILED' END AS status
FROM benchmark"""


def item_files(spark, sf, name: str) -> str:
    items = tb.table(spark, sf, "benchmark").select(_item_json().alias("value"))
    return write_files(items, work_dir(spark, name))


@query("read_json_mail", ITEM_MAILS)
def read_json_mail(spark, sf):
    """One JSON file per mail, some of them broken."""
    raw = files.read_json_mail(spark, item_files(spark, sf, "json"))
    parsed = parse.parse_mail(raw, keep=["file_text"])
    return parsed.select(item_number().alias("item_id"), "sender_email", "email_body", "status")


@query(
    "read_text_mail",
    "SELECT 'raw_text' AS email_format, concat(text, chr(10)) AS email_body FROM benchmark",
)
def read_text_mail(spark, sf):
    """One plain text file per mail."""
    items = tb.table(spark, sf, "benchmark").select(F.col("text").alias("value"))
    raw = files.read_text_mail(spark, write_files(items, work_dir(spark, "text")))
    return parse.parse_mail(raw).select("email_format", "email_body")


@query(
    "explode_mail_batch",
    tb.sql(tb.BASE, select="""
SELECT concat('F', doc_id) AS file, 0 AS batch_pos, sender AS sender_email, body AS email_body FROM base
UNION ALL
SELECT concat('F', doc_id), 1, 'copy@example.com', subject FROM base WHERE doc_id % 3 = 0
UNION ALL
SELECT concat('F', doc_id, k), 0, NULL, NULL FROM base, (VALUES ('-none'), ('-cut'), ('-tail')) t(k) WHERE doc_id % 10 = 0"""),
)
def explode_mail_batch(spark, sf):
    """Every third file is an array of two mails; beside every tenth lie an empty
    array, one cut off, and one with text behind it, which are kept as they are."""
    b = tb.base(spark, sf)
    mail = F.struct(F.col("sender"), F.col("body").alias("email_text"))
    copy = F.struct(F.lit("copy@example.com").alias("sender"), F.col("subject").alias("email_text"))
    text = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.array(mail, copy))).otherwise(F.to_json(mail))
    raw = tb.raw_from(b, text)
    odd = F.array(*[
        F.struct(F.concat("file_id", F.lit(k)).alias("id"), t.alias("text"))
        for k, t in [
            ("-none", F.lit("[]")), ("-cut", F.concat(F.lit("["), F.col("file_text"), F.lit(", {"))),
            ("-tail", F.concat(F.lit("["), F.col("file_text"), F.lit("] behind"))),
        ]
    ])
    tenth = raw.filter(F.substring("file_id", 2, 20).cast("bigint") % 10 == 0).withColumn("_odd", F.explode(odd))
    tenth = tenth.withColumn("file_id", F.col("_odd.id")).withColumn("file_text", F.col("_odd.text")).select(raw.columns)
    raw = raw.unionByName(tenth).withColumn("file_content", payload.parse_whole(F.col("file_text")))
    exploded = files.explode_mail_batch(raw)
    parsed = parse.parse_mail(exploded, keep=["batch_pos"])
    return parsed.select(
        F.substring_index("file_id", "#", 1).alias("file"), "batch_pos", "sender_email", "email_body"
    )


@query(
    "land_raw",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT file_name, upload_timestamp, 'PENDING' AS processing_status, has_content,
  doc_id % 17 = 0 OR (has_content AND label = 'unknown') AS has_text FROM raw"""),
)
def land_raw(spark, sf):
    """Raw contents landed twice under one batch id: the table holds them once."""
    rows = tb.raw(spark, sf).select("file_name", "file_text", "upload_timestamp")
    folder = work_dir(spark, "raw")
    landing.land_raw(rows, folder, batch_id=1)
    table = landing.land_raw(rows, folder, batch_id=1)
    return table.select(
        "file_name", "upload_timestamp", "processing_status",
        F.col("file_content").isNotNull().alias("has_content"),
        F.col("file_text").isNotNull().alias("has_text"),
    )


@query(
    "land_processed",
    tb.sql(tb.BASE, tb.MAILS, select="SELECT sender_email, subject, email_body, extracted_timestamp FROM mails"),
)
def land_processed(spark, sf):
    """Structured mails landed directly."""
    mails = tb.mails(spark, sf).select("sender_email", "subject", "email_body", "extracted_timestamp")
    return landing.land_processed(mails, work_dir(spark, "mails")).drop("email_id")


@query(
    "parse_rfc822",
    """
SELECT page_id, 'robot@example.com' AS sender,
  CASE WHEN page_id % 4 = 0 THEN 'No Subject' ELSE concat('page ', page_id) END AS subject,
  TIMESTAMP '2024-03-05 13:07:00' AS email_date,
  CASE page_id % 3 WHEN 2 THEN '' ELSE url END AS body
FROM pages""",
)
def parse_rfc822(spark, sf):
    """A message per page: single part, text and HTML parts, or HTML only."""
    crlf = F.lit("\r\n")
    number = F.col("page_id")
    subject = F.when(
        number % 4 != 0, F.concat(F.lit("Subject: page "), number.cast("string"), crlf)
    ).otherwise("")
    head = F.concat(
        F.lit("From: robot@example.com\r\nDate: Tue, 5 Mar 2024 14:07:00 +0100\r\n"), subject,
        F.lit("MIME-Version: 1.0\r\n"),
    )

    def part(mime, content):
        return F.concat(
            F.lit(f"--edge\r\nContent-Type: {mime}; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n"),
            F.base64(F.encode(content, "UTF-8")), crlf,
        )

    multi = F.lit('Content-Type: multipart/alternative; boundary="edge"\r\n\r\n')
    end = F.lit("--edge--\r\n")
    html = part("text/html", F.col("html"))
    bodies = tb.pick(
        number % 3,
        [
            F.concat(F.lit("Content-Type: text/plain; charset=utf-8\r\n\r\n"), F.col("url")),
            F.concat(multi, html, part("text/plain", F.col("url")), end),
            F.concat(multi, html, end),
        ],
    )
    pages = tb.spread(tb.table(spark, sf, "pages"), "page_id")
    messages = pages.select("page_id", F.encode(F.concat(head, bodies), "UTF-8").alias("content"))
    parsed = files.parse_rfc822(messages)
    return parsed.select("page_id", "sender", "subject", "email_date", "body")


@query(
    "incremental_since",
    tb.sql(tb.BASE, tb.MAILS, """
dated AS (SELECT email_id, email_date, lower(split_part(sender_email, '@', -1)) AS domain,
  extracted_timestamp < now.t - INTERVAL 24 HOUR AS done FROM mails, now),
marks AS (SELECT domain AS marked, email_date AS mark_date, email_id AS mark_id FROM dated WHERE done AND email_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY domain ORDER BY email_date DESC, email_id DESC) = 1)""",
           select="""
SELECT email_id, email_date, domain FROM dated LEFT JOIN marks ON marked IS NOT DISTINCT FROM domain
WHERE CASE WHEN email_date IS NULL THEN NOT done
  WHEN mark_date IS NULL THEN email_date > (SELECT max(email_date) FROM mails) - INTERVAL 7 DAY
  ELSE email_date > mark_date OR (email_date = mark_date AND email_id > mark_id) END
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY email_date NULLS LAST, email_id) <= 5"""),
)
def incremental_since(spark, sf):
    """The next five mails per domain after what was processed a day ago."""
    mails = tb.mails(spark, sf)
    now = mails.select(F.max("extracted_timestamp")).scalar()
    processed = mails.filter(F.col("extracted_timestamp") < ago(now, hours=24))
    fresh = pull.incremental_since(mails, processed, fallback_days=7, limit=5)
    return fresh.select("email_id", "email_date", "domain")


@query(
    "filter_domain",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, sender_email FROM mails
WHERE lower(split_part(sender_email, '@', -1)) IN ('src1.example.com', 'src7.example.com')"""),
)
def filter_domain(spark, sf):
    """Mails of two sender domains, senders given with a display name."""
    named = F.concat(F.lit("Some One <"), F.col("sender_email"), F.lit(">"))
    mails = tb.mails(spark, sf).withColumn("plain", F.col("sender_email")).withColumn("sender_email", named)
    kept = pull.filter_domain(mails, ["SRC1.example.com", "src7.example.com"])
    return kept.select("email_id", F.col("plain").alias("sender_email"))


@query(
    "filter_mail",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id FROM mails
WHERE regexp_matches(lower(concat_ws(' ', subject, email_body)), 'urgent|license|asap')
  AND NOT regexp_matches(lower(concat_ws(' ', subject, email_body)), 'idiot|newsletter')
  AND email_date >= (SELECT max(email_date) FROM mails) - INTERVAL 2 DAY AND has_attachments"""),
)
def filter_mail(spark, sf):
    """Keyword, age and attachment filters together."""
    kept = pull.filter_mail(
        tb.mails(spark, sf), ["urgent", "license", "asap"], ["idiot", "newsletter"], 2, True
    )
    return kept.select("email_id")


@query(
    "filter_mail_defaults",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id FROM mails
WHERE regexp_matches(lower(concat_ws(' ', subject, email_body)), 'meeting|urgent|action|deadline|project|client|demo')
  AND NOT regexp_matches(lower(concat_ws(' ', subject, email_body)), 'newsletter|unsubscribe|marketing|promotional')
  AND email_date >= (SELECT max(email_date) FROM mails) - INTERVAL 7 DAY"""),
)
def filter_mail_defaults(spark, sf):
    """The declared keyword lists and age."""
    kept = pull.filter_mail(
        tb.mails(spark, sf), values.INCLUDE_KEYWORDS, values.EXCLUDE_KEYWORDS, values.FILTER_DAYS
    )
    return kept.select("email_id")


@query(
    "truncate_body",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, length(email_body) AS n_before, length(substring(email_body, 1, 50000)) AS n_after FROM mails"""),
)
def truncate_body(spark, sf):
    """Bodies capped at the declared 50,000 characters."""
    mails = tb.mails(spark, sf).withColumn("whole", F.col("email_body"))
    capped = pull.truncate_body(mails, values.BODY_CAP)
    return capped.select(
        "email_id",
        F.length("whole").cast("bigint").alias("n_before"),
        F.length("email_body").cast("bigint").alias("n_after"),
    )


@query(
    "fetch_metrics",
    tb.sql(tb.BASE, select="""
SELECT source, 'GMAIL_FETCH_COUNT' AS metric_type, cast(count(*) AS DOUBLE) AS metric_value FROM base GROUP BY source
UNION ALL
SELECT source, 'GMAIL_FETCH_LATENCY',
  (epoch_us(max(upload_timestamp)) - epoch_us(min(upload_timestamp))) // 1000 / 1000.0::DOUBLE FROM base GROUP BY source"""),
)
def fetch_metrics(spark, sf):
    """Mails and seconds per fetch, one fetch per source."""
    return pull.fetch_metrics(tb.base(spark, sf), ["source"], "upload_timestamp", "upload_timestamp")


@query(
    "with_id",
    tb.sql(tb.BASE, select="""
SELECT doc_id, concat('EMAIL_', sha256(concat_ws('␟', doc_id, body))) AS row_id FROM base"""),
)
def with_id(spark, sf):
    """Row ids from the content."""
    return landing.with_id(tb.base(spark, sf), "EMAIL_", ["doc_id", "body"]).select("doc_id", "row_id")


DOMAINS = ["src1.example.com", "src2.example.com", "nobody.example.com"]


@query(
    "domain_totals",
    tb.sql(tb.BASE, tb.MAILS, """
listed(domain) AS (VALUES ('src1.example.com'), ('src2.example.com'), ('nobody.example.com')),
per AS (SELECT l.domain, count(m.email_id) AS mails FROM listed l
  LEFT JOIN mails m ON lower(split_part(m.sender_email, '@', -1)) = l.domain GROUP BY l.domain)""",
           select="""
SELECT domain, mails FROM per UNION ALL SELECT 'ALL', cast(sum(mails) AS BIGINT) FROM per"""),
)
def domain_totals(spark, sf):
    """Mails per configured domain and in total."""
    return pull.domain_totals(tb.mails(spark, sf), DOMAINS)
