"""Mail tables made from the given tables, for Spark and as SQL.

``base`` joins documents with their events: the document is the mail's text, one of its
events gives the mail's time, sender and state.  From it come raw files
(payloads in every format), mails and summaries; orders and their line items are
the job log.  Tables are built once per session and folder: what is kept is the
plan, never data.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailflow import values
from mailflow.session import spread


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(number: Column, options: list) -> Column:
    """Option by number: pick(n, [a, b]) is a for 0 and b otherwise."""
    case = F.lit(options[-1])
    for i, option in reversed(list(enumerate(options[:-1]))):
        case = F.when(number == i, option).otherwise(case)
    return case


@lru_cache(maxsize=64)
def base(spark: SparkSession, sf: str) -> DataFrame:
    """Mails as one flat table: a document and, of all its events, the one of the
    highest value.  Events belong to the document of their number modulo the number of
    documents, so that every event takes part."""
    documents = table(spark, sf, "documents")
    # starts of texts are cut before the join, so that queries without a body shuffle no texts
    starts = [F.substring("text", 1, 40).alias("head"), F.substring("text", 1, 240).alias("start")]
    documents = documents.select("doc_id", "text", "lang", "source", *starts)
    size = documents.select(F.max("doc_id") + 1).scalar()
    event = F.struct("value", "event_id", "ts", "user_id", "event_type")
    events = (
        table(spark, sf, "events").groupBy((F.col("event_id") % size).alias("doc_id"))
        .agg(F.max(event).alias("_e")).select("doc_id", "_e.ts", "_e.user_id", "_e.event_type")
    )
    rows = spread(documents, "doc_id").join(events, "doc_id")
    kind, text = F.col("event_type"), F.col("text")
    address = F.concat(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("@"), F.col("source"),
        F.lit(".example.com"),
    )
    hasty = lambda t: F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("Please act immediately. "), t)).otherwise(t)
    prefix = F.when(kind == "error", "URGENT: ").when(kind == "purchase", "asap ").otherwise("")
    return rows.select(
        "doc_id",
        (F.col("doc_id") % 7).alias("fmt_no"),
        "source",
        "lang",
        F.col("ts").alias("upload_timestamp"),
        F.when(F.col("doc_id") % 13 != 0, address).alias("sender"),
        F.concat(prefix, "head").alias("subject"),
        hasty(text).alias("body"),
        hasty(F.col("start")).alias("opening"),
        F.when(kind == "error", values.FAILED)
        .when(kind == "signup", values.PENDING)
        .otherwise(values.COMPLETED)
        .alias("processing_status"),
    )


def _base_sql(rows: str) -> str:
    return f"""
base AS (
  SELECT doc_id, doc_id % 7 AS fmt_no, source, lang, ts AS upload_timestamp,
    CASE WHEN doc_id % 13 = 0 THEN NULL
         ELSE concat('user', cast(user_id AS VARCHAR), '@', source, '.example.com') END AS sender,
    concat(CASE event_type WHEN 'error' THEN 'URGENT: ' WHEN 'purchase' THEN 'asap ' ELSE '' END,
           substring(text, 1, 40)) AS subject,
    CASE WHEN doc_id % 11 = 0 THEN concat('Please act immediately. ', text) ELSE text END AS body,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'COMPLETED' END
      AS processing_status
  FROM ({rows})
)"""


BASE = _base_sql("""
    SELECT d.*, e.ts, e.user_id, e.event_type FROM documents d JOIN (
      SELECT event_id % (SELECT max(doc_id) + 1 FROM documents) AS doc_id, ts, user_id, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY event_id % (SELECT max(doc_id) + 1 FROM documents)
        ORDER BY value DESC NULLS LAST, event_id DESC) = 1) e USING (doc_id)""")


# --- raw files --------------------------------------------------------------

NAMES = ["gmail_", "simple_", "campaign_", "exchange_", "note_", "plain_", "other_"]


def iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def api_json(b: DataFrame, body: Column | None = None) -> Column:
    """A mail-API payload; NULL fields are left out."""
    headers = F.array(
        F.struct(F.lit("From").alias("name"), F.col("sender").alias("value")),
        F.struct(
            F.lit("To").alias("name"),
            F.concat(F.lit("team@"), F.col("source"), F.lit(".example.com, desk@example.com")).alias("value"),
        ),
        F.struct(F.lit("Subject").alias("name"), F.col("subject").alias("value")),
    )
    data = F.struct((F.col("body") if body is None else body).alias("data"))
    part = F.struct(F.lit("text/plain").alias("mimeType"), data.alias("body"))
    millis = F.unix_millis(F.col("upload_timestamp").cast("timestamp"))
    return F.to_json(
        F.struct(
            F.lit(values.API).alias("email_type"),
            F.struct(headers.alias("headers"), F.array(part).alias("parts")).alias("payload"),
            millis.cast("string").alias("internalDate"),
            F.concat(F.lit("t"), (F.col("doc_id") % 50).cast("string")).alias("threadId"),
            F.concat(F.lit("m"), F.floor(F.col("doc_id") / 2).cast("string")).alias("messageId"),
        )
    )


def simple_json(tag: str | None) -> Column:
    attachment = F.struct(
        F.concat(F.lit("file"), F.col("doc_id").cast("string")).alias("name"),
        (F.col("doc_id") * 10).alias("size"),
    )
    fields = [
        F.col("sender").alias("sender"),
        F.array(F.concat(F.lit("team@"), F.col("source"), F.lit(".example.com")), F.lit("desk@example.com"))
        .alias("recipients"),
        F.col("subject"),
        iso(F.col("upload_timestamp")).alias("email_date"),
        F.col("body").alias("email_text"),
        F.array(attachment).alias("attachments"),
        F.lit("normal").alias("priority"),
    ]
    if tag:
        fields.insert(0, F.lit(tag).alias("email_type"))
    if tag == values.MARKETING:
        fields.append(F.lit("campaign").alias("campaign_id"))
    return F.to_json(F.struct(*fields))


def exchange_json() -> Column:
    return F.to_json(
        F.struct(
            F.lit("IPM.Note").alias("MessageClass"),
            F.col("sender").alias("SenderEmailAddress"),
            F.lit("desk@example.com").alias("ToRecipients"),
            F.col("subject").alias("Subject"),
            F.col("body").alias("Body"),
            iso(F.col("upload_timestamp")).alias("DateTimeReceived"),
        )
    )


def raw_text_json() -> Column:
    return F.to_json(F.struct(F.col("body").alias("raw_text")))


def unknown_json() -> Column:
    return F.to_json(F.struct(F.col("doc_id")))


def flat_json() -> Column:
    return F.to_json(
        F.struct(
            F.col("doc_id").cast("string").alias("id"),
            F.col("sender"),
            F.when(F.col("doc_id") % 5 != 0, F.col("subject")).alias("subject"),
            F.col("body"),
            F.unix_millis(F.col("upload_timestamp").cast("timestamp")).cast("string").alias("timestamp"),
        )
    )


def payload_text(b: DataFrame) -> Column:
    """Payload text in the row's format; some are cut off, some are missing."""
    by_format = pick(
        F.col("fmt_no"),
        [
            api_json(b), simple_json(values.SIMPLE), simple_json(values.MARKETING),
            exchange_json(), raw_text_json(), simple_json(None), unknown_json(),
        ],
    )
    return F.when(
        F.col("doc_id") % 17 == 0, F.concat(F.lit('{"email_text": "'), F.col("lang"))
    ).when(F.col("doc_id") % 19 != 0, by_format)


def file_id() -> Column:
    return F.concat(F.lit("F"), F.col("doc_id").cast("string"))


def raw_from(b: DataFrame, text: Column) -> DataFrame:
    number = F.col("doc_id").cast("string")
    return b.select(
        file_id().alias("file_id"),
        F.concat(pick(F.col("fmt_no"), NAMES), number, F.lit(".json")).alias("file_name"),
        "upload_timestamp",
        text.alias("file_text"),
        "processing_status",
        F.when(
            F.col("processing_status") == values.FAILED, F.concat(F.lit("cannot read "), F.col("lang"))
        ).alias("error_message"),
        "doc_id",
    )


@lru_cache(maxsize=64)
def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw file table; the payload is composed here and parsed again."""
    b = base(spark, sf)
    return raw_from(b, payload_text(b)).withColumn("file_content", F.try_parse_json("file_text"))


RAW = """
raw AS (
  SELECT concat('F', doc_id) AS file_id,
    concat(CASE fmt_no WHEN 0 THEN 'gmail_' WHEN 1 THEN 'simple_' WHEN 2 THEN 'campaign_'
           WHEN 3 THEN 'exchange_' WHEN 4 THEN 'note_' WHEN 5 THEN 'plain_' ELSE 'other_' END,
           doc_id, '.json') AS file_name,
    upload_timestamp, processing_status,
    CASE WHEN processing_status = 'FAILED' THEN concat('cannot read ', lang) END AS error_message,
    doc_id % 17 <> 0 AND doc_id % 19 <> 0 AS has_content,
    CASE fmt_no WHEN 0 THEN 'gmail_api' WHEN 1 THEN 'simple_format' WHEN 2 THEN 'marketing'
         WHEN 3 THEN 'outlook_exchange' WHEN 4 THEN 'raw_text' WHEN 5 THEN 'simple_text'
         ELSE 'unknown' END AS label,
    doc_id
  FROM base
), as_of AS (SELECT max(upload_timestamp) AS t FROM raw)"""


# --- mails, summaries, jobs -------------------------------------------------


@lru_cache(maxsize=64)
def mails(spark: SparkSession, sf: str) -> DataFrame:
    """Processed mails: every file that did not fail; some have no body."""
    b, n = base(spark, sf), F.col("doc_id")
    none = F.lit(0)
    return b.filter(F.col("processing_status") != values.FAILED).select(
        F.concat(F.lit("M"), n.cast("string")).alias("email_id"),
        file_id().alias("file_id"),
        F.col("sender").alias("sender_email"),
        F.when(n % 23 != 0, F.col("subject")).alias("subject"),
        F.when(n % 29 != 0, F.col("body")).alias("email_body"),
        F.when(
            n % 31 != 0,
            F.col("upload_timestamp") - F.make_dt_interval(none, (n % 48).cast("int")),
        ).alias("email_date"),
        F.when(
            n % 2 == 0,
            F.array(F.struct(F.lit("a.pdf").alias("name"), n.alias("size"))),
        ).alias("attachments"),
        (F.col("upload_timestamp") + F.make_dt_interval(none, none, (n % 90).cast("int"))).alias(
            "extracted_timestamp"
        ),
        pick(n % 8, values.CLASSES).alias("email_classification"),
    )


MAILS = """
mails AS (
  SELECT concat('M', doc_id) AS email_id, concat('F', doc_id) AS file_id, sender AS sender_email,
    CASE WHEN doc_id % 23 <> 0 THEN subject END AS subject,
    CASE WHEN doc_id % 29 <> 0 THEN body END AS email_body,
    CASE WHEN doc_id % 31 <> 0 THEN upload_timestamp - to_hours(doc_id % 48) END AS email_date,
    doc_id % 2 = 0 AS has_attachments,
    upload_timestamp + to_minutes(doc_id % 90) AS extracted_timestamp,
    CASE doc_id % 8 WHEN 0 THEN 'URGENT' WHEN 1 THEN 'INFORMATIONAL' WHEN 2 THEN 'ACTION_REQUIRED'
      WHEN 3 THEN 'MEETING_REQUEST' WHEN 4 THEN 'MARKETING' WHEN 5 THEN 'SUPPORT'
      WHEN 6 THEN 'PERSONAL' ELSE 'OTHER' END AS email_classification,
    doc_id
  FROM base WHERE processing_status <> 'FAILED'
), now AS (SELECT max(extracted_timestamp) AS t FROM mails)"""


@lru_cache(maxsize=64)
def summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Four summary rows per COMPLETED mail; SENTIMENT only where labelled."""
    labels = table(spark, sf, "labels").select(
        "doc_id", (F.col("quality") - F.col("toxic")).cast("string").alias("feeling")
    )
    b = base(spark, sf).filter(F.col("processing_status") == values.COMPLETED)
    with_label = b.join(labels, "doc_id", "left")
    kinds = F.array(*[F.lit(kind) for kind in values.SUMMARY_TYPES])
    kind, number = F.col("summary_type"), F.col("doc_id").cast("string")
    tall = with_label.select(
        "doc_id", "upload_timestamp", "opening", "feeling", F.explode(kinds).alias("summary_type")
    ).filter((kind != values.SENTIMENT) | F.col("feeling").isNotNull())
    text = (
        F.when(kind == values.BRIEF, F.substring("opening", 1, 80))
        .when(kind == values.DETAILED, F.substring("opening", 1, 240))
        .when(kind == values.ACTION_ITEMS, "none")
        .otherwise(F.col("feeling"))
    )
    return tall.select(
        F.concat(F.lit("S"), number, F.lit("-"), kind).alias("summary_id"),
        F.concat(F.lit("M"), number).alias("email_id"),
        "summary_type",
        text.alias("summary_text"),
        ((F.col("doc_id") % 100) / 100).alias("confidence_score"),
        (F.col("upload_timestamp") + F.make_dt_interval(F.lit(0), F.lit(2))).alias("created_timestamp"),
    )


SUMMARIES = """
summaries AS (
  SELECT concat('S', doc_id, '-', summary_type) AS summary_id, concat('M', doc_id) AS email_id,
    summary_type, summary_text, (doc_id % 100) / 100 AS confidence_score,
    upload_timestamp + to_hours(2) AS created_timestamp
  FROM (
    SELECT b.doc_id, b.upload_timestamp, 'BRIEF' AS summary_type, substring(b.body, 1, 80) AS summary_text
    FROM base b WHERE b.processing_status = 'COMPLETED'
    UNION ALL
    SELECT doc_id, upload_timestamp, 'DETAILED', substring(body, 1, 240)
    FROM base WHERE processing_status = 'COMPLETED'
    UNION ALL
    SELECT doc_id, upload_timestamp, 'ACTION_ITEMS', 'none' FROM base WHERE processing_status = 'COMPLETED'
    UNION ALL
    SELECT b.doc_id, b.upload_timestamp, 'SENTIMENT', cast(l.quality - l.toxic AS VARCHAR)
    FROM base b JOIN labels l USING (doc_id) WHERE b.processing_status = 'COMPLETED'
  )
)"""

JOB_TYPES = [
    values.JOB_URGENT, values.JOB_REALTIME, values.JOB_BATCH, values.JOB_REALTIME_AI,
    values.JOB_SUMMARIZATION,
]


@lru_cache(maxsize=64)
def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Job log: an order is a run, its line items are the files processed."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("files_processed"))
    )
    n, state = F.col("o_orderkey"), F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    none = F.lit(0)
    start = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        -(n % 50).cast("int"), none, (n % 1440).cast("int")
    )
    status = (
        F.when(state == "F", values.COMPLETED).when(state == "O", values.RUNNING).otherwise(values.FAILED)
    )
    details = F.when(
        (state == "P") & (n % 2 == 0),
        F.concat(F.lit('{"error":"code '), (n % 5).cast("string"), F.lit('"}')),
    )
    runs = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("J"), n.cast("string")).alias("job_id"),
        pick(priority - 1, JOB_TYPES).alias("job_type"),
        start.alias("start_time"),
        (start + F.make_dt_interval(none, none, none, (n % 600).cast("decimal(18,6)"))).alias("end_time"),
        status.alias("status"),
        (n % 3).alias("files_failed"),
        details.alias("error_details"),
    )
    return runs.join(lines, "o_orderkey", "left").select(
        "job_id", "job_type", "start_time", "end_time", "status",
        F.coalesce("files_processed", F.lit(0)).alias("files_processed"), "files_failed",
        "error_details",
    )


JOBS = """
jobs AS (
  SELECT concat('J', o.o_orderkey) AS job_id,
    CASE substring(o.o_orderpriority, 1, 1) WHEN '1' THEN 'URGENT_ALERT' WHEN '2' THEN 'REALTIME_PROCESSING'
      WHEN '3' THEN 'BATCH_PROCESSING' WHEN '4' THEN 'REALTIME_AI_ANALYSIS' ELSE 'SUMMARIZATION' END AS job_type,
    TIMESTAMP '2024-01-03 00:00:00' - to_days(cast(o.o_orderkey % 50 AS INTEGER)) + to_minutes(o.o_orderkey % 1440) AS start_time,
    TIMESTAMP '2024-01-03 00:00:00' - to_days(cast(o.o_orderkey % 50 AS INTEGER)) + to_minutes(o.o_orderkey % 1440)
      + to_seconds(o.o_orderkey % 600) AS end_time,
    CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    coalesce(l.n, 0) AS files_processed, o.o_orderkey % 3 AS files_failed,
    CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0
         THEN concat('code ', o.o_orderkey % 5) END AS error
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l
    ON l.l_orderkey = o.o_orderkey
), job_now AS (SELECT max(start_time) AS t FROM jobs)"""


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select
