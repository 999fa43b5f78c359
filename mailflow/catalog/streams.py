"""Streaming queries run over what is there; their sinks must equal the batch
results."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.catalog.enrichment import ALERTS, REALTIME, REALTIME_CTES, class_sql
from mailflow.catalog.ingest import ITEM_MAILS, item_files, item_number, write_files
from mailflow.catalog.parsing import ALL_SHAPES
from mailflow.catalog.registry import query
from mailflow.catalog.views import URGENT
from mailflow.functions import ids
from mailflow.operators import enrich, parse
from mailflow.session import work_dir
from mailflow.sources import files, landing
from mailflow.streaming import queries as st

BATCHES = 3
FILES_PER_TRIGGER = 3


def _stored(spark, rows, name: str):
    """Rows as a table of several committed batches, beside a write that failed before
    its commit, and the feed of the batches, one at a time."""
    folder = work_dir(spark, name)
    part = F.pmod(F.xxhash64(rows.columns[0]), F.lit(BATCHES))
    for n in range(BATCHES):
        landing.write_batch(rows.filter(part == n), folder, n)
    rows.filter(part == 0).write.parquet(f"{folder}/data/in_batch=failed")
    return st.commits(spark, folder, rows.schema, 1)


def _raw_stream(spark, sf, name):
    rows = tb.raw(spark, sf).select(
        "file_id", "file_name", "upload_timestamp", "file_text", "processing_status"
    )
    return _stored(spark, rows, name)


def _mail_stream(spark, sf, name):
    rows = tb.mails(spark, sf).select("email_id", "sender_email", "subject", "email_body")
    return _stored(spark, rows, name)


@query("stream_files", ITEM_MAILS)
def stream_files(spark, sf):
    """New JSON files as a stream."""
    folder = item_files(spark, sf, "new-files")
    raw = files.stream_raw_files(spark, folder, files_per_trigger=100)
    out = work_dir(spark, "streamed-files")
    parsed = parse.parse_mail(raw, keep=["file_text"])
    st.finish(st.append_to(parsed, f"{out}/t", f"{out}/c"))
    return spark.read.schema(parsed.schema).parquet(f"{out}/t").select(
        item_number().alias("item_id"), "sender_email", "email_body", "status"
    )


def _parsed_stream(spark, sf, name):
    out = work_dir(spark, name)
    raw = _raw_stream(spark, sf, f"{name}-source")
    st.finish(st.stream_parse(raw, f"{out}/mails", f"{out}/jobs", f"{out}/c", keep=["file_name"]))
    return out


@query(
    "stream_parse",
    tb.sql(tb.BASE, tb.RAW, select=f"""
SELECT p.file_id, p.email_format, p.sender_email, p.subject, p.email_body, p.email_date, p.status
FROM ({ALL_SHAPES}) p JOIN raw USING (file_id) WHERE processing_status = 'PENDING'"""),
)
def stream_parse(spark, sf):
    """Pending files parsed in micro-batches."""
    out = _parsed_stream(spark, sf, "stream-parse")
    return landing.read_table(spark, f"{out}/mails").select(
        "file_id", "email_format", "sender_email", "subject", "email_body", "email_date", "status"
    )


@query(
    "stream_intervals",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT 1 AS run, count(DISTINCT r.file_id) > 0 AS worked, count(*) AS rows_parsed FROM raw r WHERE processing_status = 'PENDING'
UNION ALL SELECT 2, false, 0
UNION ALL SELECT 3, true, count(*) FROM raw WHERE processing_status = 'PENDING' AND doc_id % 5 = 0"""),
)
def stream_intervals(spark, sf):
    """Three runs of one query: all files, nothing new, and a fifth of them again."""
    rows = tb.raw(spark, sf).select("file_id", "file_name", "upload_timestamp", "file_text", "processing_status", "doc_id")
    folder, out = work_dir(spark, "interval-source"), work_dir(spark, "intervals")
    seen, done = 0, []
    for run, new in enumerate([rows, None, rows.filter("doc_id % 5 = 0")], 1):
        if new is not None:
            landing.write_batch(new.drop("doc_id"), folder, run)
        feed = st.commits(spark, folder, new.drop("doc_id").schema if new is not None else rows.drop("doc_id").schema, 1)
        query = st.stream_parse(feed, f"{out}/mails", f"{out}/jobs", f"{out}/c")
        st.finish(query)
        parsed = landing.read_table(spark, f"{out}/mails").count()
        done.append((run, len(st.intervals(query)) > 0, parsed - seen))
        seen = parsed
    return spark.createDataFrame(done, "run int, worked boolean, rows_parsed bigint")


@query(
    "stream_job_log",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT 'REALTIME_PROCESSING' AS job_type, count(*) FILTER (has_content) AS files_processed,
  count(*) FILTER (NOT has_content) AS files_failed
FROM raw WHERE processing_status = 'PENDING'"""),
)
def stream_job_log(spark, sf):
    """Run records of the micro-batches, summed up."""
    out = _parsed_stream(spark, sf, "stream-jobs")
    return landing.read_table(spark, f"{out}/jobs").groupBy("job_type").agg(
        F.sum("files_processed").alias("files_processed"), F.sum("files_failed").alias("files_failed")
    )


@query(
    "stream_enrich",
    tb.sql(*REALTIME_CTES, select=f"""
SELECT email_id, summary_type, summary_text, email_classification FROM (
  SELECT email_id, 'BRIEF' AS summary_type, brief AS summary_text, email_classification FROM ({REALTIME})
  UNION ALL SELECT email_id, 'SENTIMENT', sentiment, email_classification FROM ({REALTIME}))"""),
)
def stream_enrich(spark, sf):
    """New mails summarised and classified in micro-batches."""
    mails = _mail_stream(spark, sf, "enrich-source")
    out = work_dir(spark, "stream-enrich")
    st.finish(st.stream_enrich(mails, f"{out}/s", f"{out}/k", f"{out}/jobs", f"{out}/c"))
    classes = landing.read_table(spark, f"{out}/k").select("email_id", "email_classification")
    rows = landing.read_table(spark, f"{out}/s").select("email_id", "summary_type", "summary_text")
    return rows.join(classes, "email_id")


@query("stream_alerts", tb.sql(tb.BASE, tb.MAILS, select=ALERTS))
def stream_alerts(spark, sf):
    """Alerts on new mails."""
    mails = _mail_stream(spark, sf, "alert-source")
    out = work_dir(spark, "stream-alerts")
    st.finish(st.stream_alerts(mails, f"{out}/t", f"{out}/c"))
    return landing.read_table(spark, f"{out}/t").withColumn(
        "urgency_indicators", F.array_join("urgency_indicators", ",")
    )


@query(
    "stream_health",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, count(*) AS files_uploaded,
  count(*) FILTER (processing_status = 'FAILED') AS failed_files
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, upload_timestamp) AS window_start FROM raw), as_of
GROUP BY window_start, t HAVING window_start + INTERVAL 30 MINUTE <= date_trunc('milliseconds', t - INTERVAL 1 HOUR)"""),
)
def stream_health(spark, sf):
    """Counts per half hour; windows the watermark has not passed are open."""
    raw = tb.raw(spark, sf).select("upload_timestamp", "processing_status")
    folder = work_dir(spark, "health-source")
    raw.repartitionByRange(4, "upload_timestamp").write.parquet(folder)
    stream = st.folder_stream(spark, folder, raw.schema, 1000)
    out = work_dir(spark, "stream-health")
    st.finish(st.stream_health(stream, f"{out}/t", f"{out}/c"))
    return spark.read.schema(st.health_windows(raw).schema).parquet(f"{out}/t")


@query(
    "stream_dedupe",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT DISTINCT sha256(email_body) AS content FROM mails WHERE email_body IS NOT NULL"""),
)
def stream_dedupe(spark, sf):
    """One mail per content, in micro-batches."""
    rows = tb.mails(spark, sf).filter(F.col("email_body").isNotNull()).select(
        ids.content_hash(F.col("email_body")).alias("content"), "extracted_timestamp"
    )
    folder = work_dir(spark, "dedupe-source")
    rows.repartition(3 * FILES_PER_TRIGGER).write.parquet(folder)
    stream = st.folder_stream(spark, folder, rows.schema, FILES_PER_TRIGGER)
    out = work_dir(spark, "stream-dedupe")
    st.finish(
        st.stream_dedupe(stream, ["content"], "extracted_timestamp", f"{out}/t", f"{out}/c", "60 days")
    )
    return spark.read.schema(rows.schema).parquet(f"{out}/t").select("content")


CHAIN = [
    """
page_mails AS (
  SELECT page_id, 0 AS place, concat('page ', page_id) AS subject,
    concat(CASE WHEN page_id % 5 = 0 THEN 'Urgent: asap. ' ELSE 'Note. ' END, html) AS email_body FROM pages
  UNION ALL SELECT page_id, 1, concat('reply ', page_id), html FROM pages WHERE page_id % 2 = 0
), mails AS (SELECT *, concat(page_id, '-', place) AS email_id FROM page_mails)""",
    class_sql(enrich.CLASS_RULES),
]


@query(
    "mail_chain",
    tb.sql(*CHAIN, select=f"""
SELECT page_id, place, subject, email_classification, {URGENT} AS alerted FROM mails JOIN classes USING (email_id)"""),
)
def mail_chain(spark, sf):
    """Files, raw table, mails, enrichment and alerts in one go: a file per page with its
    whole HTML, as one mail or an array of two."""
    number = F.col("page_id").cast("string")

    def mail(subject, body):
        return F.struct(
            F.lit("robot@example.com").alias("sender"),
            F.concat(F.lit(subject), number).alias("subject"),
            body.alias("email_text"),
        )

    flagged = F.when(F.col("page_id") % 5 == 0, "Urgent: asap. ").otherwise("Note. ")
    first = mail("page ", F.concat(flagged, F.col("html")))
    reply = mail("reply ", F.col("html"))
    content = F.when(F.col("page_id") % 2 == 0, F.to_json(F.array(first, reply))).otherwise(F.to_json(first))
    pages = tb.table(spark, sf, "pages").select(content.alias("value"))
    folder = write_files(pages, work_dir(spark, "chain-files"))
    tables = st.run_chain(spark, folder, work_dir(spark, "chain"))
    alerted = tables["alerts"].select("email_id", F.lit(True).alias("alerted"))
    mails = tables["mails"].filter(F.col("status") == values.COMPLETED)
    page = F.regexp_extract("subject", "([0-9]+)$", 1).cast("bigint")
    return (
        mails.join(tables["classes"].select("email_id", F.col("email_classification").alias("klass")), "email_id")
        .join(alerted, "email_id", "left")
        .select(
            page.alias("page_id"),
            F.when(F.col("subject").startswith("reply"), 1).otherwise(0).alias("place"),
            "subject",
            F.col("klass").alias("email_classification"),
            F.coalesce("alerted", F.lit(False)).alias("alerted"),
        )
    )
