"""Streaming queries: parse, enrich, alert, health counts, deduplication.

Each query has its own checkpoint.  ``every`` is a trigger interval such as
``"1 minute"``; without it a query works off what is there and ends, and does
nothing when nothing is new.  One query hands its rows to the next by the log of
committed batches (see ``sources.landing``): a reader takes whole batches, and never the
files of a write that failed.  A replayed batch finds its entry in the log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from mailflow import values
from mailflow.operators import alerts, dedupe, enrich, parse, quality
from mailflow.plans import jobs
from mailflow.session import settings
from mailflow.sources import files, landing

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


@dataclass(frozen=True)
class Feed:
    """Rows to work off batch by batch: a stream, and how its batches become rows."""

    stream: DataFrame
    rows: Callable[[DataFrame], DataFrame]

    def filter(self, condition: Column) -> "Feed":
        return replace(self, rows=lambda batch: self.rows(batch).filter(condition))


def commits(spark: SparkSession, table_dir: str, schema, batches_per_trigger: int = 100) -> Feed:
    """New committed batches of a table written by ``landing``."""
    entries = (
        spark.readStream.schema(landing.COMMIT)
        .option("maxFilesPerTrigger", batches_per_trigger)
        .json(landing.commits_dir(table_dir))
    )

    def rows(batch: DataFrame) -> DataFrame:
        folders = sorted(r.folder for r in batch.collect())  # batches_per_trigger entries at most
        return landing.read_folders(batch.sparkSession, table_dir, folders, schema)

    return Feed(entries, rows)


def for_each_batch(
    source: DataFrame | Feed, write: Callable[[DataFrame, int], None], checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    feed = source if isinstance(source, Feed) else Feed(source, lambda batch: batch)
    writer = feed.stream.writeStream.foreachBatch(lambda batch, n: write(feed.rows(batch), n))
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def append_to(
    stream: DataFrame, table_dir: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to a parquet folder, each row exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def folder_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """New parquet files of a folder whose files appear whole, such as the sink of
    ``append_to`` or a batch that is written; for the queries that keep state."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def intervals(query: StreamingQuery) -> list[dict]:
    """What each interval of a query did: batch, start, rows read.  Intervals in which
    nothing was new have no batch and are left out; Spark keeps the last hundred."""
    return [
        {"batch_id": p["batchId"], "started": p["timestamp"], "rows_read": p["numInputRows"]}
        for p in query.recentProgress
        if p["numInputRows"] > 0
    ]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _log_batch(
    outcomes: DataFrame, job_type: str, started: datetime, jobs_dir: str, batch_id: int
) -> None:
    """Run record of one micro-batch."""
    record = jobs.job_record(outcomes, job_type, started, _now(), run=str(batch_id))
    landing.write_batch(record, jobs_dir, f"{job_type}-{batch_id}")


def stream_land(
    raw: DataFrame, raw_dir: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """New files into the raw table, one row per mail."""

    def write(batch: DataFrame, batch_id: int) -> None:
        mails = files.explode_mail_batch(batch)
        text = landing.kept_text(F.col("file_content"), F.col("file_text"))
        landing.write_batch(mails.withColumn("file_text", text), raw_dir, batch_id)

    return for_each_batch(raw, write, checkpoint, every)


def stream_parse(
    raw: DataFrame | Feed, mails_dir: str, jobs_dir: str, checkpoint: str, every: str | None = None,
    keep: list[str] | None = None, **options,
) -> StreamingQuery:
    """New PENDING files into the mail table, with a run record per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = _now()
        due = batch.filter(F.col("processing_status") == values.PENDING)
        parsed = parse.parse_mail(due, keep=keep, **options).withColumn(
            "extracted_timestamp", F.current_timestamp().cast("timestamp_ntz")
        )
        stored = landing.write_batch(parsed, mails_dir, batch_id)
        _log_batch(stored, values.JOB_REALTIME, started, jobs_dir, batch_id)

    return for_each_batch(raw, write, checkpoint, every)


def stream_enrich(
    mails: DataFrame | Feed, summaries_dir: str, classes_dir: str, jobs_dir: str, checkpoint: str,
    every: str | None = None, first_chars: int | None = None,
    analyse: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """BRIEF and SENTIMENT rows and the class of new mails that have a body.

    ``analyse`` may replace ``enrich.analyze_realtime`` by a model of one's own, with the
    same columns and, if it can fail, an ``error_message``.  A mail that lacks its BRIEF
    or has an error counts as failed in the run record and gets no summary rows.
    """
    analyse = analyse or (lambda batch: enrich.analyze_realtime(batch, first_chars))

    def write(batch: DataFrame, batch_id: int) -> None:
        started = _now()
        analysed = landing.write_batch(analyse(batch), classes_dir, batch_id)
        error = F.col("error_message") if "error_message" in analysed.columns else F.lit(None)
        failed = F.col("brief").isNull() | error.isNotNull()
        tall = enrich.summary_rows(analysed.filter(~failed), enrich.REALTIME_COLUMNS, F.current_timestamp())
        landing.write_batch(tall, summaries_dir, batch_id)
        status = F.when(failed, values.FAILED).otherwise(values.COMPLETED)
        _log_batch(analysed.select(status.alias("status")), values.JOB_REALTIME_AI, started, jobs_dir, batch_id)

    return for_each_batch(mails, write, checkpoint, every)


def stream_alerts(
    mails: DataFrame | Feed, alerts_dir: str, checkpoint: str, every: str | None = None, patterns=None
) -> StreamingQuery:
    """Alert rows of new urgent mails: a stateless filter and projection."""
    if isinstance(mails, Feed):
        write = lambda batch, n: landing.write_batch(alerts.urgent_alerts(batch, patterns), alerts_dir, n)
        return for_each_batch(mails, write, checkpoint, every)
    return append_to(alerts.urgent_alerts(mails, patterns), alerts_dir, checkpoint, every)


def _keep_state_on_disk(spark: SparkSession) -> None:
    """Stateful queries keep their state in RocksDB, so it may outgrow memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def health_windows(raw: DataFrame, window: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Uploads and failures per time window of the upload time."""
    timed = raw.withColumn("_at", F.col("upload_timestamp").cast("timestamp"))
    timed = timed.withWatermark("_at", watermark) if raw.isStreaming else timed
    return (
        timed.groupBy(F.window("_at", window).alias("w"))
        .agg(
            F.count("*").alias("files_uploaded"),
            F.count_if(F.col("processing_status") == values.FAILED).alias("failed_files"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "files_uploaded", "failed_files",
        )
    )


def stream_health(
    raw: DataFrame, health_dir: str, checkpoint: str, window: str = "30 minutes",
    watermark: str = "1 hour", every: str | None = None,
) -> StreamingQuery:
    """Windowed health counts; a window is written once the watermark passed it."""
    _keep_state_on_disk(raw.sparkSession)
    return append_to(health_windows(raw, window, watermark), health_dir, checkpoint, every)


def stream_dedupe(
    mails: DataFrame, keys: list[str], time_col: str, table_dir: str, checkpoint: str,
    watermark: str = "7 days", every: str | None = None,
) -> StreamingQuery:
    """The first mail per key; copies that follow within the watermark are dropped.

    Each task drops the copies it reads itself, so a key with very many copies meets its
    one state entry with a row per task.  The state holds one entry per key, by a digest
    of the keys, and forgets it when the watermark has passed.  Mails without any of the
    keys are only dropped when they are equal in every column.
    """
    _keep_state_on_disk(mails.sparkSession)
    no_key = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNull()
    whole = F.when(no_key, F.struct(*mails.columns))
    digest = F.sha2(F.to_json(F.struct(F.struct(*keys).alias("keys"), whole.alias("whole")), {"ignoreNullFields": "false"}), 256)
    marked = mails.withColumn("_key", digest)
    cut = marked.mapInArrow(first_in_task, marked.schema)
    timed = cut.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", watermark)
    first = timed.dropDuplicatesWithinWatermark(["_key"]).drop("_at", "_key")
    return append_to(first, table_dir, checkpoint, every)


def first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ``_key`` the task has not met before; 32 bytes are kept per key."""
    met: set[bytes] = set()
    for batch in batches:
        fresh = []
        for key in batch.column("_key").to_pylist():
            code = bytes.fromhex(key)
            fresh.append(code not in met)
            met.add(code)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def finish(query: StreamingQuery, timeout: int = 3600) -> None:
    """Wait for a query that works off what is there."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query did not end within {timeout} s")


def run_chain(spark: SparkSession, path: str, out: str, timeout: int = 3600) -> dict[str, DataFrame]:
    """Files → raw table → mails → enrichment and alerts, on what is new.

    Calling it again with the same ``out`` works off the files added since.
    Returns the tables, and over all batches so far: ``files``, the raw files with their
    status after parsing; ``invalid``, the mails that break a rule, with the rules;
    ``unique``, the earliest mail of each content.
    """
    tables = {n: f"{out}/{n}" for n in ("raw", "mails", "classes", "summaries", "alerts", "jobs")}
    mark = {n: f"{out}/_checkpoints/{n}" for n in tables}

    for folder in tables.values():
        landing.make_table(spark, folder)

    source = files.stream_raw_files(spark, path)
    raw_schema = files.explode_mail_batch(source).schema
    with settings(spark, files.small_files(spark)):
        finish(stream_land(source, tables["raw"], mark["raw"]), timeout)

    raw = commits(spark, tables["raw"], raw_schema)
    carried = ["file_name"]
    no_mail = parse.parse_mail(spark.createDataFrame([], raw_schema), keep=carried).withColumn(
        "extracted_timestamp", F.current_timestamp().cast("timestamp_ntz")
    )
    finish(
        stream_parse(raw, tables["mails"], tables["jobs"], mark["mails"], keep=carried), timeout
    )

    mails = commits(spark, tables["mails"], no_mail.schema).filter(F.col("status") == values.COMPLETED)
    both = [
        stream_enrich(
            mails, tables["summaries"], tables["classes"], tables["jobs"], mark["classes"]
        ),
        stream_alerts(mails, tables["alerts"], mark["alerts"]),
    ]
    for query in both:
        finish(query, timeout)
    no_class = enrich.analyze_realtime(no_mail)
    schemas = {
        "raw": raw_schema,
        "mails": no_mail.schema,
        "classes": no_class.schema,
        "summaries": enrich.summary_rows(no_class, enrich.REALTIME_COLUMNS).schema,
        "alerts": alerts.urgent_alerts(no_mail).schema,
        "jobs": jobs.job_record(no_mail, "", _now(), _now()).schema,
    }
    stored = {
        name: landing.read_table(spark, folder, schemas[name]) for name, folder in tables.items()
    }
    outcomes = stored["mails"].select("file_id", "status", "error_message")
    done = stored["mails"].filter(F.col("status") == values.COMPLETED)
    return {
        **stored,
        "files": parse.apply_status(stored["raw"], outcomes),
        "invalid": quality.invalid_mail(done),
        "unique": dedupe.dedupe_exact(done),
    }
