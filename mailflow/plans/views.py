"""Operational views.

Counts over one table are one conditional aggregate, so each table is read once
per view; the one-row results are put side by side as scalars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailflow import values
from mailflow.clock import ago, as_of_column, moment
from mailflow.functions import payload, urgency
from mailflow.operators.lookup import few


def _briefs(summaries: DataFrame, *more: str) -> DataFrame:
    return summaries.filter(F.col("summary_type") == values.BRIEF).select(
        "email_id", F.col("summary_text").alias("brief_summary"), *more
    )


def _newest(df: DataFrame, time_col: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(F.col(time_col).desc(), *ties).limit(n)


def processing_overview(
    raw: DataFrame, mails: DataFrame, summaries: DataFrame, ordered: bool = False
) -> DataFrame:
    """Every raw file with its mail and BRIEF where they exist, ``ordered`` newest first.

    Mails meet their BRIEF first, on an id that none lacks; files without a mail then
    have no missing key to meet on.
    """
    told = mails.select("file_id", "email_id", "subject", "sender_email", "email_date").join(
        _briefs(summaries, "confidence_score"), "email_id", "left"
    )
    view = (
        raw.select("file_id", "file_name", "upload_timestamp", "processing_status")
        .join(told, "file_id", "left")
        .select(
            "file_name", "upload_timestamp", "processing_status", "subject", "sender_email",
            "email_date", "brief_summary", "confidence_score",
        )
    )
    # The name breaks ties, so that very many equal times still split into ranges.
    newest = [F.col("upload_timestamp").desc(), "file_name"]
    return view.orderBy(*newest) if ordered else view


def summary_pivot(summaries: DataFrame) -> DataFrame:
    """The four summary types side by side, and the number of summaries."""

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("summary_type") == kind, F.col("summary_text")))

    return summaries.groupBy("email_id").agg(
        of(values.BRIEF).alias("brief_summary"),
        of(values.DETAILED).alias("detailed_summary"),
        of(values.ACTION_ITEMS).alias("action_items"),
        of(values.SENTIMENT).alias("sentiment_score"),
        F.count("summary_id").alias("total_summaries"),
    )


def ai_insights(mails: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every mail with its summaries; the summaries are pivoted before the join."""
    entities = ["extracted_entities"] if "extracted_entities" in mails.columns else []
    return (
        mails.select(
            "email_id", "subject", "sender_email", "email_date", "email_classification", *entities
        )
        .join(summary_pivot(summaries), "email_id", "left")
        .withColumn("total_summaries", F.coalesce("total_summaries", F.lit(0)))
    )


def _with_content(raw: DataFrame) -> DataFrame:
    column = "file_content" if "file_content" in raw.columns else "file_text"
    return raw.filter(F.col(column).isNotNull())


def processing_stats(raw: DataFrame) -> DataFrame:
    """File totals by state and the success rate in percent."""

    def state(name: str) -> Column:
        return F.count_if(F.col("processing_status") == name)

    counted = _with_content(raw).agg(
        F.count("*").alias("total_raw_files"),
        state(values.COMPLETED).alias("processed_files"),
        state(values.PENDING).alias("pending_files"),
        state(values.FAILED).alias("failed_files"),
    )
    rate = F.try_divide(F.col("processed_files") * F.lit(100.0), F.col("total_raw_files"))
    return counted.withColumn("processing_success_rate", F.round(rate, 2))


def format_counts(raw: DataFrame) -> DataFrame:
    return (
        _with_content(raw)
        .groupBy(payload.format_label(F.col("file_content")).alias("email_format"))
        .agg(F.count("*").alias("file_count"))
    )


def format_distribution(raw: DataFrame, ordered: bool = True) -> DataFrame:
    """Files per format and their share of all files."""
    counts = format_counts(raw)
    total = counts.agg(F.sum("file_count")).scalar()
    view = counts.withColumn(
        "percentage", F.round(F.col("file_count") * F.lit(100.0) / total, 2)
    )
    return view.orderBy(F.col("file_count").desc(), "email_format") if ordered else view


def format_stats(raw: DataFrame) -> DataFrame:
    """Files per format beside the total of all files, those without content
    included.  A row per format: types are whatever the payloads declare, so
    their number has no bound that would allow one object for all."""
    total = raw.select(F.count("*")).scalar()
    return format_counts(raw).withColumn("total_files", total)


def format_log(raw: DataFrame, as_of: Column) -> DataFrame:
    """Job-log rows of a format analysis, one per format."""
    details = F.struct(
        "total_files",
        F.struct(F.col("email_format").alias("format"), F.col("file_count").alias("files")).alias(
            "format_breakdown"
        ),
    )
    return format_stats(raw).select(
        F.concat_ws("_", F.lit(values.JOB_FORMATS), as_of.cast("string"), "email_format").alias("job_id"),
        F.lit(values.JOB_FORMATS).alias("job_type"),
        as_of.alias("start_time"),
        F.lit(values.COMPLETED).alias("status"),
        F.to_json(details).alias("error_details"),
    )


def system_health(
    raw: DataFrame, mails: DataFrame, summaries: DataFrame, as_of=None
) -> DataFrame:
    """One row: activity of the last 24 hours and ACTIVE/IDLE from the last.

    The three tables' times go through one aggregate, cut to the last day first.
    """
    now = as_of_column(raw, "upload_timestamp", as_of)
    day, hour = ago(now, hours=24), ago(now, hours=1)

    def recent(df: DataFrame, what: str, time_col: str, failed: Column) -> DataFrame:
        kept = df.filter(F.col(time_col) >= day)
        return kept.select(
            F.lit(what).alias("what"), F.col(time_col).alias("at"), failed.alias("failed")
        )

    is_failed = F.coalesce(F.col("processing_status") == values.FAILED, F.lit(False))
    events = (
        recent(raw, "file", "upload_timestamp", is_failed)
        .unionByName(recent(mails, "mail", "extracted_timestamp", F.lit(False)))
        .unionByName(recent(summaries, "summary", "created_timestamp", F.lit(False)))
    )
    what = F.col("what")
    counted = events.agg(
        F.count_if(what == "file").alias("files_uploaded_24h"),
        F.count_if(what == "mail").alias("emails_processed_24h"),
        F.count_if(what == "summary").alias("summaries_created_24h"),
        F.count_if(F.col("failed")).alias("failed_files_24h"),
        F.count_if((what == "file") & (F.col("at") >= hour)).alias("_last_hour"),
    )
    status = F.when(F.col("_last_hour") > 0, values.ACTIVE).otherwise(values.IDLE)
    return counted.select(
        "files_uploaded_24h", "emails_processed_24h", "summaries_created_24h", "failed_files_24h",
        status.alias("system_status"), now.alias("last_check_time"),
    )


def health_label(health: DataFrame, max_failures: int = 5) -> DataFrame:
    """Job-log row with the health label; failures are looked at first."""
    label = (
        F.when(F.col("failed_files_24h") > max_failures, values.ISSUES)
        .when(F.col("files_uploaded_24h") > 0, values.ACTIVE)
        .otherwise(values.IDLE)
    )
    at = F.col("last_check_time")
    return health.select(
        F.concat(F.lit(f"{values.JOB_HEALTH}_"), at.cast("string")).alias("job_id"),
        F.lit(values.JOB_HEALTH).alias("job_type"),
        at.alias("start_time"),
        F.lit(values.COMPLETED).alias("status"),
        F.to_json(F.struct(label.alias("status"))).alias("error_details"),
    )


def _failures(raw: DataFrame, jobs: DataFrame, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """Failed files and failed jobs of the last days as (at, message) rows."""
    since = ago(as_of_column(raw, "upload_timestamp", as_of), days=days)
    files = raw.filter(
        (F.col("processing_status") == values.FAILED) & (F.col("upload_timestamp") >= since)
    ).select(F.col("upload_timestamp").alias("at"), F.col("error_message").alias("message"))
    error = F.get_json_object("error_details", "$.error")
    failed_jobs = jobs.filter(
        (F.col("status") == values.FAILED) & (F.col("start_time") >= since)
    ).select(
        F.col("start_time").alias("at"),
        F.coalesce(error, F.lit(values.UNKNOWN_ERROR)).alias("message"),
    )
    return files, failed_jobs


def _by_message(errors: DataFrame) -> DataFrame:
    return errors.groupBy("message").agg(F.count("*").alias("n"), F.max("at").alias("latest"))


def error_messages(raw: DataFrame, jobs: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """The errors of the last days, a row per category and message."""

    def rows(errors: DataFrame, category: str) -> DataFrame:
        return _by_message(errors).select(
            F.lit(category).alias("error_category"),
            F.col("message").alias("error_message"),
            F.col("n").alias("error_count"),
            F.col("latest").alias("latest_error"),
        )

    files, failed_jobs = _failures(raw, jobs, as_of, days)
    return rows(files, values.ERRORS_FILES).unionByName(rows(failed_jobs, values.ERRORS_JOBS))


def recent_errors(raw: DataFrame, jobs: DataFrame, as_of=None, days: int = 7, most: int = 1000) -> DataFrame:
    """File errors and job errors of the last days, always two rows.

    Repeated messages are grouped, and the first ``most`` in order of the text are
    joined to one; the text ends with how many there are besides.  ``error_messages``
    has all of them as rows.
    """

    def row(errors: DataFrame, category: str) -> DataFrame:
        grouped = _by_message(errors)
        first = grouped.filter(F.col("message").isNotNull()).orderBy("message").limit(most)
        joined = first.select(F.array_join(F.array_sort(F.collect_list("message")), "; ")).scalar()
        others = F.count("message") - most
        more = F.when(others > 0, F.concat(F.lit("; and "), others.cast("string"), F.lit(" more"))).otherwise("")
        return grouped.agg(
            F.lit(category).alias("error_category"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("error_count"),
            F.max("latest").alias("latest_error"),
            F.when(F.count("message") > 0, F.concat(joined, more)).alias("error_messages"),
        )

    files, failed_jobs = _failures(raw, jobs, as_of, days)
    return row(files, values.ERRORS_FILES).unionByName(row(failed_jobs, values.ERRORS_JOBS))


def stage_status(
    raw: DataFrame, mails: DataFrame, summaries: DataFrame, as_of=None
) -> DataFrame:
    """The three stages with their backlog or total and last-24-hours count."""
    day = ago(as_of_column(raw, "upload_timestamp", as_of), hours=24)

    def stage(df, place, name, pending, recent):
        return df.agg(
            F.lit(place).alias("_place"),
            F.lit(name).alias("stage"),
            F.count_if(pending).alias("pending_count"),
            F.count_if(recent).alias("last_24h"),
        )

    waiting = F.col("processing_status") == values.PENDING
    rows = [
        stage(raw, 1, values.STAGE_FILES, waiting, F.col("upload_timestamp") >= day),
        stage(mails, 2, values.STAGE_MAILS, F.lit(True), F.col("extracted_timestamp") >= day),
        stage(summaries, 3, values.STAGE_SUMMARIES, F.lit(True), F.col("created_timestamp") >= day),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).orderBy("_place").drop("_place")


def recent_mail(mails: DataFrame, n: int = 20) -> DataFrame:
    columns = [
        "email_id", "subject", "sender_email", "email_date", "email_classification",
        "extracted_timestamp",
    ]
    return _newest(mails.select(*columns), "extracted_timestamp", n, "email_id")


def mail_stats(mails: DataFrame, as_of=None, days: int = 7, approximate: bool = False) -> DataFrame:
    """Mails, distinct senders and URGENT mails of the last days."""
    now = as_of_column(mails, "extracted_timestamp", as_of)
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return mails.filter(F.col("extracted_timestamp") >= ago(now, days=days)).agg(
        F.count("*").alias("total_emails"),
        distinct("sender_email").alias("unique_senders"),
        F.count_if(F.col("email_classification") == "URGENT").alias("urgent_count"),
    )


def recent_files(raw: DataFrame, n: int = 10) -> DataFrame:
    files = raw.select("file_name", "processing_status", "upload_timestamp")
    return _newest(files, "upload_timestamp", n, "file_name")


def recent_jobs(jobs: DataFrame, n: int = 10) -> DataFrame:
    return _newest(jobs, "start_time", n, "job_id")


def totals(mails: DataFrame, summaries: DataFrame) -> DataFrame:
    """Mails and summaries in one row."""
    return mails.agg(F.count("*").alias("total_emails")).withColumn(
        "ai_summaries", summaries.agg(F.count("*")).scalar()
    )


def mail_history(mails: DataFrame, summaries: DataFrame, n: int = 10) -> DataFrame:
    """The newest mails with their BRIEF.

    A left join never drops a mail, so the newest ``n`` are picked first and only
    those meet the summaries; several BRIEFs of one mail are cut again at the end.
    """
    newest = _newest(
        mails.select("email_id", "subject", "sender_email", "extracted_timestamp"),
        "extracted_timestamp", n, "email_id",
    )
    briefs = _briefs(summaries).join(few(newest.select("email_id"), n), "email_id", "left_semi")
    shown = newest.join(briefs, "email_id", "left").select(
        "email_id", "subject", "sender_email", "brief_summary", "extracted_timestamp"
    )
    return _newest(shown, "extracted_timestamp", n, "email_id", "brief_summary")


def recent_summaries(summaries: DataFrame, n: int = 10) -> DataFrame:
    columns = ["summary_id", "email_id", "summary_type", "summary_text", "created_timestamp"]
    return _newest(summaries.select(*columns), "created_timestamp", n, "summary_id")


def dashboard_rows(mails: DataFrame, summaries: DataFrame, n: int = 15) -> DataFrame:
    """The newest enriched mails: summary, urgency, sentiment and time.

    The newest BRIEF rows that belong to a mail decide which mails are shown.
    """
    urgent = urgency.is_urgent(F.col("subject"), F.col("email_body"))
    brief = summaries.filter(F.col("summary_type") == values.BRIEF)
    known = brief.join(mails.select("email_id"), "email_id", "left_semi")
    newest = _newest(
        known.select("email_id", F.col("summary_text").alias("ai_summary"), "created_timestamp"),
        "created_timestamp", n, "email_id",
    )
    shown_ids = few(newest.select("email_id"), n)
    shown = mails.join(shown_ids, "email_id", "left_semi").select(
        "email_id",
        F.col("sender_email").alias("sender"),
        "subject",
        urgency.urgency_level(urgent, F.col("email_classification")).alias("urgency_level"),
    )
    feeling = (
        summaries.filter(F.col("summary_type") == values.SENTIMENT)
        .join(shown_ids, "email_id", "left_semi")
        .groupBy("email_id")
        .agg(F.max(F.col("summary_text").try_cast("double")).alias("sentiment_score"))
    )
    return newest.join(shown, "email_id").join(feeling, "email_id", "left").select(
        "email_id", "sender", "subject", "ai_summary", "urgency_level", "sentiment_score",
        "created_timestamp",
    )


def dashboard_kpis(rows: DataFrame, as_of=None) -> DataFrame:
    """Figures over the result of ``dashboard_rows``, or any table of that form."""
    now = as_of_column(rows, "created_timestamp", as_of)
    counted = rows.agg(
        F.count("*").alias("total_emails"),
        F.count_if(F.col("urgency_level") == "HIGH").alias("urgent_emails"),
        F.round(F.avg("sentiment_score"), 2).alias("avg_sentiment"),
        F.count_if(F.col("created_timestamp") >= ago(now, hours=1)).alias("last_hour"),
    )
    return counted


def sender_rollup(mails: DataFrame, summaries: DataFrame, since) -> DataFrame:
    """Mails and mean sentiment per sender from a date on."""
    feeling = summaries.filter(F.col("summary_type") == values.SENTIMENT).select(
        "email_id", F.col("summary_text").try_cast("double").alias("sentiment")
    )
    return (
        mails.filter(F.col("email_date") >= moment(since))
        .select("email_id", "sender_email")
        .join(feeling, "email_id")
        .groupBy("sender_email")
        .agg(
            F.count("*").alias("email_count"),
            F.round(F.avg("sentiment"), 6).alias("avg_sentiment"),
        )
    )


def filter_search(mails: DataFrame, sender=None, since=None, contains=None) -> DataFrame:
    """Mails by sender, date and a phrase in the body; each one is optional."""
    found = mails
    if sender is not None:
        found = found.filter(F.col("sender_email") == sender)
    if since is not None:
        found = found.filter(F.col("email_date") >= moment(since))
    if contains is not None:
        found = found.filter(F.col("email_body").ilike(f"%{contains}%"))
    return found


def source_sync_health(raw: DataFrame, name_like: str, as_of=None) -> DataFrame:
    """Files of one source (by name pattern) in the last 24 hours."""
    now = as_of_column(raw, "upload_timestamp", as_of)
    return raw.filter(
        F.col("file_name").like(name_like) & (F.col("upload_timestamp") >= ago(now, hours=24))
    ).agg(
        F.count("*").alias("emails_24h"),
        F.max("upload_timestamp").alias("last_sync"),
        F.count_if(F.col("processing_status") == values.FAILED).alias("failed_emails"),
    )


def key_violations(raw: DataFrame, mails: DataFrame, summaries: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows breaking the declared keys, counted per key."""

    def repeated(df: DataFrame, table: str, key: str) -> DataFrame:
        counts = df.groupBy(key).agg(F.count("*").alias("n"))
        broken = F.coalesce(F.sum(F.when((F.col("n") > 1) | F.col(key).isNull(), F.col("n"))), F.lit(0))
        return counts.agg(F.lit(f"{table}.{key}").alias("key"), F.lit("unique").alias("rule"),
                          broken.alias("violations"))

    def dangling(df: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
        children = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        lost = children.join(parent.select(key), key, "left_anti")
        return lost.agg(F.lit(f"{table}.{key}").alias("key"), F.lit("reference").alias("rule"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))

    checks = [
        repeated(raw, "raw_email_files", "file_id"),
        repeated(mails, "processed_emails", "email_id"),
        repeated(summaries, "email_summaries", "summary_id"),
        repeated(jobs, "processing_jobs", "job_id"),
        dangling(mails, "processed_emails", "file_id", raw),
        dangling(summaries, "email_summaries", "email_id", mails),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
