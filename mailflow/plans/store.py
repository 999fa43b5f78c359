"""The mail store in SQL: base tables and views under their usual names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailflow import schemas
from mailflow.operators import alerts
from mailflow.plans import jobs as job_plans, views

# The names SQL users know.
TABLES = ["raw_email_files", "processed_emails", "email_summaries", "processing_jobs"]
VIEWS = [
    "email_processing_overview",
    "email_ai_insights",
    "email_processing_stats",
    "email_format_distribution",
    "simple_system_health",
    "recent_errors",
    "pipeline_status",
    "urgent_emails_simple",
    "simple_task_status",
]


def empty_tables(spark: SparkSession) -> list[DataFrame]:
    """The four base tables without rows, in the order ``register`` takes them."""
    declared = [
        schemas.RAW_EMAIL_FILES, schemas.PROCESSED_EMAILS, schemas.EMAIL_SUMMARIES,
        schemas.PROCESSING_JOBS,
    ]
    return [spark.createDataFrame([], schema) for schema in declared]


def register(
    spark: SparkSession, raw: DataFrame, mails: DataFrame, summaries: DataFrame, jobs: DataFrame,
    as_of=None,
) -> list[str]:
    """Register the four tables and the views over them as temporary views, for
    ``spark.sql``.  Returns their names."""
    frames = [
        raw,
        mails,
        summaries,
        jobs,
        views.processing_overview(raw, mails, summaries),
        views.ai_insights(mails, summaries),
        views.processing_stats(raw),
        views.format_distribution(raw),
        views.system_health(raw, mails, summaries, as_of),
        views.recent_errors(raw, jobs, as_of),
        views.stage_status(raw, mails, summaries, as_of),
        alerts.urgent_recent(mails, summaries, as_of),
        job_plans.job_history(jobs, as_of),
    ]
    names = TABLES + VIEWS
    for name, frame in zip(names, frames):
        frame.createOrReplaceTempView(name)
    return names
