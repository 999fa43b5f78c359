"""Urgency alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailflow import values
from mailflow.clock import ago, as_of_column
from mailflow.functions import urgency


def _urgent(patterns):
    return urgency.is_urgent(F.col("subject"), F.col("email_body"), patterns)


def urgent_alerts(mails: DataFrame, patterns=None, in_subject=None, in_body=None) -> DataFrame:
    """One row per urgent mail with the indicators found."""
    found = urgency.urgency_indicators(F.col("subject"), F.col("email_body"), in_subject, in_body)
    return mails.filter(_urgent(patterns)).select(
        "email_id", "subject", F.col("sender_email").alias("sender"),
        found.alias("urgency_indicators"),
    )


def alert_log(mails: DataFrame, as_of, patterns=None) -> DataFrame:
    """One job-log row with the number of urgent mails, if there are any."""
    counted = mails.filter(_urgent(patterns)).agg(F.count("*").alias("n")).filter("n > 0")
    return counted.select(
        F.concat(F.lit(f"{values.JOB_URGENT}_"), as_of.cast("string")).alias("job_id"),
        F.lit(values.JOB_URGENT).alias("job_type"),
        as_of.alias("start_time"),
        F.lit(values.COMPLETED).alias("status"),
        F.to_json(F.struct(F.col("n").alias("urgent_count"))).alias("error_details"),
    )


def urgent_recent(
    mails: DataFrame, briefs: DataFrame, as_of=None, days: int = 7, patterns=None,
    ordered: bool = True,
) -> DataFrame:
    """Urgent mails of the last days with their BRIEF, newest first."""
    now = as_of_column(mails, "extracted_timestamp", as_of)
    recent = mails.filter(F.col("extracted_timestamp") >= ago(now, days=days)).filter(
        _urgent(patterns)
    )
    brief = briefs.filter(F.col("summary_type") == values.BRIEF).select(
        "email_id", F.col("summary_text").alias("brief_summary")
    )
    view = recent.select(
        "email_id", "subject", "sender_email", "email_date", "extracted_timestamp"
    ).join(brief, "email_id", "left")
    return view.orderBy(F.col("extracted_timestamp").desc(), "email_id") if ordered else view
