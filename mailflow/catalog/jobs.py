"""The job log."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.catalog.registry import query
from mailflow.operators import parse
from mailflow.plans import jobs
from mailflow.session import work_dir


@query(
    "job_record",
    tb.sql(tb.BASE, tb.RAW, select="""
SELECT 'BATCH_PROCESSING_run' AS job_id, 'BATCH_PROCESSING' AS job_type,
  TIMESTAMP '2024-02-01 00:00:00' AS start_time, TIMESTAMP '2024-02-01 00:10:00' AS end_time,
  'PARTIAL_FAILURE' AS status, count(*) FILTER (has_content) AS files_processed,
  count(*) FILTER (NOT has_content) AS files_failed
FROM raw WHERE processing_status = 'PENDING'"""),
)
def job_record(spark, sf):
    """Run record of parsing everything pending."""
    outcomes = parse.parse_batch(tb.raw(spark, sf).drop("file_content"), limit=None)
    return jobs.job_record(
        outcomes, values.JOB_BATCH, "2024-02-01 00:00:00", "2024-02-01 00:10:00", run="run"
    )


@query(
    "job_status",
    tb.sql(tb.JOBS, select="""
SELECT job_id, CASE WHEN files_failed = 0 THEN 'COMPLETED' ELSE 'PARTIAL_FAILURE' END AS job_status FROM jobs"""),
)
def job_status(spark, sf):
    """Status by failures of every run."""
    return tb.jobs(spark, sf).select("job_id", jobs.job_status(F.col("files_failed")).alias("job_status"))


@query(
    "job_history",
    tb.sql(tb.JOBS, select="""
SELECT job_type, job_id, status,
  CASE WHEN status IN ('RUNNING', 'COMPLETED') THEN 'ok' WHEN status = 'PARTIAL_FAILURE' THEN 'warning'
  ELSE 'error' END AS status_class, start_time
FROM jobs, job_now WHERE start_time >= t - INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY job_type ORDER BY start_time DESC, job_id DESC) = 1"""),
)
def job_history(spark, sf):
    """Latest run per job type in the last two hours."""
    return jobs.job_history(tb.jobs(spark, sf))


@query(
    "apply_retention",
    tb.sql(tb.JOBS, select="""
SELECT job_id, job_type, start_time, status FROM jobs, job_now WHERE start_time >= t - INTERVAL 30 DAY
UNION ALL SELECT concat('MAINTENANCE_', strftime(t, '%Y-%m-%d %H:%M:%S')), 'SIMPLE_MAINTENANCE', t, 'COMPLETED' FROM job_now"""),
)
def apply_retention(spark, sf):
    """What is left of the job log after 30 days, and the row that says so."""
    return jobs.apply_retention(tb.jobs(spark, sf))


@query(
    "retain_log",
    tb.sql(tb.JOBS, select="""
SELECT job_id, job_type, start_time, status, false AS dropped_day_left FROM jobs, job_now WHERE start_time >= t - INTERVAL 30 DAY
UNION ALL SELECT concat('MAINTENANCE_', strftime(t, '%Y-%m-%d %H:%M:%S')), 'SIMPLE_MAINTENANCE', t, 'COMPLETED', false FROM job_now"""),
)
def retain_log(spark, sf):
    """A stored log by day, its old days dropped, read again."""
    log, folder = tb.jobs(spark, sf), work_dir(spark, "job-log")
    jobs.append_log(log, folder)
    dropped = jobs.retain(spark, folder, log.schema)
    left = jobs.read_log(spark, folder, log.schema)
    stale = F.to_date("start_time").cast("string").isin(dropped)
    return left.select("job_id", "job_type", "start_time", "status", stale.alias("dropped_day_left"))


@query(
    "threshold_breaches",
    tb.sql(tb.BASE, tb.RAW, tb.JOBS, """
measured AS (
  SELECT 'processing_latency_seconds' AS threshold, cast(max(epoch(end_time) - epoch(start_time)) AS DOUBLE) AS measured,
    300.0::DOUBLE AS allowed FROM jobs
  UNION ALL SELECT 'error_rate_percentage',
    round(sum(files_failed) * 100.0::DOUBLE / sum(files_processed + files_failed), 2), 5.0 FROM jobs
  UNION ALL SELECT 'queue_depth', cast(count(*) FILTER (processing_status = 'PENDING') AS DOUBLE), 100.0 FROM raw
)""", select="SELECT threshold, measured, allowed FROM measured WHERE measured > allowed"),
)
def threshold_breaches(spark, sf):
    """Alert thresholds exceeded."""
    return jobs.threshold_breaches(tb.jobs(spark, sf), tb.raw(spark, sf))


@query(
    "basic_health",
    tb.sql(tb.JOBS, """
counted AS (
  SELECT count(*) AS jobs, count(*) FILTER (status IN ('RUNNING', 'COMPLETED')) AS running
  FROM jobs, job_now WHERE job_type LIKE 'REALTIME!_%' ESCAPE '!' AND start_time >= t - INTERVAL 1 HOUR
)""", select="""
SELECT jobs, running, CASE WHEN running = 0 THEN 'WARNING: no realtime job is running'
  WHEN running < jobs THEN concat('PARTIAL: ', running, ' of ', jobs, ' realtime jobs are running')
  ELSE 'HEALTHY: every realtime job is running' END AS health_message FROM counted"""),
)
def basic_health(spark, sf):
    """State of the realtime jobs of the last hour."""
    return jobs.basic_health(tb.jobs(spark, sf))
