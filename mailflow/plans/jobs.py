"""The job log: run records, history, retention, thresholds and health."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailflow import values
from mailflow.clock import ago, as_of_column, moment
from mailflow.operators.dedupe import latest_per_key


DAY = "start_day"


def job_status(failed: Column) -> Column:
    return F.when(failed == 0, values.COMPLETED).otherwise(values.PARTIAL_FAILURE)


def job_record(
    outcomes: DataFrame, job_type: str, start, end, run: str | None = None, partial: bool = True
) -> DataFrame:
    """Run record of a batch from its outcome rows (a ``status`` column).

    ``partial`` gives the realtime form, whose status tells about failures; the
    batch form always ends COMPLETED.
    """
    failed = F.count_if(F.col("status") == values.FAILED)
    start, end = moment(start), moment(end)
    label = F.lit(run) if run is not None else start.cast("string")
    return outcomes.agg(
        F.concat(F.lit(f"{job_type}_"), label).alias("job_id"),
        F.lit(job_type).alias("job_type"),
        start.alias("start_time"),
        end.alias("end_time"),
        (job_status(failed) if partial else F.lit(values.COMPLETED)).alias("status"),
        F.count_if(F.col("status") != values.FAILED).alias("files_processed"),
        failed.alias("files_failed"),
    )


def job_history(jobs: DataFrame, as_of=None, hours: int = 2, job_types=None) -> DataFrame:
    """Latest run per job type in the last hours, with a display class."""
    now = as_of_column(jobs, "start_time", as_of)
    recent = jobs.filter(F.col("start_time") >= ago(now, hours=hours))
    if job_types:
        recent = recent.filter(F.col("job_type").isin(job_types))
    latest = latest_per_key(recent, ["job_type"], [F.col("start_time").desc(), F.col("job_id").desc()])
    icon = (
        F.when(F.col("status").isin(values.RUNNING, values.COMPLETED), "ok")
        .when(F.col("status") == values.PARTIAL_FAILURE, "warning")
        .otherwise("error")
    )
    return latest.select("job_type", "job_id", "status", icon.alias("status_class"), "start_time")


def apply_retention(jobs: DataFrame, days: int = values.KEEP_JOB_DAYS, as_of=None) -> DataFrame:
    """Jobs of the last days plus one row that records the clean-up."""
    now = as_of_column(jobs, "start_time", as_of)
    kept = jobs.filter(F.col("start_time") >= ago(now, days=days)).select(
        "job_id", "job_type", "start_time", "status"
    )
    record = jobs.sparkSession.range(1).select(
        F.concat(F.lit("MAINTENANCE_"), now.cast("string")).alias("job_id"),
        F.lit(values.JOB_MAINTENANCE).alias("job_type"),
        now.alias("start_time"),
        F.lit(values.COMPLETED).alias("status"),
    )
    return kept.unionByName(record)


def append_log(jobs: DataFrame, log_dir: str) -> None:
    """Add run records to a log kept in one folder per day of their start."""
    dated = jobs.withColumn(DAY, F.to_date("start_time"))
    dated.write.partitionBy(DAY).mode("append").parquet(log_dir)


def _days(spark: SparkSession, log_dir: str) -> dict[str, str]:
    """Day and folder of every partition; rows without a start have no day."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(log_dir)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    folders = [str(f.getPath().toString()) for f in found if f.isDirectory()]
    named = [f for f in folders if f.rsplit("/", 1)[1].startswith(f"{DAY}=2") or f.rsplit("/", 1)[1].startswith(f"{DAY}=1")]
    return {f.rsplit("=", 1)[1]: f for f in named}


def read_log(spark: SparkSession, log_dir: str, schema, days: int | None = values.KEEP_JOB_DAYS, as_of=None) -> DataFrame:
    """The run records of the last ``days`` (all of them for None): folders of older days
    are not opened, and of the first day only later starts are taken.  ``as_of`` is the
    latest start unless given; only the latest day is read for it."""
    log = spark.read.schema(schema).option("basePath", log_dir).parquet(log_dir)
    if days is not None:
        start = _since(spark, log_dir, schema, days, as_of)
        log = log.filter((F.col(DAY) >= F.lit(start).cast("date")) & (F.col("start_time") >= F.lit(start)))
    return log.drop(DAY)


def _since(spark: SparkSession, log_dir: str, schema, days: int, as_of) -> datetime:
    if as_of is None:
        latest = max(_days(spark, log_dir))
        log = spark.read.schema(schema).option("basePath", log_dir).parquet(f"{log_dir}/{DAY}={latest}")
        as_of = log.select(F.max("start_time")).first()[0]
    return as_of - timedelta(days=days)


def retain(spark: SparkSession, log_dir: str, schema, days: int = values.KEEP_JOB_DAYS, as_of=None) -> list[str]:
    """Drop the folders of days that end before the last ``days`` and add the record of
    the clean-up; returns the days dropped.  No file that stays is read or written:
    records of the first day kept may be older by hours, and ``read_log`` leaves them out.
    """
    start = _since(spark, log_dir, schema, days, as_of)
    dropped = []
    for day, folder in sorted(_days(spark, log_dir).items()):
        if day < start.date().isoformat():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            dropped.append(day)
    now = start + timedelta(days=days)
    record = (f"MAINTENANCE_{now}", values.JOB_MAINTENANCE, now, values.COMPLETED)
    named = spark.createDataFrame([record], "job_id string, job_type string, start_time timestamp_ntz, status string")
    append_log(named, log_dir)
    return dropped


def threshold_breaches(
    jobs: DataFrame, raw: DataFrame, max_latency=values.MAX_LATENCY_SECONDS,
    max_error_percent=values.MAX_ERROR_PERCENT, max_queue=values.MAX_QUEUE_DEPTH,
) -> DataFrame:
    """The alert thresholds that are exceeded, with measured value and limit."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    worked = F.sum(F.col("files_processed") + F.col("files_failed"))
    measured = jobs.agg(
        F.max(seconds).cast("double").alias("latency"),
        F.round(F.try_divide(F.sum("files_failed") * F.lit(100.0), worked), 2).alias("errors"),
    )
    queue = raw.agg(F.count_if(F.col("processing_status") == values.PENDING)).scalar()
    limits = [
        ("processing_latency_seconds", F.col("latency"), max_latency),
        ("error_rate_percentage", F.col("errors"), max_error_percent),
        ("queue_depth", F.col("queue").cast("double"), max_queue),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("threshold"), value.alias("measured"),
                F.lit(float(limit)).alias("allowed"),
            )
            for name, value, limit in limits
        ]
    )
    return measured.withColumn("queue", queue).select(F.inline(rows)).filter("measured > allowed")


def basic_health(jobs: DataFrame, as_of=None, hours: int = 1, prefix: str = "REALTIME_") -> DataFrame:
    """State of the realtime jobs of the last hours as one message."""
    now = as_of_column(jobs, "start_time", as_of)
    recent = jobs.filter(
        F.col("job_type").startswith(prefix) & (F.col("start_time") >= ago(now, hours=hours))
    )
    working = F.col("status").isin(values.RUNNING, values.COMPLETED)
    counted = recent.agg(F.count("*").alias("jobs"), F.count_if(working).alias("running"))
    message = (
        F.when(F.col("running") == 0, "WARNING: no realtime job is running")
        .when(
            F.col("running") < F.col("jobs"),
            F.concat(
                F.lit("PARTIAL: "), F.col("running").cast("string"), F.lit(" of "),
                F.col("jobs").cast("string"), F.lit(" realtime jobs are running"),
            ),
        )
        .otherwise("HEALTHY: every realtime job is running")
    )
    return counted.select("jobs", "running", message.alias("health_message"))
