"""Incremental pulls and the filters declared for them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mailflow import values
from mailflow.clock import ago, as_of_column
from mailflow.functions.payload import domain_of
from mailflow.operators.dedupe import first_per_key
from mailflow.operators.lookup import attach


def incremental_since(
    incoming: DataFrame, processed: DataFrame, as_of=None, fallback_days: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Mails later than their domain's high-water mark.

    The mark is the latest (date, id) already processed for the sender's domain, so
    mails that share a time are told apart; mails without a sender share one mark.
    A domain without a mark is taken whole, or from ``fallback_days`` on.  Undated
    mails have no place in that order: those not processed yet are taken.  ``limit``
    caps the mails taken per domain, oldest first and undated last, so a later pull
    goes on where this one stopped.
    """
    # an "@" cannot be part of a domain, so it stands for mails without a sender
    key = F.coalesce(domain_of(F.col("sender_email")), F.lit("@"))
    place = F.struct("email_date", "email_id")
    marks = (
        processed.filter(F.col("email_date").isNotNull())
        .groupBy(key.alias("_key"))
        .agg(F.max(place).alias("_mark"))
    )
    dated = incoming.filter(F.col("email_date").isNotNull()).withColumn("_key", key)
    marked = attach(dated, marks, ["_key"], spread_by="email_id")
    unmarked = F.lit(True)
    if fallback_days is not None:
        unmarked = F.col("email_date") > ago(as_of_column(incoming, "email_date", as_of), days=fallback_days)
    later = F.when(F.col("_mark").isNull(), unmarked).otherwise(place > F.col("_mark"))
    done = processed.filter(F.col("email_date").isNull()).select("email_id")
    undated = incoming.filter(F.col("email_date").isNull()).join(done, "email_id", "left_anti")
    fresh = marked.filter(later).select(incoming.columns).unionByName(undated.select(incoming.columns))
    fresh = fresh.withColumn("domain", domain_of(F.col("sender_email")))
    if limit is None:
        return fresh
    order = [F.col("email_date").asc_nulls_last(), "email_id"]
    return first_per_key(fresh, ["domain"], order, limit, "email_id")


def filter_domain(mails: DataFrame, domains) -> DataFrame:
    """Mails from the given sender domains; ``"all"`` keeps every mail."""
    if domains == "all" or "all" in domains:
        return mails
    return mails.filter(domain_of(F.col("sender_email")).isin([d.lower() for d in domains]))


def filter_mail(
    mails: DataFrame, include=None, exclude=None, days: int | None = None,
    with_attachments: bool | None = None, as_of=None,
) -> DataFrame:
    """Keyword, age and attachment filters; each one is optional."""
    text = F.lower(F.concat_ws(" ", "subject", "email_body"))

    def any_of(words):
        return reduce(lambda a, b: a | b, [text.contains(w.lower()) for w in words])

    kept = mails
    if include:
        kept = kept.filter(any_of(include))
    if exclude:
        kept = kept.filter(~any_of(exclude))
    if days is not None:
        now = as_of_column(mails, "email_date", as_of)
        kept = kept.filter(F.col("email_date") >= ago(now, days=days))
    if with_attachments is not None:
        has = F.coalesce(F.size("attachments") > 0, F.lit(False))
        kept = kept.filter(has if with_attachments else ~has)
    return kept


def truncate_body(mails: DataFrame, n: int) -> DataFrame:
    """Cap the body at ``n`` characters (a store setting, off by default)."""
    return mails.withColumn("email_body", F.substring("email_body", 1, n))


def fetch_metrics(fetched: DataFrame, fetch_cols: list[str], start: str, end: str) -> DataFrame:
    """Two metric rows per fetch: mails fetched and seconds from first to last."""
    per_fetch = fetched.groupBy(*fetch_cols).agg(
        F.count("*").alias("n"),
        F.timestamp_diff("MICROSECOND", F.min(start), F.max(end)).alias("micros"),
    )
    metrics = F.array(
        F.struct(
            F.lit(values.METRIC_COUNT).alias("metric_type"),
            F.col("n").cast("double").alias("metric_value"),
        ),
        F.struct(
            F.lit(values.METRIC_LATENCY).alias("metric_type"),
            (F.floor(F.col("micros") / 1000) / 1000).alias("metric_value"),
        ),
    )
    return per_fetch.select(*fetch_cols, F.inline(metrics))


def domain_totals(mails: DataFrame, domains: list[str]) -> DataFrame:
    """Mails per configured domain, domains without mail included, and the
    total over all of them (``ALL``)."""
    counts = (
        filter_domain(mails, domains)
        .groupBy(domain_of(F.col("sender_email")).alias("domain"))
        .agg(F.count("*").alias("n"))
    )
    spark = mails.sparkSession
    listed = spark.range(1).select(
        F.explode(F.array(*[F.lit(d.lower()) for d in domains])).alias("domain")
    )
    return (
        listed.join(counts, "domain", "left")
        .select("domain", F.coalesce("n", F.lit(0)).alias("n"))
        .rollup("domain")
        .agg(F.sum("n").cast("bigint").alias("mails"))
        .select(F.coalesce("domain", F.lit("ALL")).alias("domain"), "mails")
    )
