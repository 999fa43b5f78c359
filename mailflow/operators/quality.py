"""Validation of parsed mails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailflow import values


def validation_errors() -> Column:
    """Messages of the rules a mail breaks, in rule order."""
    sender, subject, body = F.col("sender_email"), F.col("subject"), F.col("email_body")
    broken = [
        sender.isNull() | ~sender.rlike(values.ADDRESS_PATTERN),
        subject.isNull() | (F.length(subject) == 0),
        body.isNull() | (F.length(body) < values.MIN_BODY_CHARS),
        F.col("email_date").isNull(),
    ]
    return F.array_compact(
        F.array(*[F.when(b, message) for b, message in zip(broken, values.VALIDATION_RULES)])
    )


def validate_mail(mails: DataFrame) -> DataFrame:
    """Add the broken rules and a one-line result."""
    return mails.withColumn("validation_errors", validation_errors()).withColumn(
        "validation_result",
        F.when(F.size("validation_errors") == 0, values.VALIDATION_PASSED).otherwise(
            F.concat(F.lit(values.VALIDATION_FAILED), F.array_join("validation_errors", ", "))
        ),
    )


def invalid_mail(mails: DataFrame) -> DataFrame:
    """Mails that break at least one rule."""
    checked = mails if "validation_errors" in mails.columns else validate_mail(mails)
    return checked.filter(F.size("validation_errors") > 0).select(
        "email_id", "subject", "validation_errors"
    )


def validation_summary(mails: DataFrame) -> DataFrame:
    """How often each rule is broken; rules nobody breaks count zero."""
    errors = validation_errors()
    counts = mails.select(errors.alias("e")).agg(
        *[
            F.count_if(F.array_contains("e", message)).alias(f"r{i}")
            for i, message in enumerate(values.VALIDATION_RULES)
        ]
    )
    rules = F.array(
        *[
            F.struct(F.lit(message).alias("rule"), F.col(f"r{i}").alias("mails"))
            for i, message in enumerate(values.VALIDATION_RULES)
        ]
    )
    return counts.select(F.inline(rules))
