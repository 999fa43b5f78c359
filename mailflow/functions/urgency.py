"""Urgency expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailflow import values


def matches_any(text: Column, patterns: list[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.coalesce(text.ilike(pattern), F.lit(False))
    return hit


def is_urgent(subject: Column, body: Column, patterns=None) -> Column:
    patterns = patterns or values.URGENT_PATTERNS
    return matches_any(subject, patterns) | matches_any(body, patterns)


def urgency_indicators(subject: Column, body: Column, in_subject=None, in_body=None) -> Column:
    """Codes of the patterns found: subject codes first, then body codes."""
    in_subject = in_subject or values.SUBJECT_INDICATORS
    in_body = in_body or values.BODY_INDICATORS
    codes = [F.when(subject.ilike(p), code) for p, code in in_subject]
    codes += [F.when(body.ilike(p), code) for p, code in in_body]
    return F.array_compact(F.array(*codes))


def urgency_level(urgent: Column, mail_class: Column) -> Column:
    return (
        F.when(urgent, "HIGH")
        .when(mail_class.isin("ACTION_REQUIRED", "MEETING_REQUEST"), "MEDIUM")
        .otherwise("LOW")
    )
