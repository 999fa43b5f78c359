"""Deterministic row ids, so that a replay writes the same rows."""

from pyspark.sql import Column, functions as F

SEPARATOR = "␟"


def row_id(prefix: str, *cols) -> Column:
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws(SEPARATOR, *cols), 256))


def content_hash(text: Column) -> Column:
    """Hash to group and join by.  It is never NULL and says so, which keeps
    Spark from computing it once more to test a join key."""
    return F.coalesce(F.sha2(F.coalesce(text, F.lit("")), 256), F.lit(""))
