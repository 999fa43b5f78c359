"""Joining rows to a table with one row per key when some keys are very hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot when it holds more than one in this many rows; there are then
# never more hot keys than this, whatever the size of the data.
HOT_SHARE = 500
SALTS = 64


# Results of a top-n step are broadcast up to this many rows.
FEW_ROWS = 10_000


def few(top: DataFrame, n: int) -> DataFrame:
    """A table known to have at most ``n`` rows: broadcast while n is small,
    left to the optimizer beyond that."""
    return F.broadcast(top) if n <= FEW_ROWS else top


def hot_keys(rows: DataFrame, keys: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than 1/share of all rows: fewer than ``share`` rows."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = rows.select(F.count("*")).scalar()
    return counts.filter(F.col("_n") * share > total).select(*keys)


def attach(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: str,
    hot: DataFrame | None = None, salts: int = SALTS,
) -> DataFrame:
    """Left join of ``rows`` to ``lookup`` (unique on ``keys``).

    Rows of a hot key go to ``salts`` partitions by a hash of ``spread_by``, and
    the few lookup rows of hot keys are repeated for each; all other rows and
    keys go through the join once.  Rows without a key match nothing and are
    spread the same way.  ``hot`` may name the hot keys where the caller has
    counted them already; their number is bounded by construction, so
    broadcasting them is safe.
    """
    hot = hot if hot is not None else hot_keys(rows, keys)
    marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    spread_out = F.coalesce(F.col("_hot"), F.lit(False))
    for key in keys:
        spread_out = spread_out | F.col(key).isNull()
    salted_rows = rows.join(marked, keys, "left").withColumn(
        "_salt",
        F.when(spread_out, F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(0),
    )
    zero = F.lit(0).cast("bigint")
    repeated = F.when(F.col("_hot"), F.sequence(zero, zero + salts - 1)).otherwise(
        F.array(zero)
    )
    salted_lookup = lookup.join(marked, keys, "left").withColumn(
        "_salt", F.explode(repeated)
    )
    joined = salted_rows.drop("_hot").join(salted_lookup.drop("_hot"), [*keys, "_salt"], "left")
    return joined.drop("_salt")
