"""Gapless numbers within a key, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def numbered(df: DataFrame, keys: list[str], order: list[str], rows: int, name: str = "slot") -> DataFrame:
    """Number the rows of each key from 0.  A key is dealt by a hash of ``order`` to
    parts of about 20,000 rows; each part is numbered by itself and starts after the
    parts before it, so that a key holding most rows is still spread.  ``rows`` is
    about how many rows there are; it changes the spread only."""
    parts = max(32, rows // 20_000)
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_start")
    )
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    local = dealt.withColumn("_row", F.row_number().over(within) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on = F.col("_part") == F.col("_p")
    for s in same:
        on = on & s
    return (
        local.join(starts, on).withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_p", "_row", "_start", *[f"_k{i}" for i in range(len(keys))])
    )
