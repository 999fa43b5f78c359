"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
FAN = 6  # bits of the tree's fan-in: 64 children
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Add ``target`` to (source, source_size): by weight, none above ``most`` times its
    size, the excess reshared by weight.  A source is capped exactly if its share of what
    the sources with a smaller cap per weight leave exceeds its cap.  The windows run
    over the table of sources, one row each."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("w", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(most))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shared = weighed.withColumn("each", left / F.sum("w").over(after))
    capped = shared.withColumn("full", F.col("each") * F.col("w") > F.col("cap"))
    first = F.min_by(F.when(~F.col("full"), F.col("each")), F.when(~F.col("full"), F.col("cap") / F.col("w"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), first * F.col("w")))
    return capped.select("source", "source_size", target.alias("target"))


def unit_interval(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def duel(units: Column, seed: Column) -> Column:
    """Pivotal rounding along an array, sorted from large to small, of (size, h, doc_id, p): each step pairs the
    undecided unit with the next and moves mass between them at random until one of them
    is 0 or 1.  Sums of p and each unit's expectation stay.  Returns all units, the
    undecided one last."""
    unit = lambda u, p: F.struct(
        u["size"].alias("size"), u["h"].alias("h"), u["doc_id"].alias("doc_id"), p.alias("p")
    )

    def step(state: Column, x: Column) -> Column:
        a = state["open"]
        both = a["p"] + x["p"]
        chance = F.when(both < 1, a["p"] / F.greatest(both, F.lit(EPS))).otherwise(
            (1 - x["p"]) / F.greatest(2 - both, F.lit(EPS))
        )
        # the winner takes what there is: all below 1, else a whole
        wins = unit_interval(seed, a["h"], x["h"], a["size"], x["size"]) < chance
        small = both < 1
        high = F.when(small, both).otherwise(1.0)
        low = F.when(small, 0.0).otherwise(both - 1)
        pa, px = F.when(wins, high).otherwise(low), F.when(wins, low).otherwise(high)
        a_open = wins == small  # below 1 the winner stays open, else the loser
        return F.struct(
            F.when(a_open, unit(a, pa)).otherwise(unit(x, px)).alias("open"),
            F.concat(state["done"], F.array(F.when(a_open, unit(x, px)).otherwise(unit(a, pa)))).alias("done"),
        )

    begin = F.struct(unit(F.get(units, F.lit(0)), F.get(units, F.lit(0))["p"]).alias("open"), F.slice(units, 1, 0).alias("done"))
    return F.aggregate(F.slice(units, F.lit(2), F.size(units)), begin, step, lambda s: F.concat(s["done"], F.array(s["open"])))


def mix(
    rows: DataFrame, key: str, text: str, source: str, weights: list[int], share: float = 1.5, most: float = 2.0, seed: int = 17,
) -> DataFrame:
    """How many words the mix takes of each document.  DataFrame functions only.

    A document of a source is wanted target / source_size times.  The whole part is given,
    the fraction is rounded by the pivotal method in a reduction tree: units of one source
    and size first (by hash, 64 at a time), then residuals of neighbouring sizes, up to one
    unit per source, which is drawn.  Sizes fall along each array, so what is left open is
    small; the taken words differ from a target by about one large document at most.  Draws depend on key, size and ``seed`` (without a key on
    the text) only: reruns agree.

    Returns doc_id, size (words), source_size, target, taken, copies, source.  A null or
    empty text has no words and is taken 0 times; the null source is a source; null keys
    and repeated rows are units of their own.  No words at all: every target is 0.  Other
    columns of ``rows`` are not looked at.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    units = stored(rows.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), size.alias("size"),
        F.when(F.col(key).isNull(), F.xxhash64(text)).alias("salt")), "words")
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    targets = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    targets = targets.withColumn("whole", F.floor(F.col("rate") + EPS))
    targets = targets.withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")))
    same = F.col("t.source").eqNullSafe(F.col("u.source"))
    wanted = units.alias("u").join(targets.alias("t"), same).select(
        "u.doc_id", "u.source", "u.size", "t.source_size", "t.target", F.col("t.whole"), "t.p",
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "u.doc_id", "u.size", "u.salt"), 2).alias("h"),
    )
    fixed = (F.col("size") == 0) | (F.col("p") <= EPS)
    decided = [wanted.where(fixed).select("doc_id", "source", "size", F.lit(0.0).alias("p"))]
    open_ = wanted.where(~fixed).select("doc_id", "source", "size", "p", "h")
    most_alike, longest = wanted.where(~fixed).groupBy("source", "size").agg(F.count("*").alias("n")).agg(F.max("n"), F.max("size")).first()
    bits = max(0, ((most_alike or 0) // 32).bit_length())
    steps = [(0, b) for b in range(bits, 0, -FAN)] + [(0, 0)]
    steps += [(s, 0) for s in range(FAN, max(1, (longest or 0).bit_length()) + FAN, FAN)]
    for level, (shift, b) in enumerate(steps):
        group = ["source", F.shiftright("size", shift).alias("k1"), (F.shiftright("h", 62 - b) if b else F.lit(0)).alias("k2")]
        gathered = open_.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("size", "h", "doc_id", "p")), asc=False).alias("units"))
        # the array is named twice below, which keeps Spark from computing it per element
        rounded = gathered.withColumn("units", F.when(F.size("units") > 1, duel(F.col("units"), F.lit(seed + level))).otherwise(F.col("units")))
        placed = stored(rounded.select("source", F.posexplode("units").alias("i", "one"), F.size("units").alias("n")).select(
            "source", "one.*", (F.col("i") < F.col("n") - 1).alias("done")), "rounded")
        decided.append(placed.where("done").select("doc_id", "source", "size", "p"))
        open_ = placed.where("NOT done").select("doc_id", "source", "size", "p", "h")
    drawn = F.when(unit_interval(F.lit(seed), F.lit("last"), F.col("h")) < F.col("p"), 1.0).otherwise(0.0)
    decided.append(open_.select("doc_id", "source", "size", drawn.alias("p")))
    extra = reduce(DataFrame.unionByName, decided)
    copies = (F.col("whole") + F.when(F.col("e.p") > 0.5, 1).otherwise(0)).cast("long")
    copies = F.when(F.col("e.size") > 0, copies).otherwise(0)
    return extra.alias("e").join(targets.alias("t"), F.col("t.source").eqNullSafe(F.col("e.source"))).select(
        "e.doc_id", "e.size", "t.source_size", "t.target", (copies * F.col("e.size")).cast("long").alias("taken"),
        copies.cast("long").alias("copies"), "e.source",
    )
