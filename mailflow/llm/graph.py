"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailflow.llm.store import passing, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst): the component is its
    smallest node.  Alternating large and small stars; each round is written out.

    The table of least neighbours that a round needs also tells whether all edges are stars
    already: then it is the result, and no round is spent on seeing that nothing changes.
    Loops, repeated edges and edges with a null end do no harm; no edges, no rows.
    A hub is aggregated map-side, and its join is one that Spark splits at run time.
    """
    with passing(edges.sparkSession):
        found = stored(
            edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(),
            "edges",
        )
        for _ in range(rounds):
            both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
            below = F.when(F.col("v") < F.col("u"), F.col("v"))
            knot = F.min(below).isNotNull() & ((F.min(below) != F.max(below)) | (F.max("v") > F.col("u")))
            low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), knot.alias("knot"))
            low = stored(low, "lows")
            if not low.where("knot").limit(1).count():
                break
            large = both.where("v > u").join(low.drop("knot"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            # a node keeps the edge to its least neighbour, the other neighbours get one to that
            moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
            found = stored(large.join(least, "u").select(moved.alias("u"), F.col("m").alias("v")), "edges")
        return stored(low.select(F.col("u").alias("node"), F.col("m").alias("component")), "components", stays=True)
