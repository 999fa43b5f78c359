"""Near-duplicate vectors by NN-descent."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.graph import components
from mailflow.llm.store import stored

BLOCK = 512  # members of a dense component that are compared at once
BUCKET = 256  # members of one start bucket; larger ones are dealt by a hash
EDGES = "src long, dst long, cos double"


def usable(vector: str) -> Column:
    """True for a vector with a direction: no null or non-finite parts, not zero."""
    c = F.col(vector)
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & good & F.exists(c, lambda x: x != 0), F.lit(False))


def unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(bits: int, tables: int, seed: int):
    """Signs against random planes, ``tables`` numbers per vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                dim = int(dim)
                if dim not in planes:
                    rng = np.random.default_rng([seed, dim])
                    planes[dim] = rng.standard_normal((dim, tables * bits))
                signs = (unit(part["vec"]) @ planes[dim] > 0).reshape(len(part), tables, bits)
                code = signs @ (1 << np.arange(bits, dtype=np.int64))
                yield pd.DataFrame(
                    {
                        "node": np.repeat(part["node"].to_numpy(), tables),
                        "block": np.repeat(part["block"].to_numpy(), tables),
                        "tab": np.tile(np.arange(tables), len(part)),
                        "code": code.reshape(-1),
                    }
                )

    return run


def nearest(ids: np.ndarray, x: np.ndarray, grp: np.ndarray, k: int, bound: np.ndarray | None = None) -> pd.DataFrame:
    """Each row's k nearest of other groups; with ``bound`` only those nearer than it."""
    if len(ids) < 2:
        return pd.DataFrame({"src": ids[:0], "dst": ids[:0], "cos": np.zeros(0)})
    cos = x @ x.T
    cos[grp[:, None] == grp[None, :]] = -2.0
    k = min(k, len(ids) - 1)
    best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    src, dst = np.repeat(np.arange(len(ids)), k), best.reshape(-1)
    c = cos[src, dst]
    keep = c > -1.5
    if bound is not None:
        keep &= c > bound[src]
    return pd.DataFrame({"src": ids[src[keep]], "dst": ids[dst[keep]], "cos": c[keep]})


def runs(part: pd.DataFrame, keys: list[str]) -> Iterator[np.ndarray]:
    """The row numbers of each group of a job that holds many small groups."""
    columns = [part[c].to_numpy() for c in keys]
    order = np.lexsort(columns)
    change = np.zeros(len(order), dtype=bool)
    for c in columns:
        change[1:] |= c[order][1:] != c[order][:-1]
    yield from np.split(order, np.flatnonzero(change))


def listed(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames) if frames else pd.DataFrame({"src": [], "dst": [], "cos": []})


def top(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each source; a pair found twice counts once."""
    w = Window.partitionBy("src").orderBy(F.desc("cos"), "dst")
    once = edges.groupBy("src", "dst").agg(F.max("cos").alias("cos"))
    return once.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def largest_jobs(rows: int) -> int:
    """Jobs of about 4,000 vectors."""
    return rows // 4000


def extent(nodes: DataFrame) -> tuple[int, int]:
    """Nodes of the largest block, and of all."""
    counts = nodes.groupBy("block").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    return int(counts[0] or 0), int(counts[1] or 0)


def saturated(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """(src) of full lists whose last entry is a link: there may be links beyond."""
    return lists.groupBy("src").agg(F.min("cos").alias("last"), F.count("*").alias("n")).where(
        (F.col("n") >= k) & (F.col("last") >= threshold)
    ).select("src")


def start_lists(nodes: DataFrame, k: int, threshold: float, seed: int) -> DataFrame:
    """First neighbours: the nearest of other groups in buckets of equal plane signs.
    There are so many tables that a pair at the threshold meets in one but once in a thousand."""
    largest, total = extent(nodes)
    bits = max(2, min(24, int(math.log2(max(largest, 1) / 48 + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    tables = max(4, min(64, math.ceil(math.log(1e-3) / math.log(1 - meet))))
    schema = "node long, block long, tab int, code long"
    coded = nodes.select("node", "block", "dim", "vec").mapInPandas(codes(bits, tables, seed), schema)
    coded = coded.join(nodes.select("node", "grp"), "node")
    key = ["block", "tab", "code"]
    sizes = coded.groupBy(*key).agg(F.count("*").alias("n"), F.min("grp").alias("one"), F.max("grp").alias("two"))
    sizes = sizes.where("one < two").select(*key, "n")
    dealt = coded.join(sizes, key).select(
        "node", "grp", *key, F.pmod(F.xxhash64("node", F.lit(seed), "tab"), F.ceil(F.col("n") / BUCKET)).alias("sub")
    )

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        ids, x, grp = part["node"].to_numpy(), unit(part["vec"]), part["grp"].to_numpy()
        return listed([nearest(ids[i], x[i], grp[i], k) for i in runs(part, [*key, "sub"])])

    jobs = F.pmod(F.xxhash64(*key, "sub"), F.lit(1 + largest_jobs(total * tables)))
    shown = dealt.join(nodes.select("node", "vec"), "node").withColumn("job", jobs)
    return shown.groupBy("job").applyInPandas(pairs, EDGES)


def descend(
    lists: DataFrame, nodes: DataFrame, k: int, threshold: float, rounds: int, delta: float, graph: DataFrame | None = None
) -> DataFrame:
    """NN-descent: all neighbours and reverse neighbours of a node are compared with
    each other, and whoever is of another group and comes nearer than the last of a list
    enters it.  ``graph``: further (src, dst) that neighbours are looked for along.

    A list whose last entry is at the threshold is saturated and takes no more here;
    ``joined`` asks again for its links to other components.  Ends when a round adds
    less than the share ``delta`` of new links to the lists that are not saturated."""
    total = extent(nodes)[1]

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        ids, x, bound, grp = part["member"].to_numpy(), unit(part["vec"]), part["bound"].to_numpy(), part["grp"].to_numpy()
        return listed([nearest(ids[i], x[i], grp[i], k, bound[i]) for i in runs(part, ["mid", "part"])])

    for step in range(rounds):
        last = lists.groupBy("src").agg(F.min("cos").alias("bound"), F.count("*").alias("n"))
        bound = F.when(F.col("n") < k, -2.0).when(F.col("bound") >= threshold, 3.0).otherwise(F.col("bound"))
        last = last.select(F.col("src").alias("node"), bound.alias("bound"))
        along = lists.select("src", "dst") if graph is None else lists.select("src", "dst").unionByName(graph)
        around = along.select(F.col("src").alias("mid"), F.col("dst").alias("member"))
        around = around.unionByName(along.select(F.col("dst").alias("mid"), F.col("src").alias("member"))).distinct()
        around = around.join(nodes.select(F.col("node").alias("member"), "grp"), "member")
        degree = around.groupBy("mid").agg(F.count("*").alias("n"), F.min("grp").alias("one"), F.max("grp").alias("two"))
        degree = degree.where("one < two").select("mid", "n")
        part = F.pmod(F.xxhash64("member", F.lit(step)), F.ceil(F.col("n") / 64)).alias("part")
        shown = around.join(degree, "mid").select("mid", "member", "grp", part)
        known = nodes.select("node", "vec").join(last, "node", "left").fillna(-2.0, ["bound"])
        job = F.pmod(F.xxhash64("mid", "part"), F.lit(1 + largest_jobs(2 * k * total)))
        new = (
            shown.join(known, shown.member == known.node).select("mid", "part", "member", "grp", "vec", "bound", job.alias("job"))
            .groupBy("job").applyInPandas(pairs, EDGES)
        )
        new = new.groupBy("src", "dst").agg(F.max("cos").alias("cos")).join(lists.select("src", "dst"), ["src", "dst"], "left_anti")
        new = stored(top(new, k), "nearer")
        here = new.where(F.col("cos") >= threshold).count()
        there = lists.join(saturated(lists, k, threshold), "src", "left_anti").where(F.col("cos") >= threshold).count()
        lists = stored(top(lists.unionByName(new), k), "lists")
        if here <= delta * there:
            break
    return lists


def joined(
    edges: DataFrame, lists: DataFrame, nodes: DataFrame, k: int, threshold: float, rounds: int, delta: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(edges, components) after saturated lists were refilled from other components.

    A link of a list that is not saturated is in it, so what is missing lies between
    saturated ones.  They get new lists without members of their own component, and these
    links make components again, until a round adds none."""
    full = stored(saturated(lists, k, threshold).select(F.col("src").alias("node")), "full")
    graph = stored(lists.join(full.select(F.col("node").alias("src")), "src", "left_semi").select("src", "dst"), "graph")
    step = 0
    while True:
        labels = stored(components(edges), "components")
        grouped = full.join(labels, "node").join(nodes.select("node", "block", "dim", "vec"), "node")
        grouped = grouped.select("node", "block", "dim", "vec", F.col("component").alias("grp"))
        several = grouped.groupBy("block").agg(F.min("grp").alias("one"), F.max("grp").alias("two")).where("one < two")
        asked = stored(grouped.join(several.select("block"), "block", "left_semi"), "asked")
        if asked.isEmpty():
            return edges, labels
        step += 1
        found = stored(top(start_lists(asked, k, threshold, 1000 * step + seed), k), "lists")
        found = descend(found, asked, k, threshold, rounds, delta, graph)
        near = found.where(F.col("cos") >= threshold).select("src", "dst")
        if near.isEmpty():
            return edges, labels
        edges = edges.unionByName(near)


def weigh(threshold: float):
    """Links of each member of a job: per component, block against block."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in part.groupby("component"):
            ids, m, side = g["node"].to_numpy(), g["m"].to_numpy(), g["side"].to_numpy()
            x = unit(g["vec"])
            a, b = side != 1, side != 0  # 0: rows of the pair, 1: columns, 2: both
            near = x[a] @ x[b].T >= threshold
            near &= ids[a][:, None] != ids[b][None, :]
            out.append(pd.DataFrame({"node": ids[a], "links": near @ m[b]}))
        return pd.concat(out)

    return run


def bound_together(threshold: float):
    """Each member of a job that has a link, with one member that its links reach in the job."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in part.groupby("component"):
            ids, x = g["node"].to_numpy(), unit(g["vec"])
            near = x @ x.T >= threshold
            np.fill_diagonal(near, True)
            name = ids
            while True:
                least = np.where(near, name[None, :], np.iinfo(np.int64).max).min(axis=1)
                if (least == name).all():
                    break
                name = least
            out.append(pd.DataFrame({"src": ids[name != ids], "dst": name[name != ids]}))
        return pd.concat(out)

    return run


def exact_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges with the components that all links between nodes of a block make."""
    jobs = block_pairs(nodes.select(F.col("block").alias("component"), "node", "vec", "m"))
    return jobs.groupBy("job", "i", "j").applyInPandas(bound_together(threshold), "src long, dst long").distinct()


def exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links) for members (component, node, vec, m).  Blocks of a component are
    compared pairwise and only the number of links is kept, so that no pair is ever a row."""
    counted = block_pairs(members).groupBy("job", "i", "j").applyInPandas(weigh(threshold), "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def block_pairs(members: DataFrame) -> DataFrame:
    """Jobs (job, i, j) that together hold each pair of members of a component."""
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    sized = members.join(sizes, "component").where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    small = sized.where("blocks = 1").select(
        F.pmod(F.xxhash64("component"), F.lit(4096)).alias("job"), F.lit(0).cast("long").alias("i"),
        F.lit(0).cast("long").alias("j"), "component", "node", "vec", "m", F.lit(2).alias("side"),
    )
    large = sized.where("blocks > 1").withColumn("own", mine)
    rows = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    same = F.col("own") == F.col("other")
    cols = ["component", "node", "vec", "m"]
    as_row = rows.select(F.col("component").alias("job"), F.col("own").alias("i"), F.col("other").alias("j"), *cols,
                         F.when(same, 2).otherwise(0).alias("side"))
    as_column = rows.where(~same).select(F.col("component").alias("job"), F.col("other").alias("i"),
                                         F.col("own").alias("j"), *cols, F.lit(1).alias("side"))
    return small.unionByName(as_row).unionByName(as_column)


def audit(nodes: DataFrame, labels: DataFrame, found: DataFrame, threshold: float, sample: int, recall: float) -> list[int]:
    """The blocks of which sampled nodes know less than ``recall`` of their links, on average
    of nodes.  ``sample`` nodes a block are held against its rows, and one node each of as
    many components, so that neither a large block nor a large component hides others; of
    many blocks the first in the order of a hash.  Only the sample is sent out."""
    by = Window.partitionBy("block", "kind").orderBy("h", "node")
    spread = F.xxhash64("node", F.lit("audit")).alias("h")
    any_node = nodes.select("node", "block", spread, F.lit(0).alias("kind"))
    linked = nodes.join(labels, "node").select("node", "block", "component", spread)
    one = linked.groupBy("block", "component").agg(F.min(F.struct("h", "node")).alias("s"))
    one = one.select("s.node", "block", "s.h", F.lit(1).alias("kind"))
    drawn = any_node.unionByName(one).withColumn("r", F.row_number().over(by)).where(F.col("r") <= sample)
    drawn = drawn.orderBy("r", "h", "node", "kind").limit(10 * sample).select("node", "kind")
    asked = drawn.join(nodes.select("node", "block", "vec"), "node").toPandas()
    if asked.empty:
        return []
    kinds = nodes.sparkSession.createDataFrame([(int(n), int(b), int(k)) for n, b, k in zip(asked["node"], asked["block"], asked["kind"], strict=True)],
                                               "node long, block long, kind int")
    groups = {k: (g["node"].to_numpy(), unit(g["vec"])) for k, g in asked.drop_duplicates("node").groupby("block")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, part in batch.groupby("block"):
                if block in groups:
                    ids, x = groups[block]
                    near = (x @ unit(part["vec"]).T >= threshold) & (ids[:, None] != part["node"].to_numpy()[None, :])
                    yield pd.DataFrame({"node": ids, "there": near @ part["m"].to_numpy()})

    true = nodes.select("node", "block", "vec", "m").mapInPandas(run, "node long, there long")
    true = true.groupBy("node").agg(F.sum("there").alias("there")).where("there > 0")
    got = kinds.join(true, "node").join(found, "node", "left")
    known = F.avg(F.coalesce("links", F.lit(0)) / F.col("there")).alias("known")
    short = got.groupBy("block", "kind").agg(known).where(F.col("known") < recall)
    return sorted({r.block for r in short.collect()})


def near_vectors(
    rows: DataFrame, key: str, vector: str, label: str, threshold: float = 0.98, k: int = 8,
    rounds: int = 6, delta: float = 0.002, sample: int = 300, recall: float = 0.99, attempts: int = 3,
) -> DataFrame:
    """Links between vectors of one label with a cosine of at least ``threshold``.

    Equal vectors are one node, weighted by their number.  NN-descent refines lists of
    ``k`` neighbours; edges at or above the threshold make components, full lists are
    refilled from other components until that joins none, and every link in a component
    is counted exactly.  ``audit`` measures recall on ``sample`` nodes of each label; labels
    below ``recall`` get lists twice as long, started from other planes, ``attempts``
    times, and those still below are compared pair by pair, in blocks.

    Returns one row per input row: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable), kept.  Vectors that are null, zero or hold
    null or non-finite parts, and rows without a label, link with nothing and are their
    own component; so does a row without a key, whose result is null, 0, null, true.
    Vectors of different lengths are never compared.  Repeated rows count as copies.
    Other columns of ``rows`` are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vec"), F.col(label).alias("label"))
    good = usable("vec") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    node = F.struct("label", "vec")
    nodes = given.where(good).groupBy("label", "vec").agg(F.min("vec_id").alias("node"), F.count("*").alias("m"))
    nodes = stored(
        nodes.select("node", F.xxhash64("label", F.size("vec")).alias("block"), F.size("vec").alias("dim"), "vec", "m",
                     F.xxhash64(node).alias("h"), F.col("node").alias("grp")), "nodes",
    )
    edges, links, labels, asked = None, None, None, nodes
    for attempt in range(attempts + 1):
        if attempt < attempts:
            lists = stored(top(start_lists(asked, k, threshold, attempt), k), "lists")
            lists = descend(lists, asked, k, threshold, rounds, delta)
            near = lists.where(F.col("cos") >= threshold).select("src", "dst")
            edges = near if edges is None else edges.unionByName(near)
            edges, labels = joined(edges, lists, asked, k, threshold, rounds, delta, attempt)
        else:
            edges = edges.unionByName(stored(exact_edges(asked, threshold), "exact"))
            labels = stored(components(edges), "components")
        links = stored(exact_links(labels.join(nodes.select("node", "vec", "m"), "node"), threshold), "links")
        short = audit(asked, labels, links, threshold, sample, recall) if attempt < attempts else []
        if not short:
            break
        asked = nodes.where(F.col("block").isin(short))
        k *= 2
    known = (
        nodes.join(labels, "node", "left").join(links, "node", "left")
        .select("h", "node", "m", F.coalesce("component", "node").alias("component_id"),
                F.coalesce("links", F.lit(0)).alias("links"))
    )
    known = known.withColumnRenamed("h", "_k").withColumn("_seen", F.lit(True))
    keyed = given.select("vec_id", good.alias("_good"), F.when(good, F.xxhash64(node)).otherwise(F.xxhash64("vec_id")).alias("_k"))
    out = keyed.join(known, "_k", "left").withColumn("_seen", F.coalesce(F.col("_good") & F.col("_seen"), F.lit(False)))
    component = F.when(F.col("_seen"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("_seen"), F.col("links") + F.col("m") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
