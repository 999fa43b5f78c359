"""A Merkle manifest of a table: leaves, roots, proofs and folding of changed leaves."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.store import stored

ARITY = 8
STEP = 3  # levels that one group of nodes climbs
WIDTH = ARITY**STEP
RUN = "struct<slot: int, nodes: array<string>>"
NODE = "struct<idx: long, digest: string>"


# --- in a task: hash states ---------------------------------------------------


class Parent:
    """A run of sibling digests.  It retains the hash state before each child's slot, so
    that a replaced child costs its own digest and those to its right."""

    def __init__(self, nodes: list[str]):
        state = sha256()
        self.states = []
        for node in nodes:
            self.states.append(state.copy())
            state.update(node.encode())
        self.digest = state.hexdigest()
        self.right = ["".join(nodes[i + 1 :]).encode() for i in range(len(nodes))]
        self.others = ["".join(nodes[:i] + nodes[i + 1 :]) for i in range(len(nodes))]

    def fold(self, slot: int, digest: str) -> str:
        state = self.states[slot].copy()
        state.update(digest.encode())
        state.update(self.right[slot])
        return state.hexdigest()


def climb(nodes: list[str], levels: int) -> tuple[list[list[Parent]], list[str]]:
    """Parents of each level above the nodes, and the digests on top."""
    tree = []
    for _ in range(levels):
        tree.append([Parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)])
        nodes = [p.digest for p in tree[-1]]
    return tree, nodes


# --- Spark: order, groups, tree -----------------------------------------------


def in_order(df: DataFrame, group: list[str], order: list[str], rows: int, name: str) -> DataFrame:
    """Add ``idx``, the place of each row within its group, from 0, nulls first.

    Rows are dealt to ranges of group and order, counted per range, and each range is
    numbered by itself: a group that holds most rows lies in many ranges, and so do rows
    that tie, since the order ends in a number of its own.
    """
    parts = max(8, rows // 20_000)
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = stored(df.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()), f"{name}-ranges")
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    starts = starts.select(F.col("_part").alias("_p"), "_start", *[F.col(c).alias(f"_g_{c}") for c in group])
    within = Window.partitionBy(*group, "_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = placed.withColumn("_row", F.row_number().over(within) - 1)
    on = F.col("_part") == F.col("_p")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    found = local.join(starts, on).withColumn("idx", (F.col("_start") + F.col("_row")).cast("long"))
    return found.drop("_part", "_p", "_row", "_start", *[f"_g_{c}" for c in group])


def levels_of(n: Column) -> Column:
    """How often runs of eight are folded until one node remains; exact for any long."""
    powers = F.array(*[F.lit(ARITY**i).cast("long") for i in range(1, 21)])
    return F.when(n > 1, F.size(F.filter(powers, lambda p: p < n)) + 1).otherwise(0)


def same(a: DataFrame, b: DataFrame, *columns: str):
    on = F.lit(True)
    for c in columns:
        on = on & a[c].eqNullSafe(b[c])
    return on


def raise_nodes(nodes: DataFrame, name: str) -> DataFrame:
    """All nodes (tree, idx, digest, levels) below their tree's top: (tree, idx, path,
    top), ``path`` being the run of siblings at each level on the way up.

    Groups of 512 nodes climb three levels each; their tops are the nodes of the next
    round, so a round has 512 times fewer rows than the one before.
    """
    if (nodes.agg(F.max("levels")).first()[0] or 0) == 0:
        return nodes.select("tree", "idx", F.array().cast(f"array<{RUN}>").alias("path"), F.col("digest").alias("top"))
    group = (F.col("idx") / WIDTH).cast("long").alias("group")
    grouped = nodes.groupBy("tree", group).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"), F.max("levels").alias("levels")
    )
    grouped = stored(grouped, f"{name}-groups")
    tops = grouped.select("tree", "group", F.col("nodes.digest").alias("nodes"), "levels").mapInArrow(
        group_tops, "tree string, idx long, digest string, levels int"
    )
    above = raise_nodes(stored(tops, f"{name}-tops"), f"{name}+").withColumnRenamed("idx", "group")
    above = above.withColumnRenamed("tree", "_tree").withColumnRenamed("group", "_group")
    both = grouped.join(above, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("group") == F.col("_group")))
    given = both.select("tree", "group", F.col("nodes.digest").alias("nodes"), "levels", "path", "top")
    return given.mapInArrow(node_paths, f"tree string, idx long, path array<{RUN}>, top string")


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def group_tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tree, group, nodes, levels = (batch.column(c).to_pylist() for c in ("tree", "group", "nodes", "levels"))
        tops = [climb(n, min(k, STEP))[1][0] for n, k in zip(nodes, levels)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, pa.string()), pa.array(group, pa.int64()), pa.array(tops, pa.string()),
             pa.array([max(0, k - STEP) for k in levels], pa.int32())],
            names=["tree", "idx", "digest", "levels"],
        )


def node_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("nodes", pa.list_(pa.string()))]))
    for batch in batches:
        for row in one_by_one(batch):
            levels, nodes = [row["nodes"]], row["nodes"]
            for _ in range(min(row["levels"], STEP)):
                nodes = [Parent(nodes[i : i + ARITY]).digest for i in range(0, len(nodes), ARITY)]
                levels.append(nodes)
            paths = []
            for at in range(len(row["nodes"])):
                path, i = [], at
                for level in levels[:-1]:
                    run = i - i % ARITY
                    path.append({"slot": i % ARITY, "nodes": level[run : run + ARITY]})
                    i //= ARITY
                paths.append(path + row["path"])
            n = len(paths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * n, pa.string()), pa.array(range(row["group"] * WIDTH, row["group"] * WIDTH + n), pa.int64()),
                 pa.array(paths, kind), pa.array([row["top"]] * n, pa.string())],
                names=["tree", "idx", "path", "top"],
            )


def fold_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold every leaf of a group, or what replaces it, up to the root."""
    names = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    for batch in batches:
        for row in one_by_one(batch):
            leaves = row["leaves"]
            tree, _ = climb([leaf["leaf"] for leaf in leaves], min(row["levels"], STEP))
            above = [(Parent(run["nodes"]), run["slot"]) for run in row["path"]]
            rest = "".join(p.others[slot] for p, slot in above)
            folded, proofs = [], []
            for at, leaf in enumerate(leaves):
                digest, i, proof = leaf["changed"] or leaf["leaf"], at, []
                for level in tree:
                    parent, slot = level[i // ARITY], i % ARITY
                    proof.append(parent.others[slot])
                    digest, i = parent.fold(slot, digest), i // ARITY
                for parent, slot in above:
                    digest = parent.fold(slot, digest)
                folded.append(digest)
                proofs.append("".join(proof) + rest)
            n, root = len(leaves), row["root"]
            columns = [
                pa.array([leaf["doc_id"] for leaf in leaves], pa.int64()), pa.array([leaf["leaf"] for leaf in leaves], pa.string()),
                pa.array([row["subroot"]] * n, pa.string()), pa.array([root] * n, pa.string()),
                pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([d == root for d in folded], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


# --- the operator --------------------------------------------------------------


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields in turn, each as length in bytes, colon and value; ``-`` for null."""
    def coded(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(coded, fields)), 256)


def manifest(rows: DataFrame, key: str, group: str, fields: list, changed: list | None = None, when: Column | None = None) -> DataFrame:
    """A Merkle tree of arity 8 over all rows, per ``group`` and then over the groups.

    ``fields`` (names or columns) make a row's leaf.  ``changed`` are the fields as found
    later, where ``when`` holds; the root is then recomputed from the changed leaf and
    the original siblings.  Returns doc_id, leaf, subroot (of its group), root, ``proof``
    (the siblings' digests from leaf to root, left to right, as one text), folded_root
    and verified.

    The text is read once, for the digests; all that is shuffled are digests.  Leaves
    ascend by key (null first) and, where keys tie, by digest; rows equal in all fields
    are interchangeable.  512 leaves make a task's unit of work: their parents keep the
    state of the hash before each child, so a changed leaf resumes there and takes in
    only the siblings to its right.  Higher levels are groups of 512 tops, round by
    round.  A group of any size, null among them, is spread.  No rows give no rows.
    """
    leaf = leaf_digest(*[F.col(f) if isinstance(f, str) else f for f in fields])
    other = F.lit(None).cast("string")
    if changed:
        other = leaf_digest(*[F.col(f) if isinstance(f, str) else f for f in changed])
        other = F.when(when, other) if when is not None else other
    leaves = rows.select(
        F.col(key).cast("long").alias("doc_id"), F.col(group).cast("string").alias("tree"), leaf.alias("leaf"),
        other.alias("changed"), F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    leaves = stored(leaves, "manifest-leaves")
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n"))
    sizes = stored(sizes.withColumn("levels", levels_of(F.col("n"))), "manifest-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0

    ranked = in_order(leaves, ["tree"], ["doc_id", "leaf", "tie"], total, "manifest").drop("tie")
    units = ranked.groupBy("tree", (F.col("idx") / WIDTH).cast("long").alias("unit")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "doc_id", "leaf", "changed"))).alias("leaves")
    )
    sized = sizes.select(F.col("tree").alias("_tree"), "levels")
    units = units.join(sized, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    units = stored(units, "manifest-units")
    digests = units.select("tree", F.col("unit").alias("group"), F.col("leaves.leaf").alias("nodes"), "levels")
    tops = stored(digests.mapInArrow(group_tops, "tree string, idx long, digest string, levels int"), "manifest-tops")
    inner = raise_nodes(tops, "manifest-inner")

    subroots = stored(inner.where("idx = 0").select("tree", F.col("top").alias("subroot")), "manifest-subroots")
    n_trees = subroots.count()
    ordered = in_order(subroots, [], ["tree"], n_trees, "manifest-trees")
    ordered = stored(ordered.withColumnRenamed("tree", "member"), "manifest-ordered")
    one = ordered.select(
        F.lit("").alias("tree"), "idx", F.col("subroot").alias("digest"), levels_of(F.lit(n_trees)).alias("levels")
    )
    outer = raise_nodes(one, "manifest-outer").select(F.col("idx").alias("_idx"), F.col("path").alias("outer"), F.col("top").alias("root"))
    members = ordered.join(outer, F.col("idx") == F.col("_idx")).select(F.col("member").alias("_member"), "subroot", "outer", "root")

    inner = inner.select(F.col("tree").alias("_tree"), F.col("idx").alias("_unit"), "path")
    placed = units.join(inner, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("unit") == F.col("_unit")))
    placed = placed.join(members, F.col("tree").eqNullSafe(F.col("_member")))
    given = placed.select("leaves", "levels", F.concat("path", "outer").alias("path"), "subroot", "root")
    return given.mapInArrow(
        fold_group,
        "doc_id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean",
    )


def crc32_sql(digits: str) -> str:
    """CRC-32 of a number's decimal digits, bit by bit."""
    bits = "list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"list_transform(string_split({digits}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda a, b: {bits}), 4294967295::BIGINT)"


def manifest_sql() -> str:
    """The manifest of ``documents`` by doc_id and lang, a third of the texts in lower case."""
    def leaf(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS found
  FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
inside(lang, lvl, idx, digest, n) AS (
  SELECT lang, 0, idx, leaf, n FROM ranked
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM inside WHERE n > 1 GROUP BY lang, lvl, idx // 8, n),
subroots AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM inside WHERE n = 1),
outside(lvl, idx, digest, n) AS (
  SELECT 0, idx, digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM outside WHERE n > 1 GROUP BY lvl, idx // 8, n),
runs_in AS (SELECT lang, lvl, idx // 8 AS run, list(digest ORDER BY idx) AS nodes FROM inside WHERE n > 1 GROUP BY ALL),
runs_out AS (SELECT lvl, idx // 8 AS run, list(digest ORDER BY idx) AS nodes FROM outside WHERE n > 1 GROUP BY ALL),
up(doc_id, leaf, lang, lvl, idx, digest, proof, n) AS (
  SELECT doc_id, leaf, lang, 0, idx, found, '', n FROM ranked
  UNION ALL
  SELECT u.doc_id, u.leaf, u.lang, u.lvl + 1, u.idx // 8,
    sha256(array_to_string(nodes[:u.idx % 8] || [u.digest] || nodes[u.idx % 8 + 2:], '')),
    u.proof || array_to_string(nodes[:u.idx % 8] || nodes[u.idx % 8 + 2:], ''), (u.n + 7) // 8
  FROM up u JOIN runs_in r ON u.lang IS NOT DISTINCT FROM r.lang AND u.lvl = r.lvl AND u.idx // 8 = r.run WHERE u.n > 1),
over(doc_id, leaf, subroot, lvl, idx, digest, proof, n) AS (
  SELECT u.doc_id, u.leaf, s.digest, 0, s.idx, u.digest, u.proof, s.n
  FROM up u JOIN subroots s ON u.lang IS NOT DISTINCT FROM s.lang WHERE u.n = 1
  UNION ALL
  SELECT u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.idx // 8,
    sha256(array_to_string(nodes[:u.idx % 8] || [u.digest] || nodes[u.idx % 8 + 2:], '')),
    u.proof || array_to_string(nodes[:u.idx % 8] || nodes[u.idx % 8 + 2:], ''), (u.n + 7) // 8
  FROM over u JOIN runs_out r ON u.lvl = r.lvl AND u.idx // 8 = r.run WHERE u.n > 1)
SELECT o.doc_id, o.leaf, o.subroot, t.digest AS root, sha256(o.proof) AS proof_sha256, o.digest AS folded_root,
  o.digest = t.digest AS verified
FROM over o JOIN outside t ON t.n = 1 WHERE o.n = 1"""
