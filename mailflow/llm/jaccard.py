"""Similarity join of documents on word shingles by a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.graph import components
from mailflow.llm.spans import U, Words, mix, slices
from mailflow.llm.store import BATCH, passing, stored
from mailflow.session import settings

ORDER_SAMPLE = 16_384  # documents whose shingles tell which are frequent; the order costs or saves time only
FREQUENT = 1 << 17  # frequent shingles known at most, of the sample and of all documents
RECORDS = 1_000  # texts sent to Python at once, so that a worker stays small
MISSED = 4  # documents that send a shingle the sample did not show to be frequent
BITS = 23  # of the filter of documents whose shingles are needed again: 1 MB
NAMES = 200_000  # ids that are broadcast at most, 8 bytes each
CROWD = 8  # groups that share a shingle from which on leaders go on merging them
LEADERS = 16  # that a class meets in such a shingle each round
BAND = 0.01  # of sizes: about one per cent
FALL = 0.97  # as long as a round leaves less than this share of pairs of such groups
FACTORS = mix(np.arange(1, 65, dtype=U)) | U(1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, doc, hash): each text's distinct shingles, ordered by hash."""
    for a, b, offsets, data in slices(texts):
        words = Words(offsets, data)
        h, doc = words.hashed(words.end), words.doc
        with np.errstate(over="ignore"):
            if len(h) >= size:
                grams = np.zeros(len(h) - size + 1, U)
                for j in range(size):
                    grams += h[j : len(grams) + j] * FACTORS[j]
                whole = doc[: len(grams)] == doc[size - 1 :]
                grams, owner = mix(grams[whole]), doc[: len(grams)][whole]
            else:
                grams, owner = np.zeros(0, U), np.zeros(0, np.int64)
            counts = np.bincount(doc, minlength=b - a)
            short = np.flatnonzero((counts > 0) & (counts < size))
            if len(short):
                first = np.searchsorted(doc, short)
                one = counts[short].astype(U) * FACTORS[60]
                for j in range(size - 1):
                    has = counts[short] > j
                    one[has] += h[first[has] + j] * FACTORS[32 + j]
                grams, owner = np.concatenate([grams, mix(one)]), np.concatenate([owner, short])
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        yield a, b - a, owner[keep], grams[keep]


def class_of(rows: int, owner: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles, and a hash of the whole set, per text."""
    n = np.bincount(owner, minlength=rows)
    edges = np.concatenate([[0], np.cumsum(n)])
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(grams ^ FACTORS[50]))])
        return n, mix(sums[edges[1:]] - sums[edges[:-1]] + n.astype(U)).view(np.int64)


def all_shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, grams in shingle_sets(batch.column(1), size):
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], ["token"])

    return run


def rare_ones(
    size: int, share: float, tokens: np.ndarray, counts: np.ndarray, texts: pa.Array, valid: np.ndarray, seen: set[int]
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, n, class, row, hash): the rarest shingles of each text, so many that
    two texts as similar as asked for have one in common: n - ceil(share n) + 1, frequent
    ones last.  Copies that follow each other in a task send them once."""
    for a, rows, owner, grams in shingle_sets(texts, size):
        n, c = class_of(rows, owner, grams)
        fresh = np.zeros(rows, bool)
        for i in np.flatnonzero((n > 0) & valid[a : a + rows]):
            if c[i] not in seen:
                fresh[i] = True
                seen.add(c[i])
        if len(seen) > 50_000:
            seen.clear()
        keep = fresh[owner]
        owner, grams = owner[keep], grams[keep]
        often = np.zeros(len(grams), np.int64)
        if len(tokens):
            at = np.minimum(np.searchsorted(tokens, grams), len(tokens) - 1)
            often = np.where(tokens[at] == grams, counts[at], 0)
        order = np.lexsort((grams, often, owner))
        owner, grams = owner[order], grams[order]
        m = np.where(fresh, n, 0)
        place = np.arange(len(grams)) - (np.cumsum(m) - m)[owner]
        take = place < (n - np.ceil(share * n - 1e-9).astype(np.int64) + 1)[owner]
        yield a, rows, n, c, owner[take], grams[take]


def sized(size: int, share: float, tokens: np.ndarray, counts: np.ndarray):
    """(doc_id, n, class, rarest shingles) of each text; a text without doc_id sends none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for a, rows, n, c, row, grams in rare_ones(size, share, tokens, counts, batch.column(1), valid, seen):
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, rows), pa.array(n.astype(np.int64)), pa.array(c), lists],
                    ["doc_id", "n", "c", "tokens"],
                )

    return run


def prefixes(size: int, share: float, tokens: np.ndarray, counts: np.ndarray, wanted: np.ndarray):
    """(token, c): the rarest shingles of the texts whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            bit = batch.column(1).to_numpy()
            chosen = batch.filter(pa.array((wanted[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1)).column(0)
            for _, _, _, c, row, grams in rare_ones(size, share, tokens, counts, chosen, np.ones(len(chosen), bool), seen):
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(c[row])], ["token", "c"])

    return run


def arrays(size: int, wanted: np.ndarray):
    """(c, tokens) of the texts whose bit is set; a class comes once from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            bit = batch.column(1).to_numpy()
            chosen = batch.filter(pa.array((wanted[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            for _, rows, owner, grams in shingle_sets(chosen.column(0), size):
                n, c = class_of(rows, owner, grams)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(grams.view(np.int64)))
                fresh = []
                for key, some in zip(c.tolist(), n.tolist()):
                    fresh.append(some > 0 and key not in seen)
                    seen.add(key)
                found = pa.RecordBatch.from_arrays([pa.array(c), lists], ["c", "tokens"])
                yield found.filter(pa.array(fresh, pa.bool_()))

    return run


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of (token, count), at most ``FREQUENT``, by token.  A histogram of
    eight steps per doubling tells from which count on they are so few."""
    level = F.floor(8 * F.log2("count"))
    counts = stored(counts.withColumn("level", level), "counts", RECORDS)
    least, total = None, 0
    for row in sorted(counts.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, U), np.zeros(0, np.int64)
    rows = counts.where(F.col("level") >= least).select("token", "count").toPandas()
    tokens, n = rows["token"].to_numpy(np.int64).view(U), rows["count"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def larger(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both lists in one, by token, with the larger count."""
    tokens, at = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    n = np.zeros(len(tokens), np.int64)
    np.maximum.at(n, at, np.concatenate([one[1], two[1]]))
    return tokens, n


def bitmap(ids: DataFrame) -> np.ndarray:
    """A filter of 2^23 bits of the column ``bit``: at most 256 pieces of 4 KB."""
    bit = F.col("bit") + 1
    parts = ids.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in parts.collect():
        out[(row.b - 1) * 4096 : row.b * 4096] = np.frombuffer(row.m, np.uint8)
    return out


def need(x: Column, y: Column, percent: int) -> Column:
    """Shingles that the rarest ones of sets of x and y shingles must have in common.

    The set whose rarest shingles end first in the common order can meet the other's only
    among those, and in its remaining ceil(share x) - 1.  So of the overlap that the
    similarity asks for, ceil(share (x + y) / (1 + share)), all but max(ceil(share x),
    ceil(share y)) - 1 lie there, and one at least."""
    overlap = F.ceil(F.lit(percent) * (x + y) / (100.0 + percent) - 1e-9)
    return F.greatest(F.lit(1), overlap - F.greatest(F.ceil(percent * x / 100.0 - 1e-9), F.ceil(percent * y / 100.0 - 1e-9)) + 1)


def least_need(n: Column, low: Column, high: Column, percent: int) -> Column:
    """A bound that ``need`` of n and any size from ``low`` to ``high`` does not fall below.

    ``need`` itself has dips inside a range, from its ceilings.  Without them it is larger
    than share (n + y) / (1 + share) - share max(n, y), which rises up to y = n and falls
    from there, so that its least value is at an end of the range."""
    free = lambda y: percent * (n + y) / (100.0 + percent) - percent * F.greatest(n, y) / 100.0
    return F.greatest(F.lit(1), F.floor(F.least(free(low), free(high)) - 1e-6) + 1)


def whole_sets(active: DataFrame, texts: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(c, tokens) of the active classes: one text of each is read again.  Where the filter
    is crowded, sets of other classes come along, and some come from several tasks."""
    ids = active.select("c").join(classes, "c").select(F.col("rep").alias("doc_id"))
    shown = texts.select("text", bit_of("doc_id")).mapInArrow(arrays(size, bitmap(ids.select(bit_of("doc_id")))), "c long, tokens array<long>")
    return stored(shown, "arrays", RECORDS)


def named_by(rows: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Those rows (c, ...) that ``pairs`` (a, b) name, so that a join with both ends moves
    no others.  The names are broadcast while they are at most ``NAMES``."""
    ids = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    ids = stored(ids, f"{name}-ids")
    few = ids.count() <= NAMES
    return stored(rows.join(F.broadcast(ids) if few else ids, "c", "left_semi"), name, RECORDS)


def similar(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose sets have ``percent`` of their union in common."""
    with passing(pairs.sparkSession):
        pairs = stored(pairs, "pairs")
        known = named_by(known, pairs, "compared").dropDuplicates(["c"])
        one = known.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
        two = known.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
        both = pairs.join(one, "a").join(two, "b")
        common = F.size(F.array_intersect("ta", "tb"))
        both = both.select("a", "b", common.alias("common"), (F.size("ta") + F.size("tb")).alias("total"))
        alike = both.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")
        return stored(alike, "similar", stays=True)


def rarest(bound: DataFrame) -> DataFrame:
    """Of the shingles (c, h, token, holders, least) that a class shares with a group, the
    k - ``least`` + 1 rarest there, one of which all members have that share ``least``."""
    pair = Window.partitionBy("c", "h")
    bound = bound.withColumn("k", F.count("*").over(pair)).where("k >= least")
    bound = bound.withColumn("place", F.row_number().over(pair.orderBy("holders", "token")))
    return bound.where("place <= k - least + 1").select("c", "h", "token", "holders")


def merged(links: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(g, component) of the groups that links (a, b) join; without ``groups`` each class is
    its own.  Links within a group say nothing new, and those between two groups say the same."""
    if groups is None:
        links = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    else:
        links = links.join(groups.select(F.col("c").alias("a"), F.col("g").alias("src")), "a")
        links = links.join(groups.select(F.col("c").alias("b"), F.col("g").alias("dst")), "b").select("src", "dst")
    return components(links).select(F.col("node").alias("g"), "component")


def whole_bound(wide: DataFrame, banded: DataFrame, linked: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(c, b): the members that classes may link with in the groups they ask (c, h), without
    those that ``linked`` has joined already.

    The bound is that of the rarest shingles, on whole sets: a class must share
    ceil(share (x + y) / (1 + share)) shingles with a member, so that one that lies just
    beyond a group of near copies opens the few members that have its own shingles, not
    all that have the group's."""
    now = banded.join(merged(linked, banded), "g", "left").select("c", "n", "h", F.coalesce("component", "g").alias("top"))
    now = stored(now, "merged")
    spans = now.groupBy("h").agg(F.first("top").alias("other"), F.min("n").alias("low"))
    rest = wide.join(now.select("c", "n", "top"), "c").join(spans, "h").where("top <> other")
    low = F.greatest("low", F.ceil(percent * F.col("n") / 100.0 - 1e-9))
    least = F.ceil(percent * (F.col("n") + low) / (100.0 + percent) - 1e-9)
    rest = stored(rest.select("c", "h", least.alias("least")), "unlinked")
    members = stored(now.select("h", "c").join(rest.select("h").distinct(), "h", "left_semi"), "asked-members")
    ids = rest.select("c").unionByName(members.select("c")).select(F.col("c").alias("a"), F.col("c").alias("b"))
    sets = named_by(known, ids, "whole").dropDuplicates(["c"])
    held = stored(members.join(sets, "c").select("h", F.col("c").alias("b"), F.explode("tokens").alias("token")), "held")
    own = rest.join(sets, "c").select("c", "h", "least", F.explode("tokens").alias("token"))
    bound = own.join(held.groupBy("h", "token").agg(F.count("*").alias("holders")), ["h", "token"])
    return rarest(bound).join(held, ["h", "token"]).select("c", "b")


def jaccard_components(rows: DataFrame, key: str, text: str, size: int = 5, percent: int = 75, rounds: int = 8) -> DataFrame:
    """Documents linked by 100 * intersection >= ``percent`` * union of their shingle sets.

    Equal sets are one class.  A class sends its rarest shingles (``sized``), and those of a
    better order where that changes them (``class_posts``); what meets
    is compared first with one leader per shingle, then, where many groups share a shingle,
    with ``LEADERS`` members of larger groups there, others each round; this partitions
    similar classes into groups.  The matrix then holds, for each group and band of sizes,
    the union of its rarest shingles.  A class's overlap with the union bounds its overlap
    with any member, so it asks by all but ``least`` - 1 of its shingles only, and a group
    that reaches the bound is opened by the shingles rarest in it; members that reach what
    ``need`` asks for are compared on whole sets.  Where that would open more than ``LEADERS``
    members, the group's most typical ones are compared first and the rest by ``whole_bound``.  Smaller groups ask larger ones, and pairs
    within a group are never formed.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable).  Texts with fewer
    words than ``size`` have their whole sequence as one shingle; null and empty texts have
    none and link with nothing, nor do rows without a key, whose component is null.  Rows
    that repeat a key are one document to its links.  Other columns are not looked at.
    Shingles and sets are told apart by 64-bit hashes.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = given.where("doc_id IS NOT NULL")
    with passing(rows.sparkSession):  # the shingles' tables take more than the texts
        with passing(rows.sparkSession):
            sampled = sample_order(texts, size)
            sent = given.mapInArrow(sized(size, percent / 100, *sampled), "doc_id long, n long, c long, tokens array<long>")
            sent = stored(sent, "sent", RECORDS)
            sets = stored(sent.drop("tokens"), "sets", stays=2)
            posts = stored(class_posts(sent, texts, sampled, size, percent / 100), "posts", RECORDS, stays=1)
        linked = sets.where("n > 0 AND doc_id IS NOT NULL")
        classes = linked.groupBy("c").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
        classes = stored(classes, "classes", stays=1)
        grouped = stored(class_groups(posts, texts, classes, size, percent, rounds), "grouped", stays=1)
    labelled = classes.join(grouped, "c", "left").select("c", "rep", F.coalesce("g", "c").alias("g"))
    least = labelled.groupBy("g").agg(F.min("rep").alias("component_id"))
    final = labelled.join(least, "g").select("c", "component_id")
    alone = sets.where("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    together = linked.join(final, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return together.unionByName(alone)


def bit_of(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << BITS)).alias("bit")


def sample_order(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles of a sample, with what their counts would be in all texts."""
    rate = max(1, texts.count() // ORDER_SAMPLE)
    drawn = texts.where(F.pmod(F.xxhash64("text", F.lit("order")), F.lit(rate)) == 0).dropDuplicates(["text"])
    seen = drawn.mapInArrow(all_shingles(size), "token long").groupBy("token").count().where("count > 1")
    return frequent(seen.select("token", (F.col("count") * rate).alias("count")))


def class_posts(
    sent: DataFrame, texts: DataFrame, sampled: tuple[np.ndarray, np.ndarray], size: int, share: float
) -> DataFrame:
    """(token, c): the rarest shingles of the classes that another class has among its own.

    Shingles that the sample missed and yet many documents sent as rare ones are frequent
    too.  Their counts only rise, so they only fall back in the order: a text that sent none
    of them keeps its rarest ones, and only the others are read again."""
    flat = lambda some: some.select(F.explode("tokens").alias("token"), "c")
    missed = flat(sent).groupBy("token").agg(F.count("*").alias("count"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    counted = frequent(missed.where(f"lo < hi AND count >= {MISSED}").select("token", "count"))
    risen = counted[0]

    @F.arrow_udf("boolean")
    def asked_again(tokens: pa.Array) -> pa.Array:
        own = tokens.flatten().to_numpy(zero_copy_only=False).view(U)
        hit = np.zeros(len(own) + 1, np.int64)
        if len(risen):
            hit[1:] = np.cumsum(risen[np.minimum(np.searchsorted(risen, own), len(risen) - 1)] == own)
        at = tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
        return pa.array(hit[at[1:]] > hit[at[:-1]])

    own = sent.where(F.size("tokens") > 0)
    again = asked_again("tokens")
    with settings(sent.sparkSession, {BATCH: str(RECORDS)}):
        wanted = bitmap(own.where(again).select(bit_of("doc_id")))
    read = texts.select("text", bit_of("doc_id")).mapInArrow(
        prefixes(size, share, *larger(sampled, counted), wanted), "token long, c long"
    )
    sent = flat(own.where(~again)).unionByName(read)
    w = Window.partitionBy("token")
    met = sent.withColumn("lo", F.min("c").over(w)).withColumn("hi", F.max("c").over(w)).where("lo < hi")
    return met.select("token", "c").distinct()


def class_groups(
    posts: DataFrame, texts: DataFrame, classes: DataFrame, size: int, percent: int, rounds: int
) -> DataFrame:
    """(c, g) of the classes that meet others: the group of each, see ``jaccard_components``."""
    share = percent / 100
    active = stored(posts.select("c").distinct().join(classes, "c").select("c", "n"), "active")

    known = whole_sets(active, texts, classes, size)
    groups, most, dense = active.select("c", "n", F.col("c").alias("g")), None, posts
    for step in range(rounds):
        with passing(posts.sparkSession):  # tables of a round go with it
            placed = dense.join(groups, "c")
            if step == 0:  # a class meets the leaders of all its shingles, and takes the one it shares most with
                lead = placed.groupBy("token").agg(F.min_by(F.struct(F.col("c").alias("b"), F.col("n").alias("m")), F.xxhash64("c")).alias("l"))
                met = placed.join(lead.select("token", "l.*"), "token").where("c <> b").groupBy("c", "b", "n", "m").agg(F.count("*").alias("k"))
                met = met.where(F.col("k") >= need(F.col("n"), F.col("m"), percent))
            else:  # it meets leaders in groups larger than its own: of its most crowded shingle, others each round
                counted = groups.groupBy("g").agg(F.count("*").alias("size"))
                room = placed.join(crowded, "token").groupBy("c", "g", "n").agg(F.max_by("token", F.struct("groups", "token")).alias("token"))
                room = stored(room.join(counted, "g").withColumn("rank", F.struct("size", "g")), "rooms")
                one = F.struct(F.col("c").alias("b"), F.col("rank").alias("other"), F.col("n").alias("m"))
                drawn = F.array(*[F.min_by(one, F.struct(-F.col("size"), F.xxhash64("c", F.lit(step * LEADERS + i)))) for i in range(LEADERS)])
                lead = room.groupBy("token").agg(F.array_distinct(drawn).alias("leads")).select("token", F.inline("leads"))
                met = room.join(lead, "token").where("rank < other").select("c", "b", "n", "m")
            fits = (100 * F.col("m") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("m"))
            met = met.where(fits)
            if step == 0:
                met = met.groupBy("c").agg(F.max_by("b", F.struct("k", "b")).alias("b"))
            found = similar(met.select(F.col("c").alias("a"), "b"), known, percent)
            named = merged(found, None if step == 0 else groups)  # links of earlier rounds are in the groups
            groups = stored(groups.join(named, "g", "left").select("c", "n", F.coalesce("component", "g").alias("g")), "groups", stays=True)
        # go on where many groups share a shingle, as long as they get fewer; merging crowds no other
        crowded = dense.join(groups, "c").groupBy("token").agg(F.count_distinct("g").alias("groups"))
        crowded = stored(crowded.where(F.col("groups") >= CROWD), "crowded")
        still = crowded.agg(F.coalesce(F.sum(F.col("groups") * F.col("groups")), F.lit(0))).first()[0]
        if still == 0 or (step > 0 and still > FALL * most):
            break
        if step == 0:
            dense = stored(posts.join(crowded.select("token"), "token"), "dense")
        most = still

    # a class asks the groups larger than its own; the other direction is asked by their members.
    # A group is asked by bands of about equal sizes, which makes the bounds tight.
    band = F.xxhash64("g", F.floor(F.log("n") / BAND)).alias("h")
    counted = groups.groupBy("g").agg(F.count("*").alias("members"))
    banded = stored(groups.select("*", band).join(counted, "g"), "bands")
    placed = posts.join(banded, "c")
    lists = placed.groupBy("token").agg(F.min("g").alias("one"), F.max("g").alias("two")).where("one < two").select("token")
    placed = stored(placed.join(lists, "token").select("token", "c", "g", "h", "n", "members"), "matrix")
    # the matrix: shingle and group, with the group's sizes and how many of it have the shingle
    matrix = placed.groupBy("token", "h").agg(F.count("*").alias("holders"), F.struct(F.first("members"), F.first("g")).alias("others"))
    spans = banded.groupBy("h").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    matrix = stored(matrix.join(spans, "h"), "token-groups")
    # what shares ``least`` of a class's shingles shares one of all but ``least`` - 1, the least crowded ones
    width = matrix.groupBy("token").agg(F.count("*").alias("width"))
    own = Window.partitionBy("c")
    asking = placed.drop("h").join(width, "token").withColumn("place", F.row_number().over(own.orderBy("width", "token")))
    asking = asking.withColumn("shared", F.count("*").over(own))
    low, high = F.greatest("low", F.col("n") * share), F.least("high", F.col("n") / share)
    least = least_need(F.col("n"), F.ceil(low - 1e-9), F.floor(high + 1e-9), percent)
    fits = (low <= high + 1e-9) & (F.col("place") <= F.col("shared") - least + 1)
    larger_one = F.col("others") > F.struct("members", "g")
    asked = asking.join(matrix, "token").where(larger_one & fits).select("c", "h", least.alias("least")).distinct()
    asked = stored(asked, "asked")
    # bound the overlap with the group; a member that reaches it has one of the k - least + 1 shingles rarest there
    bound = placed.select("token", "c").join(asked, "c").join(matrix.select("token", "h", "holders"), ["token", "h"])
    probes = stored(rarest(bound), "opened")
    opens = stored(probes.groupBy("c", "h").agg(F.sum("holders").alias("opens")), "opens")
    narrow = probes.join(opens.where(F.col("opens") <= LEADERS).select("c", "h"), ["c", "h"])
    near = narrow.join(placed.select("token", "h", F.col("c").alias("b")), ["token", "h"]).select("c", "b")
    # what would open many members meets the typical ones first; whole sets bound what these leave
    wide = opens.where(F.col("opens") > LEADERS).select("c", "h")
    held = placed.join(matrix.select("token", "h", "holders"), ["token", "h"]).groupBy("h", "c").agg(F.sum("holders").alias("held"))
    first = F.row_number().over(Window.partitionBy("h").orderBy(F.desc("held"), "c"))
    typical = held.withColumn("place", first).where(F.col("place") <= LEADERS).select("h", F.col("c").alias("b"))
    linked = similar(wide.join(typical, "h").select(F.col("c").alias("a"), "b"), known, percent)
    near = near.unionByName(whole_bound(wide, banded, linked, known, percent)).distinct()
    near = stored(near.select(F.col("c").alias("a"), "b"), "near")
    short = named_by(posts, near, "rare").groupBy("c").agg(F.collect_list("token").alias("rare")).join(active, "c")
    near = near.join(short.select(F.col("c").alias("a"), "n", "rare"), "a")
    near = near.join(short.select(F.col("c").alias("b"), F.col("n").alias("m"), F.col("rare").alias("theirs")), "b")
    fits = (100 * F.col("m") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("m"))
    shared = F.size(F.array_intersect("rare", "theirs"))
    near = near.where(fits & (shared >= need(F.col("n"), F.col("m"), percent)))
    links = similar(near.select("a", "b"), known, percent).unionByName(linked)
    named = merged(links, groups)
    return groups.join(named, "g", "left").select("c", F.coalesce("component", "g").alias("g"))
