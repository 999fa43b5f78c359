"""Mails that are alike in most of their wording: MinHash bands find most links, prefixes of
rare shingles the rest, and exact Jaccard decides on each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailflow.functions.arrays import let
from mailflow.session import kept, settings

WORDS = 5  # in a shingle
THRESHOLD = 0.75
BANDS = 40
ROWS = 3  # MinHash values in a band
ROUNDS = 3
SEED = 20240501
BITS = 23  # of the filter of ids that pairs name, or of hashes: 1 MB
SAMPLE = 4096  # texts that tell which shingles are frequent; the order costs or saves time only
FREQUENT = 1 << 17  # frequent shingles that the order knows at most
CROWD = 8  # holders of a shingle that the sample missed and that is put later in the order
ORDERS = 3  # tried at most, while one lets more than ``PAIRS`` pairs meet for each text
PAIRS = 64
LOW = np.uint64(58)  # bits of a hash below its place in the order
BUCKET = 250_000  # rare shingles that are looked through at once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Order = tuple[np.ndarray, np.ndarray]  # hashes without their upper bits, ascending, and their counts


def shingles(form: Column, words: int = WORDS) -> Column:
    """Distinct 64-bit hashes of all runs of ``words`` words; a shorter text is one run."""

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - words, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))

    return F.array_distinct(let(F.split(form, " "), runs))


def band_values(flat: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For every set of hashes one key per band of ``rows`` MinHash values.

    Sets that share a share J of their elements agree in a band with probability
    J^rows: at 0.75, 40 bands of 3 miss a pair three times in ten billion.
    """
    rng = np.random.default_rng(SEED)
    odd = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    fold = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
    keys = np.empty((len(begin), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(begin), band, np.uint64)
        for i in range(rows):
            mixed = flat * odd[band * rows + i]
            mixed ^= mixed >> np.uint64(29)
            key = (key ^ np.minimum.reduceat(mixed, begin)) * fold[i]
            key ^= key >> np.uint64(32)
        keys[:, band] = key
    return keys


def placed(flat: np.ndarray, order: Order) -> np.ndarray:
    """Hashes whose upper bits tell how frequent they are, so that rare ones sort first."""
    low = flat >> np.uint64(64 - LOW)
    known, counts = order
    if not len(known):
        return low
    bit = lambda h: (h & np.uint64((1 << BITS) - 1)).astype(np.int64)
    some = np.zeros(1 << BITS, bool)
    some[bit(known)] = True
    maybe = np.flatnonzero(some[bit(low)])
    at = np.minimum(np.searchsorted(known, low[maybe]), len(known) - 1)
    hit = known[at] == low[maybe]
    level = np.minimum(1 + 2 * np.log2(counts[at[hit]]), 31).astype(np.uint64)
    low[maybe[hit]] |= level << LOW
    return low


def signatures(
    forms: DataFrame, threshold: float, words: int, order: Order, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, bands, n, rare): of each text (id, form) its keys by bands, its number of shingles
    and the first n - ceil(threshold n) + 1 of them in the order, rare ones first.

    Texts that are alike in ``threshold`` or more have one of these in common: else the set
    whose part ends first would have no more than its other ceil(threshold n) - 1 to share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column("hashes")
            flat = sets.flatten().to_numpy().view(np.uint64)
            edges = sets.offsets.to_numpy() - sets.offsets.to_numpy()[0]
            n = np.diff(edges)
            keys = band_values(flat, edges[:-1], bands, rows)
            late = placed(flat, order)
            take = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            first = [np.sort(late[a : a + m])[:k] for a, m, k in zip(edges[:-1], n, take)]

            def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), lists(keys.reshape(-1), np.full(len(n), bands)), pa.array(n.astype(np.int32)),
                    lists(np.concatenate([np.zeros(0, np.uint64), *first]), np.minimum(take, n)),
                ],
                names=["id", "bands", "n", "rare"],
            )

    sets = forms.select("id", shingles(F.col("form"), words).alias("hashes"))
    sets = sets.mapInArrow(run, "id string, bands array<bigint>, n int, rare array<bigint>")
    return kept(sets, "similar-keys")


def counted(tokens: DataFrame) -> Order:
    """The most frequent of (token, count)."""
    low = F.col("token").bitwiseAND(F.lit((1 << int(LOW)) - 1))
    rows = tokens.select(low.alias("token"), "count").orderBy(F.desc("count"), "token").limit(FREQUENT).toArrow()
    known, counts = rows["token"].to_numpy().view(np.uint64), rows["count"].to_numpy()
    by = np.argsort(known)
    return known[by], counts[by]


def sampled(forms: DataFrame, words: int, rate: int) -> Order:
    """The frequent shingles of one in ``rate`` texts, with what their counts would be in all."""
    drawn = forms.filter(F.pmod(F.xxhash64("id"), F.lit(rate)) == 0)
    each = drawn.select(F.explode(shingles(F.col("form"), words)).alias("token"))
    seen = each.select(F.shiftrightunsigned("token", 64 - int(LOW)).alias("token")).groupBy("token").count().filter("count > 1")
    return counted(seen.select("token", (F.col("count") * rate).alias("count")))


def both_orders(one: Order, two: Order) -> Order:
    """Both in one, with the larger count."""
    known, at = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    counts = np.zeros(len(known), np.int64)
    np.maximum.at(counts, at, np.concatenate([one[1], two[1]]))
    return known, counts


def jaccard(a: Column, b: Column) -> Column:
    return let(
        F.size(F.array_intersect(a, b)),
        lambda both: both / (F.size(a) + F.size(b) - both),
    )


def bitmap(rows: DataFrame, bit: Column) -> np.ndarray:
    """The bits of all rows, collected as at most 256 pieces of 4 KB."""
    parts = rows.groupBy(F.bitmap_bucket_number(bit + 1).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("m")
    )
    wanted = np.zeros(1 << (BITS - 3), np.uint8)
    for row in parts.collect():
        wanted[(row.b - 1) * 4096 : row.b * 4096] = np.frombuffer(row.m, np.uint8)
    return wanted


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``, and a few others: a join with ``ids`` then need
    not move the rest.  The filter is of 2^23 bits."""
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << BITS))
    wanted = bitmap(ids, bit)

    @F.arrow_udf("boolean")
    def named(bits: pa.Array) -> pa.Array:
        at = bits.to_numpy(zero_copy_only=False)
        return pa.array((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return rows.filter(named(bit))


def alike(pairs: DataFrame, forms: DataFrame, threshold: float, words: int, name: str) -> DataFrame:
    """(id, first, similarity) of those pairs (id, first) whose sets are alike in ``threshold``
    or more; only texts that a pair names are moved, their sets are made where they are compared."""
    here = among(forms.select("id", "form"), pairs.select("id"))
    ends = pairs.select(F.col("first").alias("id"))
    there = among(forms.select("id", "form"), ends).select(F.col("id").alias("first"), F.col("form").alias("other"))
    both = pairs.join(here, "id").join(there, "first")
    one, two = shingles(F.col("form"), words), shingles(F.col("other"), words)
    compared = both.select("id", "first", one.alias("a"), two.alias("b"))
    compared = compared.select("id", "first", jaccard(F.col("a"), F.col("b")).alias("similarity"))
    # Testing after writing keeps the sets from being made once more for the filter.
    return kept(compared, name).filter(F.col("similarity") >= threshold)


def links(
    forms: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS, words: int = WORDS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """(id, first, similarity) of texts (id, form) whose sets of shingles are alike in
    ``threshold`` or more, found by bands.

    Sets are larger than their texts, so they are made where they are needed and never
    moved; only texts that a pair names are.  All sets with a band's key meet the smallest
    id among them, never each other, so a key of any size gives one pair per member; the pair is then compared exactly.
    Members unlike their first form the group of the next round.  A set unlike the first
    ``rounds`` of all its groups, but like another of their members, gets no link to it
    here: such pairs are left to ``joined``.
    """
    if keys is None:
        keys = signatures(forms, threshold, words, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    rows = keys.select("id", F.posexplode("bands").alias("band", "key"))
    found = []
    for round_ in range(rounds):
        firsts = rows.groupBy("band", "key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        met = rows.join(firsts.filter("n > 1").drop("n"), ["band", "key"]).filter("id != first")
        met = kept(met, f"similar-met{round_}")
        pairs = kept(met.select("id", "first").distinct(), f"similar-pairs{round_}")
        like = alike(pairs, forms, threshold, words, f"similar-links{round_}")
        found.append(like)
        rows = met.join(like, ["id", "first"], "left_anti").select("id", "band", "key")
        if round_ + 1 < rounds:
            rows = kept(rows, f"similar-rest{round_}")
            if rows.isEmpty():
                break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.dropDuplicates(["id", "first"])


def components(edges: DataFrame) -> DataFrame:
    """(id, first_id): the smallest id that each end of (id, first) reaches by edges.

    Every node takes the smallest label around it and then that label's own label, so
    paths halve each round; a round is written before the next one.
    """
    both = edges.select("id", F.col("first").alias("other"))
    both = kept(both.unionByName(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "similar-edges")
    label = kept(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("first_id")), "similar-label")
    while True:
        around = both.join(label.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("first_id").alias("around"))
        near = label.join(around, "id").select("id", "first_id", F.least("first_id", "around").alias("near"))
        up = label.select(F.col("id").alias("near"), F.col("first_id").alias("above"))
        step = near.join(up, "near").select("id", "first_id", F.least("near", "above").alias("new"))
        step = kept(step, "similar-label")
        label = step.select("id", F.col("new").alias("first_id"))
        if step.filter("new != first_id").isEmpty():
            return label


def grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of texts with their group ``g``; a text without links is its own."""
    return rows.join(groups, "id", "left").withColumn("g", F.coalesce("first_id", "id")).drop("first_id")


def shared_tokens(keys: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(token) of the rare shingles that texts of several groups have.

    Of two texts the one with fewer shingles, n, has one in common with the other among its
    first n - ceil(2 threshold n / (1 + threshold)) + 1, so one holder at least must have it
    there.  Shingles go to their bucket in arrays, not as rows.
    """
    total = keys.select(F.sum(F.size("rare"))).first()[0] or 0
    buckets = int(np.clip(total // BUCKET, 16, 4096))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, n, g = batch.column("rare"), batch.column("n").to_numpy(), batch.column("g").to_numpy()
            edges = rare.offsets.to_numpy() - rare.offsets.to_numpy()[0]
            token = rare.flatten().to_numpy()
            owner = np.repeat(np.arange(len(n)), np.diff(edges))
            early = np.arange(len(token)) - edges[owner] <= (n - np.ceil(2 * threshold * n / (1 + threshold) - 1e-9))[owner]
            group = (g[owner] & ~1) | early
            bucket = token % buckets
            by = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[by], np.arange(buckets + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[by])) for x in (token, group)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), *lists], names=["bucket", "token", "g"])

    def shared(table: pa.Table) -> pa.Table:
        token, g = (table[c].combine_chunks().flatten().to_numpy() for c in ("token", "g"))
        by = np.lexsort((g, token))
        token, g = token[by], g[by]
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        if not len(begin):
            return pa.table({"token": pa.array([], pa.int64())})
        end = np.concatenate([begin[1:], [len(token)]]) - 1
        several = (g[begin] >> 1 != g[end] >> 1) & (np.maximum.reduceat(g & 1, begin) == 1)
        return pa.table({"token": token[begin[several]]})

    rows = grouped(keys.select("id", "n", "rare"), groups).select("n", "rare", F.xxhash64("g").alias("g"))
    dealt = rows.mapInArrow(deal, "bucket int, token array<bigint>, g array<bigint>")
    return kept(dealt.groupBy("bucket").applyInArrow(shared, "token bigint"), "similar-shared")


def posted(keys: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, id, n, place): the texts that have one of ``tokens`` among their rare shingles."""
    wanted = bitmap(tokens, F.pmod("token", F.lit(1 << BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare = batch.column("rare")
            edges = rare.offsets.to_numpy() - rare.offsets.to_numpy()[0]
            token = rare.flatten().to_numpy()
            at = token & ((1 << BITS) - 1)
            hit = np.flatnonzero((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            owner = np.searchsorted(edges, hit, side="right") - 1
            some = batch.select(["id", "n"]).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[hit]), some.column("id"), some.column("n"), pa.array((hit - edges[owner]).astype(np.int32))],
                names=["token", "id", "n", "place"],
            )

    rows = keys.select("id", "n", "rare").mapInArrow(run, "token bigint, id string, n int, place int")
    return kept(rows.join(tokens, "token", "left_semi"), "similar-posts")


def crowds(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, all, top, lead) of the shingles that several groups have: their holders, the
    group with the most of them, and one of its texts, another for each shingle."""
    text = F.struct(F.col("id").alias("other"), F.col("n").alias("m"), F.col("place").alias("at"))
    each = grouped(posts, groups).groupBy("token", "g").agg(
        F.count("*").alias("size"), F.min_by(text, F.xxhash64("id", "token")).alias("lead")
    )
    most = each.groupBy("token").agg(
        F.sum("size").alias("all"), F.max_by(F.struct("g", "size", "lead"), F.struct("size", "g")).alias("top"),
        F.count("*").alias("several"),
    )
    return most.filter("several > 1").select("token", "all", "top.*")


def meeting(posts: DataFrame, groups: DataFrame, threshold: float, leads: bool) -> DataFrame:
    """Pairs (id, first) of texts of two groups that a rare shingle brings together, so early
    in both that what follows is enough for ``threshold``; with ``leads`` one pair for each
    text and group, else all.

    The texts of a shingle's largest group meet all others, but not each other: pairs
    formed within a group are then never more than those of two groups.
    """
    crowd = kept(crowds(posts, groups), "similar-crowds")
    own = grouped(posts, groups)
    asking = own.join(crowd.select("token", F.col("g").alias("top")), "token").filter("g != top").drop("top")
    if leads:
        others = crowd.select("token", F.col("g").alias("h"), "lead.*")
    else:
        others = own.join(crowd.select("token"), "token", "left_semi")
        others = others.select("token", F.col("g").alias("h"), F.col("id").alias("other"), F.col("n").alias("m"), F.col("place").alias("at"))
    share = F.ceil(threshold * (F.col("n") + F.col("m")) / (1 + threshold) - 1e-9)
    both = asking.join(others, "token").filter((F.col("g") != F.col("h")) & (F.col("place") <= F.col("n") - share) & (F.col("at") <= F.col("m") - share))
    if leads:
        both = both.groupBy("id", "h").agg(F.min_by("other", F.xxhash64("id", "other")).alias("other"))
    return both.select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("first")).distinct()


def overlapping(pairs: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (id, first) that have enough of their rare shingles in common.

    The set whose rare ones end first in the order can share, beyond those, only its other
    ceil(threshold n) - 1; what is left of the overlap that ``threshold`` asks for lies among
    the rare ones of both.
    """
    rows = keys.select("id", "n", "rare")
    ends = pairs.select(F.col("first").alias("id"))
    there = among(rows, ends).select(F.col("id").alias("first"), F.col("n").alias("m"), F.col("rare").alias("theirs"))
    both = pairs.join(among(rows, pairs.select("id")), "id").join(there, "first")
    beyond = F.ceil(threshold * F.greatest("n", "m") - 1e-9) - 1
    share = F.ceil(threshold * (F.col("n") + F.col("m")) / (1 + threshold) - 1e-9)
    return both.filter(F.size(F.array_intersect("rare", "theirs")) >= share - beyond).select("id", "first")


def joined(
    forms: DataFrame, keys: DataFrame, groups: DataFrame, order: Order, threshold: float, words: int
) -> DataFrame:
    """(id, first_id): ``groups`` joined by all pairs of texts that are alike in ``threshold``
    or more and that lie in two of them.

    Alike texts have a rare shingle in common (``signatures``), so texts that share one are
    compared: each with one of the other group first, then all that are still in two groups.
    Where the order of shingles lets too many meet, those with many holders are put later,
    as long as that halves the pairs.
    """

    def merged(groups: DataFrame, pairs: DataFrame) -> DataFrame:
        pairs = kept(overlapping(pairs, keys, threshold), "similar-close")
        if pairs.isEmpty():
            return groups
        more = alike(pairs, forms, threshold, words, "similar-more").select("id", "first")
        if more.isEmpty():
            return groups
        return components(groups.select("id", F.col("first_id").alias("first")).unionByName(more))

    texts, before = keys.count(), np.inf
    for step in range(ORDERS):
        tokens = shared_tokens(keys, groups, threshold)
        if tokens.isEmpty():
            return groups
        posts = posted(keys, tokens)
        asked = kept(meeting(posts, groups, threshold, leads=True), "similar-asked")
        groups = merged(groups, asked)
        left = crowds(posts, groups).select(F.sum((F.col("all") - F.col("size")) * F.col("all"))).first()[0] or 0
        if step + 1 == ORDERS or left <= PAIRS * texts or left > before / 2:
            break
        many = counted(posts.groupBy("token").count().filter(F.col("count") >= CROWD))
        if not len(many[0]):
            break
        before, order = left, both_orders(order, many)
        keys = signatures(forms, threshold, words, order, bands=0)
    if left == 0:
        return groups
    rest = meeting(posts, groups, threshold, leads=False).join(asked, ["id", "first"], "left_anti")
    return merged(groups, kept(rest, "similar-near"))


def similar_groups(
    forms: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, rounds: int = ROUNDS
) -> DataFrame:
    """(id, first_id) of the texts (id, form) that are alike, directly or through others."""
    texts = forms.filter("form != ''").select("id", "form")
    with settings(forms.sparkSession, {CLEANUP: "true"}):  # files of a written table's shuffles go with its end
        order = sampled(texts, words, max(1, forms.count() // SAMPLE))
        keys = signatures(texts, threshold, words, order)
        groups = components(links(texts, threshold, rounds, words, keys))
        return joined(texts, keys, groups, order, threshold, words)
