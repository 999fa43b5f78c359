"""Periodic runs of words, found on an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mailflow.functions.arrays import let
from mailflow.llm.spans import slices

RUN = "struct<start: long, length: long, period: long>"
RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
WORD = r"[^\x20\x09-\x0D]+"


def starts_of(flags: np.ndarray) -> np.ndarray:
    """For sorted items, the number of the first item of each one's group."""
    at = np.arange(len(flags))
    return np.maximum.accumulate(np.where(flags, at, 0))


def suffix_array(keys: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sort all suffixes by prefix doubling.  ``end`` is where each word's text ends.

    Returns the order and, per k, the ranks by the first 2^k words: equal ranks mean
    equal words, none of them beyond the end of the text.  Words of different texts
    must have different keys.  Only suffixes that still tie are sorted again.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    rank = np.zeros(n + 1, np.int64)  # rank[n] = 0 stands behind the last word
    rank[order] = starts_of(new) + 1
    levels, width = [rank], 1
    live = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(live):
        here = order[live]
        after = here + width
        follows = np.where(after < end[here], rank[np.minimum(after, n)], 0)
        key = rank[here] * (n + 2) + follows
        by = np.argsort(key, kind="stable")
        order[live], key = here[by], key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[order[live]] = live[starts_of(new)] + 1
        levels.append(rank)
        live, width = live[~(new & np.append(new[1:], True))], 2 * width
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of each suffix with the one sorted before it; 0 at both ends."""
    lcp = np.zeros(len(order) + 1, np.int64)
    first = levels[0][order]
    at = np.flatnonzero(first[1:] == first[:-1]) + 1
    a, b = order[at - 1], order[at]
    length = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + length] == levels[k][b + length]
        length[same] += 1 << k
    lcp[at] = length
    return lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, left and right bound of the LCP interval of every place with a common
    prefix: the nearest smaller values on both sides, by range minima."""
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at, at
    depth = lcp[at]
    gaps = np.flatnonzero(lcp == 0)
    minima = [lcp]
    while 1 << len(minima) <= int(np.diff(gaps).max()):
        half = 1 << (len(minima) - 1)
        low = minima[-1].copy()
        low[:-half] = np.minimum(low[:-half], minima[-1][half:])
        low[-half:] = 0
        minima.append(low)
    left, right = at.copy(), at + 1
    for k in range(len(minima) - 1, -1, -1):
        step = 1 << k
        before = left - step
        go = (before >= 0) & (minima[k][np.maximum(before, 0)] >= depth)
        left[go] -= step
        inside = right < len(lcp)
        go = inside & (minima[k][np.minimum(right, len(lcp) - 1)] >= depth)
        right[go] += step
    return at, left - 1, right - 1


def tandems(order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every branching tandem repeat.

    A suffix i of an LCP interval of depth d starts one if suffix i + d is in the
    interval, too, and in another child of it.  Of each interval all children but the
    largest are listed, and both i + d and i - d are looked up in the inverse array.
    """
    n = len(order)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    at, left, right = intervals(lcp)
    if not len(at):
        return at, at
    by = np.lexsort((at, right, left))
    at, left, right = at[by], left[by], right[by]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    group = np.cumsum(new) - 1
    # A child begins at each boundary, and one more at the interval's left bound.
    first = np.flatnonzero(new)
    begin = np.concatenate([left[first], at])
    last = np.append(new[1:], True)
    stop = np.concatenate([at[first] - 1, np.where(last, right, np.append(at[1:], 0) - 1)])
    of = np.concatenate([np.arange(len(first)), group])
    size = stop - begin + 1
    by = np.lexsort((-size, of))
    largest = by[np.concatenate([[True], of[by][1:] != of[by][:-1]])]
    small = np.ones(len(of), bool)
    small[largest] = False
    begin, stop, of, size = begin[small], stop[small], of[small], size[small]
    child = np.repeat(np.arange(len(of)), size)
    slot = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    i, v = order[slot], first[of[child]]
    d, low, high = lcp[at[v]], left[v], right[v]
    found, halves = [], []
    for other, start in ((i + d, i), (i - d, i - d)):
        inside = (other >= 0) & (other < n)
        t = inverse[np.where(inside, other, 0)]
        hit = inside & (t >= low) & (t <= high) & ((t < begin[child]) | (t > stop[child]))
        found.append(start[hit])
        halves.append(d[hit])
    return np.concatenate(found), np.concatenate(halves)


def maximal_runs(
    keys: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int, times: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs of ``times`` periods and ``least``
    words or more, by start and then period."""
    if not len(keys):
        return (np.zeros(0, np.int64),) * 3
    order, levels = suffix_array(keys, end)
    start, period = tandems(order, common_prefixes(order, levels))
    close = start + 2 * period
    # Rotate each square to the left as far as it goes, in steps of halving length.
    floor = begin[start]
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        safe = np.maximum(back, 0)
        go = (back >= floor) & (levels[k][safe] == levels[k][safe + period])
        start = np.where(go, back, start)
    long = close - start >= np.maximum(least, times * period)
    start, close, period = start[long], close[long], period[long]
    by = np.lexsort((period, close, start))
    start, close, period = start[by], close[by], period[by]
    # Squares of one run meet here; so do those of multiples of its period.
    new = np.ones(len(by), bool)
    new[1:] = (start[1:] != start[:-1]) | (close[1:] != close[:-1])
    start, close, period = start[new], close[new], period[new]
    by = np.lexsort((period, start))
    return start[by], close[by], period[by]


def runs_of_texts(texts: pa.Array, least: int, times: int) -> pa.RecordBatch:
    """``n_words``, ``runs`` and ``left`` (the text without repeats) of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, doc = split.flatten(), pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    solid = pc.not_equal(flat, "")
    flat, doc = flat.filter(solid), doc[solid.to_numpy(zero_copy_only=False)]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    coded = flat.dictionary_encode()
    keys = doc * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
    start, close, period = maximal_runs(keys, bounds[doc], bounds[doc + 1], least, times)

    change = np.zeros(len(doc) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, close, -1)
    stays = np.cumsum(change[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(stays)])[bounds]
    words = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), flat.filter(pa.array(stays)))
    owner = doc[start] if len(start) else np.zeros(0, np.int64)
    rows = pa.StructArray.from_arrays(
        [pa.array(start - bounds[owner], pa.int64()), pa.array(close - start, pa.int64()), pa.array(period, pa.int64())],
        fields=list(RUN_ARROW),
    )
    edges = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(edges), rows),
            pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string()),
        ],
        names=["n_words", "runs", "left"],
    )


def find_runs(rows: DataFrame, key: str, text: str, least: int = 6, times: int = 4) -> DataFrame:
    """Runs of every whole text: stretches of words that repeat with a period.

    A run has the smallest period p of its words, ``times`` * p words or more and at
    least ``least``, and no neighbouring word continues it.  Words are
    ``[^\\x20\\x09-\\x0D]+``, compared as they are.  Returns doc_id, n_words, ``runs``
    (start, length, period in words, by start and period) and ``left``: the words
    outside of any run or in some run's first period only, joined by one space.

    Texts are independent, so nothing is shuffled; a task takes about half a megabyte
    of texts at once, a longer text by itself, in memory in proportion to its words.
    Null and empty texts have no words, no runs and an empty ``left``.  Rows without a
    key and repeated rows are each read by themselves.  Other columns are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b, *_ in slices(texts):
                found = runs_of_texts(texts.slice(a, b - a), least, times)
                columns = [batch.column("doc_id").slice(a, b - a), *found.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *found.schema.names])

    return given.mapInArrow(scan, f"doc_id long, n_words long, runs array<{RUN}>, left string")


def looped(key: Column, text: Column) -> Column:
    """The words of a text, for one key in ten repeating with a period from some word
    on; both follow from the key's CRC-32.  Other texts stay as they are."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        cycle = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")

    once = let(words, lambda w: F.when(F.size(w) > 0, repeat(w)))
    return F.when(h % 10 == 0, once).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Number and longest of the runs, and SHA-256 of all runs and of what is left."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        (-F.col("_best.n")).alias("length"), F.col("_best.period").alias("period"),
        F.floor(-1000 * F.col("_best.n") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("left"), 256).alias("collapsed_sha256"), "n_words",
    )
