"""Packing tokenized documents into sequences of fixed length by bin completion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailflow.llm.ranks import numbered
from mailflow.llm.store import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
CHOICES = 24  # fillings looked at around one largest document
RECORDS = 1_000  # texts sent to Python at once, so that an executor keeps no large buffers
NODES = 20_000  # of the search; then the best solution so far stands

Pattern = tuple[tuple[int, ...], int]  # lengths of a sequence, number of such sequences


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    """The byte-level BPE given as ranks; a special token's string in a text is its id."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    found = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    return partial(found.encode, allowed_special="all", disallowed_special=())


def tokenize(path: str, pattern: str, special: tuple[tuple[str, int], ...], size: int):
    """Pieces of each text: its ids and then id 0, cut only if longer than ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern, special)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), 0], dtype="<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def best_fit(counts: np.ndarray, size: int) -> list[Pattern]:
    """Best fit, largest first, on numbers of documents per length."""
    open_: dict[int, list[list]] = {}  # free space -> [lengths, number]
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            space = min((s for s, held in open_.items() if s >= length and held), default=None)
            if space is None:
                per = min(size // length, left)
                k = left // per
                open_.setdefault(size - per * length, []).append([(length,) * per, k])
                left -= per * k
                continue
            lengths, number = open_[space].pop()
            k = min(left, number)
            if number > k:
                open_[space].append([lengths, number - k])
            open_.setdefault(space - length, []).append([(*lengths, length), k])
            left -= k
    return [(lengths, n) for held in open_.values() for lengths, n in held]


def fillings(counts: np.ndarray, space: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``space`` with up to four documents, least waste first.

    A filling that leaves room for a further document, or whose documents are each at
    most as long as another's, is dominated."""
    have = counts[: space + 1] > 0
    sizes = np.flatnonzero(have)[::-1]
    if space == 0 or not len(sizes):
        return [()]
    below = np.maximum.accumulate(np.where(have, np.arange(space + 1), 0))  # largest length up to each
    found: dict[tuple[int, ...], int] = {}

    def extend(chosen: tuple[int, ...], room: int, depth: int) -> None:
        top = int(below[min(room, chosen[-1])] if chosen else below[room])
        if top and chosen and top == chosen[-1] and counts[top] <= chosen.count(top):
            top = int(below[min(room, top - 1)])
        if not top or depth == 4:
            found.setdefault(chosen, room)
            return
        tried = 0
        while top and tried < (8 if depth < 2 else 2) and len(found) < 4 * CHOICES:
            if counts[top] > chosen.count(top):
                extend((*chosen, top), room - top, depth + 1)
                if depth >= 1 and found and min(found.values()) == 0:
                    return
                tried += 1
            top = int(below[top - 1])

    pair = have[sizes] & have[space - sizes] & ((2 * sizes != space) | (counts[sizes] > 1)) & (2 * sizes >= space) & (sizes < space)
    if have[space]:
        found[(space,)] = 0
    for a in sizes[pair][:4]:
        found[(int(a), int(space - a))] = 0
    if len(found) < 2:
        extend((), space, 0)
    ranked = sorted(found.items(), key=lambda f: (f[1], [-x for x in f[0]]))
    kept: list[tuple[int, ...]] = []
    for lengths, _ in ranked:
        if not any(len(k) >= len(lengths) and all(a <= b for a, b in zip(lengths, k, strict=False)) for k in kept):
            kept.append(lengths)
        if len(kept) == CHOICES:
            break
    return kept


def completion(counts: np.ndarray, size: int, nodes: int = NODES) -> list[Pattern]:
    """Bin completion with branch and bound over numbers of documents per length.

    The largest document left is taken with a filling as often as both last; other
    fillings are tried on the way back.  A branch ends when its waste is more than a
    better solution than the incumbent can have.  Best fit is the first incumbent."""
    total = int((counts * np.arange(len(counts))).sum())
    best = best_fit(counts, size)
    used = lambda solution: sum(n for _, n in solution)
    least = -(-total // size)
    counts = counts.astype(np.int64).copy()
    path: list[tuple[tuple[int, ...], int]] = []
    options: list[list[tuple[int, ...]]] = []
    waste = bins = 0
    while nodes and used(best) > least:
        nodes -= 1
        allowed = (used(best) - 1) * size - total
        left = np.flatnonzero(counts)
        if not len(left):
            best = list(path)
        elif waste <= allowed and len(options) == len(path):
            largest = int(left[-1])
            counts[largest] -= 1
            options.append([(largest, *f) for f in fillings(counts, size - largest)][::-1])
            counts[largest] += 1
        if len(options) == len(path) or not options[-1]:  # a dead end: undo the last step
            if len(options) > len(path):
                options.pop()
            if not path:
                break
            lengths, n = path.pop()
            for x in lengths:
                counts[x] += n
            waste -= n * (size - sum(lengths))
            bins -= n
            continue
        lengths = options[-1].pop()
        n = min(int(counts[x]) // lengths.count(x) for x in set(lengths))
        for x in lengths:
            counts[x] -= n
        waste += n * (size - sum(lengths))
        bins += n
        path.append((lengths, n))
    return best


def places(plan: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, documents per sequence, first sequence, offsets of each run of ranks."""
    runs: dict[int, list[tuple]] = {}
    seen: dict[int, int] = {}
    base = 0
    for lengths, n in plan:
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        for length in dict.fromkeys(lengths):
            at = [int(offsets[i]) for i, x in enumerate(lengths) if x == length]
            runs.setdefault(length, []).append((seen.get(length, 0), len(at), base, at))
            seen[length] = seen.get(length, 0) + n * len(at)
        base += n
    out = {}
    for length, parts in runs.items():
        starts, per, bases, at = zip(*parts, strict=True)
        first = np.concatenate([[0], np.cumsum(per)[:-1]])
        out[length] = (np.array(starts), np.array(per), np.array(bases), first, np.concatenate(at))
    return out


def assign(plan: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("slot").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                starts, per, bases, first, at = plan[int(length)]
                i = np.searchsorted(starts, ranks[rows], side="right") - 1
                r = ranks[rows] - starts[i]
                sequence[rows] = bases[i] + r // per[i]
                offset[rows] = at[first[i] + r % per[i]]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def packed(rows: DataFrame, key: str, text: str, path: str, pattern: str, special: tuple = (), size: int = 2048) -> DataFrame:
    """Pack tokenized documents into as few sequences of ``size`` tokens as it can.

    Texts are tokenized where they lie.  The plan needs only how many pieces there are of
    each length, at most ``size`` numbers whatever the data; pieces then find their places
    by their rank among those of their length, numbered in parts.  The plan is sent to the
    tasks; it has about as many entries as there are lengths.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    A null or empty text is the id 0 alone.  Rows without a key and repeated rows are
    documents like others.  No rows: no sequences.  Other columns are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = stored(given.mapInArrow(tokenize(path, pattern, special, size), PIECES), "pieces", RECORDS)
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
    plan = places(completion(counts, size))
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], int(counts.sum()))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("slot").cast("long").alias("slot"))
    return ranked.mapInArrow(assign(plan), PIECES + ", sequence_id long, offset long")
