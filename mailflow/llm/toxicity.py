"""Toxic spans by a linear-chain conditional random field."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailflow.llm.spans import U, Words, mix, slices

SAMPLE = 5_000  # labelled documents a model is learnt from, at most
PER_LABEL = 400  # of these, of each label, for the field's weights
PREFIXES = (4, 5, 6)
CHUNK = 512
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def features(words: Words) -> list[np.ndarray]:
    """Hashes of each word without punctuation at its end, and of its first bytes; 0: none."""
    end = words.end.copy()
    for _ in range(3):
        cut = (end - words.start > 1) & PUNCTUATION[words.data[end - 1]] if len(end) else np.zeros(0, bool)
        end = end - cut
    out = [words.hashed(end)]
    for n in PREFIXES:
        long = end - words.start >= n
        out.append(np.where(long, words.hashed(np.where(long, words.start + n, end)) ^ U(n), U(0)))
    return out


class Field:
    """Two states per word; the emission of state 1 is the bias plus the weights of known features."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float, moves: np.ndarray, start: np.ndarray):
        self.known, self.weights, self.bias, self.moves, self.start = known, weights, bias, moves, start
        self.hint = np.zeros(1 << 16, bool)
        self.hint[(known >> U(48)).astype(np.int64)] = True

    def found(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, feature) numbers of the features that words have."""
        if not len(self.known):
            return
        for column in features(words):
            rows = np.flatnonzero(self.hint[(column >> U(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.known, column[rows]), len(self.known) - 1)
            hit = self.known[at] == column[rows]
            yield rows[hit], at[hit]

    def emissions(self, words: Words) -> np.ndarray:
        out = np.full(len(words.start), self.bias)
        for rows, at in self.found(words):
            np.add.at(out, rows, self.weights[at])
        return out

    def marginals(self, emission: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(state 1) of each word, and P(pair of states) of each word and the next of its text."""
        return forward_backward(emission, doc, self.moves, self.start)


def forward_backward(emission: np.ndarray, doc: np.ndarray, moves: np.ndarray, start: np.ndarray):
    """All texts as one chain that begins anew at each text.  The chain is cut into equal
    chunks; their matrices are multiplied side by side, then chunk after chunk gets its
    first vector, then all chunks are walked side by side."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    chunks = -(-n // CHUNK)
    one = 1 / (1 + np.exp(-np.clip(emission, -40, 40)))
    states = np.stack([1 - one, one], axis=1)
    first = np.ones(n, bool)
    first[1:] = doc[1:] != doc[:-1]
    step = np.where(first[:, None, None], start[None, None, :], moves[None, :, :]) * states[:, None, :]
    padded = np.tile(np.eye(2), (chunks * CHUNK, 1, 1))
    padded[:n] = step
    grid = padded.reshape(chunks, CHUNK, 2, 2)

    whole = np.tile(np.eye(2), (chunks, 1, 1))
    for t in range(CHUNK):
        whole = whole @ grid[:, t]
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    heads, tails = np.zeros((chunks, 2)), np.ones((chunks, 2))
    v = np.array([0.5, 0.5])
    for i in range(chunks):
        heads[i] = v
        v = v @ whole[i]
        v = v / v.sum()
    v = np.ones(2)
    for i in range(chunks - 1, -1, -1):
        tails[i] = v
        v = whole[i] @ v
        v = v / v.sum()
    ahead, behind = np.zeros((chunks, CHUNK, 2)), np.zeros((chunks, CHUNK, 2))
    v = heads
    for t in range(CHUNK):
        v = np.einsum("ci,cij->cj", v, grid[:, t])
        v = v / v.sum(axis=1, keepdims=True)
        ahead[:, t] = v
    v = tails
    for t in range(CHUNK - 1, -1, -1):
        behind[:, t] = v
        v = np.einsum("cij,cj->ci", grid[:, t], v)
        v = v / v.sum(axis=1, keepdims=True)
    a, b = ahead.reshape(-1, 2)[:n], behind.reshape(-1, 2)[:n]
    both = a * b
    single = both[:, 1] / both.sum(axis=1)
    pair = a[:-1, :, None] * step[1:] * b[1:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return single, pair[~first[1:]]


def families(texts: pa.Array) -> np.ndarray:
    """A number per text, mostly equal for copies and near copies: by the least hash of two
    neighbouring words.  Copies are one witness, not many."""
    least = np.arange(len(texts), dtype=U)
    for a, b, offsets, data in slices(texts):
        words = Words(offsets, data)
        h = words.hashed(words.end)
        with np.errstate(over="ignore"):
            two = mix(h[:-1] * U(3) + h[1:])
        same = words.doc[1:] == words.doc[:-1]
        low = np.full(b - a, np.iinfo(U).max, U)
        np.minimum.at(low, words.doc[1:][same], two[same])
        least[a:b] = np.where(low == np.iinfo(U).max, least[a:b], low)
    return np.unique(least, return_inverse=True)[1]


def telling(texts: pa.Array, toxic: np.ndarray) -> np.ndarray:
    """Features of words that toxic documents have and others do not, beyond chance: the
    Chernoff bound on so many toxic ones among their documents is below 1 % over all features."""
    pairs: list[list[np.ndarray]] = [[] for _ in range(1 + len(PREFIXES))]
    family = families(texts)
    bad_family = np.zeros(family.max() + 1 if len(family) else 0)
    np.maximum.at(bad_family, family, toxic)
    toxic = bad_family
    for a, _, offsets, data in slices(texts):
        words = Words(offsets, data)
        for kind, column in enumerate(features(words)):
            order = np.lexsort((family[words.doc + a], column))
            f, d = column[order], family[words.doc[order] + a]
            new = np.ones(len(f), bool)
            new[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
            new &= f != 0
            pairs[kind].append(np.stack([f[new], d[new].astype(U)]))
    rate = min(max(toxic.mean(), 1e-6), 1 - 1e-6)
    out = []
    for kind in pairs:
        if not kind:
            continue
        f, d = np.concatenate(kind, axis=1)
        names, at = np.unique(f, return_inverse=True)
        one = np.unique(at * len(toxic) + d.astype(np.int64))  # a family in several slices
        at, d = one // len(toxic), one % len(toxic)
        on = np.bincount(at, minlength=len(names))
        bad = np.bincount(at, weights=toxic[d], minlength=len(names))
        share = np.clip(bad / np.maximum(on, 1), 1e-9, 1 - 1e-9)
        gain = on * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))
        out.append(names[(share >= 0.9) & (gain >= math.log(max(len(names), 1) / 0.01))])
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U)


def fit(texts: list[str | None], toxic: list[int], steps: int = 25, rate: float = 0.6, decay: float = 1e-4,
        per_label: int = PER_LABEL) -> Field:
    """Learn a field from labelled documents.  Words of toxic documents with a telling
    feature are labelled 1, all other words 0; the field's likelihood of these labels is
    raised by Adam, with gradients from forward-backward.  All documents decide which
    features tell; the weights are fitted to the first ``per_label`` of each label."""
    column, label = pa.array([t or "" for t in texts], pa.large_string()), np.array(toxic, dtype=float)
    known = telling(column, label) if len(label) and 0 < label.mean() < 1 else np.zeros(0, U)
    moves, start = np.array([[0.99, 0.01], [0.7, 0.3]]), np.array([0.99, 0.01])
    if not len(known):
        return Field(known, np.zeros(0), -12.0, moves, start)
    chosen = np.sort(np.concatenate([np.flatnonzero(label == v)[:per_label] for v in (0, 1)]))
    parts = []
    for a, _, offsets, data in slices(column.take(pa.array(chosen))):
        words = Words(offsets, data)
        field = Field(known, np.zeros(len(known)), 0.0, moves, start)
        hits = list(field.found(words))
        y = np.zeros(len(words.start))
        for rows, _ in hits:
            y[rows] = 1
        y *= label[chosen[words.doc + a]]
        parts.append((words.doc, hits, y))
    total = sum(len(y) for *_, y in parts)
    theta = np.concatenate([np.full(len(known), 2.0), [-4.0], np.log(moves[:, 1] / moves[:, 0])])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        up = 1 / (1 + np.exp(-theta[-2:]))
        moves = np.stack([1 - up, up], axis=1)
        gradient = np.zeros_like(theta)
        for doc, hits, y in parts:
            e = np.full(len(y), theta[-3])
            for rows, at in hits:
                np.add.at(e, rows, theta[at])
            p, pair = forward_backward(e, doc, moves, start)
            gap = y - p
            for rows, at in hits:
                gradient[: len(known)] += np.bincount(at, weights=gap[rows], minlength=len(known))
            gradient[-3] += gap.sum()
            same = doc[1:] == doc[:-1]
            for s in (0, 1):
                is_s = (y[:-1] == s) & same
                taken, expected = (y[1:][is_s] == 1).sum(), pair[:, s, 1].sum()
                gradient[-2 + s] += taken - expected - up[s] * (is_s.sum() - pair[:, s, :].sum())
        gradient[: len(known)] *= total / np.maximum(1, total / 50)  # rare features learn as fast as the bias
        gradient = gradient / total - decay * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9) * (0.97**step)
    up = 1 / (1 + np.exp(-theta[-2:]))
    return Field(known, theta[: len(known)], float(theta[-3]), np.stack([1 - up, up], axis=1), start)


def fitter(per_label: int):
    """One row, the field learnt from all (text, label) of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        field = fit(texts, toxic, per_label=per_label)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([field.known.view(np.int64).tolist()], pa.list_(pa.int64())), pa.array([field.weights.tolist()], pa.list_(pa.float64())),
                pa.array([field.bias], pa.float64()), pa.array([field.moves.ravel().tolist()], pa.list_(pa.float64())),
                pa.array([field.start.tolist()], pa.list_(pa.float64())),
            ],
            ["known", "weights", "bias", "moves", "start"],
        )

    return run


def tagger(field: Field, least: float):
    """(doc_id, score, spans): the largest marginal, and runs of words at ``least`` or more."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, offsets, data in slices(batch.column(1)):
                words = Words(offsets, data)
                p, _ = field.marginals(field.emissions(words), words.doc)
                score = np.zeros(b - a)
                np.maximum.at(score, words.doc, p)
                spans: list[list[dict]] = [[] for _ in range(b - a)]
                marked = np.flatnonzero(p >= least)
                if len(marked):
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    new = np.ones(len(marked), bool)
                    new[1:] = (marked[1:] != marked[:-1] + 1) | (words.doc[marked[1:]] != words.doc[marked[:-1]])
                    for group in np.split(marked, np.flatnonzero(new)[1:]):
                        doc = int(words.doc[group[0]])
                        zero = points[offsets[doc]]
                        spans[doc].append(
                            {"start": int(points[words.start[group[0]]] - zero), "end": int(points[words.end[group[-1]]] - zero),
                             "score": float(p[group].max())}
                        )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(score), pa.array(spans, pa.list_(span))], ["doc_id", "score", "spans"]
                )

    return run


def held_out(key: str):
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(3)) == 1


def learn(rows: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE,
          per_label: int = PER_LABEL) -> Field:
    """Fit a field on at most ``sample`` labelled documents outside the held-out third, in
    the order of a hash; ``per_label`` of each label, at most, for its weights.  One task fits, on that many texts; the driver sees the field only."""
    asked = labels.where(~held_out(key) & F.col(label).isNotNull()).select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
    asked = asked.orderBy(F.xxhash64("_k"), "_k", "_y").limit(sample)
    found = rows.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t")).join(F.broadcast(asked), "_k")
    found = found.select("_k", "_t", "_y").orderBy(F.xxhash64("_k"), "_k", "_t").limit(sample)
    kind = "known array<long>, weights array<double>, bias double, moves array<double>, start array<double>"
    learnt = found.select("_t", "_y").coalesce(1).mapInArrow(fitter(per_label), kind).first()
    if learnt is None:
        return fit([], [])
    return Field(
        np.array(learnt["known"], np.int64).view(U), np.array(learnt["weights"], float), learnt["bias"],
        np.array(learnt["moves"]).reshape(2, 2), np.array(learnt["start"]),
    )


def score_toxicity(rows: DataFrame, field: Field, key: str, text: str, threshold: float = 0.7) -> DataFrame:
    """Score every whole text.  Returns doc_id, held_out, score, predicted, spans: start and
    end in code points and the score of each run of toxic words.

    A null, empty or blank text scores 0; so does every text if nothing could be learnt.
    Rows without a key are scored like others, with held_out false; repeated rows are
    scored one by one.  Only ``text`` decides; other columns are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = "doc_id long, score double, spans array<struct<start: long, end: long, score: double>>"
    scored = given.mapInArrow(tagger(field, 0.5), kind)
    return scored.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "spans",
    )
