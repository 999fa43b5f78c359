"""Text measures, per row.

Words are runs of ASCII letters in lower case; accented letters separate words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from mailflow.functions.arrays import let

WORD = "[a-z]+"
SENTENCE = "[^.!?\n]+[.!?]*"

# Frequent words that say nothing about a mail's topic.
STOP_WORDS = [
    "about", "after", "all", "also", "and", "any", "are", "because", "been",
    "but", "can", "could", "for", "from", "had", "has", "have", "her", "his",
    "how", "into", "its", "may", "more", "not", "our", "out", "over", "she",
    "should", "some", "than", "that", "the", "their", "them", "then", "there",
    "these", "they", "this", "was", "were", "what", "when", "which", "will",
    "with", "would", "you", "your",
]

POSITIVE_WORDS = [
    "agree", "amazing", "appreciate", "best", "better", "congratulations",
    "delighted", "easy", "excellent", "excited", "fantastic", "glad", "good",
    "great", "happy", "helpful", "improved", "love", "nice", "perfect",
    "pleased", "recommend", "success", "successful", "thank", "thanks",
    "welcome", "well", "win", "wonderful",
]

NEGATIVE_WORDS = [
    "angry", "awful", "bad", "broken", "complaint", "crash", "delay",
    "delayed", "disappointed", "error", "fail", "failed", "failure", "hate",
    "idiot", "issue", "late", "lost", "missed", "pathetic", "poor", "problem",
    "refund", "sorry", "stupid", "terrible", "unhappy", "worst", "worthless",
    "wrong",
]

ACTION_CUES = [
    "please", "must", "need to", "needs to", "action required", "to do",
    "todo", "deadline", "due by", "due on", "follow up", "follow-up",
    "remember to", "make sure", "let me know", "confirm", "asap",
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Trimmed sentences; a line end also ends a sentence."""
    found = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def count_in(tokens: Column, vocabulary: list[str]) -> Column:
    """How many tokens belong to the vocabulary (a literal set)."""
    return F.size(F.filter(tokens, lambda w: w.isin(vocabulary)))


def term_counts(words: Column) -> Column:
    """(term, tf) of a list of words: sorted, equal words are neighbours."""

    def counted(w: Column) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, F.greatest(i - 1, F.lit(0))))
        )
        return let(
            at,
            lambda first: F.transform(
                first,
                lambda i, k: F.struct(
                    F.get(w, i).alias("term"), (F.coalesce(F.get(first, k + 1), F.size(w)) - i).alias("tf")
                ),
            ),
        )

    return let(F.sort_array(words), lambda w: F.when(F.size(w) > 0, counted(w)))


def polarity(positive: Column, negative: Column) -> Column:
    """(p - n) / (p + n), cut after four decimals, as text; no hits give zero.

    The division is done on integers, so every engine gets the same digits.
    """
    cut = F.floor(F.abs(positive - negative) * 10000 / F.greatest(positive + negative, F.lit(1)))
    signed = F.when(positive < negative, -cut).otherwise(cut)
    return (signed / 10000).cast("decimal(9,4)").cast("string")


def pieces(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(offsets, bytes) of about ``limit`` bytes of texts at a time; null is empty."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = min(max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, side="right")) - 1), len(column))
        yield bounds[a : b + 1] - bounds[a], data[bounds[a] : bounds[b]]
        a = b


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of true, none across the bound of two texts."""
    opens, closes = mask.copy(), mask.copy()
    if len(mask):
        opens[1:] &= ~mask[:-1]
        closes[:-1] &= ~mask[1:]
        full = bounds[:-1] < bounds[1:]
        first, last = bounds[:-1][full], bounds[1:][full] - 1
        opens[first], closes[last] = mask[first], mask[last]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def slices_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The given byte ranges as strings."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])]
    return pa.Array.from_buffers(pa.large_string(), len(start), buffers)


def bytes_in(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


LEAST_LETTERS = 3
STOPS, MARKS, LETTERS = bytes_in(".!?\n"), bytes_in(".!?"), bytes_in("abcdefghijklmnopqrstuvwxyz")
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)  # ASCII letters only


def sentence_ranks(bounds: np.ndarray, data: np.ndarray, stop_words: pa.Array) -> tuple[np.ndarray, ...]:
    """Text, start and end (bytes) and rank within its text, from 0, of every sentence
    that may be taken, in text order; see ``summaries``."""
    start, end = runs(~STOPS[data], bounds)
    marks, close = runs(MARKS[data], bounds)
    if len(marks):  # closing marks belong to the sentence before
        at = np.minimum(np.searchsorted(marks, end), len(marks) - 1)
        inside = end < bounds[np.searchsorted(bounds, start, side="right")]
        end = np.where((marks[at] == end) & inside, close[at], end)
    solid = np.append(np.flatnonzero(data != ord(" ")), len(data))
    start, back = solid[np.searchsorted(solid, start)], np.searchsorted(solid, end) - 1
    end = np.where(back >= 0, solid[np.maximum(back, 0)] + 1, 0)
    some = start < end
    start, end = start[some], end[some]
    of = np.searchsorted(bounds, start, side="right") - 1

    low = LOWER[data]
    first, last = runs(LETTERS[low], bounds)
    long = last - first >= LEAST_LETTERS
    first, last = first[long], last[long]
    coded = slices_of(low, first, last).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    said = ~pc.is_in(coded.dictionary, stop_words).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    code, sentence = code[said], np.searchsorted(start, first[said], side="right") - 1
    _, same, often = np.unique(of[sentence] * (len(coded.dictionary) + 1) + code, return_inverse=True, return_counts=True)
    total = np.bincount(sentence, often[same], len(start)).astype(np.int64)
    count = np.bincount(sentence, minlength=len(start))

    scored = count > 0
    without = np.bincount(of[scored], minlength=len(bounds)) == 0
    may = np.flatnonzero(scored | without[of])
    score = total[may] * 1000 // np.maximum(count[may], 1)
    order = np.lexsort((may, -score, of[may]))
    place = np.empty(len(may), np.int64)
    place[order] = np.arange(len(may)) - np.searchsorted(of[may][order], of[may][order])
    return of[may], start[may], end[may], place


def summary_arrays(texts: pa.Array, sizes: list[int], stop_words: list[str]) -> list[pa.Array]:
    """One array of summaries per size, of a batch of texts at once."""
    ignored, found = pa.array(stop_words, pa.large_string()), [[] for _ in sizes]
    for bounds, data in pieces(texts):
        of, start, end, place = sentence_ranks(bounds, data, ignored)
        for made, size in zip(found, sizes):
            taken = place < size
            edges = np.searchsorted(of[taken], np.arange(len(bounds)))
            lists = pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), slices_of(data, start[taken], end[taken]))
            made.append(pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()))
    return [
        pc.if_else(texts.is_valid(), pa.concat_arrays(made) if made else pa.array([], pa.string()), pa.scalar(None, pa.string()))
        for made in found
    ]


def summaries(text: Column, sizes: dict[str, int], stop_words: list[str] = STOP_WORDS) -> Column:
    """Struct of extractive summaries, one per size in sentences, in text order.

    A sentence's score is the mean frequency, within the text, of its words, in
    thousandths (after Luhn 1958); integers keep ties exact.  Without any scored
    word the first sentences are taken.

    Counting words inside one row is what the built-in functions lack: in SQL it
    takes an explode and three groupings over every word of the mail table.  So
    this one step runs on Arrow batches, a megabyte of texts at a time: sentences and
    words are byte ranges, words become codes, and no step loops over rows.  Nothing is
    shuffled.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in sizes])

    @F.arrow_udf(schema)
    def run(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(summary_arrays(texts, list(sizes.values()), stop_words), list(sizes))

    return run(text)


def token_estimate(text: Column) -> Column:
    """Rough model tokens: one per hundred words, at least one."""
    count = F.size(F.regexp_extract_all(text, F.lit("[^ \n\t\r]+"), F.lit(0)))
    return F.greatest(F.lit(1), F.floor(count / 100)).cast("bigint")


def lines_with_cues(text: Column, cues: list[str] = ACTION_CUES) -> Column:
    """Sentences holding an action cue, in text order."""
    pattern = "(?i)(^|[^A-Za-z])(" + "|".join(map(re.escape, cues)) + ")([^A-Za-z]|$)"
    return F.filter(sentences(text), lambda s: s.rlike(pattern))
