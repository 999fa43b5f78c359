"""Licence scans: phrases and tags by Aho-Corasick, expressions by a shunting yard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CASE = str.maketrans(UPPER, LOWER)
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words, in lower-cased text

# Fixed phrases and their labels.
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}

# Further notices: words, label, and how sure they make a licence.
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.7), "gnu library general public license": ("lgpl", 0.7),
    "gnu affero general public license": ("agpl", 0.7), "gnu general public license version 2": ("gpl-2.0", 0.8),
    "gnu general public license version 3": ("gpl-3.0", 0.8), "gnu free documentation license": ("gfdl", 0.7),
    "apache license version 2 0": ("apache-2.0", 0.8), "apache license 2 0": ("apache-2.0", 0.8),
    "mozilla public license": ("mpl", 0.7), "eclipse public license": ("epl", 0.7), "isc license": ("isc", 0.7),
    "bsd license": ("bsd", 0.7), "bsd 2 clause": ("bsd-2-clause", 0.7), "bsd 3 clause": ("bsd-3-clause", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "boost software license": ("bsl", 0.7), "zlib license": ("zlib", 0.7), "artistic license": ("artistic", 0.7),
    "european union public licence": ("eupl", 0.7), "open database license": ("odbl", 0.7),
    "sil open font license": ("ofl", 0.7), "creative commons zero": ("cc0", 0.7), "cc0 1 0": ("cc0", 0.7),
    "creative commons attribution": ("cc-by", 0.7), "cc by sa": ("cc-by-sa", 0.7), "cc by nd": ("cc-by-nd", 0.7),
    "cc by nc": ("cc-by-nc", 0.7), "cc by nc sa": ("cc-by-nc-sa", 0.7), "cc by nc nd": ("cc-by-nc-nd", 0.7),
}

# Words that come before the name of a licence.
GRANTS = ["licensed under", "released under", "distributed under", "available under", "under the terms of"]

# Tags whose line holds an expression.
TAGS = ["spdx license identifier"]

# Obligations a licence brings, from free to closed.
DUTIES = ["permissive", "weak copyleft", "copyleft", "restricted", "unknown"]

# First part of an identifier and the duty it stands for.
FAMILIES = {
    "mit": 0, "apache": 0, "bsd": 0, "isc": 0, "zlib": 0, "bsl": 0, "cc0": 0, "unlicense": 0, "0bsd": 0, "ofl": 0,
    "python": 0, "psf": 0, "cc-by": 0, "artistic": 1, "lgpl": 1, "mpl": 1, "epl": 1, "eupl": 1, "cddl": 1, "gfdl": 2,
    "gpl": 2, "agpl": 2, "odbl": 2, "cc-by-sa": 2, "cc-by-nc": 3, "cc-by-nd": 3,
}

OPERATORS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Words that may stand between two notices without ending an expression.
FILLERS = {"the", "a", "an", "either", "both", "terms", "of", "under"}

PLACE = "struct<start: long, n_words: int, kind: string, label: string, weight: double>"
EXPRESSION = "struct<start: long, text: string, ids: array<string>, duty: string>"


# --- expressions ---------------------------------------------------------------


def family_duty(name: str) -> int:
    """Duty of one identifier by its longest known beginning."""
    low = name.lower().rstrip("+")
    known = [f for f in FAMILIES if low == f or low.startswith(f + "-")]
    return FAMILIES[max(known, key=len)] if known else len(DUTIES) - 1


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting yard for or, and, with (binding in this order, from the left) and
    brackets.  Reads as far as the tokens make an expression, and drops an operator or
    a bracket that nothing completes."""
    out, stack, operand = [], [], True
    for token in tokens:
        low = token.lower()
        if operand:
            if token == "(":
                stack.append(token)
            elif token == ")" or low in OPERATORS:
                break
            else:
                out.append(token)
                operand = False
        elif low in OPERATORS:
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= OPERATORS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif token == ")" and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            break
    while operand and stack:  # nothing came after the last operator or bracket
        operand = stack.pop() == "("
    return out + [op for op in reversed(stack) if op != "("]


def evaluate(postfix: list[str]) -> tuple[list[str], int] | None:
    """Identifiers and the duty left to a user: the stricter part of an ``and``, the
    freer of an ``or``; an exception (``with``) softens copyleft by one step."""
    stack = []
    for token in postfix:
        if token not in OPERATORS:
            stack.append(([token], family_duty(token)))
            continue
        if len(stack) < 2:
            continue
        (ids, right), (before, left) = stack.pop(), stack.pop()
        if token == "with":
            duty = left - 1 if 0 < left < 3 else left
        else:
            duty = max(left, right) if token == "and" else min(left, right)
        stack.append((before + ids, duty))
    return stack[-1] if stack else None


def expression(text: str) -> tuple[str, list[str], int] | None:
    """Postfix form, identifiers and duty of the expression a text begins with."""
    tokens, at = [], 0
    while (m := TOKEN.match(text, at)) is not None:
        tokens.append(m[1])
        at = m.end()
    postfix = to_postfix(tokens)
    found = evaluate(postfix)
    return (" ".join(postfix), *found) if found else None


# --- places --------------------------------------------------------------------


@lru_cache(maxsize=1)
def automaton():
    """Every phrase between blanks, so that only whole words meet."""
    import ahocorasick

    entries: dict[str, list[tuple[str, str, float]]] = {}
    for words, label in BASE.items():
        entries.setdefault(words, []).append(("base", label, 0.5))
    for words, (label, weight) in NOTICES.items():
        entries.setdefault(words, []).append(("notice", label, weight))
    for words in GRANTS:
        entries.setdefault(words, []).append(("grant", "", 0.0))
    for words in TAGS:
        entries.setdefault(words, []).append(("tag", "", 0.0))
    found = ahocorasick.Automaton()
    for words, kinds in entries.items():
        found.add_word(f" {words} ", (len(words) + 2, words.count(" ") + 1, kinds))
    found.make_automaton()
    return found


def scan(plain: str, text: str | None) -> tuple[int, list[tuple], list[tuple]]:
    """Number of words, places and expressions of one text.  ``plain`` are its words
    between single blanks; ``text`` is the original, wanted only if tags are possible."""
    padded = f" {plain} "
    places, at, word = [], 0, 0
    hits = sorted((end - size + 1, n, kinds) for end, (size, n, kinds) in automaton().iter(padded))
    for start, n, kinds in hits:
        word += padded.count(" ", at, start)
        at = start
        places.extend((word, n, kind, label, weight) for kind, label, weight in kinds)
    places.sort()
    expressions = []
    if any(p[2] == "tag" for p in places) and text is not None:
        spans = [m.span() for m in WORD.finditer(text.translate(CASE))]
        for start, n, kind, *_ in places:
            if kind != "tag":
                continue
            line = text[spans[start + n - 1][1] :].split("\n", 1)[0]
            if (found := expression(line.lstrip(" \t:=\"'"))) is not None:
                expressions.append((start, *found))
    expressions += notice_expressions(plain, [p for p in places if p[2] in ("base", "notice")])
    return (padded.count(" ") - 1 if plain else 0), places, sorted(expressions)


def notice_expressions(plain: str, places: list[tuple]) -> list[tuple]:
    """Notices that ``and`` or ``or`` joins, with at most fillers besides, as expressions."""
    if len(places) < 2:
        return []
    words = plain.split(" ")
    # Of notices that overlap, the one that begins first and is longest speaks.
    chain = []
    for start, n, kind, label, _ in sorted(places, key=lambda p: (p[0], -p[1], p[2])):
        if not chain or start >= chain[-1][0] + chain[-1][1]:
            chain.append((start, n, label))
    out, tokens, begin = [], [chain[0][2]], chain[0][0]

    def close() -> None:
        if len(tokens) > 1:
            postfix = to_postfix(tokens)
            out.append((begin, " ".join(postfix), *evaluate(postfix)))

    for (s, n, _), (start, _, label) in zip(chain, chain[1:]):
        gap = words[s + n : start] if start - s - n <= 8 else [""]
        joins = [w for w in gap if w in ("and", "or")]
        rest = [w for w in gap if w not in FILLERS and w not in ("and", "or") and not w.isdigit() and w != "version"]
        if len(joins) == 1 and not rest:
            tokens += [joins[0], label]
        else:
            close()
            tokens, begin = [label], start
    close()
    return out


def score(places: list[tuple], expressions: list[tuple]) -> float:
    """How sure the text bears a licence: 1 less the product of what each kind of
    evidence leaves open.  A name right after words of a grant counts for more."""
    ends = {start + n for start, n, kind, *_ in places if kind == "grant"}
    best: dict[str, float] = {}
    for start, _, kind, label, weight in places:
        if kind in ("base", "notice"):
            granted = ends & {start, start - 1}  # "under mit license", "under the mit license"
            best[label] = max(best.get(label, 0.0), weight + (1 - weight) / 2 if granted else weight)
    open_ = 1.0
    for weight in best.values():
        open_ *= 1 - weight
    tagged = {start for start, _, kind, *_ in places if kind == "tag"}
    for start, _, ids, duty in expressions:
        if start in tagged:
            open_ *= 0.3 if duty == len(DUTIES) - 1 else 0.05
    return round(1 - open_, 6)


def scan_licenses(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Licence phrases, tags and expressions of every whole text.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case.  Returns
    doc_id, n_words, ``places`` (start in words, n_words, kind, label, weight; kind is
    base, notice, grant or tag; overlapping places all count), ``expressions`` (start,
    postfix text, ids, duty) and score.

    Texts are reduced to words by built-in functions; one automaton of all phrases then
    passes over each text once, in Python, whatever the number of phrases.  Nothing is
    shuffled.  Only texts with the word of a tag go to Python in the original, too.
    Null and empty texts have no words and no places.  Rows without a key and repeated
    rows are each read by themselves; other columns are not looked at.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    plain = F.trim(F.regexp_replace(low, BETWEEN, " "))
    given = rows.select(F.col(key).cast("long").alias("doc_id"), plain.alias("plain"), F.col(text).alias("text"))
    tagged = reduce(lambda a, b: a | b, [F.contains("plain", F.lit(t)) for t in TAGS])
    given = given.select("doc_id", "plain", F.when(tagged, F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.struct([("start", pa.int64()), ("n_words", pa.int32()), ("kind", pa.string()), ("label", pa.string()), ("weight", pa.float64())])
        formed = pa.struct([("start", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.string())), ("duty", pa.string())])
        for batch in batches:
            n, found, said, sure = [], [], [], []
            for one, original in zip(batch.column("plain"), batch.column("text")):
                words, places, expressions = scan(one.as_py(), original.as_py())
                n.append(words)
                found.append([dict(zip(place.names, p)) for p in places])
                said.append([dict(zip(formed.names, (s, t, ids, DUTIES[d]))) for s, t, ids, d in expressions])
                sure.append(score(places, expressions))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, pa.list_(place)),
                 pa.array(said, pa.list_(formed)), pa.array(sure, pa.float64())],
                names=["doc_id", "n_words", "places", "expressions", "score"],
            )

    schema = f"doc_id long, n_words long, places array<{PLACE}>, expressions array<{EXPRESSION}>, score double"
    return given.mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts, first and last place and labels; expressions as their duties."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    label: Column = F.transform(F.filter("places", lambda p: p["label"] != ""), lambda p: p["label"])
    ids = F.flatten(F.transform("expressions", lambda e: F.transform(e["ids"], lambda i: F.lower(i))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(F.concat(label, ids)).alias("labels"), "score",
        joined(F.transform("expressions", lambda e: e["duty"])).alias("duties"),
    )
