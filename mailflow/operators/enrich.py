"""Enrichment: summaries, action items, sentiment, classes, entities.

All of it looks at one mail at a time and is a projection over the mail table:
nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mailflow import schemas, values
from mailflow.functions import ids, text, urgency
from mailflow.functions.arrays import let

BRIEF_SENTENCES = 3
DETAILED_SENTENCES = 8
UNKNOWN_KIND = "Unknown summary type; known are " + ", ".join(values.SUMMARY_TYPES)
MODEL_NAME = "mailflow-extractive"

# Words that speak for a class, with their weight.  The classes' order decides
# ties; a mail without any of these words is OTHER.
CLASS_RULES: dict[str, dict[str, int]] = {
    "URGENT": {"urgent": 5, "asap": 5, "critical": 4, "emergency": 5, "immediately": 4},
    "INFORMATIONAL": {"announcement": 3, "update": 2, "report": 2, "notice": 2, "fyi": 3},
    "ACTION_REQUIRED": {"please": 2, "deadline": 3, "submit": 3, "approve": 3, "required": 3},
    "MEETING_REQUEST": {"meeting": 4, "agenda": 3, "invite": 3, "calendar": 3, "schedule": 2},
    "MARKETING": {"offer": 3, "discount": 4, "unsubscribe": 4, "sale": 3, "newsletter": 4},
    "SUPPORT": {"ticket": 4, "support": 3, "bug": 3, "help": 2, "troubleshoot": 4},
    "PERSONAL": {"birthday": 4, "family": 3, "vacation": 3, "dinner": 3, "weekend": 2},
}

ENTITY_PATTERNS = {
    "dates": "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    "|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}"
    "|(?:January|February|March|April|May|June|July|August|September|October|November|December)"
    " [0-9]{1,2}(?:, [0-9]{4})?",
    "amounts": "[$€£][0-9][0-9,]*(?:[.][0-9]+)?",
    "phone_numbers": "[+]?[0-9]{1,3}[-. ][(]?[0-9]{2,4}[)]?[-. ][0-9]{3,4}(?:[-. ][0-9]{2,4})?",
    "email_addresses": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
}

# What the patterns above need: texts without such a character are skipped, and
# a match can only start at the second one.
ENTITY_CHARACTERS = {
    "dates": ("[0-9]", "[0-9JFMASOND]"),
    "amounts": ("[$€£]", "[$€£]"),
    "phone_numbers": ("[0-9]", "[+0-9]"),
    "email_addresses": ("@", "[A-Za-z0-9._%+-]"),
}

# Up to this many names, looking for each one first is cheaper than the pattern.
FEW_NAMES = 20

# Names looked up in the text; replace them with the names that matter to you.
GAZETTEER = {
    "people": ["John Smith", "Jane Doe", "Maria Garcia", "Wei Chen"],
    "companies": ["Apache Software Foundation", "Free Software Foundation", "MIT", "GNU"],
    "locations": ["London", "Paris", "Berlin", "Madrid", "New York", "Tokyo"],
}


# --- per-mail expressions ---------------------------------------------------


def action_items_text(body: Column, cues: list[str] = text.ACTION_CUES) -> Column:
    """Sentences with an action cue as bullets, or a fixed text."""
    bullets = F.transform(text.lines_with_cues(body, cues), lambda s: F.concat(F.lit("- "), s))
    joined = F.array_join(bullets, "\n")
    return F.coalesce(F.nullif(joined, F.lit("")), F.when(body.isNotNull(), values.NO_ACTION_ITEMS))


def sentiment_text(body: Column, positive=text.POSITIVE_WORDS, negative=text.NEGATIVE_WORDS) -> Column:
    """Balance of positive and negative words between -1 and 1, as text."""
    known = F.filter(text.words(body), lambda w: w.isin([*positive, *negative]))
    return let(
        known, lambda w: text.polarity(text.count_in(w, positive), text.count_in(w, negative))
    )


def class_of(subject: Column, body: Column, rules=None) -> Column:
    """Class with the largest weight of words found in subject and body."""
    rules = rules or CLASS_RULES
    vocabulary = sorted({w for weights in rules.values() for w in weights})
    full = F.concat_ws(" ", F.coalesce(subject, F.lit(values.DEFAULT_SUBJECT)), body)
    found = F.filter(text.words(full), lambda w: w.isin(vocabulary))

    def score(hits: Column, weights: dict[str, int]) -> Column:
        def add(total: Column, word: Column) -> Column:
            points = F.lit(0).cast("bigint")
            for known, weight in weights.items():
                points = F.when(word == known, weight).otherwise(points)
            return total + points

        return F.aggregate(hits, F.lit(0).cast("bigint"), add)

    ordered = [c for c in values.CLASSES if c in rules]

    def best(hits: Column) -> Column:
        scored = [
            F.struct(score(hits, rules[c]).alias("score"), F.lit(-i).alias("order"), F.lit(c).alias("label"))
            for i, c in enumerate(ordered)
        ]
        return F.when(F.size(hits) > 0, F.array_max(F.array(*scored))["label"]).otherwise("OTHER")

    return let(found, best)


def entities_of(body: Column, gazetteer=None, patterns=None) -> Column:
    """Struct of seven sorted arrays without repeats."""
    gazetteer = gazetteer or GAZETTEER
    needed = ENTITY_CHARACTERS if patterns is None else {}
    patterns = patterns or ENTITY_PATTERNS
    nothing = F.array().cast("array<string>")

    def found(kind: str) -> Column:
        if kind in needed:
            pattern = f"(?={needed[kind][1]})(?:{patterns[kind]})"
        elif kind in patterns:
            pattern = patterns[kind]
        else:
            names = sorted(gazetteer.get(kind, []), key=len, reverse=True)
            if not names:
                return nothing
            pattern = "(?<![A-Za-z])(?:" + "|".join(map(re.escape, names)) + ")(?![A-Za-z])"
        matches = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        result = F.sort_array(F.array_distinct(matches))
        if kind in needed:
            possible = body.rlike(needed[kind][0])
        elif kind not in patterns and len(names) <= FEW_NAMES:
            possible = reduce(lambda a, b: a | b, [body.contains(name) for name in names])
        else:
            return result
        return F.when(possible, result).when(body.isNotNull(), nothing)

    return F.struct(*[found(kind).alias(kind) for kind in schemas.ENTITY_KINDS])


# --- operators --------------------------------------------------------------


def action_items(mails: DataFrame, cues: list[str] = text.ACTION_CUES) -> DataFrame:
    return mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", action_items_text(F.col("email_body"), cues).alias("action_items")
    )


def sentiment(mails: DataFrame, positive=text.POSITIVE_WORDS, negative=text.NEGATIVE_WORDS) -> DataFrame:
    return mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", sentiment_text(F.col("email_body"), positive, negative).alias("sentiment")
    )


def summary_texts(mails: DataFrame, sizes: dict[str, int], stop_words=text.STOP_WORDS) -> DataFrame:
    """One extractive summary column per size in sentences."""
    made = mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", text.summaries(F.col("email_body"), sizes, stop_words).alias("_s")
    )
    return made.select("email_id", "_s.*")


def summarize(mails: DataFrame, kind) -> DataFrame:
    """Summary text of a kind: a name for all mails, or a column with a name
    per mail.  Names are case-insensitive; an unknown name gives a message."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    asked = mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", "email_body", kind.alias("kind")
    )
    wanted, body = F.upper("kind"), F.col("email_body")
    sizes = {"brief": BRIEF_SENTENCES, "detailed": DETAILED_SENTENCES}
    extractive = F.when(wanted.isin(values.BRIEF, values.DETAILED), body)
    made = asked.withColumn("_s", text.summaries(extractive, sizes))
    summary = (
        F.when(wanted == values.BRIEF, F.col("_s.brief"))
        .when(wanted == values.DETAILED, F.col("_s.detailed"))
        .when(wanted == values.ACTION_ITEMS, action_items_text(body))
        .when(wanted == values.SENTIMENT, sentiment_text(body))
        .otherwise(UNKNOWN_KIND)
    )
    return made.select("email_id", "kind", summary.alias("summary_text"))


def classify_rules(mails: DataFrame, rules=None, first_chars: int | None = None) -> DataFrame:
    """Class per mail; ``first_chars`` is the realtime form's body cap."""
    body = F.col("email_body") if first_chars is None else F.substring("email_body", 1, first_chars)
    return mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", class_of(F.col("subject"), body, rules).alias("email_classification")
    )


def extract_entities(mails: DataFrame, gazetteer=None, patterns=None) -> DataFrame:
    return mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", entities_of(F.col("email_body"), gazetteer, patterns).alias("extracted_entities")
    )


def analyze(mails: DataFrame) -> DataFrame:
    """Full analysis: per mail its four summary texts, class and entities."""
    body = F.col("email_body")
    sizes = {"brief": BRIEF_SENTENCES, "detailed": DETAILED_SENTENCES}
    analysed = mails.filter(body.isNotNull()).select(
        "email_id",
        text.summaries(body, sizes).alias("_s"),
        action_items_text(body).alias("action_items"),
        sentiment_text(body).alias("sentiment"),
        class_of(F.col("subject"), body).alias("email_classification"),
        entities_of(body).alias("extracted_entities"),
    )
    return analysed.select(
        "email_id", "_s.*", "action_items", "sentiment", "email_classification", "extracted_entities"
    )


def summary_rows(analysed: DataFrame, columns: dict[str, str], as_of: Column | None = None) -> DataFrame:
    """Analysed columns as rows of the tall summary table."""
    rows = F.array(
        *[
            F.struct(F.lit(kind).alias("summary_type"), F.col(name).alias("summary_text"))
            for kind, name in columns.items()
        ]
    )
    tall = analysed.select("email_id", F.inline(rows))
    return tall.select(
        ids.row_id("SUMM_", F.col("email_id"), F.col("summary_type")).alias("summary_id"),
        "email_id",
        "summary_type",
        "summary_text",
        F.lit(None).cast("double").alias("confidence_score"),
        (as_of if as_of is not None else F.lit(None)).cast("timestamp_ntz").alias("created_timestamp"),
        F.lit(MODEL_NAME).alias("model_used"),
    )


FULL_COLUMNS = {
    values.BRIEF: "brief",
    values.DETAILED: "detailed",
    values.ACTION_ITEMS: "action_items",
    values.SENTIMENT: "sentiment",
}
REALTIME_COLUMNS = {values.BRIEF: "brief", values.SENTIMENT: "sentiment"}


def analyze_realtime(mails: DataFrame, first_chars: int | None = None) -> DataFrame:
    """BRIEF, SENTIMENT and class per mail; ``first_chars`` caps the text that is classed."""
    body = F.col("email_body")
    opening = body if first_chars is None else F.substring(body, 1, first_chars)
    return mails.filter(body.isNotNull()).select(
        "email_id",
        text.summaries(body, {"s": BRIEF_SENTENCES})["s"].alias("brief"),
        sentiment_text(body).alias("sentiment"),
        class_of(F.col("subject"), opening).alias("email_classification"),
    )


def pending_enrichment(
    mails: DataFrame, summaries: DataFrame, status: str = "ALL",
    limit: int | None = None, raw: DataFrame | None = None,
) -> DataFrame:
    """Mails with a body and no BRIEF yet; optionally only those whose raw file
    has the given status, and only the first ``limit`` by time and id."""
    done = summaries.filter(F.col("summary_type") == values.BRIEF).select("email_id")
    due = mails.filter(F.col("email_body").isNotNull()).join(done, "email_id", "left_anti")
    if status != "ALL":
        wanted = raw.filter(F.col("processing_status") == status).select("file_id")
        due = due.join(wanted, "file_id", "left_semi")
    return due if limit is None else due.orderBy("extracted_timestamp", "email_id").limit(limit)


def estimate_tokens(mails: DataFrame) -> DataFrame:
    return mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", text.token_estimate(F.col("email_body")).alias("estimated_tokens")
    )


def urgency_levels(mails: DataFrame) -> DataFrame:
    """HIGH for urgent mails, MEDIUM for classes that ask for something."""
    urgent = urgency.is_urgent(F.col("subject"), F.col("email_body"))
    return mails.select(
        "email_id", urgency.urgency_level(urgent, F.col("email_classification")).alias("urgency_level")
    )
