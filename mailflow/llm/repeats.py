"""Removing text units that occur before, in another document or the same one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[ \t\r\f\x0B]"
WORD = r"[^ \t\r\f\x0B\n]+"


def unit_pattern(words: int) -> str:
    """Cuts a text into pieces that tile it.  A unit has at least ``words`` words of one
    line and goes on to the end of a sentence or of the line; what is left of a line is
    a piece of its own.  No look-around, so that SQL engines read it alike."""
    unit = rf"{SPACE}*(?:{WORD}{SPACE}+){{{words - 1}}}{WORD}[^\n]*?(?:[.!?]{SPACE}|\n|\z)"
    return rf"{unit}|[^\n]*\n|[^\n]+\z"


def is_unit(piece: Column, words: int) -> Column:
    return piece.rlike(rf"\A{SPACE}*(?:{WORD}{SPACE}+){{{words - 1}}}{WORD}")


def normal(piece: Column) -> Column:
    """Letter case and spacing do not count."""
    return F.trim(F.regexp_replace(F.lower(piece), rf"(?:{SPACE}|\n)+", " "))


def drop_repeats(rows: DataFrame, key: str, text: str, words: int = 5) -> DataFrame:
    """Keep the first occurrence of every unit, in the order of ``key`` and then of the
    place in the text; take every later one out.

    Returns doc_id, text (what is left), n_units, n_removed and ``removed``: the taken
    parts as code point ranges of the original text, (start, end) with end exclusive.

    Units are grouped by two 64-bit hashes of their normal form, each document sending
    each unit once and tasks combining before the shuffle, so that a unit that all
    documents share costs a row a task.  First occurrences go back to their documents;
    no join is on a unit, hence none on a hot one.  An empty text has no units, a null
    text stays null, with null counts 0; rows without a key are returned unchanged; rows
    that repeat a key are read as one document each and keep the same units.  Other
    columns of ``rows`` are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = F.regexp_extract_all("text", F.lit(unit_pattern(words)), F.lit(0))
    forms = F.transform(F.filter(pieces, lambda p: is_unit(p, words)), normal)
    found = given.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode(F.array_distinct(forms)).alias("form"))
    hashed = found.select("doc_id", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit(1), "form").alias("h2"))
    first = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))
    kept = first.groupBy("owner").agg(F.collect_list("h1").alias("kept"))

    cut = given.join(kept, F.col("doc_id") == F.col("owner"), "left").withColumn("pieces", F.coalesce(pieces, F.array()))
    cut = cut.withColumn(
        "hashes", F.transform("pieces", lambda p: F.when(is_unit(p, words), F.xxhash64(normal(p))))
    )
    units = F.filter("hashes", lambda h: h.isNotNull())
    cut = cut.withColumn("units", units).withColumn(
        "gone", F.when(F.col("doc_id").isNotNull(), F.array_except("units", F.coalesce("kept", F.array().cast("array<long>"))))
    )
    twice = F.size(F.array_distinct("units")) < F.size("units")
    again = F.when(twice, F.transform("hashes", lambda h, i: F.coalesce(F.array_position("hashes", h) < i + 1, F.lit(False))))
    cut = cut.withColumn("again", F.when(F.col("doc_id").isNotNull(), again))
    out = F.transform(
        "hashes",
        lambda h, i: F.coalesce(F.array_contains("gone", h), F.lit(False)) | F.coalesce(F.get("again", i), F.lit(False)),
    )
    cut = cut.withColumn("out", F.when((F.size("gone") > 0) | F.col("again").isNotNull(), out))
    lengths = F.transform("pieces", F.length)
    ends = F.aggregate(
        lengths, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))
    )
    cut = cut.withColumn("ends", F.when(F.col("out").isNotNull(), ends))
    spans = F.filter(
        F.transform("out", lambda o, i: F.when(o, F.struct(F.get("ends", i).alias("start"), F.get("ends", i + 1).alias("end")))),
        lambda s: s.isNotNull(),
    )
    left = F.array_join(F.filter("pieces", lambda p, i: ~F.get("out", i)), "")
    changed = F.col("out").isNotNull()
    return cut.select(
        "doc_id", F.when(changed, left).otherwise(F.col("text")).alias("text"),
        F.size("units").cast("long").alias("n_units"),
        F.coalesce(F.size(F.filter("out", lambda o: o)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(spans, F.array()).alias("removed"),
    )


def repeats_sql(words: int = 5) -> str:
    """The same over ``documents`` as SQL, with spans written start-end;start-end."""
    unit = rf"^{SPACE}*(?:{WORD}{SPACE}+){{{words - 1}}}{WORD}"
    return f"""
WITH cut AS (SELECT doc_id, regexp_extract_all(text, '{unit_pattern(words)}') AS p FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM cut),
formed AS (
  SELECT *, regexp_matches(piece, '{unit}') AS unit,
    trim(regexp_replace(lower(piece), '(?:{SPACE}|\\n)+', ' ', 'g')) AS form,
    coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s
  FROM pieces),
ranked AS (SELECT *, unit AND row_number() OVER (PARTITION BY unit, form ORDER BY doc_id, i) > 1 AS gone FROM formed),
joined AS (
  SELECT doc_id, coalesce(string_agg(piece, '' ORDER BY i) FILTER (NOT gone), '') AS text,
    count(*) FILTER (unit) AS n_units, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(s || '-' || (s + length(piece)), ';' ORDER BY i) FILTER (gone), '') AS removed
  FROM ranked GROUP BY doc_id)
SELECT d.doc_id, coalesce(j.text, d.text) AS text, coalesce(n_units, 0)::BIGINT AS n_units,
  coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN joined j USING (doc_id)"""
