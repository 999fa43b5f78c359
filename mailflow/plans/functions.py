"""SQL functions over mails: scalar ones for any text, and search as a table.

``create`` makes them for a session, as temporary functions; with ``schema`` the scalar
ones that need no Python are made lasting there.  Word lists and patterns are written
into the functions' bodies from the same values that the operators use.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession, functions as F

from mailflow import schemas, values
from mailflow.functions import text
from mailflow.operators import enrich, search


def literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def listed(words) -> str:
    return ", ".join(map(literal, words))


def words(of: str) -> str:
    return f"regexp_extract_all(lower({of}), {literal(text.WORD)}, 0)"


def once(value: str, name: str, body: str) -> str:
    """A value used several times in a body, computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def sentiment_body() -> str:
    known = f"filter({words('content')}, w -> w IN ({listed([*text.POSITIVE_WORDS, *text.NEGATIVE_WORDS])}))"
    up = f"size(filter(ws, w -> w IN ({listed(text.POSITIVE_WORDS)})))"
    down = f"size(filter(ws, w -> w IN ({listed(text.NEGATIVE_WORDS)})))"
    balance = (
        "CAST(CAST((CASE WHEN n.up < n.down THEN -1 ELSE 1 END * floor(abs(n.up - n.down) * 10000"
        " / greatest(n.up + n.down, 1))) / 10000 AS DECIMAL(9, 4)) AS STRING)"
    )
    return once(known, "ws", once(f"named_struct('up', {up}, 'down', {down})", "n", balance))


def actions_body() -> str:
    import re

    cue = "(?i)(^|[^A-Za-z])(" + "|".join(map(re.escape, text.ACTION_CUES)) + ")([^A-Za-z]|$)"
    found = f"transform(regexp_extract_all(content, {literal(text.SENTENCE)}, 0), s -> trim(s))"
    asked = f"transform(filter({found}, s -> s <> '' AND s RLIKE {literal(cue)}), s -> '- ' || s)"
    none = f"CASE WHEN content IS NOT NULL THEN {literal(values.NO_ACTION_ITEMS)} END"
    return f"coalesce(nullif(array_join({asked}, '\\n'), ''), {none})"


def class_body(rules=None) -> str:
    rules = rules or enrich.CLASS_RULES
    known = sorted({w for weights in rules.values() for w in weights})
    full = f"concat_ws(' ', coalesce(subject, {literal(values.DEFAULT_SUBJECT)}), content)"
    scored = []
    for i, label in enumerate(c for c in values.CLASSES if c in rules):
        points = " ".join(f"WHEN {literal(w)} THEN {p}" for w, p in rules[label].items())
        total = f"aggregate(ws, 0L, (t, w) -> t + CASE w {points} ELSE 0 END)"
        scored.append(f"named_struct('score', {total}, 'place', {-i}, 'label', {literal(label)})")
    best = f"CASE WHEN size(ws) > 0 THEN array_max(array({', '.join(scored)})).label ELSE 'OTHER' END"
    found = once(f"filter({words(full)}, w -> w IN ({listed(known)}))", "ws", best)
    return f"CASE WHEN content IS NOT NULL THEN {found} END"


def entities_body(gazetteer=None, patterns=None) -> str:
    import re

    gazetteer, patterns = gazetteer or enrich.GAZETTEER, patterns or enrich.ENTITY_PATTERNS
    fields = []
    for kind in schemas.ENTITY_KINDS:
        if kind in patterns:
            pattern = patterns[kind]
        else:
            names = sorted(gazetteer.get(kind, []), key=len, reverse=True)
            pattern = "(?<![A-Za-z])(?:" + "|".join(map(re.escape, names)) + ")(?![A-Za-z])" if names else "(?!)"
        fields.append(f"'{kind}', sort_array(array_distinct(regexp_extract_all(content, {literal(pattern)}, 0)))")
    return f"named_struct({', '.join(fields)})"


def create(
    spark: SparkSession, mails: str = "processed_emails", summaries: str = "email_summaries",
    rules=None, gazetteer=None, patterns=None,
) -> list[str]:
    """Make the functions for ``spark.sql``; returns their names.

    - ``summarize_email(content, summary_type)``: BRIEF, DETAILED, ACTION_ITEMS or
      SENTIMENT in any case of letters; another type gives a message.
    - ``classify_email(content, subject)``: the class, null without a content.
    - ``extract_email_entities(content)``: a struct of seven arrays.
    - ``search_emails(query, n)``: the ``n`` best mails of the views ``mails`` and
      ``summaries``, as rows, with the scores of ``operators.search``.
    """
    sizes = {"brief": enrich.BRIEF_SENTENCES, "detailed": enrich.DETAILED_SENTENCES}

    @F.arrow_udf("struct<brief: string, detailed: string>")
    def extracts(texts: pa.Array) -> pa.Array:
        made = text.summary_arrays(texts, list(sizes.values()), text.STOP_WORDS)
        return pa.StructArray.from_arrays(made, list(sizes))

    spark.udf.register("email_extracts", extracts)
    scalar = {
        "email_sentiment(content STRING) RETURNS STRING": sentiment_body(),
        "email_action_items(content STRING) RETURNS STRING": actions_body(),
        "classify_email(content STRING, subject STRING) RETURNS STRING": class_body(rules),
        f"extract_email_entities(content STRING) RETURNS {entity_type()}": entities_body(gazetteer, patterns),
        "summarize_email(content STRING, summary_type STRING) RETURNS STRING": f"""
            CASE upper(summary_type)
              WHEN '{values.BRIEF}' THEN email_extracts(content).brief
              WHEN '{values.DETAILED}' THEN email_extracts(content).detailed
              WHEN '{values.ACTION_ITEMS}' THEN email_action_items(content)
              WHEN '{values.SENTIMENT}' THEN email_sentiment(content)
              ELSE {literal(enrich.UNKNOWN_KIND)} END""",
    }
    for head, body in scalar.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {search_head()} RETURN {search_body(mails, summaries)}")
    return [head.split("(")[0] for head in [*scalar, search_head()]]


def entity_type() -> str:
    return "STRUCT<" + ", ".join(f"{kind}: ARRAY<STRING>" for kind in schemas.ENTITY_KINDS) + ">"


def search_head() -> str:
    return (
        "search_emails(query STRING, n INT DEFAULT 10) RETURNS TABLE (email_id STRING, subject STRING,"
        " sender_email STRING, email_date TIMESTAMP_NTZ, relevance_score DOUBLE, brief_summary STRING)"
    )


def search_body(mails: str, summaries: str) -> str:
    """BM25 of each mail by the words of the query; only id and score are sorted."""
    score = (
        f"round(aggregate(transform(sequence(0, size(f.terms) - 1), i -> CASE WHEN m.tf[i] = 0 THEN 0D ELSE"
        f" ln(1 + (f.n - f.df[i] + 0.5D) / (f.df[i] + 0.5D)) * m.tf[i] * {search.K1 + 1}D"
        f" / (m.tf[i] + {search.K1}D * ({1 - search.B}D + {search.B}D * m.dl / greatest(f.avgdl, 1e-9D))) END),"
        " 0D, (a, b) -> a + b), 9)"
    )
    return f"""
WITH asked AS (SELECT array_distinct({words('query')}) AS terms),
tokens AS (SELECT email_id, {words("concat_ws(' ', coalesce(subject, ''), email_body)")} AS ws FROM {mails} WHERE email_body IS NOT NULL),
counts AS (
  SELECT email_id, size(ws) AS dl, transform(terms, t -> size(filter(ws, w -> w = t))) AS tf
  FROM tokens JOIN asked ON true),
figures AS (
  SELECT any_value(terms) AS terms, any_value(n) AS n, any_value(avgdl) AS avgdl, transform(sort_array(collect_list(struct(i, df))), d -> d.df) AS df FROM (
    SELECT i, count_if(hit > 0) AS df, count(*) AS n, avg(dl) AS avgdl FROM (SELECT dl, posexplode(tf) AS (i, hit) FROM counts) GROUP BY i)
  JOIN asked ON true),
scored AS (SELECT m.email_id, {score} AS score FROM counts m JOIN figures f ON true),
ranked AS (SELECT email_id, score, row_number() OVER (ORDER BY score DESC, email_id) AS place FROM scored),
best AS (SELECT *, max(score) OVER () AS top FROM ranked WHERE place <= search_emails.n)
SELECT b.email_id, m.subject, m.sender_email, m.email_date,
  CASE WHEN top > 0 THEN round(score / top, 6) ELSE 0D END AS relevance_score, s.summary_text AS brief_summary
FROM best b JOIN {mails} m ON m.email_id = b.email_id
LEFT JOIN {summaries} s ON s.email_id = b.email_id AND s.summary_type = 'BRIEF'"""
