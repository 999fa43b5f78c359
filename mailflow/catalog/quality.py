"""Validation and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailflow.catalog import testbed as tb
from mailflow.catalog.registry import query
from mailflow.operators import dedupe, parse, quality

BROKEN = """
SELECT email_id, subject, list_filter([
    CASE WHEN sender_email IS NULL OR NOT regexp_matches(sender_email,
      '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$') THEN 'Invalid sender email format' END,
    CASE WHEN coalesce(subject, '') = '' THEN 'Missing email subject' END,
    CASE WHEN email_body IS NULL OR length(email_body) < 10 THEN 'Email body too short or missing' END,
    CASE WHEN email_date IS NULL THEN 'Missing email date' END], lambda e: e IS NOT NULL) AS errors
FROM mails"""


@query(
    "validate_mail",
    tb.sql(tb.BASE, tb.MAILS, select=f"""
SELECT email_id, cast(len(errors) AS INTEGER) AS error_count,
  CASE WHEN len(errors) = 0 THEN 'Email validation passed'
       ELSE concat('Email validation failed: ', array_to_string(errors, ', ')) END AS validation_result
FROM ({BROKEN})"""),
)
def validate_mail(spark, sf):
    """Broken rules and result line of every mail."""
    checked = quality.validate_mail(tb.mails(spark, sf))
    return checked.select(
        "email_id", F.size("validation_errors").alias("error_count"), "validation_result"
    )


@query(
    "invalid_mail",
    tb.sql(tb.BASE, tb.MAILS, select=f"""
SELECT email_id, subject, array_to_string(errors, '; ') AS validation_errors
FROM ({BROKEN}) WHERE len(errors) > 0"""),
)
def invalid_mail(spark, sf):
    """Mails that break a rule."""
    found = quality.invalid_mail(tb.mails(spark, sf))
    return found.withColumn("validation_errors", F.array_join("validation_errors", "; "))


@query(
    "validation_summary",
    tb.sql(tb.BASE, tb.MAILS, select=f"""
SELECT r.rule, cast(count(e.email_id) AS BIGINT) AS mails
FROM (VALUES ('Invalid sender email format'), ('Missing email subject'),
      ('Email body too short or missing'), ('Missing email date')) r(rule)
LEFT JOIN (SELECT email_id, unnest(errors) AS rule FROM ({BROKEN})) e ON e.rule = r.rule
GROUP BY r.rule"""),
)
def validation_summary(spark, sf):
    """Mails per broken rule."""
    return quality.validation_summary(tb.mails(spark, sf))


@query(
    "dedupe_exact",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, email_date FROM mails
QUALIFY row_number() OVER (PARTITION BY CASE WHEN email_body IS NULL THEN email_id ELSE sha256(email_body) END
  ORDER BY email_date ASC NULLS LAST, email_id) = 1"""),
)
def dedupe_exact(spark, sf):
    """The earliest mail of each content."""
    return dedupe.dedupe_exact(tb.mails(spark, sf)).select("email_id", "email_date")


@query(
    "dedupe_by_key",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, sender_email, subject FROM mails
QUALIFY row_number() OVER (PARTITION BY sender_email, subject,
  CASE WHEN sender_email IS NULL OR subject IS NULL THEN email_id END
  ORDER BY email_date ASC NULLS LAST, email_id) = 1"""),
)
def dedupe_by_key(spark, sf):
    """The earliest mail per sender and subject."""
    kept = dedupe.dedupe_exact(tb.mails(spark, sf), ["sender_email", "subject"])
    return kept.select("email_id", "sender_email", "subject")


@query(
    "dedupe_message_id",
    tb.sql(tb.BASE, select="""
SELECT concat('F', doc_id) AS file_id, concat('m', doc_id // 2) AS message_id,
  concat('t', doc_id % 50) AS thread_id FROM base
QUALIFY row_number() OVER (PARTITION BY doc_id // 2
  ORDER BY date_trunc('milliseconds', upload_timestamp)) = 1"""),
)
def dedupe_message_id(spark, sf):
    """The earliest of the mails parsed with the same message id."""
    b = tb.base(spark, sf)
    parsed = parse.parse_mail(tb.raw_from(b, tb.api_json(b)))
    kept = dedupe.dedupe_exact(parsed, ["message_id"])
    return kept.select("file_id", "message_id", "thread_id")


@query(
    "near_duplicates",
    tb.sql(tb.BASE, tb.MAILS, """
forms AS (
  SELECT email_id, trim(regexp_replace(concat_ws(chr(10),
    regexp_replace(lower(coalesce(subject, '')), '^( *(re|fw|fwd|aw) *:)+', ''),
    lower(coalesce(email_body, ''))), '[> \\t\\r\\n]+', ' ', 'g')) AS form FROM mails
)""", select="""
SELECT email_id, min(email_id) OVER (PARTITION BY form) AS first_id,
  count(*) OVER (PARTITION BY form) AS copies
FROM forms WHERE form <> '' QUALIFY count(*) OVER (PARTITION BY form) > 1"""),
)
def near_duplicates(spark, sf):
    """Mails equal to another one but for case, spacing, quoting, prefixes."""
    return dedupe.near_duplicates(tb.mails(spark, sf))


CHANGED = """
changed AS (
  SELECT email_id, subject, email_body, string_split(email_body, ' ') AS w, CAST(substr(email_id, 2) AS BIGINT) AS n FROM mails
), more AS (
  SELECT email_id, subject, email_body FROM changed
  UNION ALL
  SELECT concat('N', n), subject, array_to_string(
    w[:n * 7 % len(w)] || ['changed'] || w[n * 7 % len(w) + 2:], ' ') FROM changed WHERE n % 3 = 0 AND email_body IS NOT NULL
), forms AS (
  SELECT email_id, trim(regexp_replace(concat_ws(chr(10),
    regexp_replace(lower(coalesce(subject, '')), '^( *(re|fw|fwd|aw) *:)+', ''),
    lower(coalesce(email_body, ''))), '[> \\t\\r\\n]+', ' ', 'g')) AS form FROM more
), texts AS (SELECT form, min(email_id) AS id, string_split(form, ' ') AS w FROM forms WHERE form <> '' GROUP BY form),
runs AS (SELECT id, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))])) AS run FROM texts),
sizes AS (SELECT id, count(*) AS n FROM runs GROUP BY id),
shared AS (SELECT a.id AS x, b.id AS y, count(*) AS n FROM runs a JOIN runs b ON a.run = b.run AND a.id <> b.id GROUP BY ALL),
linked AS (SELECT x, y FROM shared s JOIN sizes a ON a.id = x JOIN sizes b ON b.id = y WHERE s.n >= 0.75 * (a.n + b.n - s.n)),
reach(x, y) AS (SELECT id, id FROM texts UNION SELECT r.x, l.y FROM reach r JOIN linked l ON l.x = r.y),
firsts AS (SELECT x AS id, min(y) AS first_id FROM reach GROUP BY x),
grouped AS (SELECT f.email_id, g.first_id, count(*) OVER (PARTITION BY g.first_id) AS copies
  FROM forms f JOIN texts t ON t.form = f.form JOIN firsts g ON g.id = t.id)"""


@query(
    "near_duplicates_similar",
    "WITH RECURSIVE " + tb.sql(tb.BASE, tb.MAILS, CHANGED, select="SELECT * FROM grouped WHERE copies > 1")[5:],
)
def near_duplicates_similar(spark, sf):
    """Mails alike in three quarters of their five-word runs: every third mail comes
    once more with a word changed."""
    mails = tb.mails(spark, sf).select("email_id", "subject", "email_body")
    number = F.substring("email_id", 2, 20).cast("bigint")
    w = F.split("email_body", " ")
    at = (number * 7 % F.size(w)).cast("int")
    body = F.array_join(F.concat(F.slice(w, F.lit(1), at), F.array(F.lit("changed")), F.slice(w, at + 2, F.size(w))), " ")
    copies = mails.filter(F.col("email_body").isNotNull() & (number % 3 == 0)).select(
        F.concat(F.lit("N"), number.cast("string")).alias("email_id"), "subject", body.alias("email_body")
    )
    return dedupe.near_duplicates(mails.unionByName(copies), 0.75)


@query(
    "latest_per_sender_subject",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, sender_email, subject, extracted_timestamp FROM mails
QUALIFY row_number() OVER (PARTITION BY sender_email, subject
  ORDER BY extracted_timestamp DESC, email_id DESC) = 1"""),
)
def latest_mail(spark, sf):
    """The latest mail per sender and subject."""
    order = [F.col("extracted_timestamp").desc(), F.col("email_id").desc()]
    latest = dedupe.latest_per_key(tb.mails(spark, sf), ["sender_email", "subject"], order)
    return latest.select("email_id", "sender_email", "subject", "extracted_timestamp")


@query(
    "latest_brief",
    tb.sql(tb.BASE, tb.SUMMARIES, select="""
SELECT email_id, summary_text, created_timestamp FROM summaries WHERE summary_type = 'BRIEF'
QUALIFY row_number() OVER (PARTITION BY email_id ORDER BY created_timestamp DESC, summary_id DESC) = 1"""),
)
def latest_brief(spark, sf):
    """The latest BRIEF per mail."""
    briefs = tb.summaries(spark, sf).filter("summary_type = 'BRIEF'")
    order = [F.col("created_timestamp").desc(), F.col("summary_id").desc()]
    latest = dedupe.latest_per_key(briefs, ["email_id"], order)
    return latest.select("email_id", "summary_text", "created_timestamp")


@query(
    "latest_turn",
    """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) = 1""",
)
def latest_turn(spark, sf):
    """The latest message per thread."""
    turns = tb.table(spark, sf, "conversations")
    latest = dedupe.latest_per_key(turns, ["conv_id"], [F.col("turn").desc(), "role", "text"])
    return latest.select("conv_id", "turn", "role", "text")
