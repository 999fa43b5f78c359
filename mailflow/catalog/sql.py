"""Plain SQL over the registered tables and views."""

from __future__ import annotations

from mailflow.catalog import enrichment as en, testbed as tb
from mailflow.catalog.registry import query
from mailflow.functions import text
from mailflow.operators import enrich, quality
from mailflow.plans import functions, store


def _run(spark, sf, text: str):
    mails = quality.validate_mail(tb.mails(spark, sf))
    store.register(spark, tb.raw(spark, sf), mails, tb.summaries(spark, sf), tb.jobs(spark, sf))
    return spark.sql(text)


@query(
    "sql_insights",
    tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, select="""
SELECT email_classification, count(*) AS mails, count(s.summary_text) AS with_sentiment,
  round(avg(cast(s.summary_text AS DOUBLE)), 6) AS avg_sentiment
FROM mails m LEFT JOIN summaries s ON s.email_id = m.email_id AND s.summary_type = 'SENTIMENT'
GROUP BY email_classification"""),
)
def sql_insights(spark, sf):
    """Mean sentiment per class, from the insights view."""
    return _run(spark, sf, """
SELECT email_classification, count(*) AS mails, count(sentiment_score) AS with_sentiment,
  round(avg(CAST(sentiment_score AS DOUBLE)), 6) AS avg_sentiment
FROM email_ai_insights GROUP BY email_classification""")


@query(
    "sql_validation",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT count(*) AS mails, count(*) FILTER (n > 0) AS with_errors, cast(sum(n) AS BIGINT) AS errors
FROM (SELECT cast(sender_email IS NULL AS INT) + cast(coalesce(subject, '') = '' AS INT)
  + cast(coalesce(length(email_body), 0) < 10 AS INT) + cast(email_date IS NULL AS INT) AS n FROM mails)"""),
)
def sql_validation(spark, sf):
    """How many mails have validation errors, and how many errors there are."""
    return _run(spark, sf, """
SELECT count(*) AS mails, count_if(size(validation_errors) > 0) AS with_errors,
  sum(CAST(greatest(size(validation_errors), 0) AS BIGINT)) AS errors FROM processed_emails""")


@query(
    "sql_sender_sentiment",
    tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, select="""
SELECT lower(split_part(sender_email, '@', -1)) AS domain, count(DISTINCT sender_email) AS senders,
  count(*) FILTER (cast(summary_text AS DOUBLE) < 0) AS negative_mails, round(min(cast(summary_text AS DOUBLE)), 6) AS lowest
FROM mails JOIN summaries USING (email_id)
WHERE summary_type = 'SENTIMENT' AND email_date >= (SELECT max(email_date) FROM mails) - INTERVAL 3 DAY
GROUP BY ALL"""),
)
def sql_sender_sentiment(spark, sf):
    """Bad moods of the last three days per sender domain."""
    return _run(spark, sf, """
WITH lately AS (
  SELECT email_id, sender_email, lower(substring_index(sender_email, '@', -1)) AS domain FROM processed_emails
  WHERE email_date >= (SELECT max(email_date) - INTERVAL 3 DAYS FROM processed_emails)
), moods AS (
  SELECT email_id, CAST(summary_text AS DOUBLE) AS mood FROM email_summaries WHERE summary_type = 'SENTIMENT'
)
SELECT domain, count(DISTINCT sender_email) AS senders, count_if(mood < 0) AS negative_mails,
  round(min(mood), 6) AS lowest
FROM lately JOIN moods USING (email_id) GROUP BY domain""")


@query(
    "sql_overview",
    tb.sql(tb.BASE, tb.RAW, tb.MAILS, tb.SUMMARIES, select="""
SELECT r.processing_status, count(*) AS files, count(m.subject) AS subjects, count(s.summary_id) AS briefs
FROM raw r LEFT JOIN mails m USING (file_id)
LEFT JOIN summaries s ON s.email_id = m.email_id AND s.summary_type = 'BRIEF' GROUP BY r.processing_status"""),
)
def sql_overview(spark, sf):
    """Files, mails and briefs by state, from the overview."""
    return _run(spark, sf, """
SELECT processing_status, count(*) AS files, count(subject) AS subjects, count(brief_summary) AS briefs
FROM email_processing_overview GROUP BY processing_status""")


def _with_functions(spark, sf, statement: str, **lists):
    tb.mails(spark, sf).createOrReplaceTempView("processed_emails")
    tb.summaries(spark, sf).createOrReplaceTempView("email_summaries")
    functions.create(spark, **lists)
    return spark.sql(statement)


@query(
    "sql_summarize",
    tb.sql(
        tb.BASE, tb.MAILS, en.BOTH, en.ACTIONS, en.sentiment_sql(text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
        select=f"""
SELECT t.email_id, t.brief, t.detailed, a.action_items, s.sentiment, {functions.literal(enrich.UNKNOWN_KIND)} AS other
FROM texts t JOIN actions a USING (email_id) JOIN moods s USING (email_id)""",
    ),
)
def sql_summarize(spark, sf):
    """Every kind of summary by the SQL function."""
    return _with_functions(spark, sf, """
SELECT email_id, summarize_email(email_body, 'brief') AS brief, summarize_email(email_body, 'DETAILED') AS detailed,
  summarize_email(email_body, 'Action_Items') AS action_items, summarize_email(email_body, 'sentiment') AS sentiment,
  summarize_email(email_body, 'haiku') AS other
FROM processed_emails WHERE email_body IS NOT NULL""")


@query("sql_classify", tb.sql(tb.BASE, tb.MAILS, en.class_sql(en.RULES), select="SELECT * FROM classes"))
def sql_classify(spark, sf):
    """Class per mail by the SQL function."""
    return _with_functions(spark, sf, """
SELECT email_id, classify_email(email_body, subject) AS email_classification
FROM processed_emails WHERE email_body IS NOT NULL""", rules=en.RULES)


@query("sql_entities", tb.sql(tb.BASE, tb.MAILS, en.entities_sql(en.GAZETTEER), select="SELECT * FROM entities"))
def sql_entities(spark, sf):
    """Entities per mail by the SQL function."""
    return _with_functions(spark, sf, """
SELECT email_id, array_join(e.people, '; ') AS people, array_join(e.companies, '; ') AS companies, array_join(e.dates, '; ') AS dates,
  array_join(e.locations, '; ') AS locations, array_join(e.amounts, '; ') AS amounts,
  array_join(e.phone_numbers, '; ') AS phone_numbers, array_join(e.email_addresses, '; ') AS email_addresses
FROM (SELECT email_id, extract_email_entities(email_body) AS e FROM processed_emails WHERE email_body IS NOT NULL)""", gazetteer=en.GAZETTEER)


@query("sql_search", en.SEARCH_HITS)
def sql_search(spark, sf):
    """The ten best mails for a query, by the table function."""
    return _with_functions(spark, sf, f"SELECT * FROM search_emails('{en.SEARCH}')")
