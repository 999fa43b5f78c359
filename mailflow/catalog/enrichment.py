"""Enrichment, search and alerts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.catalog.registry import query
from mailflow.catalog.views import URGENT
from mailflow.functions import text, urgency
from mailflow.operators import alerts, enrich, index, model, search
from mailflow.session import work_dir


def words_sql(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def best_sentences(**sizes: int) -> str:
    """CTEs that end in ``texts``: one column per summary size."""
    chosen = ", ".join(
        f"CASE WHEN b.{n} IS NULL THEN array_to_string(l.s[1:{k}], ' ')"
        f" ELSE array_to_string([l.s[i + 1] for i in b.{n}], ' ') END AS {n}"
        for n, k in sizes.items()
    )
    picked = ", ".join(f"list(pos ORDER BY pos) FILTER (rank <= {k}) AS {n}" for n, k in sizes.items())
    return f"""
lists AS (
  SELECT email_id, [t for t in [trim(x) for x in regexp_extract_all(email_body, '[^.!?\\n]+[.!?]*')] if t <> ''] AS s
  FROM mails WHERE email_body IS NOT NULL
), sentences AS (SELECT email_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM lists),
words AS (SELECT email_id, pos, unnest(regexp_extract_all(lower(sentence), '[a-z]+')) AS w FROM sentences),
counted AS (
  SELECT email_id, pos, w, count(*) AS n FROM words
  WHERE length(w) >= 3 AND w NOT IN ({words_sql(text.STOP_WORDS)}) GROUP BY ALL
), weighted AS (SELECT *, sum(n) OVER (PARTITION BY email_id, w) AS tf FROM counted),
scores AS (SELECT email_id, pos, cast(sum(n * tf) AS BIGINT) * 1000 // cast(sum(n) AS BIGINT) AS score
  FROM weighted GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY score DESC, pos) AS rank FROM scores),
best AS (SELECT email_id, {picked} FROM ranked GROUP BY email_id),
texts AS (SELECT l.email_id, {chosen} FROM lists l LEFT JOIN best b ON b.email_id = l.email_id)"""


BOTH = best_sentences(brief=enrich.BRIEF_SENTENCES, detailed=enrich.DETAILED_SENTENCES)

# Word lists that occur in the tables, so that every outcome occurs.
POSITIVE = ["bon", "dans", "thing", "para", "und", "with", *text.POSITIVE_WORDS]
NEGATIVE = text.NEGATIVE_WORDS


def sentiment_sql(positive, negative) -> str:
    return f"""
feelings AS (
  SELECT email_id, CASE WHEN p < n THEN -c ELSE c END / 10000.0 AS v FROM (
    SELECT email_id, p, n, abs(p - n) * 10000 // greatest(p + n, 1) AS c FROM (
      SELECT email_id, len([w for w in ws if w IN ({words_sql(positive)})]) AS p,
        len([w for w in ws if w IN ({words_sql(negative)})]) AS n
      FROM (SELECT email_id, regexp_extract_all(lower(email_body), '[a-z]+') AS ws
            FROM mails WHERE email_body IS NOT NULL)))
), moods AS (SELECT email_id, cast(cast(v AS DECIMAL(9, 4)) AS VARCHAR) AS sentiment FROM feelings)"""


ACTIONS = f"""
cues AS (
  SELECT email_id, [concat('- ', t) for t in [trim(x) for x in regexp_extract_all(email_body, '[^.!?\\n]+[.!?]*')]
    if regexp_matches(t, '(?i)(^|[^A-Za-z])({"|".join(text.ACTION_CUES)})([^A-Za-z]|$)')] AS items
  FROM mails WHERE email_body IS NOT NULL
), actions AS (
  SELECT email_id, CASE WHEN len(items) > 0 THEN array_to_string(items, chr(10))
    ELSE 'No action items found.' END AS action_items FROM cues
)"""

RULES = {
    **enrich.CLASS_RULES,
    "INFORMATIONAL": {"license": 3, "this": 1},
    "MEETING_REQUEST": {"der": 1, "und": 1},
    "SUPPORT": {"idiot": 4, "pathetic": 4, "stupid": 4},
    "PERSONAL": {"that": 1, "que": 1},
}


def class_sql(rules, body: str = "email_body") -> str:
    listed = ", ".join(
        f"('{w}', '{c}', {p}, {values.CLASSES.index(c)})"
        for c, weights in rules.items()
        for w, p in weights.items()
    )
    return f"""
rules(w, label, points, place) AS (VALUES {listed}),
found AS (
  SELECT email_id, unnest(regexp_extract_all(lower(concat(coalesce(subject, 'No Subject'), ' ', {body})), '[a-z]+')) AS w
  FROM mails WHERE email_body IS NOT NULL
), points AS (
  SELECT email_id, label, place, sum(points) AS total FROM found JOIN rules USING (w) GROUP BY ALL
), top AS (
  SELECT email_id, label FROM points
  QUALIFY row_number() OVER (PARTITION BY email_id ORDER BY total DESC, place) = 1
), classes AS (
  SELECT m.email_id, coalesce(t.label, 'OTHER') AS email_classification
  FROM mails m LEFT JOIN top t ON t.email_id = m.email_id WHERE m.email_body IS NOT NULL
)"""


GAZETTEER = {
    "people": ["Erhe", "Thre"],
    "companies": ["MIT", "GNU", "Creative Commons"],
    "locations": ["Reanwh", "Ndtion"],
}


def entities_sql(gazetteer) -> str:
    def joined(expression):
        return f"array_to_string(list_sort(list_distinct({expression})), '; ')"

    columns = []
    for kind in ["people", "companies", "dates", "locations", "amounts", "phone_numbers", "email_addresses"]:
        if kind in enrich.ENTITY_PATTERNS:
            e = f"regexp_extract_all(email_body, '{enrich.ENTITY_PATTERNS[kind]}')"
        else:
            e = (
                f"[x for x in [{words_sql(gazetteer[kind])}]"
                " if regexp_matches(email_body, concat('(^|[^A-Za-z])', x, '([^A-Za-z]|$)'))]"
            )
        columns.append(f"{joined(e)} AS {kind}")
    return (
        "entities AS (SELECT email_id, " + ", ".join(columns)
        + " FROM mails WHERE email_body IS NOT NULL)"
    )


def _entity_columns(column: str):
    return [
        F.array_join(f"{column}.{k}", "; ").alias(k)
        for k in ["people", "companies", "dates", "locations", "amounts", "phone_numbers", "email_addresses"]
    ]


@query(
    "summarize_brief",
    tb.sql(tb.BASE, tb.MAILS, BOTH, select="SELECT email_id, brief AS summary_text FROM texts"),
)
def summarize_brief(spark, sf):
    """Short extractive summary per mail."""
    return enrich.summary_texts(tb.mails(spark, sf), {"summary_text": enrich.BRIEF_SENTENCES})


@query(
    "summarize_detailed",
    tb.sql(tb.BASE, tb.MAILS, BOTH, select="SELECT email_id, detailed AS summary_text FROM texts"),
)
def summarize_detailed(spark, sf):
    """Long extractive summary per mail."""
    return enrich.summary_texts(tb.mails(spark, sf), {"summary_text": enrich.DETAILED_SENTENCES})


@query("action_items", tb.sql(tb.BASE, tb.MAILS, ACTIONS, select="SELECT * FROM actions"))
def action_items(spark, sf):
    """Sentences that ask for something."""
    return enrich.action_items(tb.mails(spark, sf))


@query(
    "sentiment",
    tb.sql(tb.BASE, tb.MAILS, sentiment_sql(POSITIVE, NEGATIVE), select="SELECT * FROM moods"),
)
def sentiment(spark, sf):
    """Balance of positive and negative words."""
    return enrich.sentiment(tb.mails(spark, sf), POSITIVE, NEGATIVE)


KINDS = ["brief", "Detailed", "ACTION_ITEMS", "sentiment", "haiku"]


@query(
    "summarize_dispatch",
    tb.sql(
        tb.BASE, tb.MAILS, BOTH, ACTIONS,
        sentiment_sql(text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
        select=f"""
SELECT m.email_id, CASE m.doc_id % 5 WHEN 0 THEN 'brief' WHEN 1 THEN 'Detailed' WHEN 2 THEN 'ACTION_ITEMS'
    WHEN 3 THEN 'sentiment' ELSE 'haiku' END AS kind,
  CASE m.doc_id % 5 WHEN 0 THEN t.brief WHEN 1 THEN t.detailed WHEN 2 THEN a.action_items
    WHEN 3 THEN s.sentiment ELSE '{enrich.UNKNOWN_KIND}' END AS summary_text
FROM mails m JOIN texts t USING (email_id) JOIN actions a USING (email_id) JOIN moods s USING (email_id)""",
    ),
)
def summarize_dispatch(spark, sf):
    """A summary kind per mail, one of them unknown."""
    mails = tb.mails(spark, sf)
    number = F.substring("email_id", 2, 20).cast("bigint")
    return enrich.summarize(mails, tb.pick(number % 5, KINDS))


@query(
    "classify_rules",
    tb.sql(tb.BASE, tb.MAILS, class_sql(RULES), select="SELECT * FROM classes"),
)
def classify_rules(spark, sf):
    """Class per mail from weighted words."""
    return enrich.classify_rules(tb.mails(spark, sf), RULES)


@query(
    "classify_realtime",
    tb.sql(
        tb.BASE, tb.MAILS, class_sql(RULES, "substring(email_body, 1, 500)"),
        select="SELECT * FROM classes",
    ),
)
def classify_realtime(spark, sf):
    """Realtime form: the class from the first 500 characters."""
    return enrich.classify_rules(tb.mails(spark, sf), RULES, values.CLASSIFY_CAP)


@query(
    "extract_entities",
    tb.sql(tb.BASE, tb.MAILS, entities_sql(GAZETTEER), select="SELECT * FROM entities"),
)
def extract_entities(spark, sf):
    """Seven kinds of entities per mail."""
    found = enrich.extract_entities(tb.mails(spark, sf), GAZETTEER)
    return found.select("email_id", *_entity_columns("extracted_entities"))


DEFAULT_NAMES = {k: sorted(v) for k, v in enrich.GAZETTEER.items()}


@query(
    "analyze",
    tb.sql(
        tb.BASE, tb.MAILS, BOTH, ACTIONS,
        sentiment_sql(text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
        class_sql(enrich.CLASS_RULES), entities_sql(DEFAULT_NAMES),
        select="""
SELECT t.email_id, brief, detailed, action_items, sentiment, email_classification, people, companies, dates,
  locations, amounts, phone_numbers, email_addresses
FROM texts t JOIN actions USING (email_id) JOIN moods USING (email_id) JOIN classes USING (email_id)
JOIN entities USING (email_id)""",
    ),
)
def analyze(spark, sf):
    """Full analysis of every mail."""
    done = enrich.analyze(tb.mails(spark, sf))
    return done.select("*", *_entity_columns("extracted_entities")).drop("extracted_entities")


ANALYZE_ROWS = """
SELECT email_id, summary_type, summary_text FROM (
  SELECT email_id, 'BRIEF' AS summary_type, brief AS summary_text FROM texts
  UNION ALL SELECT email_id, 'DETAILED', detailed FROM texts
  UNION ALL SELECT email_id, 'ACTION_ITEMS', action_items FROM actions
  UNION ALL SELECT email_id, 'SENTIMENT', sentiment FROM moods)"""


@query(
    "analyze_rows",
    tb.sql(
        tb.BASE, tb.MAILS, BOTH, ACTIONS,
        sentiment_sql(text.POSITIVE_WORDS, text.NEGATIVE_WORDS), select=ANALYZE_ROWS,
    ),
)
def analyze_rows(spark, sf):
    """The analysis as rows of the summary table."""
    tall = enrich.summary_rows(enrich.analyze(tb.mails(spark, sf)), enrich.FULL_COLUMNS)
    return tall.select("email_id", "summary_type", "summary_text")


REALTIME_CTES = [
    tb.BASE, tb.MAILS, BOTH, sentiment_sql(text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
    class_sql(enrich.CLASS_RULES),
]
REALTIME = """
SELECT t.email_id, brief, sentiment, email_classification
FROM texts t JOIN moods USING (email_id) JOIN classes USING (email_id)"""


@query("analyze_realtime", tb.sql(*REALTIME_CTES, select=REALTIME))
def analyze_realtime(spark, sf):
    """Realtime analysis of every mail."""
    return enrich.analyze_realtime(tb.mails(spark, sf))


@query(
    "pending_enrichment",
    tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, select="""
SELECT email_id, extracted_timestamp FROM mails m
WHERE email_body IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM summaries s WHERE s.email_id = m.email_id AND s.summary_type = 'BRIEF')
ORDER BY extracted_timestamp, email_id LIMIT 10"""),
)
def pending_enrichment(spark, sf):
    """The next ten mails without a BRIEF."""
    due = enrich.pending_enrichment(tb.mails(spark, sf), tb.summaries(spark, sf), limit=values.ENRICH_BATCH)
    return due.select("email_id", "extracted_timestamp")


@query(
    "pending_enrichment_by_status",
    tb.sql(tb.BASE, tb.RAW, tb.MAILS, tb.SUMMARIES, select="""
SELECT email_id, extracted_timestamp FROM mails m JOIN raw r USING (file_id)
WHERE email_body IS NOT NULL AND r.processing_status = 'PENDING' AND NOT EXISTS (
  SELECT 1 FROM summaries s WHERE s.email_id = m.email_id AND s.summary_type = 'BRIEF')"""),
)
def pending_enrichment_by_status(spark, sf):
    """Every mail without a BRIEF whose file is pending."""
    due = enrich.pending_enrichment(
        tb.mails(spark, sf), tb.summaries(spark, sf), values.PENDING, None, tb.raw(spark, sf)
    )
    return due.select("email_id", "extracted_timestamp")


@query(
    "estimate_tokens",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, cast(greatest(1, len(regexp_extract_all(email_body, '[^ \\n\\t\\r]+')) // 100) AS BIGINT) AS estimated_tokens
FROM mails WHERE email_body IS NOT NULL"""),
)
def estimate_tokens(spark, sf):
    """Model tokens per mail."""
    return enrich.estimate_tokens(tb.mails(spark, sf))


@query(
    "urgency_level",
    tb.sql(tb.BASE, tb.MAILS, select=f"""
SELECT email_id, CASE WHEN {URGENT} THEN 'HIGH'
  WHEN email_classification IN ('ACTION_REQUIRED', 'MEETING_REQUEST') THEN 'MEDIUM' ELSE 'LOW' END AS urgency_level
FROM mails"""),
)
def urgency_level(spark, sf):
    """HIGH, MEDIUM or LOW per mail."""
    return enrich.urgency_levels(tb.mails(spark, sf))


SEARCH = "license worthless tion und"
TERMS = search.query_terms(SEARCH)


def bm25_sql() -> str:
    counts = ", ".join(f"len([w for w in ws if w = '{t}']) AS tf{i}" for i, t in enumerate(TERMS))
    frequencies = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(TERMS)))
    parts = " + ".join(
        f"ln(1 + (n - df{i} + 0.5::DOUBLE) / (df{i} + 0.5::DOUBLE)) * tf{i} * 2.2::DOUBLE"
        f" / (tf{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))"
        for i in range(len(TERMS))
    )
    return f"""
tokens AS (
  SELECT email_id, regexp_extract_all(lower(concat(coalesce(subject, ''), ' ', email_body)), '[a-z]+') AS ws
  FROM mails WHERE email_body IS NOT NULL
), tfs AS (SELECT email_id, len(ws) AS dl, {counts} FROM tokens),
figures AS (SELECT count(*) AS n, avg(dl) AS avgdl, {frequencies} FROM tfs),
scored AS (SELECT email_id, round({parts}, 9) AS score FROM tfs, figures),
hits AS (SELECT * FROM scored ORDER BY score DESC, email_id LIMIT 10)"""


SEARCH_HITS = tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, bm25_sql(), select="""
SELECT m.email_id, m.subject, m.sender_email, m.email_date,
  round(h.score / (SELECT max(score) FROM hits), 6) AS relevance_score, s.summary_text AS brief_summary
FROM hits h JOIN mails m USING (email_id)
LEFT JOIN summaries s ON s.email_id = m.email_id AND s.summary_type = 'BRIEF'""")


@query(
    "search_mail",
    tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, bm25_sql(), select="""
SELECT m.email_id, m.subject, m.sender_email, m.email_date,
  round(h.score / (SELECT max(score) FROM hits), 6) AS relevance_score, s.summary_text AS brief_summary
FROM hits h JOIN mails m USING (email_id)
LEFT JOIN summaries s ON s.email_id = m.email_id AND s.summary_type = 'BRIEF'"""),
)
def search_mail(spark, sf):
    """The ten most relevant mails for a query."""
    return search.search_mail(tb.mails(spark, sf), tb.summaries(spark, sf), SEARCH)


@query("search_stored", SEARCH_HITS)
def search_stored(spark, sf):
    """The same search on a stored term table that two batches were added to."""
    mails, folder = tb.mails(spark, sf), work_dir(spark, "term-table")
    half = F.pmod(F.xxhash64("email_id"), F.lit(2))
    for batch in range(2):
        index.add_batch(mails.filter(half == batch), folder, batch, buckets=16)
    return index.search_stored(spark, folder, mails, tb.summaries(spark, sf), SEARCH, buckets=16)


@query(
    "search_vectors",
    """
WITH q AS (SELECT [cast(x AS DOUBLE) for x in embedding] AS v FROM embeddings WHERE vec_id = 1)
SELECT vec_id, round(list_cosine_similarity([cast(x AS DOUBLE) for x in embedding], v), 6) AS similarity
FROM embeddings, q WHERE vec_id <> 1 ORDER BY similarity DESC, vec_id LIMIT 10""",
)
def search_vectors(spark, sf):
    """The ten vectors nearest to vector 1."""
    return search.search_vectors(tb.table(spark, sf, "embeddings"), 1)


def length_scorer(prompts: pd.Series) -> pd.Series:
    """Stands in for a user's model: a label by length, an error for some."""
    if prompts.str.contains("idiot", regex=False).any():
        raise ValueError("refused")
    n = prompts.str.len()
    return n.map(lambda x: "LONG" if x > 1000 else "SHORT" if x < 200 else "MIDDLE")


@query(
    "score_with_model",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, CASE WHEN contains(email_body, 'idiot') THEN NULL WHEN length(email_body) + 6 > 1000 THEN 'LONG'
    WHEN length(email_body) + 6 < 200 THEN 'SHORT' END AS result,
  CASE WHEN contains(email_body, 'idiot') THEN 'ValueError: refused'
    WHEN length(email_body) + 6 BETWEEN 200 AND 1000 THEN 'answer not allowed' END AS error_message
FROM mails WHERE email_body IS NOT NULL"""),
)
def score_with_model(spark, sf):
    """A user's scorer over every mail, each distinct prompt once."""
    mails = tb.mails(spark, sf).filter(F.col("email_body").isNotNull())
    prompt = F.concat(F.lit("Text: "), F.col("email_body"))
    scored = model.score_with_model(mails, length_scorer, prompt, allowed=["LONG", "SHORT"])
    return scored.select("email_id", "result", "error_message")


@query(
    "score_stored",
    tb.sql(tb.BASE, tb.MAILS, select="""
SELECT email_id, CASE WHEN contains(email_body, 'idiot') THEN NULL WHEN length(email_body) + 6 > 1000 THEN 'LONG'
    WHEN length(email_body) + 6 < 200 THEN 'SHORT' END AS result,
  CASE WHEN contains(email_body, 'idiot') THEN 'ValueError: refused'
    WHEN length(email_body) + 6 BETWEEN 200 AND 1000 THEN 'answer not allowed' END AS error_message,
  CASE WHEN bool_or(doc_id % 2 = 0) OVER (PARTITION BY email_body) THEN '1' ELSE '2' END AS asked_in
FROM mails WHERE email_body IS NOT NULL"""),
)
def score_stored(spark, sf):
    """Answers kept by prompt: mails of even number first, then all of them; the second
    run asks only for the texts that the first has not met."""
    mails = tb.mails(spark, sf).filter(F.col("email_body").isNotNull())
    prompt, folder = F.concat(F.lit("Text: "), F.col("email_body")), work_dir(spark, "answers")
    even = mails.filter(F.substring("email_id", 2, 20).cast("bigint") % 2 == 0)
    for batch, rows in enumerate([even, mails], 1):
        scored = model.score_stored(rows, length_scorer, prompt, folder, batch, allowed=["LONG", "SHORT"])
    return scored.drop("prompt_hash")


BAYES = """
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS n FROM words GROUP BY ALL),
named AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'SUPPORT' ELSE 'INFORMATIONAL' END AS label FROM labels JOIN documents USING (doc_id)),
counts AS (SELECT label, w, sum(n) AS n FROM tf JOIN named USING (doc_id) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT w FROM counts),
classes AS (SELECT label, count(*) AS mails FROM named GROUP BY label),
totals AS (
  SELECT c.label, ln(mails / sum(mails) OVER ()) AS prior, coalesce(t.n, 0) + (SELECT count(*) FROM vocabulary) AS size
  FROM classes c LEFT JOIN (SELECT label, sum(n) AS n FROM counts GROUP BY label) t USING (label)),
parts AS (
  SELECT tf.doc_id, t.label, sum(tf.n * ln((coalesce(c.n, 0) + 1) / t.size)) AS part
  FROM tf JOIN vocabulary v ON v.w = tf.w JOIN totals t ON true LEFT JOIN counts c ON c.label = t.label AND c.w = tf.w GROUP BY ALL),
scores AS (
  SELECT d.doc_id, t.label, round(t.prior + coalesce(p.part, 0), 6) AS score
  FROM documents d JOIN totals t ON true LEFT JOIN parts p ON p.doc_id = d.doc_id AND p.label = t.label)
SELECT CAST(doc_id AS VARCHAR) AS email_id, label AS predicted FROM scores
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1"""


@query("train_classifier", BAYES)
def train_classifier(spark, sf):
    """Classes predicted for every document by a model trained on the labelled ones."""
    documents = tb.spread(tb.table(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").cast("string").alias("email_id"), "doc_id", "text"
    )
    labels = tb.table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "SUPPORT").otherwise("INFORMATIONAL").alias("label")
    )
    return model.predict(model.train_classifier(documents.join(labels, "doc_id")), documents)


@query(
    "urgent_predicate",
    tb.sql(tb.BASE, tb.MAILS, select=f"SELECT email_id, {URGENT} AS urgent FROM mails"),
)
def urgent_predicate(spark, sf):
    """Whether a mail is urgent."""
    urgent = urgency.is_urgent(F.col("subject"), F.col("email_body"))
    return tb.mails(spark, sf).select("email_id", urgent.alias("urgent"))


CODES = [
    f"CASE WHEN {column} ILIKE '{pattern}' THEN '{code}' END"
    for column, found in (("subject", values.SUBJECT_INDICATORS), ("email_body", values.BODY_INDICATORS))
    for pattern, code in found
]
INDICATORS = f"array_to_string([x for x in [{', '.join(CODES)}] if x IS NOT NULL], ',')"


@query(
    "urgency_indicators",
    tb.sql(tb.BASE, tb.MAILS, select=f"SELECT email_id, {INDICATORS} AS indicators FROM mails"),
)
def urgency_indicators(spark, sf):
    """Urgency codes of every mail."""
    codes = urgency.urgency_indicators(F.col("subject"), F.col("email_body"))
    return tb.mails(spark, sf).select("email_id", F.array_join(codes, ",").alias("indicators"))


ALERTS = f"""
SELECT email_id, subject, sender_email AS sender, {INDICATORS} AS urgency_indicators
FROM mails WHERE {URGENT}"""


@query("urgent_alerts", tb.sql(tb.BASE, tb.MAILS, select=ALERTS))
def urgent_alerts(spark, sf):
    """One row per urgent mail."""
    found = alerts.urgent_alerts(tb.mails(spark, sf))
    return found.withColumn("urgency_indicators", F.array_join("urgency_indicators", ","))


@query(
    "alert_log",
    tb.sql(tb.BASE, tb.MAILS, select=f"""
SELECT 'URGENT_ALERT' AS job_type, (SELECT t FROM now) AS start_time, 'COMPLETED' AS status,
  concat('{{"urgent_count":', count(*), '}}') AS error_details
FROM mails WHERE {URGENT} HAVING count(*) > 0"""),
)
def alert_log(spark, sf):
    """Job-log row with the number of urgent mails."""
    mails = tb.mails(spark, sf)
    at = mails.select(F.max("extracted_timestamp")).scalar()
    return alerts.alert_log(mails, at).drop("job_id")


@query(
    "urgent_recent",
    tb.sql(tb.BASE, tb.MAILS, tb.SUMMARIES, select=f"""
SELECT m.email_id, m.subject, m.sender_email, m.email_date, m.extracted_timestamp, s.summary_text AS brief_summary
FROM mails m JOIN now ON m.extracted_timestamp >= now.t - INTERVAL 7 DAY
LEFT JOIN summaries s ON s.email_id = m.email_id AND s.summary_type = 'BRIEF'
WHERE {URGENT}"""),
)
def urgent_recent(spark, sf):
    """Urgent mails of the last seven days with their BRIEF."""
    return alerts.urgent_recent(tb.mails(spark, sf), tb.summaries(spark, sf))
