"""Operators against brute force, under skew, and their plans."""

import itertools
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from mailflow import values
from mailflow.catalog import testbed as tb
from mailflow.functions import text
from mailflow.operators import alerts, dedupe, enrich, lookup, model, search
from mailflow.plans import jobs, views
from mailflow.sources import pull

T0 = datetime(2024, 1, 1)


def mail_table(spark, bodies):
    rows = [
        (f"M{i:04d}", f"F{i}", f"u{i % 3}@example.com", f"subject {i}", body, T0 + timedelta(hours=i))
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(
        rows,
        "email_id string, file_id string, sender_email string, subject string, email_body string,"
        " email_date timestamp_ntz",
    ).withColumn("extracted_timestamp", F.col("email_date"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- lookups and duplicates under skew --------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, a tenth without a key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 != 1, F.concat(F.lit("k"), (n % 997).cast("string")))
    return spark.range(30000).select(n.cast("string").alias("row"), key.alias("key")).cache()


def test_attach_equals_a_left_join(spark, skewed):
    table = skewed.filter("key IS NOT NULL").groupBy("key").agg(F.max("row").alias("value"))
    table = table.filter("key <> 'k5'")
    ours = lookup.attach(skewed, table, ["key"], spread_by="row")
    plain = skewed.join(table, "key", "left")
    assert ours.count() == plain.count() == 30000
    assert ours.select("row", "key", "value").exceptAll(plain.select("row", "key", "value")).isEmpty()


def test_hot_keys_are_few_and_found(spark, skewed):
    hot = [r.key for r in lookup.hot_keys(skewed, ["key"]).collect()]
    assert "hot" in hot and len(hot) < lookup.HOT_SHARE


def test_latest_per_key_cuts_before_the_shuffle(spark, skewed):
    latest = dedupe.latest_per_key(skewed, ["key"], [F.col("row").desc()])
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    expected = skewed.groupBy("key").agg(F.max("row").alias("row"))
    assert latest.select("key", "row").exceptAll(expected.select("key", "row")).isEmpty()


@pytest.mark.parametrize("n", [3, 1500])
def test_first_per_key(spark, skewed, n):
    ours = dedupe.first_per_key(skewed, ["key"], ["row"], n, "row")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("row"))
    plain = skewed.withColumn("rn", rank).filter(f"rn <= {n} + 0 * hash(rn)").drop("rn")
    assert ours.count() == plain.count() and ours.exceptAll(plain).isEmpty()


def test_dedupe_keeps_the_earliest_and_is_idempotent(spark):
    mails = mail_table(spark, ["a b c", "x", "a b c", None, "x", None])
    once = dedupe.dedupe_exact(mails)
    assert sorted(r.email_id for r in once.collect()) == ["M0000", "M0001", "M0003", "M0005"]
    assert dedupe.dedupe_exact(once).count() == 4
    assert dedupe.dedupe_exact(mails.withColumn("message_id", F.lit(None)), ["message_id"]).count() == 6


def test_near_duplicates(spark):
    rows = [
        ("1", "Re: RE: Plan", "> Hello   there\n> all"), ("2", "plan", "hello there all"),
        ("3", "plan", "hello there ALL "), ("4", "plan", "hello there alle"),
    ]
    mails = spark.createDataFrame(rows, "email_id string, subject string, email_body string")
    found = dedupe.near_duplicates(mails).collect()
    assert sorted((r.email_id, r.first_id, r.copies) for r in found) == [
        ("1", "1", 3), ("2", "1", 3), ("3", "1", 3),
    ]


# --- enrichment -------------------------------------------------------------


def test_enrichment_is_a_projection(spark):
    mails = mail_table(spark, ["one. two."])
    for df in (enrich.analyze(mails), enrich.analyze_realtime(mails), enrich.summarize(mails, "BRIEF")):
        assert "Exchange" not in plan_of(df)
        assert "BatchEvalPython" not in plan_of(df)


sentence = st.lists(st.sampled_from(["alpha", "beta", "gamma", "the", "of", "delta"]), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(st.lists(sentence, min_size=1, max_size=6))
def test_best_sentences_by_brute_force(parts):
    whole = ". ".join(" ".join(p) for p in parts) + "."
    scored = [[w for w in p if len(w) >= 3 and w not in text.STOP_WORDS] for p in parts]
    tf = Counter(itertools.chain(*scored))
    score = {i: sum(tf[w] for w in p) * 1000 // len(p) for i, p in enumerate(scored) if p}
    expected = sorted(score, key=lambda i: (-score[i], i))[:3] or list(range(min(3, len(parts))))
    said = [" ".join(p) + "." for p in parts]
    made = text.summary_arrays(pa.array(["", whole, None]), [3], text.STOP_WORDS)[0].to_pylist()
    assert made == ["", " ".join(said[i] for i in sorted(expected)), None]


def test_summary_of_whole_long_text(spark):
    filler = " ".join(f"word{i}" for i in range(1))
    body = "\n".join([filler + f" line {chr(97 + i % 26) * 4}." for i in range(20000)])
    body += "\nkey key key key key."
    brief = enrich.summary_texts(mail_table(spark, [body]), {"brief": 1}).first().brief
    assert brief != ""


def test_summaries_of_odd_texts(spark):
    rows = enrich.summary_texts(
        mail_table(spark, ["", "...", "é à", "No end", None]), {"brief": 2}
    ).collect()
    assert [r.brief for r in rows] == ["", "", "é à", "No end"]


def test_sentiment_and_dispatch(spark):
    mails = mail_table(spark, ["good good bad", "nothing", "awful"]).withColumn(
        "kind", F.element_at(F.array(F.lit("Sentiment"), F.lit("verse"), F.lit(None)),
                             (F.substring("email_id", 2, 4).cast("int") + 1))
    )
    moods = [r.sentiment for r in enrich.sentiment(mails).collect()]
    assert moods == ["0.3333", "0.0000", "-1.0000"]
    kinds = [r.summary_text for r in enrich.summarize(mails, F.col("kind")).orderBy("email_id").collect()]
    assert kinds == ["0.3333", enrich.UNKNOWN_KIND, enrich.UNKNOWN_KIND]


def test_class_ties_go_by_class_order(spark):
    rules = {"SUPPORT": {"b": 2}, "URGENT": {"a": 1}, "MARKETING": {"c": 2}}
    mails = mail_table(spark, ["c b", "a a c", "none here", "a b"])
    got = [r.email_classification for r in enrich.classify_rules(mails, rules).orderBy("email_id").collect()]
    assert got == ["MARKETING", "URGENT", "OTHER", "SUPPORT"]


def test_entities(spark):
    body = (
        "John Smith of the Free Software Foundation met on 2024-05-06 and March 3, 2024 in Paris and Paris;"
        " cost $1,250.50 or €9. Call +49 30 1234 5678, write a.b@example.com. Parisian, MITRE."
    )
    found = enrich.extract_entities(mail_table(spark, [body])).first().extracted_entities
    assert found.people == ["John Smith"] and found.companies == ["Free Software Foundation"]
    assert found.dates == ["2024-05-06", "March 3, 2024"] and found.locations == ["Paris"]
    assert found.amounts == ["$1,250.50", "€9"] and found.email_addresses == ["a.b@example.com"]
    assert found.phone_numbers == ["+49 30 1234 5678"]


def test_pending_enrichment_uses_an_anti_join(spark):
    mails = mail_table(spark, ["a", "b", None, "d"])
    done = spark.createDataFrame([("M0000", "BRIEF"), ("M0001", "DETAILED")], "email_id string, summary_type string")
    due = enrich.pending_enrichment(mails, done, limit=5)
    assert "LeftAnti" in plan_of(due)
    assert [r.email_id for r in due.collect()] == ["M0001", "M0003"]


# --- models and search ------------------------------------------------------


def test_each_prompt_is_scored_once_and_errors_stay_in_their_row(spark):
    seen = spark.sparkContext.accumulator(0)
    mails = mail_table(spark, ["same"] * 50 + ["boom", "odd", "known"])

    def scorer(prompts: pd.Series) -> pd.Series:
        if (prompts == "boom").any():
            raise RuntimeError("no")
        seen.add(len(prompts))
        return prompts.map({"same": "YES", "odd": "MAYBE"})

    known = spark.createDataFrame([("known",)], "t string").select(
        F.sha2("t", 256).alias("prompt_hash"), F.lit("NO").alias("result")
    )
    scored = model.score_with_model(mails, scorer, F.col("email_body"), ["YES", "NO"], known)
    rows = {r.email_id: (r.result, r.error_message) for r in scored.collect()}
    assert len(rows) == 53
    assert all(rows[f"M{i:04d}"] == ("YES", None) for i in range(50))
    assert rows["M0050"] == (None, "RuntimeError: no")
    assert rows["M0051"] == (None, "answer not allowed") and rows["M0052"] == ("NO", None)
    assert seen.value <= 4


def test_answers_known_twice_give_one_row_a_mail(spark):
    mails = mail_table(spark, ["a", "b"])
    first = model.score_with_model(mails, lambda texts: texts.str.upper(), F.col("email_body"))
    known = first.select("prompt_hash", "result").filter("result = 'A'")
    again = model.score_with_model(
        mails, lambda texts: texts.str.upper(), F.col("email_body"), known=known.unionByName(known)
    )
    assert sorted(r.result for r in again.collect()) == ["A", "B"]


def test_classifier_learns_separable_classes(spark):
    bodies = [("invoice payment due" if i % 2 else "dinner with family") + f" n{i}" for i in range(60)]
    mails = mail_table(spark, bodies).withColumn("text", F.col("email_body"))
    labelled = mails.withColumn(
        "label", F.when(F.col("text").startswith("invoice"), "SUPPORT").otherwise("PERSONAL")
    )
    fitted = model.train_classifier(labelled)
    wrong = model.predict(fitted, mails).join(labelled, "email_id").filter("predicted <> label")
    assert wrong.count() == 0


def test_bm25_by_brute_force(spark):
    import math

    bodies = ["apple pie", "apple apple tart", "plum cake with cream", None, "pie pie pie"]
    mails = mail_table(spark, bodies)
    docs = {f"M{i:04d}": ["subject"] + b.split() for i, b in enumerate(bodies) if b}
    avg = sum(map(len, docs.values())) / len(docs)

    def score(words):
        total = 0.0
        for term in ("apple", "pie"):
            df = sum(term in d for d in docs.values())
            tf = words.count(term)
            idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
        return round(total, 9)

    got = {r.email_id: r.score for r in search.bm25(mails, "Apple PIE apple").collect()}
    assert got == pytest.approx({k: score(v) for k, v in docs.items()}, abs=1e-8)


def test_search_without_words_or_hits(spark):
    mails = mail_table(spark, ["a", "b"])
    none = spark.createDataFrame([], "email_id string, summary_type string, summary_text string")
    for query in ("??", "zebra"):
        rows = search.search_mail(mails, none, query, 5).collect()
        assert [(r.email_id, r.relevance_score) for r in rows] == [("M0000", 0.0), ("M0001", 0.0)]


# --- alerts, pulls, views, jobs ---------------------------------------------


def test_alert_may_have_no_indicator(spark):
    mails = mail_table(spark, ["an Emergency", "immediate reply", "calm", None])
    found = {r.email_id: r.urgency_indicators for r in alerts.urgent_alerts(mails).collect()}
    assert found == {"M0000": ["EMERGENCY_CONTENT"], "M0001": []}
    at = F.lit(T0).cast("timestamp_ntz")
    assert alerts.alert_log(mails, at).first().error_details == '{"urgent_count":2}'
    assert alerts.alert_log(mails.filter("email_body = 'calm'"), at).isEmpty()


def test_incremental_pull_goes_on_where_it_stopped(spark):
    mails = mail_table(spark, [f"b{i}" for i in range(20)]).withColumn(
        "sender_email", F.concat(F.lit("x <a@"), F.element_at(F.array(F.lit("one.org"), F.lit("two.org")),
                                 (F.substring("email_id", 2, 4).cast("int") % 2 + 1)), F.lit(">"))
    )
    done, seen = mails.limit(0), defaultdict(list)
    for _ in range(5):
        batch = pull.incremental_since(mails, done, as_of=T0 + timedelta(hours=5), limit=3).drop("domain")
        ids = [r.email_id for r in batch.collect()]
        assert len(ids) <= 6
        done = mails.join(batch.select("email_id"), "email_id", "left_semi").unionByName(done)
        for i in ids:
            seen[i].append(1)
    assert len(seen) == 20 and all(len(v) == 1 for v in seen.values())


def test_pulls_of_equal_times_undated_and_senderless_mails_lose_nothing(spark):
    mails = mail_table(spark, [f"b{i}" for i in range(24)])
    number = F.substring("email_id", 2, 4).cast("int")
    mails = mails.withColumn("email_date", F.when(number % 4 != 3, F.lit(T0).cast("timestamp_ntz"))).withColumn(
        "sender_email", F.when(number % 3 != 2, F.lit("x@one.org"))
    )
    done, seen = mails.limit(0), []
    for _ in range(6):
        ids = [r.email_id for r in pull.incremental_since(mails, done, limit=5).collect()]
        seen += ids
        done = mails.filter(F.col("email_id").isin(seen))
    assert sorted(seen) == [r.email_id for r in mails.orderBy("email_id").collect()]
    assert pull.incremental_since(mails, done).isEmpty()


def test_a_missing_key_equals_nothing(spark):
    mails = mail_table(spark, ["one", "two", "three"]).withColumn("sender_email", F.lit("x@one.org"))
    mails = mails.withColumn("subject", F.lit(None).cast("string"))
    assert dedupe.dedupe_exact(mails, ["sender_email", "subject"]).count() == 3
    assert dedupe.dedupe_exact(mails, ["sender_email"]).count() == 1


def test_vector_search_needs_a_stored_vector(spark):
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>"
    )
    assert search.search_vectors(vectors, 9).isEmpty()
    assert [r.vec_id for r in search.search_vectors(vectors, 1).collect()] == [2]


def test_domain_filter(spark):
    mails = mail_table(spark, ["a"] * 3)
    assert pull.filter_domain(mails, "all").count() == 3
    assert pull.filter_domain(mails, ["EXAMPLE.com"]).count() == 3
    assert pull.filter_domain(mails, ["ample.com"]).count() == 0


def test_empty_tables(spark):
    raw = spark.createDataFrame(
        [], "file_id string, file_name string, upload_timestamp timestamp_ntz, file_text string,"
        " processing_status string, error_message string"
    ).withColumn("file_content", F.try_parse_json("file_text"))
    log = spark.createDataFrame(
        [], "job_id string, job_type string, start_time timestamp_ntz, end_time timestamp_ntz,"
        " status string, files_processed bigint, files_failed bigint, error_details string"
    )
    stats = views.processing_stats(raw).first()
    assert stats.total_raw_files == 0 and stats.processing_success_rate is None
    errors = views.recent_errors(raw, log).collect()
    assert [(r.error_category, r.error_count, r.error_messages) for r in errors] == [
        (values.ERRORS_FILES, 0, None), (values.ERRORS_JOBS, 0, None),
    ]
    assert views.format_distribution(raw).count() == 0
    assert jobs.basic_health(log).first().health_message.startswith("WARNING")
    assert jobs.threshold_breaches(log, raw).count() == 0


def test_failures_come_first_in_the_health_label(spark):
    def label(uploads, failures):
        row = spark.range(1).select(
            F.lit(uploads).alias("files_uploaded_24h"), F.lit(failures).alias("failed_files_24h"),
            F.lit(T0).cast("timestamp_ntz").alias("last_check_time"),
        )
        return views.health_label(row).first().error_details

    assert label(10, 6) == '{"status":"ISSUES_DETECTED"}'
    assert label(10, 5) == '{"status":"ACTIVE"}' and label(0, 0) == '{"status":"IDLE"}'


def test_time_filter_reaches_the_scan(spark, sf):
    raw = tb.table(spark, sf, "events").withColumnRenamed("ts", "upload_timestamp").selectExpr(
        "upload_timestamp", "event_type AS processing_status", "event_type AS file_name"
    )
    plan = plan_of(views.source_sync_health(raw, "x%", as_of=T0))
    assert "GreaterThanOrEqual(ts" in plan and "StartsWith(event_type,x)" in plan


def test_key_violations_counts_rows(spark):
    raw = spark.createDataFrame([("F1",), ("F1",), ("F2",)], "file_id string")
    mails = spark.createDataFrame([("M1", "F1"), ("M2", "F9")], "email_id string, file_id string")
    sums = spark.createDataFrame([("S1", "M1"), ("S2", "M7")], "summary_id string, email_id string")
    log = spark.createDataFrame([("J1",)], "job_id string")
    got = {(r.key, r.rule): r.violations for r in views.key_violations(raw, mails, sums, log).collect()}
    assert got[("raw_email_files.file_id", "unique")] == 2
    assert got[("processed_emails.file_id", "reference")] == 1
    assert got[("email_summaries.email_id", "reference")] == 1
    assert sum(got.values()) == 4


def test_times_do_not_depend_on_the_machine(spark):
    from datetime import timezone

    from mailflow.clock import moment

    given = [T0, T0.replace(tzinfo=timezone(timedelta(hours=-5))), "2024-01-01 00:00:00", F.lit(T0.isoformat())]
    row = spark.range(1).select(*[moment(g).alias(f"t{i}") for i, g in enumerate(given)]).first()
    assert list(row) == [T0, T0 + timedelta(hours=5), T0, T0]


def test_store_in_sql_on_declared_schemas(spark):
    from mailflow.plans import store

    names = store.register(spark, *store.empty_tables(spark))
    rows = {n: spark.sql(f"SELECT count(*) FROM {n}").first()[0] for n in names}
    always = {"email_processing_stats": 1, "simple_system_health": 1, "recent_errors": 2, "pipeline_status": 3}
    assert rows == {n: always.get(n, 0) for n in names}
    assert spark.sql("SELECT system_status FROM simple_system_health").first()[0] == "IDLE"
