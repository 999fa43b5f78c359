"""Streaming: replays, new files, gates."""

import json

from pyspark.sql import functions as F

from mailflow.catalog.ingest import write_files
from mailflow.operators import enrich
from mailflow.sources import landing
from mailflow.streaming import queries as st


def put(folder, name, mail):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(mail))


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_chain_takes_only_what_is_new(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    put(inbox, "1.json", {"email_text": "please answer asap", "subject": "a"})
    put(inbox, "2.json", [{"email_text": "b"}, {"raw_text": "c"}])
    (inbox / "3.json").write_text("{broken")
    first = counts(st.run_chain(spark, str(inbox), out))
    assert first == {"raw": 4, "mails": 4, "classes": 3, "summaries": 6, "alerts": 1, "jobs": 2, "files": 4, "invalid": 3, "unique": 3}
    assert counts(st.run_chain(spark, str(inbox), out)) == first
    put(inbox, "4.json", {"email_text": "an emergency"})
    second = counts(st.run_chain(spark, str(inbox), out))
    assert second == {"raw": 5, "mails": 5, "classes": 4, "summaries": 8, "alerts": 2, "jobs": 4, "files": 5, "invalid": 4, "unique": 4}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").cast("string").alias("x"))
    folder = str(tmp_path / "t")
    landing.write_batch(rows, folder, 7)
    landing.write_batch(rows.union(rows), folder, 7)
    landing.write_batch(rows, folder, 8)
    assert landing.read_table(spark, folder).count() == 10


def test_unfinished_batch_is_replaced(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").cast("string").alias("x"))
    folder = str(tmp_path / "t")
    landing.write_batch(rows, folder, 1)
    (tmp_path / "t" / "commits" / "1.json").unlink()
    landing.write_batch(rows.limit(2), folder, 1)
    assert landing.read_table(spark, folder).count() == 2


def test_job_status_of_a_batch_with_failures(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    put(inbox, "1.json", {"email_text": "fine"})
    (inbox / "2.json").write_text("{broken")
    tables = st.run_chain(spark, str(inbox), out)
    log = {r.job_type: r for r in tables["jobs"].collect()}
    assert log["REALTIME_PROCESSING"].status == "PARTIAL_FAILURE"
    assert (log["REALTIME_PROCESSING"].files_processed, log["REALTIME_PROCESSING"].files_failed) == (1, 1)
    assert log["REALTIME_AI_ANALYSIS"].status == "COMPLETED"
    assert log["REALTIME_PROCESSING"].start_time < log["REALTIME_PROCESSING"].end_time
    status = {r.file_name: r.processing_status for r in tables["files"].collect()}
    assert status == {"1.json": "COMPLETED", "2.json": "FAILED"}


def test_interval_trigger(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.json", {"email_text": "urgent"})
    from mailflow.operators import parse
    from mailflow.sources import files

    mails = parse.parse_mail(files.stream_raw_files(spark, str(inbox)))
    query = st.stream_alerts(mails, str(tmp_path / "a"), str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "a")).count() == 1
    finally:
        query.stop()


def test_dedupe_across_batches(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.sql(
        "SELECT CASE WHEN id < 9 THEN string(id % 3) END AS k, id % 2 AS x,"
        " timestamp_ntz'2024-01-01 00:00:00' AS at FROM range(12)"
    )
    for batch in range(3):
        rows.write.mode("append").parquet(folder)
    stream = st.folder_stream(spark, folder, rows.schema, 1)
    query = st.stream_dedupe(stream, ["k"], "at", str(tmp_path / "o"), str(tmp_path / "c"))
    st.finish(query)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5  # one entry per key
    kept = [(r.k or "", r.x if r.k is None else 0) for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    assert sorted(kept) == [("", 0), ("", 1), ("0", 0), ("1", 0), ("2", 0)]


def test_chain_on_an_empty_inbox(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    empty = counts(st.run_chain(spark, str(inbox), str(tmp_path / "out")))
    assert set(empty.values()) == {0}
    put(inbox, "1.json", {"email_text": "first"})
    assert counts(st.run_chain(spark, str(inbox), str(tmp_path / "out")))["classes"] == 1


def test_failed_commit_between_intervals(spark, tmp_path):
    raw = [("1", "a.json", '{"email_text": "first"}'), ("2", "b.json", '{"email_text": "urgent"}')]
    rows = spark.createDataFrame(raw, "file_id string, file_name string, file_text string").withColumn(
        "processing_status", F.lit("PENDING")
    ).withColumn("upload_timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    folder, out = str(tmp_path / "t"), str(tmp_path / "o")

    def work():
        st.finish(st.stream_parse(st.commits(spark, folder, rows.schema), f"{out}/m", f"{out}/j", f"{out}/c"))
        return sorted(r.file_id for r in landing.read_table(spark, f"{out}/m").collect())

    landing.write_batch(rows.filter("file_id = 1"), folder, 1)
    assert work() == ["1"]
    rows.filter("file_id = 2").write.parquet(f"{folder}/data/in_batch=2-broken")  # never committed
    assert work() == ["1"]
    landing.write_batch(rows.filter("file_id = 2"), folder, 2)
    assert work() == ["1", "2"]
    assert landing.read_table(spark, folder).count() == 2


def test_enrichment_failures_are_counted(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "fine"), ("2", None, "bad"), ("3", None, None)], "email_id string, subject string, email_body string")
    folder, out = str(tmp_path / "t"), str(tmp_path / "o")
    landing.write_batch(rows, folder, 0)

    def model(batch):
        done = enrich.analyze_realtime(batch)
        error = F.when(F.col("brief") == "bad", "refused")
        return done.withColumn("error_message", error)

    feed = st.commits(spark, folder, rows.schema)
    st.finish(st.stream_enrich(feed, f"{out}/s", f"{out}/k", f"{out}/j", f"{out}/c", analyse=model))
    log = landing.read_table(spark, f"{out}/j").first()
    assert (log.status, log.files_processed, log.files_failed) == ("PARTIAL_FAILURE", 1, 1)
    assert {r.email_id for r in landing.read_table(spark, f"{out}/s").collect()} == {"1"}


def test_a_run_without_new_files_adds_no_batch(spark, tmp_path):
    rows = spark.range(3).select(F.col("id").cast("string").alias("email_id"), F.lit("asap").alias("subject"), F.lit("b").alias("email_body"), F.lit("s").alias("sender_email"))
    folder, out = str(tmp_path / "t"), str(tmp_path / "o")
    landing.write_batch(rows, folder, 0)
    for wanted in (1, 0):
        query = st.stream_alerts(st.commits(spark, folder, rows.schema), f"{out}/a", f"{out}/c")
        st.finish(query)
        assert len(st.intervals(query)) == wanted
    assert landing.read_table(spark, f"{out}/a").count() == 3


def test_many_small_files_are_landed_by_few_tasks(spark, tmp_path):
    texts = [json.dumps({"email_text": f"mail {n}", "subject": "s"}) for n in range(599)]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[0]]], "value string")
    inbox = write_files(rows, str(tmp_path / "in"))
    files = [p.read_text() for p in (tmp_path / "in").glob("*.txt")]
    assert sorted(files) == sorted(t + "\n" for t in [*texts, texts[0]])
    before = dict(spark.conf.getAll)
    tables = st.run_chain(spark, inbox, str(tmp_path / "out"))
    assert tables["mails"].filter("status = 'COMPLETED'").select("email_id").distinct().count() == 600
    assert dict(spark.conf.getAll) == before
    assert len(list((tmp_path / "out" / "raw" / "data").rglob("*.parquet"))) <= 2 * spark.sparkContext.defaultParallelism
