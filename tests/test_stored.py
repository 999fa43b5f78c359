"""What is kept between runs: term table, answers, job log; and what SQL users call."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mailflow.catalog import testbed
from mailflow.functions import text
from mailflow.operators import dedupe, enrich, index, model, search, similar
from mailflow.plans import functions, jobs

MAIL = "email_id string, subject string, email_body string, sender_email string, email_date timestamp_ntz"


def mails_of(spark, bodies, subject="subject"):
    rows = [(f"M{i:04d}", subject, b, "a@b.example", datetime(2024, 1, 1) + timedelta(hours=i)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, MAIL)


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- stored search --------------------------------------------------------------

BODIES = ["apple pie", "Apple apple tart", "plum cake", None, "", "pie pie", "ÄPFEL x", "1 2 3", "the pie of apples"] * 3
NO_BRIEF = "email_id string, summary_type string, summary_text string"


@pytest.mark.parametrize("query", ["apple pie", "pie", "nothing here", "", "APPLE plum subject"])
def test_stored_search_equals_search(spark, tmp_path, query):
    mails, none = mails_of(spark, BODIES), spark.createDataFrame([], NO_BRIEF)
    folder = str(tmp_path / "i")
    for batch, cond in enumerate(["email_id < 'M0010'", "email_id >= 'M0010' AND email_id < 'M0011'", "email_id >= 'M0011'"]):
        index.add_batch(mails.filter(cond), folder, batch, buckets=7, parts=2)
    index.add_batch(mails, folder, 1, buckets=7)  # a replay changes nothing
    got = index.search_stored(spark, folder, mails, none, query, n=8, buckets=7).collect()
    assert got == search.search_mail(mails, none, query, n=8).collect()


def test_stored_search_of_nothing(spark, tmp_path):
    mails, none, folder = mails_of(spark, []), spark.createDataFrame([], NO_BRIEF), str(tmp_path / "i")
    index.add_batch(mails, folder, 0)
    assert index.search_stored(spark, folder, mails, none, "pie").count() == 0


def test_search_reads_its_own_words_only(spark, tmp_path):
    folder = str(tmp_path / "i")
    index.add_batch(mails_of(spark, BODIES), folder, 0, buckets=7)
    plan = plan_of(index.scores(spark, folder, "apple pie", buckets=7))
    assert "PartitionFilters: [bucket" in plan and "In(term, [apple,pie])" in plan


# --- alike mails ----------------------------------------------------------------


def brute_groups(forms, threshold, words=5):
    sets = {}
    for k, form in forms.items():
        w = form.split(" ")
        sets[k] = {tuple(w[i : i + words]) for i in range(max(len(w) - words, 0) + 1)}
    label = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    return {k: v for k, v in label.items() if list(label.values()).count(v) > 1}


@pytest.mark.parametrize("threshold", [0.75, 0.9])
def test_similar_mails_by_brute_force(spark, threshold):
    rng = random.Random(4)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 30, 80]))] for _ in range(12)]
    bodies = []
    for w in base:
        for _ in range(rng.randint(1, 6)):
            copy = list(w)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            bodies.append(" ".join(copy))
    bodies += ["", None, "A  b\nc", "> a b C"]
    mails = mails_of(spark, bodies)
    forms = {r.email_id: r.f for r in mails.select("email_id", dedupe.normal_form(F.col("subject"), F.col("email_body")).alias("f")).collect()}
    wanted = brute_groups({k: v for k, v in forms.items() if v}, threshold)
    got = {r.email_id: (r.first_id, r.copies) for r in dedupe.near_duplicates(mails, threshold).collect()}
    assert {k: v for k, (v, _) in got.items()} == wanted
    assert all(n == list(wanted.values()).count(first) for first, n in got.values())


def test_components_of_a_long_chain(spark):
    edges = [(f"n{i:03d}", f"n{i - 1:03d}") for i in range(1, 120)] + [("z2", "z1")]
    random.Random(1).shuffle(edges)
    got = dict(similar.components(spark.createDataFrame(edges, "id string, first string")).collect())
    assert got == {f"n{i:03d}": "n000" for i in range(120)} | {"z1": "z1", "z2": "z1"}


def test_no_similar_mails(spark):
    assert dedupe.near_duplicates(mails_of(spark, []), 0.75).count() == 0
    assert dedupe.near_duplicates(mails_of(spark, ["one two three four five six", "other words are in here now"]), 0.75).count() == 0


# --- classifier -----------------------------------------------------------------


def test_counts_of_two_batches_add_up(spark):
    rows = spark.createDataFrame([("A", "x y x"), ("B", "y z"), ("A", ""), (None, "x")], "label string, text string")
    whole = model.train_classifier(rows)
    halves = model.train_classifier(rows.filter("text = 'y z'")).unionByName(model.train_classifier(rows.filter("text <> 'y z'")))
    summed = halves.groupBy("label", "word").agg(F.sum("n").alias("n"))
    assert set(map(tuple, whole.collect())) == set(map(tuple, summed.collect())) == {
        ("A", None, 2), ("A", "x", 2), ("A", "y", 1), ("B", None, 1), ("B", "y", 1), ("B", "z", 1)
    }
    mails = spark.createDataFrame([("1", "x"), ("2", "z z"), ("3", None), ("4", "unseen")], "email_id string, text string")
    assert dict(model.predict(whole, mails).collect()) == {"1": "A", "2": "B", "3": "A", "4": "A"}
    nothing = model.train_classifier(rows.limit(0))
    assert {r.predicted for r in model.predict(nothing, mails).collect()} == {None}


# --- answers by prompt ----------------------------------------------------------


def test_answers_are_kept(spark, tmp_path):
    asked, folder = spark.sparkContext.accumulator(0), str(tmp_path / "s")

    def scorer(prompts: pd.Series) -> pd.Series:
        asked.add(len(prompts))
        if (prompts == "bad").any():
            raise ValueError("no")
        return prompts.str.upper()

    def run(bodies, batch, **more):
        rows = model.score_stored(mails_of(spark, bodies), scorer, F.col("email_body"), folder, batch, **more).collect()
        return sorted((r.email_id, r.result, r.error_message, r.asked_in) for r in rows)

    first = run(["a", "a", "b"], 1)
    assert first == [("M0000", "A", None, "1"), ("M0001", "A", None, "1"), ("M0002", "B", None, "1")] and asked.value == 2
    assert run(["a", "c", "bad"], 2) == [("M0000", "A", None, "1"), ("M0001", "C", None, "2"), ("M0002", None, "ValueError: no", "2")]
    before = asked.value
    run(["a", "c", "bad"], 2)  # the batch is there already
    run(["a", "c", "bad"], 3)  # and so are all answers
    assert asked.value == before
    run(["bad"], 4, retry=True)
    assert asked.value > before


# --- job log by day -------------------------------------------------------------

RUN = "job_id string, job_type string, start_time timestamp_ntz, status string"


def log_rows(spark, hours):
    end = datetime(2024, 3, 31, 12)
    return spark.createDataFrame([(f"J{h}", "X", end - timedelta(hours=h), "COMPLETED") for h in hours], RUN)


def test_retention_drops_whole_days(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = log_rows(spark, range(0, 24 * 40, 7))
    jobs.append_log(rows, folder)
    kept_files = {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    dropped = jobs.retain(spark, folder, rows.schema, 30)
    assert dropped and max(dropped) == "2024-02-29"
    left = {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    assert {p for p in kept_files if p not in left} == {p for p in kept_files if p.parent.name.split("=")[1] in dropped}
    assert all(left[p] == kept_files[p] for p in left if p in kept_files)  # untouched
    read = {r.job_id for r in jobs.read_log(spark, folder, rows.schema, 30).collect()}
    wanted = {r.job_id for r in rows.filter("start_time >= timestamp_ntz'2024-03-01 12:00:00'").collect()}
    assert read - wanted == {"MAINTENANCE_2024-03-31 12:00:00"} and wanted <= read
    assert jobs.retain(spark, folder, rows.schema, 30) == []


def test_the_log_is_pruned_by_day(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = log_rows(spark, range(0, 24 * 40, 24))
    jobs.append_log(rows, folder)
    plan = plan_of(jobs.read_log(spark, folder, rows.schema, 2))
    assert "PartitionFilters: [isnotnull(start_day" in plan and "start_time" in plan
    assert jobs.read_log(spark, folder, rows.schema, None).count() == 40


# --- SQL functions --------------------------------------------------------------


def test_sql_functions_equal_the_operators(spark):
    bodies = [
        None, "", "...", "Please pay $5 by 2024-01-02. Thanks! It's \"great\"\\n.", "URGENT: meeting with John Smith in Paris, asap",
        "terrible bug\nplease help: call +1 555-123-4567 or mail x@y.org", "é" * 50,
    ]
    mails = mails_of(spark, bodies)
    mails.createOrReplaceTempView("processed_emails")
    spark.createDataFrame([("M0004", "BRIEF", "short")], NO_BRIEF).createOrReplaceTempView("email_summaries")
    names = functions.create(spark)
    assert set(names) >= {"summarize_email", "classify_email", "extract_email_entities", "search_emails"}
    called = spark.sql("""
        SELECT email_id, summarize_email(email_body, 'Brief') AS brief, summarize_email(email_body, 'detailed') AS detailed,
          summarize_email(email_body, 'action_items') AS action_items, summarize_email(email_body, 'SENTIMENT') AS sentiment,
          classify_email(email_body, subject) AS email_classification, extract_email_entities(email_body) AS extracted_entities
        FROM processed_emails""")
    got = {r.email_id: r for r in called.collect()}
    wanted = {r.email_id: r for r in enrich.analyze(mails).collect()}
    assert len(got) == len(bodies) and len(wanted) == len(bodies) - 1
    assert all(got[k] == v for k, v in wanted.items())
    assert got["M0000"].email_classification is None and got["M0000"].brief is None
    assert spark.sql("SELECT summarize_email('x', 'poem')").first()[0] == enrich.UNKNOWN_KIND
    summaries = spark.table("email_summaries")
    for query in ("meeting asap", "please", "nowhere", ""):
        rows = sorted(spark.sql(f"SELECT * FROM search_emails('{query}', 3)").collect(), key=lambda r: (-r.relevance_score, r.email_id))
        assert rows == search.search_mail(mails, summaries, query, 3).collect(), query


def test_word_counts_in_a_row(spark):
    got = spark.sql("SELECT array('b','a','b') AS w UNION ALL SELECT array() UNION ALL SELECT NULL")
    rows = got.select(text.term_counts(F.col("w")).alias("c")).collect()
    assert [(c.term, c.tf) for c in rows[0].c] == [("a", 1), ("b", 2)]
    assert rows[1].c is None and rows[2].c is None


def met(spark, mails):
    """The mails, and a counter of the rows of them that were read."""
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(len(batch))
            yield batch

    return mails.mapInPandas(count, mails.schema), counter


def test_index_reads_mails_once(spark, tmp_path):
    rows = [("1", "a", "b c"), ("2", None, "c"), ("3", "x", None), ("4", "", "")]
    mails, counter = met(spark, spark.createDataFrame(rows, "email_id string, subject string, email_body string"))
    index.add_batch(mails, str(tmp_path / "i"), 0)
    assert counter.value == 4
    index.add_batch(mails, str(tmp_path / "i"), 0)  # complete: left as it is
    assert counter.value == 4


def test_prediction_trains_once(spark):
    labelled, counter = met(spark, spark.createDataFrame([("A", "x y"), ("B", "z")], "label string, text string"))
    mails = spark.createDataFrame([("1", "x"), ("2", "z z"), ("3", None)], "email_id string, text string")
    got = {r.email_id: r.predicted for r in model.predict(model.train_classifier(labelled), mails).collect()}
    assert got == {"1": "A", "2": "B", "3": "A"} and counter.value == 2


def test_subjects_and_briefs_shuffle_no_texts(spark, sf):
    for rows in (testbed.mails(spark, sf).select("email_id", "subject"), testbed.summaries(spark, sf)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join ")
        assert "substring(text" not in plan[:join] and "substring(text" in plan[join:]


def test_pairs_move_the_texts_they_name_only(spark):
    rows = spark.range(5000).select(F.format_string("m%05d", "id").alias("id"), F.lit("x").alias("form"))
    ids = rows.where("id < 'm00040'").select("id")
    kept = {r.id for r in similar.among(rows, ids).collect()}
    assert {f"m{n:05d}" for n in range(40)} <= kept and len(kept) < 60
    assert similar.among(rows, ids.limit(0)).count() == 0


def test_links_are_those_of_all_pairs(spark):
    texts = {f"t{n:02d}": [f"w{n // 3}x{k}" for k in range(40)] for n in range(30)}
    for n, words in enumerate(texts.values()):
        words[n % 7 * 5] += "y" * (n % 3)
    texts["u"], texts["v"], texts["w"] = ["one", "two"], ["one", "two", "three"], ["one", "two"]

    def runs(words):
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}

    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "id string, form string")
    got = {(r.id, r.first): r.similarity for r in similar.links(rows, 0.6).collect()}
    for (one, two), alike in got.items():
        a, b = runs(texts[one]), runs(texts[two])
        assert alike == len(a & b) / len(a | b) >= 0.6
    # each meets the first of its kind, as the second and third of ten kinds, and the two equal short texts
    assert {one for one, _ in got} >= {i for n, i in enumerate(list(texts)[:30]) if n % 3} | {"w"}
    assert not {"v"} & {x for pair in got for x in pair}


def one_text(n, changes, of=220):
    """``of`` words of one text with every so many of them replaced by words of its own."""
    words = [f"b{k}" for k in range(of)]
    for k in range(changes):
        words[(n * 7 + k * of // max(changes, 1)) % of] = f"own{n}x{k}"
    return " ".join(words)


def test_alike_mails_behind_many_others_are_found(spark):
    """The last two are alike, but all their bands begin with more mails unlike them than there are rounds."""
    bodies = [one_text(n, 8) for n in range(90)] + [one_text(900, 3), one_text(901, 0)]
    mails = mails_of(spark, bodies)
    got = {(r.email_id, r.first_id, r.copies) for r in dedupe.near_duplicates(mails, 0.75).collect()}
    assert got == {("M0090", "M0090", 2), ("M0091", "M0090", 2)}


@pytest.mark.parametrize("again", [False, True])
def test_rare_shingles_find_all_links_alone(spark, monkeypatch, again):
    """Without any group to begin with, and with an order that is made again."""
    if again:
        monkeypatch.setattr(similar, "PAIRS", 0)
        monkeypatch.setattr(similar, "CROWD", 2)
    rng = random.Random(7)
    texts = [one_text(rng.randrange(10**6), rng.choice([0, 2, 3, 4, 5, 6, 8]), rng.choice([60, 75, 90])) for _ in range(60)]
    texts += [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([2, 5, 6, 40]))) for _ in range(20)]
    texts += ["a a a a a", "a a a a a a", "a a a a a a a b", "a b", "b a"]
    forms = {f"t{n:03d}": form for n, form in enumerate(dict.fromkeys(texts))}
    rows = spark.createDataFrame(list(forms.items()), "id string, form string")
    none = (similar.np.zeros(0, "uint64"), similar.np.zeros(0, "int64"))
    order = none if again else similar.sampled(rows, 5, 1)
    keys = similar.signatures(rows, 0.75, 5, order, bands=0)
    alone = spark.createDataFrame([], "id string, first_id string")
    got = {r.id: r.first_id for r in similar.joined(rows, keys, alone, order, 0.75, 5).collect()}
    wanted = brute_groups(forms, 0.75)
    assert got == wanted and len(set(wanted.values())) > 1
