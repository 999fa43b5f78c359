"""Models: a user's own scorer run in batches, and a trained classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from mailflow.functions import ids, text
from mailflow.operators.lookup import HOT_SHARE, attach
from mailflow.session import kept
from mailflow.sources import landing


def ask(
    prompts: DataFrame, scorer: Callable[[pd.Series], pd.Series], allowed: list[str] | None = None,
    carried: list[str] | None = None,
) -> DataFrame:
    """The scorer's answer or error for each row of (prompt_hash, prompt)."""
    carried = carried or []

    def one(prompt):
        try:
            return scorer(pd.Series([prompt])).iloc[0], None
        except Exception as error:  # reported in the row
            return None, f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                results = list(scorer(batch["prompt"]))
                pairs = [(r, None) for r in results]
            except Exception:  # find the row it belongs to
                pairs = [one(prompt) for prompt in batch["prompt"]]
            yield pd.DataFrame(
                {
                    "prompt_hash": batch["prompt_hash"].to_numpy(),
                    "result": [p[0] for p in pairs],
                    "error_message": [p[1] for p in pairs],
                    **{name: batch[name].to_numpy() for name in carried},
                }
            )

    more = "".join(f", {name} bigint" for name in carried)
    scored = prompts.select("prompt_hash", "prompt", *carried).mapInPandas(run, ANSWERS + more)
    return only_allowed(scored, allowed)


def only_allowed(scored: DataFrame, allowed: list[str] | None) -> DataFrame:
    """Turn an answer outside ``allowed`` into an error."""
    if allowed is None:
        return scored
    legal = F.col("result").isin(allowed)
    wrong = F.col("result").isNotNull() & ~legal
    error = F.when(wrong, "answer not allowed").otherwise(F.col("error_message"))
    return scored.withColumn("error_message", error).withColumn("result", F.when(legal, F.col("result")))


def score_with_model(
    mails: DataFrame, scorer: Callable[[pd.Series], pd.Series], prompt: Column,
    allowed: list[str] | None = None, known: DataFrame | None = None, max_chars: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Run a user's scorer over prompts, each distinct prompt once.

    ``scorer`` maps a batch of prompts to a batch of texts.  When a batch raises,
    its prompts are scored one by one, so an error stays with its own row.  An
    answer outside ``allowed`` is an error too.  ``known`` holds earlier results
    (prompt_hash, result); their prompts are not scored again.  ``max_chars``
    caps the prompt where the model has a limit; the default sends it whole.
    ``tasks`` sets how many tasks score: a slow model needs more than the size of
    the prompts alone would give.
    """
    asked = prompt if max_chars is None else F.substring(prompt, 1, max_chars)
    prompts = mails.select("email_id", asked.alias("prompt")).withColumn(
        "prompt_hash", ids.content_hash(F.col("prompt"))
    )
    if known is not None:
        known = known.groupBy("prompt_hash").agg(F.min("result").alias("result"))
    distinct = prompts.groupBy("prompt_hash").agg(
        F.first("prompt").alias("prompt"), F.count("*").alias("copies")
    )
    todo = distinct if known is None else distinct.join(known, "prompt_hash", "left_anti")
    if tasks is not None:
        todo = todo.repartition(tasks)

    scored = ask(todo, scorer, None, ["copies"])
    if known is not None:
        again = distinct.join(known, "prompt_hash").select(
            "prompt_hash", "copies", "result", F.lit(None).cast("string").alias("error_message")
        )
        scored = scored.unionByName(again)
    scored = only_allowed(scored, allowed)
    total = prompts.select(F.count("*")).scalar()
    hot = distinct.filter(F.col("copies") * HOT_SHARE > total).select("prompt_hash")
    return attach(
        prompts.drop("prompt"), scored.drop("copies"), ["prompt_hash"], spread_by="email_id", hot=hot
    ).select("email_id", "prompt_hash", "result", "error_message")


def train_classifier(labelled: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """A classifier for mails with known classes, as a table of counts.

    Rows are (label, word, n): how often the word occurs in mails of the label; the row
    without a word holds the number of the label's mails.  It is all that ``predict``,
    or a query, needs; tables of further mails can be added up with it.
    """
    known = labelled.filter(F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"),
        F.coalesce(text.words(F.col(text_col)), F.array()).alias("_w"),
    )
    # The row without a word is one more entry of each mail's own counts.
    entry = F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).alias("tf"))
    counts = F.concat(F.array(entry), F.coalesce(text.term_counts(F.col("_w")), F.array()))
    rows = known.select("label", F.explode(counts).alias("_t"))
    return rows.groupBy("label", F.col("_t.term").alias("word")).agg(F.sum("_t.tf").cast("bigint").alias("n"))


def predict(counts: DataFrame, mails: DataFrame, text_col: str = "text") -> DataFrame:
    """Predicted class per mail by naive Bayes over a table of counts.

    The score of a class is the log of its share of mails and, for every word of the
    mail that the table knows, the log of (n + 1) / (words of the class + words known).
    Scores are rounded to six decimals; of equal ones the first label wins.  Words are
    counted within a mail first; a mail's distinct words meet one row per known word.
    """
    counts = kept(counts, "word-counts")  # asked three times, and may be the training itself
    totals = counts.groupBy("label").agg(
        F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("mails"),
        F.coalesce(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))), F.lit(0)).alias("words"),
    )
    classes = sorted(totals.collect())  # a row per class
    vocabulary = counts.filter("word IS NOT NULL").select(F.count_distinct("word")).first()[0]
    if not classes:
        return mails.select("email_id", F.lit(None).cast("string").alias("predicted"))
    n = {label: F.sum(F.when(F.col("label") == label, F.col("n"))).alias(f"_n{i}") for i, (label, *_) in enumerate(classes)}
    known = counts.filter("word IS NOT NULL").groupBy("word").agg(*n.values())
    words = mails.select("email_id", F.explode_outer(text.term_counts(text.words(F.col(text_col)))).alias("_t"))
    met = words.select("email_id", F.col("_t.term").alias("word"), F.col("_t.tf").alias("tf")).join(known, "word", "left")
    every = sum(m for _, m, _ in classes)
    seen = F.coalesce(*[F.col(f"_n{i}") for i in range(len(classes))]).isNotNull()
    parts = []
    for i, (label, m, total) in enumerate(classes):
        log = F.log((F.coalesce(F.col(f"_n{i}"), F.lit(0)) + 1) / F.lit(float(total + vocabulary)))
        score = F.coalesce(F.sum(F.when(seen, F.col("tf") * log)), F.lit(0.0)) + F.log(F.lit(m / every))
        parts.append(F.struct(F.round(score, 6).alias("score"), F.lit(-i).alias("place"), F.lit(label).alias("label")))
    best = F.array_max(F.array(*parts))
    return met.groupBy("email_id").agg(best.alias("_best")).select("email_id", F.col("_best.label").alias("predicted"))


ANSWERS = "prompt_hash string, result string, error_message string"


def score_stored(
    mails: DataFrame, scorer: Callable[[pd.Series], pd.Series], prompt: Column, store_dir: str, batch_id,
    allowed: list[str] | None = None, retry: bool = False,
) -> DataFrame:
    """``score_with_model`` with the answers kept in a table by prompt hash.

    The mails' text is read once, into a work table; of it only hashes are counted and
    joined.  Prompts that the table has an answer for are not asked again (with
    ``retry`` those that failed are); new answers are committed as one batch, so a
    replayed batch asks nobody.  Returns email_id, prompt_hash, result, error_message and
    the batch the answer came with.
    """
    spark = mails.sparkSession
    landing.make_table(spark, store_dir)
    asked = mails.select("email_id", prompt.alias("prompt")).withColumn("prompt_hash", ids.content_hash(F.col("prompt")))
    asked = kept(asked, "prompts")
    stored = landing.read_table(spark, store_dir, f"{ANSWERS}, asked_in string")
    done = stored.filter(F.col("error_message").isNull()) if retry else stored
    fresh = asked.join(done.select("prompt_hash").distinct(), "prompt_hash", "left_anti")
    fresh = fresh.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
    answers = ask(fresh, scorer, allowed).withColumn("asked_in", F.lit(str(batch_id)))
    landing.write_batch(answers, store_dir, batch_id)
    stored = landing.read_table(spark, store_dir, answers.schema)
    # One answer per prompt: one without an error before others, then the earliest text.
    order = F.struct(F.col("error_message").isNotNull().alias("failed"), "result", "error_message", "asked_in")
    best = stored.groupBy("prompt_hash").agg(F.min(order).alias("_a"))
    best = best.select("prompt_hash", "_a.result", "_a.error_message", "_a.asked_in")
    return attach(asked.select("email_id", "prompt_hash"), best, ["prompt_hash"], spread_by="email_id")
