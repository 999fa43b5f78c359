"""Stored search: an inverted term table that batches are added to.

``postings`` holds one row per mail and word (term, email_id, tf, dl), in one folder per
term bucket and sorted by term; ``figures`` holds each batch's number of mails and words.
A search opens the buckets of its own words only and, there, the row groups whose
range of terms holds them; no text is read but that of the mails found.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailflow.functions import text
from mailflow.operators import search
from mailflow.session import kept
from mailflow.sources import landing

BUCKETS = 256
POSTING = "term string, email_id string, tf int, dl int, bucket int"
SIZE = "mails bigint, words bigint"
MEMBER = "email_id string"


def bucket_of(term: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term.encode()) % buckets


def counted(mails: DataFrame) -> DataFrame:
    """Each mail with a body: its length in words and its distinct words.  Words are
    counted within the row: no shuffle."""
    full = F.concat_ws(" ", F.coalesce("subject", F.lit("")), "email_body")
    words = mails.filter(F.col("email_body").isNotNull()).select("email_id", text.words(full).alias("_w"))
    return words.select("email_id", F.size("_w").alias("dl"), text.term_counts(F.col("_w")).alias("terms"))


def postings(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per mail and word, from ``counted``."""
    rows = counts.select("email_id", "dl", F.explode("terms").alias("_t"))
    return rows.select("_t.term", "email_id", "_t.tf", "dl", (F.crc32("_t.term") % buckets).cast("int").alias("bucket"))


def add_batch(mails: DataFrame, index_dir: str, batch_id=0, buckets: int = BUCKETS, parts: int = 1) -> None:
    """Append the words of new mails; a batch that is complete is left as it is.

    The mails are read once, into a work table of their words.  ``parts`` files per bucket
    hold the batch, split by mail, so that a bucket with a very frequent word is written
    by several tasks.
    """
    if landing.committed(mails.sparkSession, f"{index_dir}/figures", batch_id) is not None:  # written last
        return
    counts = kept(counted(mails), "counted-words")
    split = F.pmod(F.xxhash64("email_id"), F.lit(parts))
    dealt = postings(counts, buckets).repartition(buckets * parts, "bucket", split).sortWithinPartitions("bucket", "term", "email_id")
    landing.write_batch(dealt, f"{index_dir}/postings", batch_id, partition_by=["bucket"])
    landing.write_batch(counts.select("email_id"), f"{index_dir}/members", batch_id)
    size = counts.agg(F.count("*").alias("mails"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words"))
    landing.write_batch(size, f"{index_dir}/figures", batch_id)


def scores(spark: SparkSession, index_dir: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """BM25 of the mails that hold a word of the query: (email_id, score).

    Only the query's postings are read and shuffled; the words' frequencies and the
    collection's figures are one small aggregate each.
    """
    terms = search.query_terms(query)
    stored = landing.read_table(spark, f"{index_dir}/postings", POSTING)
    wanted = stored.filter(F.col("bucket").isin([bucket_of(t, buckets) for t in terms]) & F.col("term").isin(terms))
    size = landing.read_table(spark, f"{index_dir}/figures", SIZE).agg(
        F.coalesce(F.sum("mails"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("w")
    )
    mails, words = size.first()
    if not terms or not mails:
        return spark.createDataFrame([], "email_id string, score double")
    common = dict(wanted.groupBy("term").count().collect())  # a row per word of the query
    frequency = F.lit(0.0)
    for term in terms:
        frequency = F.when(F.col("term") == term, float(common.get(term, 0))).otherwise(frequency)
    weight = F.log(1 + (mails - frequency + 0.5) / (frequency + 0.5))
    norm = search.K1 * (1 - search.B + search.B * F.col("dl") / max(words / mails, 1e-9))
    part = weight * F.col("tf") * (search.K1 + 1) / (F.col("tf") + norm)
    # Added up in the order of the query, so that equal mails get equal digits.
    ordered = [F.coalesce(F.sum(F.when(F.col("term") == t, F.col("_part"))), F.lit(0.0)) for t in terms]
    total = ordered[0]
    for part_sum in ordered[1:]:
        total = total + part_sum
    return wanted.withColumn("_part", part).groupBy("email_id").agg(F.round(total, 9).alias("score"))


def search_stored(
    spark: SparkSession, index_dir: str, mails: DataFrame, summaries: DataFrame, query: str, n: int = 10,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of ``search.search_mail``, by the term table: ``mails`` and ``summaries``
    are only asked for the ``n`` found.  With fewer than ``n`` hits other mails follow
    by id with score 0."""
    best = scores(spark, index_dir, query, buckets).orderBy(F.col("score").desc(), "email_id").limit(n)
    found = {r.email_id: r.score for r in best.collect()}  # n rows
    if len(found) < n:
        members = landing.read_table(spark, f"{index_dir}/members", MEMBER)
        rest = members.filter(~F.col("email_id").isin(list(found))).orderBy("email_id").limit(n - len(found))
        found |= {r.email_id: 0.0 for r in rest.collect()}
    best = spark.createDataFrame(list(found.items()), "email_id string, score double")
    return search.with_briefs(mails, summaries, best, n)
