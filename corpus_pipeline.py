"""The corpus pipeline: each stage works on all that the one before it kept.

Stages take (spark, docs, sf_dir) and give a DataFrame, which is written as Parquet and
read again as the next one's ``docs``.  All but the last give the columns of documents,
others that ``docs`` has among them.  Rows are told apart by doc_id and, without one, by
their text; rows equal in both are one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mailflow.llm import jaccard, linechunks, mixing, packing, toxicity
from mailflow.llm.queries import vocabulary
from mailflow.llm.store import passing, stored, table
from mailflow.session import prepare


def recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns)


def row_key() -> Column:
    """A number for each row: its doc_id, else one beyond all of these by its text."""
    by_text = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2)
    return F.coalesce(F.col("doc_id").cast("long"), by_text)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field rejects go, every row by its own text."""
    labels = table(spark, sf_dir, "labels")
    field = toxicity.learn(docs, labels, "doc_id", "text", "toxic")
    own = F.xxhash64("doc_id", "text")
    scored = toxicity.score_toxicity(docs.select(own.alias("_own"), "text"), field, "_own", "text")
    bad = stored(scored.where("predicted = 1").select(F.col("doc_id").alias("_bad")).distinct(), "toxic")
    return docs.join(bad, own == F.col("_bad"), "left_anti")


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the chunks of lines that an earlier document has."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    return recounted(linechunks.drop_chunks(docs, "doc_id", "text", keep=others), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id;
    rows without one stay only where no row of their group has one."""
    with passing(spark):
        found = jaccard.jaccard_components(docs.select(row_key().alias("_key"), "text"), "_key", "text")
        found = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_copy")).distinct()
        copies = stored(found, "copies", stays=True)
    left = docs.join(copies, row_key() == F.col("_copy"), "left_anti")
    # rows that repeat key and text are few, and only these are shuffled
    pair = F.struct(row_key().alias("k"), F.xxhash64("text").alias("h"))
    twice = stored(docs.groupBy(pair.alias("_pair")).agg(F.count("*").alias("_n")).where("_n > 1").select("_pair"), "twice")
    once = left.join(twice, pair == F.col("_pair"), "left_anti")
    again = left.join(twice, pair == F.col("_pair"), "left_semi")
    return once.unionByName(again.withColumn("_pair", pair).dropDuplicates(["_pair"]).drop("_pair"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    keyed = docs.withColumn("_key", row_key())
    with passing(spark):
        mixed = mixing.mix(keyed.select("_key", "text", "source"), "_key", "text", "source", [3, 1, 2])
        nth = F.row_number().over(Window.partitionBy("_id").orderBy("_size"))
        taken = mixed.where("copies > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "copies")
        taken = taken.withColumn("_nth", nth).select("_id", "_nth", F.col("copies").alias("_copies"))
        taken = stored(taken, "taken", stays=True).hint("merge")  # at any size alike, not broadcast to small texts
    # rows that share a key are few, and only these are numbered, by length and text
    twice = stored(keyed.groupBy(F.col("_key").alias("_twice")).agg(F.count("*").alias("_n")).where("_n > 1").select("_twice"), "twice")
    repeats = F.col("_key") == F.col("_twice")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.length("text"), "text"))
    rows = keyed.join(twice, repeats, "left_semi").withColumn("_row", nth)
    both = keyed.join(twice, repeats, "left_anti").withColumn("_row", F.lit(1)).unionByName(rows)
    both = both.join(taken, (F.col("_key") == F.col("_id")) & (F.col("_row") == F.col("_nth")))
    return both.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, tokenized, in sequences of 2048 tokens."""
    return packing.packed(docs, "doc_id", "text", *vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_chunks),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# Learning, rounding and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    spark = prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs


def pipeline_queries() -> dict:
    return {"pipeline": run}
