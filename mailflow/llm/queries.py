"""The registered query of each operator, on its whole table, and SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailflow.llm import (
    fingerprints, jaccard, licenses, linechunks, manifest, mixing, packing, pages, repeats, runs, sharding, toxicity, vectors,
)
from mailflow.llm.store import table
from mailflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_near_vectors")
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within a label."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


@query("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document so that sources meet their targets."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source", [3, 1, 2])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_repeated_units", repeats.repeats_sql())
def op6_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the units that occurred before."""
    found = repeats.drop_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ";")
    return found.withColumn("removed", spans)


@query("op7_shards")
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal bytes."""
    return sharding.shards(table(spark, sf_dir, "documents"), "doc_id", "text", 24)


@query("op8_line_chunks", linechunks.chunks_sql())
def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred before."""
    found = linechunks.drop_chunks(table(spark, sf_dir, "documents"), "doc_id", "text")
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("+", s["first"], s["n"])), ";")
    return found.withColumn("removed", spans)


@query("op9_weighted_fingerprints")
def op9_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of every text and of its edited form, and how alike they are."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text")


def vocabulary() -> tuple[str, str, tuple[tuple[str, int], ...]]:
    """The 50k byte-level BPE as ranks, how it cuts words, and its special tokens."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        special = tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special


@query("op4_packed_sequences")
def op4_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized, in sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), "doc_id", "text", *vocabulary())


@query("op10_main_text")
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return pages.main_texts(table(spark, sf_dir, "pages"), "page_id", "url", "html")


@query("op2_toxic_spans")
def op2_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out third."""
    documents = table(spark, sf_dir, "documents")
    field = toxicity.learn(documents, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return toxicity.score_toxicity(documents, field, "doc_id", "text")


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike in at least 75 % of their five-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op11_license_scan")
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, tags and expressions of every document."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text")
    return licenses.digests(found)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words of every document, a tenth of them made to repeat."""
    documents = table(spark, sf_dir, "documents")
    documents = documents.select("doc_id", runs.looped(F.col("doc_id"), F.col("text")).alias("text"))
    return runs.digests(runs.find_runs(documents, "doc_id", "text", least=6, times=4))


@query("op13_merkle_manifest", manifest.manifest_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root, and the root that a changed text folds to."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = manifest.manifest(
        table(spark, sf_dir, "documents"), "doc_id", "lang", [*fields, "text"], [*fields, lower], third
    )
    return found.withColumn("proof_sha256", F.sha2(F.col("proof"), 256)).drop("proof")
