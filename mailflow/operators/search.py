"""Relevance search over mails and over precomputed vectors."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow import values
from mailflow.functions import text
from mailflow.functions.arrays import let
from mailflow.operators.lookup import few

K1 = 1.2
B = 0.75


def query_terms(query: str) -> list[str]:
    """Distinct words of the query, in the order typed."""
    return list(dict.fromkeys(re.findall(text.WORD, query.lower())))


def term_counts(mails: DataFrame, terms: list[str]) -> DataFrame:
    """Length in words and count per query term of every mail: no token table."""
    full = F.concat_ws(" ", F.coalesce("subject", F.lit("")), "email_body")

    def measure(tokens: Column) -> Column:
        hits = F.filter(tokens, lambda w: w.isin(terms))
        return F.struct(F.size(tokens).alias("dl"), hits.alias("hits"))

    measured = mails.filter(F.col("email_body").isNotNull()).select(
        "email_id", let(text.words(full), measure).alias("_m")
    )
    return measured.select(
        "email_id",
        F.col("_m.dl").alias("dl"),
        *[text.count_in(F.col("_m.hits"), [t]).alias(f"tf{i}") for i, t in enumerate(terms)],
    )


def bm25(mails: DataFrame, query: str) -> DataFrame:
    """BM25 score per mail (Robertson & Zaragoza 2009), zero without a hit.

    Collection figures come from one aggregate and reach the scoring pass as a
    single scalar, so neither pass shuffles the mails.
    """
    terms = query_terms(query)
    if not terms:
        return mails.filter(F.col("email_body").isNotNull()).select(
            "email_id", F.lit(0.0).alias("score")
        )
    counts = term_counts(mails, terms)
    figures = counts.agg(
        F.count("*").alias("n"),
        F.avg("dl").alias("avgdl"),
        *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
    )
    stats = figures.select(F.struct(*figures.columns)).scalar()
    s = counts.withColumn("_s", stats)

    def part(i: int) -> Column:
        tf, df, n = F.col(f"tf{i}"), F.col(f"_s.df{i}"), F.col("_s.n")
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * F.col("dl") / F.greatest("_s.avgdl", F.lit(1e-9)))
        return idf * tf * (K1 + 1) / (tf + norm)

    total = reduce(lambda a, b: a + b, [part(i) for i in range(len(terms))])
    return s.select("email_id", F.round(total, 9).alias("score"))


def search_mail(mails: DataFrame, summaries: DataFrame, query: str, n: int = 10) -> DataFrame:
    """The ``n`` most relevant mails with a score from 0 to 1 and their BRIEF.

    The best ``n`` are found first on id and score; only those meet the mail and
    summary tables again.
    """
    best = bm25(mails, query).orderBy(F.col("score").desc(), "email_id").limit(n)
    return with_briefs(mails, summaries, best, n)


def with_briefs(mails: DataFrame, summaries: DataFrame, best: DataFrame, n: int) -> DataFrame:
    """The best ``n`` (email_id, score) with their mails and BRIEF, the first scoring 1."""
    top = F.max("score").over(Window.partitionBy())  # over the n rows only
    scored = best.select(
        "email_id",
        F.when(top > 0, F.round(F.col("score") / top, 6)).otherwise(0.0).alias("relevance_score"),
    )
    brief = summaries.filter(F.col("summary_type") == values.BRIEF).select(
        "email_id", F.col("summary_text").alias("brief_summary")
    )
    found = few(scored, n)  # met by both tables with the same columns
    hits = mails.select("email_id", "subject", "sender_email", "email_date").join(found, "email_id")
    briefs = brief.join(found, "email_id")
    return (
        hits.join(briefs, ["email_id", "relevance_score"], "left")
        .select("email_id", "subject", "sender_email", "email_date", "relevance_score", "brief_summary")
        .orderBy(F.col("relevance_score").desc(), "email_id")
    )


def cosine(a: Column, b: Column) -> Column:
    def dot(x, y):
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def search_vectors(
    vectors: DataFrame, query_id, n: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``n`` vectors nearest to a stored one by cosine, itself excluded.

    An id that is not stored has no neighbours; vectors without a cosine are none.
    """
    query = vectors.filter(F.col(id_col) == query_id).select(F.first(vector_col)).scalar()
    others = vectors.filter(F.col(id_col) != query_id).withColumn("_query", query)
    scored = others.select(
        id_col, F.round(cosine(F.col(vector_col), F.col("_query")), 6).alias("similarity")
    )
    return scored.filter("similarity IS NOT NULL").orderBy(F.desc("similarity"), id_col).limit(n)
