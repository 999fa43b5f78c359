"""Duplicate detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.functions import ids
from mailflow.operators import similar
from mailflow.operators.lookup import HOT_SHARE, SALTS, attach
from mailflow.session import kept

# Ranks up to this limit are cut before the shuffle (Spark's own threshold).
CUT_BY_SPARK = 1000


def latest_per_key(df: DataFrame, keys: list[str], order: list, name: str = "_rn") -> DataFrame:
    """The first row per key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a key with very many rows costs one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(first)).filter(F.col(name) == 1).drop(name)


def first_per_key(
    df: DataFrame, keys: list[str], order: list, n: int, spread_by: str
) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Up to a thousand rows Spark cuts each key per task before the shuffle.  For
    more, every key is ranked in slices first, so that the last step meets at
    most ``n`` rows per slice of a hot key.
    """

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")

    if n > CUT_BY_SPARK:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
        df = cut(sliced, [*keys, "_slice"]).drop("_slice")
    return cut(df, keys)


def dedupe_exact(mails: DataFrame, keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """Keep the earliest of mails equal in ``keys``; by default equal content.

    A mail that lacks one of the keys, or its content, equals no other one, as SQL
    equality has it.
    """
    order = order or [F.col("email_date").asc_nulls_last(), F.col("email_id")]
    keyed = mails
    if not keys:
        keys = ["_hash"]
        text = F.col("email_body")
        keyed = mails.withColumn("_hash", F.when(text.isNotNull(), ids.content_hash(text)))
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own = F.when(lacking, F.col("email_id"))
    kept = latest_per_key(keyed.withColumn("_own", own), [*keys, "_own"], order)
    return kept.drop("_own", "_hash")


def normal_form(subject: Column, body: Column) -> Column:
    """Text without reply prefixes, quote marks, letter case and spacing."""
    bare = F.regexp_replace(
        F.lower(F.coalesce(subject, F.lit(""))), "^( *(re|fw|fwd|aw) *:)+", ""
    )
    text = F.concat_ws("\n", bare, F.lower(F.coalesce(body, F.lit(""))))
    return F.trim(F.regexp_replace(text, "[> \t\r\n]+", " "))


def near_duplicates(mails: DataFrame, threshold: float | None = None) -> DataFrame:
    """Mails that differ from an earlier one only in case, spacing, quoting or
    reply prefixes: each mail of such a group with the group's first mail and
    size.  Groups are found by hash; no pairs are formed.  Mails without any text
    are left out.

    With a ``threshold`` also mails whose sets of five-word runs overlap by that
    share (Jaccard) belong together, directly or through others (see
    ``operators.similar``); of equal mails only one is compared.
    """
    form = normal_form(F.col("subject"), F.col("email_body"))
    if threshold is not None:
        return _similar(mails, form, threshold)
    marked = mails.select(
        "email_id", ids.content_hash(form).alias("_form"), (form != "").alias("_text")
    )
    # Testing for text after grouping keeps the form from being computed once
    # more for a filter below.
    groups = (
        marked.groupBy("_form")
        .agg(
            F.min("email_id").alias("first_id"), F.count("*").alias("copies"),
            F.bool_or("_text").alias("_some"),
        )
        .filter("copies > 1 AND _some")
        .drop("_some")
    )
    return _members(marked.drop("_text"), groups)


def _members(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """Mails (email_id, _form) with the group of their form."""
    total = marked.select(F.count("*")).scalar()
    hot = groups.filter(F.col("copies") * HOT_SHARE > total).select("_form")
    found = attach(marked, groups, ["_form"], spread_by="email_id", hot=hot)
    return found.filter(F.col("copies").isNotNull()).select("email_id", "first_id", "copies")


def _similar(mails: DataFrame, form: Column, threshold: float) -> DataFrame:
    formed = mails.select("email_id", form.alias("form")).withColumn("_form", ids.content_hash(F.col("form")))
    # Testing for text after writing keeps the form from being computed once more.
    formed = kept(formed, "similar-forms").filter("form != ''")
    # A form is stored with the group, not with each of its mails.
    forms = formed.groupBy("_form").agg(
        F.min("email_id").alias("id"), F.min("form").alias("form"), F.count("*").alias("copies")
    )
    forms = kept(forms, "similar-distinct")
    together = similar.similar_groups(forms, threshold)
    classes = forms.select("_form", "id", "copies").join(together, "id", "left")
    classes = classes.select("_form", "copies", F.coalesce("first_id", "id").alias("first_id"))
    sizes = classes.groupBy("first_id").agg(F.sum("copies").alias("_n")).filter("_n > 1")
    sized = classes.join(sizes, "first_id").select("_form", "first_id", F.col("_n").alias("copies"))
    return _members(formed.select("email_id", "_form"), sized)
