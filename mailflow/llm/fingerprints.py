"""Fingerprints of texts by consistent weighted sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.store import stored

WIDTH = 9  # bits of a bucket of keys: 512
SAMPLES = 32
ABSENT = 1 << 62
SPACE = r"[\x20\x09-\x0D]+"


def successors(values: DataFrame, low: int, high: int) -> DataFrame:
    """(v, after): each of the distinct whole numbers and the next larger one, null for
    the last.  Numbers are ordered within ranges of 512, ranges within ranges of ranges,
    so no window holds more than 512 rows however the numbers lie."""
    group = F.shiftright(F.col("v") - F.lit(low), WIDTH)
    ranged = values.withColumn("g", group)
    inner = ranged.withColumn("after", F.lead("v").over(Window.partitionBy("g").orderBy("v")))
    if (high - low) >> WIDTH == 0:
        return inner.select("v", "after")
    firsts = values.groupBy(group.alias("g")).agg(F.min("v").alias("first"))
    above = successors(firsts.select(F.col("g").alias("v")), 0, (high - low) >> WIDTH)
    above = above.select(F.col("v").alias("g"), F.col("after").alias("h"))
    entry = above.join(firsts.select(F.col("g").alias("h"), "first"), "h", "left").select("g", "first")
    return inner.join(entry, "g").select("v", F.coalesce("after", "first").alias("after"))


def with_next(rows: DataFrame) -> DataFrame:
    """Add to (doc_id, text): bucket, place, next_text and last (of its bucket).  Texts
    are dealt once, by bucket; only the first text of each bucket is fetched again, for
    the bucket before it."""
    bucket = F.coalesce(F.shiftright("doc_id", WIDTH), F.lit(-(1 << 54) - 1))
    dealt = rows.withColumn("bucket", bucket)
    firsts = stored(dealt.groupBy("bucket").agg(F.min("doc_id").alias("first_id")), "firsts")
    low, high = firsts.agg(F.min("bucket"), F.max("bucket")).first()
    if low is None:
        low = high = 0
    order = stored(successors(firsts.select(F.col("bucket").alias("v")), low, high), "order")
    order = order.select(F.col("v").alias("before"), F.coalesce("after", F.lit(low)).alias("b"))
    heads = rows.join(firsts, F.col("doc_id").eqNullSafe(F.col("first_id")))
    heads = heads.groupBy(F.col("bucket").alias("b")).agg(F.min(F.coalesce("text", F.lit(""))).alias("head"))
    heads = stored(heads.join(order, "b").select("before", "head"), "heads")
    by = Window.partitionBy("bucket").orderBy("doc_id", "text")
    placed = dealt.withColumn("place", F.row_number().over(by)).withColumn("follows", F.lead("text").over(by))
    placed = placed.withColumn("last", F.lead(F.lit(True)).over(by).isNull())
    joined = placed.join(heads, (F.col("bucket") == F.col("before")) & F.col("last"), "left")
    return joined.select("doc_id", "text", "bucket", "place", "last", F.coalesce("head", "follows").alias("next_text"))


def sample(k: int) -> Column:
    """The value of term ``h`` of weight e^``logw`` in sample k; the least one wins.

    Two hashes give five uniform numbers, these r and c ~ Gamma(2, 1) and b ~ U(0, 1).
    With t = floor(ln w / r + b) and ln y = r (t - b), the term with the least
    c / (y e^r) is drawn, and it is drawn with the same t for every weight near w.  The
    value's upper bits order by ln c - ln y - r, its lower 16 name term and t."""
    a, d = F.xxhash64("h", F.lit(2 * k)), F.xxhash64("h", F.lit(2 * k + 1))
    bits = lambda x, at, n: (F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << n) - 1)).cast("double") + 0.5) / float(1 << n)
    r = -F.log(bits(a, 0, 24) * bits(a, 24, 24))
    c = -F.log(bits(d, 0, 24) * bits(d, 24, 24))
    b = bits(a, 48, 16)
    t = F.floor(F.col("logw") / r + b)
    value = ((F.log(c) - r * (t.cast("double") - b + 1.0) + 400.0) * float(1 << 35)).cast("long")
    name = (F.col("h") + t * 40503).bitwiseAND(F.lit(0xFFFF))
    return F.shiftleft(value, 16).bitwiseOR(name)


def likeness(a: str, b: str) -> Column:
    """The share of equal samples: the two texts' generalised Jaccard similarity, up to chance."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, 1.0).otherwise(0.0))
    return F.aggregate(same, F.lit(0.0), lambda s, x: s + x) / F.lit(float(SAMPLES))


def written(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def fingerprints(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprint every text and its edited form, whose last quarter of code points is
    replaced by the first as many of the next text (by key; after the last, the first).
    DataFrame functions only.

    A text is a bag of words, letter case aside; a word weighs its count times its squared
    length, since short words say little.  Consistent weighted samples are the signature.
    A word with one count in both forms is sampled once for both.  Texts are dealt once,
    in buckets of 512 keys; all later steps use that partitioning.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.  A null text counts as empty; texts without words have one common
    fingerprint and are like each other only.  Rows without a key come first, rows that
    repeat a key lie side by side in the order of their texts.  A single row follows
    itself.  Other columns of ``rows`` are not looked at.
    """
    given = rows.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n, q = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    both = with_next(given).select(
        "bucket", "place", "doc_id", "last", "text", "next_text", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q)).alias("edited"),
    )
    # forms 0 and 1 are the text and its edited form; 2, the text after the last of a bucket, stands as a
    # document without n_chars of its own behind it
    form = lambda i, body: F.struct(F.lit(i).alias("form"), body.alias("body"))
    forms = F.array(form(0, F.col("text")), form(1, F.col("edited")), form(2, F.when(F.col("last"), F.col("next_text"))))
    keys = ["bucket", "place", "doc_id", "n_chars", "sha"]
    shown = both.withColumn("sha", F.unhex(F.sha2("edited", 256))).select(*keys, F.inline(forms)).where("body IS NOT NULL")
    behind = F.col("form") == 2
    shown = shown.select(
        "bucket", F.when(behind, F.col("place") + 1).otherwise(F.col("place")).alias("place"), "doc_id",
        F.when(~behind, F.col("n_chars")).alias("n_chars"), F.when(~behind, F.col("sha")).alias("sha"),
        F.when(behind, 0).otherwise(F.col("form")).alias("form"), "body",
    )
    words = shown.select(*keys, "form", F.explode(F.split(F.lower("body"), SPACE)).alias("word"))
    words = words.select(*keys, F.xxhash64("word").alias("h"), F.length("word").alias("len"), "form")
    times = lambda i: F.sum(F.when(F.col("form") == i, 1).otherwise(0)).cast("int")
    counted = words.groupBy(*keys, "h").agg(F.max("len").alias("len"), times(0).alias("n0"), times(1).alias("n1"))
    # rows of equal counts: ``forms`` is a bit per form; the empty word only stands for a text without others
    case = lambda on, n, bits: F.when(on, F.struct(n.alias("n"), bits.alias("forms")))
    n0, n1 = F.col("n0"), F.col("n1")
    same = n0 == n1
    cases = F.array(case(n0 > 0, n0, F.when(same, 3).otherwise(1)), case((n1 > 0) & ~same, n1, F.lit(2)))
    weighed = counted.select(*keys, "h", "len", F.inline(cases)).where("n IS NOT NULL").select(
        *keys, "h", F.log(F.col("n") * F.greatest(F.col("len"), F.lit(0.05)) * F.greatest(F.col("len"), F.lit(0.05))).alias("logw"),
        *[F.when(F.col("forms").bitwiseAND(F.lit(1 << i)) == 0, F.lit(ABSENT)).otherwise(F.lit(0)).alias(f"off{i}") for i in range(2)],
    )
    least = weighed.groupBy(*keys).agg(
        *[F.min(F.greatest(sample(k), F.col(f"off{i}"))).alias(f"s{i}_{k}") for k in range(SAMPLES) for i in range(2)]
    )
    sig = lambda i: F.array(*[F.col(f"s{i}_{k}").bitwiseAND(F.lit(0xFFFF)).cast("int") for k in range(SAMPLES)])
    signed = least.select(*keys, sig(0).alias("sig0"), sig(1).alias("sig1"))
    by = Window.partitionBy("bucket").orderBy("place")
    whole = signed.withColumn("follows", F.lead("sig0").over(by)).where("n_chars IS NOT NULL")
    return whole.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), written("sig0").alias("fingerprint"),
        written("sig1").alias("edited_fingerprint"), likeness("sig0", "sig1").alias("near_edited"),
        likeness("sig0", "follows").alias("near_next"),
    )
