"""Removing repeated runs of lines, cut where the content says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailflow.llm.store import passing, stored

DIVISOR = 3  # a line ends no chunk in one of so many cases
FACTOR = 31
NOT_BLANK = r"[^\x20\x09-\x0D]"


def line_hash(line: Column) -> Column:
    """32 bits of MD5, which every SQL engine has."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(rows: DataFrame) -> DataFrame:
    """Add ``lines`` and ``chunks``: (first, n, body, digest) of each chunk.  The hash that
    decides where a chunk ends rolls over a line and the one before, so cuts move along with
    the lines: text put in before or after changes the chunks around it only.  A chunk of one
    line is known by the line before it as well.  No digest: blank, or the text's only line."""
    cut = rows.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    cut = cut.withColumn("hashes", F.transform("lines", line_hash))
    ends = lambda h, i: (i > 0) & ((h + FACTOR * F.get("hashes", i - 1)) % DIVISOR != 0)
    marks = F.transform("hashes", lambda h, i: F.when(ends(h, i) | (i == F.size("hashes") - 1), i))
    cut = cut.withColumn("ends", F.filter(marks, lambda i: i.isNotNull())).drop("hashes")
    spans = F.transform(
        "ends",
        lambda e, j: F.struct(
            F.when(j > 0, F.get("ends", j - 1) + 1).otherwise(0).alias("first"),
            (e - F.when(j > 0, F.get("ends", j - 1)).otherwise(-1)).alias("n"),
        ),
    )
    cut = cut.withColumn("spans", spans).drop("ends")
    before = lambda s: F.when((s["n"] == 1) & (s["first"] > 0), 1).otherwise(0)
    bodies = F.transform(
        "spans",
        lambda s: F.struct(
            s["first"].alias("first"), s["n"].alias("n"),
            F.when((s["n"] > 1) | (s["first"] > 0),
                   F.array_join(F.slice("lines", s["first"] + 1 - before(s), s["n"] + before(s)), "\n")).alias("body"),
        ),
    )
    cut = cut.withColumn("bodies", bodies).drop("spans")
    chunks = F.transform(
        "bodies",
        lambda c: F.struct(
            c["first"].alias("first"), c["n"].alias("n"), c["body"].alias("body"),
            F.when(c["body"].rlike(NOT_BLANK), F.unhex(F.md5(c["body"]))).alias("digest"),
        ),
    )
    return cut.withColumn("chunks", chunks).drop("bodies")


def marked(given: DataFrame) -> DataFrame:
    """Add ``gone``, numbers of the chunks whose digest occurs before, and ``own``, of those
    that are the first of several.  Texts are cut once, to a table of digests; these are
    combined within each task, the first place of each meets the places of its document,
    and no join is on a digest.  Whole texts meet only what is marked in them."""
    place = F.posexplode_outer("chunks").alias("at", "c")  # outer: else Spark cuts once more, to see that there is any
    found = with_chunks(given.where(F.col("doc_id").isNotNull())).select("doc_id", "own_hash", place)
    found = stored(found.where("c.digest IS NOT NULL").select("doc_id", "own_hash", "at", "c.digest"), "chunk-digests")
    first = found.groupBy("digest").agg(F.min(F.struct("doc_id", "own_hash", "at")).alias("f"), F.count("*").alias("often"))
    each = found.drop("digest").join(first.select("f.*", "often"), ["doc_id", "own_hash", "at"], "left").where("often IS NULL OR often > 1")
    known = each.groupBy("doc_id", "own_hash").agg(
        F.collect_set(F.when(F.col("often").isNull(), F.col("at"))).alias("gone"), F.collect_set(F.when(F.col("often") > 1, F.col("at"))).alias("own"))
    known = stored(known, "chunk-marks")
    none = F.array().cast("array<int>")
    both = given.join(known.hint("merge"), ["doc_id", "own_hash"], "left")  # at any size alike, no table of marks is broadcast
    return both.withColumn("gone", F.coalesce("gone", none)).withColumn("own", F.coalesce("own", none))


def units(repeated: DataFrame) -> DataFrame:
    """What is compared byte by byte: (doc_id, own_hash, at, line, n, digest, away, body) of
    every repeated chunk (``away`` 0), and of each line of the chunks beside it, ``away``
    lines off.  Lines beside a chunk that goes too are left out, they go with that one."""
    cut = with_chunks(repeated)
    edges = lambda side: F.array_union(F.array_except("gone", F.transform("gone", lambda g: g - side)), F.col("own"))
    to = lambda numbers, side: F.transform(numbers, lambda g: F.struct(g.alias("at"), F.lit(side).alias("side")))
    asked = cut.withColumn("asked", F.concat(to(F.array_union("gone", "own"), 0), to(edges(-1), -1), to(edges(1), 1)))
    chunk, beside = (lambda a: F.get("chunks", a["at"])), (lambda a: F.get("chunks", a["at"] + a["side"]))
    lined = F.transform(
        "asked",
        lambda a: F.struct(
            a["at"].alias("at"), a["side"].alias("side"), chunk(a)["first"].alias("first"), chunk(a)["n"].alias("n"),
            chunk(a)["digest"].alias("digest"), F.when(a["side"] == 0, chunk(a)["body"]).alias("body"),
            F.when(a["side"] != 0, F.slice("lines", beside(a)["first"] + 1, beside(a)["n"])).alias("texts"),
            F.when(a["side"] != 0, beside(a)["first"]).alias("start"),
        ),
    )
    each = asked.select("doc_id", "own_hash", "lines", "chunks", lined.alias("u")).select("doc_id", "own_hash", F.explode_outer("u").alias("u"))
    whole = each.where("u.side = 0").select("doc_id", "own_hash", "u.at", F.col("u.first").alias("line"), "u.n", "u.digest", F.lit(0).alias("away"), "u.body")
    edge = F.when(F.col("u.side") == 1, F.col("u.first") + F.col("u.n") - 1).otherwise(F.col("u.first"))
    lines = each.where("u.side <> 0").select(
        "doc_id", "own_hash", "u.at", "u.start", "u.digest", edge.alias("edge"), F.posexplode("u.texts").alias("i", "body"))
    lines = lines.withColumn("line", F.col("start") + F.col("i")).select(
        "doc_id", "own_hash", "at", "line", F.lit(1).alias("n"), "digest", (F.col("line") - F.col("edge")).alias("away"), "body")
    return whole.unionByName(lines)


def repeated_ranges(asked: DataFrame) -> DataFrame:
    """(doc_id, own_hash, removed) from ``units``: ranges of lines, each with a chunk in it."""
    first = asked.groupBy("digest", "away", "body").agg(F.min(F.struct("doc_id", "own_hash", "at")).alias("f"))
    first = first.select("f.doc_id", "f.own_hash", "f.at", "away")
    lost = asked.select("doc_id", "own_hash", "at", "line", "n", "away").join(first, ["doc_id", "own_hash", "at", "away"], "left_anti")
    each = lost.select("doc_id", "own_hash", (F.col("away") == 0).alias("chunk"), F.explode(F.expr("sequence(line, line + n - 1)")).alias("line"))
    each = each.groupBy("doc_id", "own_hash", "line").agg(F.max("chunk").alias("chunk"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "own_hash").orderBy("line"))
    runs = each.withColumn("run", F.col("line") - nth).groupBy("doc_id", "own_hash", "run").agg(
        F.min("line").alias("first"), F.count("*").cast("int").alias("n"), F.max("chunk").alias("chunk"))
    return runs.where("chunk").groupBy("doc_id", "own_hash").agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("removed"))


def drop_chunks(rows: DataFrame, key: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """Keep the first occurrence of each chunk, by ``key`` and then by place; remove the
    others, and with them the lines beside that an earlier occurrence has as well.
    DataFrame functions only.

    A text is cut into chunks of one line and a half on average; one of a single line counts
    together with the line before it, so that two lines at least repeat.  Digests find what
    may be repeated, and only that is grouped by its whole text, so that equal digests
    alone remove nothing.  A removed chunk then grows line by line through the chunks
    beside it: a line goes that stands as far off an earlier occurrence of the same chunk,
    as long as there is no gap.  So every removed line stands in an earlier document or
    further up.  A chunk that all documents share is one row a task, and no join is on one.

    Returns doc_id, text, n_lines, n_removed (lines) and ``removed``: (first line, number
    of lines) of the original.  A null text counts as no lines and stays null; empty texts
    have one empty line and stay; chunks of white space alone go only beside others.  Rows
    without a key are returned unchanged; of rows that repeat a key with another text the
    smaller hash counts as earlier, those equal in both keep and lose the same.  Other
    columns of ``rows`` are not looked at; those named in ``keep`` are carried along.
    """
    carried = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep or [])]
    given = rows.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("own_hash"), F.col(text).alias("text"), *carried)
    with passing(rows.sparkSession):
        known = stored(marked(given), "chunks", stays=True)
    with passing(rows.sparkSession):
        asked = stored(units(known.where("size(gone) > 0 OR size(own) > 0").select("doc_id", "own_hash", "text", "gone", "own")), "chunk-units")
        ranges = stored(repeated_ranges(asked), "chunk-ranges", stays=True)
    none = F.array().cast("array<struct<first: int, n: int>>")
    changed = known.where("size(gone) > 0").join(ranges.hint("merge"), ["doc_id", "own_hash"], "left").withColumn("removed", F.coalesce("removed", none))
    both = known.where("size(gone) = 0").withColumn("removed", none).unionByName(changed)
    both = both.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    out = F.flatten(F.transform("removed", lambda r: F.sequence(r["first"], r["first"] + r["n"] - 1)))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), out), lambda i: F.get("lines", i))
    return both.select(
        "doc_id",
        F.when(F.size("removed") > 0, F.array_join(left, "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.aggregate("removed", F.lit(0), lambda a, r: a + r["n"]).cast("long").alias("n_removed"),
        "removed", *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep or [])],
    )


def chunks_sql() -> str:
    """The same over ``documents`` as SQL, with ranges written first+n;first+n."""
    return f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS i FROM split),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
cut AS (SELECT *, lag(line) OVER w AS prior, coalesce((h + {FACTOR} * lag(h) OVER w) % {DIVISOR} <> 0, false)::INT AS edge FROM hashed
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(edge) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cut),
tiles AS (
  SELECT doc_id, c, min(i) AS f, count(*) AS n,
    CASE WHEN count(*) = 1 THEN any_value(prior) || chr(10) ELSE '' END || string_agg(line, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY doc_id, c),
usable AS (SELECT *, coalesce(regexp_matches(body, '{NOT_BLANK}'), false) AS ok FROM tiles),
placed AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY ok, body) AS often FROM usable
  WINDOW w AS (PARTITION BY ok, body ORDER BY doc_id, c)),
flagged AS (SELECT *, ok AND place > 1 AS gone, ok AND place = 1 AND often > 1 AS own FROM placed),
chunks AS (SELECT *, coalesce(lag(gone) OVER w, false) AS gone_before, coalesce(lead(gone) OVER w, false) AS gone_after FROM flagged
  WINDOW w AS (PARTITION BY doc_id ORDER BY c)),
beside AS (
  SELECT k.doc_id, k.c, k.body, l.i, l.line, CASE WHEN l.c > k.c THEN l.i - (k.f + k.n - 1) ELSE l.i - k.f END AS away
  FROM chunks k JOIN numbered l ON l.doc_id = k.doc_id AND (
    l.c = k.c + 1 AND (k.own OR k.gone AND NOT k.gone_after) OR l.c = k.c - 1 AND (k.own OR k.gone AND NOT k.gone_before))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body, away, line ORDER BY doc_id, c) AS place FROM beside),
lost AS (
  SELECT n.doc_id, n.i, 1 AS chunk FROM numbered n JOIN chunks k ON k.doc_id = n.doc_id AND k.c = n.c WHERE k.gone
  UNION ALL SELECT doc_id, i, 0 FROM ranked WHERE place > 1),
once AS (SELECT doc_id, i, max(chunk) AS chunk FROM lost GROUP BY doc_id, i),
sessions AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM once),
runs AS (SELECT doc_id, run, min(i) AS f, count(*) AS n FROM sessions GROUP BY doc_id, run HAVING max(chunk) = 1),
ranges AS (SELECT doc_id, sum(n) AS n_removed, string_agg(f || '+' || n, ';' ORDER BY f) AS removed FROM runs GROUP BY doc_id),
taken AS (SELECT s.doc_id, s.i FROM sessions s JOIN runs r ON r.doc_id = s.doc_id AND r.run = s.run),
joined AS (
  SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (t.i IS NULL), '') AS text, count(*) AS n_lines
  FROM lines l LEFT JOIN taken t ON t.doc_id = l.doc_id AND t.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, j.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN joined j USING (doc_id) LEFT JOIN ranges r USING (doc_id)"""
