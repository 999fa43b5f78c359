"""Corpus operators against SQL, brute force and awkward rows."""

import collections
import contextlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from mailflow.llm import fingerprints, jaccard, linechunks, mixing, packing, pages, repeats, sharding, toxicity, vectors
from mailflow.llm.queries import ORACLES, QUERIES, vocabulary
from mailflow.session import settings

DOCS = "doc_id long, text string, source string, c long, n string, token int, u int, v int, h1 int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    lines = "one line of several words here\nand a second line follows it\nand the third line ends it"
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "a"), (2, None, "a"), (3, "", None), (4, "  \n\t ", "b"),
        (5, "alpha beta gamma delta epsilon zeta", "b"), (6, long, "a"), (7, lines, None), (8, "new start\n" + lines, "c"),
        (9, "x", "a"), (9, "x", "a"), (None, "alpha beta gamma delta epsilon zeta", "a"), (10, "ALPHA beta\tgamma delta epsilon zeta", "c"),
    ]
    return spark.createDataFrame([(*r, 1, "n", 2, 3, 4, 5) for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, sf, name):
    assert compare.difference(QUERIES[name](spark, sf), compare.connect(sf), ORACLES[name]) is None


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[0] + rng.standard_normal(16) * 0.01], 0) for i in range(30)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 1), (202, None, 0), (203, [0.0] * 16, 0), (204, [math.nan] * 16, 0), (205, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df, "vec_id", "embedding", "label").collect()}
    assert len(got) == len(rows)
    valid = [(i, np.float32(v).astype(float), lab) for i, v, lab in rows if v and lab is not None and np.isfinite(v).all() and any(v)]
    for i, v, lab in valid:
        linked = [j for j, w, other in valid if j != i and other == lab and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98]
        assert got[i].n_links == len(linked)
        assert got[i].component_id == min([i, *linked])
    for i in (202, 203, 204, 205):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vectors.near_vectors(df.limit(0), "vec_id", "embedding", "label").count() == 0


def two_groups(rng, n=30, dim=64):
    """Two tight groups whose vectors lie at a cosine of about 0.985 across."""
    a = rng.standard_normal(dim)
    a /= np.linalg.norm(a)
    b = rng.standard_normal(dim)
    b -= (a @ b) * a
    b = 0.985 * a + math.sqrt(1 - 0.985**2) * b / np.linalg.norm(b)
    return [list(map(float, c + rng.standard_normal(dim) * 0.0005)) for c in (a, b) for _ in range(n)]


def test_vectors_of_two_tight_groups(spark):
    rng = np.random.default_rng(8)
    x = two_groups(rng)
    rows = [(i, v, 0) for i, v in enumerate(x)] + [(100 + i, list(map(float, rng.standard_normal(64))), 0) for i in range(200)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(x[:30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df, "vec_id", "embedding", "label", attempts=1, recall=0.0).collect()}
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (59, 0, i == 0) for i in range(60))
    assert all((got[i].n_links, got[i].component_id) == (29, 1000) for i in range(1000, 1030))
    assert all(got[100 + i].n_links == 0 for i in range(200))


def test_vectors_go_on_exactly(spark, monkeypatch):
    x = two_groups(np.random.default_rng(9))
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(vectors, "joined", lambda edges, *_: (edges, vectors.stored(vectors.components(edges), "components")))
    monkeypatch.setattr(vectors, "BLOCK", 16)
    got = vectors.near_vectors(df, "vec_id", "embedding", "label", attempts=1).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(59, 0)}


def test_toxicity(spark, odd, none):
    good = [f"the day {i} was fine and quiet in town" for i in range(200)]
    bad = [f"the day {i} was {'grobbian' if i % 2 else 'Grobbian,'} and quiet in town" for i in range(200, 260)]
    field = toxicity.fit(good + bad, [0] * 200 + [1] * 60)
    df = spark.createDataFrame([(1, "you grobbian over there"), (2, "a quiet town")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, field, "doc_id", "text").collect()}
    assert (got[1].predicted, got[2].predicted) == (1, 0)
    assert [(s.start, s.end) for s in got[1].spans] == [(4, 12)]
    assert toxicity.score_toxicity(odd, field, "doc_id", "text").where("predicted = 0").count() == 12
    assert toxicity.score_toxicity(none, field, "doc_id", "text").count() == 0
    rng = np.random.default_rng(1)
    e, doc = rng.standard_normal(1300), np.sort(rng.integers(0, 5, 1300))
    moves, start = np.array([[0.9, 0.1], [0.4, 0.6]]), np.array([0.8, 0.2])
    p, _ = toxicity.forward_backward(e, doc, moves, start)
    for d in range(5):
        x = np.exp(np.stack([np.zeros((doc == d).sum()), e[doc == d]], 1))
        a, b = np.zeros_like(x), np.ones_like(x)
        for t in range(len(x)):
            a[t] = (start if t == 0 else a[t - 1] @ moves) * x[t]
            a[t] /= a[t].sum()
        for t in range(len(x) - 2, -1, -1):
            b[t] = moves @ (x[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        assert np.allclose(p[doc == d], (a * b)[:, 1] / (a * b).sum(1))


def test_toxicity_of_held_out_documents(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    out = toxicity.held_out("doc_id")
    odd = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    odd = odd.unionByName(labels.limit(5).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(
        labels.where(out).limit(5).withColumn("toxic", F.lit(None).cast(labels.schema["toxic"].dataType)))
    field, same = (toxicity.learn(docs, given, "doc_id", "text", "toxic") for given in (labels, odd))
    assert np.array_equal(field.known, same.known) and np.allclose(field.weights, same.weights)
    fewer = toxicity.learn(docs, labels, "doc_id", "text", "toxic", per_label=20)
    assert np.array_equal(field.known, fewer.known) and not np.allclose(field.weights, fewer.weights)
    scored = toxicity.score_toxicity(docs, field, "doc_id", "text").where("held_out")
    rows = scored.join(labels.where("toxic IS NOT NULL"), "doc_id").select("predicted", "score", F.col("toxic").cast("int").alias("y")).collect()
    caught = sum(r.predicted for r in rows if r.y) / sum(r.y for r in rows)
    right = sum(r.y for r in rows if r.predicted) / max(1, sum(r.predicted for r in rows))
    assert caught > 0.6 and right > 0.8


def test_mixing(spark, sf, odd, none):
    rows = QUERIES["op3_mix_sources"](spark, sf).collect()
    assert rows and sorted(rows) == sorted(QUERIES["op3_mix_sources"](spark, sf).collect())
    assert all(r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    assert math.isclose(sum(r.target / r.source_size * r.size for r in rows), 1.5 * sum(r.size for r in rows))
    got = mixing.mix(odd, "doc_id", "text", "source", [3, 1, 2]).collect()
    assert len(got) == 12 and {r.taken for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix(none, "doc_id", "text", "source", [3, 1, 2]).count() == 0


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    import public_tokenizers

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.packed(odd, "doc_id", "text", *vocabulary()).toPandas()
    for doc, text in [(r.doc_id, r.text) for r in odd.where("doc_id <> 9").collect()]:
        ids = len(exact.encode(text or "", add_special_tokens=False).ids) + 1
        assert rows[rows.doc_id == doc].length.sum() == ids
    rows = rows.sort_values(["sequence_id", "offset"])
    ends = rows.offset + rows.length
    assert (ends <= 2048).all() and (ends.groupby(rows.sequence_id).shift().fillna(0) == rows.offset).all()
    assert packing.packed(none, "doc_id", "text", *vocabulary()).count() == 0
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 90, 400), minlength=101)
    plan = packing.completion(counts, 100)
    assert (sum(np.bincount(p, minlength=101) * k for p, k in plan) == counts).all()
    assert sum(k for _, k in plan) <= sum(k for _, k in packing.best_fit(counts, 100))


def test_packing_sends_few_texts_at_once(spark, monkeypatch):
    tokenize = packing.tokenize

    def counted(*given):
        def run(batches):
            def few():
                for batch in batches:
                    assert batch.num_rows <= 1000
                    yield batch

            return tokenize(*given)(few())

        return run

    monkeypatch.setattr(packing, "tokenize", counted)
    docs = spark.range(0, 3000, numPartitions=1).selectExpr("id AS doc_id", "'a few words' AS text")
    assert packing.packed(docs, "doc_id", "text", *vocabulary()).count() == 3000


def test_jaccard(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in jaccard.jaccard_components(docs, "doc_id", "text").collect()}
    sets = {}
    for r in docs.collect():
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    name = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((name[a], name[b]))
                name = {k: low if v == high else v for k, v in name.items()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(sets[d]), name[d]) for d in sets}
    odd_rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd, "doc_id", "text").collect()}
    assert {(1, 2, 1), (5, 2, 1), (10, 2, 1), (2, 0, 2), (3, 0, 3), (9, 1, 9), (None, 2, None)} <= odd_rows
    assert jaccard.jaccard_components(none, "doc_id", "text").count() == 0


def test_jaccard_asks_a_large_group_by_few_pairs(spark, monkeypatch):
    """Texts beyond a group of near copies, by shingles that are frequent elsewhere, are not
    paired with all its members."""
    rng = random.Random(7)
    core, common = [f"c{i}" for i in range(150)], [f"p{i}" for i in range(42)]

    def edited(changes, other=()):
        at = rng.choice([0, 54, 108])
        text = core[:at] + [*other] + core[at + len(other) :]
        for at in rng.sample(range(150), changes):
            text[at] = f"e{rng.randrange(400)}"
        return text

    texts = [edited(1 + i % 2) for i in range(300)] + [edited(1, common) for _ in range(80)]
    texts += [[f"u{i}-{j}" for j in range(60)] + common for i in range(500)]
    counts = {}
    stored = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name, *a, **k: counts.__setitem__(name, stored(df, name, *a, **k)) or counts[name])
    monkeypatch.setattr(jaccard, "passing", lambda spark: contextlib.nullcontext())
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, "doc_id", "text").collect()}
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    assert got == {i: root(i) for i in range(len(texts))}
    assert len(set(got.values())) > 500
    assert counts["near"].count() <= 10 * len(texts)


def test_jaccard_opens_groups_of_mixed_sizes(spark):
    from pyspark.sql import functions as F

    n, y, low, high = (F.col(c) for c in ("n", "y", "low", "high"))
    top = F.floor(n * 100 / 75)
    each = spark.range(1, 61).select(F.col("id").alias("n"))
    sizes = each.select("n", F.explode(F.sequence(F.ceil(n * 0.75), top)).alias("low"))
    sizes = sizes.select("n", "low", F.explode(F.sequence(low, top)).alias("high"))
    inside = sizes.select("*", F.explode(F.sequence(low, high)).alias("y")).select("*", jaccard.need(n, y, 75).alias("need"))
    ranges = inside.groupBy("n", "low", "high").agg(F.min("need").alias("least"))
    checked = ranges.select(
        "least", jaccard.least_need(n, low, high, 75).alias("bound"),
        F.least(jaccard.need(n, low, 75), jaccard.need(n, high, 75)).alias("ends"),
    )
    assert checked.where("ends > least").count() > 0  # the ends of a range are no bound
    assert checked.where("bound > least OR bound < least - 1").count() == 0


def test_repeats_and_chunks(odd, none):
    got = {r.doc_id: r for r in repeats.drop_repeats(odd, "doc_id", "text").collect()}
    assert got[5].text == "" and got[1].n_removed == 0 and got[2].text is None and got[None].n_removed == 0
    assert got[8].text == "new start\n" and got[8].n_removed == 3
    assert repeats.drop_repeats(none, "doc_id", "text").count() == 0
    cut = {r.doc_id: r for r in linechunks.drop_chunks(odd, "doc_id", "text").collect()}
    assert cut[2].text is None and cut[7].n_removed == 0 and cut[4].text == "  \n\t "
    assert linechunks.drop_chunks(none, "doc_id", "text").count() == 0


def test_chunks_by_length_of_passage(spark):
    """Each passage stands in two documents, with own lines around it."""
    rng, rows, at = random.Random(5), [], {}
    for length in (2, 3, 4, 8, 20):
        for _ in range(80):
            passage = [f"shared {rng.random()} line" for _ in range(length)]
            for again in (0, 1):
                a, b = rng.randint(1, 6), rng.randint(1, 6)
                own = [f"own line {rng.random()}" for _ in range(a + b)]
                at[len(rows)] = (length if again else 0, set(range(a, a + length)))
                rows.append((len(rows), "\n".join([*own[:a], *passage, *own[a:]])))
    share = dict.fromkeys((0, 2, 3, 4, 8, 20), 0.0)
    for r in linechunks.drop_chunks(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect():
        length, lines = at[r.doc_id]
        gone = {i for first, n in r.removed for i in range(first, first + n)}
        assert gone <= (lines if length else set())
        whole = rows[r.doc_id][1].split("\n")
        assert r.text == "\n".join(t for i, t in enumerate(whole) if i not in gone) and r.n_removed == len(gone)
        share[length] += len(gone) / len(lines) / 80
    assert share[2] > 0.25 and share[3] > 0.5 and share[4] > 0.7 and share[8] > 0.9 and share[20] > 0.95


def test_chunks_of_one_text(spark):
    texts = ["x\nx\nx\nx\nx\nx", "\n\n\n\n", "a\nb\nc\nd\na\nb\nc\nd", "solo", "solo"]
    rows = {r.doc_id: r for r in linechunks.drop_chunks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()}
    assert all(r.text == "\n".join(texts[d].split("\n")[i] for i in range(r.n_lines) if not any(f <= i < f + n for f, n in r.removed)) for d, r in rows.items())
    assert "x" in rows[0].text and rows[1].n_removed == 0 and {"a", "b", "c", "d"} <= set(rows[2].text) and rows[4].text == "solo"


def test_shards(odd, none):
    rows = sharding.shards(odd, "doc_id", "text", 3).toPandas()
    assert len(rows) == 12 and rows.groupby("text_crc32").shard.nunique().max() == 1
    for _, g in rows.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert sharding.shards(none, "doc_id", "text", 3).count() == 0
    sizes = np.random.default_rng(2).integers(1, 1000, 500).tolist()
    place = sharding.difference(sizes, 8)
    sums = np.bincount(place, weights=sizes, minlength=8)
    assert sums.max() - sums.min() <= 10


def test_fingerprints(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = fingerprints.fingerprints(docs, "doc_id", "text").toPandas().sort_values("doc_id")
    text = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    import hashlib

    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(text, text[1:] + text[:1], strict=True)]
    assert list(rows.edited_sha256) == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    assert rows.near_edited.mean() > 0.5 and rows.near_next.median() < 0.2
    assert rows.groupby(np.array(text)).fingerprint.nunique().max() == 1
    assert fingerprints.fingerprints(odd, "doc_id", "text").count() == 12
    assert fingerprints.fingerprints(none, "doc_id", "text").count() == 0


def test_pages(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class='ad'>buy</div><article><h1>A &amp; B</h1>"
        "<p><b>First<br>part<p>no {}&nbsp;</p><div class=comments>nice</div></article><footer>foot</footer>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(5)] + [(9, None, None), (10, "nonsense", ""), (11, None, "plain <b>text")]
    got = {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html").collect()}
    assert got[3] == "A & B\nFirst part\nno 3" and got[9] == "" and got[10] == ""
    assert pages.main_texts(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "url", "html").count() == 0


def main_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.main_texts(df, "page_id", "url", "html").collect()}


def test_pages_beside_a_list_page(spark):
    page = "<body><div class=x>Aside {0} of varied words</div><article><p>Article {0} goes on</p></article></body>"
    two = "<body><article><p>First card</p></article><article><p>Second card</p></article></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)] + [(7, "http://h.example/7", two)]
    got = main_of(spark, rows)
    assert got == {**{i: f"Article {i} goes on" for i in range(6)}, 7: "First card\nSecond card"}


def test_pages_without_article_names(spark):
    page = (
        "<body><div class=x>Same words on all pages of this host</div><div class=w><h1>Title {0}</h1><div class=lead>Lead {0} of the page</div>"
        "<div class=text><p>Body {0} goes on and on, longer than the lead and the title and all that stands before it</p><p>End {0}</p></div></div></body>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(5)]
    long = "Body {0} goes on and on, longer than the lead and the title and all that stands before it"
    want = {i: "\n".join([f"Title {i}", f"Lead {i} of the page", long.format(i), f"End {i}"]) for i in range(5)}
    assert main_of(spark, rows) == want


def test_templates_come_through_valid_classes(spark):
    """Paths are kept by their class, and pages are not parsed again for each step."""
    rows = [(f"h{h}", p, n, k, 10 + n, d, 1, n, n) for h in range(2) for n in range(4) for p, k, d in (("/a", 1, 1), ("/a/b", 1, 2), ("/a/c", n % 2 + 1, 2))]
    schema = "host string, path string, number long, n long, chars long, depth long, role long, mark long, whole long"
    found = pages.templates(spark.createDataFrame(rows, schema).mapInPandas(lambda batches: batches, schema))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "together" not in plan and "vector" in plan
    assert {(r.host, r.main) for r in found.collect()} == {("h0", "/a/b"), ("h1", "/a/b")}


def test_only_texts_with_missed_shingles_are_read_again(spark):
    J, words = jaccard, [[f"d{n}w{k}" for k in range(30)] for n in range(60)]
    for n, w in enumerate(words):
        w[n % 20 : n % 20] = [f"common{k}" for k in range(8)] if n % 4 else [f"pair{n // 8}x{k}" for k in range(6)]
    texts = [" ".join(w) for w in words] + [" ".join(words[0]), "too short", "", None]
    none = (np.zeros(0, J.U), np.zeros(0, np.int64))

    def rare(order):
        found = collections.defaultdict(set)
        for _, _, _, c, row, grams in J.rare_ones(5, 0.75, *order, pa.array(texts), np.ones(len(texts), bool), set()):
            for r, g in zip(row, grams.view(np.int64).tolist()):
                found[g].add(int(c[r]))
        return found

    often = {g: len(cs) for g, cs in rare(none).items() if len(cs) >= J.MISSED}
    assert often
    tokens = np.sort(np.array(list(often), np.int64).view(J.U))
    order = tokens, np.array([often[int(t)] for t in tokens.view(np.int64)])
    expected = {(g, c) for g, cs in rare(order).items() if len(cs) > 1 for c in cs}
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").repartition(1)
    sent = rows.mapInArrow(J.sized(5, 0.75, *none), "doc_id long, n long, c long, tokens array<long>")
    got = [(r.token, r.c) for r in J.class_posts(sent, rows, none, 5, 0.75).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_fingerprints_sample_two_forms_a_row(spark):
    """The text behind a bucket is a row of its own, not a third set of samples of every row."""
    rows = [(510, "alpha beta gamma"), (511, "same words here now"), (512, "same words here now"), (513, None)]
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    with settings(spark, {"spark.sql.debug.maxToStringFields": "1000"}):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min(greatest(") == 2 * fingerprints.SAMPLES
    got = {r.doc_id: r for r in found.collect()}
    assert sorted(got) == [510, 511, 512, 513] and got[511].near_next == 1.0 and got[512].near_next == 0.0
    assert got[511].fingerprint == got[512].fingerprint and got[513].n_chars == 0
