"""The pipeline's stages on awkward rows, against brute force."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from mailflow.llm import graph, jaccard, linechunks, packing
from mailflow.llm.queries import vocabulary
from mailflow.llm.store import passing, stored

ROWS = "doc_id long, text string, lang string, source string, n_chars long, lines string, c int, n int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "other")
    rows = [
        (5, base, "a"), (2, near, "a"), (7, base, "b"), (7, base, "b"), (None, base, None), (None, "only text without id here", "c"),
        (None, "only text without id here", "c"), (8, None, "a"), (9, "", "a"), (10, "one two three", None), (10, "else four words here", "b"),
        (11, "first line of a passage here\nsecond line of it\nthird one\nown", "a"),
    ]
    return spark.createDataFrame([(d, t, "en", s, None if t is None else len(t), "x", 1, 2) for d, t, s in rows], ROWS)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_copies_stage(spark, sf, docs):
    got = pipeline.drop_near_copies(spark, docs, sf)
    assert got.columns == docs.columns
    base = [r.text for r in docs.where("doc_id = 2").collect()][0]
    assert kept(got) == sorted([
        (2, base), (None, "only text without id here"), (8, None), (9, ""), (10, "one two three"), (10, "else four words here"),
        (11, "first line of a passage here\nsecond line of it\nthird one\nown"),
    ], key=str)


def test_line_stage_keeps_columns_and_rows(spark, sf, docs):
    got = pipeline.drop_repeated_chunks(spark, docs, sf)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.lines == "x" and r.c == 1 for r in got.collect())


def test_toxic_stage_judges_each_row_by_its_text(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # enough labels to reject some
    given = spark.read.parquet(f"{sf}/documents.parquet")
    more = given.selectExpr("CAST(NULL AS long) AS doc_id", *given.columns[1:])
    both = given.unionByName(more).withColumn("extra", F.lit(1))
    got = [(r.doc_id, r.text) for r in pipeline.drop_toxic(spark, both, sf).collect()]
    named, nameless = [t for d, t in got if d is not None], [t for d, t in got if d is None]
    assert sorted(map(str, named)) == sorted(map(str, nameless)) and 0 < len(named) < given.count()


def test_mix_stage(spark, sf, docs):
    got = pipeline.mix_sources(spark, docs, sf)
    assert got.columns == docs.columns
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
    sources = sorted((s for s in size if s is not None)) + [None]
    weight = dict(zip(sources, [3, 1, 2, 3]))
    total, target, free = 1.5 * sum(size.values()), dict.fromkeys(size, 0.0), set(size)
    while total > 1e-9 and free:
        share = {s: total * weight[s] / sum(weight[f] for f in free) for s in free}
        total = 0.0
        for s in list(free):
            target[s] += share[s]
            if target[s] >= 2 * size[s]:
                total += target[s] - 2 * size[s]
                target[s] = 2 * size[s]
                free.discard(s)
    taken = {}
    for r in got.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
    largest = max(len(words(r.text)) for r in docs.collect())
    assert all(abs(taken.get(s, 0) - target[s]) <= largest for s in size)


def test_special_tokens_and_checksums(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endof text|>", "é 日本 \n\n tail ", "x " * 5000 + "<|endoftext|>", None]
    rows = packing.packed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", *vocabulary()).collect()
    for doc, text in enumerate(texts):
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc)
        assert sum(n for _, _, n, _ in mine) == len(ids)
        assert all(c == zlib.crc32(ids[a : a + n].tobytes()) for _, a, n, c in mine)


def test_stages_of_nothing(spark, sf, docs):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


@pytest.fixture
def tables_left(monkeypatch, tmp_path):
    """Gives a function: names of the tables that ``work`` leaves in the shared folder, and its rows."""
    def run(name, work):
        monkeypatch.setattr("mailflow.session.shared_root", lambda spark: str(tmp_path / name))
        rows = work().collect()
        return sorted(re.sub(r"-\w{12}\Z", "", p.name) for p in (tmp_path / name / "mailflow").iterdir()), rows

    return run


def test_passing_tables_go(spark, tables_left):
    def work():
        with passing(spark):
            with passing(spark):
                inner = stored(spark.range(3), "inner")
                outer = stored(inner.selectExpr("id + 1 AS id"), "outer", stays=True)
            return stored(outer.selectExpr("id * 2 AS id"), "left", stays=True)

    left, rows = tables_left("p", work)
    assert left == ["llm-left"] and sorted(r.id for r in rows) == [2, 4, 6]


def test_stages_leave_small_tables(spark, sf, tables_left, docs):
    left, _ = tables_left("a", lambda: pipeline.drop_near_copies(spark, docs, sf))
    assert left == ["llm-copies", "llm-twice"]
    left, _ = tables_left("b", lambda: pipeline.mix_sources(spark, docs, sf))
    assert left == ["llm-taken", "llm-twice"]
    left, _ = tables_left("c", lambda: jaccard.jaccard_components(docs, "doc_id", "text"))
    assert left == ["llm-classes", "llm-grouped", "llm-sets"]


def test_components_take_no_round_to_see_the_end(spark, tables_left, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "stored", lambda df, name, **more: (written.append(name), stored(df, name, **more))[1])
    stars = spark.createDataFrame([(1, 5), (5, 1), (6, 1), (3, 8), (4, 4), (None, 2)], "src long, dst long")
    left, rows = tables_left("g", lambda: graph.components(stars))
    assert left == ["llm-components"] and written == ["edges", "lows", "components"]
    assert sorted(map(tuple, rows)) == [(1, 1), (3, 3), (5, 1), (6, 1), (8, 3)]
    path = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(7, 7), (30, 3)], "src long, dst long")
    left, rows = tables_left("h", lambda: graph.components(path))
    assert left == ["llm-components"] and sorted(map(tuple, rows)) == [(i, 0) for i in range(41)]


def test_links_of_a_round_join_the_groups_of_those_before(spark):
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5)], "c long, g long")
    links = spark.createDataFrame([(2, 4), (1, 2)], "a long, b long")
    assert sorted(map(tuple, jaccard.merged(links, groups).collect())) == [(1, 1), (3, 1)]
    assert sorted(map(tuple, jaccard.merged(links, None).collect())) == [(1, 1), (2, 1), (4, 1)]


def test_texts_meet_marks_alike_at_any_size(spark, tables_left):
    """No table of marks is broadcast: what shuffles grows with the texts from the first."""
    given = spark.createDataFrame([(1, 5, "a\nb"), (2, 6, "a\nb")], "doc_id long, own_hash long, text string")
    plan = linechunks.marked(given)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    left, rows = tables_left("l", lambda: linechunks.drop_chunks(given, "doc_id", "text"))
    assert left == ["llm-chunk-ranges", "llm-chunks"] and sorted(r.n_removed for r in rows) == [0, 2]
