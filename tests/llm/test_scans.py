"""Licence scans, periodic runs and the manifest against brute force and awkward rows."""

import random
import re
import zlib
from hashlib import sha256

import pytest

import compare
from mailflow.llm import licenses, manifest, runs
from mailflow.llm.queries import ORACLES, QUERIES

ROWS = "doc_id long, text string, source string, lang string, n_chars long, tree string, idx int, path string, leaf int, runs int"


def rows_of(spark, texts, langs=("en", None, "de")):
    rows = [(i, t, None if i % 4 == 0 else f"s{i % 3}", langs[i % len(langs)], None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(*r, "x", 1, "p", 2, 3) for r in rows], ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ROWS)


# --- periodic runs -------------------------------------------------------------


def brute_runs(w, least, times):
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, times * q) and not any((s, i + q - s, d) in out for d in range(1, q)):
                out.add((s, i + q - s, q))
            i = max(i, s) + 1 if i == s else i
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "x", "a " * 3000 + "b", "Ab ab " * 9, "a\x0bb\x0ca b\ta b\r\na b", "u v u v u v u v", "é é é é é é"]
    for _ in range(200):
        n, letters = rng.choice([5, 6, 7, 20, 60]), "abcdefg"[: rng.choice([1, 2, 3, 5])]
        w = [rng.choice(letters) for _ in range(n)]
        if rng.random() < 0.5:
            p, a = rng.randint(1, 6), rng.randint(0, 4)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            w = w + ["z"] + w
        texts.append(rng.choice(["  ", " ", "\n"]).join(w))
    return texts


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (1, 3)])
def test_runs(spark, least, times):
    texts = periodic_texts()
    got = {r.doc_id: r for r in runs.find_runs(rows_of(spark, texts), "doc_id", "text", least, times).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        wanted = brute_runs(w, least, times)
        assert [tuple(r) for r in got[i].runs] == wanted, text
        gone = {x for s, n, q in wanted for x in range(s + q, s + n)}
        assert (got[i].n_words, got[i].left) == (len(w), " ".join(x for j, x in enumerate(w) if j not in gone))


def test_runs_digests(spark, tmp_path):
    texts = periodic_texts()
    rows_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    changed = 0
    for i, text in enumerate(texts):
        w, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
            changed += 1
        wanted = brute_runs(w, 6, 4)
        gone = {x for s, n, q in wanted for x in range(s + q, s + n)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        best = min(wanted, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = got[i]
        assert (row.n_runs, row.start, row.length, row.period) == (len(wanted), *best)
        assert row.exponent_milli == (best[0] if best[0] is None else 1000 * best[1] // best[2])
        assert row.runs_sha256 == sha256("".join(f"{s},{n},{q}\n" for s, n, q in wanted).encode()).hexdigest()
        assert row.collapsed_sha256 == sha256(left.encode()).hexdigest()
    assert changed > 5


def test_runs_of_awkward_rows(spark, none):
    assert runs.find_runs(none, "doc_id", "text").count() == 0
    twice = rows_of(spark, ["a a a a a a"] * 2)
    rows = twice.unionByName(twice.selectExpr("CAST(NULL AS long) AS doc_id", *twice.columns[1:]))
    got = runs.find_runs(rows, "doc_id", "text").collect()
    assert len(got) == 4 and all([tuple(x) for x in r.runs] == [(0, 6, 1)] and r.left == "a" for r in got)
    long = " ".join(f"w{i % 70_000}" for i in range(300_000))
    row = runs.find_runs(rows_of(spark, [long]), "doc_id", "text").first()
    assert [tuple(x) for x in row.runs] == [(0, 300_000, 70_000)] and row.left.count(" ") == 69_999


# --- licences ------------------------------------------------------------------


def plain_words(text):
    low = (text or "").translate(licenses.CASE)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_places(w):
    return sorted(
        (i, label) for words, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(words.split())] == words.split()
    )


def test_licences(spark, tmp_path):
    rng = random.Random(2)
    parts = [*licenses.BASE, *licenses.NOTICES, *licenses.GRANTS, "CC BY", "Apache-License", "MIT\nLicense", "mitlicense", "é", "a", "and", "or", "CC", "by"]
    texts = [None, "", "!?", "cc by cc by cc", "MIT LICENSE", "İ mit license", "mit license" + " x" * 50_000 + " cc by"]
    texts += [rng.choice([" ", ", ", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    rows_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_license_scan"](spark, str(tmp_path)).collect()}
    phrases = {w: x for w, (x, _) in licenses.NOTICES.items()} | licenses.BASE
    for i, text in enumerate(texts):
        w, row = plain_words(text), got[i]
        at = base_places(w)
        first, last = (at[0][0], at[-1][0]) if at else (None, None)
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(w), len(at), first, last), text
        assert row.base_labels == ",".join(sorted({x for _, x in at}))
        joined = f" {' '.join(w)} "
        named = {label for words, label in phrases.items() if f" {words} " in joined}
        named |= {label for words, label in licenses.BASE.items() if f" {words} " in joined}
        assert set(row.labels.split(",")) - {""} == named
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(named)


@pytest.mark.parametrize(
    "text,postfix,duty",
    [
        ("MIT", "MIT", "permissive"),
        ("MIT OR GPL-2.0-only AND Apache-2.0", "MIT GPL-2.0-only Apache-2.0 and or", "permissive"),
        ("(MIT OR GPL-2.0-only) AND LGPL-3.0+", "MIT GPL-2.0-only or LGPL-3.0+ and", "weak copyleft"),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0", "GPL-2.0-or-later Classpath-exception-2.0 with", "weak copyleft"),
        ("GPL-2.0 with X or MIT and Acme-1", "GPL-2.0 X with MIT Acme-1 and or", "weak copyleft"),
        ("(MIT", "MIT", "permissive"),
        ("MIT OR", "MIT", "permissive"),
        ("MIT AND (", "MIT", "permissive"),
        ("MIT) OR GPL-3.0", "MIT", "permissive"),
        ("MIT see the file", "MIT", "permissive"),
        ("CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0", "restricted"),
        ("Acme-Commercial-1", "Acme-Commercial-1", "unknown"),
    ],
)
def test_expressions(text, postfix, duty):
    found = licenses.expression(text)
    assert (found[0], licenses.DUTIES[found[2]]) == (postfix, duty)


@pytest.mark.parametrize("text", ["", "AND MIT", "()", ")", "( AND", "or"])
def test_no_expression(text):
    assert licenses.expression(text) is None


def test_tags_and_notices(spark, none):
    assert licenses.scan_licenses(none, "doc_id", "text").count() == 0
    texts = [
        "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nNext line AND GPL-3.0",
        "SPDX-License-Identifier: Acme\nx\nSPDX-LICENSE-IDENTIFIER: GPL-3.0-only", "SPDX-License-Identifier:",
        "Use it under the MIT License or the Apache License, Version 2.0.", "The MIT License. Later: the Apache License.",
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(rows_of(spark, texts), "doc_id", "text").collect()}
    said = lambda i: [(e.text, e.duty) for e in got[i].expressions]
    assert said(0) == [("MIT Apache-2.0 or BSD-3-Clause and", "permissive")]
    assert said(1) == [("Acme", "unknown"), ("GPL-3.0-only", "copyleft")]
    assert said(2) == [] and said(4) == []
    assert said(3) == [("mit apache-2.0 or", "permissive")]
    assert got[0].score >= 0.95 and got[0].score > got[4].score > got[2].score == 0


# --- manifest ------------------------------------------------------------------


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, fields, tampered):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row, by plain loops."""
    def leaf(r):
        return digest(*["-" if r[f] is None else f"{len(str(r[f]).encode())}:{r[f]}" for f in fields])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def fold(levels, at, node):
        proof = ""
        for level in levels[:-1]:
            run, slot = level[at - at % 8 : at - at % 8 + 8], at % 8
            proof += "".join(run[:slot] + run[slot + 1 :])
            node, at = digest(*run[:slot], node, *run[slot + 1 :]), at // 8
        return proof, node

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))
        groups[g].sort(key=key)
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            a, node = fold(trees[g], at, leaf(tampered(r)))
            b, node = fold(top, k, node)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], digest(a + b), node, node == top[-1][0]))
    return sorted(out, key=str)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def lowered(r):
    hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
    return {**r, "text": r["text"].translate(licenses.CASE)} if hit and r["text"] is not None else r


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (9, [None]), (700, ["en", None, "de"]), (4700, ["en"]), (40, [f"l{i}" for i in range(13)]), (1200, [f"é{i}" for i in range(600)])])
def test_manifest(spark, tmp_path, n, langs):
    texts = [None if i % 11 == 3 else "" if i % 13 == 5 else f"Über Text {i} " * (i % 3) for i in range(n)]
    df = rows_of(spark, texts, langs)
    if n == 700:  # copies, rows that only share a key, and rows without one
        df = df.union(df.where("doc_id < 50")).union(df.where("doc_id > 680").selectExpr("1 AS doc_id", *df.columns[1:]))
        df = df.union(df.where("doc_id BETWEEN 90 AND 99").selectExpr("CAST(NULL AS long) AS doc_id", *df.columns[1:]))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in df.collect()]
    got = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_manifest(rows, FIELDS, lowered)
    if n == 4700:
        assert compare.difference(QUERIES["op13_merkle_manifest"](spark, str(tmp_path)), duck(tmp_path), ORACLES["op13_merkle_manifest"]) is None


def duck(path):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    return con


def test_manifest_of_nothing(spark, none):
    assert manifest.manifest(none, "doc_id", "lang", FIELDS).count() == 0
    untouched = manifest.manifest(rows_of(spark, ["a", "b", None]), "doc_id", "lang", FIELDS).collect()
    assert len(untouched) == 3 and all(r.verified for r in untouched)
