"""Divergence audit, license scan and Merkle manifest: SQL, brute force, edge cases."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from tidemark.llm import divergence as D
from tidemark.llm import licenses as L
from tidemark.llm import merkle as M

SF01 = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def oracle(sql, documents):
    con = duckdb.connect()
    if isinstance(documents, str):
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents}'")
    else:
        con.register("documents", documents)
    return sorted(con.execute(sql).fetchall(), key=str)


def awkward_table(names):
    at = {"doc_id": 0, "text": 1, "lang": 2, "source": 3}
    n_chars = [None if r[1] is None else len(r[1]) for r in AWKWARD]
    return pa.table({n: pa.array([r[at[n]] for r in AWKWARD] if n in at else n_chars, pa.int64() if n in ("doc_id", "n_chars") else pa.string()) for n in names})


# ------------------------------------------------------------------ divergence


@pytest.mark.parametrize("sizes", [None, (64, 3)], ids=["one block", "many blocks and slices"])
def test_divergence_equals_sql(lspark, monkeypatch, sizes):
    if sizes:
        monkeypatch.setattr(D, "SLICE_ROWS", sizes[0])
        monkeypatch.setattr(D, "BLOCK", sizes[1])
    got = rows_of(D.op11_source_divergence_audit(lspark, SF01))
    assert got == oracle(D.SQL, f"{SF01}/documents.parquet")
    assert {r[2] for r in got} == {"pair", "term"}


def test_divergence_of_awkward_rows(lspark, awkward, nothing):
    """Groups without terms or without kept terms, null languages and sources, one source only."""
    assert rows_of(D.audit(awkward)) == oracle(D.SQL, awkward_table(("doc_id", "text", "lang", "source")))
    assert D.audit(nothing).collect() == []
    # every term is kept: nulls, ties by UTF-8 order, a term that one source lacks
    rows = [("b é B, x2y", "en", "s1"), ("b b", "en", "s2"), (None, "en", None), ("ß", None, "s1"), ("a-b_c É", "en", "s1")] * 10
    docs = lspark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS idx", "2 AS p", "3 AS term", "'k' AS value")
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(("text", "lang", "source"))})
    got = rows_of(D.audit(docs))
    assert got == oracle(D.SQL, table)
    assert {r[3] for r in got if r[2] == "term" and r[0] == "en"} <= {"a", "b", "c", "x", "y", "é", "É"}


def test_terms_are_those_of_the_pattern(texts):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text in [t for _, t in texts] + ["".join(map(chr, range(1, 700))), "", None, "É À x"]:
        want = Counter(w.encode() for w in word.findall((text or "").translate(upper)))
        assert D.term_counts(text) == want


def test_shares_stay_exact_for_huge_counts(lspark):
    row = lspark.range(1).select(D.share(F.lit(10**17), F.lit(3 * 10**18), F.lit(10**9)).alias("p")).first()
    assert row["p"] == 1 + (10**9 * (10**17 + 2)) // (3 * 10**18 + 2 * 10**9)


def test_held_counts_are_sent_on(monkeypatch):
    """A task that sends its counts on early reports the same sums."""
    batch = pa.record_batch({"lang": ["en"] * 50, "source": ["a", "b"] * 25, "text": [f"x y{chr(97 + i % 26)} x" for i in range(50)]})

    def sums():
        n = Counter()
        for b in D._count(iter([batch, batch])):
            for r in b.to_pylist():
                n[r["lang"], r["source"], r["term"]] += 1000 * r["n"] + r["docs"]
        return n

    want = sums()
    monkeypatch.setattr(D, "HELD", 3)
    assert sums() == want and want["en", "a", "x"] == 1000 * 100 + 50


# ------------------------------------------------------------------ licenses


def plain_words(text):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(upper))


def plain_base(text):
    words = plain_words(text)
    found = []
    for phrase, label in L.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_phrases_equal_brute_force(lspark):
    docs = lspark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in L.op12_license_scan(lspark, SF01).collect()}
    assert len(got) == len(docs)
    named = 0
    for doc_id, text in docs:
        r = got[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_base(text)
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert r["labels"] == ",".join(sorted(r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == (r["labels"] != "")
        named += r["n_base"] > 0
    assert named


LINES = {
    "Licensed under CC BY-NC 4.0.": {"cc-by", "cc-by-nc-4.0"},
    "This work is licensed under the GNU General Public License, version 3.": {"gpl", "gpl-3"},
    "Licensed under the Apache License, Version 2.0.": {"apache-2.0"},
    "Released under the MIT license.": {"mit"},
    "ALL RIGHTS RESERVED": {"reserved"},
    "GNU Lesser General Public License v2.1 or later": {"gpl", "lgpl-2.1"},
    "SPDX-License-Identifier: BSD-3-Clause": {"bsd-3-clause"},
    "SPDX-License-Identifier: MPL-2.0": {"mpl-2.0"},
    "the summit, bylaws, ccby, general public licenses": set(),
    "Tous droits réservés": {"reserved"},
    "Permission is hereby granted, free of charge, to any person obtaining a copy": {"mit"},
}


def test_named_licenses():
    scanner = L.Scanner(L.production_rules(), L.BASE)
    for line, want in LINES.items():
        _, places, found = scanner.scan(line)
        labels = {x for x, _ in places} | {scanner.rules[i].label for *_, i in found}
        assert want <= labels <= want | {"reference"}, (line, labels)
    assert len(scanner.rules) > 200


def test_prefilter_loses_no_detection(texts):
    """Every rule, untried ones too, on every text and line: a match implies a keyword."""
    rules = L.production_rules()
    for text in [*LINES, *(s + " " + t for s, t in zip(LINES, [t[:400] for _, t in texts]))]:
        words = L.words_of(text)
        for r in rules:
            if r.pattern.search(b" ".join(words)):
                assert set(r.keywords) & set(words), (r, text)


def test_suppression_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        found = [(rnd.randint(1, 3), a := rnd.randint(0, 12), a + rnd.randint(1, 6), rnd.randint(0, 4)) for _ in range(rnd.randint(0, 25))]
        found = list(dict.fromkeys(found))

        def before(e, d):
            return (e[0], -(e[2] - e[1]), e[3]) < (d[0], -(d[2] - d[1]), d[3])

        want = {d for d in found if not any(e is not d and e[1] <= d[1] and d[2] <= e[2] and before(e, d) for e in found)}
        assert {found[i] for i in L.resolve(found)} == want


def test_scan_of_awkward_rows(lspark, awkward, nothing):
    got = {(r["doc_id"], r["n_words"]): r for r in L.scan_licenses(awkward).collect()}
    assert {k: r["labels"] for k, r in got.items() if k[1] == 0} == {(1, 0): [], (2, 0): [], (3, 0): []}
    assert L.scan_licenses(awkward).count() == len(AWKWARD)
    assert all(r["score"] == 0 and r["first_word"] is None for r in got.values())
    assert L.scan_licenses(nothing).collect() == []
    # overlapping places, ties, a very long text; rules of one's own
    text = "cc by cc by " + "x " * 60_000 + "General-Public\nLicense"
    docs = lspark.createDataFrame([(7, text), (7, text), (None, "aa aa aa")], "doc_id long, text string").selectExpr("*", "1 AS labels", "2 AS score")
    rows = L.scan_licenses(docs, [L.rule("twice", L.NAME, "aa", "aa aa")], (*L.BASE, ("aa aa", "pair"))).collect()
    seven = [r for r in rows if r["doc_id"] == 7]
    assert len(seven) == 2 and seven[0] == seven[1]
    assert (seven[0]["n_base"], seven[0]["first_word"], seven[0]["last_word"]) == (3, 0, 60_004)
    (other,) = [r for r in rows if r["doc_id"] is None]
    assert other["n_base"] == 2 and other["labels"] == ["pair", "twice"]
    assert [(d["first"], d["end"]) for d in other["detections"]] == [(0, 2)]


# ------------------------------------------------------------------ Merkle manifest


def plain_manifest(rows):
    """Per row (in order of source, id): leaf, subroot, root, proof, all hexadecimal."""

    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def out(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for leaf, own in enumerate(at):
                run = nodes[own // 3 * 3 : own // 3 * 3 + 3]
                paths[leaf].append((run[: own % 3], run[own % 3 + 1 :]))
            nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
            at = [i // 3 for i in at]
        return nodes[0], paths

    def leaf(r):
        return h(*map(out, r))

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        per[s] = mine, *tree([leaf(r) for r in mine])
    root, tops = tree([per[s][1] for s in sources])
    for s, top in zip(sources, tops):
        mine, subroot, paths = per[s]
        for r, path in zip(mine, paths):
            yield r, leaf(r), subroot, root, path + top


def fold_hex(leaf, path):
    for left, right in path:
        leaf = hashlib.sha256("".join([*left, leaf, *right]).encode()).hexdigest()
    return leaf


def test_manifest_equals_sql(lspark, monkeypatch):
    want = oracle(M.SQL, f"{SF01}/documents.parquet")
    assert rows_of(M.op13_merkle_manifest(lspark, SF01)) == want
    assert {r[-1] for r in want} == {True, False}
    monkeypatch.setattr(M, "BAND", 2)  # many bands
    assert rows_of(M.op13_merkle_manifest(lspark, SF01)) == want


@pytest.mark.parametrize("size", [1, 4, 28])
def test_proofs_of_any_size(lspark, monkeypatch, size):
    """Runs of one at every level; whole and short last runs; one source or several."""
    monkeypatch.setattr(M, "BAND", 2)
    rows = [(i * 7 % 101, "s" if i % 5 else None, "en", i, f"text {i}\né") for i in range(size)]
    docs = lspark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = {r["doc_id"]: r for r in M.manifest(docs, F.lit("another text"), with_proofs=True).collect()}
    assert len(got) == size
    for r, leaf, subroot, root, path in plain_manifest(rows):
        g = got[r[0]]
        assert (g["leaf"].hex(), g["subroot"].hex(), g["root"].hex()) == (leaf, subroot, root)
        siblings = [x for left, right in path for x in (*left, *right)]
        assert M.siblings_of(bytes(g["proof"])).hex() == "".join(siblings)
        assert g["proof_digest"].hex() == hashlib.sha256("".join(siblings).encode()).hexdigest()
        assert M.fold(bytes(g["leaf"]), bytes(g["proof"])) == bytes(g["root"]) != bytes(g["folded"])
        changed = hashlib.sha256("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*r[:4], "another text")).encode()).hexdigest()
        assert g["folded"].hex() == fold_hex(changed, path)


def test_manifest_of_awkward_rows(lspark, awkward, nothing, tmp_path):
    rows = awkward.withColumn("n_chars", F.length("text").cast("long")).withColumn("lo", F.lit(1)).withColumn("n", F.lit("x")).withColumn("tree", F.lit(2))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op13_merkle_manifest(lspark, str(tmp_path))
    assert rows_of(got) == oracle(M.SQL, awkward_table(("doc_id", "text", "lang", "source", "n_chars")))
    assert M.manifest(nothing.withColumn("n_chars", F.lit(0))).collect() == []


def test_manifest_buckets_stay_small(lspark):
    """A source that holds nearly all rows is cut into buckets of at most 243 leaves."""
    docs = lspark.range(3000).selectExpr("id AS doc_id", "if(id % 100 = 0, 't', 's') AS source", "'en' AS lang", "id AS n_chars", "string(id) AS text")
    plan = M.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "bucket" in plan
    got = M.manifest(docs).collect()
    assert len(got) == 3000 and len({r["subroot"] for r in got}) == 2 and all(r["folded"] == r["root"] for r in got)
