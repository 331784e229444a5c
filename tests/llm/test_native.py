"""Mixing and URL filter: DataFrame plans against DuckDB, edge cases, no Python in plans."""

from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from tidemark.llm import mixing as M
from tidemark.llm import urls as U

SF01 = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, value in tables.items():
        if isinstance(value, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{value}'")
        else:
            con.register(name, value)
    return sorted(con.execute(sql).fetchall(), key=str)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_mixing_equals_sql(lspark):
    got = M.op1_mixing_sources(lspark, SF01)
    no_python(got)
    assert rows_of(got) == oracle(M.SQL, documents=f"{SF01}/documents.parquet")


def test_mixing_equals_sql_on_awkward_rows(lspark, awkward, nothing):
    names = ("doc_id", "text", "lang", "source")
    docs = pa.table({n: pa.array([r[i] for r in AWKWARD], pa.int64() if i == 0 else pa.string()) for i, n in enumerate(names)})
    assert rows_of(M.mix(awkward, M.source_domain(F.col("source")))) == oracle(M.SQL, documents=docs)
    assert M.mix(nothing, M.source_domain(F.col("source"))).collect() == []


def test_buckets_do_not_change_the_prefix(lspark, monkeypatch):
    want = rows_of(M.op1_mixing_sources(lspark, SF01))
    monkeypatch.setattr(M, "BUCKET_ROWS", 3)
    assert rows_of(M.op1_mixing_sources(lspark, SF01)) == want


def test_shortage_goes_to_siblings_before_ancestors(lspark):
    """d0/en is short of tokens: d0/fr makes it up; d1 gets no more than its share."""
    rows = [("d0", "en", "a", 10, 100), ("d0", "fr", "b", 10, 900), ("d1", "en", "c", 10, 1000)]
    leaves = lspark.createDataFrame(rows, "domain string, lang string, source string, docs long, tokens long")
    got = {r["source"]: r["budget"] for r in M.budgets(leaves, M.LEVELS, ({}, {}, {}), 1000, 1).collect()}
    assert got == {"a": 100, "b": 400, "c": 500}
    # d0 as a whole is short: only then does d1 take the rest
    got = {r["source"]: r["budget"] for r in M.budgets(leaves, M.LEVELS, ({"d0": 9}, {}, {}), 1500, 1).collect()}
    assert got == {"a": 100, "b": 900, "c": 500}
    # epochs raise what a leaf can give; weight zero gives nothing
    got = {r["source"]: r["budget"] for r in M.budgets(leaves, M.LEVELS, ({"d1": 0}, {}, {}), 1500, 4).collect()}
    assert got == {"a": 400, "b": 1100, "c": 0}


def test_weight_zero_below_the_top_adds_no_capacity(lspark):
    """d0 can spend on en only: what its share lacks goes to d1."""
    rows = [("d0", "en", "a", 10, 100), ("d0", "fr", "b", 10, 900), ("d1", "en", "c", 10, 1000)]
    leaves = lspark.createDataFrame(rows, "domain string, lang string, source string, docs long, tokens long")
    got = {r["source"]: r["budget"] for r in M.budgets(leaves, M.LEVELS, ({}, {"fr": 0}, {}), 1000, 1).collect()}
    assert got == {"a": 100, "b": 0, "c": 900}
    got = {r["source"]: r["budget"] for r in M.budgets(leaves, M.LEVELS, ({}, {}, {"b": 0}), 1000, 1).collect()}
    assert got == {"a": 100, "b": 0, "c": 900}


def test_prefix_meets_each_budget(lspark):
    got = M.op1_mixing_sources(lspark, SF01).groupBy(*M.LEVELS).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n"), F.max("n_tokens").alias("m"), F.sum("n_tokens").alias("all"))
    leaves = M.op1_mixing_sources(lspark, SF01).groupBy(*M.LEVELS).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] * 4 // 5
    plan = {tuple(r)[:3]: r["budget"] for r in M.budgets(leaves, M.LEVELS, M.WEIGHTS, total, M.MAX_EPOCHS).collect()}
    for r in got.collect():
        budget = plan[r["domain"], r["lang"], r["source"]]
        assert budget <= r["n"] < budget + max(r["m"], 1) and r["n"] <= M.MAX_EPOCHS * r["all"]
    assert total - 200 <= sum(plan.values()) <= total


def test_urls_equal_sql(lspark):
    got = U.op2_url_filter(lspark, SF01)
    no_python(got)
    rows = rows_of(got)
    assert rows == oracle(U.SQL, pages=f"{SF01}/pages.parquet")
    assert len({r[4] for r in rows}) == 2


def canonical(url):
    return f'<html><head><link href="{url}" rel="canonical"></head>'


PAGES = [
    (1, "http://a.example.net/x", "<link rel=canonical href=/y>"),
    (2, "http://a.example.net/y", canonical("//b.example.org/es/1")),
    (3, "http://b.example.org/es/1#q", None),
    (4, None, "x"),
    (5, "nourl", ""),
    (6, "HTTP://A.example.net/z?a=1#t", "<meta http-equiv='refresh' content='0; url=../x'>"),
    (7, "http://q.net", canonical("http://w.net/")),
    (8, "http://w.net/", canonical("http://ex.com/fr/3")),
    (9, "http://ex.com/de/1", canonical("http://w.net/")),
    (None, "http://a.example.net/x", ""),
    (10, "http://k.com/de/1", canonical("http://l.net/?p=1&amp;q=2")),
    (11, "http://L.net?p=1&q=2#z", "<p>"),
    (12, "http://www.example.org", ""),
    (13, "http://v.net/m/n", "<META HTTP-EQUIV=refresh CONTENT='3;URL=o'>"),
    (14, "http://v.net/m/o", canonical("?z")),
    (15, "http://v.net/m/o?z", canonical("http://k.com/de/1")),
    (15, "http://v.net/m/o?z", canonical("mailto:x@y")),
    (16, "http://c.net/1", f"<!-- {canonical('http://k.com/de/1')} --><link data-rel='canonical' href='http://k.com/de/1'>"),
    (17, "http://c.net/2", "<link rel=canonical title='href=/9' data-href=http://c.net/1 href=http://k.com/de/1><!-- open"),
    (18, "http://c.net/3", '<base target=x><base href="http://K.com:80/de/0?b"><base href=/no><link rel="alternate Canonical"href="1">'),
    (19, "https://p.net/a", canonical("HTTPS://P.net:443/x/../b")),
    (20, "https://p.net:443/b", canonical("https://p.net:80/c")),
    (21, "https://p.net:80/c", canonical("http://p.net:80/./d/.")),
    (22, "http://p.net/d/", "<meta content='0;url=http://ex.com:/de/2' http-equiv=' refresh '>"),
    (23, "http://ex.com:/de/2", "<link rel=canonical><link rel=canonical href=''><link rel=canonical href=#x><link rel=canonically href=http://w.net>"),
    (24, "http://c.net/4", "<!-- canonical --><link title='a rel=canonical b' href=http://k.com/de/1><meta http-equiv=refresh data-url=http://k.com/de/1 content=5>"),
    (25, "http://c.net/5", "<!-- <link rel=canonical href=http://k.com/de/1>"),
]


def test_redirect_equivalence_equals_sql(lspark, tmp_path):
    """The query and its SQL on every kind of alias, and on a chain of 1,000 pages."""
    chain = [(100 + i, f"http://chain{i % 7}.net/p/{i}", canonical(f"//CHAIN{(i + 1) % 7}.net:80/p/x/../{i + 1}")) for i in range(1000)]
    chain.append((1100, f"http://chain{1000 % 7}.net/p/1000", canonical("http://k.com/de/1")))
    rows = PAGES + chain[-60:]  # the closure of the SQL grows with the square of a chain
    schema = "page_id long, url string, html string"
    lspark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/pages.parquet")
    got = U.op2_url_filter(lspark, str(tmp_path))
    no_python(got)
    got = rows_of(got)
    assert got == oracle(U.SQL, pages=f"{tmp_path}/pages.parquet")
    verdict = Counter((r[0], r[4]) for r in got)
    # by alias: blocked through canonical links and refreshes; an allowed alias goes first
    blocked = (1, 2, 3, 6, 9, 10, 11, 13, 14, 17, 18, 19, 20, 21, 22, 23)
    assert all(verdict[i, "block"] for i in blocked) and verdict[15, "block"] == 2 and verdict[None, "block"] == 1
    assert all(verdict[i, "allow"] for i in (4, 5, 7, 8, 12, 16, 24, 25))
    df = lspark.createDataFrame(PAGES, schema).selectExpr("*", "1 AS host", "2 AS node", "3 AS root", "4 AS _r", "5 AS rule")
    assert rows_of(U.judge(df)) == [r for r in got if r[0] is None or r[0] < 100]
    assert U.judge(df.limit(0)).collect() == []
    long = lspark.createDataFrame(chain, schema)
    assert {r["verdict"] for r in U.judge(long).collect()} == {"block"}


def test_dot_segments_are_removed(lspark):
    paths = {"": "", "/": "/", "/a/b/c/./../../g": "/a/g", "/a/..": "/", "/a/b/.": "/a/b/", "/../../x": "/x", "/a//../b": "/a/b", "/a/...": "/a/...", "/.a/b.": "/.a/b.", "//x/../": "//"}
    df = lspark.createDataFrame([*paths.items()], "p string, want string")
    assert df.where(U.without_dots(F.col("p")) != F.col("want")).collect() == []
    pages = pa.table({"page_id": list(range(len(paths))), "url": [f"http://u{i}.net{p}" for i, p in enumerate(paths)], "html": [canonical("http://k.com/de/1")] * len(paths)})
    assert {r[4] for r in oracle(U.SQL, pages=pages)} == {"block"}


def test_redirect_table_and_rule_order(lspark):
    df = lspark.createDataFrame([(1, "http://s.net/a", None), (2, "http://t.com/de/x", None)], "page_id long, url string, html string")
    moved = lspark.createDataFrame([("http://s.net/a", "http://t.com/de/x"), (None, "http://s.net/a")], "src string, dst string")
    assert {r["page_id"]: r["verdict"] for r in U.judge(df, redirects=moved).collect()} == {1: "block", 2: "block"}
    rules = [("block", "b.com/"), ("allow", "x.b.com/"), ("block", "x.b.com/p")]
    urls = [(1, "http://b.com/"), (2, "http://y.b.com/p"), (3, "http://x.b.com/o"), (4, "http://z.x.b.com/pq"), (5, "http://xb.com/"), (6, "http://b.com")]
    got = U.judge(lspark.createDataFrame([(*u, None) for u in urls], "page_id long, url string, html string"), rules)
    assert {r["page_id"]: r["rule"] for r in got.collect()} == {1: "b.com/", 2: "b.com/", 3: "x.b.com/", 4: "x.b.com/p", 5: None, 6: None}
    assert {r["verdict"] for r in U.judge(df, rules=[]).collect()} == {"allow"}
