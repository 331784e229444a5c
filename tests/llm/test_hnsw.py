import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hnsw as H
from tidemark.sources.tables import table

SF01 = "/root/testdata/sf0.01"


def brute(ids, v, query, k):
    score = (v * v[ids.index(query)]).sum(axis=1)
    return sorted((-s, i) for s, i in zip(score, ids) if i != query)[:k]


def test_query_recall_and_scores(lspark):
    rows = sorted(tuple(r) for r in table(lspark, SF01, "embeddings").select("vec_id", "embedding").collect())
    ids, v = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    got = {}
    for r in H.op5_nearest_neighbours(lspark, SF01).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [i for i in ids if i % 20 == 0]
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        for _, i, s in found:
            assert abs(s - float((v[ids.index(i)] * v[ids.index(q)]).sum())) < 1e-12
        hits += len({f[1] for f in found} & {i for _, i in brute(ids, v, q, 20)})
    assert hits / (20 * len(got)) >= 0.95


def test_shards_and_inner_products_of_any_length(lspark, monkeypatch):
    monkeypatch.setattr(H, "SHARD", 400)
    monkeypatch.setattr(H, "SLICE", 20)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 12)) * rng.gamma(2.0, 1.0, size=(1500, 1))
    df = lspark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in H.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    ids = list(range(1500))
    hits = sum(len(got[q] & {i for _, i in brute(ids, v, q, 10)}) for q in got)
    assert len(got) == 75 and hits / 750 >= 0.9


def test_many_copies_of_one_vector(lspark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=8).tolist()
    rows = [(i, same) for i in range(300)] + [(300 + i, rng.normal(size=8).tolist()) for i in range(100)]
    got = H.nearest(lspark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20)
    top = {r["query_id"]: r["ids"] for r in got.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "vec_id"))), lambda x: x["vec_id"]).alias("ids")).collect()}
    ids, v = [r[0] for r in rows], np.array([r[1] for r in rows])
    assert top[0] == [i for _, i in brute(ids, v, 0, 20)]  # ties go to the smaller ids
    assert top[280][:5] == [i for _, i in brute(ids, v, 280, 20)][:5]


def test_rows_that_take_no_part(lspark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, None), (7, [0.0, -0.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [nan, 1.0]), (11, [1.0, None]), (40, [inf, 1.0]), (10, [2.0, -0.0])]
    df = lspark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS rep", "3 AS v")
    got = [tuple(r) for r in H.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 10, 2.0), (0, 2, 3, 1.0), (0, 3, 20, 1.0), (20, 1, 10, 2.0), (20, 2, 0, 1.0), (20, 3, 3, 1.0)]
    assert H.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_graph_round_trip_and_layers():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(700, 10))
    g = H.Graph(v).build()
    assert len(g.layers) > 1
    assert (g.layers[0][:700] >= 0).any(axis=1).all()
    h = H.Graph.load(v, **g.flat())
    assert (g.search(v[:50])[0] == h.search(v[:50])[0]).all()


def test_one_vector_much_longer_than_the_rest():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 12))
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    for times in (1e3, 1e5, 1e9):
        v[750] *= times / np.sqrt((v[750] ** 2).sum())
        ids, _ = H.Graph(v).build().search(v[:200])
        score = v[:200] @ v.T
        hits = 0
        for found, s in zip(ids, score):
            found = found[found >= 0]
            hits += len(set(found[np.argsort(-s[found])][:20]) & set(np.argsort(-s)[:20]))
        assert hits / 4000 >= 0.95
