import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, SMALL
from tidemark.llm import langid as L
from tidemark.llm import quality as Q
from tidemark.llm import toxicity as T
from tidemark.llm import trees
from tidemark.sources.tables import table

SF01 = "/root/testdata/sf0.01"


def held(rows, truth):
    out = [(r, truth[r["doc_id"]]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert out
    return out


def crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode())


def test_language_accuracy_held_out(lspark):
    got = L.op7_language_id(lspark, SF01).collect()
    truth = dict(table(lspark, SF01, "documents").select("doc_id", "lang").collect())
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in got)
    right = [r["lang_pred"] == t for r, t in held(got, truth)]
    assert np.mean(right) >= 0.98
    assert all(0.0 <= r["score"] <= 1.0 for r in got)


def test_language_back_off_and_awkward_rows(lspark, awkward, nothing):
    train = lspark.createDataFrame([(i, "the thing with the hat and this", "en") for i in range(3)] + [(9, "der hund und die katze schläft", "de"), (10, "der und die", "de"), (11, None, "de"), (12, "x", None)], "doc_id long, text string, lang string")
    model = L.train(train)
    assert model.langs == ["de", "en"] and "the" in model.words and "hund" not in model.words
    s = L.Scorer(model)
    said = L.predict(s, ["schlafen hunde", "thinking withhat", "123 !!", None])
    assert [x for x, _ in said] == ["de", "en", "und", "und"] and said[2:] == [("und", 0.0)] * 2
    got = L.identify(awkward, model).collect()
    assert len(got) == len(AWKWARD) and sum(r["doc_id"] is None for r in got) == 1
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert L.identify(nothing, L.train(nothing)).collect() == []
    assert {r["lang_pred"] for r in L.identify(awkward, L.train(nothing)).collect()} == {"und"}


def test_longest_known_gram_scores_first(lspark):
    def grams(*items, scores):
        return np.array([L._gram_keys(np.array(list(map(ord, g)), np.uint64), len(g))[0] for g in items], np.uint64), np.array(scores)

    none = (np.empty(0, np.uint64), np.zeros((0, 2)))
    m = L.Model(["a", "b"], ([], np.zeros((0, 2))), {4: grams("abcd", scores=[[4, 0]]), 3: grams("bcd", scores=[[0, 3]]), 2: none, 1: grams(*"abcd", scores=[[1, 1]] * 4)})
    # positions of |abcd|: border (nothing), a -> abcd, b -> bcd, c and d -> letters
    assert m.unseen(["abcd", "xyz"]).tolist() == [[(4 + 0 + 1 + 1) / 4, (0 + 3 + 1 + 1) / 4], [0.0, 0.0]]


def test_quality_held_out(lspark):
    got = Q.op4_quality_classifier(lspark, SF01).collect()
    truth = dict(table(lspark, SF01, "labels").select("doc_id", "quality").collect())
    pairs = held(got, truth)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert np.mean([r["predicted"] == t for r, t in pairs]) >= 0.93
    assert np.mean([r["predicted"] for r, t in pairs if t == 1]) >= 0.95


def test_rules_compile_to_what_they_say(lspark, texts):
    docs, labels = table(lspark, SF01, "documents"), table(lspark, SF01, "labels")
    model = Q.train(docs, labels)
    assert model.rules and len(model.describe()) == len(model.rules)
    got = {r["doc_id"]: r["score"] for r in Q.score(table(lspark, SMALL, "documents"), model).collect()}
    for d, t in texts:
        x = Q.statistics(t)
        z = model.base + sum(w for rule, w in model.rules if all(x[f] <= v if low else x[f] > v for f, v, low in rule))
        assert abs(got[d] - 1 / (1 + np.exp(-z))) < 1e-9
    kept = Q.keep_good(table(lspark, SMALL, "documents"), model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(d for d, s in got.items() if s >= 0.5)


def test_quality_awkward_rows(lspark, awkward, nothing):
    labels = lspark.createDataFrame([(2, 0), (4, 1), (4, 1), (5, None), (None, 1), (-7, 1), (99, 0)], "doc_id long, quality int")
    model = Q.train(awkward, labels)
    got = Q.score(awkward, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert Q.keep_good(awkward, model).columns == awkward.columns
    blank = Q.train(nothing, labels.limit(0))
    assert blank.rules == [] and all(r["score"] > 0.99 for r in Q.score(awkward, blank).collect())
    assert Q.score(nothing, blank).collect() == []


def test_toxicity_held_out(lspark):
    got = T.op9_toxicity(lspark, "/root/testdata/sf0.1").collect()
    truth = dict(table(lspark, "/root/testdata/sf0.1", "labels").select("doc_id", "toxic").collect())
    pairs = held(got, truth)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert np.mean([r["predicted"] for r, t in pairs if t == 1]) >= 0.85
    assert np.mean([r["predicted"] for r, t in pairs if t == 0]) <= 0.02


def test_toxicity_awkward_rows(lspark, awkward, nothing):
    labels = lspark.createDataFrame([(2, 0), (4, 1), (4, 0), (5, None), (None, 1), (-7, 1), (99, 0)], "doc_id long, toxic int")
    model = T.train(awkward, labels)
    got = T.score(awkward, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert T.score(nothing, T.train(nothing, labels.limit(0))).collect() == []


def test_rare_label_is_kept_and_weighted(lspark):
    docs = lspark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    labels = lspark.range(4000).selectExpr("id AS doc_id", "int(id % 100 = 0) AS toxic")
    got = {r["label"]: r for r in trees.balanced_sample(docs, labels, "toxic", 400).groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert got[1.0]["n"] == 40 == got[1.0]["w"]
    assert 300 <= got[0.0]["n"] <= 420 and abs(got[0.0]["w"] - 3960) < 600


def test_calibration_rows_are_out_of_fold(lspark, monkeypatch):
    """A rare label takes the same path: no trees give margins to rows they were fitted on."""
    seen, fitted = [], []
    class Watched(T.Ensemble):
        def probability(self, x):
            seen.append(len(x))
            return super().probability(x)
    fit = T.GBTClassifier.fit
    monkeypatch.setattr(T, "Ensemble", Watched)
    monkeypatch.setattr(T.GBTClassifier, "fit", lambda self, df: (fitted.append(df.count()), fit(self, df))[1])
    rows = [(i, ("you awful idiot " if i % 20 == 0 else "kind words here ") * 3 + f"w{i % 7}") for i in range(400)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    model = T.train(docs, lspark.createDataFrame([(i, int(i % 20 == 0)) for i in range(400)], "doc_id long, toxic int"))
    assert len(seen) == T.PARTS and sum(seen) == 400 and fitted == [400 - k for k in seen] + [400]
    assert model.levels.min() < 0.3 <= model.levels.max()


def test_toxicity_features():
    f = T.Featurizer({"idiot": 3.0, "idio-": 2.0, "hater": 2.0})
    at = {n: i for i, n in enumerate(T.FEATURES)}
    x = f.features("You are an idiot! h4t3r")
    assert x[at["distinct_hits"]] == 1 and x[at["hits_near_second_person"]] > 0 and x[at["exclaims"]] == 0.2
    assert x[at["disguised"]] == 0.2 and x[at["disguised_hits"]] == 0.2
    assert f.features("") == [0.0] * len(T.FEATURES) and f.features(" \n") == f.features("")
    assert f.features("GO AWAY")[at["shouted_words"]] == 1.0


def test_flat_ensemble_equals_spark(lspark):
    from pyspark.ml.classification import GBTClassifier

    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    df = lspark.createDataFrame([(float(b), a.tolist()) for a, b in zip(x, y)], "label double, x array<double>").select("label", "x", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(df)
    want = np.array([r[0] for r in model.transform(df).select(vector_to_array("probability")[1]).collect()])
    assert np.allclose(trees.Ensemble(model).probability(x), want)
    for tree in model.trees:
        for rule in trees.rules_of(tree):
            col = trees.rule_column(rule, [F.col("x")[i] for i in range(3)])
            got = [r[0] for r in df.select(col).collect()]
            assert got == [float(all(v[f] <= t if low else v[f] > t for f, t, low in rule)) for v in x]
        break
