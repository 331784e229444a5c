import corpus_pipeline as P
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tests.llm.test_substring import slow
from tidemark.llm import bpe, quality, simhash
from tidemark.llm.common import crc_of_id, stored
from tidemark.sources.tables import table


def test_stages_follow_their_operators(lspark):
    docs = table(lspark, SMALL, "documents")
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5 and P.ORACLE_SQL is None
    before = docs
    for name, stage in P.STAGES:
        after = stored(stage(lspark, before, SMALL), "test")
        if name != names[-1]:
            assert after.columns == columns and dict(after.dtypes) == dict(docs.dtypes)
        old = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
        new = {r["doc_id"]: r for r in after.collect()}
        assert set(new) <= set(old) and len(new) == after.count()
        if name == "quality classifier":
            labels = table(lspark, SMALL, "labels").where(crc_of_id(F.col("doc_id")) % 3 != 1)
            score = {r["doc_id"]: r["score"] for r in quality.score(before, quality.train(before, labels)).collect()}
            assert set(new) == {d for d, s in score.items() if s >= 0.5}
            good = {r["doc_id"] for r in table(lspark, SMALL, "labels").where("quality = 1").collect()} & set(old)
            assert len(good & set(new)) >= 0.9 * len(good)
        elif name == "SimHash near-dedup":
            groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(before).collect()}
            assert set(new) == set(groups.values()) and len(new) < len(old)
        elif name == "substring dedup":
            want = {d: (gone, t.decode()) for d, n, gone, t in slow(list(old.items()), 20) if not n or gone < n}
            assert {d: r["text"] for d, r in new.items()} == {d: t if gone else old[d] for d, (gone, t) in want.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in new.values())
        elif name == "mixing sources":
            total = sum(len(t.split()) for t in old.values())
            assert 0.85 * total <= sum(len(old[d].split()) for d in new) <= total
            assert all(r["text"] == old[d] for d, r in new.items())
        else:
            vocabulary = bpe.Vocabulary.load(bpe.default_vocabulary())
            assert set(new) == set(old)
            for d, r in new.items():
                assert vocabulary.decode_many([bytes(r["ids"])])[0].decode() == old[d] and r["n_tokens"] == len(r["ids"]) // 4
        before = after
    run = P.run(lspark, SMALL)
    assert sorted(map(str, run.collect())) == sorted(map(str, before.collect()))


def test_awkward_and_empty_tables(lspark, awkward, nothing):
    docs = awkward.withColumn("n_chars", F.length("text").cast("long"))
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in P.STAGES:
            now = stored(stage(lspark, now, SMALL), "test")
            if name != P.STAGES[-1][0]:
                assert now.columns == docs.columns
        assert now.count() <= docs.count()
    assert now.count() == 0
    # near-duplicates: equal texts once (the null id's equals id 4's), both texts of id 5 stay
    left = P.near_dedup_stage(lspark, docs, SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["-7", "1", "4", "5", "5"]


def test_rows_are_named_by_all_their_columns(lspark):
    """Null and repeated ids, a source with a long number, a column with a dot, equal rows."""
    rows = [(None, f"text number {i} of many words {i * i}", "en", "src" + "9" * 25) for i in range(20)] + [(7, "a b c", "en", "s1"), (7, "d e f", "en", "s1")] + [(8, "x y z", None, None)] * 4
    docs = lspark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "length(text) AS n_chars", "1 AS `a.b`")
    docs = stored(docs, "test")
    near = P.near_dedup_stage(lspark, docs, SMALL)
    assert near.columns == docs.columns and near.where("doc_id = 7").count() == 2 and near.where("doc_id = 8").count() == 1
    assert P.substring_stage(lspark, docs, SMALL).columns == docs.columns
    taken = stored(P.mixing_stage(lspark, docs, SMALL), "test")
    keyed = docs.select(P.row_key(docs).alias("key"), "text", "lang", "source")
    plan = P.mixing.mix(keyed, P.mixing.source_domain(F.col("source")), budget_share=P.MIX_SHARE, max_epochs=1, id_col="key")
    assert taken.count() == plan.agg(F.sum("copies")).first()[0] < docs.count()
    assert {r["domain"] for r in plan.where("lang = 'en'").collect()} == {"d1", "d3"}
