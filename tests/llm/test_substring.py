import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tests.llm.conftest import AWKWARD, SMALL
from tidemark.llm import substring as S


def slow(rows, window):
    """(doc_id, n_words, n_removed, kept words) by comparing window tuples."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for d, t in rows:
        w = S.words_of(t)
        key = float("inf") if d is None else d
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, key), key)
    out = []
    for d, t in rows:
        w, mine = S.words_of(t), set()
        key = float("inf") if d is None else d
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if first[k] < key or k in mine:
                gone[i : i + window] = [True] * window
            mine.add(k)
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_query_equals_brute_force(lspark, texts):
    got = sorted(tuple(r) for r in S.op8_substring_dedup(lspark, SMALL).collect())
    assert got == [(d, n, k, hashlib.sha256(t).hexdigest()) for d, n, k, t in slow(texts, 20)]
    assert sum(r[2] for r in got) > 0


def test_awkward_rows_and_spans(awkward, nothing):
    got = S.dedup_substrings(awkward, window=5).collect()
    want = slow([(r[0], r[1]) for r in AWKWARD], 5)
    assert sorted(str((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"].encode())) for r in got) == sorted(map(str, want))
    for r in got:
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["first"] for a, b in zip(r["removed"], r["removed"][1:]))
    assert S.dedup_substrings(nothing).collect() == []


def test_carried_columns_and_layout(lspark):
    rows = [(1, "a  b\nc", "k1"), (2, "x y z a b c d", "k2"), (3, "q a b c d", None)]
    df = lspark.createDataFrame(rows, "doc_id long, text string, hashes string")
    got = sorted(S.dedup_substrings(df, window=4, carry=["hashes"], keep_layout=True).select("doc_id", "kept_text", "carried.hashes").collect())
    assert [tuple(r) for r in got] == [(1, "a  b\nc", "k1"), (2, "x y z a b c d", "k2"), (3, "q", None)]


def test_passage_in_many_documents_and_buckets(lspark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i * 37, f"u{i} v{i} {passage} w{i}") for i in range(300)]
    monkeypatch.setattr(S, "BUCKET", 500)
    got = sorted(tuple(r) for r in S.dedup_substrings(lspark.createDataFrame(rows, "doc_id long, text string").repartition(7)).select("doc_id", "n_words", "n_removed").collect())
    assert got == [(i * 37, 28, 25 if i else 0) for i in range(300)]


def test_shared_ids_are_dealt_over_parts(lspark, monkeypatch):
    """Null and repeated ids, equal texts among them, in groups of at most four consecutive ids."""
    monkeypatch.setattr(S, "GROUP_BITS", 2)
    monkeypatch.setattr(S, "GROUP", 4)
    monkeypatch.setattr(S, "BUCKET", 50)
    say = lambda i, n=9: " ".join(f"w{(i * 5 + j) % 23}" for j in range(n))
    rows = [(i, say(i)) for i in range(-3, 14)] + [(5, say(i % 7, 12)) for i in range(30)] + [(6, say(i)) for i in range(5)]
    rows += [(None, say(40)) for _ in range(25)] + [(None, say(i, 30)) for i in range(15)] + [(8, None)] * 9 + [(12, say(3))] * 3
    df = lspark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"].encode()) for r in S.dedup_substrings(df, window=4).collect()]
    assert sorted(map(str, got)) == sorted(map(str, slow(rows, 4)))
    grouped, shared = S._grouped(df)
    assert {r["h_id"] for r in shared.collect()} == {5, 6, 8, S.LAST_ID}
    where = {(r["doc_id"], r["grp"]) for r in grouped.collect()}
    assert {(4, 4), (5, 5), (6, 6), (7, 7), (8, 8), (9, 9), (11, 9), (12, 12), (-3, -4), (None, S.LAST_ID)} <= where
    copies = shared.where(f"h_id = {S.LAST_ID} AND parts >= 7").collect()
    assert len(copies) == 1  # 25 equal texts: one class, in parts of four


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=5), st.integers(1, 4))
def test_group_settles_its_own_repeats(docs, window):
    ids = list(range(len(docs)))
    hashes = [S.window_hashes([w.encode() for w in d], window) for d in docs]
    found = S.removed_windows(ids, hashes, np.empty(0, np.uint64))
    want = slow([(i, " ".join(d)) for i, d in zip(ids, docs)], window)
    for d, starts, (_, n, gone, _) in zip(docs, found, want):
        assert int(S._covered(starts, len(d), window).sum()) == gone


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 23))
def test_window_hash_depends_on_words_only(symbols, window):
    words = [b"w%d" % s for s in symbols]
    h = S.window_hashes(words, window)
    assert len(h) == max(0, len(words) - window + 1)
    seen = {}
    for i, x in enumerate(h.tolist()):
        assert seen.setdefault(tuple(words[i : i + window]), x) == x
    assert len(set(seen.values())) == len(seen)
