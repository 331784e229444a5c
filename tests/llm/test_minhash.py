import hashlib

import numpy as np

from tests.llm.conftest import AWKWARD, SMALL
from tidemark.llm import minhash as M


def shingles(text):
    w = text.encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_equals_single_texts(lspark, texts):
    got = {r["doc_id"]: r for r in M.op6_document_fingerprints(lspark, SMALL).collect()}
    assert len(got) == len(texts)
    errors = []
    for i, (d, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        other = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(other.encode()).hexdigest())
        assert r["fingerprint"] == M.fingerprint(t).hex() and r["edited_fingerprint"] == M.fingerprint(other).hex()
        if len(t.split()) > 60:
            errors += [r["near_edited"] - jaccard(t, other), r["near_next"] - jaccard(t, after)]
    assert np.abs(errors).max() < 0.12 and np.std(errors) < 0.03


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.3, 0.8, 1.0):
        errors = []
        for _ in range(60):
            a = [f"w{x}" for x in rng.integers(0, 10**9, 900)]
            cut = int(900 * share)
            b = a[:cut] + [f"v{x}" for x in rng.integers(0, 10**9, 900 - cut)]
            x, y = " ".join(a), " ".join(b)
            errors.append(M.likeness(M.fingerprint(x), M.fingerprint(y)) - jaccard(x, y))
        assert abs(np.mean(errors)) < 0.015 and np.abs(errors).max() < 0.12


def test_few_shingles_fill_all_bins_alike():
    few = M.shingle_hashes("one two three four five six")
    assert len(few) == 2
    a, b = M.bins_of(few), M.bins_of(few[::-1].copy())
    assert (a == b).all() and (a != M._EMPTY).all() and len(set(a.tolist())) == 2
    assert M.fingerprint(" \n") == b"" == M.fingerprint(None)
    assert M.likeness(b"", b"") == 1.0 and M.likeness(b"", M.fingerprint("x")) == 0.0


def test_empty_bins_draw_until_they_hit():
    """Of few filled bins, none is preferred for being next around the ring."""
    rng, ring, n = np.random.default_rng(8), 0, 0
    for _ in range(40):
        h = rng.integers(0, 1 << 64, 5, np.uint64)
        full = np.unique(h >> np.uint64(55)).astype(int)
        bins = M.bins_of(h)
        empty = np.setdiff1d(np.arange(M.BINS), full)
        ring += (bins[empty] == bins[full[np.searchsorted(full, empty) % len(full)]]).sum()
        n += len(empty)
    assert 0.15 < ring / n < 0.25


def test_next_document_across_ranges(lspark):
    rows = [(7 * i - 50, f"text number {i} of the row " + "z" * i) for i in range(90)]
    got = {r["doc_id"]: r["edited_sha256"] for r in M.compare_with_next(lspark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    for i, (d, t) in enumerate(rows):
        assert got[d] == hashlib.sha256(M.edited(t, rows[(i + 1) % 90][1]).encode()).hexdigest()


def test_awkward_rows(lspark, awkward, nothing):
    got = M.compare_with_next(awkward).collect()
    rows = sorted(((r[0] if r[0] is not None else M.FIRST_ID, r[1] or "") for r in AWKWARD))
    want = [(t, M.edited(t, rows[(i + 1) % len(rows)][1])) for i, (_, t) in enumerate(rows)]
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted((len(t), hashlib.sha256(e.encode()).hexdigest()) for t, e in want)
    assert sum(r["doc_id"] is None for r in got) == 1
    assert M.compare_with_next(nothing).collect() == []
    one = M.compare_with_next(lspark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(5, 1.0)]
