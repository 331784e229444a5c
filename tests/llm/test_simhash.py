import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tidemark.llm import simhash as S


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    fps = [(d, slow_fingerprint(t)) for d, t in rows]
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j][1]).bit_count() <= 3:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, format(f, "016x"), least.get(find(i))) for i, (d, f) in enumerate(fps)]


def test_query_equals_brute_force(lspark, texts):
    short = [(d, t) for d, t in texts if len(t) < 20_000]
    got = {r["doc_id"]: tuple(r) for r in S.op3_simhash_near_dedup(lspark, SMALL).collect()}
    assert len(got) == len(texts)
    for d, f, _ in slow_components(short):
        assert got[d][1] == f
    # links among all rows, by the fingerprints checked above
    ids = sorted(got)
    v = np.array([int(got[d][1], 16) for d in ids], np.uint64)
    up = list(range(len(ids)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(v[:i] ^ v[i]) <= 3).tolist():
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    assert [got[d][2] for d in ids] == [ids[find(i)] for i in range(len(ids))]


def test_awkward_rows(awkward, nothing):
    got = S.near_duplicates(awkward).select("doc_id", S.fp_hex(F.col("fp")), "component_id").collect()
    from tests.llm.conftest import AWKWARD

    want = slow_components([(r[0], r[1]) for r in AWKWARD])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert S.near_duplicates(nothing).collect() == []


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40)
    near = np.unique(np.concatenate([base] + [base ^ (1 << b) for b in range(20)])).astype("<i8")
    x, y = near[: len(near) // 2], near[len(near) // 2 :]
    for same in (True, False):
        nodes = x if same else np.concatenate([x, y])
        a, b = S.forest(x, x if same else y, 3, same)
        assert len(a) < len(nodes)
        up = {int(n): int(n) for n in nodes}

        def find(n, up=up):
            while up[n] != n:
                n = up[n]
            return n

        for p, q in zip(a.tolist(), b.tolist()):
            up[find(p)] = find(q)
        for i in x.tolist():
            for j in (x if same else y).tolist():
                if (i ^ j).bit_count() <= 3:
                    assert find(i) == find(j)


def test_links_over_many_tiles(lspark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63, 300)
    flips = np.array([1 << i for i in range(62)])
    fps = np.unique(np.concatenate([base, base ^ rng.choice(flips, 300), base ^ rng.choice(flips, 300) ^ rng.choice(flips, 300)]))
    df = lspark.createDataFrame([(int(x),) for x in fps], "fp long").repartition(5)
    edges = [(r["a"], r["b"]) for r in S.links(df, 3).collect()]
    up = {int(x): int(x) for x in fps}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        up[find(a)] = find(b)
    u = fps.astype(np.int64).view(np.uint64)
    for i, a in enumerate(u):
        for j in np.flatnonzero(np.bitwise_count(u ^ a) <= 3):
            assert find(int(fps[i])) == find(int(fps[j]))
    assert all((a ^ b) != 0 for a, b in edges)
