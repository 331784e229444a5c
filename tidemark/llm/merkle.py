"""Merkle manifest of a dataset: a tree per source, a tree over the sources' roots, and
for every row the proof that it belongs to the root.

Nodes carry the interval of leaf ranks they cover, ``[lo, hi)``. The levels are cut into
bands of ``BAND``; the nodes of a band meet in one bucket by the interval of the band's top
node (``BRANCH ** BAND`` units wide), so a bucket never holds more than that many,
however many leaves a source has.

1. Leaves are hashed in the scan; a distributed index gives each its rank in its source.
2. Up. A bucket builds the levels of its band and hands its top node to the next band,
   until every source has one node. The sources' roots are the leaves of one more tree.
3. Down. Every bucket joins the path of its own top node. Within the bucket a node's
   ancestors are those whose intervals contain its own; the parent's interval less its own
   leaves the intervals of its siblings, to its left and right. A leaf's proof is the
   siblings of its ancestors, level by level, to the root of all.

A proof is bytes: per level one byte ``4 * left + right``, the numbers of siblings on
either side, then their digests. ``fold`` recomputes a root from a leaf and its proof.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, stored
from tidemark.operators.index import IDX, N, SeriesSpec, with_index

BRANCH = 3  # children of a node
BAND = 5  # levels that a bucket builds: 243 units
_SIZE = 32  # bytes of a digest


def written_out(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its UTF-8 byte count, ``:``, itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    """Digest of a row's values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[written_out(v) for v in values]), 256))


def parent_digest(children: bytes) -> bytes:
    """Digest over the joined digests of a run of nodes, which enter as hexadecimal text."""
    return hashlib.sha256(children.hex().encode()).digest()


def fold(node: bytes, proof: bytes) -> bytes:
    """The root that ``node`` and its proof lead to."""
    at = 0
    while at < len(proof):
        left, right = divmod(proof[at], 4)
        mid = at + 1 + _SIZE * left
        end = mid + _SIZE * right
        node = parent_digest(proof[at + 1 : mid] + node + proof[mid:end])
        at = end
    return node


def siblings_of(proof: bytes) -> bytes:
    """The digests of a proof, joined."""
    out, at = [], 0
    while at < len(proof):
        end = at + 1 + _SIZE * sum(divmod(proof[at], 4))
        out.append(proof[at + 1 : end])
        at = end
    return b"".join(out)


@dataclass
class Level:
    """Nodes of one level: the intervals of leaf ranks they cover, ascending, and digests."""

    lo: np.ndarray
    hi: np.ndarray
    digests: list[bytes]

    def holding(self, rank: np.ndarray) -> np.ndarray:
        """The node whose interval contains each rank."""
        return np.searchsorted(self.lo, rank, "right") - 1

    def raised(self, width: int, total: int) -> Level:
        """The level above, whose nodes cover ``width`` ranks each."""
        lo, first = np.unique(self.lo // width * width, return_index=True)
        runs = np.append(first, len(self.lo))
        return Level(lo, np.minimum(lo + width, total), [parent_digest(b"".join(self.digests[a:b])) for a, b in zip(runs, runs[1:])])

    def sibling_records(self, above: Level) -> list[bytes]:
        """The proof's entry for each node: what of its parent's interval is not its own."""
        parent = above.holding(self.lo)
        first, end = np.searchsorted(self.lo, above.lo[parent]), np.searchsorted(self.lo, above.hi[parent])
        out = []
        for own, (a, b) in enumerate(zip(first.tolist(), end.tolist())):
            out.append(bytes([4 * (own - a) + b - own - 1]) + b"".join(self.digests[a:own] + self.digests[own + 1 : b]))
        return out


def _levels(units: Level, width: int, total: int) -> list[Level]:
    """The levels of a bucket, from its units up: as many as a band has, fewer if one node
    covers the whole tree before."""
    levels = [units]
    for _ in range(BAND):
        if levels[-1].hi[-1] - levels[-1].lo[0] >= total and len(levels[-1].lo) == 1:
            break
        width *= BRANCH
        levels.append(levels[-1].raised(width, total))
    return levels


def _units(table: pa.Table, width: int) -> tuple[Level, int, np.ndarray]:
    """A bucket's units by rank, the leaves of their tree, and the order of the rows."""
    lo, total = table["lo"].to_numpy(), int(table["n"][0].as_py())
    order = np.argsort(lo)
    digests = table["digest"].to_pylist()
    return Level(lo[order], np.minimum(lo[order] + width, total), [digests[i] for i in order]), total, order


def _climb(units: DataFrame, width: int) -> DataFrame:
    """``units(tree, lo, n, digest)`` that cover ``width`` ranks each -> those of the next band."""

    def run(key, table):
        level, total, _ = _units(table, width)
        top = _levels(level, width, total)[-1]
        return pa.table({"tree": table["tree"][:1], "lo": top.lo, "n": pa.array([total], pa.int64()), "digest": pa.array(top.digests, pa.binary())})

    span = width * BRANCH**BAND
    dealt = units.select("tree", "lo", "n", "digest", F.expr(f"lo div {span}").alias("bucket"))
    return dealt.groupBy("tree", "bucket").applyInArrow(run, "tree string, lo long, n long, digest binary")


def _forest(leaves: DataFrame, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The units of every band, leaves first, and ``(tree, root)`` of every tree."""
    longest = int(leaves.agg(F.max("n")).first()[0] or 0)
    bands, width = [leaves], 1
    while width < longest:
        bands.append(stored(_climb(bands[-1], width), f"{tag}-band"))
        width *= BRANCH**BAND
    return bands[:-1] or [leaves], stored(bands[-1].select("tree", F.col("digest").alias("root")), f"{tag}-roots")


_PATH = "tree string, lo long, path binary, subroot binary, root binary"


def _descend(units: DataFrame, above: DataFrame, width: int, finish=None, schema: str = _PATH) -> DataFrame:
    """Proofs of a band's units from those of its buckets' top nodes ``above(tree, lo, path,
    subroot, root)``. ``finish(table, paths, subroot, root)`` makes the rows."""

    def paths_only(table: pa.Table, paths: list[bytes], subroot: bytes, root: bytes) -> pa.Table:
        n = len(paths)
        return pa.table({"tree": table["tree"], "lo": table["lo"], "path": pa.array(paths, pa.binary()), "subroot": pa.array([subroot] * n, pa.binary()), "root": pa.array([root] * n, pa.binary())})

    def run(key, table, top):
        level, total, order = _units(table, width)
        levels = _levels(level, width, total)
        # per level: the ancestor that contains each unit, and that ancestor's siblings
        records = [(below.holding(level.lo), below.sibling_records(up)) for below, up in zip(levels, levels[1:])]
        end = top["path"][0].as_py()
        paths = [b""] * len(order)
        for i, row in enumerate(order.tolist()):
            paths[row] = b"".join([entries[own[i]] for own, entries in records]) + end
        return (finish or paths_only)(table, paths, top["subroot"][0].as_py(), top["root"][0].as_py())

    span = width * BRANCH**BAND
    here = units.withColumn("bucket", F.expr(f"lo div {span}")).groupBy("tree", "bucket")
    there = above.withColumn("bucket", F.expr(f"lo div {span}")).groupBy("tree", "bucket")
    return here.cogroup(there).applyInArrow(run, schema)


def _paths(bands: list[DataFrame], top: DataFrame, finish=None, schema: str = _PATH) -> DataFrame:
    """Proofs of the leaves of a forest, band by band from ``top``, the paths of its roots."""
    width = BRANCH ** (BAND * (len(bands) - 1))
    for band in reversed(bands[1:]):
        top = stored(_descend(band, top, width), "merkle-paths")
        width //= BRANCH**BAND
    return _descend(bands[0], top, 1, finish, schema)


_ROWS = "doc_id long, leaf binary, subroot binary, root binary, proof_digest binary, folded binary"


def _finish(with_proofs: bool):
    def run(table: pa.Table, paths: list[bytes], subroot: bytes, root: bytes) -> pa.Table:
        leaves, shown, n = table["digest"].to_pylist(), table["shown"].to_pylist(), len(paths)
        folded = [fold(s if s is not None else leaf, p) for leaf, s, p in zip(leaves, shown, paths)]
        columns = {"doc_id": table["doc_id"], "leaf": leaves, "subroot": [subroot] * n, "root": [root] * n, "proof_digest": [parent_digest(siblings_of(p)) for p in paths], "folded": folded}
        if with_proofs:
            columns["proof"] = paths
        return pa.table({c: v if c == "doc_id" else pa.array(v, pa.binary()) for c, v in columns.items()})

    return run


def manifest(
    docs: DataFrame, tampered: Column | None = None, with_proofs: bool = False, id_col: str = "doc_id", source_col: str = "source",
    value_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars"), text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, leaf, subroot, root, proof_digest, folded`` as raw
    digests, with ``with_proofs`` also ``proof`` (see the module).

    A leaf is the digest of ``value_cols`` and ``text_col``. Leaves ascend by id within their
    source; ``subroot`` is the source's node, ``root`` the one over all sources, null source
    first. ``folded`` is the root recomputed from the original proof and the leaf of the row
    as it is now: ``tampered`` is its text now (null: unchanged).

    Nulls enter a leaf as ``-``; a null source is a source of its own, an empty one another.
    Null ids come first; rows of equal id go by their digest, and equal rows have equal
    digests, so their order changes nothing but which of them gets which proof. Other
    columns are not read. An empty table gives an empty table.
    """
    values = [F.col(f"`{c}`") for c in value_cols]
    text = F.col(f"`{text_col}`")
    shown = F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), leaf_of(*values, tampered))
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))  # null first, then bytewise
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), tree.alias("tree"), leaf_of(*values, text).alias("digest"), shown.alias("shown"))
    rows = stored(rows, "merkle-leaves").withColumn("tie", F.monotonically_increasing_id())
    ranked = with_index(rows, SeriesSpec(keys=("tree",), order=("doc_id", "digest", "tie"), chunk_rows=1))
    leaves = ranked.select("tree", F.col(IDX).alias("lo"), F.col(N).alias("n"), "digest", "doc_id", "shown")
    bands, subroots = _forest(leaves, "merkle")
    ranked = with_index(subroots, SeriesSpec(keys=(), order=("tree",), chunk_rows=1))
    sources = ranked.select(F.lit("").alias("tree"), F.col(IDX).alias("lo"), F.col(N).alias("n"), F.col("root").alias("digest"), F.col("tree").alias("source"))
    sources = stored(sources, "merkle-sources")
    over, root = _forest(sources, "merkle-over")
    none = F.lit(b"")
    start = root.select("tree", F.lit(0).cast("long").alias("lo"), none.alias("path"), none.alias("subroot"), "root")
    found = _paths(over, start).select("lo", "path", "root")
    tops = sources.join(found, "lo").select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("lo"), "path", F.col("digest").alias("subroot"), "root")
    schema = _ROWS + (", proof binary" if with_proofs else "")
    return _paths(bands, stored(tops, "merkle-tops"), _finish(with_proofs), schema)


def _hex(column: str) -> Column:
    return F.lower(F.hex(column))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; the line breaks of every document whose
    CRC-32 is even are gone by the time it is verified."""
    from tidemark.sources.tables import table

    docs = table(spark, sf_dir, "documents")
    touched = (crc_of_id(F.col("doc_id")) % 2 == 0) & F.contains("text", F.lit("\n"))
    out = manifest(docs, tampered=F.when(touched, F.replace("text", F.lit("\n"), F.lit(""))))
    return out.select(
        "doc_id", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"),
        _hex("proof_digest").alias("proof_sha256"), _hex("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def _sql() -> str:
    def out(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"({out(x)})" for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def siblings(of: str, nodes: str, after: int) -> str:
        """Siblings per node ``of(k, tree, i)`` and level, to its left and right."""
        path = f"SELECT k, tree, 0 AS level, i FROM {of} UNION ALL SELECT p.k, p.tree, p.level + 1, p.i // 3 FROM p{after} p WHERE EXISTS (SELECT 1 FROM {nodes} u WHERE u.tree = p.tree AND u.level = p.level AND u.n > 1)"
        return f"""p{after}(k, tree, level, i) AS ({path}),
s{after} AS (SELECT p.k, p.level + {after} AS level, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < p.i), '') AS l, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > p.i), '') AS r
  FROM p{after} p JOIN {nodes} u ON u.tree = p.tree AND u.level = p.level AND u.i // 3 = p.i // 3 WHERE u.n > 1 GROUP BY p.k, p.level)"""

    return f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS t),
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf, {leaf("replace(text, chr(10), '')")} AS cut,
  list_transform(range(length(coalesce(doc_id::VARCHAR, ''))), lambda j: ascii(substr(doc_id::VARCHAR, j + 1, 1))::BIGINT) AS digits FROM documents),
z AS (SELECT k, doc_id, tree, leaf, CASE WHEN xor(list_reduce(list_prepend(4294967295, digits), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0
  THEN cut ELSE leaf END AS shown FROM d, tab),
lf AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM z),
up(tree, level, i, n, h) AS (SELECT tree, 0, i, n, leaf FROM lf
  UNION ALL SELECT tree, level + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY tree, level, i // 3),
sub AS (SELECT tree AS source, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top(tree, level, i, n, h) AS (SELECT '', 0, i, n, subroot FROM sub
  UNION ALL SELECT tree, level + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY tree, level, i // 3),
below AS (SELECT k, tree, i FROM lf), above AS (SELECT i AS k, '' AS tree, i FROM sub),
{siblings('below', 'up', 0)},
{siblings('above', 'top', 1000)},
steps AS (SELECT k, l, r, row_number() OVER (PARTITION BY k ORDER BY level) AS step FROM (
  SELECT k, level, l, r FROM s0 UNION ALL SELECT lf.k, level, l, r FROM s1000 JOIN sub ON s1000.k = sub.i JOIN lf ON lf.tree = sub.source)),
f(k, step, h) AS (SELECT k, 0, shown FROM lf UNION ALL SELECT f.k, steps.step, sha256(l || h || r) FROM f JOIN steps ON steps.k = f.k AND steps.step = f.step + 1),
folded AS (SELECT k, arg_max(h, step) AS folded_root FROM f GROUP BY k),
proof AS (SELECT k, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY k)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = (SELECT h FROM top WHERE n = 1) AS verified
FROM lf JOIN sub ON sub.source = lf.tree JOIN folded USING (k) LEFT JOIN proof USING (k)"""


SQL = _sql()
