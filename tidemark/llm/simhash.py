"""SimHash near-duplicates by tiled exact comparison.

1. Every whole text gets a 64-bit fingerprint: bit i is set if bit i is set in over
   half of the XXH64 hashes (seed 42) of its word shingles, repeats included.
2. Distinct fingerprints (grouped before the shuffle, so thousands of copies are one
   row) are range-sorted by population count, then by the population counts of their
   four 16-bit quarters, and cut into tiles of one population count each.
3. Two tiles can hold a link only if their population counts, and the sum of the gaps
   between their quarters' counts, differ by no more than the radius; all other tile
   pairs are skipped unread. The rest are compared in full with numpy exclusive-or
   and bit counts. A comparison returns a spanning forest of its links (at most one
   row per fingerprint), never all pairs.
4. Connected components over the forest edges give every fingerprint its class.

The number of tile pairs grows with the square of the number of *distinct*
fingerprints, as an exact comparison by tiles must; the quarters' counts skip most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import connected_components

SEED = 42
TILE = 4096  # fingerprints in a tile
ROWS = 64  # rows of a tile compared at once: 64 x 4096 differences, 2 MB
_BLOCK = 1 << 16  # shingle hashes whose bits are counted at once
_QUARTERS = ("q0", "q1", "q2", "q3")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint of one text (A-Z lower-cased); no words: zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: n - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        h = xxhash.xxh64_intdigest
        hashes = np.array([h(joined[i:k], SEED) for i, k in zip(starts, ends)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = hashes[i : i + _BLOCK]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed long.

    Null and empty texts, and texts without a word, have fingerprint zero. Rows are
    kept as they come: repeated rows and null ids give repeated rows and null ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def fp_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (pop, quarters, fp) -> tiles of one population count."""
    held: list[np.ndarray] = []

    def tile(block: np.ndarray) -> pa.RecordBatch:
        q = block[:, 1:5]
        row = {
            "tile": int(block[0, 5]), "pop": int(block[0, 0]),
            "lo": q.min(axis=0).tolist(), "hi": q.max(axis=0).tolist(),
            "fps": np.ascontiguousarray(block[:, 5]).astype("<i8").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_TILE_SCHEMA)

    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        block = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        for part in np.split(block, np.flatnonzero(np.diff(block[:, 0])) + 1):
            while len(part):
                if held and held[0][0, 0] != part[0, 0]:
                    yield tile(np.concatenate(held))
                    held, size = [], 0
                take = part[: TILE - size]
                held.append(take)
                size += len(take)
                part = part[len(take) :]
                if size == TILE:
                    yield tile(np.concatenate(held))
                    held, size = [], 0
    if held:
        yield tile(np.concatenate(held))


_TILE_SCHEMA = pa.schema(
    [("tile", pa.int64()), ("pop", pa.int32()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())), ("fps", pa.binary())]
)


def tiles(fps: DataFrame) -> DataFrame:
    """Tiles of the distinct fingerprints in ``fps`` (column ``fp``, no repeats)."""
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))).alias(q) for i, q in enumerate(_QUARTERS)]
    rows = fps.select(F.bit_count("fp").alias("pop"), *quarters, "fp")
    order = ["pop", *_QUARTERS, "fp"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _cut, "tile long, pop int, lo array<int>, hi array<int>, fps binary"
    )


def forest(x: np.ndarray, y: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within ``radius`` bits between tiles x and y
    (or within x): arrays of (node, root) fingerprints."""
    nodes = x if same else np.concatenate([x, y])
    shift = 0 if same else len(x)
    label = np.arange(len(nodes))
    ux, uy = x.view(np.uint64), y.view(np.uint64)
    for i in range(0, len(x), ROWS):
        near = np.bitwise_count(ux[i : i + ROWS, None] ^ uy[None, :]) <= radius
        if same:
            near[np.arange(len(near)), np.arange(i, i + len(near))] = False
        if not near.any():
            continue
        u, v = np.nonzero(near)
        u, v = u + i, v + shift
        while True:
            a, b = label[u], label[v]
            if np.array_equal(a, b):
                break
            m = np.minimum(a, b)
            np.minimum.at(label, a, m)
            np.minimum.at(label, b, m)
            while not np.array_equal(up := label[label], label):
                label = up
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)``: edges that connect exactly the distinct fingerprints which links of
    at most ``radius`` differing bits connect."""
    t = stored(tiles(fps), "simhash-tiles")
    meta = t.select("tile", "pop", "lo", "hi")
    left = meta.select(
        F.col("tile").alias("ta"), F.col("pop").alias("pa"), F.col("lo").alias("la"), F.col("hi").alias("ha"),
        F.explode(F.sequence("pop", F.col("pop") + F.lit(radius))).alias("pb"),
    )
    right = meta.select(F.col("tile").alias("tb"), F.col("pop").alias("pb"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    gaps = [F.greatest(F.col("lb")[i] - F.col("ha")[i], F.col("la")[i] - F.col("hb")[i], F.lit(0)) for i in range(4)]
    once = (F.col("pb") > F.col("pa")) | (F.col("tb") >= F.col("ta"))
    pairs = left.join(right, "pb").where(once & (sum(gaps[1:], gaps[0]) <= radius)).select("ta", "tb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ta, tb, x, y in zip(*(c for c in batch.columns)):
                same = ta.as_py() == tb.as_py()
                x, y = (np.frombuffer(z.as_py(), "<i8") for z in (x, y))
                a, b = forest(x, y, radius, same)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    blobs = pairs.join(t.select(F.col("tile").alias("ta"), F.col("fps").alias("x")), "ta")
    blobs = blobs.join(t.select(F.col("tile").alias("tb"), F.col("fps").alias("y")), "tb")
    return blobs.select("ta", "tb", "x", "y").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``radius`` differing bits, the row's own id included. Null, empty and wordless
    texts have fingerprint zero and are linked like any other; rows with a null id
    take part (a class with null ids only has a null component). An empty table
    gives an empty table; other columns of ``docs`` are not read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-class")
    roots = connected_components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = stored(classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-root")
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-name")
    class_of = stored(rooted.join(named, "root").select("fp", "component_id"), "simhash-of")
    return fps.join(class_of, "fp").select("doc_id", "fp", "component_id")


def op3_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    from tidemark.sources.tables import table

    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", fp_hex(F.col("fp")).alias("fingerprint"), "component_id")
