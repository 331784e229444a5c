"""Document fingerprints: one-permutation MinHash with optimal densification.

Every 5-word shingle of a text is hashed once. The hash's high bits choose one of
``BINS`` bins and each bin keeps its smallest value. An empty bin copies the bin that a
fixed pseudo-random sequence of its own reaches first among those that were filled
(optimal densification: every empty bin draws anew, so equal sets give equal
fingerprints and errors do not cluster). Of each bin the low ``BITS`` bits are kept,
packed: 512 bins of 4 bits are 256 bytes.

Likeness: the share of equal bins, m, holds chance matches of low bits, so the
estimate of the Jaccard similarity of the shingle sets is (m - c) / (1 - c) with
c = 2**-BITS, clamped to 0..1. Its standard error is near 0.023 in the middle.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions

SHINGLE = 5
BINS = 512
BITS = 4
SEED = 1729
TRIES = 64  # bins that an empty bin asks at a time
FIRST_ID = -(1 << 63)  # where a null id sorts
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@functools.lru_cache(maxsize=64)
def _donors(block: int) -> np.ndarray:
    """Row j: the next ``TRIES`` bins that bin j asks for a value, in order; block after
    block, without end."""
    start = np.uint64((SEED << 20) + block * BINS * TRIES)
    asked = _mix(np.arange(BINS * TRIES, dtype=np.uint64) + start) % np.uint64(BINS)
    return asked.reshape(BINS, TRIES).astype(np.uint16)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles; fewer words than a shingle: of the whole sequence."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(shingle, n)
    with np.errstate(over="ignore"):
        h = one[: n - size + 1].copy()
        for k in range(1, size):
            h = h * _BASE + one[k : n - size + 1 + k]
        return _mix(h + np.uint64(size))


def bins_of(hashes: np.ndarray) -> np.ndarray | None:
    """Densified bins of a shingle set; none for an empty set."""
    if not len(hashes):
        return None
    bins = np.full(BINS, _EMPTY)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    values = hashes & ((np.uint64(1) << shift) - np.uint64(1))
    np.minimum.at(bins, (hashes >> shift).astype(np.int64), values)
    filled = bins != _EMPTY
    if not filled.all():
        empty = np.flatnonzero(~filled)
        given = np.empty(len(empty), np.int64)
        left = np.arange(len(empty))  # places in ``empty`` whose draws have not hit yet
        for block in itertools.count():
            draws = _donors(block)[empty[left]]
            asked = filled[draws]
            first = asked.argmax(axis=1)
            rows = np.arange(len(left))
            found = asked[rows, first]
            given[left[found]] = draws[rows, first][found]
            left = left[~found]
            if not len(left):
                break
        bins[empty] = bins[given]
    return bins


def fingerprint(text: str | None) -> bytes:
    """Packed fingerprint of a text; empty bytes for a text without words."""
    bins = bins_of(shingle_hashes(text or ""))
    if bins is None:
        return b""
    low = (_mix(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Bias-corrected estimate of the Jaccard similarity of two shingle sets: 1 for two
    texts without words, 0 if only one has none."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    same = np.count_nonzero(x < 16) + np.count_nonzero(x & 15 == 0)
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (same / BINS - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint binary)`` of every row, nothing shuffled. Null, empty and
    wordless texts have the empty fingerprint; an empty table gives an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint binary")


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the next one's start."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, id): each row is judged with the one after it; the last
    rows of a range are copies of the next range's first, for its last row only."""
    held = None  # (range, id, text, fingerprint) of the row before

    def judge(doc, text, print_, following, next_print) -> tuple:
        other = edited(text, following)
        edited_print = fingerprint(other)
        return (
            doc, len(text), hashlib.sha256(other.encode()).hexdigest(), print_, edited_print,
            likeness(print_, edited_print), likeness(print_, next_print),
        )

    for batch in batches:
        out = []
        for part, ahead, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
            print_ = fingerprint(text)
            if held is not None and held[0] == part:
                out.append(judge(*held[1:], text, print_))
            held = None if ahead else (part, doc, text, print_)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _COMPARED)], schema=_COMPARED) if out else pa.RecordBatch.from_pylist([], schema=_COMPARED)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness of its
    fingerprint to the edited text's and to the next document's (ascending id; after the
    last: the first).

    Texts are range-sorted by id, so the next document lies in the same task but for
    the last of a range: every range's first document is sent to the range before as
    well. Only the range bounds and first rows' keys (one per range) reach the driver.

    Null texts are empty. Rows with the same id follow each other by text; equal rows are
    interchangeable; null ids come first. A single row follows itself. An empty table
    gives an empty table. Other columns are not read.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID))
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    shares = [i / n for i in range(1, n)] or [1.0]
    found = rows.agg(F.percentile_approx("key", shares, 40 * n)).first()[0]
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    ranged = rows.withColumn("part", range_of("key"))
    firsts = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.min("key")).collect())  # a row per range
    before = [(low, firsts[i - 1][0]) for i, (_, low) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(before, "key long, to int"))  # as many rows as ranges
    leads = rows.join(heads, "key").groupBy("key", "to").agg(F.min("text").alias("text"))
    none = F.lit(None).cast("long")
    own = ranged.select("part", F.lit(False).alias("ahead"), "key", "doc_id", "text")
    ahead = leads.select(F.col("to").alias("part"), F.lit(True).alias("ahead"), "key", none.alias("doc_id"), "text")
    # one range per partition: hashing the ranges would put several into one task
    dealt = own.unionByName(ahead).repartitionById(len(bounds) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "ahead", "key", "text")
    return ordered.select("part", "ahead", "doc_id", "text").mapInArrow(_compare, _COMPARED_DDL)


_COMPARED_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
)


def op6_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    from tidemark.sources.tables import table

    out = compare_with_next(table(spark, sf_dir, "documents"))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return out.select("doc_id", "n_chars", "edited_sha256", *hexed, "near_edited", "near_next")
