"""Substring dedup: repeated word windows by Rabin-Karp hashes, counted in Spark.

1. Hash. Every 20-word window of every document gets a Rabin-Karp hash: words are
   hashed to 64 bits, a window is their polynomial modulo 2**64, then mixed.
2. Count. Hashes travel to the bucket of their value, packed as sorted numpy
   arrays with the document they start in (a hash that one group of documents holds
   many times travels once per group: its smallest document). A bucket task sorts its
   hashes and finds those of more than one group of documents.
3. Reply. The bucket sends each repeated hash to every group but the first: there,
   every window with the hash starts later than one elsewhere. What repeats inside a
   group of documents is settled by that group's own task, which holds its texts.
4. Merge. A word is removed if a removed window covers it; windows merge into maximal
   intervals.

A group is the documents of ``GROUP`` consecutive ids. An id that more than ``GROUP`` rows
share (null is one) is a group of its own, before and after which its neighbours go on; as
its rows are not earlier than each other, they need not meet, and are dealt by a hash of
their text into classes, and a class with more than ``GROUP`` rows into parts that all get
its replies. So no task holds more than some ``2 * GROUP`` documents, whatever repeats. A passage that a third of all documents
share costs its bucket one entry per group of documents and map task, not one per
document. Windows are compared by 64-bit hashes: two different windows collide with a
chance near 2**-64 each pair (0.0005 expected collisions among 130 million windows).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import shuffle_partitions, stored

WINDOW = 20
GROUP_BITS = 9  # ids with the same value above these bits form a group of documents
GROUP = 1 << GROUP_BITS
PACK = 1 << 20  # windows that a map task packs at once
BUCKET = 1 << 20  # windows that a bucket holds, about
LAST_ID = (1 << 63) - 1  # a null id comes after all others
CLASSES = 256  # of the texts of one id

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers keep all bits
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: runs without space or tab..carriage return."""
    return (text or "").encode().split()


def window_hashes(words: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hash of every run of ``window`` words, by start."""
    n = len(words)
    if n < window:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    # hash of k words from the hashes of halves: H(2k)[i] = H(k)[i] * base**k + H(k)[i + k]
    h, k, power = one, 1, _BASE
    with np.errstate(over="ignore"):
        for bit in bin(window)[3:]:
            h = h[:-k] * power + h[k:]
            k, power = 2 * k, power * power
            if bit == "1":
                h = h[:-1] * _BASE + one[k : k + len(h) - 1]
                k, power = k + 1, power * _BASE
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of an array by significance: the zero bytes of small values lie together
    and cost nothing once the shuffle has compressed them."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _pack(docs: list[tuple[int, int, np.ndarray]], buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """One row per bucket: sorted hashes, the place of each one's group, groups and classes."""
    docs = sorted(docs, key=lambda d: d[:2])
    groups, classes = (np.array(x, dtype="<i8") for x in zip(*(d[:2] for d in docs)))
    new = np.concatenate([[False], (groups[1:] != groups[:-1]) | (classes[1:] != classes[:-1])])
    h = np.concatenate([d[2] for d in docs])
    at = np.repeat(np.cumsum(new).astype("<u4"), [len(d[2]) for d in docs])
    new[0] = True
    groups, classes = groups[new], classes[new]
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    first = np.ones(len(h), bool)  # a hash once a group and class
    first[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
    h, at = h[first], at[first]
    step = (1 << 64) // buckets + 1
    cuts = np.searchsorted(h, np.array([i * step for i in range(1, buckets)], dtype=np.uint64))
    for bucket, (hs, places) in enumerate(zip(np.split(h, cuts), np.split(at, cuts))):
        if len(hs):
            used, places = np.unique(places, return_inverse=True)
            gaps = np.diff(hs, prepend=np.uint64(0)).astype("<u8")
            yield bucket, _planes(gaps), _planes(places.astype("<u4")), _planes(np.diff(groups[used], prepend=0).astype("<i8")), _planes(classes[used])


_PACKED = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary()), ("groups", pa.binary()), ("classes", pa.binary())])


def _pack_stage(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for group, cls, text in zip(*batch.columns):
                h = window_hashes(words_of(text.as_py()), window)
                if not len(h):
                    continue
                held.append((group.as_py(), cls.as_py(), h))
                size += len(h)
                if size >= PACK:
                    for row in _pack(held, buckets):
                        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PACKED)], schema=_PACKED)
                    held, size = [], 0
        if held:
            for row in _pack(held, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PACKED)], schema=_PACKED)

    return run


def _repeated(rows: list[tuple[bytes, bytes, bytes, bytes]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(group, class, its hashes that also start in an earlier group) of one bucket."""
    hs, groups, classes = [], [], []
    for hashes, places, starts, cls in rows:
        at = _unplanes(places, "<u4")
        hs.append(np.cumsum(_unplanes(hashes, "<u8"), dtype=np.uint64))
        groups.append(np.cumsum(_unplanes(starts, "<i8"))[at])
        classes.append(_unplanes(cls, "<i8")[at])
    h, group, cls = np.concatenate(hs), np.concatenate(groups), np.concatenate(classes)
    order = np.argsort(h)
    h, group, cls = h[order], group[order], cls[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    first = np.minimum.reduceat(group, starts)
    later = group > np.repeat(first, np.diff(np.append(starts, len(h))))
    h, group, cls = h[later], group[later], cls[later]
    order = np.lexsort((cls, group))
    h, group, cls = h[order], group[order], cls[order]
    cuts = np.flatnonzero((group[1:] != group[:-1]) | (cls[1:] != cls[:-1])) + 1
    for at, part in zip(np.append(0, cuts), np.split(h, cuts) if len(h) else []):
        yield int(group[at]), int(cls[at]), np.unique(part)


def _count_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> (group, class, repeated hashes)."""
    now, held = None, []

    def reply() -> Iterator[pa.RecordBatch]:
        for group, cls, h in _repeated(held):
            row = [pa.array([group], pa.int64()), pa.array([cls], pa.int64()), pa.array([h.astype("<u8").tobytes()])]
            yield pa.RecordBatch.from_arrays(row, names=["grp", "cls", "hashes"])

    for batch in batches:
        for bucket, *row in zip(*batch.columns):
            if bucket.as_py() != now and held:
                yield from reply()
                held = []
            now = bucket.as_py()
            held.append(tuple(x.as_py() for x in row))
    if held:
        yield from reply()


def removed_windows(ids: list[int], hashes: list[np.ndarray], elsewhere: np.ndarray) -> list[np.ndarray]:
    """Starts of the windows to remove, per document of one group.

    ``ids`` ascend. ``elsewhere`` are the hashes that start in an earlier group.
    Documents with the same id do not count as earlier than each other.
    """
    if not ids:
        return []
    sizes = [len(h) for h in hashes]
    h = np.concatenate(hashes)
    row = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(h, kind="stable")  # within a hash: by document, then start
    h, row = h[order], row[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
    run = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    doc = np.asarray(ids)[row]
    gone = np.isin(h[starts], elsewhere)[run] | (doc > doc[starts][run])
    again = ~new
    again[1:] &= row[1:] == row[:-1]
    gone |= again
    mask = np.zeros(len(h), bool)
    mask[order] = gone
    return [np.flatnonzero(m) for m in np.split(mask, np.cumsum(sizes)[:-1])]


def _covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1  # starts are distinct, so are their ends
    edge[starts + window] -= 1
    return np.cumsum(edge[:n]) > 0


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string()),
    ]
)
_OUT_DDL = "doc_id long, n_words long, n_removed long, removed array<struct<first:long,end:long>>, kept_text string"


def _merge_stage(window: int, keep_layout: bool, out: pa.Schema):
    """Rows sorted by (group, class, part, kind, id): replies, then documents -> result rows."""

    def result(docs, elsewhere) -> Iterator[pa.RecordBatch]:
        ids = [d if d is not None else LAST_ID for d, *_ in docs]
        hashes = [window_hashes(words_of(t), window) for _, t, *_ in docs]
        found = removed_windows(ids, hashes, np.concatenate(elsewhere) if elsewhere else np.empty(0, np.uint64))
        rows = []
        for (doc_id, text, *carried), starts in zip(docs, found):
            words, spans, gone = words_of(text), [], 0
            n = len(words)
            if len(starts):
                covered = _covered(starts, n, window)
                gone = int(covered.sum())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                spans = [{"first": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                words = [words[i] for i in np.flatnonzero(~covered)]
            kept = (text or "") if keep_layout and not gone else b" ".join(words).decode()
            rows.append((doc_id, n, gone, spans, kept, *carried))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, elsewhere = None, [], []
        for batch in batches:
            for group, cls, part, hashes, *doc in zip(*batch.columns):
                place = group.as_py(), cls.as_py(), part.as_py()
                if place != now:
                    if docs:
                        yield from result(docs, elsewhere)
                    now, docs, elsewhere = place, [], []
                if hashes.is_valid:
                    elsewhere.append(np.frombuffer(hashes.as_py(), "<u8"))
                else:
                    docs.append(tuple(x.as_py() for x in doc))
        if docs:
            yield from result(docs, elsewhere)

    return run


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their group ``grp`` (the first id of it), class ``cls`` and a ``draw`` from
    0 to 1, and the table ``(h_id, h_cls, parts)`` of ids that more than ``GROUP`` rows share.

    Counts are one row per id; the tables of such ids are stored, so that Spark knows their bytes
    when it picks the joins.
    """
    order_id = F.coalesce("doc_id", F.lit(LAST_ID))
    text_class = F.pmod(F.xxhash64("text"), F.lit(CLASSES))
    counts = rows.select(order_id.alias("h_id"), text_class.alias("h_cls")).groupBy("h_id", "h_cls").agg(F.count(F.lit(1)).alias("n"))
    each = F.collect_list(F.struct("h_cls", F.ceil(F.col("n") / GROUP).cast("long").alias("parts"))).alias("each")
    shared = counts.groupBy("h_id").agg(F.sum("n").alias("n"), each).where(F.col("n") > GROUP)
    shared = stored(shared.select("h_id", F.inline("each")), "substring-shared-ids")
    block = F.shiftright("h_id", GROUP_BITS).alias("h_block")
    blocks = stored(shared.groupBy(block).agg(F.collect_set("h_id").alias("h_ids")), "substring-shared-blocks")
    own = F.shiftright(order_id, GROUP_BITS)
    # drawn before any shuffle, where the order of rows outlives a lost executor
    joined = rows.withColumn("draw", F.rand(7)).join(blocks, own == F.col("h_block"), "left")
    hot = F.coalesce(F.array_contains("h_ids", order_id), F.lit(False))
    before = F.array_max(F.filter("h_ids", lambda x: x < order_id))
    start = F.greatest(F.shiftleft(own, GROUP_BITS), before + F.lit(1))  # greatest skips a null
    grp, cls = F.when(hot, order_id).otherwise(start), F.when(hot, text_class).otherwise(F.lit(0)).cast("long")
    return joined.select(*rows.columns, "draw", grp.alias("grp"), cls.alias("cls")), shared


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), keep_layout: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, removed, kept_text``; with
    ``carry``, the struct ``carried`` of these columns of the row as well.

    A word is removed if a window of ``window`` words that covers it also starts
    earlier: in a document with a smaller id, or earlier in the same one; windows are
    judged on the input. ``removed`` are maximal half-open word intervals;
    ``kept_text`` joins the kept words by one space; with ``keep_layout`` a text that
    loses nothing stays as it is.

    Null and empty texts have no words and give an empty ``kept_text``. Rows with the
    same id are separate texts, neither earlier than the other. A null id comes after
    all others. An empty table gives an empty table; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else [])
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(chars // 6 // BUCKET) + 1
    grouped, shared = _grouped(rows)
    packed = grouped.select("grp", "cls", "text").mapInArrow(
        _pack_stage(window, buckets), "bucket int, hashes binary, places binary, groups binary, classes binary"
    )
    # buckets dealt evenly; a task takes its buckets one by one
    parts = min(buckets, 4 * shuffle_partitions(docs.sparkSession))
    dealt = packed.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    replies = dealt.mapInArrow(_count_stage, "grp long, cls long, hashes binary")
    # a row of a shared id goes to one part of its class, a reply to all of them
    same = (F.col("grp") == F.col("h_id")) & (F.col("cls") == F.col("h_cls"))
    part = F.coalesce(F.floor(F.col("draw") * F.col("parts")), F.lit(0)).cast("long").alias("part")
    placed = grouped.join(shared, same, "left").select(*rows.columns, "grp", "cls", part)
    parts_of = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1)
    told = replies.join(shared, same, "left").select(*replies.columns, F.explode(parts_of).alias("part"))
    both = placed.unionByName(told, allowMissingColumns=True)
    place = ("grp", "cls", "part")
    ordered = both.repartition(*place).sortWithinPartitions(*place, F.col("hashes").isNull(), F.col("doc_id").asc_nulls_last())
    out, schema = _OUT, T.StructType.fromDDL(_OUT_DDL)
    if carry:
        kind = rows.schema["carried"].dataType
        out, schema = out.append(pa.field("carried", to_arrow_type(kind))), schema.add("carried", kind)
    return ordered.select(*place, "hashes", *rows.columns).mapInArrow(_merge_stage(window, keep_layout, out), schema)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words kept of every document once repeated 20-word windows are removed."""
    from tidemark.sources.tables import table

    out = dedup_substrings(table(spark, sf_dir, "documents"), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
