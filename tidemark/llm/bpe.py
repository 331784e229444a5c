"""Byte-level BPE encoding and decoding with a transducer of frequent words.

1. Words (pre-tokens) are counted over all texts: every task keeps a Misra-Gries
   summary of bounded size, the summaries are added up in Spark, and a histogram of the
   counts gives the threshold of the most frequent ``lexicon_words``.
2. The driver encodes those words and compiles them into a minimal acyclic transducer
   (``lexicon.py``), bounded by that parameter; the file goes to the shared folder, and
   executors map it into memory.
3. Tasks cut texts into words, walk the transducer with all new words at once, and
   merge the words it does not hold by the exact merge order, many at once in numpy.

What the lexicon holds changes the speed only; ids never depend on it. Ids equal
those of the ``tokenizers`` library for the same vocabulary file.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import publish, stored
from tidemark.llm.lexicon import Lexicon, compile_words

LEXICON_WORDS = 1 << 16  # frequent words compiled into the transducer, at most
SUMMARY = 1 << 16  # words a task's Misra-Gries summary keeps
MAX_WORD = 64  # bytes of the longest word the lexicon takes, and of the numpy merge
CACHE = 1 << 18  # words whose ids a worker remembers
FLUSH = 1 << 21  # characters a worker encodes at once
_NONE = np.int32(2**31 - 1)

# Characters whose class (letter, number, space, other) is the same in every Unicode
# version and library; texts of other characters are cut by the tokenizers library.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPACE = "\\t-\\r "
_PLAIN = re.compile(
    "[\\t-\\r -~¡-©«-±´¶-¸»¿-ɏ‐-‧‰-⁞€]*"
)
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
).findall


@lru_cache(maxsize=1)
def _library_cut():
    from tokenizers.pre_tokenizers import ByteLevel

    return ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str


def cut_words(text: str) -> list[str]:
    """The pre-tokens of a text without added tokens; joined they give the text."""
    if _PLAIN.fullmatch(text):
        return _WORDS(text)
    return [text[a:b] for _, (a, b) in _library_cut()(text)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes for themselves, the others by the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary as arrays: merges by pair, bytes by id."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level BPE vocabulary without a prefix space is needed")
        if model.get("dropout") or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError("dropout, ignore_merges and normalizers are not supported")
        vocab = model["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        tokens |= {i: c.encode() for c, i in added.items()}
        self.added = {c: np.array([i], "<u4").tobytes() for c, i in added.items()}
        # longest first where several added tokens start at one place
        self.split_added = re.compile("(" + "|".join(re.escape(c) for c in sorted(added, key=len, reverse=True)) + ")").split if added else None
        size = max(tokens) + 1
        self.sizes = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # open-addressing table: pair -> merge rank
        self._bits = max(4, int(len(pairs) * 4).bit_length())
        self._pair = np.full(1 << self._bits, -1, np.int64)
        self._rank = np.full(1 << self._bits, _NONE, np.int32)
        self.rank_of = {}
        mask = (1 << self._bits) - 1
        slots = self._slot(left, right).tolist()
        for rank, (key, at) in enumerate(zip((left << 32 | right).tolist(), slots)):
            if key in self.rank_of:
                continue
            self.rank_of[key] = rank
            while self._pair[at] != -1:
                at = (at + 1) & mask
            self._pair[at], self._rank[at] = key, rank

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (a * 0x9E3779B1 + b * 0x85EBCA77) & 0xFFFFFFFF
        return (x ^ (x >> 15)) & ((1 << self._bits) - 1)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids; none where an id is negative or unknown."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        key, at = (a << 32) | b, self._slot(a, b)
        found = self._pair[at]
        out = np.where(found == key, self._rank[at], _NONE)
        more = (found != key) & (found != -1)
        while more.any():
            at = (at + 1) & ((1 << self._bits) - 1)
            found = self._pair[at]
            out = np.where(more & (found == key), self._rank[at], out)
            more &= (found != key) & (found != -1)
        out[b < 0] = _NONE
        return out

    def _merge_long(self, word: bytes) -> bytes:
        """One long word by a heap of pairs over a linked list."""
        import heapq

        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := self.rank_of.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has been merged meanwhile
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Exact ids of each word, packed: the leftmost pair of the lowest rank merges
        until none is left."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > MAX_WORD:
                out[i] = self._merge_long(w)
            elif w:
                by_size.setdefault((len(w) + 3) // 4 * 4, []).append(i)
        for width, members in by_size.items():
            for k in range(0, len(members), step := max(1, (1 << 17) // width)):
                block = members[k : k + step]
                self._merge_block([words[i] for i in block], width, block, out)
        return out

    def _merge_block(self, words: list[bytes], width: int, places: list[int], out: list[bytes]) -> None:
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.where(np.arange(width) < sizes[:, None], self.byte_ids[data], np.int32(-1))
        live = np.arange(len(words))
        work = ids
        ranks = self._ranks(work[:, :-1], work[:, 1:]) if width > 1 else np.empty((len(words), 0), np.int32)
        columns = np.arange(width)
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            go = best != _NONE
            if not go.all():
                ids[live[~go]] = work[~go]
                live, work, ranks, at, best = live[go], work[go], ranks[go], at[go], best[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            # close the gap: everything right of the merged pair moves one place left
            work = np.concatenate([work, np.full((len(live), 1), -1, np.int32)], axis=1)
            work = work[rows[:, None], columns + (columns > at[:, None])]
            work[rows, at] = self.merged[best]
            ranks = np.concatenate([ranks, np.full((len(live), 1), _NONE, np.int32)], axis=1)
            ranks = ranks[rows[:, None], columns[:-1] + (columns[:-1] > at[:, None])]
            right = np.minimum(at, width - 2)
            ranks[rows, right] = self._ranks(work[rows, right], work[rows, right + 1])
            left = np.maximum(at - 1, 0)
            ranks[rows, left] = self._ranks(work[rows, left], work[rows, left + 1])
        counts = (ids >= 0).sum(axis=1).tolist()
        flat = ids[ids >= 0].astype("<u4").tobytes()
        end = 0
        for place, n in zip(places, counts):
            out[place] = flat[end : end + 4 * n]
            end += 4 * n

    def decode_many(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each packed id sequence stands for."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = self.sizes[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.pool[np.repeat(self.starts[flat] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([len(x) // 4 for x in ids])]
        return [data[a:b] for a, b in zip(np.concatenate([[0], cuts[:-1]]).tolist(), cuts.tolist())]


class _Encoder:
    """A worker's encoder: words through cache, transducer, then exact merges."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHE:
            self.known = {}
        new = [w for w in words if w not in self.known]
        raw = [w.encode() for w in new]
        ranks = self.lexicon.ranks(raw)
        unseen = []
        for w, rank in zip(new, ranks.tolist()):
            if rank >= 0:
                self.known[w] = self.lexicon.packed_ids(rank)
            else:
                unseen.append(w)
        self.known.update(zip(unseen, self.vocabulary.merge([w.encode() for w in unseen])))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = self.vocabulary.split_added
        added = self.vocabulary.added
        cut: list[list] = []
        words: set[str] = set()
        for text in texts:
            if split and any(a in text for a in added):
                pieces = [p if k % 2 else cut_words(p) for k, p in enumerate(split(text))]
            else:
                pieces = [cut_words(text)]
            cut.append(pieces)
            for p in pieces:
                if isinstance(p, list):
                    words.update(p)
        self.learn(words)
        get = self.known.__getitem__
        return [b"".join(b"".join(map(get, p)) if isinstance(p, list) else added[p] for p in pieces) for pieces in cut]


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(vocab_path: str, lexicon_file: str) -> _Encoder:
    """This worker's encoder; the last one is kept for the worker's next task."""
    if lexicon_file not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[lexicon_file] = _Encoder(Vocabulary.load(SparkFiles.get(vocab_path)), Lexicon.open(SparkFiles.get(lexicon_file)))
    return _ENCODERS[lexicon_file]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's Misra-Gries summary: counts are too low by the same bounded share of
    the task's words at most, and any word above that share is in it."""
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(cut_words(text.as_py()))
            if len(counts) > 2 * SUMMARY:
                least = sorted(counts.values(), reverse=True)[SUMMARY]
                counts = Counter({w: n - least for w, n in counts.items() if n > least})
    if len(counts) > SUMMARY:
        least = sorted(counts.values(), reverse=True)[SUMMARY]
        counts = Counter({w: n - least for w, n in counts.items() if n > least})
    kept = [(w, n) for w, n in counts.items() if len(w) <= MAX_WORD]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
    )


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """At most ``most`` of the most frequent words of all texts, by summed summaries."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    counts = stored(texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
    # counts by steps of a 16th of a doubling: a few hundred rows at any size
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for row in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        total += row["count"]
        if total > most:
            break
        least = row["s"]
    if least is None:
        return []
    return [r["word"] for r in counts.where(step >= least).select("word").collect()]


def build_lexicon(words: list[str], vocabulary: Vocabulary) -> bytes:
    raw = [w.encode() for w in words]
    return compile_words({w: np.frombuffer(x, "<u4").tolist() for w, x in zip(raw, vocabulary.merge(raw))})


def encode(
    docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS
) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids, decoded``.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded`` is the text that
    decoding them gives (bytes that are not UTF-8 become U+FFFD). Texts of added tokens
    become their ids, as the library does; none are put around a text. Null and empty
    texts have no ids and decode to the empty text. Repeated rows and null ids are kept;
    other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.load(vocab_path)
    lexicon = publish(spark, build_lexicon(frequent_words(docs, text_col, lexicon_words), vocabulary), "bpe-lexicon")
    with open(vocab_path, "rb") as f:
        vocab = publish(spark, f.read(), "bpe-vocabulary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocab, lexicon)

        def result(held: list[tuple]) -> pa.RecordBatch:
            ids = coder.encode([t for _, t in held])
            back = [x.decode("utf-8", "replace") for x in coder.vocabulary.decode_many(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in held], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.append((doc_id.as_py(), text.as_py() or ""))
                size += len(held[-1][1])
                if size >= FLUSH:
                    yield result(held)
                    held, size = [], 0
        if held:
            yield result(held)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path("byte_bpe_50k.json"))


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    from tidemark.sources.tables import table

    return digests(encode(table(spark, sf_dir, "documents"), default_vocabulary()))
