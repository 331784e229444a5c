"""Language identification, word first with back-off to character n-grams.

Training counts words and character n-grams (4 to 1, of words with their borders) per
language on a bounded sample of labelled rows. A known word scores its smoothed log
frequency in each language. A word that training has not seen falls back to its
characters: at every position the longest known n-gram scores, 4 characters first, then
3, 2 and 1. A document's score is the mean over its words, its language the largest,
its ``score`` that language's posterior share.

The model is bounded by its parameters, whatever the corpus: ``max_words`` words and
``max_grams`` n-grams of each length; it is broadcast as arrays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, stored

SAMPLE_ROWS = 3000  # labelled rows per language that training reads, about
MAX_WORDS = 50_000  # words kept, the most frequent ones
MAX_GRAMS = 50_000  # n-grams kept of each length
MIN_COUNT = 2  # of a word, to count as known
MAX_GROUPS = 1000  # languages to learn, at most: each is a column of the model
ORDERS = (4, 3, 2, 1)
ALPHA = 0.5  # added to every count
CACHE = 1 << 18  # words whose scores a worker remembers
TEXTS = 256  # texts scored at once
_BORDER = "\x02"
_letters = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _letters(text.lower()) if text else []


def _gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key of the n characters from each place on."""
    size = max(0, len(codes) - n + 1)
    key = np.full(size, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            key = (key ^ codes[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key


def _places(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of the words with their borders, how many of the word are left from
    each on, and the word each belongs to."""
    codes = np.frombuffer("".join(f"{_BORDER}{w}{_BORDER}" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return codes, np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes)), np.repeat(np.arange(len(words)), sizes)


class Model:
    """Scores of known words and n-grams, one column per language."""

    def __init__(self, langs: list[str], words: tuple[list[str], np.ndarray], grams: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.words, self.word_scores = {w: i for i, w in enumerate(words[0])}, words[1].astype(np.float32)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, (keys, scores) in grams.items():
            order = np.argsort(keys)
            self.grams[n] = keys[order], scores.astype(np.float32)[order]

    def unseen(self, words: list[str]) -> np.ndarray:
        """A row per word: the mean over its places of the longest known n-gram that
        starts there; zero (no evidence) for a word without any."""
        if not words:
            return np.zeros((0, len(self.langs)), np.float32)
        codes, left, of = _places(words)
        total = np.zeros((len(codes), len(self.langs)), np.float32)
        open_ = np.arange(len(codes))  # places without a known n-gram so far
        for n in ORDERS:
            keys, table = self.grams[n]
            at = open_[left[open_] >= n]
            if n == 1:
                at = at[codes[at] != ord(_BORDER)]
            if not len(keys) or not len(at):
                continue
            key = _gram_keys(codes, n)[at]
            hit = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            ok = keys[hit] == key
            total[at[ok]] = table[hit[ok]]
            left[at[ok]] = 0  # settled
            open_ = open_[left[open_] > 0]
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        seen = np.add.reduceat((left == 0).astype(np.float32), starts)
        return np.add.reduceat(total, starts, axis=0) / np.maximum(seen, 1.0)[:, None]


class Scorer:
    """A worker's scorer: distinct words get a row of scores, texts add rows up."""

    def __init__(self, model: Model):
        self.model = model
        self._fresh()

    def _fresh(self) -> None:
        self.row: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.langs)), np.float32)

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """Summed scores of each list of words."""
        words = set().union(*texts)
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > CACHE:
            self._fresh()
            new = words
        while len(self.row) + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        known, unseen = self.model.words, []
        for w in new:
            at = self.row[w] = len(self.row)
            if (hit := known.get(w)) is not None:
                self.scores[at] = self.model.word_scores[hit]
            else:
                unseen.append(w)
        self.scores[[self.row[w] for w in unseen]] = self.model.unseen(unseen)
        out = np.zeros((len(texts), len(self.model.langs)))
        for i, words in enumerate(texts):
            if words:
                out[i] = self.scores[list(map(self.row.__getitem__, words))].sum(axis=0, dtype=np.float64)
        return out


def predict(scorer: Scorer, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and its share for each text."""
    words = [words_of(t) for t in texts]
    langs = scorer.model.langs
    if not langs:
        return [("und", 0.0)] * len(texts)
    out = []
    for w, total in zip(words, scorer.totals(words)):
        # evidence of one text saturates: words of a text are far from independent
        share = np.exp((total - total.max()) / max(1.0, len(w) / 50.0))
        best = int(total.argmax())
        letters = any(c.isalpha() for word in w for c in word)  # numerals such as one half are none
        out.append((langs[best], float(share[best] / share.sum())) if letters else ("und", 0.0))
    return out


def sample(rows: DataFrame, group: str, per_group: int, key: Column) -> DataFrame:
    """About ``per_group`` rows of each group: those whose hashed key falls below the
    group's share (all rows of a smaller group). One count per group reaches the driver;
    the groups are a label's values, at most ``MAX_GROUPS`` (more are refused)."""
    counts = {r[group]: r["count"] for r in rows.groupBy(group).count().limit(MAX_GROUPS + 1).collect()}
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"column {group} has over {MAX_GROUPS} values: clean it before training")
    u = F.xxhash64(key, F.lit(7)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, per_group / n))).otherwise(share)
    return rows.where(u < share)


_COUNTS = "kind int, item string, gram long, lang string, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, item, gram, lang, n) of a task: kind 0 counts words, a higher one n-grams of
    that length by their keys."""
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))

    def rows(kind: int, items: list | None, grams: np.ndarray | None, lang: str, n) -> pa.RecordBatch:
        size = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * size, pa.int32()), pa.array(items or [None] * size, pa.string()),
             pa.array([None] * size if grams is None else grams.view(np.int64), pa.int64()), pa.array([lang] * size, pa.string()), pa.array(n, pa.int64())],
            names=["kind", "item", "gram", "lang", "n"],
        )

    for lang, words in counts.items():
        if not words:
            continue
        items, n = list(words), np.array(list(words.values()))
        yield rows(0, items, None, lang, n)
        codes, left, of = _places(items)
        for size in ORDERS:
            at = np.flatnonzero((left >= size) & ((size > 1) | (codes != ord(_BORDER))))
            keys, inverse = np.unique(_gram_keys(codes, size)[at], return_inverse=True)
            yield rows(size, None, keys, lang, np.bincount(inverse, n[of[at]], len(keys)).astype(np.int64))


def _most(counts: DataFrame, words: int, grams: int, least: int) -> DataFrame:
    """Of the items of at least ``least`` occurrences the ``words`` most frequent words and
    ``grams`` most frequent n-grams of each length, ties to the smaller item.

    A histogram of 16 steps per doubling (a few hundred rows) finds the step in which a limit
    falls; only the items of that step are ranked one by one."""
    totals = counts.groupBy("kind", "item", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    step = F.floor(F.log2("n") * 16)
    totals = stored(totals.withColumn("s", step), "langid-items")
    edge: dict[int, int] = {}  # by kind, the step in which its limit falls
    room: dict[int, int] = {}  # and the places left for it
    for r in sorted(totals.groupBy("kind", "s").count().collect(), key=lambda r: -r["s"]):
        k = r["kind"]
        left = room.setdefault(k, grams if k else words)
        if k not in edge:
            edge[k] = r["s"]
            if r["count"] < left:
                del edge[k]
                room[k] = left - r["count"]
    here, places = F.lit(None).cast("long"), F.lit(0)
    for k, s in edge.items():
        here = F.when(F.col("kind") == k, F.lit(s)).otherwise(here)
        places = F.when(F.col("kind") == k, F.lit(room[k])).otherwise(places)
    above = totals.where(here.isNull() | (F.col("s") > here)).select("kind", "item", "gram")
    if not edge:
        return above
    order = Window.partitionBy("kind").orderBy(F.desc("n"), "item", "gram")
    ranked = totals.where(F.col("s") == here).withColumn("rn", F.row_number().over(order))
    return above.unionByName(ranked.where((F.col("rn") <= max(room.values())) & (F.col("rn") <= places)).select("kind", "item", "gram"))


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS,
) -> Model:
    """Fit on about ``sample_rows`` rows per language (rows with a null text or language
    teach nothing). No labelled rows: a model without languages, which says ``und``."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    taken = sample(rows, "lang", sample_rows, F.col("id")).select("lang", "text")
    counted = stored(
        taken.mapInArrow(_count, _COUNTS).groupBy("kind", "item", "gram", "lang").agg(F.sum("n").alias("n")),
        "langid-counts",
    )
    sums = counted.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in sums})
    at = {lang: i for i, lang in enumerate(langs)}
    total = {(r["kind"], at[r["lang"]]): r["n"] for r in sums}
    most = _most(counted, max_words, max_grams, MIN_COUNT).alias("k")
    same = [F.col(f"c.{x}").eqNullSafe(F.col(f"k.{x}")) for x in ("kind", "item", "gram")]
    kept = counted.alias("c").join(most, reduce(lambda a, b: a & b, same), "left_semi")
    wide = kept.groupBy("kind", "item", "gram").pivot("lang", langs).agg(F.sum("n")).fillna(0).toArrow() if langs else None
    found: dict[int, tuple] = {}
    for kind in (0, *ORDERS):
        rows = wide.filter(pc.equal(wide["kind"], kind)) if langs else None
        items = rows["gram"].to_numpy().view(np.uint64) if kind and langs else rows["item"].to_pylist() if langs else np.empty(0, np.uint64)
        counts = np.stack([rows[lang].to_numpy() for lang in langs], axis=1) if langs else np.zeros((0, 0))
        base = np.array([total.get((kind, i), 0) for i in range(len(langs))], float) + ALPHA * (len(items) + 1)
        logs = np.log((counts + ALPHA) / base)
        found[kind] = items, logs - logs.sum(axis=1, keepdims=True) / max(1, len(langs))  # what sets languages apart
    words = found.pop(0)
    return Model(langs, words, found)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score``; nothing is shuffled.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter (empty
    texts too). Whole texts count, whatever their length. Ties go to the first language
    by name. Repeated rows and null ids are kept; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                out = predict(scorer, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned where crc32(doc_id) mod 4 is not 2."""
    from tidemark.sources.tables import table

    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    model = train(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
