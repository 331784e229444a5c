"""Toxicity classifier: boosted trees over dense features, calibrated by isotonic
regression.

1. Lexicon. On a bounded labelled sample, words and word beginnings whose document
   frequency among toxic texts is many times that among the others. A part of the
   sample gets its features from the lexicon of the other parts, so that training sees
   lexicon hits as rarely as new texts do; new texts get the lexicon of all parts.
2. Features of whole texts (``FEATURES``): lexicon densities, closeness of lexicon words
   to second-person words, capitals, punctuation, obfuscation.
3. Spark's gradient-boosted trees on the sample. Isotonic regression turns their margin
   into a probability; it is fitted on margins of every part by trees of the other parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, stored
from tidemark.llm.trees import Ensemble, balanced_sample

SAMPLE_ROWS = 20_000  # labelled rows that training reads, about
LEAST_TEXTS = 4  # toxic texts an entry must occur in
LEAST_RATIO = 8.0  # of its document frequencies, toxic to other
BEGINNINGS = (4, 5, 6, 7)  # letters of word beginnings
TREES, DEPTH, STEP = 15, 3, 0.3
SEED = 23
PARTS = 4
NEAR = 6  # words between a lexicon word and a second-person word
CACHE = 1 << 18

#: Second-person words of English, French, German and Spanish (fixed values).
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur thou thee tu te toi ton ta tes vous votre vos du dich dir dein deine deinen "
    "deiner ihr euch euer eure tú ti contigo tuyo tuya usted ustedes vosotros os vuestro vuestra".split()
)
#: Characters that stand for letters in disguised words (fixed values).
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "+": "t"})

FEATURES = (
    "distinct_hit_share", "distinct_hits", "hit_density", "best_hit", "weight_share", "beginning_share", "beginnings", "best_beginning",
    "second_person", "hits_near_second_person", "shouted_words", "upper", "exclaims", "questions", "punctuation",
    "disguised", "disguised_hits", "stretched", "log_words",
)
_LETTERS = re.compile(r"[^\W\d_]+").findall
_DISGUISED = re.compile(r"[^\W\d_][\d@$!|+*.\-_#]+[^\W\d_]").search
_STRETCHED = re.compile(r"([^\W\d_])\1\1").search
_EDGES = ".,;:!?\"'()%$#&*|"
_INNER = re.compile(r"[\W_]+")
_PUNCTUATION = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)


def terms_of(text: str) -> set[str]:
    """Words of a text in lower case, and their beginnings (marked by a hyphen)."""
    words = set(_LETTERS(text.lower()))
    return words | {f"{w[:n]}-" for w in words for n in BEGINNINGS if len(w) >= n}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, part, toxic, other): document frequencies of a task."""
    seen: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for text, label, part in zip(*(c.to_pylist() for c in batch.columns)):
            seen.setdefault((part, int(label)), Counter()).update(terms_of(text))
    for part in {p for p, _ in seen}:
        toxic, other = seen.get((part, 1), Counter()), seen.get((part, 0), Counter())
        terms = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([part] * len(terms), pa.int32()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([other[t] for t in terms], pa.int64())],
            names=["term", "part", "toxic", "other"],
        )


def lexicon_of(counts: DataFrame, toxic_texts: int, other_texts: int) -> dict[str, float]:
    """Term -> log ratio of document frequencies, for all telling terms; they are bounded
    by the texts of the labelled sample."""
    sums = counts.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    ratio = ((F.col("t") + 0.5) / F.lit(toxic_texts + 1.0)) / ((F.col("o") + 0.5) / F.lit(other_texts + 1.0))
    told = sums.where((F.col("t") >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)).select("term", F.log(ratio).alias("w"))
    return {r["term"]: float(r["w"]) for r in told.collect()}


class Featurizer:
    """A worker's feature maker: distinct words get a row of attributes once."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {k: v for k, v in lexicon.items() if not k.endswith("-")}
        self.starts = {k[:-1]: v for k, v in lexicon.items() if k.endswith("-")}
        self.heads = {k[: BEGINNINGS[0]] for k in self.starts}
        self._fresh()

    def _fresh(self) -> None:
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, 7))

    def _attributes(self, word: str) -> tuple:
        low = word.lower()
        letters = low.strip(_EDGES)
        disguised = hidden = 0.0
        if not letters.isalpha():
            letters = max(_LETTERS(low), key=len, default="")
            if _DISGUISED(low):
                plain = low.translate(DISGUISE)
                disguised = 1.0
                hidden = float(letters not in self.words and (_INNER.sub("", plain) in self.words or any(w in self.words for w in _LETTERS(plain))))
        start = 0.0
        if letters[: BEGINNINGS[0]] in self.heads:
            start = max((self.starts.get(letters[:n], 0.0) for n in BEGINNINGS if len(letters) >= n), default=0.0)
        shouted = float(len(letters) > 1 and word.isupper())
        return self.words.get(letters, 0.0), start, float(letters in SECOND_PERSON), shouted, disguised, hidden, float(_STRETCHED(low) is not None)

    def _rows(self, words: list[str]) -> list[int]:
        try:
            return [self.row[w] for w in words]
        except KeyError:
            new = [w for w in set(words) if w not in self.row]
            if len(self.row) + len(new) > CACHE:
                self._fresh()
                new = list(set(words))
            while len(self.row) + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            at = len(self.row)
            self.table[at : at + len(new)] = [self._attributes(w) for w in new]
            self.row.update(zip(new, range(at, at + len(new))))
            return [self.row[w] for w in words]

    def features(self, text: str) -> list[float]:
        """The features of one whole text; all zero for a text without words."""
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(FEATURES)
        counts = Counter(words)
        rows = self._rows(list(counts))
        once = self.table[rows]  # a word repeated a hundred times tells no more
        times = np.fromiter(counts.values(), float, len(counts))
        hit, person = once[:, 0] > 0, once[:, 2] > 0
        m = len(once)
        hits, starts = int(hit.sum()), int((once[:, 1] > 0).sum())
        near = 0
        if hits and person.any():
            told, meant = ({w for w, x in zip(counts, flag) if x} for flag in (hit, person))
            mine = np.array([i for i, w in enumerate(words) if w in told])
            at = np.array([i for i, w in enumerate(words) if w in meant])
            k = np.searchsorted(at, mine)
            gap = np.minimum(np.abs(mine - at[np.minimum(k, len(at) - 1)]), np.abs(mine - at[np.maximum(k - 1, 0)]))
            near = int((gap <= NEAR).sum())
        raw = np.frombuffer(text.encode(), np.uint8)
        seen = np.bincount(raw, minlength=256)
        sums = times @ once
        return [
            hits / m, float(hits), float(times[hit].sum()) / n, float(once[:, 0].max()), float(once[:, 0].sum()) / m,
            starts / m, float(starts), float(once[:, 1].max()),
            sums[2] / n, near / n, sums[3] / n, float(seen[65:91].sum()) / len(raw),
            float(seen[33]) / n, float(seen[63]) / n, float(seen[_PUNCTUATION].sum()) / len(raw),
            sums[4] / n, sums[5] / n, sums[6] / n, float(np.log1p(n)),
        ]


def _with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``rows(id, label, weight, text)`` -> ``id, label, weight, x`` with the features as an array."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # two bounded lexicons

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(shared.value)
        for batch in batches:
            x = [maker.features(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(x, pa.list_(pa.float64()))], names=["id", "label", "weight", "x"])

    return rows.select("id", "label", "weight", "text").mapInArrow(run, "id long, label double, weight double, x array<double>")


class Model:
    """Lexicon, trees and calibration; all bounded by this module's parameters."""

    def __init__(self, lexicon: dict[str, float], trees: Ensemble | None, knots: np.ndarray, levels: np.ndarray):
        self.lexicon, self.trees, self.knots, self.levels = lexicon, trees, knots, levels

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.levels[0])
        return np.interp(self.trees.probability(x), self.knots, self.levels)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on about ``sample_rows`` labelled documents, of a rare label as many as there
    are up to half of that, weighted back to their share. The trees see all rows; the
    calibration sees margins that trees of three parts give the fourth.

    Without labelled rows, or with one label only, the score is the share of label 1.
    """
    part = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(PARTS)).cast("int")
    rows = stored(balanced_sample(docs, labels, "toxic", sample_rows, id_col, text_col).withColumn("part", part), "toxic-sample")
    n = {(r["part"], int(r["label"])): r["count"] for r in rows.groupBy("part", "label").count().collect()}
    total = sum(n.values())
    ones = sum(k for (_, label), k in n.items() if label)
    if ones in (0, total):
        return Model({}, None, np.zeros(1), np.array([ones / total if total else 0.0]))
    counts = stored(rows.select("text", "label", "part").mapInArrow(_count_terms, "term string, part int, toxic long, other long"), "toxic-terms")

    def lexicon(parts: tuple[int, ...]) -> dict[str, float]:
        at = [sum(n.get((p, label), 0) for p in parts) for label in (1, 0)]
        return lexicon_of(counts.where(F.col("part").isin(*parts)), *at)

    parts = range(PARTS)
    crossed = [_with_features(rows.where(F.col("part") == p), lexicon(tuple(q for q in parts if q != p))) for p in parts]
    crossed = [c.withColumn("part", F.lit(p)) for p, c in zip(parts, crossed)]
    features = stored(reduce(DataFrame.unionByName, crossed), "toxic-features")
    def fit(sample: DataFrame) -> Ensemble:
        boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=64, minInstancesPerNode=3, weightCol="weight")
        return Ensemble(boosted.fit(sample.select("label", "weight", array_to_vector("x").alias("features"))))

    points = []
    for p in parts:  # out of fold, of the bounded sample
        held = features.where(F.col("part") == p).select("label", "x", "weight").toPandas()
        if not len(held):
            continue
        rest = [sum(n.get((q, label), 0) for q in parts if q != p) for label in (0, 1)]
        if min(rest):
            margin = fit(features.where(F.col("part") != p)).probability(np.array(held["x"].tolist()).reshape(-1, len(FEATURES)))
        else:  # all rows of a label lie in this part: the others know one answer
            margin = np.full(len(held), float(rest[1] > 0))
        points += zip(held["label"].tolist(), margin.tolist(), held["weight"].tolist())
    trees = fit(features)
    points = docs.sparkSession.createDataFrame(points, "label double, features double, weight double")
    iso = IsotonicRegression(weightCol="weight").fit(points)
    return Model(lexicon(tuple(parts)), trees, iso.boundaries.toArray(), np.clip(iso.predictions.toArray(), 0.0, 1.0))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score`` (0 to 1, higher: label 1 likelier).

    Null texts count as empty; a text without words has all features zero. Whole texts
    count. Repeated rows and null ids are kept; other columns are not read; an empty
    table gives an empty table. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(shared.value.lexicon)
        for batch in batches:
            x = np.array([maker.features(t.as_py() or "") for t in batch.column(1)], dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned where crc32(doc_id) mod 4 is not 2."""
    from tidemark.sources.tables import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    model = train(docs, labels.where(~held_out))
    scored = score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
