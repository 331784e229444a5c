"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Every whole text gets a row of statistics (``STATISTICS``).
2. Shallow trees are grown on a bounded labelled sample; every path from a root to a
   node is a rule, a conjunction of thresholds on statistics.
3. A lasso logistic regression weighs the rules; most weights become zero.
4. The rest compile into one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.common import crc_of_id, stored
from tidemark.llm.trees import Condition, labelled_sample, rule_column, rules_of

SAMPLE_ROWS = 20_000  # labelled rows that training reads, about
TREES, DEPTH = 16, 3
LASSO = 0.0005  # weight of the L1 penalty
SEED = 17

STATISTICS = (
    "log_chars", "log_words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "next_equal",
    "word_ends_symbol", "capital_words", "lone_symbols", "upper", "digits", "spaces", "newlines", "stops", "commas",
    "exclaims", "bars", "symbols", "byte_entropy", "lines_repeated", "line_length", "sentence_words",
)
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", np.uint8)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; all zero for an empty one."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    sizes = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    equal = sum(map(bytes.__eq__, words, words[1:]))
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    upper = int(seen[65:91].sum())
    share = seen[seen > 0] / size
    lines = [x for x in raw.split(b"\n") if x.strip()]
    stops = int(seen[46] + seen[33] + seen[63])
    shouted = sum(map(str.isupper, text.split())) if upper * 5 > size else 0
    symbols = int(seen[_SYMBOLS].sum())
    return [
        float(np.log1p(size)), float(np.log1p(n)), float(sizes.mean()), float((sizes > 15).mean()), float((sizes < 3).mean()),
        len(counts) / n, max(counts.values()) / n, equal / n,
        float(np.isin(ends, _SYMBOLS).mean()), shouted / n, sum(counts[s] for s in (b"|", b"*", b"#", b"-", b"=", b"&", b"+")) / n,
        upper / size, float(seen[48:58].sum()) / size, float(seen[32]) / size, float(seen[10]) / size,
        stops / n, float(seen[44]) / n, float(seen[33]) / n, float(seen[124]) / n, symbols / size,
        float(-(share * np.log2(share)).sum()), 1 - len(set(lines)) / len(lines), float(np.log1p(size / len(lines))),
        float(np.log1p(n / (stops + 1))),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(text: pd.Series) -> pd.Series:
    """The statistics of each text (null: empty) in a column; a few hundred bytes a row."""
    return pd.Series([statistics(t or "") for t in text])


class RuleEnsemble:
    """``base`` plus the weights of the rules that hold, as log odds of label 1."""

    def __init__(self, base: float, rules: list[tuple[tuple[Condition, ...], float]]):
        self.base, self.rules = base, rules

    def column(self, found: Column) -> Column:
        """The score as an expression over the array of statistics."""
        features = [found[i] for i in range(len(STATISTICS))]
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.lit(weight) * rule_column(rule, features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[f]} {'<=' if low else '>'} {t:.4g}" for f, t, low in rule) for rule, w in self.rules]


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> RuleEnsemble:
    """Fit on about ``sample_rows`` labelled documents of ``docs``.

    Without labelled rows, or with one label only, the ensemble has no rules and scores
    everything by the share of label 1 (1 if nothing is labelled: nothing is rejected).
    """
    rows = labelled_sample(docs, labels, "quality", sample_rows, id_col, text_col)
    rows = stored(rows.select("label", statistics_of("text").alias("s")), "quality-sample")
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        share = min(max((ones or 0) / n if n else 1.0, 1e-6), 1 - 1e-6)
        return RuleEnsemble(float(np.log(share / (1 - share))), [])
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.5, featureSubsetStrategy="onethird", minInstancesPerNode=5, maxBins=64
    ).fit(rows.select("label", array_to_vector("s").alias("features")))
    rules = sorted({r for tree in forest.trees for r in rules_of(tree)})
    if not rules:
        return RuleEnsemble(float(np.log(ones / (n - ones))), [])
    columns = [F.col("s")[i] for i in range(len(STATISTICS))]
    holds = stored(rows.select("label", F.array(*[rule_column(r, columns) for r in rules]).alias("holds")), "quality-rules")
    fit = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(
        holds.select("label", array_to_vector("holds").alias("features"))
    )
    weights = fit.coefficients.toArray()
    return RuleEnsemble(float(fit.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0])


def score(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score`` (0 to 1, higher: label 1 likelier).

    Null texts count as empty; empty and wordless texts have all statistics zero and are
    scored by the rules like any other. Repeated rows and null ids are kept; other
    columns are not read; an empty table gives an empty table. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), statistics_of(F.col(text_col).cast("string")).alias("s"))
    return rows.select("doc_id", model.column(F.col("s")).alias("score"))


def keep_good(docs: DataFrame, model: RuleEnsemble, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more. Nothing is
    shuffled or joined; names of columns cannot clash."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), statistics_of(F.col(text_col).cast("string")).alias("s"))
    return rows.where(model.column(F.col("s")) >= least).select("row.*")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned where crc32(doc_id) mod 3 is not 1."""
    from tidemark.sources.tables import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = train(docs, labels.where(~held_out))
    scored = score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
