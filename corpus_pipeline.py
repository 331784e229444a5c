"""The corpus pipeline: stages over ``documents``, each one operator's decision.

quality classifier      rejected documents go
SimHash near-dedup      one document of each group stays, the one with the smallest id (nulls last)
substring dedup         repeated 20-word windows go; a text that loses nothing stays as it is,
                        a document that loses all its words goes
mixing                  nine tenths of the tokens, by the production weights, from one epoch
                        (more would put copies back that the stages before took out)
BPE                     ids and digests of every text left

Decisions come back to rows by a key of all their columns, not by id: different rows of a null
or repeated id are judged apart, and of equal rows as many stay as the decision names (one
after near-dedup; as many as the mixture takes). Null texts count as empty. Every stage
takes an empty table to an empty table. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, simhash, substring
from tidemark.llm.common import crc_of_id, stored
from tidemark.session import ship_package
from tidemark.sources.tables import table

MIX_SHARE = (9, 10)
MIX_EPOCHS = 1


def row_key(docs: DataFrame) -> Column:
    """64 bits of all columns of a row, nulls told from values."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def whole_rows(docs: DataFrame) -> DataFrame:
    """``key, row``: every different row once."""
    rows = docs.select(row_key(docs).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.groupBy("key").agg(F.first("row").alias("row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").where(crc_of_id(F.col("doc_id")) % 3 != 1)
    return quality.keep_good(docs, quality.train(docs, labels), 0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 3 bits)."""
    ship_package(spark)
    rows = docs.select(row_key(docs).alias("key"), F.col("doc_id").alias("id"), F.col("text"))
    groups = simhash.near_duplicates(rows, shingle=3, radius=3, id_col="key")
    classes = groups.groupBy(F.col("doc_id").alias("key")).agg(F.first("component_id").alias("class"))
    named = classes.join(rows.groupBy("key").agg(F.first("id").alias("id")), "key")
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("key")
    kept = stored(named.groupBy("class").agg(first).select("key"), "pipeline-kept")
    return whole_rows(docs).join(kept, "key").select("row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated 20-word windows."""
    ship_package(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = substring.dedup_substrings(docs, window=20, carry=rest, keep_layout=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return left.select(*[columns[c].alias(c) if c in columns else F.col(f"carried.`{c}`").alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, as often as it takes them."""
    rows = docs.select(row_key(docs).alias("key"), "text", "lang", "source")
    plan = mixing.mix(rows, mixing.source_domain(F.col("source")), budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS, id_col="key")
    copies = plan.where(F.col("copies") > 0).groupBy(F.col("doc_id").alias("key")).agg(F.sum("copies").alias("copies"))
    taken = whole_rows(docs).join(stored(copies, "pipeline-mix"), "key")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their digest and that of the text they decode to."""
    ship_package(spark)
    encoded = bpe.encode(docs, bpe.default_vocabulary())
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding", bpe_stage),
]
ORACLE_SQL = None  # a classifier and BPE: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
