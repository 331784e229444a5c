"""Mixing sources to target weights by hierarchical budgeting, in DataFrame
operations only.

Documents are leaves' rows in a tree: domain, language, source. A token budget runs down
the tree. At every node it is shared among the children by weight; a child takes at most
what its leaves hold in ``max_epochs`` epochs, and what it cannot take goes to
its siblings by weight, until they are full too. So a shortage is made up within
the language before the domain, and within the domain before the others.

A leaf's budget is spent in epochs: as many whole ones as it covers, then a prefix of
one more, in an order drawn from seed, epoch and document id. A document belongs to the
prefix if the tokens before it are fewer than what is left.

Scale: documents meet in groups only as sums per leaf and per hash bucket of a leaf
(added up before the shuffle). Of every leaf only the one bucket in which the prefix ends,
about ``BUCKET_ROWS`` documents, is ordered row by row; a leaf with a third of all
rows has as many more buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BUCKET_ROWS = 512
NONE = "(none)"  # the value of a null on a level
LEVELS = ("domain", "lang", "source")
_TOP = 1 << 60

#: Production weights: by domain and language, sources alike.
WEIGHTS = ({"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "fr": 2, "de": 2, "es": 1}, {})
BUDGET_SHARE = (4, 5)  # of all tokens
MAX_EPOCHS = 3
SEED = 20


def tokens_of(text: Column) -> Column:
    """Words: runs without space or tab..carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(seed: int, epoch: Column, doc_id: Column, sign: Column) -> Column:
    """A document's place in an epoch, 0 up to 2**60: digits of an MD5, as any engine
    has it. ``sign`` (of its text) sets documents of a null or repeated id apart."""
    key = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), sign)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def sign_of(text: Column) -> Column:
    """16 digits of a text's MD5 (null: of the empty one)."""
    return F.substring(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")), 1, 16)


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """The weight of a node by its value on ``level``."""
    weight = F.lit(1)
    for value, w in weights.items():
        weight = F.when(F.col(level) == value, F.lit(int(w))).otherwise(weight)
    return weight


def _share(children: DataFrame, parents: DataFrame | None, keys: Sequence[str], weights: Mapping[str, int], total: int) -> DataFrame:
    """``children(keys, cap)`` with ``budget``: the parent's, shared by weight up to cap.

    Children that are full at the common level are those of the smallest cap per
    weight; the level follows from what the others weigh.
    """
    level, above = keys[-1], list(keys[:-1])
    weight = _weight(level, weights)
    rows = children.withColumn("w", weight.cast("long")).withColumn("c", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
    rows = rows.join(parents.select(*above, F.col("budget").alias("b")), above) if parents is not None else rows.withColumn("b", F.lit(total).cast("long"))
    ratio = F.when(F.col("w") > 0, F.col("c") / F.col("w")).otherwise(F.lit(-1.0))
    group = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
    order = group.orderBy("ratio", level)
    rows = rows.withColumn("ratio", ratio).withColumns(
        {
            "c_before": F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c"),
            "w_from": F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    rows = rows.withColumn("t", F.when(F.col("w_from") > 0, (F.col("b") - F.col("c_before")) / F.col("w_from")))
    rows = rows.withColumn("full", F.col("c") <= F.col("w") * F.coalesce("t", F.lit(0.0)))
    rows = rows.withColumn("t", F.max(F.when(~F.col("full"), F.col("t"))).over(group))
    budget = F.when(F.col("full"), F.col("c")).otherwise(F.least("c", F.greatest(F.lit(0), F.floor(F.col("w") * F.col("t")))))
    return rows.select(*keys, *[x for x in children.columns if x not in keys], budget.cast("long").alias("budget"))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, int]], total: int, max_epochs: int) -> DataFrame:
    """``leaves(levels, docs, tokens)`` with each leaf's token ``budget``. Weights are
    whole numbers per value of a level (1 where none is given; 0: nothing). What lies
    below a weight of 0 adds nothing to the capacity of the nodes above. Shares are rounded
    down, so the sum may fall short by a token per node."""
    weighs = F.lit(True)
    for level, given in zip(levels, weights):
        weighs = weighs & (_weight(level, given) > 0)
    caps = leaves.withColumn("cap", F.when(weighs, F.col("tokens") * F.lit(max_epochs)).otherwise(F.lit(0)).cast("long"))
    parents = None
    for i in range(len(levels)):
        keys = list(levels[: i + 1])
        last = i == len(levels) - 1
        nodes = caps if last else caps.groupBy(*keys).agg(F.sum("cap").alias("cap"))
        parents = stored(_share(nodes, parents, keys, weights[i], total), f"mix-level-{i}")
    return parents


def mix(
    docs: DataFrame, domain: Column, weights: Sequence[Mapping[str, int]] = WEIGHTS, budget_share: tuple[int, int] = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """One row per input row: ``doc_id, domain, lang, source, n_tokens, copies``.

    ``copies`` is the number of epochs that hold the document (0: not selected). The
    budget is ``budget_share`` (a fraction) of all tokens, at most what ``max_epochs``
    epochs hold. ``domain`` is an expression over the columns of ``docs``.

    Null levels count as the value ``(none)``. Null and empty texts have no tokens; like
    any document they are in whole epochs, and in a prefix that has not ended (a leaf
    without any tokens selects nothing). Ties in
    the order go by id, then length; equal rows are interchangeable. Rows of a null or
    repeated id are drawn apart by their texts. Other columns are not read; an empty table gives an empty table.
    """
    levels = list(LEVELS)
    cols = [domain.alias("domain"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for c, n in zip(cols, levels)], tokens_of(F.col(text_col)).alias("n_tokens"), sign_of(F.col(text_col)).alias("sign"))
    rows = stored(rows, "mix-rows")
    leaves = stored(rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")), "mix-leaves")
    tokens = int(leaves.agg(F.sum("tokens")).first()[0] or 0)
    total = tokens * budget_share[0] // budget_share[1]
    plan = budgets(leaves, levels, weights, total, max_epochs).where(F.col("tokens") > 0)
    plan = plan.withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    plan = stored(plan.withColumn("buckets", F.ceil(F.col("docs") / F.lit(BUCKET_ROWS))).select(*levels, "epochs", "rest", "buckets"), "mix-plan")
    placed = rows.join(plan, levels, "left").withColumn("u", draw(seed, F.col("epochs"), F.col("doc_id"), F.col("sign")))
    placed = placed.withColumn("bucket", F.floor(F.col("u") * F.col("buckets").cast("double") / F.lit(float(_TOP))))
    placed = stored(placed.select("doc_id", *levels, "n_tokens", "epochs", "rest", "u", "bucket"), "mix-placed")
    # the bucket of each leaf in which its prefix ends, and the tokens before it
    sums = placed.where(F.col("rest") > 0).groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    before = F.sum("n").over(Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ends = sums.withColumn("before", before).where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
    ends = stored(ends.groupBy(*levels).agg(F.max("bucket").alias("last"), F.max_by("before", "bucket").alias("before")), "mix-ends")
    known = stored(placed.join(ends, levels, "left"), "mix-known")
    epochs = F.coalesce("epochs", F.lit(0))
    out = ["doc_id", *levels, "n_tokens"]
    on_edge = F.coalesce(F.col("bucket") == F.col("last"), F.lit(False))
    plain = known.where(~on_edge).select(*out, (epochs + F.coalesce((F.col("bucket") < F.col("last")).cast("long"), F.lit(0))).alias("copies"))
    w = Window.partitionBy(*levels).orderBy("u", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("before") + F.sum("n_tokens").over(w) - F.col("n_tokens")
    edge = known.where(on_edge).withColumn("start", start).select(*out, (epochs + (F.col("start") < F.col("rest")).cast("long")).alias("copies"))
    return plain.unionByName(edge)


def source_domain(source: Column) -> Column:
    """The domain of a numbered source: its number's remainder by four, which its last two
    digits tell, however long it is."""
    number = F.regexp_extract(source, r"[0-9]+", 0)
    return F.when(number != "", F.concat(F.lit("d"), F.pmod(F.substring(number, -2, 2).cast("int"), F.lit(4)).cast("string")))


def op1_mixing_sources(spark, sf_dir: str) -> DataFrame:
    """How many epochs of the production mixture hold each document."""
    from tidemark.sources.tables import table

    return mix(table(spark, sf_dir, "documents"), source_domain(F.col("source")))


def _sql() -> str:
    def weight(level: int) -> str:
        cases = " ".join(f"WHEN {LEVELS[level]} = '{v}' THEN {w}" for v, w in WEIGHTS[level].items())
        return f"CASE {cases} ELSE 1 END" if cases else "1"

    def share(i: int) -> str:
        keys = list(LEVELS[: i + 1])
        above = ", ".join(keys[:-1])
        by = f"PARTITION BY {above} " if above else ""
        tail = "docs, tokens, " if i == 2 else ""
        source = "cap3" if i == 2 else f"(SELECT {', '.join(keys)}, sum(cap)::BIGINT AS cap FROM cap3 GROUP BY ALL)"
        parent = f"JOIN b{i - 1} USING ({above})" if above else "CROSS JOIN (SELECT total AS budget FROM total)"
        return f"""
n{i} AS (SELECT {', '.join(keys)}, {tail}cap, ({weight(i)})::BIGINT AS w, budget AS b FROM {source} {parent}),
m{i} AS (SELECT *, CASE WHEN w > 0 THEN cap ELSE 0 END AS c, CASE WHEN w > 0 THEN cap / w ELSE -1.0 END AS ratio FROM n{i}),
f{i} AS (SELECT *, (sum(c) OVER o - c)::BIGINT AS c_before, (sum(w) OVER ({by}ORDER BY ratio, {keys[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w_from
  FROM m{i} WINDOW o AS ({by}ORDER BY ratio, {keys[-1]} ROWS UNBOUNDED PRECEDING)),
g{i} AS (SELECT *, CASE WHEN w_from > 0 THEN (b - c_before) / w_from END AS t FROM f{i}),
h{i} AS (SELECT *, c <= w * coalesce(t, 0.0) AS filled FROM g{i}),
b{i} AS (SELECT {', '.join(keys)}, {tail}
  (CASE WHEN filled THEN c ELSE least(c, greatest(0, floor(w * max(CASE WHEN NOT filled THEN t END) OVER ({by.strip()})))) END)::BIGINT AS budget FROM h{i})"""

    num, den = BUDGET_SHARE
    weighs = " AND ".join(f"({weight(i)}) > 0" for i in range(len(LEVELS)))
    number = "regexp_extract(source, '[0-9]+')"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(CASE WHEN {number} <> '' THEN 'd' || (right({number}, 2)::INTEGER % 4) END, '{NONE}') AS domain,
    coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens, substr(md5(coalesce(text, '')), 1, 16) AS sign FROM documents),
cap3 AS (SELECT domain, lang, source, count(*) AS docs, sum(n_tokens)::BIGINT AS tokens, (sum(CASE WHEN {weighs} THEN n_tokens ELSE 0 END) * {MAX_EPOCHS})::BIGINT AS cap FROM d GROUP BY ALL),
total AS (SELECT (sum(tokens)::BIGINT * {num}) // {den} AS total FROM cap3),{share(0)},{share(1)},{share(2)},
plan AS (SELECT domain, lang, source, floor(budget / tokens)::BIGINT AS epochs, budget - floor(budget / tokens)::BIGINT * tokens AS rest FROM b2 WHERE tokens > 0),
u AS (SELECT d.*, coalesce(epochs, 0) AS epochs, coalesce(rest, 0) AS rest,
  ('0x' || substr(md5('{SEED}:' || coalesce(epochs, 0)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '') || ':' || sign), 1, 15))::BIGINT AS u
  FROM d LEFT JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens,
  epochs + (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY u, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens < rest)::BIGINT AS copies
FROM u"""


SQL = _sql()
