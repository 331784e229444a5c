"""Source divergence audit: how far the vocabularies of a language's sources lie apart.

1. Tokenize. ``bytes.translate`` lowers A-Z and blanks every separator in one pass,
   ``bytes.split`` cuts, a Counter per document gives its terms. A task adds the documents
   of a (language, source) group up before anything is shuffled: occurrences and documents.
2. Keep. Per language, the terms in at least ``LEAST_DOCS`` of its documents.
3. Weigh. A group gives a kept term the share ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``,
   a term it lacks too; two shares differ by ``floor((p - q)^2 / (p + q))``. All in whole numbers.
4. Pairs. The sources of a language are cut into blocks; a pair of blocks and a slice of
   the terms meet in one task, as a table terms x sources. The terms that neither source
   holds all differ alike, so only kept counts above zero travel.
5. Terms. Each group's terms against the language's as a whole, the first ``TOP`` of them.

No task holds more than a slice of the terms for two blocks of sources. A hot source or a
frequent term costs one row per map task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
BLOCK = 256  # sources of a block
SLICE_ROWS = 8192  # counts of a slice, about, where blocks are small
HELD = 400_000  # entries that a map task adds up before it sends them on

_SPACE, _CASE = 0x20, 0x20
#: A-Z to a-z, all other ASCII but a-z to a blank; UTF-8 bytes above stay.
TRANSLATE = bytes(
    b + _CASE if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE for b in range(256)
)


def term_counts(text: str | None) -> Counter:
    """Terms of one text (as UTF-8) and how often each occurs."""
    return Counter((text or "").encode().translate(TRANSLATE).split())


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> counts of a task, sent on whenever ``HELD`` entries are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def send() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(list(n), pa.binary()).cast(pa.string()),
                 pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                schema=_COUNTS,
            )

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            terms = term_counts(text)
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            n.update(terms)
            docs.update(terms.keys())
            size += len(n)
            if size >= HELD:
                yield from send()
                held, size = {}, 0
    yield from send()


def counts_of(docs: DataFrame) -> DataFrame:
    """``docs(lang, source, text)`` -> ``lang, source, term, n, docs``: occurrences and
    documents of every term in every group."""
    parts = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # dealt by term, so that the language's sums below find their rows together
    dealt = parts.repartition("lang", "term")
    return dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Rows of the terms in at least ``least`` documents of their language, with the
    language's count ``n_lang`` and its first source with the term."""
    term = Window.partitionBy("lang", "term")
    rows = counts.withColumns({"n_lang": F.sum("n").over(term), "in_lang": F.sum("docs").over(term), "first": F.min("source").over(term)})
    return rows.where(F.col("in_lang") >= least).select("lang", "term", "source", "n", "n_lang", (F.col("first") == F.col("source")).alias("once"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``, exact."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, F.greatest(total + 2 * terms, F.lit(1)).cast("decimal(19,0)"))


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``, exact: shares are at most ``SCALE + 1``."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a - b) ** 2 // (a + b)


def _pair_stage(key, counts, sources):
    """One slice of the terms for two blocks of sources: what its terms add to the
    difference of every pair, beyond the terms that neither holds."""
    meta = {name: sources[name].to_numpy() for name in ("idx", "block", "p0", "terms")}
    lang, left, right, at = (k.as_py() for k in key)
    ij = [np.flatnonzero(meta["block"] == b) for b in (left, right)]
    a0, b0 = (meta["p0"][i] for i in ij)
    base = _differences(a0[:, None], b0[None, :])
    total = base * (meta["terms"][0] if at == 0 and len(meta["terms"]) else 0)  # slice 0 counts them all as lacking
    if counts.num_rows:
        row = counts["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        idx, p = counts["idx"].to_numpy(), counts["p"].to_numpy()
        order = np.argsort(row, kind="stable")
        row, idx, p = row[order], idx[order], p[order]
        step = max(1, (1 << 18) // max(len(a0) + len(b0), 1))  # terms of a table
        for first in range(0, int(row[-1]) + 1, step):
            lo, hi = np.searchsorted(row, [first, first + step])
            size = min(step, int(row[-1]) + 1 - first)
            tables = []
            for at_, p0 in zip(ij, (a0, b0)):
                table = np.repeat(p0[None, :], size, axis=0)
                place = np.searchsorted(meta["idx"][at_], idx[lo:hi])
                mine = place < len(at_)
                mine[mine] = meta["idx"][at_][place[mine]] == idx[lo:hi][mine]
                table[row[lo:hi][mine] - first, place[mine]] = p[lo:hi][mine]
                tables.append(table)
            a, b = tables
            for i in range(len(a0)):
                total[i] += (_differences(a[:, i : i + 1], b) - base[i]).sum(axis=0)
    i, j = (x.ravel() for x in np.meshgrid(meta["idx"][ij[0]], meta["idx"][ij[1]], indexing="ij"))
    once = i < j
    n = int(once.sum())
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "i": i[once], "j": j[once], "value": total.ravel()[once]})


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups(lang, source, idx, block, blocks, slices, p0, terms)`` and the kept counts
    ``(lang, term, idx, block, blocks, slices, p)`` -> ``lang, i, j, value`` for i < j."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ends = [F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")]
    dealt = kept.withColumn("other", other).select("lang", *ends, F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"), "term", "idx", "p")
    own = [F.col(c).alias(c) for c in ("lang", "slices", "idx", "block", "p0", "terms")]  # columns apart from those in ``kept``
    heads = groups.withColumn("other", other).select(*own, *ends)
    heads = heads.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).drop("slices")
    key = ["lang", "left", "right", "slice"]
    ordered = lambda key, counts, sources: _pair_stage(key, counts, sources.sort_by("idx"))
    found = dealt.groupBy(*key).cogroup(heads.groupBy(*key)).applyInArrow(ordered, "lang string, i int, j int, value long")
    return found.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``lang, source, part, item, value, rank``. Part ``pair``: every other source of the
    language, by how far its shares of the kept terms differ, added up. Part ``term``: the
    ``top`` terms that the source holds above the language's share, by how far.

    Ranks go from 1 per (language, source) and part, by value descending, then item ascending in
    UTF-8 order. Null texts, languages and sources count as empty ones; a text without terms
    still makes its group occur, and a language without kept terms has pairs of value 0.
    Repeated rows are documents of their own. Other columns are not read; an empty table
    gives an empty table.
    """
    cols = {"lang": lang_col, "source": source_col, "text": text_col}
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in cols.items()])
    kept = stored(kept_terms(counts_of(rows), least), "audit-kept")
    langs = kept.groupBy("lang").agg(F.count_if("once").alias("terms"), F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("rows"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    by_lang, zero = Window.partitionBy("lang"), F.lit(0).cast("long")
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["terms", "n_all", "n_group", "rows"])
    groups = groups.withColumn("idx", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn("block", F.expr(f"cast(idx div {BLOCK} as int)"))
    groups = groups.withColumn("blocks", F.max("block").over(by_lang) + 1)
    # a slice holds at least as many counts as it returns pairs
    wide = F.least(F.count(F.lit(1)).over(by_lang), F.lit(BLOCK))
    groups = groups.withColumn("slices", F.lit(1).cast("long") + F.call_function("div", F.col("rows"), F.greatest(F.lit(SLICE_ROWS), wide * wide)))
    groups = stored(groups.withColumn("p0", share(zero, F.col("n_group"), F.col("terms"))).drop("rows"), "audit-groups")
    weighed = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("n_group"), F.col("terms")))
    weighed = weighed.withColumn("q", share(F.col("n_lang"), F.col("n_all"), F.col("terms")))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    sides = _pairs(weighed, groups)
    both = F.explode(F.array(F.struct(F.col("i").alias("idx"), F.col("j").alias("other")), F.struct(F.col("j").alias("idx"), F.col("i").alias("other"))))
    sides = sides.select("lang", "value", both.alias("s")).select("lang", "value", "s.*")
    names = groups.select("lang", "source", "idx")
    sides = sides.join(names, ["lang", "idx"]).join(names.select("lang", F.col("source").alias("item"), F.col("idx").alias("other")), ["lang", "other"])
    pairs = sides.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    told = weighed.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    return pairs.unionByName(told.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def op11_source_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """Every source of every language against the others, and its own ten terms."""
    from tidemark.sources.tables import table

    return audit(table(spark, sf_dir, "documents"))


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    f = "((p - q) * (p - q)) // (p + q)"
    rank = "CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM t GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(c.n) FILTER (kept.term IS NOT NULL), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN kept USING (lang, term) GROUP BY lang, source),
e AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
  1 + ({SCALE}::HUGEINT * (kept.n + 2)) // (l.n + 2 * l.v) AS q FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, item, sum({f}) AS value FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM e a JOIN e b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, term AS item, ({f})::BIGINT AS value FROM e WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, {rank} FROM pair
UNION ALL SELECT lang, source, 'term', item, value, rank FROM (SELECT *, {rank} FROM term) WHERE rank <= {TOP}"""


SQL = _sql()
