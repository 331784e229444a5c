"""Column profiling and type reduction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import qcol
from tidemark.operators.index import IDX, N, SeriesSpec, resolve, with_index
from tidemark.session import written

_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_of(df: DataFrame, kinds) -> list[str]:
    """Columns whose type is one of ``kinds`` (Spark type classes)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))]


def select_as_double(df: DataFrame, columns) -> DataFrame:
    """Project ``columns`` and cast them to double."""
    return df.select(*[qcol(c).cast("double").alias(c) for c in columns])


def _missing(c: str, dtype) -> F.Column:
    x = qcol(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.sum((x.isNull() | F.isnan(x)).cast("long"))
    return F.sum(x.isNull().cast("long"))


def data_summary(df: DataFrame) -> DataFrame:
    """A1-A3 in one pass: per column ``missing`` (null or NaN) and, for numeric
    columns, mean, sample std, min and max ignoring NaN; plus ``rows`` and
    ``n_columns`` on every row. Long form, one row per column, in column order."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggs.append(_missing(f.name, f.dataType).alias(f"_m{i}"))
        if isinstance(f.dataType, T.NumericType):
            x = F.nanvl(qcol(f.name).cast("double"), F.lit(None).cast("double"))
            aggs += [F.avg(x).alias(f"_a{i}"), F.stddev_samp(x).alias(f"_s{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    one = df.agg(*aggs)
    nulld = F.lit(None).cast("double")
    rows = []
    for i, f in enumerate(fields):
        num = isinstance(f.dataType, T.NumericType)
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"_m{i}").alias("missing"),
                (F.col(f"_a{i}") if num else nulld).alias("mean"),
                (F.col(f"_s{i}") if num else nulld).alias("std"),
                (F.col(f"_lo{i}") if num else nulld).alias("min"),
                (F.col(f"_hi{i}") if num else nulld).alias("max"),
            )
        )
    return one.select(F.col("_rows").alias("rows"), F.lit(len(fields)).alias("n_columns"), F.explode(F.array(*rows)).alias("_r")).select(
        "rows", "n_columns", "_r.*"
    )


def _int_target(lo: F.Column, hi: F.Column) -> F.Column:
    """Downcast rule: unsigned when min >= 0 (u8/u16/u32 -> smallint/int/bigint in
    Spark, which has no unsigned types), otherwise signed with strict bounds."""
    return (
        F.when(lo >= 0, F.when(hi < 2**8, "smallint").when(hi < 2**16, "int").when(hi < 2**32, "bigint"))
        .when((lo > -(2**7)) & (hi < 2**7), "tinyint")
        .when((lo > -(2**15)) & (hi < 2**15), "smallint")
        .when((lo > -(2**31)) & (hi < 2**31), "int")
    )


def _int_label(lo: F.Column, hi: F.Column) -> F.Column:
    return (
        F.when(lo >= 0, F.when(hi < 2**8, "uint8").when(hi < 2**16, "uint16").when(hi < 2**32, "uint32"))
        .when((lo > -(2**7)) & (hi < 2**7), "int8")
        .when((lo > -(2**15)) & (hi < 2**15), "int16")
        .when((lo > -(2**31)) & (hi < 2**31), "int32")
    )


def distinct_counts(df: DataFrame, columns, exact: bool = True) -> dict[str, int]:
    """Distinct non-null values of each column, of all columns in one scan: exact counts
    from (column, value) pairs that are pre-aggregated in the task that reads them."""
    if not columns:
        return {}
    if not exact:
        row = df.agg(*[F.approx_count_distinct(qcol(c)).alias(f"_d{i}") for i, c in enumerate(columns)]).first()
        return {c: int(row[i]) for i, c in enumerate(columns)}
    counts = column_values(df, columns).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per column
    return dict.fromkeys(columns, 0) | {columns[r["i"]]: int(r["n"]) for r in counts}


def column_values(df: DataFrame, columns) -> DataFrame:
    """``(i, v)``: the different non-null values, as text, of the ``i``-th column."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    value = lambda c: qcol(c) + F.lit(0.0) if c in real else qcol(c)  # noqa: E731 - -0.0 is 0.0
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), value(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    return df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()


def downcast_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """The type each column would get, from one aggregation pass (and one for the
    distinct values of all string columns).

    Integers follow the min/max rule; double becomes float; a string column becomes
    a dictionary-coded category when distinct/rows < 0.5. Also reports the
    distinct ratio and the estimated bytes before and after.
    """
    fields = df.schema.fields
    distinct = distinct_counts(df, [f.name for f in fields if isinstance(f.dataType, T.StringType)], exact_distinct)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        x = qcol(f.name)
        if isinstance(f.dataType, _INTEGRAL):
            aggs += [F.min(x).cast("long").alias(f"_lo{i}"), F.max(x).cast("long").alias(f"_hi{i}")]
        if isinstance(f.dataType, T.StringType):
            aggs += [F.lit(distinct[f.name]).alias(f"_d{i}"), F.sum(F.octet_length(x)).alias(f"_b{i}")]
    one = df.agg(*aggs)
    rows_c = F.col("_rows")
    out = []
    for i, f in enumerate(fields):
        t = f.dataType
        src = F.lit(t.simpleString())
        nulll = F.lit(None).cast("long")
        if isinstance(t, _INTEGRAL):
            lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
            target = F.coalesce(_int_target(lo, hi), src)
            label = F.coalesce(_int_label(lo, hi), src)
            ratio = F.lit(None).cast("double")
            before = rows_c * _WIDTH[type(t)]
            width = (F.when(target == "tinyint", 1).when(target == "smallint", 2).when(target == "int", 4).otherwise(8))
            after = rows_c * width
        elif isinstance(t, T.DoubleType):
            lo = hi = nulll
            target, label, ratio = F.lit("float"), F.lit("float32"), F.lit(None).cast("double")
            before, after = rows_c * 8, rows_c * 4
        elif isinstance(t, T.StringType):
            lo = hi = nulll
            ratio = F.when(rows_c > 0, F.col(f"_d{i}") / rows_c)
            is_cat = ratio < 0.5
            target = F.when(is_cat, "int").otherwise(src)
            label = F.when(is_cat, "category").otherwise(F.lit("object"))
            strb = F.coalesce(F.col(f"_b{i}"), F.lit(0))
            before = strb
            # codes (4 bytes per row) plus a dictionary of about one value per distinct
            after = F.when(is_cat, rows_c * 4 + F.ceil(strb * ratio)).otherwise(strb)
        else:
            lo = hi = nulll
            target, label, ratio = src, src, F.lit(None).cast("double")
            before = after = rows_c * _WIDTH.get(type(t), 8)
        out.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                src.alias("source_type"),
                target.alias("target_type"),
                label.alias("numpy_type"),
                lo.alias("min"),
                hi.alias("max"),
                ratio.cast("double").alias("distinct_ratio"),
                before.cast("long").alias("bytes_before"),
                after.cast("long").alias("bytes_after"),
            )
        )
    return one.select(F.explode(F.array(*out)).alias("_r")).select("_r.*")


def size_saving(profile: DataFrame) -> DataFrame:
    """P5: total bytes before / after and percent saved."""
    return profile.agg(
        F.sum("bytes_before").alias("bytes_before"),
        F.sum("bytes_after").alias("bytes_after"),
    ).withColumn("saved_pct", F.when(F.col("bytes_before") > 0, (1 - F.col("bytes_after") / F.col("bytes_before")) * 100))


def optimize(df: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Apply the downcasts. Category columns become dense codes in sorted value
    order. The values of all of them come from one scan and are numbered together, each column
    from 0, with the distributed range index; the dictionary is stored by column, and each
    column is joined with its part of it (Spark picks the join by its bytes)."""
    prof = profile if profile is not None else downcast_profile(df)
    decisions = {r["column"]: (r["target_type"], r["numpy_type"]) for r in prof.select("column", "target_type", "numpy_type").collect()}
    out = df
    categories = [f.name for f in df.schema.fields if decisions[f.name][1] == "category"]
    if categories:
        values = with_index(column_values(df, categories), SeriesSpec(keys=("i",), order=("v",), chunk_rows=1 << 20))
        dictionary = written(values.select("i", F.col("v").alias("_v"), F.col(IDX).cast("int").alias("_code")), "dictionary", by="i")
    for f in df.schema.fields:
        target, label = decisions[f.name]
        if label == "category":
            dic = dictionary.where(F.col("i") == categories.index(f.name)).select("_v", "_code")
            out = out.join(dic, out[f"`{f.name}`"] == dic["_v"], "left").drop("_v").withColumn(f.name, F.col("_code")).drop("_code")
        elif target != f.dataType.simpleString():
            out = out.withColumn(f.name, qcol(f.name).cast(target))
    return out.select(*[qcol(f.name) for f in df.schema.fields])


def category_ratio(df: DataFrame, columns, exact: bool = True) -> DataFrame:
    """A4: distinct / rows for each column."""
    distinct = distinct_counts(df, list(columns), exact)
    one = df.agg(F.count(F.lit(1)).alias("_rows"))
    rows = [F.struct(F.lit(c).alias("column"), (F.lit(distinct[c]) / F.col("_rows")).alias("distinct_ratio")) for c in columns]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def with_chunks(df: DataFrame, spec: SeriesSpec, chunk_size: int = 10000, indexed: bool = False) -> DataFrame:
    """A5: ``chunk_id = floor(idx / chunk_size)`` over consecutive rows of each series."""
    if not indexed:
        spec, _ = resolve(df, spec)
    base = df if indexed else with_index(df, spec)
    return base.withColumn("chunk_id", F.floor(F.col(IDX) / F.lit(int(chunk_size))).cast("long"))


def process_in_chunks(df: DataFrame, spec: SeriesSpec, func, schema, chunk_size: int = 10000) -> DataFrame:
    """A5 with a user function: ``func(pandas.DataFrame) -> pandas.DataFrame`` per chunk,
    run by ``applyInPandas`` (each group holds at most ``chunk_size`` rows). The function gets
    the rows of a chunk in series order, with the input's columns and ``chunk_id``."""
    chunks = with_chunks(df, spec, chunk_size)

    def in_order(pdf):
        return func(pdf.sort_values(IDX, kind="stable").drop(columns=[IDX, N]).reset_index(drop=True))

    return chunks.groupBy(*spec.keys, "chunk_id").applyInPandas(in_order, schema)


def head(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """The first ``n`` rows in series order (top-k, no full sort)."""
    return df.orderBy(*[qcol(c) for c in (*spec.keys, *spec.order)]).limit(int(n))


def insufficient(df: DataFrame, group, min_rows: int, count_col: str = "sample_count") -> DataFrame:
    """Groups with fewer than ``min_rows`` rows get a ``skipped_reason``."""
    counts = df.groupBy(*[qcol(c) for c in group]).agg(F.count(F.lit(1)).alias(count_col))
    return counts.withColumn(
        "skipped_reason",
        F.when(F.col(count_col) < min_rows, F.lit("too few rows for a train, validation and test part")),
    )
