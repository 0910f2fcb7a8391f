"""Consecutive numbering that never puts a whole group in one task.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row of a
group to one task; one conversation (or one category) holding a third of all
rows would make that task the whole job.  Here the rows are cut into ranges of
(group, order), so a hot group is cut across many partitions.

The cuts are quantiles of a sample and become part of the plan, so every pass
puts a row into the same range, also after an executor is lost, and nothing is
checkpointed.  A range numbers its rows by itself; only its first group may have
begun before.  How many rows that group has in the ranges before is counted in
one pass over the narrow keys, for the group at each cut alone: at most one number a
range.  Then one shuffle, straight to the ranges, moves the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SAMPLE = 40  # sampled keys per range


def _cuts(keys: DataFrame, n: int) -> list[Row]:
    """The keys that begin the ranges 1 to n - 1, from a random sample (``n`` rows to the driver)."""
    sample = keys.select(F.struct(*keys.columns).alias("k")).orderBy(F.rand(17)).limit(_SAMPLE * n)
    every = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("ks", F.floor(i * F.size("ks") / n).cast("int")))
    row = sample.agg(F.sort_array(F.collect_list("k")).alias("ks")).where(F.size("ks") > 0).select(every.alias("cuts")).first()
    return list(row["cuts"]) if row is not None and n > 1 else []


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*(_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields))
    return F.lit(value).cast(kind)


def _range_of(key: Column, cuts: Column, n: int) -> Column:
    """Number of cuts up to ``key``, by binary search."""
    steps = F.array(*(F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= F.size(cuts)) & (F.get(cuts, at + s - 1) <= key), at + s).otherwise(at))


def number_rows(df: DataFrame, group_cols: list[str], order_cols: list[str],
                out: str = "position", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1, 2, ... within each group in ``order_cols`` order.

    Ties in ``order_cols`` are broken by a hash of the whole row, so the
    numbering is deterministic.  The result is in order of (group, order) from partition
    to partition.  ``df`` is read three times (keys, keys, rows) and must give the
    same rows each time.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Private names, whatever the caller's columns are called.
    groups, orders = [f"__n_g{i}" for i in range(len(group_cols))], [f"__n_o{i}" for i in range(len(order_cols))]
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = df.select("*", *(F.col(c).alias(a) for c, a in zip([*group_cols, *order_cols], [*groups, *orders])), F.xxhash64(*hashable).alias("__n_tie"))
    names = [*groups, *orders]
    cuts = _cuts(rows.select(*names), n)
    if len(set(map(str, cuts))) < len(cuts):   # a key that fills a range by itself: cut it by the tie
        names = [*names, "__n_tie"]
        cuts = _cuts(rows.select(*names), n)
    kind = rows.select(F.struct(*names).alias("k")).schema["k"].dataType
    literal = F.array(*(_literal(c, kind) for c in cuts)) if cuts else F.array().cast(T.ArrayType(kind))
    rows = rows.withColumn("__n_range", _range_of(F.struct(*names), literal, len(cuts)))

    def same_group(cut: Column) -> Column:
        """Whether a row's group is that of a cut."""
        same = cut.isNotNull()
        for g in groups:
            same = same & F.col(g).eqNullSafe(cut[g])
        return same

    before = [0] * (len(cuts) + 1)
    if cuts:
        # rows of each range that belong to the group at its end
        tail = rows.where(same_group(F.get(literal, F.col("__n_range")))).groupBy("__n_range").count()
        tails = {r["__n_range"]: r["count"] for r in tail.collect()}
        for i, cut in enumerate(cuts):
            goes_on = i > 0 and all(str(cut[g]) == str(cuts[i - 1][g]) for g in groups)
            before[i + 1] = tails.get(i, 0) + (before[i] if goes_on else 0)
    offset = F.when(same_group(F.get(literal, F.col("__n_range") - 1)), F.get(F.lit(before), F.col("__n_range"))).otherwise(F.lit(0))
    within = Window.partitionBy("__n_range", *groups).orderBy(*orders, "__n_tie")
    dealt = rows.repartitionById(len(cuts) + 1, F.col("__n_range"))
    return (dealt.withColumn(out, (F.row_number().over(within) + offset).cast("long"))
            .select(*(F.col(f"`{c}`") for c in df.columns if c != out), out))


def dense_codes(df: DataFrame, value_col: str, out: str = "code") -> DataFrame:
    """0-based dense codes for the distinct non-null values of one column, in
    ascending order.  Returns ``(value_col, out)``; distributed end to end."""
    distinct = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    numbered = number_rows(distinct, [], [value_col], out="_n")
    return numbered.select(value_col, (F.col("_n") - 1).alias(out))


def dense_rank_desc(df: DataFrame, value_col: str, out: str = "rank", max_bytes: int | None = None) -> DataFrame:
    """Dense rank by a numeric column, highest first (1 = highest; nulls
    last), over the whole frame.

    The frame is materialised once and its bytes are summed.  Within ``max_bytes``
    an ordered window in one task is bounded by proof; beyond it the
    distinct values are numbered with the distributed numbering and the
    ranks joined back, so no task ever holds the whole frame."""
    from kensa.operators.joins import SMALL_BYTES, checked_small
    m, small = checked_small(df, SMALL_BYTES if max_bytes is None else max_bytes)
    if small:
        return m.withColumn(out, F.dense_rank().over(Window.orderBy(F.desc(value_col))))
    # The window's order: NaN above every number, nulls below every number.
    key = F.when(F.col(value_col).isNull(), F.lit(1)).otherwise(F.lit(0))
    values = (m.select(value_col).distinct()
               .withColumn("_null", key)
              .withColumn("_nan", F.when(F.isnan(F.col(value_col).cast("double")), F.lit(0)).otherwise(F.lit(1)))
              .withColumn("_neg", -F.col(value_col)))
    ranks = number_rows(values, [], ["_null", "_nan", "_neg"], out=out).select(value_col, out)
    ranked = m.join(ranks, m[value_col].eqNullSafe(ranks[value_col]), "left").drop(ranks[value_col])
    return ranked.select(*m.columns, F.col(out).cast("int").alias(out))
