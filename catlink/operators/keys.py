"""Building blocks: uniqueness, first-of-group, ordered numbering, list columns.

All of them are plain aggregations, so Spark combines rows on the map side before the
shuffle and a key that holds a large share of the rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def only_single(df: DataFrame, keys: Sequence[str], count: Column | str = "*") -> DataFrame:
    """Rows of the keys that have exactly one row (or one non-NULL ``count`` value).

    One pass: a key with a single row is rebuilt from its own maximum, no join back. When
    ``count`` skips NULLs a key may keep further rows, so those are found by a semi-join.
    """
    if isinstance(count, str) and count == "*":
        rest = [c for c in df.columns if c not in keys]
        grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(F.struct(F.col(c).alias("v")))["v"].alias(c) for c in rest])
        return grouped.filter("_n = 1").select(*df.columns)
    value = F.col(count) if isinstance(count, str) else count
    ok = df.groupBy(*keys).agg(F.count(value).alias("_n")).filter("_n = 1").select(*keys)
    return df.join(ok, list(keys), "left_semi")


def repeated(df: DataFrame, keys: Sequence[str], count: str | None = None) -> DataFrame:
    """Keys with more than one row (or non-NULL ``count`` value)."""
    n = F.count(F.col(count) if count else F.lit(1))
    return df.groupBy(*keys).agg(n.alias("_n")).filter("_n > 1").select(*keys)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ascending order of ``order`` (NULLs first)."""
    values = [c for c in df.columns if c not in keys]
    rank = list(order) + [c for c in values if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in rank]))
    return df.groupBy(*keys).agg(first.alias("_f")).select([F.col(c) if c in keys else F.col("_f")[c].alias(c) for c in df.columns])


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column, out: str = "row_number") -> DataFrame:
    """``row_number`` within a group, without bringing a whole group into one task.

    ``bucket`` must not decrease along ``order`` and bounds the rows of one window partition.
    Rows are numbered inside (group, bucket) and shifted by the size of the earlier buckets,
    which come from a pre-aggregated count.
    """
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*group, "_bucket").orderBy(*order)
    local = b.withColumn("_local", F.row_number().over(inside))
    return local.join(offsets, [*group, "_bucket"]).withColumn(out, F.col("_before") + F.col("_local")).drop("_bucket", "_local", "_before")


def joined_text(value: str, separator: str) -> Column:
    """Aggregate: the non-NULL values in ascending order, separated."""
    return F.when(F.count(value) > 0, F.array_join(F.sort_array(F.collect_list(value)), separator))


def note_list(df: DataFrame, keys: Sequence[str], note: str, shown: int = 3) -> DataFrame:
    """The first ``shown`` notes per key as an array, without collecting the rest.

    The window limit on ``row_number`` is applied before the shuffle as well.
    """
    w = W.partitionBy(*keys).orderBy(note)
    top = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= shown)
    return top.groupBy(*keys).agg(F.sort_array(F.collect_list(note)).alias("notes"))


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference; NULLs compare equal."""
    return left.subtract(right.select(*left.columns))


def format_family(c: Column | str, family: Sequence[int]) -> Column:
    """One value for all formats of the family, the format itself otherwise."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isin(*family), F.lit(family[0])).otherwise(x)


def partners(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``left`` with the number of distinct ``value`` under its key in ``right`` and the lowest one.

    ``right`` is reduced to one row per key before the join, so a key that is frequent on both
    sides costs one row per left row, never the product.
    """
    per_key = right.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias("n_partners"), F.min(value).alias("first_partner"))
    return left.join(per_key, list(keys))
