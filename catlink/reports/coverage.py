"""How much of the catalogs is linked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from catlink.config import Catalog
from catlink.functions.text import percent


def coverage(a: Catalog, b: Catalog) -> DataFrame:
    """(entity, a_total, b_total, links, percent), one row per entity kind.

    The share refers to catalog A's total; for release groups to catalog B's, which is the smaller.
    """
    def count(df: DataFrame, entity: str, what: str) -> DataFrame:
        zero = {k: F.lit(0).cast("bigint").alias(k) for k in ("a_total", "b_total", "links")}
        n = df.agg(F.count("id").alias("n"))
        return n.select(F.lit(entity).alias("entity"), *[F.col("n").alias(k) if k == what else zero[k] for k in zero])

    tables = {
        "release": (a.release, b.release, a.release_link),
        "release_group": (a.release_group, b.master, a.release_group_link),
        "artist": (a.artist, b.artist, a.artist_link),
        "label": (a.label, b.label, a.label_link),
    }
    parts = [count(df, kind, what) for kind, dfs in tables.items() for df, what in zip(dfs, ("a_total", "b_total", "links"))]
    rows = reduce(DataFrame.unionByName, parts).groupBy("entity").agg(*[F.sum(c).alias(c) for c in ("a_total", "b_total", "links")])
    whole = F.when(F.col("entity") == "release_group", F.col("b_total")).otherwise(F.col("a_total"))
    return rows.withColumn("percent", F.when(whole > 0, percent("links", whole)))
