"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard. On each level every child draws ``-ln(u) / weight`` from a hash of the document's id and
the child's name, and the least draw wins, so children win in proportion to their weights. A changed weight changes the draws of that
child and its ancestors alone: documents move only into (or out of) subtrees whose weights change. A shard added with a rack and a
region of its own takes documents only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from catlink import session
from catlink.llm.common import uniform


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def layout(shards: int, racks: int = 2, per_rack: int = 4) -> list[Shard]:
    """Equal shards in regions of ``racks`` x ``per_rack``."""
    return [Shard(s, f"g{s // (racks * per_rack)}", f"r{s // per_rack}") for s in range(shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region and rack of its own."""
    s = max(x.shard for x in tree) + 1
    return [*tree, Shard(s, f"g+{s}", f"r+{s}", weight)]


def _least(key: Column, children: Column) -> Column:
    """Name of the child, of structs (name, weight), with the least draw; ties go to the smaller name."""
    draws = F.transform(children, lambda c: F.struct((-F.log(uniform(c["name"], key)) / c["weight"]).alias("draw"), c["name"].alias("name")))
    return F.array_min(draws)["name"]


def _children(weights: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in sorted(weights.items())])


def _below(groups: dict[str, dict[str, float]], parent: Column) -> Column:
    return F.element_at(F.create_map(*[x for name, children in groups.items() for x in (F.lit(name), _children(children))]), parent)


def place(df: DataFrame, tree: list[Shard], key: str, into: str) -> DataFrame:
    """Add the shard of each row. Null keys share one place; rows of equal keys stay together."""
    if not any(x.weight > 0 for x in tree):
        raise ValueError("no shard has a weight")
    tree = [x for x in tree if x.weight > 0]
    regions: dict[str, float] = {}
    racks: dict[str, dict[str, float]] = {}
    leaves: dict[str, dict[str, float]] = {}
    for x in tree:
        regions[x.region] = regions.get(x.region, 0) + x.weight
        racks.setdefault(x.region, {})[x.rack] = racks.get(x.region, {}).get(x.rack, 0) + x.weight
        leaves.setdefault(x.rack, {})[f"s{x.shard}"] = x.weight
    k = F.col(key)
    rack = _least(k, _below(racks, _least(k, _children(regions))))
    shard = F.substring(_least(k, _below(leaves, rack)), 2, 10).cast("int").alias(into)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != into], shard)


def slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``: gapless numbers from 0 in each shard, in the given order, nulls first.

    Rows are dealt by ranges of (shard, order) and numbered where they lie; the pre-aggregated counts of a shard's ranges shift the numbers.
    Rows that are equal in all that are told apart by their place in the input, so no key, not even null, fills one task.
    """
    keys = [shard, *order, "_place"]
    sorted_ = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    numbered = session.materialise(sorted_.withColumns({"_part": F.spark_partition_id(), "_nr": F.monotonically_increasing_id()}), "slots")
    ranges = numbered.groupBy(shard, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_nr").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(shard, "_part", (before - F.col("_first")).alias("_shift"))
    return numbered.join(ranges, [shard, "_part"]).withColumn("slot", (F.col("_nr") + F.col("_shift")).cast("long")).drop("_part", "_nr", "_shift")


def assign(docs: DataFrame, tree: list[Shard], larger: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (null without ``larger``) and slot of every document.

    A null text has no bytes (size 16, checksum 0); a null id is a key like any other; repeated rows get slots of their own; an empty
    table gives no rows. Other columns are not read.
    """
    octets = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(octets) + 16).cast("long").alias("size"), F.crc32(octets.cast("binary")).cast("long").alias("text_crc32"))
    rows = place(rows, tree, "doc_id", "shard")
    rows = place(rows, larger, "doc_id", "grown_shard") if larger else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return slots(rows, "shard", ["doc_id", "text_crc32", "size"])
