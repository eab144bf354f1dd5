"""SimHash near-duplicates, found by anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most 3 bits differ in at most 1 bit of one of their 32-bit halves. The anchors of a half
are the words of a covering code of radius 1: the (31, 26) Hamming code with one free bit. Every fingerprint lies within 1 bit of one
anchor, its own, and is replicated to every anchor within radius plus threshold, 2 bits (at most 17). A half that differs in at most 1
bit therefore meets the own anchor of one fingerprint among the replicas of the other, and only there are they compared.

``keep_one`` keeps one document of each group so linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from catlink import session
from catlink.llm.common import in_batches

DISTANCE = 3
WORDS = 3
_STEP = 1 << 14


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bits set in over half the hashes of the word shingles; 0 without words. A text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    ws = text.lower().split()
    if not ws:
        return 0
    if len(ws) <= words:
        return xxh64_intdigest(b" ".join(ws), 42)
    joined = b" ".join(ws)
    length = np.fromiter(map(len, ws), np.int64, len(ws))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:len(ws) - words + 1].tolist()
    end = end[words - 1:].tolist()
    n, counts = len(start), np.zeros(64, np.int64)
    for i in range(0, n, _STEP):
        h = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(start[i:i + _STEP], end[i:i + _STEP], strict=True)], np.dtype("<u8"))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            fp = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in text), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return run


def prints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text"), _prints(words), f"doc_id {kind}, fp long")


def _half(fp: Column, half: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))


def _syndrome(x: Column) -> Column:
    """Exclusive or of the positions (1 to 31) of the set bits."""
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        out = out + F.shiftleft((F.bit_count(x.bitwiseAND(F.lit(mask))) % 2).cast("int"), k)
    return out


def _bit(position: Column) -> Column:
    return F.when(position > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (position - 1).cast("int"))).otherwise(F.lit(0).cast("long"))


def own_anchor(fp: Column, half: int) -> Column:
    """The anchor within 1 bit of a half, as a key with the half's number."""
    x = _half(fp, half)
    return x.bitwiseXOR(_bit(_syndrome(x))).bitwiseOR(F.lit(half << 32))


def anchors(fp: Column, half: int) -> Column:
    """All anchors within 2 bits of a half: the own one, the same with the free bit turned, and those two code bits away."""
    x = _half(fp, half)
    near = x.bitwiseXOR(_bit(_syndrome(x)))
    pairs = F.transform(F.array(F.struct(x.alias("x"), _syndrome(x).alias("s"))), lambda v: F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (v["s"] > 0) & (i != v["s"]) & (i < i.bitwiseXOR(v["s"]))),
        lambda i: v["x"].bitwiseXOR(_bit(i)).bitwiseXOR(_bit(i.bitwiseXOR(v["s"])))))
    found = F.concat(F.array(near, near.bitwiseXOR(F.lit(1 << 31))), F.element_at(pairs, 1))
    return F.transform(found, lambda a: a.bitwiseOR(F.lit(half << 32)))


def links(distinct: DataFrame) -> DataFrame:
    """(u, v), u < v: all pairs of distinct fingerprints (column ``fp``) that differ in at most 3 bits, each once.

    Spark sizes rows made by ``explode`` as the rows they come from, so both sides are asked to be shuffled: the replicas, 34 for each
    fingerprint, would be broadcast wherever the fingerprints are small enough.
    """
    left = distinct.select(F.col("fp").alias("u"), F.explode(F.array(*[own_anchor(F.col("fp"), h) for h in (0, 1)])).alias("anchor"))
    right = distinct.select(F.col("fp").alias("v"), F.explode(F.concat(*[anchors(F.col("fp"), h) for h in (0, 1)])).alias("anchor"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    low, high = F.bit_count(_half(differ, 0)), F.bit_count(_half(differ, 1))
    first = F.col("anchor") < (1 << 32)
    near = (low + high <= DISTANCE) & F.when(first, low <= 1).otherwise((low > 1) & (high <= 1))
    return left.hint("merge").join(right.hint("merge"), "anchor").filter((F.col("u") < F.col("v")) & near).select("u", "v")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root): the least node reachable from each node of the edges (u, v), by alternating large and small stars.

    Each round is written to the shared folder; the rounds end when the edges stay as they are.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = session.materialise(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct(), name)
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u < v").distinct()
        # Small star: each node with its smaller neighbours, all tied to the least of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct(F.col("m").alias("u"), "v"), F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("e"))
        edges = session.materialise(small.select("e.u", "e.v").filter("u < v").distinct(), name)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def groups(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of the component, of every document.

    Null and empty texts have fingerprint zero, linked like any other. Equal fingerprints meet in one aggregated row before anything
    is compared, so groups of copies of any size cost one row. Null ids never name a component unless it has no other; repeated rows
    are returned as often as they come; an empty table gives no rows.
    """
    rows = session.materialise(prints(docs, words), "prints")
    distinct = session.materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(links(distinct))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    # both sides are as long as the table, and files of hashes are several times smaller than their rows
    return rows.hint("merge").join(of, "fp").select("doc_id", "fp", "component_id")


def _hash() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def _key() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), _hash().alias("hash"))


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each group of ``groups``, with the columns it had: that of the smallest id, null last, and of equal ids that of the
    least text hash.

    Rows are told apart by id and text, so a group of null ids keeps one document, and groups that share a repeated id keep one each. Of rows
    that repeat both one stays, that of the least hash of its columns. Null and empty texts are one group. An empty table gives no rows. The
    row travels as one struct, so no column of the table can clash with a name used here.
    """
    of = groups(docs.select(_key().alias("doc_id"), "text"), words)
    first = of.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("key")).distinct()
    rows = docs.select(_key().alias("key"), F.struct("*").alias("row")).join(first, "key", "left_semi")
    plain = [f"row.`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return rows.groupBy("key").agg(F.min_by("row", F.xxhash64(*plain)).alias("row")).select("row.*")
