"""Prefix trie of conversations, with a count-min sketch of prefix digests that keeps lonely tails out of the shuffle.

The digest of a prefix is a polynomial of its turns' MD5 digests modulo 2**127 - 1. It grows turn by turn and can be put together from pieces,
so a conversation of any length is worked out by several tasks. All digests are counted in a sketch whose cells stop at two. A prefix with one
cell that was met once is surely in one conversation only, and so is everything behind it: those nodes are written where they are found.
Only the prefixes before, which may be shared, are grouped exactly by their digests.

A node belongs to its smallest conversation. The nodes of one conversation are a chain, from some depth down to that of its last shared
prefix; what a chain holds is added to the nodes above it along the prefixes of its conversation, so sums over subtrees take no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from catlink import session
from catlink.llm.common import in_batches, mix, word_count

PIECE = 8192
"""Turns of a piece of a conversation at most."""
ROWS = 3
"""Rows of the sketch."""
CELLS = 1 << 24
"""Cells of a row at most: what is sent to every task is 6 MB then. Beyond, the sketch holds back fewer prefixes, and results are the same."""
LOAD = 4
"""Cells of a row for each turn, up to ``CELLS``."""
SLAB = 1 << 16
"""Cells of the sketch that one row of its table holds."""
SPAN = 4096
"""Depths that are summed up in one window."""
_PRIME = (1 << 127) - 1
_BASE = 0x5DEECE66D1B54A32D192ED03A6F4B1C7 % _PRIME


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, t (digest of role and text), words and copies: one row for equal ones. Null role or text counts as empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.select("conv_id", "turn", t.alias("t"), word_count(F.col("text")).alias("words"))
    return rows.groupBy("conv_id", "turn", "t").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("copies"))


def rebuilt(rows: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """Digest rows of conversations whose first turns are those of another: the first h of conversation c - c % ``group`` (no remainder is
    negative) stand for its own first h, h = crc32(c) % ``heads``. The null conversation stays as it is.

    Adds ``own``: false for turns taken over. A row of which nothing is left has 0 copies. Only the first turns of each conversation are
    numbered; Spark limits them before they are shuffled.
    """
    rows = session.materialise(rows, "trie-turns")
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads, F.lit(0))
    known = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in ("conv_id", "turn")]
    key = F.md5(F.concat_ws("|", *known, F.hex("t")))
    order = Window.partitionBy("conv_id").orderBy("turn", "t")
    top = rows.withColumn("nr", F.row_number().over(order)).filter(F.col("nr") < heads)
    top = top.withColumn("before", F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    top = session.materialise(top.drop("nr"), "trie-first-turns")
    own = rows.withColumn("k", key).join(top.select(key.alias("k"), "before"), "k", "left")
    gone = F.least(F.greatest(h - F.coalesce("before", F.lit(heads)), F.lit(0)), F.col("copies"))
    own = own.select("conv_id", F.lit(True).alias("own"), "turn", "t", "words", (F.col("copies") - gone).alias("copies"))
    each = top.filter(F.col("conv_id") % group == 0).withColumn("i", F.explode(F.expr(f"sequence(1, int(least(copies, {heads})))")))
    each = each.select(F.col("conv_id").alias("base"), (F.col("before") + F.col("i")).alias("at"), "t", "words").filter(F.col("at") < heads)
    takers = rows.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("base"), h.alias("h")).filter("h > 0")
    turn = rows.schema["turn"].dataType
    taken = takers.join(each, "base").filter("at <= h").select("conv_id", F.lit(False).alias("own"), F.col("at").cast(turn).alias("turn"), "t", "words", F.lit(1).cast("long").alias("copies"))
    return own.unionByName(taken)


def _number(x: bytes) -> int:
    return int.from_bytes(x, "little")


def _cut(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations from rows in order: the digests of their prefixes as if they began with the piece, and the words of each turn."""
    part, nr, out = TaskContext.get().partitionId(), 0, []
    conv = kind = None
    h, hashes, words, inside, begun = 0, bytearray(), [], False, False

    def close(whole: bool) -> None:
        nonlocal nr, h, hashes, words
        out.append((conv, part, nr, whole, len(words), bytes(hashes), np.array(words, "<i8").tobytes()))
        nr, h, hashes, words = nr + 1, 0, bytearray(), []

    def flush() -> pa.RecordBatch:
        types = [kind, pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["conv_id", "part", "nr", "whole", "n", "hashes", "words"])
        out.clear()
        return batch

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, t, w, copies in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if inside and c != conv:
                close(begun)
                begun = True
            conv, inside = c, True
            add = _number(t) + 1
            for _ in range(copies):
                if len(words) >= limit:
                    close(False)
                    begun = False
                h = (h * _BASE + add) % _PRIME
                hashes += h.to_bytes(16, "little")
                words.append(w)
            if len(out) >= 1024:
                yield flush()
    if inside:
        close(False)
        yield flush()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth and digest before each piece of a conversation, its whole depth and the number of its first piece."""
    held: list[dict] = []

    def solved() -> pa.RecordBatch:
        depth, h, rows = 0, 0, []
        for r in held:
            rows.append((r["part"], r["nr"], depth, h.to_bytes(16, "little")))
            depth, h = depth + r["n"], (h * pow(_BASE, r["n"], _PRIME) + _number(r["end"])) % _PRIME
        first = held[0]["part"] << 32 | held[0]["nr"]
        rows = [(*r, depth, first) for r in rows]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["part", "nr", "depth", "before", "total", "cid"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield solved()
                held = []
            held.append(row)
    if held:
        yield solved()


class _Prefixes:
    """All prefixes of a batch of pieces, one after the other: the piece of each, its depth, digest, the digest before it and its last words."""

    def __init__(self, batch: pa.RecordBatch):
        n, depth = (np.asarray(batch.column(c)).astype(np.int64) for c in ("n", "depth"))
        root = depth == 0
        root &= np.asarray(batch.column("cid")) == (np.asarray(batch.column("part")).astype(np.int64) << 32 | np.asarray(batch.column("nr")))
        parts, before, words = [], [], []
        for r, (own, start, w) in enumerate(zip(batch.column("hashes").to_pylist(), batch.column("before").to_pylist(), batch.column("words").to_pylist(), strict=True)):
            if start != bytes(16):
                h, power = _number(start), 1
                moved = bytearray()
                for i in range(0, len(own), 16):
                    power = power * _BASE % _PRIME
                    moved += ((h * power + _number(own[i:i + 16])) % _PRIME).to_bytes(16, "little")
                own = bytes(moved)
            ahead = bytes(16) if root[r] else b""
            parts.append(ahead + own)
            before.append(ahead + (start + own[:-16] if own else b""))
            words.append((bytes(8) if root[r] else b"") + w)
        size = n + root
        self.row = np.repeat(np.arange(len(n)), size)
        self.depth = np.arange(len(self.row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(depth + 1 - root, size)
        self.h = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
        self.p = np.frombuffer(b"".join(before), "<i8").reshape(-1, 2)
        self.words = np.frombuffer(b"".join(words), "<i8")
        self.count = len(n)

    def cells(self, width: int) -> list[np.ndarray]:
        """The cell of each prefix in each row of the sketch; ``width`` is a power of two."""
        low, high = self.h[:, 0].view(np.uint64), self.h[:, 1].view(np.uint64)
        return [(mix(low * np.uint64(2 * r + 1) + mix(high + np.uint64(r))) & np.uint64(width - 1)).astype(np.int64) for r in range(ROWS)]


def _counted(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sketch of the prefixes of a task, in slabs of cells: 0, 1, or 2 for more."""
    sketch = np.zeros((ROWS, width), np.uint8)
    for batch in batches:
        p = _Prefixes(batch)
        deep = p.depth > 0
        for r, cells in enumerate(p.cells(width)):
            met, n = np.unique(cells[deep], return_counts=True)
            sketch[r, met] = np.minimum(sketch[r, met] + n, 2)
    slabs = sketch.reshape(-1, min(SLAB, width))
    some = np.flatnonzero(slabs.any(axis=1))
    for i in some:
        yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([slabs[i].tobytes()], pa.binary())], names=["slab", "cells"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit a cell: met more than once. Slabs of one number come one after the other."""
    at, total = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(total > 1).tobytes()], pa.binary())], names=["slab", "bits"])

    for batch in batches:
        for slab, cells in zip(batch.column("slab").to_pylist(), batch.column("cells").to_pylist(), strict=True):
            cells = np.frombuffer(cells, np.uint8)
            if slab != at:
                if at is not None:
                    yield done()
                at, total = slab, np.zeros(len(cells), np.uint8)
            total = np.minimum(total + cells, 2)
    if at is not None:
        yield done()


def sketch(pieces: DataFrame, cells: int = CELLS) -> np.ndarray:
    """(row, byte): bits of the cells that more than one prefix met. Its size is bounded by ``cells``."""
    turns = pieces.agg(F.sum("n")).first()[0] or 0
    width = 1 << max(12, min(int(LOAD * turns).bit_length(), cells.bit_length() - 1))
    counts = in_batches(pieces, partial(_counted, width), "slab int, cells binary")
    merged = in_batches(counts.repartition("slab").sortWithinPartitions("slab"), _merged, "slab int, bits binary").toArrow()
    out = np.zeros((ROWS * width // min(SLAB, width), min(SLAB, width) // 8), np.uint8)
    for slab, bits in zip(merged["slab"].to_pylist(), merged["bits"].to_pylist(), strict=True):
        out[slab] = np.frombuffer(bits, np.uint8)
    return out.reshape(ROWS, -1)


def _shared(p: _Prefixes, bits: np.ndarray) -> np.ndarray:
    """Whether each prefix may be in several conversations."""
    out = np.ones(len(p.depth), bool)
    for r, cells in enumerate(p.cells(bits.shape[1] * 8)):
        out &= (bits[r, cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
    return out | (p.depth == 0)


def _stops(p: _Prefixes, bits: np.ndarray) -> np.ndarray:
    """The depth of the last prefix before the first lonely one of each piece; a large number where there is none."""
    stop = np.full(p.count, 1 << 60)
    np.minimum.at(stop, p.row, np.where(_shared(p, bits), 1 << 60, p.depth - 1))
    return stop


_MAY_BE_SHARED, _LONELY = 0, 1


def _screened(bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = _Prefixes(batch)
        stop = np.asarray(batch.column("stop").fill_null(-1)).astype(np.int64)
        stop = np.where(stop < 0, _stops(p, bits.value), stop)
        total = np.asarray(batch.column("total")).astype(np.int64)
        stop, total = np.minimum(stop, total)[p.row], total[p.row]
        lonely, row = p.depth > stop, pa.array(p.row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(lonely, _LONELY, _MAY_BE_SHARED), pa.int32()), pa.array(p.depth), *[pa.array(x) for x in (p.h[:, 0], p.h[:, 1], p.p[:, 0], p.p[:, 1])],
             batch.column("cid").take(row), batch.column("conv_id").take(row), pa.array(p.words), pa.array(p.depth == total), pa.array(stop < total),
             pa.array(np.where(lonely, p.depth == stop + 1, (p.depth == stop) & (stop < total)))],
            names=["kind", "depth", "h1", "h2", "p1", "p2", "cid", "conv_id", "words", "ends", "tailed", "edge"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the comma-joined ids of each node, which come one after the other. Nothing is held but the digest's state."""
    import hashlib

    node, digest = None, None
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("depth", "h1", "h2")], strict=True))
        names = ["" if x is None else str(x) for x in batch.column("conv_id").to_pylist()]
        cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
        done = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if node != keys[a]:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = keys[a], hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(names[a:b]).encode())
        if done:
            yield _ended(done)
    if node is not None:
        yield _ended([(*node, digest.hexdigest())])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["depth", "h1", "h2", "ends_sha256"])


_NODE = ["depth", "h1", "h2"]


def _as_parent(df: DataFrame) -> DataFrame:
    """Rows by the node above theirs."""
    return df.withColumns({"depth": F.col("depth") - 1, "h1": F.col("p1"), "h2": F.col("p2")})


def _suffix_sums(nodes: DataFrame) -> DataFrame:
    """Add ``own``: the sum of ``value`` from a node down its chain, by spans of depths, so that no window holds a long chain."""
    nodes = nodes.withColumn("span", F.floor(F.col("depth") / SPAN))
    spans = nodes.groupBy("cid", "span").agg(F.sum("value").alias("v"))
    later = F.coalesce(F.sum("v").over(Window.partitionBy("cid").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("value").over(Window.partitionBy("cid", "span").orderBy(F.desc("depth")))
    both = nodes.withColumn("inside", inside).join(spans.select("cid", "span", later.alias("later")), ["cid", "span"])
    return both.withColumn("own", F.col("inside") + F.col("later")).drop("inside", "later", "span")


def _pieces(rows: DataFrame, piece: int) -> DataFrame:
    conv = rows.schema["conv_id"].dataType.simpleString()
    order: list[Column] = [F.col("conv_id").asc_nulls_last(), F.col("own").asc(), F.col("turn").asc(), F.col("t").asc()]
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t", "words", "copies")
    cut = session.materialise(in_batches(in_order, partial(_cut, piece), f"conv_id {conv}, part int, nr int, whole boolean, n long, hashes binary, words binary"), "trie-cut")
    number = F.shiftleft(F.col("part").cast("long"), 32) + F.col("nr")
    whole = cut.filter("whole").select("*", F.lit(0).cast("long").alias("depth"), F.lit(bytes(16)).alias("before"), F.col("n").alias("total"), number.alias("cid"))
    last = F.when(F.col("n") > 0, F.expr("substring(hashes, -16, 16)")).otherwise(F.lit(bytes(16))).alias("end")
    parts = cut.filter("NOT whole").select("conv_id", "part", "nr", "n", last).repartition("conv_id").sortWithinPartitions("conv_id", "part", "nr")
    chain = in_batches(parts, _chained, "part int, nr int, depth long, before binary, total long, cid long")
    return session.materialise(whole.unionByName(cut.filter("NOT whole").join(chain, ["part", "nr"]).select(*whole.columns)), "trie-pieces")


def nodes_of(rows: DataFrame, cells: int = CELLS, piece: int = PIECE) -> DataFrame:
    """The nodes of the trie of digest rows (``digests``, ``rebuilt``); see ``nodes``."""
    if "own" not in rows.columns:
        rows = rows.withColumn("own", F.lit(True))
    pieces = _pieces(rows, piece)
    bits = pieces.sparkSession.sparkContext.broadcast(sketch(pieces, cells))

    def stops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(_stops(_Prefixes(batch), bits.value))], names=["cid", "stop"])

    # Where a conversation has several pieces, its first lonely prefix is that of all pieces.
    long = in_batches(pieces.filter("NOT whole"), stops, "cid long, stop long").groupBy("cid").agg(F.min("stop").alias("stop"))
    given = pieces.filter("whole").withColumn("stop", F.lit(None).cast("long")).unionByName(pieces.filter("NOT whole").join(long, "cid"))
    conv = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"kind int, depth long, h1 long, h2 long, p1 long, p2 long, cid long, conv_id {conv}, words long, ends boolean, tailed boolean, edge boolean"
    found = session.materialise(in_batches(given, partial(_screened, bits), schema), "trie-prefixes")
    shared, lonely = found.filter(F.col("kind") == _MAY_BE_SHARED), found.filter(F.col("kind") == _LONELY)

    def count(flag: str) -> Column:
        return F.sum(F.col(flag).cast("long")).alias(flag)

    grouped = shared.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("cid").alias("cid"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"), count("edge"), count("tailed"))
    grouped = session.materialise(grouped, "trie-grouped")
    below = _as_parent(grouped.filter("depth > 0")).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("below"))
    known = grouped.join(below, _NODE, "left").withColumn("n_children", F.coalesce("below", F.lit(0)) + F.col("edge"))
    known = known.withColumns({"value": (F.col("n_convs") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long")})
    known = session.materialise(known.drop("below", "edge"), "trie-known")
    chains = known.groupBy("cid").agg(F.min("depth").alias("top"), F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    giving = chains.filter("top > 0 AND (value > 0 OR leaf > 0)").join(shared.select("cid", *_NODE), "cid").filter("depth < top")
    given = giving.groupBy(*_NODE).agg(F.sum("value").alias("above_value"), F.sum("leaf").alias("above_leaf"))
    ends = shared.filter("ends").select(*_NODE, "conv_id").repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
    ends = in_batches(ends, _ends, "depth long, h1 long, h2 long, ends_sha256 string")
    own = _suffix_sums(known).join(chains.select("cid", F.col("leaf").alias("chain_leaf")), "cid")
    zero, nothing = F.lit(0).cast("long"), F.sha2(F.lit(b""), 256)
    full = own.join(given, _NODE, "left").join(ends, _NODE, "left").select(
        *_NODE, "p1", "p2", "conv_id", "n_convs", "n_children", (F.col("tailed") + F.col("chain_leaf") + F.coalesce("above_leaf", zero)).alias("n_leaves"),
        (F.col("own") + F.coalesce("above_value", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    parent = known.select(*_NODE, F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    depth = (F.col("depth") + 1).alias("depth")
    top = full.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast(conv)).select(columns)
    inner = _as_parent(full.filter("depth > 0")).join(parent, _NODE).select("conv_id", depth, *columns[2:])
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    alone = lonely.select(
        *_NODE, "p1", "p2", "edge", "conv_id", F.lit(1).cast("long").alias("n_convs"), (~F.col("ends")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"), F.when(F.col("ends"), F.sha2(name.cast("binary"), 256)).otherwise(nothing).alias("ends_sha256"))
    first = _as_parent(alone.filter("edge")).join(parent, _NODE).select("conv_id", depth, *columns[2:])
    rest = alone.filter("NOT edge").withColumn("parent_conv_id", F.col("conv_id")).select(columns)
    return top.unionByName(inner).unionByName(first).unionByName(rest)


def nodes(conversations: DataFrame, cells: int = CELLS, piece: int = PIECE) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    A node is a distinct sequence of first turns (role, text), the root that of none; a conversation is named by conv_id and its turns are in
    order of ``turn``, null first, then of a digest of role and text. Null role or text counts as empty. The null conv_id is a conversation of
    its own, the last in order; where it is the only member, conv_id is null, and among the ids of ends it is an empty name. Equal rows are
    turns each. Other columns are not read; an empty table has no nodes. The digest over the ids of a node is sequential by definition: they
    are streamed in order, and nothing is held.
    """
    return nodes_of(digests(conversations), cells, piece)
