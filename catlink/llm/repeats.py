"""Repeated passages, by longest-previous-factor arrays over suffix order.

A byte is repeated if a string of ``length`` bytes that covers it also starts elsewhere. In suffix order such strings stand side by side:
suffixes that share their first ``length`` bytes form a run, inside a run the previous smaller position is an earlier match, and a suffix
whose longest previous factor reaches ``length`` is a later copy. Suffixes equal up to there are ordered by position, so the previous
smaller position of a suffix is its neighbour.

No task sorts the suffixes of a corpus. Every string of ``length`` bytes has one anchor, the grain of ``GRAIN`` bytes in it with the least
hash, and equal strings have equal anchors at equal places. So only strings whose anchor occurs twice are looked at; equal stretches of
strings around an anchor are one row of an aggregation, represented by the first of them; and suffixes are sorted among the
representatives of one anchor. Anchors with more than ``LIMIT`` different stretches are not gathered: their strings are aggregated one by
one by a 128-bit hash, which spreads them over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catlink import session
from catlink.llm.common import Rolling, chain, pieces, ragged

LENGTH = 200
GRAIN = 64
LIMIT = 4096
SEGMENT = 1 << 22
"""Bytes of a single text that are scanned at a time."""
_LOW = np.uint64((1 << 24) - 1)
_rolling: list[Rolling] = []


def _hashers() -> list[Rolling]:
    if not _rolling:
        _rolling.extend([Rolling(4), Rolling(5)])
    return _rolling


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x)
    y = np.concatenate([x, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(y, axis=1).reshape(-1)
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int, grain: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, stretch hash, row, first start in the row and number of starts of all stretches: starts in a row with one anchor."""
    parts = []
    one, two = _hashers()
    for at in range(0, max(1, len(data) - length + 1), SEGMENT):
        part = data[at:at + SEGMENT + length - 1]
        if len(part) < length:
            break
        one.over(part)
        two.over(part)
        i = np.arange(len(part) - grain + 1)
        h = one.of(i, i + grain)
        least = _sliding_min((h & ~_LOW) | i.astype(np.uint64), length - grain + 1)
        start = np.arange(len(least))
        row = np.searchsorted(offsets, start + at, "right") - 1
        inside = start + at + length <= offsets[row + 1]
        start, row, anchor = start[inside], row[inside], (least[inside] & _LOW).astype(np.int64)
        if not len(start):
            continue
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        s, e = start[first], start[last]
        whole = chain(one.of(s, e + length), two.of(s, e + length), (anchor[first] - s).astype(np.uint64))
        parts.append((h[anchor[first]].view(np.int64), whole.view(np.int64), row[first], s + at - offsets[row[first]], e - s + 1))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _scan(keyed: DataFrame, length: int, grain: int, whole: bool) -> DataFrame:
    """All stretches of all texts: h, or also c, key, lo and n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sums = np.asarray(batch.column("k")), np.asarray(batch.column("mark"))
            for first, _, data, offsets in pieces(batch.column("text")):
                h, c, row, lo, n = _stretches(data, offsets, length, grain)
                if whole:
                    row = row + first
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), pa.array(keys[row]), pa.array(sums[row]), pa.array(lo, pa.int32()), pa.array(n, pa.int32())], ["h", "c", "k", "mark", "lo", "n"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(h)], ["h"])

    return keyed.mapInArrow(run, "h long, c long, k long, mark long, lo int, n int" if whole else "h long")


def _words(data: np.ndarray, start: np.ndarray, length: int) -> list[np.ndarray]:
    """The strings at the starts as big-endian words, the last word first: keys for np.lexsort. Words may overlap at the end."""
    at = [*range(0, length - 7, 8)] if length >= 8 else []
    if length % 8:
        at.append(length - 8)
    out = []
    for i in reversed(at):
        w = np.zeros(len(start), np.uint64)
        for j in range(8):
            w = w << np.uint64(8) | data[start + i + j].astype(np.uint64)
        out.append(w)
    return out


def _common(keys: list[np.ndarray], order: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in suffix order, ``length`` at most."""
    out = np.full(len(order), length)
    open_ = np.ones(len(order), bool)
    for j, k in enumerate(reversed(keys)):  # the first word is the last key
        differ = np.zeros(len(order), bool)
        x = k[order][1:] ^ k[order][:-1]
        differ[1:] = x != 0
        equal = np.zeros(len(order), np.int64)
        for byte in range(1, 8):
            equal[1:] += x >> np.uint64(64 - 8 * byte) == 0
        here = open_ & differ
        out[here] = (min(8 * j, length - 8) + equal)[here]
        open_ &= ~differ
    return out


def previous_factors(position: list[int], common: list[int]) -> list[int]:
    """The longest factor of each suffix, in suffix order, that begins at a smaller position.

    The smaller positions next before and next behind a suffix in that order share most with it. A stack of rising positions gives both: a
    suffix leaves it when the next smaller one comes, and what it shares with the one below it is kept beside it.
    """
    out, stack = [0] * len(position), []
    for k, at in enumerate(position):
        shared = common[k]
        while stack and position[stack[-1][0]] > at:
            top, before = stack.pop()
            out[top] = before if before > shared else shared
            shared = before if before < shared else shared
        stack.append((k, shared if stack else 0))
    for top, before in stack:
        out[top] = before
    return out


def longest_factors(data: np.ndarray, start: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each start, in order of position: whether its longest previous factor, and whether that or its longest next one, reaches ``length``.

    Starts with a hash of their own have no factor of that length; the others are put in suffix order, and their factors come from the previous and
    next smaller (for next factors: larger) positions in it. Factors are counted up to ``length`` and lie in one bucket.
    """
    one, two = (r.over(data) for r in _hashers())
    h = chain(one.of(start, start + length), two.of(start, start + length), bucket.astype(np.uint64))
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[inverse] > 1)
    earlier, shared = np.zeros(len(start), bool), np.zeros(len(start), bool)
    if len(some):
        keys = _words(data, start[some], length)
        order = np.lexsort([np.arange(len(some)), *keys, bucket[some]])
        common = _common(keys, order, length)
        common[0] = 0
        common[1:][bucket[some][order][1:] != bucket[some][order][:-1]] = 0
        common = common.tolist()
        previous = np.array(previous_factors(order.tolist(), common))
        following = np.array(previous_factors((-order).tolist(), common))
        earlier[some[order]] = previous >= length
        shared[some[order]] = np.maximum(previous, following) >= length
    return earlier, shared


def _ranges(which: np.ndarray, earlier: np.ndarray, owner: np.ndarray, start: np.ndarray, length: int):
    """Runs of neighbouring starts of one owner with the same verdict: (owner, first byte, end byte, earlier)."""
    at = np.flatnonzero(which)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    new = np.concatenate([[True], (owner[at][1:] != owner[at][:-1]) | (start[at][1:] != start[at][:-1] + 1) | (earlier[at][1:] != earlier[at][:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return owner[at[first]], start[at[first]], start[at[last]] + length, earlier[at[first]]


_RANGE = "k long, mark long, a int, z int, earlier boolean"


def _compare(length: int, limit: int):
    """Suffix order among the stretches of each anchor; rows come sorted by anchor and position."""
    def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        h, k, mark, lo, n = (np.asarray(t[c].combine_chunks()) for c in ("h", "k", "mark", "lo", "n"))
        blob = t["bytes"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(blob.buffers()[1], np.int64, len(blob) + 1, blob.offset * 8)
        data, base = np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0]
        owner = np.repeat(np.arange(len(h)), n)
        start = ragged(n.astype(np.int64), base)
        earlier, shared = longest_factors(data, start, np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))[owner], length)
        o, a, z, e = _ranges(shared, earlier, owner, start, length)
        shift = lo[o] - base[o]
        return pa.RecordBatch.from_arrays([pa.array(k[o]), pa.array(mark[o]), pa.array(a + shift, pa.int32()), pa.array(z + shift, pa.int32()), pa.array(e, pa.bool_())], ["k", "mark", "a", "z", "earlier"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            h = np.asarray(batch.column("h"))
            cuts = np.flatnonzero(h[1:] != h[:-1]) + 1
            done = 0
            for cut in [*cuts.tolist(), None]:
                # A cut is the beginning of a new anchor; the end of a batch is none.
                if cut is None:
                    if done < batch.num_rows:
                        held.append(batch.slice(done))
                        size += batch.num_rows - done
                elif size + cut - done >= limit:
                    held.append(batch.slice(done, cut - done))
                    yield work(held)
                    held, size, done = [], 0, cut
        if held:
            yield work(held)

    return run


def _cut(length: int):
    """Bytes of the wanted stretches of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                text = (batch.column("text")[r].as_py() or "").encode()
                want = batch.column("want")[r].as_py()
                k, mark = batch.column("k")[r].as_py(), batch.column("mark")[r].as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array([w["h"] for w in want], pa.int64()), pa.array([k] * len(want), pa.int64()), pa.array([mark] * len(want), pa.int64()), pa.array([w["lo"] for w in want], pa.int32()),
                    pa.array([w["n"] for w in want], pa.int32()), pa.array([text[w["lo"]:w["lo"] + w["n"] - 1 + length] for w in want], pa.binary())],
                    ["h", "k", "mark", "lo", "n", "bytes"])

    return run


def _each(length: int):
    """Every string of stretches, by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _hashers()
        for batch in batches:
            k, mark, lo, n = (np.asarray(batch.column(c)) for c in ("k", "mark", "lo", "n"))
            for first, end, data, offsets in pieces(batch.column("bytes")):
                size = n[first:end].astype(np.int64)
                s, o = ragged(size, offsets[:-1]), np.repeat(np.arange(first, end), size)
                one.over(data), two.over(data)
                yield pa.RecordBatch.from_arrays([
                    pa.array(one.of(s, s + length).view(np.int64)), pa.array(two.of(s, s + length).view(np.int64)), pa.array(k[o]), pa.array(mark[o]),
                    pa.array(s - offsets[o - first] + lo[o], pa.int32())], ["w1", "w2", "k", "mark", "lo"])

    return run


def _erase(keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            texts = batch.column("text")
            for r, ranges in enumerate(batch.column("ranges").to_pylist()):
                raw = (texts[r].as_py() or "").encode()
                merged: list[list[int]] = []
                for x in sorted((x["a"], x["z"]) for x in ranges or () if x["earlier"] or not keep_first):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append([*x])
                ends = [0, *[z for _, z in merged]]
                starts = [*[a for a, _ in merged], len(raw)]
                sizes.append(len(raw))
                spans.append([{"start": a, "end": z} for a, z in merged])
                kept.append(b"".join(raw[a:z] for a, z in zip(ends, starts, strict=True)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove(docs: DataFrame, length: int = LENGTH, keep_first: bool = True, grain: int = GRAIN, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, spans (the removed [start, end) bytes) and kept (the bytes that remain) of every document.

    ``keep_first`` leaves the first copy of what repeats, in order of doc_id (null first) and place; otherwise every copy goes. Null texts
    are empty; repeated rows repeat one another; rows that share an id and a text are given the same spans, so that under ``keep_first``
    they keep theirs alike; an empty table gives no rows. ``grain`` is from 8 to ``length``. Documents are told apart by id and a 64-bit
    hash of the text, which matters only where ids repeat or are null.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64(text).alias("mark"), "doc_id", text.alias("text"))
    plain = keyed.select("k", "mark", "text")
    often = _scan(plain, length, grain, False).groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("h")
    often = session.materialise(often, "repeat-anchors")
    rows = session.materialise(_scan(plain, length, grain, True).join(often, "h", "left_semi"), "repeat-rows")
    place = F.struct("k", "mark", "lo", "n")
    groups = session.materialise(rows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("m"), F.min(place).alias("first")), "repeat-groups")
    # Stretches that occur twice or more are settled as they are.
    settled = rows.join(groups.filter("m > 1").select("h", "c", "first"), ["h", "c"]).select(
        "k", "mark", F.col("lo").alias("a"), (F.col("lo") + F.col("n") - 1 + length).alias("z"), (place != F.col("first")).alias("earlier"))
    # Where an anchor has different stretches, the first of each is compared with the others.
    mixed = groups.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    want = groups.join(mixed, "h").select("first.k", "first.mark", F.struct("h", "first.lo", "first.n").alias("w"), (F.col("kinds") > limit).alias("hot"))
    # The texts are dealt out by document once: this exchange is the same for all that is joined with it.
    placed = keyed.repartition("k", "mark")

    def cut(some: DataFrame) -> DataFrame:
        some = some.groupBy("k", "mark").agg(F.collect_list("w").alias("want"))
        texts = placed.join(some, ["k", "mark"]).select("k", "mark", "text", "want").dropDuplicates(["k", "mark"])
        return texts.mapInArrow(_cut(length), "h long, k long, mark long, lo int, n int, bytes binary")

    ordered = cut(want.filter("NOT hot")).repartition("h").sortWithinPartitions("h", "k", "mark", "lo").mapInArrow(_compare(length, limit), _RANGE)
    each = cut(want.filter("hot")).select("k", "mark", "lo", "n", "bytes").mapInArrow(_each(length), "w1 long, w2 long, k long, mark long, lo int")
    spot = F.struct("k", "mark", "lo")
    found = each.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("m"), F.min(spot).alias("first")).filter("m > 1")
    single = each.join(found, ["w1", "w2"]).select("k", "mark", F.col("lo").alias("a"), (F.col("lo") + length).alias("z"), (spot != F.col("first")).alias("earlier"))
    # Rows that share an id and a text find the same ranges; a set holds them once.
    ranges = settled.union(ordered).union(single).groupBy("k", "mark").agg(F.collect_set(F.struct("a", "z", "earlier")).alias("ranges"))
    joined = placed.join(ranges, ["k", "mark"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_erase(keep_first), f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
