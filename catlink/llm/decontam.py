"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of ten words (an item of fewer words is one window), a window into shingles of three words. A document that
contains a window contains all its shingles, so the necessary prefix of a window, with shingles in order of rarity, is its rarest one.
Documents are joined with these prefix tokens only; a match fixes where the window would lie, which bounds its start and end in the
document, and the words there are compared exactly.

Benchmarks are taken in blocks of bounded size, each shared with the tasks; all documents are read against every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catlink.llm.common import Rolling, chain, in_batches, pieces, ragged, runs

WINDOW = 10
SHINGLE = 3
BLOCK = 200_000
"""Windows of a block: at most some 30 MB shared with the tasks."""

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_SPLIT = bytes(int(_LOWER[b]) if _WORD[b] else 32 for b in range(256))
_rolling: list[Rolling] = []


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start byte and row of every word, and the number of words before each row."""
    if not _rolling:
        _rolling.append(Rolling(3))
    start, end = runs(_WORD[data], offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    before = np.searchsorted(start, offsets)
    return _rolling[0].over(data, _LOWER).of(start, end), start, row, before


def _shingles(h: np.ndarray, n: int) -> np.ndarray:
    if len(h) < n:
        return np.zeros(0, np.uint64)
    return chain(np.full(len(h) - n + 1, n, np.uint64), *[h[i:len(h) - n + 1 + i] for i in range(n)])


class _Sieve:
    """Membership in a set of hashes: a bit table first, then a search in the sorted values."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.values >> np.uint64(42)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and their numbers in the sorted values."""
        at = np.flatnonzero(self.bits[(h >> np.uint64(42)).astype(np.int64)])
        if not len(at) or not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        nr = np.minimum(np.searchsorted(self.values, h[at]), len(self.values) - 1)
        good = self.values[nr] == h[at]
        return at[good], nr[good]


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(words, item): the windows of every item, once each. A null item id is the empty name; items without words have no window."""
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    df = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    df = df.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("w"))
    return df.select(F.array_join("w", " ").alias("words"), "item").distinct()


def _window_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of windows: word hashes, first word of each, and its shingles as (window, offset, hash)."""
    column = pa.array(texts, pa.string())
    hashes, counts = [], []
    for _, _, data, offsets in pieces(column):
        h, _, _, before = _words(data, offsets)
        hashes.append(h)
        counts.append(np.diff(before))
    h, count = np.concatenate(hashes), np.concatenate(counts)
    first = np.concatenate([[0], np.cumsum(count)])
    nr, offset, hashed = [], [], []
    for n in range(1, SHINGLE + 1):
        ok = np.flatnonzero(count >= n) if n == SHINGLE else np.flatnonzero(count == n)
        if len(ok):
            lengths = count[ok] - n + 1
            at = ragged(lengths, first[ok])
            nr.append(np.repeat(ok, lengths))
            offset.append(at - np.repeat(first[ok], lengths))
            hashed.append(_shingles(h, n)[at])
    return h, first, np.concatenate(nr), np.concatenate(offset), np.concatenate(hashed)


def _frequencies(docs: DataFrame, hashes: np.ndarray, sizes: list[int]) -> DataFrame:
    """(shingle, df): in how many documents each of the shingles occurs, counted over all documents and added up by batch first."""
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve(shared.value)
        for batch in batches:
            counts = np.zeros(len(sieve.values), np.int64)
            for first, end, data, offsets in pieces(batch.column("text")):
                h, _, row, _ = _words(data, offsets)
                seen = []
                for n in sizes:
                    at, nr = sieve.find(_shingles(h, n))
                    inside = row[at] == row[at + n - 1]
                    seen.append(row[at[inside]] * len(sieve.values) + nr[inside])
                counts += np.bincount(np.unique(np.concatenate(seen)) % max(1, len(sieve.values)), minlength=len(sieve.values))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(sieve.values[some].view(np.int64)), pa.array(counts[some])], ["shingle", "df"])

    return in_batches(docs.select("text"), run, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))


class _Block:
    """Windows of one block with their prefix tokens, ready to be met with documents."""

    def __init__(self, texts: list[str], items: list[list[str]], df: dict[int, int]):
        self.texts, self.items = texts, items
        self.hashes, self.first, nr, offset, shingle = _window_shingles(texts)
        rarity = np.fromiter((df.get(int(s), 0) for s in shingle.view(np.int64)), np.int64, len(shingle))
        order = np.lexsort((offset, shingle, rarity, nr))
        nr, offset, shingle = nr[order], offset[order], shingle[order]
        lead = np.flatnonzero(np.concatenate([[True], nr[1:] != nr[:-1]]))
        prefix, at = shingle[lead], offset[lead]
        self.sieve = _Sieve(prefix)
        by = np.argsort(prefix, kind="stable")
        self.window, self.offset = nr[lead][by], at[by]
        self.starts = np.searchsorted(prefix[by], np.append(self.sieve.values, self.sieve.values[-1:] + np.uint64(1)))
        self.starts[-1] = len(by)
        self.sizes = sorted({min(SHINGLE, int(c)) for c in np.unique(np.diff(self.first))})

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word in the row, window) of every occurrence, and the words before each row."""
        h, _, row, before = _words(data, offsets)
        starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.sizes:
            at, nr = self.sieve.find(_shingles(h, n))
            lengths = self.starts[nr + 1] - self.starts[nr]
            k = ragged(lengths, self.starts[nr])
            s, w = np.repeat(at, lengths) - self.offset[k], self.window[k]
            size = self.first[w + 1] - self.first[w]
            r = row[np.repeat(at, lengths)] if len(k) else np.zeros(0, np.int64)
            ok = (np.minimum(size, SHINGLE) == n) & (s >= before[r]) & (s + size <= before[r + 1])
            s, w, size = s[ok], w[ok], size[ok]
            for i in range(int(size.max()) if len(size) else 0):
                ok = (i >= size) | (h[np.minimum(s + i, len(h) - 1)] == self.hashes[np.minimum(self.first[w] + i, len(self.hashes) - 1)])
                s, w, size = s[ok], w[ok], size[ok]
            starts.append(s)
            found.append(w)
        s, w = np.concatenate(starts), np.concatenate(found)
        r = row[s]
        order = np.argsort(r, kind="stable")
        s, w, r = s[order], w[order], r[order]
        # Equal hashes are taken for a match only where the words themselves are equal.
        good, last, words = np.ones(len(s), bool), -1, []
        for i in range(len(s)):
            if r[i] != last:
                last = r[i]
                words = data[offsets[last]:offsets[last + 1]].tobytes().translate(_SPLIT).split()
            start = s[i] - before[last]
            window = self.texts[w[i]].encode().split(b" ")
            good[i] = words[start:start + len(window)] == window
        s, w, r = s[good], w[good], r[good]
        return r, s - before[r], w, before


def _blocks(docs: DataFrame, benchmark: DataFrame, size: int) -> list:
    """Blocks of the benchmark, shared with the tasks: all items of a window are in its block."""
    spark = docs.sparkSession
    found = windows(benchmark)
    total = found.agg(F.sum(F.length("words") / 60 + 1)).first()[0] or 0
    n = int(total // size) + 1
    out = []
    for b in range(n):
        part = found.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == b).groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")).toArrow()
        if not part.num_rows:
            continue
        part = part.sort_by("words")
        texts = part["words"].to_pylist()
        _, first, _, _, shingle = _window_shingles(texts)
        sizes = sorted({min(SHINGLE, int(c)) for c in np.unique(np.diff(first))})
        df = {r["shingle"]: r["df"] for r in _frequencies(docs, np.unique(shingle), sizes).collect()}
        out.append(spark.sparkContext.broadcast(_Block(texts, part["items"].to_pylist(), df)))
    return out


def hits(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, spans (runs of hit words as [start, end)) and items (names of the items found) of every document.

    Null and empty texts have no words; repeated rows are returned as often as they come; without items nothing is hit.
    """
    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, spans, items, keys = [], [], [], []
                for first, end, data, offsets in pieces(batch.column("text")):
                    n = end - first
                    if shared is None:
                        before = _words(data, offsets)[3]
                        r = s = w = np.zeros(0, np.int64)
                    else:
                        r, s, w, before = shared.value.hits(data, offsets)
                    words.append(np.diff(before))
                    got: dict[int, tuple[list, set]] = {}
                    for i in np.lexsort((s, r)).tolist():
                        runs_, names = got.setdefault(int(r[i]), ([], set()))
                        stop = int(s[i]) + int(shared.value.first[w[i] + 1] - shared.value.first[w[i]])
                        if runs_ and runs_[-1]["start"] <= s[i] <= runs_[-1]["end"]:
                            runs_[-1]["end"] = max(runs_[-1]["end"], stop)
                        else:
                            runs_.append({"start": int(s[i]), "end": stop})
                        names.update(shared.value.items[w[i]])
                    spans += [got[i][0] if i in got else [] for i in range(n)]
                    items += [sorted(got[i][1]) if i in got else [] for i in range(n)]
                    ends = data.tobytes()
                    keys += [hash_text(ends[offsets[i]:offsets[i + 1]]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(keys, pa.string()), pa.array(np.concatenate(words) if words else [], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "_key", "n_words", "spans", "items"])

        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, _key string, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    shared = _blocks(docs, benchmark, block) or [None]
    parts = [in_batches(docs.select("doc_id", "text"), run_with(b), schema) for b in shared]
    if len(parts) == 1:
        return parts[0].drop("_key")
    # Blocks meet again by document; equal rows are counted and given back as often as they came.
    met = reduce(DataFrame.union, parts).groupBy("doc_id", "_key").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / len(parts)).cast("int").alias("_n"))
    merged = F.aggregate(
        F.array_sort("s"), F.lit(None).cast("array<struct<start:long,end:long>>"),
        lambda acc, x: F.when(acc.isNull(), F.array(x)).when(
            F.element_at(acc, -1)["end"] >= x["start"],
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(x))))
    met = met.withColumn("spans", F.coalesce(merged, F.expr("cast(array() as array<struct<start:long,end:long>>)")))
    return met.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("doc_id", "n_words", "spans", "items")


def hash_text(text: bytes) -> str:
    from hashlib import blake2b

    return blake2b(text, digest_size=16).hexdigest()


def keep_clean(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents in which no window occurs, with the columns they had. Rows pass each block in turn; none is shuffled."""
    at, schema = docs.columns.index("text"), docs.schema

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in pieces(batch.column(at)):
                    keep[first + shared.value.hits(data, offsets)[0]] = False
                yield batch.filter(pa.array(keep))

        return run

    for shared in _blocks(docs, benchmark, block):
        docs = in_batches(docs, run_with(shared), schema)
    return docs
