"""Token-id files: ids ranked by frequency, in byte-aligned variable-length coding with separate control bytes.

Texts are encoded by a public tokenizer, an end id is appended, and ids are replaced by their rank of frequency over the whole corpus,
so that most take one byte. A block of documents holds its ranks in one to four bytes each and, apart from them, the lengths: two bits
per id, four to a control byte. Decoding looks four lengths up per control byte and gathers all ids of a block at once.

The file set is a Parquet folder: a row is a block of one file (a range of document ids), in order of (file, block); a second folder
holds the ranks. Texts are split at ASCII white space, which this tokenizer drops, and each distinct piece is encoded once per worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catlink import session
from catlink.llm.common import Rolling, give_back, in_batches, pieces, ragged

END = 1
PER_FILE = 20_000
"""Documents of a file, about."""
BLOCK = 1 << 15
"""Ids of a block at least, but for the last of a file; a document is never split."""
CACHE = 1_000_000
"""Distinct pieces that a worker remembers, by two 64-bit hashes each; beyond that it forgets those met in one step only."""
STEP = 2 << 20
"""Bytes of text that are encoded at a time."""
_SEPARATORS = "§¶•†‡¤"


class Encoder:
    """Ids of many texts by one tokenizer file, without special tokens."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        alone = {s: self.tokenizer.encode(s, add_special_tokens=False).ids for s in _SEPARATORS}
        self.mark = next(s for s, ids in alone.items() if len(ids) == 1)
        self.mark_id = alone[self.mark][0]
        self.rolling = [Rolling(7), Rolling(8)]
        self.clear()

    def clear(self) -> None:
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.length, self.hits, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the pieces that later steps met again, the more frequent half of the room at most."""
        least = 1
        while (self.hits >= least).sum() > CACHE // 2:
            least *= 2
        keep = np.flatnonzero(self.hits >= least)
        self.ids = self.ids[ragged(self.length[keep].astype(np.int64), self.start[keep])]
        self.h1, self.h2, self.length, self.hits = self.h1[keep], self.h2[keep], self.length[keep], self.hits[keep]
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of each): many are encoded at a time, with a mark between them; those that would hide a mark go alone."""
        parts, lengths = [np.zeros(0, np.int32)], np.zeros(len(words), np.int32)
        for i in range(0, len(words), 500):
            some = words[i:i + 500]
            ids = self._plain(f" {self.mark} ".join(some))
            at = np.flatnonzero(ids == self.mark_id)
            if len(at) == len(some) - 1 and not any("<|" in w or self.mark in w for w in some):
                lengths[i:i + len(some)] = np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
                parts.append(ids[ids != self.mark_id])
            else:
                each = [self._plain(w) for w in some]
                lengths[i:i + len(some)] = [len(x) for x in each]
                parts += each
        return np.concatenate(parts), lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text starts (one more at the end). Null counts as empty."""
        if len(self.h1) > CACHE:
            self._forget()
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        offsets = np.asarray(split.offsets).astype(np.int64)
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        pairs = [(r.over(data).of(at[:-1], at[1:])) for _, _, data, at in pieces(coded.dictionary) for r in self.rolling]
        h1, h2 = (np.concatenate([np.zeros(0, np.uint64), *pairs[i::2]]) for i in (0, 1))
        nr = np.searchsorted(self.h1, h1)
        known = np.zeros(len(h1), bool)
        inside = np.flatnonzero(nr < len(self.h1))
        known[inside] = (self.h1[nr[inside]] == h1[inside]) & (self.h2[nr[inside]] == h2[inside])
        start, length = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int32)
        start[known], length[known] = self.start[nr[known]], self.length[nr[known]]
        self.hits[nr[known]] += 1
        new = ~known
        ids, length[new] = self._learn(coded.dictionary.filter(pa.array(new)).to_pylist())
        start[new] = len(self.ids) + np.cumsum(length[new], dtype=np.int64) - length[new]
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(np.concatenate([self.h1, h1[new]]), kind="stable")
        for name, more in (("h1", h1), ("h2", h2), ("start", start), ("length", length), ("hits", np.zeros(len(h1), np.int32))):
            setattr(self, name, np.concatenate([getattr(self, name), more[new]])[order])
        at = np.asarray(coded.indices)
        counts = length[at].astype(np.int64)
        return self.ids[ragged(counts, start[at])], np.concatenate([[0], np.cumsum(counts)])[offsets]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _lookup() -> tuple[np.ndarray, np.ndarray]:
    """Of each control byte: its four lengths, and how many bytes they are in all."""
    four = np.stack([(np.arange(256) >> 2 * i & 3) + 1 for i in range(4)], axis=1)
    return four, four.sum(axis=1)


_FOUR, _SUM = _lookup()


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of numbers below 2**32."""
    v = values.astype(np.uint32)
    length = 1 + (v >= 1 << 8).astype(np.int64) + (v >= 1 << 16) + (v >= 1 << 24)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[:len(v)] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    raw = v.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), raw[np.arange(4) < length[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers back: lengths by table lookup, bytes gathered by position."""
    length = _FOUR[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(length)
    start = end - length
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = raw[start]
    for i in (1, 2, 3):
        longer = np.flatnonzero(length > i)
        out[longer] |= raw[start[longer] + i] << np.uint32(8 * i)
    return out


def _values(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(all ids of a binary column, where each row's begin and the last end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64) // width
    ids = np.frombuffer(column.buffers()[2], f"<u{width}") if column.buffers()[2] is not None else np.zeros(0, f"<u{width}")
    return ids[offsets[0]:offsets[-1]], offsets - offsets[0]


def encode(docs: DataFrame, tokenizer: str, end: int = END) -> tuple[DataFrame, int]:
    """((doc_id, h, nr, ids), width): the plain ids of every document with the end id, ``width`` bytes each, stored.

    ``h`` is a hash of the text and ``nr`` counts the rows of a task: both tell rows of one id apart, so that no id is hot.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = 2 if max(_encoder(tokenizer).size, end + 1) <= 1 << 16 else 4

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, seen = _encoder(tokenizer), 0
        for whole in batches:
            size = np.cumsum(np.asarray(pc.binary_length(whole.column("text")).fill_null(0)).astype(np.int64))
            for part in np.split(np.arange(whole.num_rows), np.flatnonzero(np.diff(size // STEP)) + 1):
                if not len(part):
                    continue
                batch = whole.slice(part[0], len(part))
                ids, at = e.encode(batch.column("text"))
                n = batch.num_rows
                ends = at[1:] + np.arange(n)
                out, own = np.full(len(ids) + n, end, f"<u{width}"), np.ones(len(ids) + n, bool)
                own[ends] = False
                out[own] = ids
                offsets = np.concatenate([[0], (ends + 1) * width]).astype(np.int32)
                coded = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(np.arange(seen, seen + n)), coded], ["doc_id", "h", "nr", "ids"])
                seen += n

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    return session.materialise(in_batches(rows, tokenize, f"doc_id {kind}, h long, nr long, ids binary"), "token-ids"), width


def _release() -> None:
    """Give back what encoding held in this worker; later stages need none of it."""
    if _encoders:
        _encoders.clear()
        give_back()


def ranks(coded: DataFrame, width: int) -> DataFrame:
    """(id, rank, n): all ids that occur, the most frequent first; ties go to the smaller id. Counts are added up by task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        total = np.zeros(1, np.int64)
        for batch in batches:
            n = np.bincount(_values(batch.column("ids"), width)[0])
            if len(n) > len(total):
                total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
            total[:len(n)] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counts = in_batches(coded.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select("id", (F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "n")


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, per_file: int = PER_FILE, block: int = BLOCK) -> None:
    """Write the file set: ``path/ranks`` and ``path/blocks``. The table of ranks is as long as the vocabulary at most.

    Files are ranges of (doc_id, h, nr), so a task writes one file at a time and holds one block of it.
    """
    spark = docs.sparkSession
    coded, width = encode(docs, tokenizer, end)
    ranks(coded, width).write.parquet(f"{path}/ranks")
    rows = spark.read.parquet(f"{path}/ranks").select("id", "rank").toArrow()
    table = np.zeros(max(rows["id"].to_pylist(), default=0) + 1, np.uint32)
    table[np.asarray(rows["id"])] = np.asarray(rows["rank"])
    shared = spark.sparkContext.broadcast(table)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        file, nr, docs_, lengths, parts, n = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            control, data = pack(shared.value[np.concatenate(parts)])
            ids, sizes = pa.concat_arrays(docs_), np.concatenate(lengths)
            whole = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), x) for x in (ids, pa.array(sizes))]
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([nr], pa.int32()), *whole, pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                                              ["file", "block", "doc_ids", "lengths", "control", "data"])

        for batch in batches:
            doc, (ids, at) = batch.column("doc_id"), _values(batch.column("ids"), width)
            first = 0
            while first < len(doc):
                # documents up to the one that fills the block
                stop = min(int(np.searchsorted(at, at[first] + block - n)), len(doc))
                docs_.append(doc.slice(first, stop - first))
                lengths.append(np.diff(at[first:stop + 1]))
                parts.append(ids[at[first]:at[stop]].copy())
                n += int(at[stop] - at[first])
                first = stop
                if n >= block:
                    yield flush()
                    nr, docs_, lengths, parts, n = nr + 1, [], [], [], 0
        if docs_:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("nr")]
    files = max(1, -(-coded.count() // per_file))
    filed = coded.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    kind = docs.schema["doc_id"].dataType.simpleString()
    in_batches(filed, gather, f"file int, block int, doc_ids array<{kind}>, lengths array<long>, control binary, data binary").write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): every document of the file set, decoded; ``start`` is the number of ids before it."""
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toArrow()["id"]
    shared = spark.sparkContext.broadcast(np.asarray(table).astype(np.uint32))
    blocks = spark.read.parquet(f"{path}/blocks")
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    heads = blocks.select("file", "block", size.alias("n"))
    files = heads.groupBy("file").agg(F.sum("n").alias("n"))
    before = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("files_before"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = heads.select("file", "block", inside.alias("blocks_before")).join(before, "file").select("file", "block", (F.col("files_before") + F.col("blocks_before")).alias("first"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        for batch in batches:
            for r in range(batch.num_rows):
                lengths = np.asarray(batch.column("lengths")[r].values)
                end = np.cumsum(lengths)
                ids = shared.value[unpack(batch.column("control")[r].as_py(), batch.column("data")[r].as_py(), int(end[-1]))].astype("<u4")
                sums = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(end, lengths, strict=True)]
                first = np.full(len(end), batch.column("file")[r].as_py()), np.full(len(end), batch.column("block")[r].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[0], pa.int32()), pa.array(first[1], pa.int32()), batch.column("doc_ids")[r].values, pa.array(end - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    ["file", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    decoded = in_batches(blocks, run, f"file int, block int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long")
    return decoded.join(heads, ["file", "block"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END, per_file: int = PER_FILE) -> DataFrame:
    """Write the file set to the shared folder and read it back.

    Null and empty texts hold the end id alone; documents of equal ids follow one another in order of a hash of their text; an empty table gives empty files.
    """
    path = session.stored_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end, per_file)
    return read(docs.sparkSession, path)
