"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of word bytes and runs of other non-space bytes. Features are hashes of lower-cased words and word pairs, and of one to
three tokens written as classes (lower case, capitalised, upper case, digits, the same word again, or the symbols themselves), so that
habits of writing are learned and not words alone. A feature's value is its share of the document's n-grams; a score is the sparse dot
product of these with the weights, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catlink.llm.common import Rolling, chain, in_batches, pieces, runs, sampled, unused

DIMENSIONS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows that are learned from, about, drawn by hash where there are more. ``shards``: learners whose weights are averaged."""

    sample: int = 9_000
    shards: int = 6
    epochs: int = 3
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    scale: float = 20.0


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_SMALL = np.zeros(256, np.int64)
_SMALL[97:123] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_KINDS = np.array([0x51, 0x52, 0x53, 0x54, 0x55, 0x56], np.uint64) << np.uint64(40)
_rolling: list[Rolling] = []


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all rows of a piece: (feature, row), rows in order."""
    if not _rolling:
        _rolling.append(Rolling(2))
    word = _WORD[data]
    ws, we = runs(word, offsets)
    ss, se = runs(~word & ~_SPACE[data], offsets)
    start, end = np.concatenate([ws, ss]), np.concatenate([we, se])
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start, end, is_word = start[order], end[order], (np.arange(len(start)) < len(ws))[order]
    row = np.searchsorted(offsets, start, "right") - 1
    h = _rolling[0].over(data, _LOWER).of(start, end)
    sums = [np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _SMALL, _DIGIT)]
    up, small, digit = (s[end] - s[start] for s in sums)
    first_up = _UPPER[data[start]] > 0
    kind = np.where(digit == end - start, 0, np.where((up > 0) & (small == 0), 1, np.where(first_up, 2, np.where(up > 0, 3, 4))))
    # The word before, with a symbol run between or not, makes the class "the same word again".
    at = np.flatnonzero(is_word)
    same = np.zeros(len(h), bool)
    if len(at) > 1:
        same[at[1:]] = (h[at[1:]] == h[at[:-1]]) & (row[at[1:]] == row[at[:-1]])
    kind[same] = 5
    shape = np.where(is_word, _KINDS[kind], h)

    def grams(x: np.ndarray, of: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        keep = np.ones(max(0, len(x) - n + 1), bool) if n == 1 else of[n - 1:] == of[:len(of) - n + 1]
        parts = [x[i:len(x) - n + 1 + i][keep] for i in range(n)]
        return chain(np.full(len(parts[0]), salt, np.uint64), *parts), of[:len(x) - n + 1][keep]

    words, rows = h[at], row[at]
    found = [grams(words, rows, 1, 1), grams(words, rows, 2, 2), grams(shape, row, 1, 3), grams(shape, row, 2, 4), grams(shape, row, 3, 5)]
    f = np.concatenate([x[0] for x in found])
    r = np.concatenate([x[1] for x in found])
    return (f >> np.uint64(46)).astype(np.int32), r


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, values = [], []
        for first, end, data, offsets in pieces(batch.column("text")):
            f, r = features(data, offsets)
            key, count = np.unique(r * DIMENSIONS + f, return_counts=True)
            of = key // DIMENSIONS
            total = np.bincount(of, count, end - first)
            cut = np.searchsorted(of, np.arange(end - first + 1))
            f, v = (key % DIMENSIONS).astype(np.int32), (count / total[of]).astype(np.float32)
            for i in range(end - first):
                ids.append(f[cut[i]:cut[i + 1]])
                values.append(v[cut[i]:cut[i + 1]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("y"), batch.column("turn"), pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["y", "turn", "ids", "vals"])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> np.ndarray:
    """Weights after proximal follow-the-regularised-leader updates, row by row. The last weight is the bias."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= s.l1, 0.0, w)

    for _ in range(s.epochs):
        for ids, values, y in rows:
            i = np.append(ids, DIMENSIONS)
            x = np.append(values * s.scale, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(DIMENSIONS + 1))


def labelled(labels: DataFrame, column: str = "quality") -> DataFrame:
    """(doc_id, y): one row for each labelled document outside the held-out third; several labels count by majority, 1 on a tie."""
    df = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out("doc_id"))
    return df.groupBy("doc_id").agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y"))


def held_out(key: str):
    """Whether the CRC-32 of the id as text leaves 1 on division by 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Fit on about ``settings.sample`` labelled rows, all if there are fewer. Zeros (score 0.5) if the labels do not hold both classes.

    Texts are turned into sparse rows where they lie; each shard of the sample is learned in a task of its own, in hash order, and the
    weights of the shards are averaged.
    """
    spark = docs.sparkSession
    turn = F.md5(F.col("doc_id").cast("string"))
    picked = sampled(labelled(labels), "doc_id", settings.sample).select(F.col("doc_id").alias("_id"), "y", turn.alias("turn"))
    texts = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id"))
    rows = in_batches(texts.select("y", "turn", F.coalesce("text", F.lit("")).alias("text")), _sparse, "y int, turn string, ids array<int>, vals array<float>")

    def learn(key, table):
        table = table.sort_by("turn")
        got = list(zip((np.asarray(x.values) for x in table["ids"]), (np.asarray(x.values) for x in table["vals"]), table["y"].to_pylist(), strict=True))
        y = {r[2] for r in got}
        w = ftrl(got, settings) if len(y) > 1 else np.zeros(DIMENSIONS + 1)
        return pa.table({"n": pa.array([len(got) if len(y) > 1 else 0], pa.int64()), "w": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    shard = F.pmod(F.conv(F.substring("turn", 1, 8), 16, 10).cast("long"), F.lit(settings.shards)).alias("shard")
    learned = rows.select(shard, "turn", "y", "ids", "vals").groupBy("shard").applyInArrow(learn, "n long, w binary").collect()
    total = sum(r["n"] for r in learned)
    out = np.zeros(DIMENSIONS + 1, np.float32)
    for r in sorted(learned, key=lambda r: bytes(r["w"])):
        if r["n"]:
            out += np.frombuffer(bytes(r["w"]), np.float32) * (r["n"] / total)
    return out


def scores(column: pa.Array, weights: np.ndarray, scale: float) -> np.ndarray:
    parts = []
    for first, end, data, offsets in pieces(column):
        f, r = features(data, offsets)
        total = np.bincount(r, minlength=end - first)
        dot = np.bincount(r, weights[f], end - first) / np.maximum(total, 1)
        parts.append(1 / (1 + np.exp(-np.clip(dot * scale + weights[-1], -35, 35))))
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, weights: np.ndarray, into: str = "score", scale: float = Settings.scale) -> DataFrame:
    """Add the score of every whole text (double); an empty or null text has the bias alone. Weights have a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = [c for c in docs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(batch.column(kept.index("text")), shared.value, scale)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, into])

    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return in_batches(plain, run, f"{fields}, `{into}` double")


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. Repeated rows are scored each; an empty table gives no rows."""
    w = train(docs, labels, settings)
    out = score(docs.select("doc_id", "text"), w, scale=settings.scale)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not rejected (score of 0.5 or more), with the columns they had."""
    w = train(docs, labels, settings)
    into = unused("score", docs)
    out = score(docs, w, into, settings.scale).filter(F.col(into) >= 0.5)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
