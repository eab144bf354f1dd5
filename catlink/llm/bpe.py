"""Byte-pair encoding and decoding with a tokenizer's file: merges are found by a segment tree over the ranks of adjacent pairs.

A text is cut as the file's normaliser and pre-tokenizer say. Within a piece, leaf i of a segment tree holds the rank of the pair that begins
at symbol i, with i behind it; the root is the least of all, the leftmost pair of the lowest rank. A merge changes three leaves, each in
as many steps as the tree is high, so a piece of n symbols takes n log n steps however long it is. Decoding gathers the tokens of all ids
from one byte table.

Texts are encoded where they lie, without a shuffle; a worker remembers the pieces it met, up to a bound.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catlink.llm.common import in_batches, ragged

CACHE = 200_000
"""Words that a worker remembers in each of two generations; the older one is forgotten when the younger is full."""
LONG = 64
"""Characters of the longest word that is remembered."""
STEP = 1 << 18
"""Words that are looked up at a time."""
BLOCK = 1 << 20
"""Characters of a text that are cut into words at a time, up to the next white space."""
WIDE = 64
"""Leaves of the trees that are worked on side by side; longer pieces have one each."""
AT_ONCE = 1 << 14
"""Trees that are worked on side by side."""
SHORT = 4096
"""Symbols up to which the tree of a single piece is held in lists, which are faster, and not in arrays of eight bytes an entry."""
WORD = re.compile("[^ \\t\\n\\r]+")
BLANK = re.compile("[ \\t\\n\\r]")
OTHER_SPACE = re.compile(r"\s")
_NEAR = 7
_FAR = 1 << 40
_NONE = (1 << 62) - 1
_PLACE = 32
_PLACES = (1 << _PLACE) - 1


def _byte_signs() -> list[str]:
    """The sign that stands for each byte: itself where it is printable, or else one of the signs from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merges:
    """Merging of the symbols of pieces.

    ``pairs`` gives (rank, merged id) of (left id << 32 | right id), ``inner`` and ``last`` the id of each byte within a piece and at its end.
    """

    def __init__(self, pairs: dict[int, tuple[int, int]], inner: np.ndarray | None = None, last: np.ndarray | None = None):
        self.pairs, self.inner, self.last = pairs, inner, last
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64((1 << 63) - 1))
        self.rank = np.array([pairs[k][0] for k in keys.tolist()] + [0], np.int64)
        self.result = np.zeros(max((r for r, _ in pairs.values()), default=0) + 1, np.int64)
        for r, new in pairs.values():
            self.result[r] = new

    def _ranks(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaves of pairs: rank and place in one number, ``_FAR`` for what is no pair."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at] << _NEAR | place, _FAR)

    def run_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pieces: a tree each, those of one height side by side, so that every step merges once in each of them."""
        out: list[bytes] = [b""] * len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        height = np.ceil(np.log2(np.maximum(length - 1, 1))).astype(np.int64)
        for h in np.unique(height[length > 0]).tolist():
            some = np.flatnonzero((height == h) & (length > 0))
            if 1 << h > WIDE:
                for i in some.tolist():
                    raw = np.frombuffer(pieces[i], np.uint8)
                    symbols = self.inner[raw]
                    symbols[-1] = self.last[raw[-1]]
                    out[i] = np.array(self.run(symbols.tolist()), "<u4").tobytes()
                continue
            for part in np.array_split(some, -(-len(some) // AT_ONCE)):
                ids, n = self._together([pieces[i] for i in part.tolist()], length[part], 1 << h)
                cut = (4 * np.concatenate([[0], np.cumsum(n)])).tolist()
                raw = ids.astype("<u4").tobytes()
                for i, a, b in zip(part.tolist(), cut[:-1], cut[1:], strict=True):
                    out[i] = raw[a:b]
        return out

    def _together(self, pieces: list[bytes], length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of each). Symbols of a piece are a row; its last column stands before the first and behind the last."""
        m, wide = len(pieces), size + 2
        none = size + 1
        base = np.arange(m) * wide
        at = np.repeat(base, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = np.full(m * wide, -1, np.int64)
        symbols[at] = self.inner[raw]
        ends = base + length - 1
        symbols[ends] = self.last[raw[np.cumsum(length) - 1]]
        after, before = (np.tile(x, m) for x in (np.append(np.arange(1, wide), none), np.append(np.arange(-1, wide - 2), none)))
        after[ends], before[base] = none, none
        # Leaves begin at ``size``; the two columns behind them take what belongs to no leaf.
        tall = 2 * size + 2
        tree = np.full((m, tall), _FAR, np.int64)
        grid = symbols.reshape(m, wide)
        tree[:, size:2 * size] = self._ranks(grid[:, :size], grid[:, 1:size + 1], np.arange(size))
        level = size
        while level > 1:
            np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2], out=tree[:, level // 2:level])
            level //= 2
        tree, rows = tree.reshape(-1), np.arange(m)
        while True:
            least = tree[rows * tall + 1]
            rows, least = rows[least != _FAR], least[least != _FAR]
            if not len(rows):
                break
            row, root = rows * wide, rows * tall
            i = least & (1 << _NEAR) - 1
            new = self.result[least >> _NEAR]
            j = after[row + i]
            k, h = after[row + j], before[row + i]
            symbols[row + i], symbols[row + j] = new, -1
            after[row + i], before[row + k] = k, i
            places = np.concatenate([j, i, h])
            roots = np.concatenate([root, root, root])
            tree[roots + size + places] = np.concatenate([
                np.full(len(rows), _FAR), self._ranks(new, symbols[row + k], i), self._ranks(symbols[row + h], new, h)])
            node = size + np.minimum(places, size - 1)
            for _ in range(size.bit_length() - 1):
                node >>= 1
                tree[roots + node] = np.minimum(tree[roots + 2 * node], tree[roots + 2 * node + 1])
        grid = symbols.reshape(m, wide)
        return grid[grid >= 0], (grid >= 0).sum(axis=1)

    def run(self, symbols: list[int]) -> list[int]:
        """The ids left when no pair can be merged; each step merges the leftmost of the pairs of the lowest rank."""
        n = len(symbols)
        if n < 2:
            return symbols
        find = self.pairs.get
        leaves = [found[0] << _PLACE | i if (found := find(a << 32 | b)) else _NONE for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))]
        if min(leaves) == _NONE:
            return symbols
        size = 1 << (n - 2).bit_length()
        held = list if n <= SHORT else lambda x: array("q", x)
        tree = held([_NONE] * size + leaves + [_NONE] * (size - n + 1))
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        symbols, after, before = held(symbols), held(range(1, n + 1)), held(range(-1, n - 1))
        while (least := tree[1]) != _NONE:
            i = least & _PLACES
            j = after[i]
            symbols[i] = x = self.pairs[symbols[i] << 32 | symbols[j]][1]
            symbols[j] = -1
            k, h = after[j], before[i]
            after[i] = k
            changed = [(i, _NONE)]
            if k < n:
                before[k] = i
                found = find(x << 32 | symbols[k])
                changed = [(j, _NONE), (i, found[0] << _PLACE | i if found else _NONE)]
            if h >= 0:
                found = find(symbols[h] << 32 | x)
                changed.append((h, found[0] << _PLACE | h if found else _NONE))
            for at, value in changed:
                at += size
                tree[at] = value
                while at > 1:
                    at >>= 1
                    a, b = tree[2 * at], tree[2 * at + 1]
                    if b < a:
                        a = b
                    if tree[at] == a:
                        break
                    tree[at] = a
        return [x for x in symbols if x >= 0]


class Coder:
    """The tokenizer of one file of the BPE kind: byte-level pieces, an end-of-word suffix, special tokens looked for in the text as it is."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        if model["type"] != "BPE" or odd or spec.get("decoder") or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"not a tokenizer of this kind: {path} {odd}")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in added}
        self.special_text = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pairs[vocab[left] << 32 | vocab[right]] = rank, vocab[left + right]
        signs = _byte_signs()
        self.merges = Merges(pairs, np.array([vocab[x] for x in signs]), np.array([vocab[x + suffix] for x in signs]))
        parts = Tokenizer.from_file(path)
        self.normalise = parts.normalizer.normalize_str if parts.normalizer else str
        self.cut = parts.pre_tokenizer.pre_tokenize_str
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        names = {i: t for t, i in (vocab | self.special).items()}
        shown = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_ends = np.cumsum([len(x) for x in shown], dtype=np.int64)

    def _learn(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(word, ids) of words: normalised and cut all at once, with a space between each two, and each distinct piece merged once.

        White space is in no piece and composes with nothing, so words do not change each other. A word that holds white space of another
        kind goes alone.
        """
        for odd in (w for w in words if OTHER_SPACE.search(w)):
            norm = self.normalise(odd)
            yield odd, b"".join(self.merges.run_many([norm[a:b].encode() for _, (a, b) in self.cut(norm)]))
        plain = [w for w in words if not OTHER_SPACE.search(w)]
        norm = self.normalise(" ".join(plain))
        spans = [span for _, span in self.cut(norm)]
        ends = np.cumsum([len(w) + 1 for w in norm.split(" ")])
        of = np.searchsorted(ends, [a for a, _ in spans], "right") if spans else np.zeros(0, np.int64)
        number: dict[str, int] = {}
        piece = [number.setdefault(norm[a:b], len(number)) for a, b in spans]
        ids = self.merges.run_many([p.encode() for p in number])
        first = np.searchsorted(of, np.arange(len(plain) + 1)).tolist()
        for w, a, b in zip(plain, first[:-1], first[1:], strict=True):
            yield w, ids[piece[a]] if b == a + 1 else b"".join([ids[k] for k in piece[a:b]])

    def _settle(self, queue: list[tuple[list[bytes], list[str] | bytes]]) -> None:
        """Append the ids of the words of each entry to its output; what is not remembered is learnt at once."""
        words, new = self.words, set()
        for _, ws in queue:
            if isinstance(ws, list):
                for w in set(ws):
                    if w not in words:
                        if (known := self.old.get(w)) is None:
                            new.add(w)
                        else:
                            words[w] = known
        if new:
            words.update(self._learn(list(new)))
        for out, ws in queue:
            out.append(ws if isinstance(ws, bytes) else b"".join([words[w] for w in ws]))
        for w in new:
            if len(w) > LONG:
                del words[w]
        if len(words) >= CACHE:
            self.old, self.words = words, {}

    def _parts(self, text: str) -> Iterator[list[str] | bytes]:
        """The words of a text in blocks, and the ids of special tokens between them."""
        start = 0
        for found in [*(self.special_text.finditer(text) if self.special else ()), None]:
            end = found.start() if found else len(text)
            while start < end:
                blank = BLANK.search(text, start + BLOCK, end) if start + BLOCK < end else None
                stop = blank.start() if blank else end
                yield WORD.findall(text, start, stop)
                start = stop
            if found:
                yield self.special[found.group()].to_bytes(4, "little")
                start = found.end()

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. Words are looked up by steps of ``STEP`` words or so."""
        outs: list[list[bytes]] = []
        queue, n = [], 0
        for text in texts:
            outs.append([])
            for part in self._parts(text):
                queue.append((outs[-1], part))
                n += len(part)
                if n >= STEP:
                    self._settle(queue)
                    queue, n = [], 0
        self._settle(queue)
        return [b"".join(x) for x in outs]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of the ids with a space between each two, in UTF-8."""
        ends = self.shown_ends[ids]
        starts = np.where(ids > 0, self.shown_ends[np.maximum(ids, 1) - 1], 0)
        return self.shown[ragged(ends - starts, starts)].tobytes()[:-1]


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode(docs: DataFrame, tokenizer: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add ``into``: the ids of every whole text as little-endian unsigned 32-bit integers in one binary value. The text column goes.

    Null and empty texts, and texts of white space, have no ids. Equal rows are encoded each. The other columns are kept, but for one of the
    name ``into``. An empty table gives no rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, into)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        for batch in batches:
            ids = pa.array(c.encode_many(t.as_py() or "" for t in batch.column(len(kept))), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], into])

    plain = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return in_batches(plain, run, f"{fields}`{into}` binary")


def decode(coded: DataFrame, tokenizer: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Add ``into``: the text of every row of ids, special tokens included. The file names no decoder, so tokens stand apart by spaces.

    Null ids give an empty text. The other columns are kept, but for one of the name ``into``.
    """
    kept = [f for f in coded.schema.fields if f.name != into]
    at = [f.name for f in kept].index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        for batch in batches:
            texts = (c.decode(np.frombuffer(x.as_buffer(), "<u4").astype(np.int64)) if x.is_valid and len(x.as_buffer()) else b"" for x in batch.column(at))
            text = pa.array(texts, pa.binary(), size=batch.num_rows).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, into])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return in_batches(coded.select(*[F.col(f"`{f.name}`") for f in kept]), run, f"{fields}`{into}` string")
