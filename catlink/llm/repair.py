"""Cheapest repair of conversations to the turn order ``(s?(ua)+)?``, by block tables after the Four Russians.

A turn is one of nine symbols: its role's initial (s, u, a or another), cut short or not, or must be deleted. The cost of repairing the rest
of a conversation depends on the state of the order reached so far (nothing yet, after s, after u, after a): a vector of four numbers. Less its
least number it is one of few vectors, so for every block of ``BLOCK`` symbols and every vector after it, the vector before it and what the
least number grew by are looked up in one table. A conversation is read from its end, a block a step; then its edits are traced from the
start: each block is expanded back from the vector behind it, and of the edits that cost least the one of the least letter is taken.

Long conversations are cut into pieces of ``PIECE`` turns. What a piece does to each vector and each state is a small table too, so pieces
are worked out where they lie; only those tables are put in order in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from catlink import session
from catlink.llm.common import in_batches

BLOCK = 4
"""Symbols of a block."""
PIECE = 8192
"""Turns of a piece at most."""
PIECE_BYTES = 4 << 20
"""Bytes of text after which a piece ends."""

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
"""Costs of the edits, and of a turn cut short that stays."""
ROLES = "sua"
MUST_GO = 8
SYMBOLS = 9
_FAR = 1 << 20
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_FILL = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
"""The role of user and assistant that may come in each state, and the state then."""


def _filled(base: list[int]) -> list[int]:
    """Costs when turns may also be inserted first."""
    for _ in range(3):
        base = [min(c, INSERT + base[_FILL[s][1]]) for s, c in enumerate(base)]
    return base


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up one turn."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        role, extra = (ROLES + "-")[symbol // 2], UNFINISHED * (symbol % 2)
        if role in _AFTER[state]:
            out.append(("K", KEEP + extra, _AFTER[state][role]))
        out.append(("R", REROLE + extra, _FILL[state][1]))
    return out


class Tables:
    """``vectors`` (the first is that of the end); of one symbol before vector v ``step`` and ``grow``, and ``edit``: the letters and the
    state they lead to; of a block of symbols ``steps`` and ``grows``; ``tail``: the letters that end a conversation in each state."""

    def __init__(self, block: int):
        self.block = block
        self.vectors = [tuple(_filled([0, _FAR, _FAR, 0]))]
        numbers, step, grow, self.edit = {self.vectors[0]: 0}, [], [], []
        for after in self.vectors:  # grows while it is read
            step.append([])
            grow.append([])
            self.edit.append([])
            for symbol in range(SYMBOLS):
                costs = _filled([min(c + after[t] for _, c, t in _edits(symbol, s)) for s in range(4)])
                least = min(costs)
                vector = tuple(c - least for c in costs)
                if vector not in numbers:
                    numbers[vector] = len(self.vectors)
                    self.vectors.append(vector)
                step[-1].append(numbers[vector])
                grow[-1].append(least)
                self.edit[-1].append([self._cheapest(symbol, s, costs, after) for s in range(4)])
        self.step, self.grow = step, grow
        self.tail = []
        for s in range(4):
            letters = ""
            while s not in (0, 3):
                letters, s = letters + "I", _FILL[s][1]
            self.tail.append(letters)
        one, add = np.array(step, np.int32), np.array(grow, np.int32)
        self.steps, self.grows = one, add
        for _ in range(block - 1):
            # A block is its first symbol before a block one shorter; the first symbol comes last from the end.
            self.steps, self.grows = one[self.steps].transpose(0, 2, 1).reshape(len(one), -1), (self.grows[:, :, None] + add[self.steps]).transpose(0, 2, 1).reshape(len(one), -1)
        self.place = SYMBOLS ** np.arange(block - 1, -1, -1)

    @staticmethod
    def _cheapest(symbol: int, state: int, costs: list[int], after: tuple[int, ...]) -> tuple[str, int]:
        letters = ""
        while True:
            ways = [(x, t) for x, c, t in _edits(symbol, state) if c + after[t] == costs[state]]
            more = [("I", _FILL[state][1])] if INSERT + costs[_FILL[state][1]] == costs[state] else []
            letter, state = min(ways + more)
            letters += letter
            if letter != "I":
                return letters, state

    def back(self, symbols: np.ndarray, vector: int) -> tuple[list[int], int]:
        """(vectors from the end: behind each block, behind the odd symbols at the start if any, and before all; growth of the least number)."""
        odd = len(symbols) % self.block
        codes = (symbols[odd:].reshape(-1, self.block).astype(np.int64) @ self.place).tolist()
        seen, total = [vector], 0
        for code in reversed(codes):
            total += int(self.grows[vector, code])
            vector = int(self.steps[vector, code])
            seen.append(vector)
        for x in symbols[:odd][::-1].tolist():
            total += self.grow[vector][x]
            vector = self.step[vector][x]
        return [*seen, vector] if odd else seen, total

    def trace(self, symbols: np.ndarray, seen: list[int], state: int) -> tuple[list[str], int]:
        """(letters of each symbol, the state behind them) from a state; ``seen`` is that of ``back``."""
        odd, out, at = len(symbols) % self.block, [], len(seen) - 2
        cuts = [0, *range(odd, len(symbols) + 1, self.block)] if odd else list(range(0, len(symbols) + 1, self.block))
        values = symbols.tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            behind = [seen[at]]
            for x in values[b - 1:a:-1]:
                behind.append(self.step[behind[-1]][x])
            for x in values[a:b]:
                letters, state = self.edit[behind.pop()][x][state]
                out.append(letters)
            at -= 1
        return out, state

    def effect(self, symbols: np.ndarray) -> np.ndarray:
        """Of each vector behind a piece: the vector before it, the growth, and the state behind it for each state before it."""
        rows = []
        for v in range(len(self.vectors)):
            seen, total = self.back(symbols, v)
            rows.append([seen[-1], total, *[self.trace(symbols, seen, s)[1] for s in range(4)]])
        return np.array(rows, np.int32)


tables = cache(Tables)


def repaired(letters: list[str], state: int, lines: list[dict]) -> list[dict]:
    """The turns that the edits leave; ``lines`` are those whose symbol is not ``MUST_GO``, paired with the letters by the caller."""
    out = []
    for edits, line in zip(letters, lines, strict=True):
        for x in edits:
            if x == "I":
                role, state = _FILL[state]
                out.append({"role": role, "text": ""})
            elif x == "K":
                out.append(line)
                state = _AFTER[state][line["role"][0]]
            elif x == "R":
                role, state = _FILL[state]
                out.append({"role": role, "text": line["text"]})
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies: the rows as the damage leaves them, by the checksum of ``conv_id:turn`` modulo 20.

    0 drops a row (copies 0, without turn, role and text), 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 gives it to the
    user. Nulls count as one space.
    """
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    k = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), k.alias("k"))
    live = F.col("k") != 0
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", F.when(live, F.col("turn")).alias("turn"), F.when(live, F.when(F.col("k") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(live, text).alias("text"), F.when(F.col("k") == 3, 2).when(live, 1).otherwise(0).alias("copies"))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row for equal ones, with its faults, and whether it is the first of its role and text in the conversation.

    Both steps are aggregations with partial sums, on keys that end in a digest of role and text; only the first carries texts.
    """
    def known(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))

    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = rows.withColumn("d", F.coalesce(digest, F.lit("")))
    key = F.md5(F.concat_ws("|", known("conv_id"), known("turn"), F.col("d")))
    equal = rows.withColumn("k", key).groupBy("k").agg(
        F.first("conv_id").alias("conv_id"), F.first("turn").alias("turn"), F.first("role").alias("role"), F.first("d").alias("d"), F.first("text").alias("text"), F.sum("copies").alias("copies"))
    place = F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("at")
    first = rows.filter("copies > 0").groupBy("conv_id", "d").agg(place).select("conv_id", "d", F.col("at.turn").alias("turn"))
    both = equal.join(first.select(key.alias("k"), F.lit(True).alias("first")), "k", "left")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return both.select(
        "conv_id", "turn", "role", "d", "text", "copies", blank.alias("blank"), (~blank & F.col("first").isNull()).alias("again"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("short"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Piece:
    def __init__(self, conv):
        self.conv, self.symbols, self.lines, self.size = conv, bytearray(), [], 0
        self.n = dict.fromkeys(_COUNTS, 0)
        self.head = self.tail = ""
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role, text, copies, blank, again, short) -> None:
        if not copies:
            return
        initial = role[:1] or "-"
        sound = not blank and not again
        self.symbols += bytes([(ROLES + "-").index(initial if initial in ROLES else "-") * 2 + short if sound else MUST_GO]) + bytes([MUST_GO]) * (copies - 1)
        if sound:
            self.lines.append({"role": role, "text": text})
            self.size += len(text)
        self.n["blank"] += copies * blank
        self.n["duplicate"] += 0 if blank else copies - sound
        self.n["truncated"] += sound and short
        self.n["illegal"] += copies - 1 + (bool(self.tail) and not _legal(self.tail, initial))
        self.head, self.tail = self.head or initial, initial
        if turn is not None:
            self.n["turns"] += self.last != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        if len(self.symbols) == copies:
            self.first = turn
        self.last = turn

    def full(self, limit: int) -> bool:
        return len(self.symbols) >= limit or self.size >= PIECE_BYTES


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _finish(symbols: np.ndarray, lines: list[dict], vector: int, state: int, last: bool) -> tuple[str, list[dict]]:
    """(audit, turns left) of a piece, from what is behind and before it."""
    t = tables(BLOCK)
    letters, after = t.trace(symbols, t.back(symbols, vector)[0], state)
    rows = iter(lines)
    left = repaired(letters, state, [next(rows) if x != MUST_GO else {} for x in symbols.tolist()])
    if last:
        letters.append(t.tail[after])
        for _ in t.tail[after]:
            role, after = _FILL[after]
            left.append({"role": role, "text": ""})
    return "".join(letters), left


_LINES = "array<struct<role:string,text:string>>"
_ARROW_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _cut(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations from rows in order. One that surely lies in this task as a whole is repaired at once."""
    part, nr, out, piece, begun, seen = TaskContext.get().partitionId(), 0, [], None, False, 0
    kind = None

    def close(p: _Piece, whole: bool) -> None:
        nonlocal nr, seen
        t, symbols = tables(BLOCK), np.frombuffer(bytes(p.symbols), np.uint8)
        row = {"conv_id": p.conv, "part": part, "nr": nr, "whole": whole, **p.n, "head": p.head, "tail": p.tail, "low": p.low, "high": p.high, "first": p.first, "last": p.last}
        if whole:
            before, grown = t.back(symbols, 0)
            audit, left = _finish(symbols, p.lines, 0, 0, True)
            row |= {"cost": grown + t.vectors[before[-1]][0], "audit": audit, "repaired": left, "symbols": b"", "lines": [], "effect": b""}
        else:
            row |= {"cost": None, "audit": None, "repaired": None, "symbols": bytes(p.symbols), "lines": p.lines, "effect": t.effect(symbols).tobytes()}
        nr += 1
        seen += p.size + 100
        out.append(row)

    def flush() -> pa.RecordBatch:
        nonlocal seen
        fields = [("conv_id", kind), ("part", pa.int32()), ("nr", pa.int32()), ("whole", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS], ("head", pa.string()), ("tail", pa.string()),
                  *[(c, turn_kind) for c in ("low", "high", "first", "last")], ("cost", pa.int64()), ("audit", pa.string()), ("repaired", _ARROW_LINES), ("symbols", pa.binary()), ("lines", _ARROW_LINES), ("effect", pa.binary())]
        batch = pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in fields], names=[n for n, _ in fields])
        out.clear()
        seen = 0
        return batch

    for batch in batches:
        kind, turn_kind = batch.schema.field("conv_id").type, batch.schema.field("turn").type
        for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if piece is None or conv != piece.conv:
                if piece:
                    close(piece, begun)
                    begun = True  # what comes now began in this task
                piece = _Piece(conv)
            elif piece.full(limit):
                close(piece, False)
                piece, begun = _Piece(conv), False
            piece.add(*row)
            if seen > PIECE_BYTES:
                yield flush()
    if piece:
        close(piece, False)
        yield flush()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies behind and before each piece of a conversation, from the pieces' tables in order."""
    t = tables(BLOCK)
    held: list[dict] = []

    def solved() -> pa.RecordBatch:
        vector, effects = 0, [np.frombuffer(r["effect"], np.int32).reshape(-1, 6) for r in held]
        behind, costs = [], []
        for e in reversed(effects):
            behind.append(vector)
            costs.append(int(e[vector, 1]))
            vector = int(e[vector, 0])
        behind, costs = behind[::-1], costs[::-1]
        costs[0] += t.vectors[vector][0]
        states, state = [], 0
        for e, v in zip(effects, behind, strict=True):
            states.append(state)
            state = int(e[v, 2 + state])
        illegal, turns, tail, last = [], [], "", None
        for r in held:
            illegal.append(int(bool(tail and r["head"]) and not _legal(tail, r["head"])))
            turns.append(-int(bool(r["head"]) and last is not None and r["first"] == last))
            tail, last = r["tail"] or tail, r["last"] if r["head"] else last
        n = len(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in held], pa.int32()) for c in ("part", "nr")] + [pa.array(x, pa.int32()) for x in (behind, states)]
            + [pa.array([i == n - 1 for i in range(n)])] + [pa.array(x, pa.int64()) for x in (costs, illegal, turns)],
            names=["part", "nr", "vector", "state", "final", "cost", "illegal", "turns"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield solved()
                held = []
            held.append(row)
    if held:
        yield solved()


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_finish(np.frombuffer(r["symbols"], np.uint8), r["lines"], r["vector"], r["state"], r["final"]) for r in batch.select(["symbols", "lines", "vector", "state", "final"]).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], _ARROW_LINES)], names=[*batch.schema.names[:3], "audit", "repaired"])


def repair(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired (array of role and text), once for every conv_id.

    Rows (conv_id, turn, role, text) come with ``copies`` if they stand for several, 0 for a mere mention of the conversation. They are taken by
    turn, null first, then by role and by digest of role and text. A null role or text counts as one space, so as blank or as another role. The
    null conv_id is a conversation like any other. Equal rows are one row with a count until a task writes them out, so a hot row costs one;
    rows are dealt by range of (conversation, turn, …), so a conversation of any length is spread over tasks. Its audit and its
    turns are one value by definition. Other columns are not read; an empty table gives no rows.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.col("copies") if "copies" in conversations.columns else F.lit(1)).cast("long").alias("copies"))
    rows = rows.withColumns({c: F.when(F.col("copies") > 0, F.col(c)) for c in ("turn", "role", "text")})
    order = ["conv_id", "turn", "role", "d"]
    sorted_ = _symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    conv, turn = (conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    schema = f"conv_id {conv}, part int, nr int, whole boolean, {counts}, head string, tail string, low {turn}, high {turn}, first {turn}, last {turn}, cost long, audit string, repaired {_LINES}, symbols binary, lines {_LINES}, effect binary"
    pieces = session.materialise(in_batches(sorted_.select("conv_id", "turn", "role", "text", "copies", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("blank", "again", "short")]), partial(_cut, piece), schema), "turn-pieces")
    part = pieces.filter("NOT whole")
    tables_ = part.select("conv_id", "part", "nr", "head", "tail", "first", "last", "effect").repartition("conv_id").sortWithinPartitions("conv_id", "part", "nr")
    chain = in_batches(tables_, _chained, "part int, nr int, vector int, state int, final boolean, cost long, illegal long, turns long")
    chain = session.materialise(chain, "turn-chain")
    ends = part.select("part", "nr", "conv_id", "symbols", "lines").join(chain.select("part", "nr", "vector", "state", "final"), ["part", "nr"])
    traced = in_batches(ends.select("part", "nr", "conv_id", "symbols", "lines", "vector", "state", "final"), _traced, f"part int, nr int, conv_id {conv}, audit string, repaired {_LINES}")
    numbers = part.drop("cost", "audit", "repaired", "symbols", "lines", "effect").join(
        chain.select("part", "nr", "cost", F.col("illegal").alias("more"), F.col("turns").alias("less")), ["part", "nr"])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    columns = ["blank", "duplicate", "truncated", "illegal", "cost"]
    summed = numbers.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")], F.sum(F.col("illegal") + F.col("more")).alias("illegal"),
        F.sum(F.col("turns") + F.col("less")).alias("turns"), F.min("low").alias("low"), F.max("high").alias("high"))
    texts = traced.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "nr", "audit", "repaired"))).alias("p"))
    texts = texts.select(F.col("conv_id").alias("c"), F.array_join(F.transform("p", lambda x: x["audit"]), "").alias("audit"), F.flatten(F.transform("p", lambda x: x["repaired"])).alias("repaired"))
    cut = summed.join(texts, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", gaps, *columns, "audit", "repaired")
    return pieces.filter("whole").select("conv_id", gaps, *columns, "audit", "repaired").unionByName(cut)
