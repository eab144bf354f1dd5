"""Scanners of page markup over Arrow columns, in time linear in the text: the parts of ``wikitext`` that need more than regular expressions."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

SPACE = b" \t\n\x0b\f\r"
_STEP = 1 << 22
"""Bytes of text that one numpy step takes; a longer text is a step of its own."""


def _runs(data: np.ndarray, byte: int, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of a byte; no run crosses a break."""
    at = np.flatnonzero(data == byte)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | np.isin(at[1:], breaks)
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def _pairs(data: np.ndarray, byte: int, breaks: np.ndarray) -> np.ndarray:
    """Starts of the doubled bytes, read from the left of each run."""
    start, length = _runs(data, byte, breaks)
    n = length // 2
    return np.repeat(start, n) + 2 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def _words(data: np.ndarray, word: bytes, row: np.ndarray) -> np.ndarray:
    """Starts of a word of different or equal bytes, inside one row."""
    n = len(data) - len(word) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    found = data[:n] == word[0]
    for i, b in enumerate(word[1:], 1):
        found &= data[i:n + i] == b
    at = np.flatnonzero(found)
    return at[row[at] == row[at + len(word) - 1]] if len(at) else at


def _visible(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes lie outside all templates and comments.

    Marks are read from the left. Their depths are prefix sums over the marks of a row; a byte is kept where both are zero, so a stray closing
    mark, which makes its depth negative, hides what follows too.
    """
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start_comment, end_comment = _words(data, b"<!--", row), _words(data, b"-->", row)
    # The dashes of a comment's beginning are not those of an end.
    end_comment = end_comment[~np.isin(end_comment, np.concatenate([start_comment + 2, start_comment + 3]))]
    marks = [(_pairs(data, 0x7B, offsets), 2, 1, 0), (_pairs(data, 0x7D, offsets), 2, -1, 0), (start_comment, 4, 0, 1), (end_comment, 3, 0, -1)]
    at = np.concatenate([m[0] for m in marks])
    width, template, comment = (np.concatenate([np.full(len(m[0]), m[i]) for m in marks]) for i in (1, 2, 3))
    order = np.argsort(at, kind="stable")
    at, width, template, comment = at[order], width[order], template[order], comment[order]
    keep = np.ones(len(data), bool)
    if not len(at):
        return keep
    of = row[at]
    first = np.searchsorted(of, of)  # the first mark of the same row
    depth = []
    for delta in (template, comment):
        total = np.concatenate([[0], np.cumsum(delta)])
        depth.append(total[1:] - total[first])
    hidden = (depth[0] != 0) | (depth[1] != 0)
    # From the end of a mark to the next mark, or to the end of the row.
    until = np.append(at[1:], len(data))
    last = np.append(of[1:] != of[:-1], True)
    until[last] = offsets[of[last] + 1]
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    np.add.at(change, (at + width)[hidden], 1)
    np.add.at(change, until[hidden], -1)
    return np.cumsum(change[:-1]) == 0


def without_markup(text: pa.Array) -> list[bytes | None]:
    """Every text without templates, which may be nested, and comments."""
    text = text.cast(pa.large_binary())
    out: list[bytes | None] = []
    values = text.fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    body = values.buffers()[2] if len(values) else None
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(values):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _STEP, "right")) - 1)
        here, cuts = data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        keep = _visible(here, cuts)
        kept, total = here[keep].tobytes(), np.concatenate([[0], np.cumsum(keep)])[cuts]
        out += [kept[a:b] for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True)]
        first = end
    valid = text.is_valid().to_pylist()
    return [x if ok else None for x, ok in zip(out, valid, strict=True)]


def first_paragraphs(text: pa.Array) -> list[bytes | None]:
    return [None if x is None else x.strip(SPACE).split(b"\n\n", 1)[0] for x in without_markup(text)]


_SIGN = re.compile(r"\{\{|\}\}|\||=|\r\n|\n|\r")
_BRACES = re.compile(r"\{\{|\}\}")
_BLANK = " \t\n\x0b\f\r"


def template_body(text: str, start: int) -> tuple[int, int, list[tuple[int, str]]] | None:
    """(begin, end, signs) of the body of a template whose head ends at ``start``: from its first bar to the braces that close it.

    ``signs`` are the line breaks and equals signs outside the templates within. None if the braces are never closed. A template without a
    bar has an empty body.
    """
    depth, begin, signs = 1, None, []
    for found in _SIGN.finditer(text, start):
        sign, at = found.group(), found.start()
        if sign == "{{":
            depth += 1
        elif sign == "}}":
            depth -= 1
            if not depth:
                return (at if begin is None else begin), at, signs
        elif depth == 1:
            if begin is None:
                begin = at if sign == "|" else None
            if begin is not None and sign != "|":
                signs.append((at, sign))
    return None


def fields(text: str, body: tuple[int, int, list[tuple[int, str]]]) -> dict[str, str]:
    """``| name = value`` lines of a body; names in lower case, the last value of a name wins. Lines without an equals sign are passed over."""
    begin, end, signs = body
    out: dict[str, str] = {}
    start, equals = begin, None

    def line(stop: int) -> None:
        if equals is not None:
            name = text[start:equals].strip(_BLANK).lstrip("| ").lower()
            out.pop(name, None)
            out[name] = text[equals + 1:stop].strip(_BLANK)

    for at, sign in signs:
        if sign != "=":
            line(at)
            start, equals = at + len(sign), None
        elif equals is None:
            equals = at
    line(end)
    return out


def template(text: str | None, head: re.Pattern[str]) -> tuple[str, dict[str, str]] | None:
    """(first group of the head, fields) of the first template with that head whose braces are closed. One pass with a stack finds it."""
    if not text or not head.search(text):
        return None
    best, open_, heads = None, [], 0
    for brace in _BRACES.finditer(text):
        if brace.group() == "{{":
            open_.append(head.match(text, brace.start()))
            heads += open_[-1] is not None
        elif open_:
            closed = open_.pop()
            if closed is not None:
                heads -= 1
                best = closed if best is None or closed.start() < best.start() else best
            if best is not None and not heads:
                break
    if best is None:
        return None
    return (best.group(1) if head.groups else ""), fields(text, template_body(text, best.end()))
