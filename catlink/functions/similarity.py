"""String similarity in which a substitution costs two: ``2 * LCS / (len(a) + len(b))``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, functions as F

from catlink.functions.text import col


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, all cells of a row at once.

    Bit j of ``row`` is 0 where the row of the dynamic programme grows at letter j of ``a``. A row follows from the one before by an addition
    that carries each match to the next growing cell; the integers are worked on in machine words, so a pair of m and n letters takes n steps
    of m / 64 words.
    """
    places: dict[str, int] = {}
    for j, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << j
    full = row = (1 << len(a)) - 1
    for letter in b:
        matches = row & places.get(letter, 0)
        if matches:
            row = (row + matches | row - matches) & full
    return len(a) - row.bit_count()


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence; null if a side is."""
    def lengths(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = zip(x.to_pylist(), y.to_pylist(), strict=True)
        return pa.array([None if u is None or v is None else _common(u, v) for u, v in pairs], pa.int32())

    x, y = col(a), col(b)
    return F.when(x == y, F.length(x)).otherwise(F.arrow_udf(lengths, "int")(x, y))


def ratio(a: Column | str, b: Column | str) -> Column:
    x, y = col(a), col(b)
    total = F.length(x) + F.length(y)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * lcs_length(x, y) / F.greatest(total, F.lit(1)))


def ratio_at_least(a: Column | str, b: Column | str, threshold: float) -> Column:
    """The ratio if it reaches the threshold, else NULL.

    One minus the plain edit distance over the total length is never below the ratio, so it
    decides cheaply for most pairs that the quadratic computation is not needed.
    """
    x, y = col(a), col(b)
    total = F.greatest(F.length(x) + F.length(y), F.lit(1))
    bound = F.lit(1.0) - F.levenshtein(x, y) / total
    exact = F.when(bound >= threshold, ratio(x, y))
    return F.when(exact >= threshold, exact)
