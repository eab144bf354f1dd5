"""Name and text normalisation as ``Column -> Column`` functions (all JVM-side)."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Letters that unaccent expands to more than one letter.
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` with NULL, not the empty string, when nothing matches."""
    return blank_to_null(F.regexp_extract(col(c), pattern, group))


def strip_suffix(c: Column | str) -> Column:
    """Drop the trailing disambiguator: ``Prince (2)`` -> ``Prince``."""
    name = col(c)
    # only a name that ends in a parenthesis can carry one
    return blank_to_null(F.when(name.endswith(")"), F.regexp_extract(name, r"(?s)^(.+?)(?: \(\d+\))?\z", 1)).otherwise(name))


def name_key(c: Column | str) -> Column:
    """Join key of a plain name."""
    return F.lower(col(c))


def numbered_name_key(c: Column | str) -> Column:
    """Join key of a name that may carry a disambiguator."""
    return F.lower(strip_suffix(c))


def catno_key(c: Column | str) -> Column:
    """Join key of a catalog number: case and blanks do not count."""
    return F.lower(F.replace(col(c), F.lit(" "), F.lit("")))


def barcode_clean(c: Column | str) -> Column:
    """Remove separators if only digits remain; spell every "no barcode" as ``none``."""
    raw = col(c)
    bare = F.translate(raw, " ->./", "")
    value = F.when(bare.rlike(r"^[0-9]+\z"), bare).otherwise(raw)
    return F.when(value.rlike(r"(?i)none|no barcode"), F.lit("none")).otherwise(value)


def is_barcode(c: Column | str) -> Column:
    return col(c).rlike(r"^[0-9]{12,13}\z")


def find_barcode(c: Column | str) -> Column:
    return extract(c, r"(\d{12,13})")


def release_year(c: Column | str) -> Column:
    """First four characters as a number, NULL unless the text starts with four digits."""
    raw = col(c)
    return F.when(raw.rlike(r"^[0-9]{4}"), F.left(raw, F.lit(4)).try_cast("int"))


def first_sentence(c: Column | str) -> Column:
    return extract(c, r"(?s)^([^.]+\.?)")


def partial_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``YYYY[-MM[-DD]]``; a day counts only when the month is known."""
    y, m, d = col(year), col(month), col(day)

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    day_text = F.when(d.isNull(), "").otherwise(F.concat(F.lit("-"), two(d)))
    month_text = F.when(m.isNull(), "").otherwise(F.concat(F.lit("-"), two(m), day_text))
    return F.concat(F.coalesce(y.cast("string"), F.lit("")), month_text)


def array_concat(a: Column | str, b: Column | str) -> Column:
    """Concatenation in which a NULL side counts as empty (NULL only if both are)."""
    x, y = col(a), col(b)
    return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(F.concat(x, y))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(accented, plain) character strings, by rule from the Unicode character names.

    A letter whose name is ``LATIN <case> LETTER <name> WITH <mark>`` maps to the letter
    named by the part before ``WITH``.
    """
    accented, plain = [], []
    for code in range(0x110000):
        name = unicodedata.name(chr(code), "")
        m = re.match(r"(LATIN [A-Z]+ LETTER [A-Z]+) WITH", name)
        if not m:
            continue
        try:
            base = unicodedata.lookup(m.group(1))
        except KeyError:
            continue
        accented.append(chr(code))
        plain.append(base)
    return "".join(accented), "".join(plain)


def unaccent(c: Column | str) -> Column:
    out = col(c)
    for letter, expansion in LIGATURES.items():
        out = F.replace(out, F.lit(letter), F.lit(expansion))
    return F.translate(out, *accent_table())


def mangle_name(c: Column | str) -> Column:
    """Comparison form: lower case, no accents, no trailing "(feat. …)", letters and digits only."""
    plain = unaccent(F.lower(col(c)))
    no_feat = F.regexp_replace(plain, r"\(feat\. [^)]+\)(?=\n?\z)", "")
    return F.regexp_replace(no_feat, r"[^\p{L}\p{N}_]", "")


def drop_parenthesis(c: Column | str) -> Column:
    """Title without its trailing qualifier: ``Air (band)`` -> ``Air``."""
    return F.regexp_replace(col(c), r" \(.+\)(?=\n?\z)", "")


def quoted_first(kind: str, first: Column | str, n: Column | str, shown: int = 3) -> Column:
    """``albums "a", "b" and "c"``; from ``shown + 1`` names on, ``… and N more``.

    ``first`` holds the first ``shown`` names, ``n`` is the number of all names.
    """
    a = F.transform(col(first), lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    count = col(n)
    plural = "categories" if kind == "category" else (kind + "s" if kind else "")
    head = F.when(count > 1, F.lit(plural + " " if plural else "")).otherwise(F.lit(kind + " " if kind else ""))
    size = F.size(a)
    few = F.concat(
        F.array_join(F.slice(a, F.lit(1), F.greatest(size - 1, F.lit(0))), ", "), F.lit(" and "), F.try_element_at(a, F.greatest(size, F.lit(1)))
    )
    many = F.concat(F.array_join(F.slice(a, 1, shown), ", "), F.lit(" and "), (count - shown).cast("string"), F.lit(" more"))
    body = F.when(count == 1, F.try_element_at(a, F.lit(1))).when(count <= shown, few).otherwise(many)
    return F.when(col(first).isNull() | (count <= 0), "").otherwise(F.concat(head, body))


def quoted_list(kind: str, names: Column | str, shown: int = 3) -> Column:
    """:func:`quoted_first` for a complete list."""
    return quoted_first(kind, names, F.size(col(names)), shown)


def comma_and(names: Column | str) -> Column:
    """``A, B and C``."""
    a = col(names)
    n = F.size(a)
    last = F.try_element_at(a, F.greatest(n, F.lit(1)))
    return F.when(n > 1, F.concat(F.array_join(F.slice(a, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), last)).otherwise(last)


# Scripts a name must show before it is looked up in a language's encyclopedia.
LANGUAGE_SCRIPTS = {"ja": ("Katakana", "Hiragana", "Han"), "ko": ("Hangul",)}


def _script_class(scripts: tuple[str, ...]) -> str:
    return "[" + "".join(r"\p{Is%s}" % s for s in scripts) + "]"


def in_script(c: Column | str, *scripts: str) -> Column:
    """Every character belongs to one of the scripts."""
    return col(c).rlike(rf"^{_script_class(scripts)}+\z")


def has_script(c: Column | str, *scripts: str) -> Column:
    """At least one character belongs to one of the scripts."""
    return col(c).rlike(_script_class(scripts))


def duration_seconds(c: Column | str) -> Column:
    """``m:ss`` -> seconds."""
    parts = F.split(col(c), ":")
    return F.try_element_at(parts, F.lit(1)).try_cast("int") * 60 + F.try_element_at(parts, F.lit(2)).try_cast("int")


def format_seconds(c: Column | str) -> Column:
    """Seconds -> ``m:ss``."""
    s = col(c).cast("long")
    text = F.format_string("%d:%02d", F.floor(s / 60).cast("long"), s % 60)
    return F.when(s.isNotNull(), text)


def track_number(c: Column | str) -> Column:
    return extract(c, r"^(\d+). .+").try_cast("int")


def track_title(c: Column | str) -> Column:
    return extract(c, r"^\d+. (.+)$")


def format_iswc(c: Column | str) -> Column:
    """``T0123456789`` -> ``T-012.345.678-9``."""
    return F.regexp_replace(col(c), r"^(.)(.{3})(.{3})(.{3})(.).*$", "$1-$2.$3.$4-$5")


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.format_string("%.0f", col(part) * 100.0 / col(whole))
