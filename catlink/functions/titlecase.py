"""Title casing and sort names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catlink.functions.text import col, let

# Words that stay in lower case inside a title.
SMALL_WORDS = (
    "a an the "
    "and but or nor "
    "as at by for in of on to but cum mid off per qua re up via"
).split()

# Extra title information written in lower case, applied in this order.
EXTRA_TITLE_INFO = (
    "feat.",
    "live",
    "mix",
    "remix",
    "edit",
    "version",
    "album version",
    "bonus track",
    "radio edit",
)


def _words(c: Column, unicode_words: bool) -> Column:
    """Words (apostrophes inside a word belong to it) and the separators between them."""
    flag = "(?U)" if unicode_words else ""
    return F.regexp_extract_all(c, F.lit(flag + r"(\w+(?:'\w+)*|\W+)"), F.lit(1))


def guess_case(c: Column | str, unicode_words: bool = False) -> Column:
    """Capitalise every word except articles, conjunctions and prepositions.

    The first and last word are always capitalised, but only when no separator stands
    before or after them. By default a word is made of ASCII letters, digits and ``_``;
    ``unicode_words`` takes all letters.
    """
    flag = "(?U)" if unicode_words else ""

    def cased(words: Column) -> Column:
        last = F.size(words) - 1

        def one(word: Column, i: Column) -> Column:
            upper_first = F.concat(F.upper(F.left(word, F.lit(1))), F.substr(word, F.lit(2)))
            keep_small = F.lower(word).isin(*SMALL_WORDS) & (i > 0) & (i < last)
            return F.when(~word.rlike(flag + r"^\w"), word).when(keep_small, F.lower(word)).otherwise(upper_first)

        return F.array_join(F.transform(words, one), "")

    return let(_words(col(c), unicode_words), cased)


def guess_case_title(c: Column | str, unicode_words: bool = False) -> Column:
    """Like :func:`guess_case`, with known version information in the last parenthesis in lower case."""
    cased = guess_case(c, unicode_words)
    tail = r"(?s)^(.*) \(([^)]+)\)(\n?)\z"
    info = F.regexp_extract(cased, tail, 2)
    for phrase in EXTRA_TITLE_INFO:
        pattern = phrase.replace(".", r"\.")
        info = F.regexp_replace(info, rf"(?i)(^| )({pattern})(\z| )", f"$1{phrase}$3")
    rebuilt = F.concat(F.regexp_extract(cased, tail, 1), F.lit(" ("), info, F.lit(")"), F.regexp_extract(cased, tail, 3))
    return F.when(cased.rlike(tail), rebuilt).otherwise(cased)


def add_sort_name(artists: DataFrame, given_names: DataFrame, name: str = "name", out: str = "sort_name") -> DataFrame:
    """``The XX`` -> ``XX, The``; a known given name plus one word -> ``Word, Given``.

    ``given_names`` has one column ``name`` of lower-case names. Its size decides, at run
    time, between a broadcast and a shuffled join.
    """
    cased = guess_case(col(name))
    words = _words(cased, False)
    two_words = cased.rlike(r"^\w+(?:'\w+)* \w+(?:'\w+)*\z")
    first = F.try_element_at(words, F.lit(1))
    third = F.try_element_at(words, F.lit(3))
    known = given_names.select(F.lower("name").alias("_given")).distinct().withColumn("_known", F.lit(True))
    df = artists.withColumn("_words", words).withColumn("_cased", cased)
    df = df.withColumn("_given", F.when(two_words, F.lower(first))).join(known, "_given", "left")
    words, cased = F.col("_words"), F.col("_cased")
    first, third = F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(3))
    rest = F.trim(F.substr(cased, F.length(first) + 1))
    value = (
        F.when(F.col("_known"), F.concat(third, F.lit(", "), first))
        .when(first.isin("The", "A"), F.concat(rest, F.lit(", "), first))
        .otherwise(cased)
    )
    return df.withColumn(out, value).drop("_given", "_known", "_words", "_cased")
