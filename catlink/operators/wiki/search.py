"""Ranked title search over a stored inverted index, any word of a name sufficing.

A word weighs ``1000 ln(1 + titles / titles with the word)``, rounded. The score of a title for a name is the weight of the words they share
over the weight of the words they have in all: 1 for equal words, and rare words decide. The index keeps one posting for each word of a title,
stored in order of the word and the title's weight, and the head of every list: its ``depth`` lightest titles, which score best among all
titles that share nothing but that word. A posting carries what a score needs, so that pairs of names and titles are scored where they meet.

Words, titles, names and their rankings are repetitive, so their files are up to a hundred times smaller than their rows; Spark goes by the files. Tables
as long as those of titles or names are therefore shuffled to each other (``_by_shuffle``) and never broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from catlink import session

DEPTH = 50
UNIT = 1000

# About as many pairs of names and titles meet in one task.
PAIRS = 1 << 20


def tokens(c: Column | str) -> Column:
    """Lower-case words of a title, each once."""
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.array_distinct(F.regexp_extract_all(low, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))


def _by_shuffle(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join of two tables of which neither may be broadcast, however small its files are."""
    return left.hint("merge").join(right, on, how)


@dataclass(frozen=True)
class TitleIndex:
    """``words`` (word, df, weight, floor, floor_title) and ``postings`` (word, title, words, title_weight, place, listed), stored.

    ``floor`` and ``floor_title`` are the weight and title at the end of the head of a list; ``place`` is a posting's number in the head, null
    behind it; ``listed`` are the words of the title that have it in their heads.
    """

    words: DataFrame
    postings: DataFrame
    depth: int


def build_index(titles: DataFrame, depth: int = DEPTH) -> TitleIndex:
    """The index of all distinct titles that have words."""
    plain = titles.select("title").distinct().withColumn("words", tokens("title")).filter(F.size("words") > 0)
    plain = session.materialise(plain, "index-titles")
    n = plain.count()
    by_word = plain.select("title", F.explode("words").alias("word"))
    frequency = by_word.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    frequency = session.materialise(frequency.withColumn("weight", F.round(F.lit(UNIT) * F.log(F.lit(1) + F.lit(n) / F.col("df"))).cast("long")), "index-frequency")
    weights = _by_shuffle(by_word, frequency, "word").groupBy("title").agg(F.sum("weight").alias("title_weight"))
    weighed = session.materialise(_by_shuffle(plain, weights, "title"), "index-titles-weighed")
    postings = weighed.select(F.explode("words").alias("word"), "title", "title_weight")
    # Spark keeps the first ``depth`` of each word on every task before it shuffles them.
    head = postings.withColumn("place", F.row_number().over(W.partitionBy("word").orderBy("title_weight", "title"))).filter(F.col("place") <= depth)
    head = session.materialise(head, "index-head")
    listed = head.groupBy("title").agg(F.map_from_entries(F.collect_list(F.struct("word", "place"))).alias("places"))
    places = F.coalesce("places", F.create_map().cast("map<string,int>"))
    full = _by_shuffle(weighed, listed, "title", "left").select(F.explode("words").alias("word"), "title", "words", "title_weight", places.alias("places"))
    full = full.select("word", "title", "words", "title_weight", F.try_element_at("places", "word").alias("place"), F.map_keys("places").alias("listed"))
    full = full.repartitionByRange("word", "title_weight", "title").sortWithinPartitions("word", "title_weight", "title")
    end = head.groupBy("word").agg(F.max(F.struct("title_weight", "title")).alias("end"))
    words = _by_shuffle(frequency, end, "word").select("word", "df", "weight", F.col("end.title_weight").alias("floor"), F.col("end.title").alias("floor_title"))
    return TitleIndex(session.materialise(words, "index-words"), session.materialise(full, "index-postings"), depth)


def _queries(entities: DataFrame, index: TitleIndex) -> DataFrame:
    """(number, query, terms, weight): the distinct word sets of names; ``terms`` are the words that titles have, the heaviest first."""
    names = entities.select(F.sort_array(tokens("name")).alias("query")).filter(F.size("query") > 0).distinct()
    words = _by_shuffle(names.select("query", F.explode("query").alias("word")), index.words, "word", "left")
    term = F.struct((-F.col("weight")).alias("order"), "word", "weight")
    # A word that no title has weighs as much as one that a single title has, at least.
    unknown = F.coalesce("weight", F.lit(int(UNIT * 20)))
    grouped = words.groupBy("query").agg(F.array_sort(F.collect_list(F.when(F.col("df").isNotNull(), term))).alias("terms"), F.sum(unknown).alias("weight"))
    return grouped.filter(F.size("terms") > 0).withColumn("number", F.monotonically_increasing_id())


def _meet(terms: DataFrame, postings: DataFrame, entries: Column, index: TitleIndex, pairs: int) -> DataFrame:
    """``terms`` (word, number, terms, weight, ...) next to the postings of their words, with the words they share.

    A word whose names and ``entries`` make more than ``pairs`` pairs is dealt over so many tasks by the number of the name.
    """
    wanted = _by_shuffle(terms.groupBy("word").agg(F.count(F.lit(1)).alias("names")), index.words, "word")
    load = session.materialise(wanted.select("word", (F.col("names") * entries).alias("load")), "search-load")
    parts = int(load.agg(F.ceil(F.coalesce(F.sum("load"), F.lit(0)) / pairs)).first()[0]) + load.sparkSession.sparkContext.defaultParallelism
    hot = load.filter(F.col("load") > pairs).select("word", F.ceil(F.col("load") / pairs).cast("int").alias("_parts"))
    shares = F.coalesce("_parts", F.lit(1))
    left = terms.join(hot, "word", "left").withColumn("_part", F.pmod(F.xxhash64("number"), shares).cast("int")).drop("_parts")
    right = postings.join(hot, "word", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_parts")
    both = left.repartition(parts, "word", "_part").join(right.repartition(parts, "word", "_part"), ["word", "_part"])
    return both.withColumn("shared", F.filter("terms", lambda x: F.array_contains(F.col("words"), x["word"])))


def _scored(both: DataFrame, least: int) -> DataFrame:
    """(number, title, score) of pairs that share ``least`` words."""
    common = F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["weight"])
    score = common / (F.col("weight") + F.col("title_weight") - common)
    return both.filter(F.size("shared") >= least).select("number", "title", score.alias("score"))


def _ranked(rows: DataFrame, k: int | None) -> DataFrame:
    top = rows.withColumn("rank", F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), "title")))
    return top if k is None else top.filter(F.col("rank") <= k)


def search_titles(entities: DataFrame, index: TitleIndex, k: int | None = DEPTH, least: int = 1, pairs: int = PAIRS) -> DataFrame:
    """(id, title, score, rank): the ``k`` best titles (all without ``k``) that have ``least`` or more words of the name; ties go by title.

    First only the heads of the lists are read, ``depth`` postings for each word, and give the k-th best title. A title outside them can
    do better only if it also shares a lighter word: so the list of a word is read on where the words from it down could still beat that
    score (or tie with it by an earlier title), and only for titles that could. The list of a name's lightest word is never read beyond its
    head, so frequent words cost no more than rare ones. A pair counts where its heaviest shared word is met, so it is never met twice.
    Without ``k`` the lists of the ``least - 1`` lightest words are not read: who shares so many words shares a heavier one too.
    Names of the same words are looked up once.
    """
    if k is not None and k > index.depth:
        raise ValueError(f"the index keeps heads of {index.depth} titles, {k} are asked for")
    queries = session.materialise(_queries(entities, index), "title-queries")
    term = queries.select("number", "weight", "terms", F.posexplode("terms").alias("at", "term"))
    term = term.select("number", "weight", "terms", "at", F.col("term.word").alias("word"))
    heaviest = F.col("shared")[0]["word"] == F.col("word")
    if k is None:
        narrow = term.filter(F.col("at") <= F.size("terms") - least).drop("at")
        postings = index.postings.select("word", "title", "words", "title_weight")
        top = _ranked(_scored(_meet(narrow, postings, F.col("df"), index, pairs).filter(heaviest), least), None)
    else:
        in_heads = F.filter("shared", lambda x: F.array_contains(F.col("listed"), x["word"]))
        head = index.postings.filter("place IS NOT NULL").drop("place")
        met = _meet(term.drop("at"), head, F.least("df", F.lit(index.depth)), index, pairs).filter(in_heads[0]["word"] == F.col("word"))
        first = session.materialise(_ranked(_scored(met, least), k), "title-heads")
        bar = first.filter(F.col("rank") == k).select("number", F.col("score").alias("bar"), F.col("title").alias("bar_title"))
        lighter = F.aggregate(F.slice("terms", F.col("at") + 1, F.size("terms")), F.lit(0).cast("long"), lambda a, x: a + x["weight"])

        def beats(weight: str, title: str) -> Column:
            """A title of this weight that shares all words from this one down comes before the k-th best so far."""
            best = F.col("most") / (F.col("weight") + F.col(weight) - F.col("most"))
            return F.col("bar").isNull() | (best > F.col("bar")) | ((best == F.col("bar")) & (F.col(title) < F.col("bar_title")))

        long = index.words.filter(F.col("df") > index.depth).select("word", "floor", "floor_title")
        more = _by_shuffle(term.filter(F.col("at") < F.size("terms") - 1).join(long, "word").withColumn("most", lighter), bar, "number", "left")
        more = session.materialise(more.filter(beats("floor", "floor_title")).drop("at", "floor", "floor_title"), "title-lists")
        beyond = _meet(more, index.postings.filter("place IS NULL").drop("place"), F.col("df"), index, pairs)
        beyond = _scored(beyond.filter(beats("title_weight", "title") & heaviest & (F.size(in_heads) == 0)), least)
        again = more.select("number").distinct()
        renewed = _ranked(first.join(again, "number", "left_semi").drop("rank").unionByName(beyond), k)
        top = first.join(again, "number", "left_anti").unionByName(renewed)
    named = _by_shuffle(entities.select("id", F.sort_array(tokens("name")).alias("query")), queries.select("query", "number"), "query")
    return _by_shuffle(named.select("id", "number"), top, "number").select("id", "title", "score", "rank")
