"""Match catalog entities to encyclopedia pages by how many of their titles the page mentions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from catlink import session
from catlink.config import Catalog
from catlink.functions.text import drop_parenthesis, mangle_name, quoted_first
from catlink.functions.urls import quote_title, wiki_base
from catlink.functions.wikitext import categories
from catlink.operators.keys import first_by

# Title matching ----------------------------------------------------------------------------------


# Titles of works are not candidates for artists.
WORK_SUFFIXES = ("album)", "song)")


def match_titles(entities: DataFrame, titles: DataFrame, skip: Sequence[str] = WORK_SUFFIXES) -> DataFrame:
    """(id, title, exact): titles equal to the name in comparison form, with or without their qualifier.

    A plain equality join, so no cut-off like that of a ranked search applies. Names without
    letters or digits match nothing.
    """
    t = titles.select("title").distinct()
    for suffix in skip:
        t = t.filter(~F.col("title").endswith(suffix))
    whole, cut = mangle_name("title"), mangle_name(drop_parenthesis("title"))
    keyed = t.select("title", whole.alias("_whole"), F.explode(F.array_distinct(F.array(whole, cut))).alias("_key")).filter("_key <> ''")
    names = entities.select("id", mangle_name("name").alias("_key"))
    return names.join(keyed, "_key").select("id", "title", (F.col("_key") == F.col("_whole")).alias("exact"))


# Page filters -------------------------------------------------------------------------------------

# Signs, per use, that a page is a redirect, a disambiguation or an album page.
_COMMON = ("redirect", "disambiguationpages", "homonymie")
PAGE_RULES = {
    "artist": {"page_not": (*_COMMON, "infoboxalbum"), "title_not": ("disambiguation",), "text_not": ("{{disambig", "{{disamb"), "page_has": ()},
    "release_group": {"page_not": _COMMON, "title_not": ("disambiguation",), "text_not": ("{{disambig",), "page_has": ()},
    "label": {"page_not": ("disambiguationpages",), "title_not": (), "text_not": (), "page_has": ("recordlabels",)},
    "ja": {"page_not": ("曖昧さ回避",), "title_not": (), "text_not": (), "page_has": ()},
    "ko": {"page_not": ("동음이의",), "title_not": (), "text_not": (), "page_has": ()},
}


def usable_pages(pages: DataFrame, use: str) -> DataFrame:
    """Pages that pass the rules, with their comparison form ``page``. Empty pages are out."""
    rules = PAGE_RULES[use]
    df = pages.filter(F.length("text") > 0)
    low = F.lower("text")
    for word in rules["title_not"]:
        df = df.filter(~F.col("title").contains(word))
    for word in rules["text_not"]:
        df = df.filter(~low.contains(word))

    def passes(page: Column) -> Column:
        signs = [~page.contains(w) for w in rules["page_not"]] + [page.contains(w) for w in rules["page_has"]]
        return reduce(lambda x, y: x & y, signs)

    # as a generator, so that the comparison form is not computed once more for every sign
    return df.withColumn("page", F.explode(F.filter(F.array(mangle_name("text")), passes)))


def is_album_page(text: Column | str, lang: str) -> Column:
    """A category says that the page is about an album."""
    found = categories(text, lang)
    if lang == "fr":
        return F.exists(found, lambda c: c.startswith("Album "))
    return F.exists(found, lambda c: F.lower(c).endswith(" albums") | F.lower(c).endswith(" soundtracks"))


# Mention ratio --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class MentionRule:
    """What counts as a mention and when a page is accepted.

    ``min_length``: a title counts as found only if its comparison form is longer.
    ``drop_self``: ``contained`` leaves out titles that contain the entity's name, ``equal`` only
    the name itself, both before counting. ``drop_short`` leaves out short titles before counting.
    ``ratio`` applies to names of up to ``long_name`` characters, ``long_ratio`` to longer ones.
    """

    kind: str
    min_length: int
    drop_self: str = "contained"
    drop_short: bool = False
    min_titles: int = 1
    min_found: int = 0
    ratio: float | None = None
    long_name: int | None = None
    long_ratio: float | None = None


# Thresholds per use.
RULES = {
    "artist": MentionRule("album", 6, ratio=0.3, long_name=15, long_ratio=0.15),
    "ja": MentionRule("album", 4, min_found=2, ratio=0.2),
    "ko": MentionRule("album", 4, min_found=2),
    "release_group": MentionRule("track", 4, drop_short=True, min_titles=5, ratio=1.0, long_name=4, long_ratio=0.7),
    "label": MentionRule("artist", 5, drop_self="equal", min_found=2),
}


# Items that one automaton looks for; a page with more of them is read once for each such share of them.
ITEMS_AT_ONCE = 50_000


def _found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(title, item) of every item that occurs in the page of its row: one automaton of all its items, one pass over the text."""
    import ahocorasick

    for batch in batches:
        titles, found = [], []
        for title, page, items in zip(*[batch.column(c) for c in ("title", "page", "items")], strict=True):
            automaton = ahocorasick.Automaton()
            wanted = items.as_py()
            for i, item in enumerate(wanted):
                automaton.add_word(item, i)
            automaton.make_automaton()
            hit: set[int] = set()
            for _, i in automaton.iter(page.as_py()):
                hit.add(i)
                if len(hit) == len(wanted):
                    break
            titles += [title.as_py()] * len(hit)
            found += [wanted[i] for i in hit]
        yield pa.RecordBatch.from_arrays([pa.array(titles, pa.string()), pa.array(found, pa.string())], names=["title", "_item"])


def items_on_pages(wanted: DataFrame, pages: DataFrame, at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """Distinct (title, _item) of ``wanted`` whose item occurs in a page of that title (``title``, ``page``).

    All items looked for in a page travel to it as arrays of ``at_once`` or fewer, so the text of a page is joined and read once, however
    many entities and items it is a candidate for. Empty items occur nowhere.
    """
    session.bound_batches(pages.sparkSession)
    wanted = wanted.select("title", "_item").filter("_item <> ''").distinct()
    # The shares follow from the number of items of a title; nearly every title has one.
    shares = wanted.groupBy("title").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias("_shares"))
    shared = wanted.join(shares, "title").groupBy("title", F.pmod(F.xxhash64("_item"), F.col("_shares")).alias("_share")).agg(F.collect_list("_item").alias("items"))
    rows = pages.select("title", "page").join(shared.select("title", "items"), "title")
    return rows.mapInArrow(_found_in, "title string, _item string").distinct()


def _numbers_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, title, n) of every numbered item that occurs in the page of its row."""
    import ahocorasick

    for batch in batches:
        for title, page, items in zip(*[batch.column(c) for c in ("title", "page", "items")], strict=True):
            ids, numbers, words = items.values.flatten()
            places: dict[str, list[int]] = {}
            for i, word in enumerate(words.to_pylist()):
                places.setdefault(word, []).append(i)
            automaton = ahocorasick.Automaton()
            for word in places:
                automaton.add_word(word, word)
            automaton.make_automaton()
            hit: set[str] = set()
            for _, word in automaton.iter(page.as_py()):
                hit.add(word)
                if len(hit) == len(places):
                    break
            found = pa.array([i for word in hit for i in places[word]], pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(found), pa.array([title.as_py()] * len(found), pa.string()), numbers.take(found)], names=["id", "title", "n"])


def numbers_on_pages(wanted: DataFrame, pages: DataFrame, at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """Distinct (id, title, n) of ``wanted`` (id, title, n, _item) whose item occurs in a page of that title: as ``items_on_pages``, but only
    numbers leave the pages.

    Titles with more than ``at_once`` items are stored first, few by nature, so that the texts of items are dealt once, by title and share.
    """
    session.bound_batches(pages.sparkSession)
    wanted = wanted.select("id", "title", "n", "_item").filter("_item <> ''")
    shares = wanted.groupBy("title").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias("_shares")).filter("_shares > 1")
    shares = session.materialise(shares, "mention-shares")
    share = F.coalesce(F.pmod(F.xxhash64("_item"), F.col("_shares")).cast("int"), F.lit(0))
    items = wanted.join(shares, "title", "left").groupBy("title", share.alias("_share")).agg(F.collect_list(F.struct("id", "n", "_item")).alias("items"))
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))
    texts = pages.select("title", "page").join(shares, "title", "left").select("title", "page", each.alias("_share"))
    rows = texts.join(items, ["title", "_share"]).select("title", "page", "items")
    return rows.mapInArrow(_numbers_in, f"id {wanted.schema['id'].dataType.simpleString()}, title string, n int").distinct()


def mentions(entities: DataFrame, candidates: DataFrame, pages: DataFrame, titles: DataFrame, rule: MentionRule) -> DataFrame:
    """(id, title, n_titles, n_found, ratio, first_found, accepted) per candidate page.

    ``entities`` is (id, name), ``candidates`` (id, title), ``pages`` (title, page) and ``titles``
    (id, name). A page is searched once for all titles of all its candidates; only the pairs found
    leave it. A title that several pages share counts each item once.
    """
    return _mentions(entities, candidates, session.materialise(pages.select("title", "page"), "mention-pages"), titles, rule)


def _mentions(entities: DataFrame, candidates: DataFrame, pages: DataFrame, titles: DataFrame, rule: MentionRule) -> DataFrame:
    """``mentions`` of stored pages. Only candidates that have a page, and only titles of entities that have such a candidate, go further;
    those titles are brought into comparison form once, numbered within their entity in order and stored, and what is found are their numbers."""
    pairs = candidates.select("id", "title").distinct().join(pages.select("title").distinct(), "title", "left_semi")
    pairs = session.materialise(pairs.select("id", "title"), "mention-candidates")
    own = entities.select("id", F.col("name").alias("_own"), mangle_name("name").alias("_self")).join(pairs.select("id").distinct(), "id", "left_semi")
    t = titles.select("id", F.col("name").alias("item")).join(pairs.select("id").distinct(), "id", "left_semi").distinct()
    t = t.withColumn("_item", F.explode(F.array(mangle_name("item")))).join(own, "id")
    t = t.filter(F.col("item") != F.col("_own")) if rule.drop_self == "equal" else t.filter(~F.col("_item").contains(F.col("_self")))
    if rule.drop_short:
        t = t.filter(F.length("_item") > rule.min_length)
    t = t.withColumn("n", F.row_number().over(W.partitionBy("id").orderBy("item")))
    t = session.materialise(t.select("id", "_own", "item", "_item", "n"), "mention-items")
    totals = t.groupBy("id", "_own").agg(F.count(F.lit(1)).alias("n_titles")).filter(F.col("n_titles") >= rule.min_titles)
    looked_for = pairs.join(t.filter(F.length("_item") > rule.min_length).select("id", "n", "_item"), "id")
    hits = session.materialise(numbers_on_pages(looked_for, pages), "mention-hits")
    # One shuffle ranks and counts the hits of a candidate; only the first three meet their texts again.
    group = W.partitionBy("id", "title")
    hits = hits.withColumn("_rn", F.row_number().over(group.orderBy("n"))).withColumn("n_found", F.count(F.lit(1)).over(group)).filter("_rn <= 3")
    hits = hits.join(t.select("id", "n", "item"), ["id", "n"])
    found = hits.groupBy("id", "title").agg(F.max("n_found").alias("n_found"), F.sort_array(F.collect_list("item")).alias("first_found"))
    rows = (
        pairs.join(totals, "id").join(found, ["id", "title"], "left")
        .withColumn("n_found", F.coalesce("n_found", F.lit(0)))
        .withColumn("ratio", F.col("n_found") / F.col("n_titles"))
    )
    accepted = F.col("n_found") >= rule.min_found
    if rule.ratio is not None:
        need = F.lit(rule.ratio)
        if rule.long_name is not None:
            need = F.when(F.length("_own") > rule.long_name, F.lit(rule.long_ratio)).otherwise(need)
        accepted = accepted & (F.col("ratio") >= need)
    return rows.select("id", "title", "n_titles", "n_found", "ratio", "first_found", accepted.alias("accepted"))


def first_accepted(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """One page per entity: an exactly equal title before a qualified one, then by title."""
    good = rows.filter("accepted").join(candidates.select("id", "title", "exact").distinct(), ["id", "title"])
    return first_by(good.withColumn("_late", ~F.col("exact")), ["id"], ["_late", "title"]).drop("_late")


def country_gate(rows: DataFrame, lang: str, countries: Sequence[str] | None = None) -> DataFrame:
    """Rows whose page or artist country the language accepts (``page_country``, ``country``)."""
    from catlink.operators.wiki.worklists import LANGUAGE_COUNTRIES

    if lang == "en":
        return rows
    accepted = LANGUAGE_COUNTRIES.get(lang, ()) if countries is None else countries
    if not accepted:
        return rows.limit(0)
    ok = F.coalesce(F.col("page_country").isin(*accepted), F.lit(False)) | F.coalesce(F.col("country").isin(*accepted), F.lit(False))
    return rows.filter(ok)


def _proposal(rows: DataFrame, entities: DataFrame, lang: str, rule: MentionRule, with_artist: bool = False) -> DataFrame:
    mention = quoted_first(rule.kind, "first_found", "n_found")
    lead = F.lit("Matched based on the name. The page mentions ")
    artist = F.concat(F.lit('artist "'), F.col("credit_name"), F.lit('" and ')) if with_artist else F.lit("")
    extra = [c for c in ("auto",) if c in rows.columns]
    keep = ["id", "gid"] + (["credit_name"] if with_artist else [])
    joined = rows.join(entities.select(*keep), "id")
    return joined.select("gid", F.concat(F.lit(wiki_base(lang)), quote_title("title")).alias("url"),
                         F.concat(lead, artist, mention, F.lit(".")).alias("note"), *extra)


# Complete matchers -------------------------------------------------------------------------------------


def in_language(pages: DataFrame, lang: str) -> DataFrame:
    """Pages of one encyclopedia; pages without a ``lang`` column are all of that language."""
    return pages.filter(F.col("lang") == lang) if "lang" in pages.columns else pages


def candidate_pages(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pages that some entity is a candidate for, so that no other text is ever brought into comparison form."""
    return pages.join(candidates.select("title").distinct(), "title", "left_semi")


def artist_titles(a: Catalog) -> DataFrame:
    """(id, name): release group and release titles of each artist."""
    acn = a.artist_credit_name.select("artist_credit", F.col("artist").alias("id"))
    rg = a.release_group.select("artist_credit", "name").join(acn, "artist_credit")
    rel = a.release.select("artist_credit", "name").join(acn, "artist_credit")
    return rg.unionByName(rel).select("id", "name").distinct()


def release_group_tracks(a: Catalog) -> DataFrame:
    """(id, name): track titles of each release group."""
    rel = a.release.select(F.col("id").alias("release"), F.col("release_group").alias("id"))
    media = a.medium.select("release", "tracklist").join(rel, "release")
    return a.track.select("tracklist", "name").join(media, "tracklist").select("id", "name").distinct()


def label_artists(a: Catalog) -> DataFrame:
    """(id, name): artists with releases on each label."""
    held = a.release_label.select(F.col("label").alias("id"), "release").distinct()
    credits = a.release.select(F.col("id").alias("release"), "artist_credit").join(held, "release").select("id", "artist_credit").distinct()
    acn = a.artist_credit_name.select("artist_credit", "artist").distinct()
    names = a.artist.select(F.col("id").alias("artist"), "name")
    return credits.join(acn, "artist_credit").select("id", "artist").distinct().join(names, "artist").select("id", "name").distinct()


def match_artists(worklist: DataFrame, pages: DataFrame, titles: DataFrame, lang: str, page_country: DataFrame | None = None) -> DataFrame:
    """(gid, url, note): the page of each artist on the worklist (id, gid, name, country).

    For languages with accepted countries ``page_country`` (title, page_country) is needed as well.
    """
    use = lang if lang in ("ja", "ko") else "artist"
    rule = RULES[use]
    pages = in_language(pages, lang)
    candidates = match_titles(worklist, pages)
    good = usable_pages(candidate_pages(pages, candidates), use)
    rows = mentions(worklist, candidates, good, titles, rule)
    if use == "artist" and lang != "en":
        named = rows.join(worklist.select("id", "country"), "id")
        named = named.join(page_country, "title", "left") if page_country is not None else named.withColumn("page_country", F.lit(None).cast("string"))
        rows = country_gate(named, lang).select(*rows.columns)
    return _proposal(first_accepted(rows, candidates), worklist, lang, rule)


def label_mentions(worklist: DataFrame, pages: DataFrame, artists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mention rows, candidates) of labels: pages about record labels that have the label's name."""
    candidates = match_titles(worklist, pages, skip=())
    good = usable_pages(candidate_pages(pages, candidates), "label")
    return mentions(worklist, candidates, good, artists, RULES["label"]), candidates


def match_labels(worklist: DataFrame, pages: DataFrame, artists: DataFrame, lang: str = "en") -> DataFrame:
    """(gid, url, note): the page of each label on the worklist (id, gid, name)."""
    rows, candidates = label_mentions(worklist, in_language(pages, lang), artists)
    return _proposal(first_accepted(rows, candidates), worklist, lang, RULES["label"])


# A release group link is entered without review above this ratio, except for these types.
AUTO_RATIO = 0.75
NOT_AUTO = ("Compilation", "Soundtrack")


def release_group_mentions(worklist: DataFrame, pages: DataFrame, tracks: DataFrame, lang: str) -> tuple[DataFrame, DataFrame]:
    """(mention rows with ``auto``, candidates) of release groups: album pages with the group's name that also mention its artist."""
    candidates = match_titles(worklist, pages, skip=())
    good = usable_pages(candidate_pages(pages, candidates), "release_group").filter(is_album_page("text", lang))
    good = session.materialise(good.select("title", "page"), "mention-pages")
    credit = candidates.join(worklist.select("id", mangle_name("credit_name").alias("_item")), "id")
    credited = credit.join(items_on_pages(credit, good), ["title", "_item"], "left_semi").select("id", "title").unionByName(credit.filter("_item = ''").select("id", "title"))
    rows = _mentions(worklist, credited, good, tracks, RULES["release_group"])
    auto = (F.col("ratio") > AUTO_RATIO) & ~F.coalesce(F.col("type_name").isin(*NOT_AUTO), F.lit(False))
    return rows.join(worklist.select("id", "type_name"), "id").withColumn("auto", auto).drop("type_name"), candidates


def match_release_groups(worklist: DataFrame, pages: DataFrame, tracks: DataFrame, lang: str) -> DataFrame:
    """(gid, url, note, auto): the album page of each release group (id, gid, name, credit_name, type_name)."""
    rows, candidates = release_group_mentions(worklist, in_language(pages, lang), tracks, lang)
    return _proposal(first_accepted(rows, candidates), worklist, lang, RULES["release_group"], with_artist=True)
