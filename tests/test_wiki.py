import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catlink.functions import wikitext
from catlink.operators.wiki import facts, matching, search


def pages(spark, items, lang="en"):
    return spark.createDataFrame(items, "t string, x string").select(*wikitext.page_struct("t", "x", lang))


def brute_search(names, titles, k, least=1):
    """All titles that share a word, by the score of the search module's docstring."""
    words = {t: set(re.findall(r"\w+", t.lower())) for t in titles}
    words = {t: w for t, w in words.items() if w}
    df = Counter(w for ws in words.values() for w in ws)
    weight = {w: round(1000 * math.log(1 + len(words) / n)) for w, n in df.items()}
    out = set()
    for i, name in names:
        q = set(re.findall(r"\w+", name.lower()))
        total = sum(weight.get(w, 20000) for w in q)
        scored = []
        for t, ws in words.items():
            common = sum(weight[w] for w in q & ws)
            if len(q & ws) >= least:
                scored.append((-common / (total + sum(weight[w] for w in ws) - common), t))
        out |= {(i, t, r + 1) for r, (_, t) in enumerate(sorted(scored)[:k])}
    return out


def test_title_search_ranks_by_any_word(spark):
    e = spark.createDataFrame([(1, "The Band"), (2, "the the"), (3, "!!!"), (4, "Unknown Words"), (5, "band the")], "id int, name string")
    titles = ["The Band", "The Band (album)", "Band", "The Other", "The The (band)", "???", "Words"]
    index = search.build_index(spark.createDataFrame([(t,) for t in titles], "title string"), 2)
    got = {}
    for r in search.search_titles(e, index, 2).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.title)
    assert got == {1: ["The Band", "The The (band)"], 2: ["The Band", "The The (band)"], 4: ["Words"], 5: ["The Band", "The The (band)"]}


@pytest.mark.parametrize(("k", "depth", "least"), [(3, 3, 1), (2, 5, 1), (4, 4, 2), (None, 3, 1), (None, 3, 2)])
def test_title_search_equals_scoring_everything(spark, k, depth, least):
    draw = random.Random(5)
    common, rare = ["the", "band", "of", "new"], [f"w{i}" for i in range(25)]
    titles = sorted({" ".join(draw.sample(common, draw.randint(0, 3)) + draw.sample(rare, draw.randint(0, 2))) for _ in range(400)})
    names = [(i, " ".join(draw.sample(common, draw.randint(0, 3)) + draw.sample(rare, draw.randint(0, 2)) + (["zz"] if i % 9 == 0 else []))) for i in range(120)]
    index = search.build_index(spark.createDataFrame([(t,) for t in titles], "title string"), depth)
    rows = search.search_titles(spark.createDataFrame(names, "id int, name string"), index, k, least).collect()
    assert {(r.id, r.title, r.rank) for r in rows} == brute_search([n for n in names if n[1]], titles, k, least)


def test_title_search_reads_no_list_on_for_ties_or_the_lightest_word(spark, monkeypatch):
    stored = {}
    plain = search.session.materialise
    monkeypatch.setattr(search.session, "materialise", lambda df, name: stored.setdefault(name, []).append(plain(df, name)) or stored[name][-1])
    titles = [f"the band {i:03}" for i in range(60)] + [f"the {i:03}" for i in range(60, 120)]
    index = search.build_index(spark.createDataFrame([(t,) for t in titles], "title string"), 3)
    names = [(i, t) for i, t in enumerate(titles)]
    entities = spark.createDataFrame(names, "id int, name string")
    for k, least in ((3, 1), (None, 2)):
        rows = search.search_titles(entities, index, k, least, pairs=50).collect()
        assert {(r.id, r.title, r.rank) for r in rows} == brute_search(names, titles, k, least)
    # equally heavy titles behind a head come later by title, so no list is read on
    assert stored["title-lists"][0].count() == 0
    # "the" is in all 120 names and titles; with two words asked for, only "band" (60 x 60) and the numbers are met
    assert stored["search-load"][-1].groupBy().sum("load").first()[0] == 60 * 60 + 120


def test_title_search_never_broadcasts_its_rankings(spark):
    """Files of rankings and names are far smaller than their rows, so these joins must not be chosen by size."""
    index = search.build_index(spark.range(30).select(F.concat(F.lit("the band "), "id").alias("title")), 3)
    entities = spark.range(30).select("id", F.concat(F.lit("the band "), "id").alias("name"))
    for k, least in ((3, 1), (None, 2)):
        plan = search.search_titles(entities, index, k, least)._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"\w+Join", plan)[:2] == ["SortMergeJoin"] * 2


def test_only_titles_of_candidates_with_pages_are_looked_for(spark, monkeypatch):
    stored = {}
    plain = matching.session.materialise
    monkeypatch.setattr(matching.session, "materialise", lambda df, name: stored.setdefault(name, plain(df, name)))
    people = spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, "Cid")], "id int, name string")
    candidates = spark.createDataFrame([(1, "Ann"), (2, "Bob (x)")], "id int, title string")
    pages = spark.createDataFrame([("Ann", "theredsongandthebluesong"), ("Cid", "theredsong")], "title string, page string")
    titles = spark.createDataFrame([(i, t) for i in (1, 2, 3) for t in ("The Red Song", "The Blue Song", "The Red Song", "Elsewhere")], "id int, name string")
    rows = matching.mentions(people, candidates, pages, titles, matching.RULES["artist"]).collect()
    assert [(r.id, r.title, r.n_titles, r.n_found, r.first_found, r.accepted) for r in rows] == [(1, "Ann", 3, 2, ["The Blue Song", "The Red Song"], True)]
    assert {r.id for r in stored["mention-items"].collect()} == {1}


def test_items_on_pages_in_shares(spark):
    pages = spark.createDataFrame([("p", "abcabd é"), ("p", "xyz"), ("q", ""), ("r", "bc")], "title string, page string")
    wanted = [(t, i) for t in ("p", "q", "r", "none") for i in ("abc", "bc", "abd", "cab", "é", "zz", "", "xy", "a", "abcabd é!")]
    df = spark.createDataFrame(wanted, "title string, _item string")
    for at_once in (1, 3, 100):
        got = {tuple(r) for r in matching.items_on_pages(df, pages, at_once).collect()}
        assert got == {("p", i) for i in ("abc", "bc", "abd", "cab", "é", "xy", "a")} | {("r", "bc")}


def test_only_numbers_leave_the_pages(spark, monkeypatch):
    """Numbered items are found as by ``items_on_pages``, in shares or not, and hits are stored without texts."""
    pages = spark.createDataFrame([("p", "abcabd é"), ("p", "xyz"), ("q", ""), ("r", "bc")], "title string, page string")
    items = ["abc", "bc", "abd", "cab", "é", "zz", "", "xy", "a", "abcabd é!"]
    wanted = [(i, t, n, item) for i in (1, 2) for t in ("p", "q", "r", "none") for n, item in enumerate(items) if n % 2 == 0 or i == 1]
    df = spark.createDataFrame(wanted, "id int, title string, n int, _item string")
    at = {"p": {"abc", "bc", "abd", "cab", "é", "xy", "a"}, "r": {"bc"}}
    for at_once in (1, 3, 100):
        rows = [tuple(r) for r in matching.numbers_on_pages(df, pages, at_once).collect()]
        assert sorted(rows) == sorted((i, t, n) for i, t, n, item in wanted if item in at.get(t, ()))
    stored = {}
    plain = matching.session.materialise
    monkeypatch.setattr(matching.session, "materialise", lambda df, name: stored.setdefault(name, plain(df, name)))
    people, candidates = spark.createDataFrame([(1, "Ann")], "id int, name string"), spark.createDataFrame([(1, "p")], "id int, title string")
    titles = spark.createDataFrame([(1, f"song number {i}") for i in "dbca"], "id int, name string")
    text = spark.createDataFrame([("p", "songnumberd songnumberb songnumberc songnumbera")], "title string, page string")
    rows = matching.mentions(people, candidates, text, titles, matching.RULES["artist"]).collect()
    assert [(r.n_titles, r.n_found, r.first_found) for r in rows] == [(4, 4, ["song number a", "song number b", "song number c"])]
    assert stored["mention-hits"].columns == ["id", "title", "n"]


def test_title_match(spark):
    e = spark.createDataFrame([(1, "Mø"), (2, "Air"), (3, "!!!")], "id int, name string")
    t = spark.createDataFrame([("MO",), ("Air (French band)",), ("Air (album)",), ("Air",), ("???",)], "title string")
    got = {tuple(r) for r in matching.match_titles(e, t).collect()}
    assert got == {(1, "MO", True), (2, "Air (French band)", False), (2, "Air", True)}
    assert (2, "Air (album)", False) in {tuple(r) for r in matching.match_titles(e, t, skip=()).collect()}


def test_page_filters(spark):
    items = [("a", "plain"), ("b", "#REDIRECT [[x]]"), ("c (disambiguation)", "x"), ("d", "{{Disambig}}"), ("e", "disambiguation pages"), ("f", "Homonymie"), ("g", "Infobox album"), ("h", ""), ("i", "record labels")]
    df = spark.createDataFrame(items, "title string, text string")
    assert {r.title for r in matching.usable_pages(df, "artist").collect()} == {"a", "i"}
    assert {r.title for r in matching.usable_pages(df, "release_group").collect()} == {"a", "g", "i"}
    assert {r.title for r in matching.usable_pages(df, "label").collect()} == {"i"}


def test_mention_thresholds(spark):
    people = spark.createDataFrame([(1, "Ann"), (2, "A very long name indeed"), (3, "Solo")], "id int, name string")
    cand = spark.createDataFrame([(1, "Ann"), (2, "Long"), (3, "Solo")], "id int, title string")
    page = spark.createDataFrame([("Ann", "xxabcdefgyyabcdef"), ("Long", "abcdefg"), ("Solo", "text")], "title string, page string")
    titles = [(1, "Abcdefg"), (1, "abcdef"), (1, "Ann and me"), (1, "zzzzzzzz"), (3, "Best of Solo")] + [(2, "ABCDEFG")] + [(2, f"other {i}{i}{i}{i}") for i in range(5)]
    t = spark.createDataFrame(titles, "id int, name string")
    got = {r.id: (r.n_titles, r.n_found, r.accepted) for r in matching.mentions(people, cand, page, t, matching.RULES["artist"]).collect()}
    # "abcdef" is too short to count as found; "Ann and me" names the artist; 1/6 suffices for a long name
    assert got == {1: (3, 1, True), 2: (6, 1, True)}
    ja = {r.id: r.accepted for r in matching.mentions(people, cand, page, t, matching.RULES["ja"]).collect()}
    assert ja == {1: True, 2: False}


def test_release_group_match(spark):
    work = spark.createDataFrame([(1, "g1", "Great Album", "Ann", "Album"), (2, "g2", "Great Album", "Nobody", "Soundtrack")], "id int, gid string, name string, credit_name string, type_name string")
    names = ["Opening", "Second", "Third one", "Fourth", "Closing"]
    text = "By Ann. " + ", ".join(names[:4]) + " [[Category:2000 albums]]"
    page = spark.createDataFrame([("Great Album (album)", text)], "title string, text string")
    tracks = spark.createDataFrame([(i, n) for i in (1, 2) for n in names + ["abc", "Great Album reprise"]], "id int, name string")
    got = matching.match_release_groups(work, page, tracks, "en").collect()
    assert [(r.gid, r.url, r.auto) for r in got] == [("g1", "http://en.wikipedia.org/wiki/Great_Album_%28album%29", True)]
    assert got[0].note == 'Matched based on the name. The page mentions artist "Ann" and tracks "Fourth", "Opening", "Second" and 1 more.'


def test_label_match(spark):
    work = spark.createDataFrame([(1, "g1", "Cool Records")], "id int, gid string, name string")
    page = spark.createDataFrame([("Cool Records", "Artists: Somebody, Another One. [[Category:Record labels]]")], "title string, text string")
    people = spark.createDataFrame([(1, "Somebody"), (1, "Another One"), (1, "Cool Records"), (1, "Short")], "id int, name string")
    assert [r.note for r in matching.match_labels(work, page, people).collect()] == ['Matched based on the name. The page mentions artists "Another One" and "Somebody".']


def test_language_and_repeated_titles(spark):
    """Only pages of the language are compared, and two pages of one title count an item once."""
    work = spark.createDataFrame([(1, "g1", "Cool Records"), (2, "g2", "Odd Records")], "id int, gid string, name string")
    text = "Artists: Somebody, Another One. [[Category:Record labels]]"
    page = spark.createDataFrame(
        [("Cool Records", text, "en"), ("Cool Records", text, "fr"), ("Cool Records", text, "en"), ("Odd Records", text, "fr")], "title string, text string, lang string")
    people = spark.createDataFrame([(i, n) for i in (1, 2) for n in ("Somebody", "Another One")], "id int, name string")
    got = matching.match_labels(work, page, people).collect()
    assert [(r.gid, r.note) for r in got] == [("g1", 'Matched based on the name. The page mentions artists "Another One" and "Somebody".')]
    cand = spark.createDataFrame([(1, "Cool Records")], "id int, title string")
    rows = matching.mentions(work, cand, matching.usable_pages(page, "label"), people, matching.RULES["label"]).collect()
    assert [(r.n_found, r.ratio, r.first_found) for r in rows] == [(2, 1.0, ["Another One", "Somebody"])]


def test_country_needs_agreement(spark):
    box = "{{Infobox musical artist\n| origin = [[Lyon]], [[France|FR]]\n}}"
    items = [
        ("agree", box + " From [[france]].\n\nx [[Category:French singers]]"), ("conflict", box + "[[Category:American singers]]"), ("no category", box),
        ("state", "He is from [[Austin, Texas]].\n\n[[Category:Singers from Texas]]"), ("template", "{{France}} [[Category:French people]]"),
    ]
    places = facts.place_dictionary(spark.createDataFrame([("France", "FR"), ("Germany", "DE")], "name string, code string"))
    got = {r.title: (r.country, r.reasons) for r in facts.country(pages(spark, items), places, "en").collect()}
    assert set(got) == {"agree", "state", "template"}
    assert got["agree"] == ("FR", ['Infobox links to "France".', 'The first paragraph links to "france".', 'Belongs to category "French singers".'])
    assert got["state"] == ("US", ['The first paragraph links to "Austin, Texas".', 'Belongs to category "Singers from Texas".'])


def test_gender(spark):
    items = [
        ("Jean-Paul_X", "texte"), ("Marie Y", "il il il"), ("Zoé Z", "Elle elle ELLE"), ("Solo", "il"), ("A B", "[[Catégorie:Chanteuse française]]"), ("C D", "il il il elle"),
    ]
    names = spark.createDataFrame([("Jean", "male"), ("Marie", "female")], "name string, gender string")
    got = {r.title: r.gender for r in facts.gender(pages(spark, items, "fr"), "fr", names).collect()}
    assert got == {"Jean-Paul_X": "male", "Zoé Z": "female", "A B": "female"}
    en = pages(spark, [("x", "He said his he she"), ("y", "She, her. SHE the"), ("z", "[[Category:Male singers]][[Category:Female singers]]")])
    assert {r.title: r.gender for r in facts.gender(en, "en").collect()} == {"y": "female"}


def test_type_and_dates(spark):
    items = [
        ("p", "{{Infobox person\n| background = solo_singer\n| birth_date = {{Birth date|1950|May|7}}\n}}"), ("g", "[[Category:Musical groups established in 1970]][[Category:Musical groups disestablished in 1980]]"),
        ("x", "{{Infobox person\n| background = solo_singer\n}}[[Category:Rock groups]]"), ("d", "{{Persondata\n| NAME = N\n| DATE OF BIRTH = 5 March 1951\n| DATE OF DEATH = 1999\n}}"),
        ("c", "[[Category:1960 births]][[Category:2001 deaths]]"), ("n", "{{Persondata\n|NAME=N\n|DATE OF BIRTH = unknown\n}}[[Category:In 1960 births]]"),
    ]
    p = pages(spark, items)
    assert {r.title: r.type for r in facts.artist_type(p, "en").collect()} == {"p": "person", "g": "group", "d": "person", "n": "person"}
    got = {r.title: r for r in facts.dates(p, "en").collect()}
    assert got["p"].person_begin[:3] == (1950, 5, 7) and got["d"].person_begin[:3] == (1951, 3, 5) and got["d"].person_end[:3] == (1999, None, None)
    assert got["c"].person_begin[:3] == (1960, None, None) and got["c"].person_end.year == 2001
    assert (got["g"].group_begin.year, got["g"].group_end.year) == (1970, 1980) and got["n"].person_begin is None
    fr = pages(spark, [("f", "{{Infobox Musique (artiste)\n| naissance = {{Date de naissance|7|août|1950}}\n}}")], "fr")
    assert facts.dates(fr, "fr").first().person_begin[:3] == (1950, 8, 7)


def test_fill_notes(spark):
    a = spark.createDataFrame([(1, "g", "http://w/p", "p", None, None, None), (2, "h", "http://w/g", "g", 3, 2, None)], "id int, gid string, url string, title string, country int, type int, gender int")
    for w in ("begin", "end"):
        for part in ("year", "month", "day"):
            a = a.withColumn(f"{w}_date_{part}", F.lit(None).cast("int"))
    p = pages(spark, [("p", "{{Infobox person\n| background = solo_singer\n| birth_date = {{dob|1950|5|7}}\n}} he his he [[Category:French singers]]"), ("g", "x")])
    places = facts.place_dictionary(spark.createDataFrame([("France", "FR")], "name string, code string"))
    ids = spark.createDataFrame([("fr", 73)], "key string, value int")
    genders = spark.createDataFrame([("male", 1)], "key string, value int")
    got = facts.fill_artist_data(a, facts.country(p, places, "en"), facts.gender(p, "en"), facts.artist_type(p, "en"), facts.dates(p, "en"), ids, genders).collect()
    assert [(r.id, r.country, r.type, r.gender, r.begin_date_year, r.updated) for r in got] == [(1, 73, 1, 1, 1950, ["country", "type", "gender", "begin_date"])]
    assert got[0].note.startswith('From http://w/p\n\nCOUNTRY:\nBelongs to category "French singers".\n\nTYPE:\nInfobox has "background = solo_singer".')


def test_batches_of_pages_are_bounded_in_bytes(spark):
    from pyspark.sql import functions as F

    from catlink import session

    was = spark.conf.get(session.BATCH)
    spark.conf.set(session.BATCH, "256m")
    try:
        session.bound_batches(spark)
        assert spark.conf.get(session.BATCH) == str(session.BATCH_BYTES)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

        pages = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
        assert max(r.n for r in pages.mapInArrow(sizes, "n long").collect()) < 2 * session.BATCH_BYTES
        spark.conf.set(session.BATCH, "1m")
        session.bound_batches(spark)
        assert spark.conf.get(session.BATCH) == "1m"
    finally:
        spark.conf.set(session.BATCH, was)
