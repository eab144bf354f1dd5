"""Literal-row cases for rules that generated data rarely meets: NULLs, ties, ambiguity, thresholds, hot keys."""

import pytest
from pyspark.sql import functions as F

from catlink.config import Catalog, Sites
from catlink.operators import catalog as prep, evidence as ev, links, proposals as pr, state
from catlink.operators.keys import first_by, note_list, numbered, only_single, repeated
from catlink.reports import structure

S = Sites("A", "B", "http://a/", "http://b/")


def rows(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def test_uniqueness(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", None), ("d", 3), ("d", None)], "k string, v int")
    assert rows(only_single(df, ["k"])) == {("a", 1), ("c", None)}
    assert rows(only_single(df, ["k"], count="v")) == {("a", 1), ("d", 3), ("d", None)}
    assert rows(repeated(df, ["k"])) == {("b",), ("d",)}
    assert rows(repeated(df, ["k"], "v")) == {("b",)}
    assert rows(first_by(df, ["k"], ["v"])) == {("a", 1), ("b", 1), ("c", None), ("d", None)}


def test_note_list_keeps_the_first_three(spark):
    df = spark.createDataFrame([("a", f"n{i}") for i in range(9)] + [("b", "x")], "k string, note string")
    assert {r.k: r.notes for r in note_list(df, ["k"], "note").collect()} == {"a": ["n0", "n1", "n2"], "b": ["x"]}


def test_numbering_of_one_large_group(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), (F.col("id") * 7919 % 20011).alias("o"))
    got = numbered(df, ["g"], ["o"], F.floor(F.col("o") / 256)).select("g", "o", "row_number")
    from pyspark.sql import Window as W

    want = df.withColumn("row_number", F.row_number().over(W.partitionBy("g").orderBy("o")))
    assert got.exceptAll(want).count() == 0 and got.count() == 20000


def test_release_status(spark):
    data = [(1, ["Album"]), (2, ["Promo", "Unofficial Release"]), (3, ["Partially Unofficial"]), (4, None), (5, []), (6, [None, "Album"]), (7, ["White Label"]), (7, ["Album"])]
    df = spark.createDataFrame(data, "release_id int, descriptions array<string>")
    assert rows(prep.release_status(df)) == {(1, 1), (2, 2), (3, 3), (5, 1), (7, 2), (7, 1)}


def test_clean_identifiers_order(spark):
    data = [("Barcode", "LC 1234", "x"), ("Other", "LC01", "runout"), ("Other", "z", "Rights Society: X"), ("Other", "z", "side A RUNOUT"), ("Other", "z", None), ("Barcode", None, None), ("Barcode", "4-0 1", "d")]
    got = rows(prep.clean_identifiers(spark.createDataFrame(data, "type string, value string, description string")), "type", "value", "description")
    assert got == {("Label Code", "LC 1234", None), ("Label Code", "LC01", None), ("Rights Society", "z", None), ("Matrix / Runout", "z", "side A RUNOUT"), ("Other", "z", None), ("Barcode", None, None), ("Barcode", "401", "d")}


def test_artist_repairs(spark):
    artists = spark.createDataFrame([(3, "a"), (1, "a"), (2, "a"), (5, "b")], "id bigint, name string")
    kept = prep.dedupe_artists(artists)
    assert rows(kept) == {(1, "a"), (5, "b")}
    refs = spark.createDataFrame([(3,), (5,), (None,)], "artist_id bigint")
    assert rows(prep.repair_artist_ids(refs, kept)) == {(0,), (5,), (None,)}
    assert (0, "Missing") in rows(prep.add_missing_artist(kept))


def test_country_by_prefix(spark):
    countries = spark.createDataFrame([(1, "US", "United States"), (2, "GB", "United Kingdom"), (3, "XX", "%odd"), (4, "YY", "q_")], "id int, iso_code string, name string")
    search = spark.createDataFrame([("US", ["american%", "us %"]), ("GB", ["uk %"])], "iso_code string, search array<string>")
    patterns = pr.country_patterns(countries, search)
    texts = spark.createDataFrame([("American band",), ("UK band",), ("United Kingdom",), ("very odd",), ("us",), ("qx",), ("",), (None,)], "t string")
    got = rows(pr.country_by_prefix(texts, "t", patterns), "t", "country_id")
    want = rows(texts.join(patterns, F.expr("lower(t) LIKE pattern")).select("t", "country_id").distinct())
    assert got == want and ("very odd", 3) in got and ("qx", 4) in got


def test_link_phrases(spark):
    a = Catalog({
        "link": spark.createDataFrame([(1, 30), (2, 30), (3, 31)], "id int, link_type int"),
        "link_type": spark.createDataFrame([(30, "{additional} {co:co-}produced {additional}"), (31, "mixed  it ")], "id int, link_phrase string"),
        "link_attribute_type": spark.createDataFrame([(1, 1, "additional"), (2, 2, "co"), (3, 1, "a$b\\c")], "id int, root int, name string"),
        "link_type_attribute_type": spark.createDataFrame([(30, 1), (30, 2)], "link_type int, attribute_type int"),
        "link_attribute": spark.createDataFrame([(1, 1), (1, 3)], "link int, attribute_type int"),
    })
    assert rows(links.link_phrases(a), "link", "phrase") == {(1, "a$b\\c, additional produced {additional}"), (2, "produced {additional}"), (3, "mixed it")}


def test_sync_is_null_safe(spark):
    schema = "gid string, name string, url string, id bigint, edits_pending int"
    old = spark.createDataFrame([("g1", None, "u1", 1, 0), ("g2", "n", "u2", 2, 0)], schema)
    new = spark.createDataFrame([("g2", "n", "u2", 2, 0), ("g3", "n", "u3", 3, 0), ("g4", "n", "u4", 4, 0)], schema)
    known = spark.createDataFrame([(2,), (3,)], "id bigint")
    added, removed = links.sync_changes(old, new, known)
    assert rows(added, "gid") == {("g3",)} and rows(removed, "gid") == {("g1",)}
    assert rows(links.apply_changes(old, added, removed), "gid") == {("g2",), ("g3",)}
    assert links.sync_event("t", added, removed).collect()[0].event == "removed: 1, added: 1"
    assert links.sync_event("t", added.limit(0), removed.limit(0)).collect()[0].event == "removed: 0, added: 0"


def matching_catalog(spark, releases):
    """Catalog B with one label and the given (release_id, catno, format_id, title) rows, equal in all other respects."""
    return Catalog({
        "label": spark.createDataFrame([(1, "L")], "id bigint, name string"),
        "label_link": spark.createDataFrame([("lg", "L", "u", 1, 0)], "gid string, name string, url string, id bigint, edits_pending int"),
        "releases_labels": spark.createDataFrame([(r, "L", c) for r, c, _, _ in releases], "release_id bigint, label string, catno string"),
        "release_mapping": spark.createDataFrame([(r, t, 2000, "x", f, 10, 1, 5, "C") for r, _, f, t in releases],
                                                 "release_id bigint, title string, year int, format_name string, format_id int, track_count bigint, status int, country_id int, country string"),
        "release_identifier": spark.createDataFrame([(1, "Barcode", "123456789012", None)], "release_id bigint, type string, value string, description string"),
    })


def candidates(spark, items):
    return spark.createDataFrame([("L", "lg", c, g, n, 10, f, 5, 2000, 1, bc) for g, c, f, n, bc in items],
                                 "label_name string, label_gid string, catalog_number string, gid string, name string, track_count bigint, format int, country int, year int, status int, barcode string")


def test_release_links(spark):
    b = matching_catalog(spark, [(1, "AB 1", 7, "One"), (2, "ab2", 29, "Two"), (3, "AB2", 30, "Two"), (4, "X9", 1, "Nine"), (5, None, 1, "None")])
    c = candidates(spark, [("g1", "ab1", 31, "ONE", "123456789012"), ("g2", "AB 2", 7, "Two", None), ("g3", "x9", 1, "Other", "999"), ("g4", "x9", 7, "Nine", None), ("g5", "x9", 1, "nine", None)])
    got = {r.gid: (r.url, r.score) for r in pr.release_links(c, b, S).collect()}
    # g2 meets two releases of the family and is ambiguous, g4 has another format
    assert got == {"g1": ("http://b/release/1", 9), "g3": ("http://b/release/4", 1), "g5": ("http://b/release/4", 7)}


def test_hot_catalog_number_stays_linear(spark):
    """Thousands of releases and candidates under one key are ambiguous; they are counted, not paired."""
    hot = [(i, "none", 1, "T") for i in range(10, 3010)]
    b = matching_catalog(spark, hot + [(1, "ONE", 1, "T")])
    c = candidates(spark, [(f"h{i}", "none", 1, "T", None) for i in range(3000)] + [("g", "one", 1, "T", None)])
    assert rows(pr.release_links(c, b, S), "gid") == {("g",)}


def test_artist_types(spark):
    data = [("g1", None, "a singer"), ("g2", 1, "a singer"), ("g3", None, "singer feat. x"), ("g4", None, "singers"), ("g5", None, "DJ from x"), ("g6", None, None), ("g7", None, "rock band")]
    df = spark.createDataFrame(data, "gid string, type int, comment string")
    assert rows(pr.artist_types(df, 1), "gid") == {("g1",), ("g5",)} and rows(pr.artist_types(df, 2), "gid") == {("g7",)}


def test_summary_text(spark):
    df = spark.createDataFrame([("g", "u", f"n{i}") for i in range(5)] + [("h", "u", "x"), ("h", "u", None), ("i", "u", "a"), ("i", "u", "a")], "gid string, url string, note string")
    got = {r.gid: (r.note, r.score) for r in ev.summarise(df, "things").collect()}
    assert got == {"g": ("n0\nn1\nn2\nand 2 more things", 5), "h": ("x", 1), "i": ("a\na", 2)}


def test_drain(spark):
    q = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("c", 0)], "gid string, s int")
    batch, rest = state.drain(q, 2, [F.desc("s"), "gid"], ["gid"])
    assert rows(batch) == {("a", 3), ("b", 2)} and rows(rest) == {("c", 0)}


@pytest.mark.parametrize("current,old,new,want", [
    ("x", "x", "y", state.SET), ("y", "x", "y", state.CHANGED), ("z", "x", "y", state.CHANGED), ("x", "x", "x", state.ALREADY_SET), (None, "", "y", state.SET)])
def test_guard(spark, current, old, new, want):
    df = spark.createDataFrame([(current, old, new)], "c string, o string, n string")
    assert df.select(state.guard(F.col("c"), F.col("o"), F.col("n"))).first()[0] == want
    expected_first = state.ALREADY_SET if (current == new and new != old) else (state.SET if current in (old, None) else state.CHANGED)
    assert df.select(state.guard(F.col("c"), F.col("o"), F.col("n"), new_first=True)).first()[0] == expected_first


def test_edit_guard_aborts_whole_edit(spark):
    p = spark.createDataFrame([("g", "f", "a", "b"), ("g", "h", "x", "y"), ("k", "f", "a", "b"), ("m", "f", "a", "a")], "gid string, field string, old string, new string")
    now = spark.createDataFrame([("g", "f", "a"), ("g", "h", "changed"), ("k", "f", "a"), ("m", "f", "a")], "gid string, field string, value string")
    assert rows(state.edit_guard(p, now, ["gid"])) == {("g", state.CHANGED), ("k", state.SET), ("m", state.ALREADY_SET)}


def test_ledger(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "gid string")
    ledger = spark.createDataFrame([("a", "en"), ("b", "fr")], "gid string, lang string")
    assert rows(state.not_processed(items, ledger, "en")) == {("b",), ("c",)} and rows(state.not_processed(items, ledger)) == {("c",)}
    assert rows(state.record_processed(items, "en"), "gid", "lang") == {("a", "en"), ("b", "en"), ("c", "en")}


def test_track_ranges(spark):
    tracks = spark.createDataFrame([(1, i + 1, p) for i, p in enumerate(["A1", "A2", "A3", "B1", "B-2", "B3"])], "release_id int, row_number int, position string")
    texts = ["A1 to A3, B3", "", None, "A2", "B1-B3", "B-2", "A3 to A1", "Z9, A1 TO A2"]
    credits = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "release_id int, n int, tracks string")
    got = {}
    for r in structure.expand_tracks(credits, tracks).orderBy("n", "position").collect():
        got.setdefault(r.n, []).append(r.position)
    assert got == {0: ["A1", "A2", "A3", "B3"], 1: [""], 2: [""], 3: ["A2"], 4: ["B-2", "B1", "B3"], 5: ["B-2"], 7: ["A1", "A2"]}


def test_dead_links(spark):
    c = spark.createDataFrame([(1, "g", "u1"), (2, "h", "u2")], "id int, gid string, url string")
    crawl = spark.createDataFrame([("u1", 404), ("u2", 200), ("u1", 404)], "url string, status int")
    assert rows(pr.dead_links(c, crawl)) == {(1, "g", "u1")}


def test_release_format_prefers_description(spark):
    f = spark.createDataFrame([(1, "Vinyl", ['7"', "Album"]), (2, "Vinyl", ["LP"]), (3, "Book", ["x"]), (4, "CD", None)], "release_id int, format_name string, descriptions array<string>")
    m = spark.createDataFrame([("Vinyl", None, 7, "Vinyl"), ("Vinyl", '7"', 29, '7" Vinyl'), ("CD", None, 1, "CD")], "format_name string, description string, format_id int, a_name string")
    assert rows(prep.release_format(f, m), "release_id", "format_id") == {(1, 29), (2, 7), (4, 1)}


def test_shared_titles_count_releases_and_drop_claimed_credits(spark):
    """Two spellings of one title are not two releases, a credit with a linked member counts for nobody, and repeated rows count once."""
    def t(data, schema):
        return spark.createDataFrame(data, schema)

    a = Catalog({
        "artist": t([(2, "two", "Two"), (3, "three", "Three"), (4, "four", "Four"), (5, "five", "Five"), (1, "va", "Various")], "id bigint, gid string, name string"),
        "artist_credit_name": t([(20, 2), (30, 3), (40, 4), (41, 4), (41, 5), (10, 1), (30, 1)], "artist_credit bigint, artist bigint"),
        "artist_link": t([(5, "five")], "id bigint, gid string"),
        "release": t([(1, "One", 20), (2, "X", 30), (3, "x", 30), (4, "Y", 30), (5, "P", 40), (6, "Q", 41), (7, "One", 10), (8, None, 40), (9, "Z", None)], "id bigint, name string, artist_credit bigint"),
    })
    b = Catalog({
        "releases_artists": t([(1, "TWO"), (2, "Two"), (3, "THREE (2)"), (4, "THREE (2)"), (5, "Three (2)"), (6, "THREE (2)"), (7, "Four"), (8, "Four"), (9, None)], "release_id bigint, artist_name string"),
        "release": t([(1, "ONE"), (2, "one"), (3, "X"), (4, "y"), (5, "x"), (6, "X"), (7, "P"), (8, "Q"), (9, "P")], "id bigint, title string"),
    })
    got = rows(ev.by_shared_titles(a, b, S), "gid", "url", "note", "score")
    assert got == {("three", "THREE+(2)", "Both profiles have following releases: X, y", 8)}


def test_summary_ignores_null_notes(spark):
    df = spark.createDataFrame([("g", "u", n) for n in ("b", None, "a", "c", "d", None)] + [("g", "v", None)], "gid string, url string, note string")
    assert rows(ev.summarise(df, "left")) == {("g", "u", "a\nb\nc\nand 1 more left", 4), ("g", "v", None, 0)}
