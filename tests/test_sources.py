import json

import pytest
from pyspark.sql import functions as F

from catlink import session
from catlink.operators import catalog as prep, links
from catlink.sources import dictionaries, feeds, tables


def write(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


def test_roles_file(spark, tmp_path):
    rows = ['Producer\tN\tProduction\t\tSays "hi", quoted\t1\t30\tproducer\t\\N\t\\N\t28\t\\N', "Other\t\\N\t\\N\t\\N\tUn-linked\t2\t\\N\t\\N\t\\N\t\\N\t\\N\t\\N"]
    got = dictionaries.read_roles(spark, write(tmp_path / "roles.tsv", "\n".join(rows) + "\n")).orderBy("role_id").collect()
    assert [(r.credit, r.description, r.release_link_type, r.category) for r in got] == [("Producer", 'Says "hi", quoted', 30, "Production"), ("Other", "Un-linked", None, None)]


def test_titles_take_language_from_file_name(spark, tmp_path):
    paths = [write(tmp_path / "fr-titles.txt", "A_b\nC\r\n"), write(tmp_path / "en.txt", "D_e_f\n")]
    got = {tuple(r) for r in dictionaries.read_titles(spark, paths).collect()}
    assert got == {("A_b", "A b", "fr"), ("C", "C", "fr"), ("D_e_f", "D e f", "en")}


def test_script_and_name_files(spark, tmp_path):
    path = write(tmp_path / "scripts.txt", "# head\n\n0041..005A    ; Latin # L\n00AA ; Latin\n3041..3096 ; Hiragana # x\n")
    assert {tuple(r) for r in dictionaries.read_script_ranges(spark, path).collect()} == {("Latin", 0x41, 0x5A), ("Latin", 0xAA, 0xAA), ("Hiragana", 0x3041, 0x3096)}
    names = [write(tmp_path / "m.first", "JAMES 3.3 1\nJOHN 2\n"), write(tmp_path / "f.first", "MARY 2\nJOHN 1\n")]
    assert {r.name for r in dictionaries.read_given_names(spark, names).collect()} == {"james", "john", "mary"}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"x', "")], "i int, s string, t string")
    tables.write_csv(df, str(tmp_path / "out"))
    lines = sorted(x for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines())
    assert lines == ['1,"a,b",', '2,"q""x",""']
    assert {tuple(r) for r in tables.read_csv(spark, str(tmp_path / "out"), "i int, s string, t string").collect()} == {(1, "a,b", None), (2, 'q"x', "")}


def test_albums(spark, tmp_path):
    docs = [{"_id": f"s:{i}", "title": "T", "status": {"imported": i == 2}, "artist_cdbaby_id": f"a{i}",
             "mediums": [{"position": 1, "format": "CD", "tracks": [{"position": 1, "title": "x", "length": 65}]}]} for i in (3, 1, 2)]
    albums = feeds.read_albums(spark, write(tmp_path / "a.json", "\n".join(map(json.dumps, docs))))
    assert [r._id for r in feeds.pending_albums(albums, 1).collect()] == ["s:1"]
    artists = spark.createDataFrame([("cdbaby:a1", "m1")], "_id string, mbid string")
    assert {(r._id, r.artist_mbid, r.type) for r in prep.reuse_artist_ids(albums, artists).collect()} == {("s:1", "m1", "album"), ("s:2", None, "album"), ("s:3", None, "album")}
    assert {r._id for r in prep.new_artists(prep.reuse_artist_ids(albums, artists), artists).collect()} == {"cdbaby:a2", "cdbaby:a3"}
    done = prep.mark_imported(albums, spark.createDataFrame([("s:1", "r1")], "_id string, mbid string"))
    assert {(r._id, r.mbid, r.status.imported) for r in done.collect()} == {("s:1", "r1", True), ("s:2", None, True), ("s:3", None, False)}
    form = {r.key: r.value for r in prep.album_form(albums.filter("_id = 's:1'")).collect()}
    assert form["mediums.0.track.0.length"] == "1:05" and form["edit_note"].endswith("/1") and "barcode" not in form


def test_feed_file(spark, tmp_path):
    items = "".join(
        f"<item><itms:artist>A</itms:artist><itms:artistLink>{al}</itms:artistLink><itms:album>{t}</itms:album><itms:albumLink>{bl}</itms:albumLink><itms:releasedate>{d}</itms:releasedate></item>"
        for al, t, bl, d in [("http://x/id1", "One - EP", "http://x/album/id2", "January 5, 2011"), ("http://x/id3", "Two [feat. B]", "http://x/song/id4", "soon")])
    path = write(tmp_path / "f.xml", f'<rss xmlns:itms="http://phobos.apple.com/rss/1.0/modules/itms/"><channel>{items}</channel></rss>')
    got = {r.album: (r.artist_id, r.album_id, r.album_type, str(r.release_date), r.album_url) for r in feeds.read_feed(spark, path).collect()}
    assert got == {"One": (1, 2, "EP", "2011-01-05", "http://itunes.apple.com/us/album/id2"), "Two (feat. B)": (3, None, None, "None", None)}


def test_rights_pages_need_equal_sizes(spark):
    link = '<a href="' + "x" * feeds.WRITER_LINK_OFFSET + '{}&y">{}</a>'
    good = '<table width="490">' + link.format(1, " A ") + "<td>123456789</td>" + link.format(2, "B") + "<td>12345</td></table>"
    bad = '<table width="490">' + link.format(3, "C") + link.format(4, "D") + "<td>123456789</td></table>"
    got = {tuple(r) for r in feeds.writer_search(spark.createDataFrame([(good,), (bad,), ("no table",)], "html string")).collect()}
    assert got == {("1", "A", "123456789"), ("2", "B", "12345")}


def test_keyed_state(spark):
    state = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "k int, name string, code string")
    new = spark.createDataFrame([(1, "a1", None, 1), (1, "a2", None, 2), (3, "c", "new", 3)], "k int, name string, code string, seq int")
    assert {tuple(r) for r in tables.upsert(state, new, ["k"], ["seq"], keep_old=["code"]).collect()} == {(1, "a2", "old"), (2, "b", "old"), (3, "c", "new")}
    assert {tuple(r) for r in tables.upsert(state, new, ["k"], ["seq"]).collect()} == {(1, "a2", None), (2, "b", "old"), (3, "c", "new")}
    got = tables.insert_ignore(state.select("k"), new.select("k", "seq"), ["k"], ["seq"]).collect()
    assert [tuple(r) for r in got] == [(3, 3)]
    items = spark.createDataFrame([(1, False), (2, None), (3, True), (4, False)], "id int, done boolean")
    marked = tables.mark_done(items, items.filter("id = 4"), "id")
    assert {r.id for r in tables.pending(marked).collect()} == {1}


def test_audit_log(spark):
    log = spark.createDataFrame([(7, "x", "e", None)], "id bigint, updated string, event string, timest timestamp")
    events = spark.createDataFrame([("b", "2"), ("a", "1")], "updated string, event string")
    rows = tables.log_event(log, events)
    assert [(r.id, r.updated) for r in rows.orderBy("id").collect()] == [(8, "a"), (9, "b")]
    assert [r.id for r in tables.latest_events(log.unionByName(rows), 2).collect()] == [9, 8]


def test_declared_schema(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    assert tables.declared(df, "x bigint, y int").schema.simpleString() == "struct<x:bigint,y:int>"
    with pytest.raises(ValueError):
        tables.declared(df, "x int")


def test_name_resolution(spark):
    names = spark.createDataFrame([(10, "Ten")], "id int, name string")
    entity = spark.createDataFrame([(1, 10, "g")], "id int, name int, gid string")
    assert tables.resolve_name(entity, names).collect()[0].asDict() == {"id": 1, "name": "Ten", "gid": "g"}


def test_materialise_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = session.materialise(spark.range(3).withColumn("x", F.lit("a")), "t")
    assert df.count() == 3 and all(f.startswith("file:" + folder) or folder in f for f in df.inputFiles())


def test_replace_table(spark):
    for n in (1, 2):
        assert tables.replace_table(spark.range(n), "replaced").count() == n


def test_read_catalog_and_link_resolution(spark, tmp_path):
    """Tables written and read with their declared schemas, then linked."""
    from catlink import Catalog, Sites, schemas

    def put(side, table, schema, data):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / side / table))

    put("a", "artist", schemas.A_TABLES["artist"], [(5, "g5", "Mø (x)", None, None, None, None, None, None, None, None, None, None)])
    put("a", "url", schemas.A_TABLES["url"], [(1, "http://b/artist/M%C3%B8+(x)"), (2, "http://b/artist/Gone")])
    put("a", "l_artist_url", schemas.A_TABLES["l_artist_url"], [(1, 5, 1, 26038, 0), (2, 5, 2, 26038, 0), (3, 5, 1, 99, 0)])
    put("b", "artist", schemas.B_TABLES["artist"], [(9, "MØ (X)", None, None, None, None, None, None, None), (8, "Mø (x)", None, None, None, None, None, None, None)])
    a = tables.read_catalog(spark, str(tmp_path / "a"), schemas.A_TABLES, ["artist", "url", "l_artist_url"])
    b = tables.read_catalog(spark, str(tmp_path / "b"), schemas.B_TABLES, ["artist"])
    view = links.link_view(a, "artist")
    assert {(r.id, r.url) for r in view.collect()} == {(5, "http://b/artist/M%C3%B8+(x)"), (5, "http://b/artist/Gone")}
    got = links.resolve_links("artist", view, b, Sites(b_base="http://b/"))
    assert [tuple(r) for r in got.collect()] == [("g5", "Mø (x)", "http://b/artist/M%C3%B8+(x)", 8, 0)]
    with pytest.raises(AttributeError):
        Catalog({}).nothing
