"""Registered queries against their SQL on small data, and the driver contract."""

import sys
from pathlib import Path

import pytest
from conftest import DATA

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module  # noqa: E402
from catlink.plans import check, queries  # noqa: E402

# A cross-section; ``python -m catlink.plans.check FOLDER`` compares all of them.
CHECKED = [
    "release_link_proposals", "artist_evidence_all", "link_cleanup", "label_evidence", "artist_sync_added", "release_sync_event", "member_of_band", "performs_as",
    "release_group_link_proposals", "format_proposals", "barcode_proposals", "remix_proposals", "common_masters", "artist_country_from_comment", "track_alignment",
    "release_checks", "release_artists_report", "track_credits", "missing_images", "coverage_report", "title_search", "best_candidate", "page_country", "filled_artist_data",
    "label_page_proposals", "release_group_page_proposals", "structure_lines", "structure_text", "similarity_ratio", "similar_masters", "country_gate", "title_search_two_words",
    "french_page_parts", "page_country_french", "page_gender_french", "page_dates_french", "album_form", "imported_albums", "stored_new_albums", "roles_from_file",
]


@pytest.fixture(scope="module")
def engine():
    return check.connect(DATA)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, engine, name):
    line = check.compare(spark, engine, DATA, name, queries.ALL[name])
    assert ": ok" in line and "EMPTY" not in line, line


def test_contract(spark):
    built, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(built) and len(built) > 150
    core = set(queries.ALL)
    assert core <= set(built) and {n for n in core if n not in sql} == {"structure_report"}
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns == ["gid", "url", "note", "score"]


def test_similarity_query_against_brute_force(spark):
    from test_text import py_ratio

    got = {r.k: r.ratio for r in queries.ALL["similarity_ratio"].build(queries.Ctx.of(spark, DATA)).collect()}
    for r in spark.read.parquet(f"{DATA}/part.parquet").collect():
        assert got[r.p_partkey] == pytest.approx(py_ratio(r.p_name, f"{r.p_type} {r.p_brand}".lower()), abs=1e-8)


def test_structure_report_text(spark):
    from catlink.operators.links import link_phrases
    from catlink.reports.structure import structure_report

    c = queries.Ctx.of(spark, DATA)
    rows = structure_report(c.a, c.b, c.sites, link_phrases(c.a)).cache()
    one = rows.filter("release_gid IS NOT NULL AND note IS NOT NULL").orderBy("release_id").first()
    note = one.note
    parts = ["Release: \r\n", "Labels: \r\n", "Artists: \r\n", "Release information", "Tracks / Recordings and works:\r\n"]
    places = [note.index(p) for p in parts]
    assert places == sorted(places)
    assert f"http://a.example/release/{one.release_gid}" in note and " - B track\r\n" in note and "http://a.example/recording/t-" in note
    assert rows.select("release_id").distinct().count() == c.b.release.count()


def test_structure_report_moves_each_piece_once(spark):
    """Shared pieces are stored, tracks are numbered without joins, and no finished text is shuffled or joined again."""
    from catlink.operators.links import link_phrases
    from catlink.reports import structure

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    c = queries.Ctx.of(spark, DATA)
    assert "Join" not in plan(structure.b_tracks(c.b))
    text = plan(structure.structure_report(c.a, c.b, c.sites, link_phrases(c.a)))
    assert "Join" not in text[:text.index("MapInArrow")] and "Exchange" not in text[:text.index("MapInArrow")]


def test_structure_report_stores_lines_that_take_joins(spark, monkeypatch):
    """Each kind of line with joins is stored apart, so the report's own query shuffles finished lines and little else."""
    from catlink.operators.links import link_phrases
    from catlink.reports import structure

    c, stored = queries.Ctx.of(spark, DATA), []
    keep = structure.session.materialise
    monkeypatch.setattr(structure.session, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    structure.structure_report(c.a, c.b, c.sites, link_phrases(c.a))
    assert stored.count("report-lines") == 8


def test_stored_tables_leave_no_shuffles(spark):
    import time

    from catlink import session

    blocks = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString("\n").count("_data")
    assert spark.conf.get(session.CLEAN, None) is None
    before = blocks()
    df = session.materialise(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().repartition(3), "counts")
    for _ in range(20):
        if blocks() <= before:
            break
        time.sleep(0.5)
    assert blocks() <= before and df.count() == 7 and spark.conf.get(session.CLEAN, None) is None


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_track_evidence_starts_from_linked_releases(spark):
    """Recordings meet the places on linked releases before the artists of their credits, and tracks of catalog B the linked releases before theirs."""
    from catlink.operators.evidence import track_evidence

    c = queries.Ctx.of(spark, DATA)
    plan = optimized(track_evidence(c.a, c.b, c.sites))
    assert plan.index("Join Inner, (artist_credit#") < plan.index("Join Inner, (recording#")
    assert plan.index("Join Inner, (track_id#") < plan.rindex("Join LeftSemi, (release_id#")


def test_track_alignment_has_no_null_key(spark):
    """Tracks of unlinked releases have no partner: they must not meet the other side under a key that is null for all of them."""
    from catlink.reports.structure import track_alignment

    c = queries.Ctx.of(spark, DATA)
    plan = optimized(track_alignment(c.a, c.b, c.sites))
    outer = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "release_id#" in outer[0] and "release_gid#" in outer[0]
    assert plan.count("release_gid#") and all("(recording#" not in line or line.index("Join") > outer[0].index("Join") for line in outer)


def test_track_lists_are_looked_up_once(spark):
    """Parts and ends of ranges share one look-up: three joins expand the texts (look-up, numbers between ends, credits)."""
    from catlink.reports.structure import expand_tracks

    credits = spark.createDataFrame([(1, "x", "A1 to A3, B1")], "release_id bigint, n string, tracks string")
    tracks = spark.createDataFrame([(1, i + 1, p) for i, p in enumerate(["A1", "A2", "A3", "B1", "B2"])], "release_id bigint, row_number bigint, position string")
    rows = expand_tracks(credits, tracks)
    assert sorted(r.position for r in rows.collect()) == ["A1", "A2", "A3", "B1"]
    assert optimized(rows).count("Join ") == 3


def test_release_checks_spread_releases_without_master(spark):
    """Releases meet masters and labels under a key that is not null, and the four checks are put together without joins."""
    from catlink.reports import structure

    c = queries.Ctx.of(spark, DATA)
    outer = [line for line in optimized(structure.master_check(c.b, c.sites)).splitlines() if "Join LeftOuter" in line]
    assert "_key#" in outer[0]
    top = optimized(structure.release_checks(c.b, c.sites).drop("note"))
    assert top.index("Union") < top.index("Join ")


def test_link_cleanup_stores_what_it_reads_again(spark, monkeypatch):
    """Matches and texts of catalog B are computed once."""
    from catlink.operators import proposals

    c, stored = queries.Ctx.of(spark, DATA), []
    keep = proposals.materialise
    monkeypatch.setattr(proposals, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    proposals.release_cleanup(c.a, c.b, c.sites)
    assert stored == ["cleanup-matches", "cleanup", "cleanup-texts"]


def test_remix_proposals_read_recordings_of_credited_releases(spark, monkeypatch):
    """Credits are stored, and releases without one give up no recordings."""
    from catlink.operators import proposals

    c, stored = queries.Ctx.of(spark, DATA), []
    keep = proposals.materialise
    monkeypatch.setattr(proposals, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    plan = optimized(proposals.remix_proposals(c.a, c.b, c.sites))
    assert stored == ["remix-credits"] and any("Join LeftSemi" in line and "release_gid#" in line for line in plan.splitlines())


def test_release_artists_deal_mentions_once(spark):
    """Mentions meet tracks, links and roles once each, and their texts the releases: four joins."""
    from catlink.reports.artists import release_artists

    c = queries.Ctx.of(spark, DATA)
    assert optimized(release_artists(c.b, c.view("roles"), c.sites)).count("Join ") == 4


def test_release_artists_with_several_names_and_links(spark):
    """Credits stand under every name of an artist, once per link; artists without an id have no block."""
    from catlink.config import Catalog
    from catlink.reports.artists import release_artists

    people = "artist_id bigint, artist_name string, anv string"
    b = Catalog({
        "release": spark.createDataFrame([(1,), (2,)], "id bigint"),
        "track": spark.createDataFrame([(10, 1, "A1")], "id bigint, release_id bigint, position string"),
        "tracks_artists": spark.createDataFrame([(10, 5, "Y", "")] * 2, "track_id bigint, " + people),
        "tracks_extraartists": spark.createDataFrame([(10, None, "Z", "", "Mix", None)], "track_id bigint, " + people + ", role_name string, role_details string"),
        "releases_artists": spark.createDataFrame([(1, 5, "X", None), (1, 6, "U", "")], "release_id bigint, " + people),
        "releases_extraartists": spark.createDataFrame([], "release_id bigint, " + people + ", role_name string, role_details string, tracks string"),
        "artist_link": spark.createDataFrame([(5, "a-1", "n1"), (5, "a-2", "n2")], "id bigint, gid string, name string"),
    })
    roles = spark.createDataFrame([("Mix", "mixer", None)], "credit string, release_link_type_name string, link_attribute_name string")
    notes = {r.release_id: r.note for r in release_artists(b, roles, queries.Ctx.of(spark, DATA).sites).collect()}
    credits = "\tRelease - X\n\tTrack - Y (tracks: A1)"
    lines = "\tn1 http://a.example/artist/a-1\n\tn2 http://a.example/artist/a-2\n"
    blocks = "\n".join(f"{n} http://b.example/artist/{n}\n{lines}{credits}\n{credits}" for n in "XY")
    assert notes[1] == f"Linked artists:\n\n\nMulti-linked artists:\n{blocks}\n\nUnlinked artists:\nU http://b.example/artist/U\n\tRelease - U"
    assert notes[2] == "Linked artists:\n\n\nMulti-linked artists:\n\n\nUnlinked artists:\n"


def test_evidence_shares_linked_releases(spark):
    """Linked releases and linked credits are stored once, and equal rows of all branches are dropped where they are put together."""
    from catlink.operators import evidence as ev

    c = queries.Ctx.of(spark, DATA)
    for df in (ev.track_evidence(c.a, c.b, c.sites), ev.by_linked_release(c.a, c.b, c.sites)):
        files = " ".join(df.inputFiles())
        assert "/b_linked_releases-" in files and "/a_credited-" in files
    relations = " ".join(ev.by_band_member(c.a, c.b, c.sites).inputFiles())
    assert "/a_artist_relations-" in relations and "/a_l_artist_artist-" not in relations
    total = queries.ALL["artist_evidence_all"].build(c)._jdf.queryExecution().executedPlan().toString()
    assert total[:total.index("Union")].count("Exchange") == 1
