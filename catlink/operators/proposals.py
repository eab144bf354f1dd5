"""Proposed edits for catalog A: links, relationships, formats, barcodes, credits, types, countries, cleanup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from catlink.config import B_LINK, LINK_TYPE, PERSON, SEVEN_INCH, VINYL_FORMATS, Catalog, Sites
from catlink.functions import similarity
from catlink.functions import text as X
from catlink.functions.text import catno_key, comma_and, name_key, numbered_name_key, strip_suffix
from catlink.functions.urls import encode_name, id_from_url
from catlink.operators.evidence import IS_PERSON, MEMBER_OF_BAND, linked, relations, text, unlinked
from catlink.operators.keys import except_rows, format_family, joined_text, only_single, repeated
from catlink.reports.info import CRLF, a_release_info, b_release_info
from catlink.session import materialise

# Relationships ---------------------------------------------------------------------------------


def _name_pairs(b: Catalog, listed: DataFrame) -> DataFrame:
    """(gid0, other name) -> (gid0, gid1) where a linked catalog B artist has exactly that name."""
    named = b.artist.select("id", F.col("name").alias("other")).join(b.artist_link.select("id", F.col("gid").alias("gid1")), "id")
    return listed.distinct().join(named.select("other", "gid1").distinct(), "other").select("gid0", "gid1").distinct()


def _existing_pairs(a: Catalog, kind: str) -> DataFrame:
    return linked(relations(a, kind), a.artist_link, on="id0").select("gid0", "gid1").distinct()


def member_of_band(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(gid0, gid1, note): linked artists whose catalog B record lists the other as their group."""
    listed = b.artist_link.select("id", F.col("gid").alias("gid0")).join(b.artist.select("id", F.explode("groups").alias("other")), "id")
    pairs = except_rows(_name_pairs(b, listed.select("gid0", "other")), _existing_pairs(a, MEMBER_OF_BAND))
    names = b.artist_link.select("gid", "name").distinct()
    n0, n1 = (names.select(F.col("gid").alias(f"gid{i}"), F.col("name").alias(f"name{i}")) for i in (0, 1))
    note = text(f'Both artists are linked to {sites.b_name} where "', F.col("name0"), '" is member of "', F.col("name1"), '".')
    return pairs.join(n0, "gid0").join(n1, "gid1").select("gid0", "gid1", note.alias("note"))


def performs_as(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(gid0, gid1, note): linked artists under their real name with a linked artist among their aliases."""
    own_name = b.artist.filter(strip_suffix("name") == F.col("realname")).select("id", F.explode("aliases").alias("other"))
    listed = b.artist_link.select("id", F.col("gid").alias("gid0")).join(own_name, "id")
    pairs = except_rows(_name_pairs(b, listed.select("gid0", "other")), _existing_pairs(a, IS_PERSON))
    links = b.artist_link.select("gid", "name", "url").distinct()
    n0, n1 = (links.select(F.col("gid").alias(f"gid{i}"), F.col("name").alias(f"name{i}"), F.col("url").alias(f"url{i}")) for i in (0, 1))
    note = text(f'Both artists are linked to {sites.b_name} where "', F.col("name0"), '" ', F.col("url0"), ' performs as "', F.col("name1"), '" ', F.col("url1"))
    return pairs.join(n0, "gid0").join(n1, "gid1").select("gid0", "gid1", note.alias("note"))


# Labels ------------------------------------------------------------------------------------------


def _shared(a_keys: DataFrame, b_keys: DataFrame, shown: str, what: str) -> DataFrame:
    """Count shared values between labels of one name: (gid, url, note, score).

    ``a_keys`` is (gid, _name, _key) and ``b_keys`` (label, _name, _key, shown), both distinct.
    """
    totals = a_keys.groupBy("gid", "_name").agg(F.count("_key").alias("total"))
    hits = a_keys.join(b_keys, ["_name", "_key"]).select("gid", "_name", encode_name("label").alias("url"), shown).distinct()
    # catalog A names are compared in lower case, so a label has one total
    counted = hits.groupBy("gid", "_name", "url").agg(F.count(shown).alias("score")).join(totals, ["gid", "_name"])
    return counted.select("gid", "url", text(F.col("score"), f" shared {what} from total ", F.col("total")).alias("note"), "score")


def label_links(a: Catalog, b: Catalog) -> DataFrame:
    """(gid, url, note, score): labels of the same name that share catalog numbers or release titles."""
    labels = unlinked(a.label.select("id", "gid", "name"), a.label_link).select(F.col("id").alias("label"), "gid", name_key("name").alias("_name"))
    held = a.release_label.join(labels, "label")
    b_rows = b.releases_labels.select("release_id", "label", "catno", name_key("label").alias("_name"))
    cats = _shared(
        held.filter("catalog_number IS NOT NULL").select("gid", "_name", catno_key("catalog_number").alias("_key")).distinct(),
        b_rows.select("label", "_name", catno_key("catno").alias("_key")).distinct().withColumn("catno", F.col("_key")),
        "catno", "catalog numbers",
    )
    titles = a.release.select(F.col("id").alias("release"), name_key("name").alias("_key"))
    b_titles = b.release.select(F.col("id").alias("release_id"), "title", name_key("title").alias("_key"))
    rels = _shared(
        held.join(titles, "release").select("gid", "_name", "_key").distinct(),
        b_rows.join(b_titles, "release_id").select("label", "_name", "_key", "title").distinct(),
        "title", "release titles",
    )
    rows = cats.unionByName(rels).distinct()
    per = rows.groupBy("gid", "url").agg(joined_text("note", " and ").alias("notes"), F.sum("score").alias("score"))
    return per.select("gid", "url", text("Name match and ", F.col("notes")).alias("note"), "score")


# Releases ------------------------------------------------------------------------------------------


def release_candidates(a: Catalog, multi_linked: bool = False) -> DataFrame:
    """Releases with exactly one linked label and one medium format, not linked yet.

    With ``multi_linked`` the releases that have several links instead.
    """
    own = a.release_link.select("id", "url")
    base = a.release.select("id")
    if multi_linked:
        base = base.join(repeated(own, ["id"], "url"), "id", "left_semi")
    else:
        base = unlinked(base, own)
    labelled = (
        a.label_link.select(F.col("id").alias("label"), F.col("name").alias("label_name"), F.col("gid").alias("label_gid"))
        .join(a.release_label.filter("catalog_number IS NOT NULL").select("label", F.col("release").alias("id"), "catalog_number"), "label")
        .join(base, "id", "left_semi")
    )
    one_label = only_single(labelled.drop("label"), ["id"])
    media = (
        a.medium.select(F.col("release").alias("id"), "tracklist", "format")
        .join(a.tracklist.select(F.col("id").alias("tracklist"), "track_count"), "tracklist")
        .groupBy("id").agg(F.sum("track_count").alias("track_count"), F.max("format").alias("format"), F.count("format").alias("n"))
        .filter("n = 1").drop("n")
    )
    rel = a.release.select("id", "gid", "name", "country", F.col("date_year").alias("year"), "status", "barcode")
    return one_label.join(media, "id").join(rel, "id").select(
        "label_name", "label_gid", "catalog_number", "gid", "name", "track_count", "format", "country", "year", "status", "barcode")


_MATCH = ["label_id", "_catno", "year", "status", "_format", "country", "track_count"]


def single_matches(candidates: DataFrame, b: Catalog) -> DataFrame:
    """Candidates with exactly one release of catalog B that agrees in every respect.

    Label, catalog number, year, status, country, track count and format family are all join
    keys. Catalog B is reduced to one row per key, with the number of releases behind it, before
    the join: a key shared by many releases (``none``, say) can only be ambiguous, so its
    releases are counted and never paired with the candidates.
    """
    b_side = (
        b.releases_labels.select("release_id", F.col("label").alias("_label"), catno_key("catno").alias("_catno"))
        .join(b.label.select(F.col("id").alias("label_id"), F.col("name").alias("_label")), "_label")
        .join(b.release_mapping, "release_id")
        .select("label_id", "_catno", F.col("country_id").cast("bigint").alias("country"), format_family("format_id", VINYL_FORMATS).alias("_format"),
                *[c for c in b.release_mapping.columns if c not in ("country", "country_id")])
        .distinct()
        .groupBy(*_MATCH).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("release_id", "title")).alias("_m"))
    )
    b_labels = b.label_link.select(F.col("gid").alias("label_gid"), F.col("id").alias("label_id")).distinct()
    a_side = (
        candidates.join(b_labels, "label_gid")
        .withColumn("_catno", catno_key("catalog_number"))
        .withColumn("_format", format_family("format", VINYL_FORMATS))
        .withColumn("country", F.col("country").cast("bigint"))
        .distinct()
    )
    hits = a_side.join(b_side, _MATCH)
    keep = ["label_name", "catalog_number", "name", "barcode"]
    single = hits.groupBy("gid").agg(F.sum("_n").alias("_total"), F.max(F.struct(*keep, F.col("_m.release_id"), F.col("_m.title"))).alias("m"))
    single = single.filter("_total = 1").select("gid", "m.*")
    codes = b.release_identifier.filter("type = 'Barcode' AND value <> ''").select("release_id", F.col("value").alias("barcode")).distinct()
    codes = codes.withColumn("b_barcode", F.col("barcode"))
    return single.join(codes, ["release_id", "barcode"], "left").select("gid", *keep, "release_id", "title", "b_barcode")


def release_links(candidates: DataFrame, b: Catalog, sites: Sites) -> DataFrame:
    """(gid, url, note, score): the one agreeing release of each candidate, scored."""
    same_title = name_key("title") == name_key("name")
    barcode_note = (
        F.when(F.col("barcode").isNull(), f"{sites.a_name} barcode missing")
        .when(F.col("b_barcode").isNull(), f"{sites.b_name} barcode missing")
        .otherwise(text('with same barcode "', F.col("barcode"), '"'))
    )
    note = text(
        'Release from label "', F.col("label_name"), f'" found on linked {sites.b_name} label with same normalized catalog number "', F.col("catalog_number"),
        '", ', barcode_note, ", same number of tracks, same format, same release country, same release year, same status, and ",
        F.when(same_title, "exactly same").otherwise("similar"),
        f' release name {sites.a_name}: "', F.col("name"), f'" {sites.b_name}: "', F.col("title"), '"',
    )
    score = (
        F.lit(1)
        + F.when(F.col("barcode").isNotNull() & F.col("b_barcode").isNotNull(), 3).when(F.col("barcode").isNull() & F.col("b_barcode").isNull(), 1).otherwise(0)
        + F.when(same_title, 5).otherwise(0)
    )
    url = text(sites.b("release"), F.col("release_id"))
    return single_matches(candidates, b).select("gid", url.alias("url"), note.alias("note"), score.cast("bigint").alias("score"))


def release_cleanup(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(id, note): links to remove from releases with several links, one of which is the best match."""
    links = b.release_link.select("gid", "url", "id")
    multi = links.join(repeated(links, ["gid"], "url"), "gid", "left_semi")
    # the matches are read for the links found, those to remove and the texts: stored once
    best = materialise(single_matches(release_candidates(a, multi_linked=True), b).select("gid", "release_id"), "cleanup-matches")
    best = best.withColumn("best_url", text(sites.b("release"), F.col("release_id")))
    found = multi.select("gid", "url").intersect(best.select("gid", F.col("best_url").alias("url")))
    removable = except_rows(multi.select("gid", "url").join(found.select("gid"), "gid", "left_semi"), found)
    several = repeated(a.release_link, ["id"], "url")
    edges = (
        a.l_release_url.select(F.col("id").alias("edge"), F.col("entity0").alias("id"), F.col("entity1").alias("url_id"))
        .join(a.url.select(F.col("id").alias("url_id"), "url"), "url_id")
        .join(a.release_link.join(several, "id", "left_semi").select("id", "gid", "url"), ["id", "url"])
        .select("edge", "gid", "url", F.col("id").alias("a_release"))
        .distinct()
    )
    removed = (
        edges.join(removable, ["gid", "url"])
        .join(links.select("gid", "url", F.col("id").alias("remove_id")), ["gid", "url"])
        .join(best, "gid")
    )
    # the links to remove are read many times below: stored once, and texts only of their releases
    removed = materialise(removed, "cleanup")
    a_ids = removed.select(F.col("a_release").alias("release_id"))
    b_ids = removed.select("release_id").unionByName(removed.select(F.col("remove_id").alias("release_id")))
    a_info = a_release_info(a, "short", a_ids).select(F.col("release_id").alias("a_release"), F.col("info").alias("a_info"))
    b_info = materialise(b_release_info(b, "short", b_ids), "cleanup-texts")
    rows = (
        removed.join(a_info, "a_release", "left")
        .join(b_info.select("release_id", F.col("info").alias("best_info")), "release_id", "left")
        .join(b_info.select(F.col("release_id").alias("remove_id"), F.col("info").alias("remove_info")), "remove_id", "left")
    )
    note = text(
        f"Release has multiple {sites.b_name} urls.", CRLF, F.col("a_info"), CRLF,
        F.col("best_url"), " is best match", CRLF, F.col("best_info"), CRLF, CRLF,
        f"Removing {sites.b('release')}", F.col("remove_id"), CRLF, F.col("remove_info"),
    )
    return rows.select(F.col("edge").alias("id"), note.alias("note")).distinct()


def release_formats(a: Catalog, b: Catalog) -> DataFrame:
    """(gid, format_id, url): the one format of the linked release, for a release with one medium lacking it."""
    bare = a.medium.filter("format IS NULL").select(F.col("release").alias("id"))
    rows = a.release_link.filter("edits_pending = 0").select("id", "url").join(bare, "id")
    one = rows.groupBy("id").agg(F.count("url").alias("n")).filter("n = 1").select("id")
    rel = a.release.select("id", "gid", F.col("date_year").alias("a_year"), F.col("country").alias("a_country")).join(one, "id", "left_semi").drop("id")
    linked_rows = rel.join(b.release_link.select("gid", F.col("id").alias("release_id"), "url"), "gid")
    m = b.release_mapping.select("release_id", F.col("country_id").alias("a_country"), "year", "format_id").distinct()
    hits = linked_rows.join(m, ["release_id", "a_country"]).filter("a_year IS NULL OR a_year = year").select("gid", "format_id", "url").distinct()
    return only_single(hits, ["gid"], count="format_id")


def release_barcodes(a: Catalog, b: Catalog) -> DataFrame:
    """(gid, url, value): 12 or 13 digit barcodes of the linked release for releases without one."""
    one = a.release_link.groupBy("gid").agg(F.count("url").alias("n")).filter("n = 1").select("gid")
    rel = a.release.filter("barcode IS NULL AND quality = -1").select(F.col("id").alias("release"), "gid", "country", F.col("date_year").alias("year"))
    left = (
        rel.join(one, "gid", "left_semi")
        .join(a.medium.select("release", "format"), "release")
        .join(a.release_label.select("release", catno_key("catalog_number").alias("_catno")), "release")
        .join(b.release_link.select("gid", F.col("id").alias("release_id"), "url"), "gid")
        .select("gid", "url", "release_id", "country", "year", "format", "_catno")
        .distinct()
    )
    mapped = b.release_mapping.select("release_id", F.col("country_id").alias("country"), "year", F.col("format_id").alias("format"))
    catnos = b.releases_labels.select("release_id", catno_key("catno").alias("_catno"))
    agreed = left.join(mapped, ["release_id", "country", "year", "format"], "left_semi").join(catnos, ["release_id", "_catno"], "left_semi")
    codes = b.release_identifier.filter((F.col("type") == "Barcode") & X.is_barcode("value")).select("release_id", "value")
    return agreed.select("gid", "url", "release_id").distinct().join(codes, "release_id").select("gid", "url", "value").distinct()


# Release groups ------------------------------------------------------------------------------------


def release_group_links(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(gid, master_id, note): same linked artist, same title, same first year.

    Artists with a repeated group name and release groups with several masters are left out.
    """
    shared = repeated(a.artist_link, ["url"], "gid")
    people = a.artist_link.filter("edits_pending = 0").join(shared, "url", "left_anti").select(F.col("id").alias("artist"), F.col("gid").alias("artist_gid"))
    single = a.artist_credit.filter("artist_count = 1").select(F.col("id").alias("artist_credit"))
    free = unlinked(a.release_group.select("id", "gid", "name", "artist_credit"), a.release_group_link, key="gid", on="gid")
    groups = (
        people.join(a.artist_credit_name.select("artist_credit", "artist"), "artist")
        .join(single, "artist_credit", "left_semi")
        .join(free, "artist_credit")
        .join(a.release_group_meta.select("id", F.col("first_release_date_year").alias("year")), "id")
        .select("gid", "name", "artist_gid", "year")
    )
    unclear = repeated(groups, ["artist_gid", "name"], "gid").select("artist_gid").distinct()
    left = (
        groups.join(unclear, "artist_gid", "left_anti")
        .join(b.artist_link.select(F.col("gid").alias("artist_gid"), F.col("id").alias("artist_id"), F.col("name").alias("link_name"), F.col("url").alias("link_url")), "artist_gid")
        .join(b.artist.select(F.col("id").alias("artist_id"), F.col("name").alias("b_artist")), "artist_id")
        .withColumn("_title", name_key("name"))
    )
    # masters per (artist, title, year) are counted first: a repeated master is ambiguous for
    # every release group that meets it, and is never paired with them
    right = (
        b.masters_artists.select("artist_id", "master_id")
        .join(b.master.select(F.col("id").alias("master_id"), "title", "year", name_key("title").alias("_title")), "master_id")
        .groupBy("artist_id", "_title", "year").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("master_id", "title")).alias("_m"))
    )
    note = text(f"{sites.a_name} release group: ", F.col("name"), " by ", F.col("link_name"), f"\n{sites.b_name} master: ", F.col("m.title"), " by ",
                F.col("b_artist"), " ", F.col("link_url"),
                "\nLinked artists, release group and master have unique name (in artist context), names match, and both have earliest release on ", F.col("year"))
    hits = left.join(right, ["artist_id", "_title", "year"])
    shown = ["name", "link_name", "b_artist", "link_url", "year"]
    single = hits.groupBy("gid").agg(F.sum("_n").alias("_total"), F.max(F.struct(*shown, F.col("_m").alias("m"))).alias("h")).filter("_total = 1")
    return single.select("gid", "h.*").select("gid", F.col("m.master_id").alias("master_id"), note.alias("note"))


def common_masters(a: Catalog, b: Catalog, sites: Sites, threshold: float = 0.8) -> DataFrame:
    """(gid, url, note): release groups all of whose linked releases belong to one master of similar title."""
    def edges(kind: str, link_type: int) -> DataFrame:
        links = a.link.filter(F.col("link_type") == link_type).select(F.col("id").alias("link"))
        return getattr(a, f"l_{kind}_url").join(links, "link", "left_semi").select(F.col("entity0").alias(kind), F.col("entity1").alias("url_id"))

    with_master = edges("release_group", LINK_TYPE["release_group_b"]).select("release_group").distinct()
    urls = (
        edges("release", LINK_TYPE["release_b"])
        .join(a.release.select(F.col("id").alias("release"), "release_group"), "release")
        .join(with_master, "release_group", "left_anti")
        .join(a.url.select(F.col("id").alias("url_id"), "url"), "url_id")
        .select("release_group", "url").distinct()
    )
    masters = urls.withColumn("release_id", id_from_url("url", sites.b("release"))).join(
        b.release.select(F.col("id").alias("release_id"), "master_id"), "release_id", "left")
    per = masters.groupBy("release_group").agg(
        F.count("url").alias("n"), F.count("master_id").alias("n_master"), F.min("master_id").alias("lo"), F.max("master_id").alias("hi"))
    agreed = per.filter("n >= 2 AND n_master = n AND lo = hi").select("release_group", "n", F.col("lo").alias("master_id"))
    names = b.masters_artists.groupBy("master_id").agg(F.sort_array(F.collect_list(F.struct("artist_id", "artist_name"))).alias("people"))
    rows = (
        agreed.join(a.release_group.select(F.col("id").alias("release_group"), "gid", "name"), "release_group")
        .join(b.master.select(F.col("id").alias("master_id"), "title"), "master_id")
        .withColumn("ratio", similarity.ratio_at_least(F.lower("title"), F.lower("name"), threshold))
        .filter("ratio IS NOT NULL")
        .join(names, "master_id", "left")
    )
    note = text("There are ", F.col("n"), f" distinct {sites.b_name} links in this release group, and all point to this master URL.\n",
                f"The name of the {sites.b_name} master is “", F.col("title"), "” (similarity: ", F.format_string("%.0f", F.col("ratio") * 100), "%) by ",
                comma_and(F.transform("people", lambda p: p["artist_name"])), ".")
    return rows.select("gid", text(sites.b("master"), F.col("master_id")).alias("url"), note.alias("note"))


def shuffled_groups(df: DataFrame, group: str, member: str, seed: int = 0) -> DataFrame:
    """Random but repeatable order of groups, with the members of a group together."""
    return df.orderBy(F.xxhash64(F.col(group), F.lit(seed)), F.col(group), F.col(member))


# Credits -----------------------------------------------------------------------------------------


def release_credits(b: Catalog) -> DataFrame:
    """Linked artists credited on linked releases, both with a single link."""
    def single(links: DataFrame) -> DataFrame:
        return links.join(links.groupBy("gid").agg(F.count("gid").alias("n")).filter("n = 1").select("gid"), "gid", "left_semi")

    rel = single(b.release_link).select(F.col("gid").alias("release_gid"), F.col("url").alias("release_url"), F.col("id").alias("release_id"))
    art = single(b.artist_link).select(F.col("gid").alias("artist_gid"), F.col("url").alias("artist_url"), F.col("id").alias("artist_id"))
    return (
        b.releases_extraartists.select("release_id", "artist_id", "roles")
        .join(rel, "release_id").join(linked(art, b.artist, on="artist_id"), "artist_id")
        .select("release_gid", "release_url", "artist_gid", "artist_url", "roles")
    )


def credit_proposals(a: Catalog, b: Catalog, role: str = "Producer", link_type: str = "producer") -> DataFrame:
    """Release credits in one role that catalog A does not have yet."""
    credits = release_credits(b).filter(F.array_contains("roles", role))
    types = a.link_type.filter(F.col("name") == link_type).select(F.col("id").alias("link_type"))
    links = a.link.join(types, "link_type", "left_semi").select(F.col("id").alias("link"))
    present = (
        a.l_artist_release.join(links, "link", "left_semi").select(F.col("entity0").alias("artist"), F.col("entity1").alias("release"))
        .join(a.artist.select(F.col("id").alias("artist"), F.col("gid").alias("artist_gid")), "artist")
        .join(a.release.select(F.col("id").alias("release"), F.col("gid").alias("release_gid")), "release")
        .select("artist_gid", "release_gid").distinct()
    )
    return credits.join(present, ["artist_gid", "release_gid"], "left_anti").select("release_gid", "release_url", "artist_gid", "artist_url", "roles")


def remix_credits(b: Catalog) -> DataFrame:
    """Plain remix credits of linked artists on tracks of linked releases."""
    plain = b.tracks_extraartists.filter("role_name = 'Remix' AND role_details IS NULL AND anv = '' AND artist_id <> 0").select("track_id", "artist_id")
    people = (
        b.artist_link.select(F.col("id").alias("artist_id"), F.col("gid").alias("artist_gid"), F.col("name").alias("link_name"))
        .join(b.artist.select(F.col("id").alias("artist_id"), "name"), "artist_id")
        .filter(name_key("link_name") == numbered_name_key("name")).drop("link_name")
    )
    rel = b.release_link.select("gid", "id").join(b.release.select("id", "title"), "id")
    tracks = b.track.select(F.col("id").alias("track_id"), F.col("release_id").alias("id"), "position", F.col("title").alias("track_title"))
    return plain.join(tracks, "track_id").join(rel, "id").join(people, "artist_id").select(
        "gid", "id", "title", "position", "track_title", "name", "artist_gid")


def remix_proposals(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(artist_gid, gid, note): recordings of the same title on the linked release, one note per pair."""
    credits = remix_credits(b).select(F.col("gid").alias("release_gid"), "id", "title", "name", "artist_gid", name_key("track_title").alias("_title")).distinct()
    # stored, as only releases with such credits give up their recordings
    credits = materialise(credits, "remix-credits")
    rec = (
        a.release.select(F.col("id").alias("release"), F.col("gid").alias("release_gid")).join(credits.select("release_gid").distinct(), "release_gid", "left_semi")
        .join(a.medium.select("release", "tracklist"), "release")
        .join(a.track.select("tracklist", "recording"), "tracklist")
        .join(a.recording.select(F.col("id").alias("recording"), "gid", "name"), "recording")
        .select("release_gid", "gid", F.col("name").alias("recording_name"), name_key("name").alias("_title"))
        .distinct()
    )
    note = text('Release "', F.col("title"), f'" {sites.a("release")}', F.col("release_gid"), f" has {sites.b_name} link {sites.b('release')}", F.col("id"),
                '\nThere is track "', F.col("recording_name"), f'" that is same as recording {sites.a("recording")}', F.col("gid"),
                "\nIt is remixed by ", F.col("name"), f" linked artist found on {sites.a_name} {sites.a('artist')}", F.col("artist_gid"))
    links = a.link.filter(F.col("link_type") == LINK_TYPE["remixer"]).select(F.col("id").alias("link"))
    present = (
        a.l_artist_recording.join(links, "link", "left_semi").select(F.col("entity0").alias("artist"), F.col("entity1").alias("recording"))
        .join(a.artist.select(F.col("id").alias("artist"), F.col("gid").alias("artist_gid")), "artist")
        .join(a.recording.select(F.col("id").alias("recording"), "gid"), "recording")
        .select("artist_gid", "gid").distinct()
    )
    rows = credits.join(rec, ["release_gid", "_title"]).select("artist_gid", "gid", note.alias("note"))
    return rows.join(present, ["artist_gid", "gid"], "left_anti").groupBy("artist_gid", "gid").agg(F.min("note").alias("note"))


# Artist attributes ------------------------------------------------------------------------------------

# Words of a comment that tell the artist type, and patterns that rule it out.
PERSON_WORDS = ("singer", "actor", "producer", "composer", "conductor", "dj")
PERSON_NOT = ("%unknown%", "%feat%", "%crew%")
PERSON_NOTE = "Singer/actor/producer/composer/conductor/dj in disambiguation comment"
GROUP_WORDS = ("band", "group", "trio", "quartet", "duo", "duet", "orchestra", "ensemble")
GROUP_NOT = ("%unknown%", "%artist%band%", "%performed%", "%feat%", "%artist%group%", "%composer%")
GROUP_NOTE = "Band/group/duo/duet/trio/quartet/orchestra/ensemble in disambiguation comment"


def _like_any(c: Column, patterns: Sequence[str]) -> Column:
    out = c.like(patterns[0])
    for p in patterns[1:]:
        out = out | c.like(p)
    return out


def artist_types(artists: DataFrame, artist_type: int) -> DataFrame:
    """(gid, type, note) of artists without a type whose comment names it."""
    words, ruled_out, note = (PERSON_WORDS, PERSON_NOT, PERSON_NOTE) if artist_type == PERSON else (GROUP_WORDS, GROUP_NOT, GROUP_NOTE)
    comment = F.lower("comment")
    patterns = [p for w in words for p in (f"% {w}", f"% {w} %", f"{w} %")]
    hit = artists.filter(F.col("type").isNull() & _like_any(comment, patterns) & ~_like_any(comment, ruled_out))
    return hit.select("gid", F.lit(artist_type).alias("type"), F.lit(note).alias("note")).distinct()


def country_patterns(countries: DataFrame, search: DataFrame) -> DataFrame:
    """(country_id, pattern): the country's own name and its search patterns."""
    own = F.array(F.concat(F.lower("name"), F.lit("%")))
    with_search = countries.join(search, "iso_code", "left")
    return with_search.select(F.col("id").alias("country_id"), F.explode(X.array_concat(own, "search")).alias("pattern")).distinct()


def country_by_prefix(texts: DataFrame, column: str, patterns: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """``texts`` with each country one of whose ``LIKE`` patterns matches the text; a country once per row.

    A pattern's letters up to its first wildcard are an equality key. A text is looked up under its beginnings of just the lengths that occur among
    the patterns, so it meets only patterns whose whole literal beginning it has, whatever many texts begin alike; a pattern that begins
    with a wildcard has the empty key. With ``key``, columns that tell the texts apart, only those and the country are
    deduplicated, and the texts are joined back to what matched.
    """
    head = F.regexp_extract("pattern", r"(?s)^([^%_\\]*)", 1)
    keyed = patterns.select("country_id", "pattern", head.alias("_key")).distinct()
    lengths = sorted(r[0] for r in keyed.select(F.length("_key")).distinct().collect())  # as many as the longest name has letters, at most
    low = F.lower(column)
    starts = F.array_distinct(F.array(*[F.left(low, F.lit(n)) for n in lengths])) if lengths else F.array().cast("array<string>")
    rows = texts.filter(F.col(column).isNotNull()).withColumn("_key", F.explode(starts)).join(keyed, "_key").filter(F.expr(f"lower(`{column}`) LIKE pattern"))
    if not key:
        return rows.drop("_key", "pattern").distinct()
    return texts.join(rows.select(*key, "country_id").distinct(), [*key])


def country_from_comment(artists: DataFrame, patterns: DataFrame) -> DataFrame:
    """(country_id, gid, name, comment) of artists without a country whose comment begins with one."""
    ok = (F.col("country").isNull()) & ~F.col("comment").contains("?") & ~F.col("comment").rlike(r"(?i)^[a-z]+[-/]")
    return country_by_prefix(artists.filter(ok).select("gid", "name", "comment"), "comment", patterns, ["gid"]).select("country_id", "gid", "name", "comment")


def country_from_profile(a: Catalog, b: Catalog, patterns: DataFrame) -> DataFrame:
    """(country_id, gid, name, comment) of linked artists without a country, from their catalog B profile.

    The comment is the first sentence of the profile.
    """
    open_artists = a.artist.filter("country IS NULL").select("gid", "id").join(a.artist_link.select("id").distinct(), "id", "left_semi").select("gid").distinct()
    rows = b.artist_link.select("id", "gid", "name").distinct().join(b.artist.select("id", "profile"), "id").join(open_artists, "gid", "left_semi")
    ok = ~F.col("profile").contains("?") & ~F.col("profile").rlike(r"(?i)^[a-z]+[-/]")
    hit = country_by_prefix(rows.filter(ok).select("id", "gid", "name", "profile"), "profile", patterns, ["id", "gid", "name"])
    return hit.select("country_id", "gid", "name", X.first_sentence("profile").alias("comment"))


# Link maintenance ---------------------------------------------------------------------------------------


def dead_link_candidates(a: Catalog, b: Catalog, kind: str) -> DataFrame:
    """(id, gid, url): settled links of artists or labels that no catalog B entity answers to."""
    edges = getattr(a, f"l_{kind}_url").filter((F.col("link") == B_LINK[kind]) & (F.col("edits_pending") == 0))
    return (
        edges.select("id", F.col("entity0").alias("entity"), F.col("entity1").alias("url_id"))
        .join(a.url.select(F.col("id").alias("url_id"), "url"), "url_id")
        .join(getattr(a, kind).select(F.col("id").alias("entity"), "gid"), "entity")
        .join(getattr(b, f"{kind}_link").select("gid").distinct(), "gid", "left_anti")
        .select("id", "gid", "url")
    )


def dead_links(candidates: DataFrame, crawl: DataFrame, status: int = 404) -> DataFrame:
    """Candidates whose address the crawl ``(url, status)`` found gone."""
    return candidates.join(crawl.filter(F.col("status") == status).select("url").distinct(), "url", "left_semi").select("id", "gid", "url")


# Sites whose links become "has a page in a database", and the link rows in question.
DATABASE_SITES = """
http://rateyourmusic.com/
http://www.worldcat.org/
http://musicmoz.org/
http://www.45cat.com/
http://www.musik-sammler.de/
http://discografia.dds.it/
http://www.elnet.ee/ester/
http://www.encyclopedisque.fr/
http://www.discosdobrasil.com.br/
http://isrc.ncl.edu.tw/
http://www.rolldabeats.com/
http://www.psydb.net/
http://www.metal-archives.com/
http://www.spirit-of-metal.com/
http://www.ibdb.com/
http://www.iobdb.com/
http://theatricalia.com/
http://ocremix.org/
""".split()
DATABASE_LINKS = (26043, 26045, 26049, 26051, 26069)


def database_relations(a: Catalog, sites: Sequence[str] = DATABASE_SITES, links: Sequence[int] = DATABASE_LINKS) -> DataFrame:
    """(id, link_type, new_link_type): links to whitelisted sites that carry one of the old link rows."""
    edges = a.l_artist_url.filter(F.col("link").isin(*links)).select("id", F.col("entity1").alias("url_id"), "link")
    listed = a.url.filter(_like_any(F.col("url"), [s + "%" for s in sites])).select(F.col("id").alias("url_id"))
    kinds = a.link.select(F.col("id").alias("link"), "link_type")
    return edges.join(listed, "url_id").join(kinds, "link").select("id", "link_type", F.lit(LINK_TYPE["database_page"]).alias("new_link_type"))


def seven_inch_formats(a: Catalog, processed: DataFrame, prefix: str = "http://www.encyclopedisque.fr/images/", limit: int | None = None) -> DataFrame:
    """Releases with an image link of the sleeve site whose medium should be a 7-inch.

    The format is absent or just "vinyl", the image belongs to no other release, and the release
    was not processed before.
    """
    links = a.link.filter(F.col("link_type") == LINK_TYPE["release_image"]).select(F.col("id").alias("link"))
    images = a.url.filter(F.col("url").startswith(prefix)).select(F.col("id").alias("url_id"), "url")
    edges = a.l_release_url.select(F.col("entity0").alias("release"), F.col("entity1").alias("url_id"), "link")
    # an address with a single distinct release: shared ones fail for every release
    own = edges.groupBy("url_id").agg(F.min("release").alias("lo"), F.max("release").alias("hi")).filter("lo = hi").select("url_id")
    media = a.medium.filter("format IS NULL OR format = 7").select("release", "format")
    rows = edges.join(links, "link", "left_semi").join(images, "url_id").join(own, "url_id", "left_semi").join(media, "release")
    rel = a.release.select(F.col("id").alias("release"), "gid", "name", "artist_credit")
    credit = a.artist_credit.select(F.col("id").alias("artist_credit"), F.col("name").alias("credit_name"))
    out = rows.join(rel, "release").join(credit, "artist_credit").join(processed.select("gid").distinct(), "gid", "left_anti")
    if limit is not None:
        out = out.orderBy("artist_credit", "release", "url", "format").limit(limit)
    note = text('Setting format to 7" based on attached link to Encyclopedisque (', F.col("url"), ")")
    return out.select(F.col("release").alias("id"), "gid", "name", "url", "format", "credit_name", F.lit(SEVEN_INCH).alias("new_format"), note.alias("note"))

