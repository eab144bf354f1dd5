"""Evidence that an unlinked artist of catalog A is a certain artist of catalog B.

Every branch returns ``(gid, url, note, score)``; ``url`` is the encoded name in catalog B.
Joins use all equal columns at once (release and title and name, say), never a name alone with
the rest as a filter, so that one frequent name does not multiply rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, functions as F

from catlink.config import SPECIAL_ARTIST, Catalog, Sites
from catlink.functions.text import name_key, numbered_name_key
from catlink.functions.urls import encode_name
from catlink.operators.keys import joined_text, note_list

# Link type names, weights.
MEMBER_OF_BAND, IS_PERSON = "member of band", "is person"
W_CREDIT, W_RELATION, W_URL, W_TITLE, W_TRACK = 12, 3, 3, 4, 1


def text(*parts: Column | str) -> Column:
    """Concatenation that is NULL when a part is; strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _branch(df: DataFrame, gid: str, name: Column | str, note: Column, score: Column | int) -> DataFrame:
    s = F.lit(score) if isinstance(score, int) else score
    n = F.col(name) if isinstance(name, str) else name
    return df.select(F.col(gid).alias("gid"), encode_name(n).alias("url"), note.alias("note"), s.cast("bigint").alias("score"))


def _once(branch: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The branch with equal rows once; its ``rows`` may repeat, for a union that drops them itself."""
    @wraps(branch)
    def once(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
        return branch(a, b, sites).distinct()

    once.rows = branch
    return once


def unlinked(df: DataFrame, links: DataFrame, key: str = "id", on: str = "id") -> DataFrame:
    return df.join(links.select(F.col(key).alias(on)).distinct(), on, "left_anti")


def linked(df: DataFrame, links: DataFrame, key: str = "id", on: str = "id") -> DataFrame:
    return df.join(links.select(F.col(key).alias(on)).distinct(), on, "left_semi")


def credited_artists(a: Catalog) -> DataFrame:
    """(artist_credit, artist, artist_gid, artist_name) of every credit member."""
    art = a.artist.select(F.col("id").alias("artist"), F.col("gid").alias("artist_gid"), F.col("name").alias("artist_name"))
    return a.artist_credit_name.select("artist_credit", "artist").join(art, "artist")


def b_ids(links: DataFrame, gid: str, out: str, *extra: str) -> DataFrame:
    """Resolved links as (gid column, catalog B id column)."""
    return links.select(F.col("gid").alias(gid), F.col("id").alias(out), *extra)


def flagged(df: DataFrame, links: DataFrame, on: str, out: str) -> DataFrame:
    """``df`` with a boolean column: the entity is linked."""
    marks = links.select(F.col("id").alias(on)).distinct().withColumn(out, F.lit(True))
    return df.join(marks, on, "left").withColumn(out, F.coalesce(out, F.lit(False)))


# Rows that several branches share -------------------------------------------------------------------


def credits_with_links(a: Catalog) -> DataFrame:
    """:func:`credited_artists` with ``artist_linked``."""
    return flagged(credited_artists(a), a.artist_link, "artist", "artist_linked")


def releases_with_links(a: Catalog, b: Catalog) -> DataFrame:
    """(release, release_gid, release_name, artist_credit, release_id, release_url): linked releases, one row per resolved link."""
    releases = a.release.select(F.col("id").alias("release"), F.col("gid").alias("release_gid"), F.col("name").alias("release_name"), "artist_credit")
    links = b_ids(b.release_link, "release_gid", "release_id", F.col("url").alias("release_url"))
    return linked(releases.join(links, "release_gid"), a.release_link, on="release")


def relations_with_links(a: Catalog) -> DataFrame:
    """:func:`relations` of bands and of persons in one pass, with ``kind``, ``linked0`` and ``linked1``."""
    types = a.link_type.filter(F.col("name").isin(MEMBER_OF_BAND, IS_PERSON)).select(F.col("id").alias("link_type"), F.col("name").alias("kind"))
    kinds = a.link.join(types, "link_type").select(F.col("id").alias("link"), "kind").distinct()
    out = a.l_artist_artist.select("entity0", "entity1", "link").join(kinds, "link").drop("link")
    for n in (0, 1):
        side = a.artist.select(F.col("id").alias(f"entity{n}"), F.col("gid").alias(f"gid{n}"), F.col("name").alias(f"name{n}"))
        out = out.join(flagged(side, a.artist_link, f"entity{n}", f"linked{n}"), f"entity{n}")
    return out.select("kind", F.col("entity0").alias("id0"), "gid0", "name0", "linked0", F.col("entity1").alias("id1"), "gid1", "name1", "linked1")


def credited(a: Catalog) -> DataFrame:
    """Table ``credited`` of a catalog that keeps it, else :func:`credits_with_links`."""
    return a.credited if "credited" in a else credits_with_links(a)


def unlinked_credited(a: Catalog) -> DataFrame:
    return credited(a).filter(~F.col("artist_linked")).drop("artist_linked")


def linked_releases(a: Catalog, b: Catalog) -> DataFrame:
    """Table ``linked_releases`` of a catalog that keeps it, else :func:`releases_with_links`."""
    return b.linked_releases if "linked_releases" in b else releases_with_links(a, b)


def artist_relations(a: Catalog) -> DataFrame:
    """Table ``artist_relations`` of a catalog that keeps it, else :func:`relations_with_links`."""
    return a.artist_relations if "artist_relations" in a else relations_with_links(a)


# Tracks (C15) and release credits (C16) -----------------------------------------------------------


def track_evidence(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """Same track title and same track artist on a linked release. Equal rows are given once."""
    keys = ["release_id", "_title", "_name"]
    # linked releases lead on both sides, so that only their tracks travel further; equal rows are dropped on the right, so no title multiplies
    places = a.medium.select("tracklist", "release").join(linked_releases(a, b).select("release", "release_gid", "release_id"), "release").drop("release")
    rec = a.recording.select(F.col("id").alias("recording"), F.col("name").alias("title"), "artist_credit")
    left = (
        a.track.select("tracklist", "recording").join(places, "tracklist")
        .join(rec, "recording")
        .join(unlinked_credited(a), "artist_credit")
        .select("artist_gid", "release_gid", "release_id", "title", name_key("title").alias("_title"), name_key("artist_name").alias("_name"))
    )
    right = (
        linked(b.track.select(F.col("id").alias("track_id"), "release_id", name_key("title").alias("_title")), b.release_link, on="release_id")
        .join(b.tracks_artists.select("track_id", "artist_name"), "track_id")
        .select("release_id", "_title", numbered_name_key("artist_name").alias("_name"), "artist_name")
        .repartition(*keys).distinct()
    )
    note = text('Track "', F.col("title"), f'" artist on linked {sites.b_name} release {sites.a("release")}', F.col("release_gid"), " pointing to same artist.")
    return _branch(left.join(right, keys), "artist_gid", "artist_name", note, W_TRACK).distinct()


def release_credit_evidence(a: Catalog, b: Catalog, roles: DataFrame, phrases: DataFrame, sites: Sites) -> DataFrame:
    """Same artist credited on a linked release in a role of the same kind: (gid, url, note), one row per pair of credits."""
    people = unlinked(a.artist.select("gid", F.col("id").alias("artist"), "name"), a.artist_link, key="gid", on="gid")
    left = (
        a.l_artist_release.select(F.col("entity0").alias("artist"), F.col("entity1").alias("release"), "link")
        .join(linked_releases(a, b).select("release", "release_gid", "release_id", "release_url"), "release")
        .join(people, "artist")
        .join(phrases.select("link", "link_type", "phrase"), "link")
        .select("gid", "release_gid", "release_id", "release_url", "link_type", "phrase", name_key("name").alias("_name"))
    )
    kinds = roles.filter("release_link_type IS NOT NULL").select(F.col("credit").alias("role_name"), F.col("release_link_type").alias("link_type"))
    right = (
        b.releases_extraartists.select("release_id", "artist_name", "role_name")
        .join(kinds, "role_name")
        .select("release_id", "link_type", numbered_name_key("artist_name").alias("_name"), "artist_name", "role_name")
    )
    note = text("Artist credited (", F.col("phrase"), f") in {sites.a('release')}", F.col("release_gid"), " and (", F.col("role_name"),
                f") in linked {sites.b_name} release ", F.col("release_url"))
    joined = left.join(right, ["release_id", "link_type", "_name"])
    return joined.select("gid", encode_name("artist_name").alias("url"), note.alias("note"))


def summarise(rows: DataFrame, closing: str) -> DataFrame:
    """Per (gid, url): the first three notes and ``and N more …``; the score is the number of notes."""
    sums = rows.groupBy("gid", "url").agg(F.count("note").alias("score"))
    notes = note_list(rows.filter("note IS NOT NULL"), ["gid", "url"], "note", 3)
    head = F.array_join("notes", "\n")
    more = F.when(F.col("score") > 3, text(head, "\nand ", F.col("score") - 3, " more " + closing)).otherwise(head)
    return sums.join(notes, ["gid", "url"], "left").select("gid", "url", more.alias("note"), "score")


def track_summary(rows: DataFrame) -> DataFrame:
    return summarise(rows.select("gid", "url", "note").distinct(), "similary linked tracks pointing to same artist")


def release_credit_summary(rows: DataFrame) -> DataFrame:
    return summarise(rows, "similar releases with credits pointing to same artist")


# Branches over catalog structure (C17a to C17h) -----------------------------------------------------


@_once
def by_linked_release(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """A linked release is credited to an artist of the same name.

    Artists tagged ``improper <catalog B> link`` are left out.
    """
    improper = a.tag.filter(F.col("name") == f"improper {sites.b_name.lower()} link").select(F.col("id").alias("tag")).join(a.artist_tag, "tag").select("artist").distinct()
    people = unlinked_credited(a).filter(F.col("artist") != SPECIAL_ARTIST).join(improper, "artist", "left_anti")
    left = (
        linked(linked_releases(a, b), a.release_link.filter("edits_pending = 0"), on="release")
        .join(people, "artist_credit")
        .select("artist_gid", "release_gid", "release_name", "release_id", name_key("artist_name").alias("_name"))
        .repartition("release_id", "_name").distinct()
    )
    right = b.releases_artists.select("release_id", "artist_name", numbered_name_key("artist_name").alias("_name"))
    note = text(f"Release with {sites.b_name} link points to same artist: ", F.col("release_name"), f": {sites.a('release')}", F.col("release_gid"))
    return _branch(left.join(right, ["release_id", "_name"]), "artist_gid", "artist_name", note, W_CREDIT)


@_once
def by_linked_release_group(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """A linked release group with a single artist is credited to an artist of the same name."""
    single = a.artist_credit.filter((F.col("artist_count") == 1) & (F.col("id") != SPECIAL_ARTIST)).select(F.col("id").alias("artist_credit"))
    people = unlinked_credited(a).join(single, "artist_credit", "left_semi")
    masters = b_ids(b.release_group_link, "gid", "master_id").join(b.master.select(F.col("id").alias("master_id")), "master_id", "left_semi")
    left = (
        a.release_group_link.filter("edits_pending = 0").select("id", "gid", "name").distinct()
        .join(a.release_group.select("id", "artist_credit"), "id")
        .join(people, "artist_credit")
        .join(masters, "gid")
        .select("artist_gid", "gid", "name", "master_id", name_key("artist_name").alias("_name"))
        .repartition("master_id", "_name").distinct()
    )
    right = b.masters_artists.select("master_id", "artist_name", numbered_name_key("artist_name").alias("_name"))
    note = text('Linked Release Group "', F.col("name"), f'" {sites.a("release-group")}', F.col("gid"), " points to same artist")
    return _branch(left.join(right, ["master_id", "_name"]), "artist_gid", "artist_name", note, W_CREDIT)


def relations(a: Catalog, kind: str) -> DataFrame:
    """Artist relationships of a kind: (id0, gid0, name0, id1, gid1, name1)."""
    types = a.link_type.filter(F.col("name") == kind).select(F.col("id").alias("link_type"))
    links = a.link.join(types, "link_type").select(F.col("id").alias("link"))
    edges = a.l_artist_artist.join(links, "link", "left_semi").select("entity0", "entity1")

    def side(n: int) -> DataFrame:
        return a.artist.select(F.col("id").alias(f"entity{n}"), F.col("gid").alias(f"gid{n}"), F.col("name").alias(f"name{n}"))

    both = edges.join(side(0), "entity0").join(side(1), "entity1")
    return both.select(F.col("entity0").alias("id0"), "gid0", "name0", F.col("entity1").alias("id1"), "gid1", "name1")


def relations_linked(a: Catalog, kind: str, first: bool, second: bool) -> DataFrame:
    """Relationships whose first and second artist are linked (or not) as asked."""
    rows = artist_relations(a).filter((F.col("kind") == kind) & (F.col("linked0") == first) & (F.col("linked1") == second))
    return rows.select("id0", "gid0", "name0", "id1", "gid1", "name1")


def b_artists_of(b: Catalog, gid: str, *columns: str) -> DataFrame:
    """Linked artists: gid, link address and the asked columns of their catalog B record."""
    link = b.artist_link.select(F.col("gid").alias(gid), "id", F.col("url").alias("link_url"))
    return link.join(b.artist.select("id", *columns), "id").drop("id")


@_once
def by_band_member(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """The band is linked and its record lists a member of the same name."""
    left = relations_linked(a, MEMBER_OF_BAND, False, True).withColumn("_name", name_key("name0"))
    right = b_artists_of(b, "gid1", "members").select("gid1", F.explode("members").alias("member"))
    right = right.select("gid1", "member", numbered_name_key("member").alias("_name")).distinct()
    note = text(F.col("name0"), " is member of band ", F.col("name1"), f" {sites.a('artist')}", F.col("gid1"),
                f" that is linked to {sites.b_name}, linked band has member with name match.")
    return _branch(left.join(right, ["gid1", "_name"]), "gid0", "member", note, W_RELATION)


@_once
def by_member_band(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """A member is linked and their record lists a group of the same name."""
    left = relations_linked(a, MEMBER_OF_BAND, True, False).withColumn("_name", name_key("name1"))
    right = b_artists_of(b, "gid0", "groups").select("gid0", "link_url", F.explode("groups").alias("band"))
    right = right.select("gid0", "link_url", "band", numbered_name_key("band").alias("_name")).distinct()
    note = text(F.col("name1"), " member ", F.col("name0"), f" is linked to {sites.b_name}, linked {sites.b_name} artist ", F.col("link_url"),
                " is member of band with name match.")
    return _branch(left.join(right, ["gid0", "_name"]), "gid1", "band", note, W_RELATION)


def by_shared_urls(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """Same name and common addresses in both profiles."""
    left = (
        unlinked(a.artist.select("id", "gid", "name"), a.artist_link)
        .join(a.l_artist_url.select(F.col("entity0").alias("id"), F.col("entity1").alias("url_id")), "id")
        .join(a.url.select(F.col("id").alias("url_id"), "url"), "url_id")
        .select("gid", "name", "url", name_key("name").alias("_name"))
    )
    right = b.artist.select(F.col("name").alias("b_name"), numbered_name_key("name").alias("_name"), F.explode(F.array_distinct("urls")).alias("url"))
    pairs = left.join(right, ["_name", "url"]).groupBy("gid", "name", "b_name").agg(
        joined_text("url", ", ").alias("shared"), F.count("url").alias("n"))
    return _branch(pairs, "gid", "b_name", text("Both profiles point to following url(s): ", F.col("shared")), F.col("n") * W_URL)


@_once
def by_real_name(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """The performance name is linked; its record has the person as alias and as real name."""
    left = relations_linked(a, IS_PERSON, False, True)
    right = b_artists_of(b, "gid1", "aliases", "realname")
    hit = left.join(right, (left.gid1 == right.gid1) & (left.name0 == right.realname)).filter(F.array_contains("aliases", F.col("name0"))).drop(right.gid1)
    note = text(F.col("name0"), " perform as ", F.col("name1"), f" {sites.a('artist')}", F.col("gid1"),
                f" that is linked to {sites.b_name}. {sites.b_name} artist points to artist with same realname")
    return _branch(hit, "gid0", "name0", note, W_RELATION)


@_once
def by_performer_name(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """The person is linked; their record has the performance name as alias."""
    left = relations_linked(a, IS_PERSON, True, False)
    right = b_artists_of(b, "gid0", "aliases").select("gid0", F.explode("aliases").alias("name1")).distinct()
    note = text(F.col("name1"), " is performer name of ", F.col("name0"), f" {sites.a('artist')}", F.col("gid0"),
                f" that is linked to {sites.b_name}. {sites.b_name} artist points to artist with same performer name")
    return _branch(left.join(right, ["gid0", "name1"]), "gid1", "name1", note, W_RELATION)


def by_shared_titles(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """Two or more release titles in common, among releases without any linked artist."""
    # the hash leads, so that rows are sorted by a number and not by names that begin alike
    keys, key = ["_key", "_name", "_title"], F.xxhash64("_name", "_title").alias("_key")
    people = credited(a).filter(F.col("artist") != SPECIAL_ARTIST)
    claimed = people.filter("artist_linked").select("artist_credit").distinct()
    people = people.join(claimed, "artist_credit", "left_anti").select("artist_credit", F.col("artist_gid").alias("gid"), "artist_name")
    # releases are counted per credit, so that only artists with enough of them meet their titles
    counts = people.join(a.release.groupBy("artist_credit").agg(F.count(F.lit(1)).alias("n")), "artist_credit")
    enough = counts.groupBy("gid", "artist_name").agg(F.sum("n").alias("n")).filter("n >= 2")
    left = (
        a.release.select("name", "artist_credit").join(people.join(enough, ["gid", "artist_name"], "left_semi"), "artist_credit")
        .select("gid", name_key("name").alias("_title"), name_key("artist_name").alias("_name"))
        .select("gid", key, "_name", "_title").repartition(*keys).distinct()
    )
    right = (
        b.releases_artists.select("release_id", "artist_name")
        .join(b.release.select(F.col("id").alias("release_id"), "title"), "release_id")
        .select(numbered_name_key("artist_name").alias("_name"), name_key("title").alias("_title"), "artist_name", "title")
        .select(key, "_name", "_title", "artist_name", "title")
    )
    # equal rows are dropped on the left, so no title multiplies, and per artist in the set
    shared = left.join(right, keys).select("gid", encode_name("artist_name").alias("url"), "title").repartition("gid", "url")
    per = shared.groupBy("gid", "url").agg(F.sort_array(F.collect_set("title")).alias("titles"))
    per = per.select("gid", "url", F.array_join("titles", ", ").alias("titles"), F.size("titles").cast("bigint").alias("n")).filter("n >= 2")
    return per.select("gid", "url", text("Both profiles have following releases: ", F.col("titles")).alias("note"), (F.col("n") * W_TITLE).alias("score"))


BRANCHES = {
    "linked_release": by_linked_release,
    "linked_release_group": by_linked_release_group,
    "band_member": by_band_member,
    "shared_urls": by_shared_urls,
    "member_band": by_member_band,
    "real_name": by_real_name,
    "performer_name": by_performer_name,
    "shared_titles": by_shared_titles,
}


def evidence_union(branches: list[DataFrame]) -> DataFrame:
    """All branches, equal rows once; they lie by (gid, url), so that these can be put together where they are."""
    out = branches[0].select("gid", "url", "note", "score")
    for df in branches[1:]:
        out = out.unionByName(df.select("gid", "url", "note", "score"))
    return out.repartition("gid", "url").distinct()


def artist_evidence(a: Catalog, b: Catalog, sites: Sites, tracks: DataFrame, credits: DataFrame) -> DataFrame:
    """All evidence per (gid, url): the notes and the total score.

    ``tracks`` and ``credits`` are the (stored) outcomes of :func:`track_evidence` and
    :func:`release_credit_evidence`.
    """
    rows = evidence_union([getattr(f, "rows", f)(a, b, sites) for f in BRANCHES.values()] + [track_summary(tracks), release_credit_summary(credits)])
    totals = rows.groupBy("gid", "url").agg(joined_text("note", "\n").alias("notes"), F.sum("score").alias("score"))
    return totals.select("gid", "url", text(f"Found {sites.b_name} Artist with name match.\n", F.col("notes")).alias("note"), "score")


