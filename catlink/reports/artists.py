"""Artists of a release of catalog B and their credits, by how they are linked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from catlink.config import Catalog, Sites
from catlink.functions.urls import encode_name
from catlink.operators.evidence import text
from catlink.operators.keys import joined_text


def release_artist_rows(b: Catalog, releases: DataFrame | None = None) -> DataFrame:
    """All artist mentions (release_id, artist_id, artist_name, anv, role_name, role_details, track_id, tracks); rows may repeat."""
    null = F.lit(None).cast("string")
    tracks = b.track.select(F.col("id").alias("track_id"), "release_id", F.col("position").alias("tracks"))
    base = ["release_id", "artist_id", "artist_name", "anv"]
    role = ["role_name", "role_details"]
    no_role = [null.alias(c) for c in role]
    no_track = F.lit(None).cast("bigint").alias("track_id")
    people = ["track_id", *base[1:]]
    on_tracks = b.tracks_extraartists.select(*people, *role).unionByName(b.tracks_artists.select(*people, *no_role))
    parts = [
        tracks.join(on_tracks, "track_id").select(*base, *role, "track_id", "tracks"),
        b.releases_artists.select(*base, *no_role, no_track, null.alias("tracks")),
        b.releases_extraartists.select(*base, *role, no_track, "tracks"),
    ]
    if releases is not None:
        wanted = releases.select(F.col("id").alias("release_id")).distinct()
        parts = [p.join(wanted, "release_id", "left_semi") for p in parts]
    return reduce(DataFrame.unionByName, parts)


def release_artists(b: Catalog, roles: DataFrame, sites: Sites, releases: DataFrame | None = None) -> DataFrame:
    """(release_id, note): linked, multi-linked and unlinked artists of each release with their credits.

    Mentions meet the links of their artist, then are dealt by release once; everything after that stays in place.
    """
    links = b.artist_link.select(F.col("id").alias("artist_id"), text("\t", F.col("name"), " " + sites.a("artist"), F.col("gid")).alias("a_line"))
    links = links.filter("artist_id IS NOT NULL").groupBy("artist_id").agg(F.sort_array(F.collect_list("a_line")).alias("a_list"), F.count(F.lit(1)).alias("n_links"))
    rows = release_artist_rows(b, releases).join(links, "artist_id", "left").repartition("release_id").distinct()
    kinds = roles.select(F.col("credit").alias("role_name"), "release_link_type_name", "link_attribute_name")
    no_role = F.col("role_name").isNull() & F.col("role_details").isNull()
    line = text(
        "\t", F.coalesce("role_name", F.lit("")),
        F.when(F.col("role_details").isNull(), "").otherwise(text(" [", F.col("role_details"), "]")),
        F.when(no_role & F.col("tracks").isNull(), "Release - ").when(no_role, "Track - ").otherwise(" - "),
        F.when(F.col("anv").isNull() | (F.col("anv") == ""), F.col("artist_name")).otherwise(F.col("anv")),
        F.when(F.col("tracks").isNull() | (F.col("tracks") == ""), "").otherwise(text(" (tracks: ", F.col("tracks"), ")")),
        F.when(F.col("release_link_type_name").isNull(), "").otherwise(text(f" --{sites.a_name}--> ", F.col("release_link_type_name"))),
        F.when(F.col("link_attribute_name").isNull(), "").otherwise(text(" [", F.col("link_attribute_name"), "]")),
    )
    # the credits of an artist stand under each of its names, and are repeated once per link
    credits = rows.join(kinds, "role_name", "left").groupBy("release_id", "artist_id").agg(
        joined_text(line, "\n").alias("credits"), F.collect_set("artist_name").alias("names"),
        F.first("a_list", ignorenulls=True).alias("a_list"), F.greatest(F.max("n_links"), F.lit(1)).cast("int").alias("times"))
    credits = credits.withColumn("credits", F.when(F.col("artist_id").isNotNull(), F.col("credits")))
    art = (
        credits.withColumn("artist_name", F.explode("names"))
        .groupBy("release_id", "artist_name")
        .agg(F.sort_array(F.flatten(F.collect_list("a_list"))).alias("a_lists"),
             F.array_join(F.sort_array(F.flatten(F.collect_list(F.when(F.col("credits").isNotNull(), F.array_repeat("credits", F.col("times")))))), "\n").alias("credits"),
             F.count("credits").alias("n_credits"))
        .withColumns({"n": F.size("a_lists"), "a_lines": F.array_join("a_lists", "\n"), "credits": F.when(F.col("n_credits") > 0, F.col("credits"))})
        .withColumn("b_line", text(F.col("artist_name"), " " + sites.b("artist"), encode_name("artist_name")))
    )
    block = F.when(F.col("n") > 0, text(F.col("b_line"), "\n", F.col("a_lines"), "\n", F.col("credits"))).otherwise(
        text(F.col("b_line"), "\n", F.col("credits")))
    group = F.when(F.col("n") == 1, "linked").when(F.col("n") > 1, "multi").otherwise("unlinked")
    sections = art.select("release_id", group.alias("g"), block.alias("block")).withColumns(
        {g: F.when(F.col("g") == g, F.col("block")) for g in ("linked", "multi", "unlinked")})
    per = sections.groupBy("release_id").agg(*[joined_text(g, "\n").alias(g) for g in ("linked", "multi", "unlinked")])
    base = b.release.select(F.col("id").alias("release_id"))
    if releases is not None:
        base = base.join(releases.select(F.col("id").alias("release_id")).distinct(), "release_id", "left_semi")

    def part(c: str):
        return F.coalesce(F.col(c), F.lit(""))

    note = text("Linked artists:\n", part("linked"), "\n\nMulti-linked artists:\n", part("multi"), "\n\nUnlinked artists:\n", part("unlinked"))
    return base.join(per, "release_id", "left").select("release_id", note.alias("note"))
