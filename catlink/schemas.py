"""Column lists of the source tables, as DDL strings for explicit read schemas."""

from __future__ import annotations

# Resolved links of catalog A, as stored next to catalog B.
LINKS = "gid string, name string, url string, id bigint, edits_pending int"
_EDGE = "id bigint, entity0 bigint, entity1 bigint, link int, edits_pending int"

A_TABLES = {
    "artist": "id bigint, gid string, name string, comment string, country int, type int, gender int, "
    "begin_date_year int, begin_date_month int, begin_date_day int, end_date_year int, end_date_month int, end_date_day int",
    "artist_credit": "id bigint, artist_count int, name string",
    "artist_credit_name": "artist_credit bigint, artist bigint, name string",
    "release": "id bigint, gid string, name string, artist_credit bigint, release_group bigint, barcode string, country int, "
    "date_year int, date_month int, date_day int, status int, quality int, packaging int, language int, script int",
    "release_meta": "id bigint, amazon_asin string, cover_art_presence string",
    "release_group": "id bigint, gid string, name string, artist_credit bigint, type int",
    "release_group_meta": "id bigint, first_release_date_year int",
    "medium": "id bigint, release bigint, tracklist bigint, format int, position int",
    "tracklist": "id bigint, track_count int",
    "track": "id bigint, tracklist bigint, recording bigint, name string, position int, number string, length int, artist_credit bigint",
    "recording": "id bigint, gid string, name string, length int, artist_credit bigint",
    "work": "id bigint, gid string, name string",
    "label": "id bigint, gid string, name string",
    "release_label": "release bigint, label bigint, catalog_number string",
    "url": "id bigint, url string",
    "link": "id int, link_type int",
    "link_type": "id int, name string, link_phrase string",
    "link_attribute": "link int, attribute_type int",
    "link_attribute_type": "id int, root int, name string",
    "link_type_attribute_type": "link_type int, attribute_type int",
    "country": "id int, iso_code string, name string",
    "tag": "id bigint, name string",
    "artist_tag": "artist bigint, tag bigint",
    "release_group_secondary_type_join": "release_group bigint, secondary_type int",
    **{n: "id int, name string" for n in (
        "release_group_type", "release_group_primary_type", "release_group_secondary_type", "release_status", "release_packaging",
        "medium_format", "language", "script")},
    **{f"l_{a}_{b}": _EDGE for a, b in (
        ("artist", "artist"), ("artist", "release"), ("artist", "recording"), ("artist", "work"), ("recording", "work"),
        ("artist", "url"), ("label", "url"), ("release", "url"), ("release_group", "url"))},
}

B_TABLES = {
    "artist": "id bigint, name string, realname string, profile string, data_quality string, "
    "aliases array<string>, groups array<string>, members array<string>, urls array<string>",
    "label": "id bigint, name string",
    "master": "id bigint, title string, year int",
    "masters_artists": "master_id bigint, artist_id bigint, artist_name string",
    "release": "id bigint, title string, released string, country string, master_id bigint, notes string, data_quality string, "
    "genres array<string>, styles array<string>",
    "releases_artists": "release_id bigint, artist_id bigint, artist_name string, anv string",
    "releases_extraartists": "release_id bigint, artist_id bigint, artist_name string, anv string, role_name string, "
    "role_details string, roles array<string>, tracks string",
    "releases_labels": "release_id bigint, label string, catno string",
    "releases_formats": "release_id bigint, format_name string, qty int, descriptions array<string>, text string",
    "release_identifier": "release_id bigint, type string, value string, description string",
    "track": "id bigint, release_id bigint, position string, title string, duration string",
    "tracks_artists": "track_id bigint, artist_id bigint, artist_name string, anv string",
    "tracks_extraartists": "track_id bigint, artist_id bigint, artist_name string, anv string, role_name string, role_details string",
    "releases_images": "release_id bigint, image_id bigint",
    "image": "id bigint, uri string, type string, height int, width int",
}

UPDATE_LOG = "id bigint, updated string, event string, timest timestamp"

# Role dictionary: twelve tab-separated columns without header.
ROLES = (
    "credit string, has_page string, category string, subcategory string, description string, role_id int, "
    "release_link_type int, release_link_type_name string, link_attribute int, link_attribute_name string, "
    "recording_link_type int, extra string"
)

ALBUM = (
    "_id string, cdbaby_id string, title string, artist string, artist_cdbaby_id string, artist_mbid string, mbid string, "
    "type string, barcode string, date string, label string, "
    "mediums array<struct<position:int,format:string,tracks:array<struct<position:int,title:string,length:int>>>>, "
    "status struct<imported:boolean,added:timestamp>"
)

FEED_ITEM = (
    "`itms:artist` string, `itms:artistLink` string, `itms:album` string, `itms:albumLink` string, `itms:releasedate` string"
)
