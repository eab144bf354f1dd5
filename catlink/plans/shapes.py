"""Catalog-shaped views over the driver tables.

Each view is one SELECT in the SQL that Spark and other engines share, so the same data reaches
both sides of a check. Views are put together as common table expressions; nothing is registered
in the session.

Keys: order ``o`` is release ``o`` of catalog A and releases ``2o`` (and, as a reissue, ``2o+1``) of
catalog B; customer ``k`` is artist ``k+1`` of A and ``2k+2`` of B; line items are tracks; every 15th
customer is a label.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_NAME_NO = "CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS STRING)"
_TITLE_NO = "CAST(CASE WHEN o_orderkey % 9 = 8 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING)"
_GROUP_NO = "CAST(CASE WHEN o_orderkey % 15 = 0 THEN 0 ELSE o_orderkey END AS STRING)"
_CAT_NO = "CAST(CASE WHEN o_orderkey % 11 = 10 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING)"
_LABEL_OF = "CAST(floor(o_custkey / 15) AS BIGINT)"
_BARCODE = "lpad(CAST(o_orderkey * 7919 AS STRING), 12, '0')"

VIEWS: dict[str, str] = {}


def _view(name: str, sql: str) -> None:
    VIEWS[name] = " ".join(line.strip() for line in sql.strip().splitlines())


_view("line", """
SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, min(l_suppkey) AS s,
  (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS t
FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey""")

# Catalog A -------------------------------------------------------------------------------------

_view("a_artist", f"""
SELECT c_custkey + 1 AS id, 'a-' || CAST(c_custkey AS STRING) AS gid, 'Artist ' || {_NAME_NO} AS name,
  CASE c_custkey % 6 WHEN 0 THEN 'american singer' WHEN 1 THEN 'UK band' WHEN 2 THEN 'unknown dj crew'
    WHEN 3 THEN 'Nation_3 jazz trio' WHEN 4 THEN 'pop/rock composer' END AS comment,
  CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS country,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 3 AS INT) END AS type,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(1 + c_custkey % 2 AS INT) END AS gender,
  CASE WHEN c_custkey % 7 = 0 THEN CAST(1950 + c_custkey % 50 AS INT) END AS begin_date_year,
  CAST(NULL AS INT) AS begin_date_month, CAST(NULL AS INT) AS begin_date_day,
  CAST(NULL AS INT) AS end_date_year, CAST(NULL AS INT) AS end_date_month, CAST(NULL AS INT) AS end_date_day
FROM customer""")
_view("a_artist_credit", """
SELECT 2 * id - 1 AS id, 1 AS artist_count, name FROM a_artist
UNION ALL SELECT 2 * id, 2, name || ' & Friend' FROM a_artist WHERE id % 7 = 1""")
_view("a_artist_credit_name", """
SELECT 2 * id - 1 AS artist_credit, id AS artist, name FROM a_artist
UNION ALL SELECT 2 * id, id, name FROM a_artist WHERE id % 7 = 1
UNION ALL SELECT 2 * id, id + 1, 'Friend' FROM a_artist WHERE id % 7 = 1""")
_view("a_release", f"""
SELECT o_orderkey AS id, 'r-' || CAST(o_orderkey AS STRING) AS gid, 'Title ' || {_TITLE_NO} AS name,
  CASE WHEN o_custkey % 7 = 0 AND o_orderkey % 3 = 0 THEN 2 * o_custkey + 2 ELSE 2 * o_custkey + 1 END AS artist_credit,
  o_orderkey - o_orderkey % 3 AS release_group,
  CASE WHEN o_orderkey % 5 = 0 THEN {_BARCODE} END AS barcode,
  CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_custkey % 25 AS INT) END AS country,
  CASE WHEN o_orderkey % 23 <> 0 THEN CAST(year(o_orderdate) AS INT) END AS date_year,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(month(o_orderdate) AS INT) END AS date_month,
  CASE WHEN o_orderkey % 8 <> 0 THEN CAST(day(o_orderdate) AS INT) END AS date_day,
  CAST(1 + o_orderkey % 3 AS INT) AS status, CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE CAST(o_orderkey % 3 AS INT) END AS quality,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(1 + o_orderkey % 2 AS INT) END AS packaging,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS language, CASE WHEN o_orderkey % 3 = 0 THEN 1 END AS script
FROM orders""")
_view("a_release_meta", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 18 = 0 THEN 'B' || CAST(o_orderkey AS STRING) END AS amazon_asin,
  CASE WHEN o_orderkey % 5 = 0 THEN 'present' ELSE 'absent' END AS cover_art_presence FROM orders""")
_view("a_release_group", f"""
SELECT o_orderkey AS id, 'g-' || CAST(o_orderkey AS STRING) AS gid, 'Group ' || {_GROUP_NO} AS name,
  2 * o_custkey + 1 AS artist_credit, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(1 + o_orderkey % 5 AS INT) END AS type
FROM orders WHERE o_orderkey % 3 = 0""")
_view("a_release_group_meta", """
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INT) AS first_release_date_year FROM orders WHERE o_orderkey % 3 = 0""")
_view("a_medium", """
SELECT 2 * o_orderkey AS id, o_orderkey AS release, 2 * o_orderkey AS tracklist,
  CASE o_orderkey % 8 WHEN 0 THEN 7 WHEN 4 THEN 31 WHEN 1 THEN 29 WHEN 5 THEN 29 WHEN 2 THEN 1 WHEN 6 THEN 1 END AS format, 1 AS position FROM orders
UNION ALL SELECT 2 * o_orderkey + 1, o_orderkey, 2 * o_orderkey + 1, CAST(NULL AS INT), 2 FROM orders WHERE o_orderkey % 10 IN (5, 6)""")
_view("a_track", """
SELECT t AS id, 2 * o + CASE WHEN o % 10 = 5 AND n > 4 THEN 1 ELSE 0 END AS tracklist, t AS recording,
  'Track ' || CAST(p AS STRING) AS name, n AS position, CAST(n AS STRING) AS number,
  CAST(1000 * (120 + p % 200) AS INT) AS length, 2 * s + 1 AS artist_credit FROM line""")
_view("a_recording", """
SELECT t AS id, 't-' || CAST(t AS STRING) AS gid,
  'Track ' || CAST(p AS STRING) || CASE WHEN p % 13 = 0 THEN ' (live)' ELSE '' END AS name,
  CAST(1000 * (120 + p % 200) AS INT) AS length, 2 * s + 1 AS artist_credit FROM line""")
_view("a_tracklist", "SELECT tracklist AS id, CAST(count(*) AS INT) AS track_count FROM a_track GROUP BY tracklist")
_view("a_work", "SELECT p_partkey AS id, 'w-' || CAST(p_partkey AS STRING) AS gid, 'Work ' || p_name AS name FROM part WHERE p_partkey % 4 = 0")
_view("a_l_recording_work", "SELECT t AS id, t AS entity0, p AS entity1, 2780 AS link, 0 AS edits_pending FROM line WHERE p % 4 = 0")
_view("a_label", """
SELECT CAST(floor(c_custkey / 15) AS BIGINT) + 1 AS id, 'l-' || CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS STRING) AS gid,
  'Label ' || CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS STRING) AS name FROM customer WHERE c_custkey % 15 = 0""")
_view("a_release_label", f"""
SELECT o_orderkey AS release, {_LABEL_OF} + 1 AS label, CASE WHEN o_orderkey % 21 <> 0 THEN 'CAT ' || {_CAT_NO} END AS catalog_number FROM orders
UNION ALL SELECT o_orderkey, {_LABEL_OF} + 2, 'CAT ' || {_CAT_NO} FROM orders WHERE o_orderkey % 13 = 0""")
_view("a_country", """
SELECT n_nationkey AS id, n_name AS name,
  CASE n_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'FR' WHEN 3 THEN 'KR' WHEN 4 THEN 'RU' WHEN 5 THEN 'JP'
    ELSE 'N' || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', n_nationkey + 1, 1) END AS iso_code FROM nation""")
_view("a_url", """
SELECT 16 * o_orderkey + 1 AS id, 'http://b.example/release/' || CAST(2 * o_orderkey AS STRING) AS url FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT 16 * o_orderkey + 2, 'http://b.example/release/' || CAST(2 * o_orderkey + 1 AS STRING) FROM orders WHERE o_orderkey % 8 = 0
UNION ALL SELECT 16 * o_orderkey + 3, 'http://b.example/master/' || CAST(o_orderkey AS STRING) FROM orders WHERE o_orderkey % 12 = 0
UNION ALL SELECT 16 * id + 4, 'http://b.example/artist/' || replace(name, ' ', '+')
  || CASE WHEN id % 4 = 1 THEN '+(' || CAST(2 + (id - 1) % 3 AS STRING) || ')' ELSE '' END FROM a_artist WHERE id % 3 = 1
UNION ALL SELECT 16 * id + 5, 'http://b.example/label/' || replace(name, ' ', '+') FROM a_label WHERE id % 2 = 1
UNION ALL SELECT 16 * id + 6, 'http://home.example/' || CAST(id - 1 AS STRING) FROM a_artist WHERE id % 2 = 0
UNION ALL SELECT 16 * id + 7, 'http://en.wikipedia.org/wiki/' || replace(name, ' ', '_') FROM a_artist WHERE id % 8 = 2
UNION ALL SELECT 16 * o_orderkey + 8, 'http://www.encyclopedisque.fr/images/' || CAST(o_orderkey AS STRING) FROM orders WHERE o_orderkey % 10 = 7
UNION ALL SELECT 16 * id + 9, CASE WHEN id % 2 = 0 THEN 'http://rateyourmusic.com/artist/' ELSE 'http://elsewhere.example/' END || CAST(id AS STRING) FROM a_artist WHERE id % 9 = 3
UNION ALL SELECT 16 * id + 10, CASE WHEN id % 30 = 0 THEN 'http://en.wikipedia.org/wiki/Group_' ELSE 'http://fr.wikipedia.org/wiki/Group_' END || CAST(id AS STRING) FROM a_release_group WHERE id % 15 = 0
UNION ALL SELECT 16 * id + 11, 'http://en.wikipedia.org/wiki/Label_' || CAST(id AS STRING) FROM a_label WHERE id % 4 = 1
UNION ALL SELECT 16 * id + 12, 'http://b.example/artist/Gone+%zz+' || CAST(id AS STRING) FROM a_artist WHERE id % 30 = 2""")
_view("a_l_release_url", """
SELECT id, CAST(floor(id / 16) AS BIGINT) AS entity0, id AS entity1, CASE WHEN id % 16 = 8 THEN 7800 ELSE 6301 END AS link,
  CASE WHEN id % 11 = 0 THEN 1 ELSE 0 END AS edits_pending FROM a_url WHERE id % 16 IN (1, 2, 8)
UNION ALL SELECT id + 7, CAST(floor(id / 16) AS BIGINT) + 1, id, 7800, 0 FROM a_url WHERE id % 16 = 8 AND id % 3 = 0""")
_view("a_l_release_group_url", """
SELECT id, CAST(floor(id / 16) AS BIGINT) AS entity0, id AS entity1, CASE WHEN id % 16 = 3 THEN 6309 ELSE 8900 END AS link,
  CASE WHEN id % 13 = 0 THEN 1 ELSE 0 END AS edits_pending FROM a_url WHERE id % 16 IN (3, 10)""")
_view("a_l_artist_url", """
SELECT id, CAST(floor(id / 16) AS BIGINT) AS entity0, id AS entity1,
  CASE id % 16 WHEN 4 THEN 26038 WHEN 12 THEN 26038 WHEN 6 THEN 26100 WHEN 7 THEN 17900 ELSE 26043 END AS link,
  CASE WHEN id % 13 = 0 THEN 1 ELSE 0 END AS edits_pending FROM a_url WHERE id % 16 IN (4, 6, 7, 9, 12)""")
_view("a_l_label_url", """
SELECT id, CAST(floor(id / 16) AS BIGINT) AS entity0, id AS entity1, CASE WHEN id % 16 = 5 THEN 27037 ELSE 21600 END AS link,
  0 AS edits_pending FROM a_url WHERE id % 16 IN (5, 11)""")
_view("a_link", """
SELECT * FROM (VALUES (6301, 76), (6309, 90), (26038, 180), (27037, 217), (7800, 78), (17900, 179), (8900, 89), (21600, 216),
  (26043, 185), (26100, 183), (1030, 103), (1080, 108), (300, 30), (301, 31), (601, 60), (1530, 153), (2780, 278)) AS v(id, link_type)""")
_view("a_link_type", """
SELECT * FROM (VALUES (103, 'member of band', 'member of'), (108, 'is person', 'performs as'), (30, 'producer', '{additional} {co:co-}produced'),
  (31, 'engineer', 'engineered'), (60, 'vocal', '{vocal:%|vocals}'), (153, 'remixer', 'remixed')) AS v(id, name, link_phrase)""")
_view("a_link_attribute_type", """
SELECT * FROM (VALUES (1, 1, 'additional'), (2, 2, 'co'), (3, 3, 'vocal'), (4, 3, 'lead vocals'), (5, 3, 'alto vocals')) AS v(id, root, name)""")
_view("a_link_type_attribute_type", "SELECT * FROM (VALUES (30, 1), (30, 2), (60, 3)) AS v(link_type, attribute_type)")
_view("a_link_attribute", "SELECT * FROM (VALUES (300, 1), (601, 5), (601, 4)) AS v(link, attribute_type)")
_view("a_l_artist_artist", """
SELECT 4 * id AS id, id AS entity0, id + 5 AS entity1, 1030 AS link, 0 AS edits_pending FROM a_artist WHERE id % 2 = 1
UNION ALL SELECT 4 * id + 1, id, id + 6, 1030, 0 FROM a_artist WHERE id % 4 = 2
UNION ALL SELECT 4 * id + 2, id + 1, id, 1080, 0 FROM a_artist WHERE id % 5 < 3""")
_view("a_l_artist_release", """
SELECT t AS id, s + 1 AS entity0, o AS entity1, CASE p % 3 WHEN 0 THEN 300 WHEN 1 THEN 601 ELSE 301 END AS link, 0 AS edits_pending
FROM line WHERE n <= 3 AND p % 2 = 0""")
_view("a_l_artist_recording", "SELECT t AS id, s + 1 AS entity0, t AS entity1, 1530 AS link, 0 AS edits_pending FROM line WHERE p % 12 = 0")
_view("a_l_artist_work", "SELECT p_partkey AS id, 1 + p_partkey % 7 AS entity0, p_partkey AS entity1, 301 AS link, 0 AS edits_pending FROM part WHERE p_partkey % 8 = 0")
_view("a_tag", "SELECT * FROM (VALUES (1, 'improper b link'), (2, 'rock')) AS v(id, name)")
_view("a_artist_tag", "SELECT id AS artist, CASE WHEN id % 12 = 0 THEN 1 ELSE 2 END AS tag FROM a_artist WHERE id % 6 = 0")
_view("a_release_group_type", "SELECT * FROM (VALUES (1, 'Album'), (2, 'Single'), (3, 'EP'), (4, 'Soundtrack'), (5, 'Interview')) AS v(id, name)")
_view("a_release_group_primary_type", "SELECT id, name FROM a_release_group_type")
_view("a_release_group_secondary_type", "SELECT * FROM (VALUES (1, 'Live'), (2, 'Remix')) AS v(id, name)")
_view("a_release_group_secondary_type_join", """
SELECT id AS release_group, 1 AS secondary_type FROM a_release_group WHERE id % 2 = 0
UNION ALL SELECT id, 2 FROM a_release_group WHERE id % 6 = 0""")
_view("a_release_status", "SELECT * FROM (VALUES (1, 'Official'), (2, 'Promotion'), (3, 'Bootleg')) AS v(id, name)")
_view("a_release_packaging", "SELECT * FROM (VALUES (1, 'Jewel Case'), (2, 'Digipak')) AS v(id, name)")
_view("a_medium_format", "SELECT * FROM (VALUES (1, 'CD'), (7, 'Vinyl'), (29, '7\" Vinyl'), (31, '12\" Vinyl')) AS v(id, name)")
_view("a_language", "SELECT * FROM (VALUES (1, 'English')) AS v(id, name)")
_view("a_script", "SELECT * FROM (VALUES (1, 'Latin')) AS v(id, name)")

# Catalog B -------------------------------------------------------------------------------------

_view("b_artist", f"""
SELECT 2 * c_custkey + 2 AS id,
  'ARTIST ' || {_NAME_NO} || CASE WHEN c_custkey % 4 = 0 THEN ' (' || CAST(2 + c_custkey % 3 AS STRING) || ')' ELSE '' END AS name,
  CASE c_custkey % 6 WHEN 0 THEN 'ARTIST ' || {_NAME_NO} WHEN 3 THEN 'Artist ' || CAST(c_custkey + 1 AS STRING) ELSE 'Somebody' END AS realname,
  CASE c_custkey % 5 WHEN 0 THEN 'American rock artist. Born long ago.' WHEN 1 THEN 'Nation_1 based duo' WHEN 2 THEN 'Who? Nobody knows.'
    WHEN 3 THEN 'nation-born artist' END AS profile,
  'Correct' AS data_quality,
  split('ARTIST ' || CAST(c_custkey + 3 AS STRING) || ',Artist ' || CAST(c_custkey + 1 AS STRING) || ',Artist ' || CAST(c_custkey - 1 AS STRING), ',') AS aliases,
  split('ARTIST ' || CAST(c_custkey + 5 AS STRING) || ',ARTIST ' || CAST(c_custkey + 6 AS STRING), ',') AS groups,
  split('Artist ' || CAST(c_custkey - 5 AS STRING) || ' (2),ARTIST ' || CAST(c_custkey - 6 AS STRING), ',') AS members,
  split('http://home.example/' || CAST(c_custkey AS STRING) || ',http://fan.example/' || CAST(c_custkey AS STRING), ',') AS urls
FROM customer""")
_view("b_base", """
SELECT 2 * o_orderkey AS id, o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey % 3 <> 1
UNION ALL SELECT 2 * o_orderkey + 1, o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 32 = 0 THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END FROM orders WHERE o_orderkey % 16 = 0 OR o_orderkey % 17 = 0""")
_view("b_release", f"""
SELECT id, CASE WHEN o_orderkey % 7 < 5 THEN 'TITLE ' ELSE 'Other ' END || {_TITLE_NO} AS title,
  CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE CAST(year(o_orderdate) AS STRING) || '-01-01' END AS released,
  CASE o_custkey % 25 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 3 THEN 'South Korea' WHEN 4 THEN 'Russia'
    ELSE 'NATION_' || CAST(o_custkey % 25 AS STRING) END AS country,
  CASE WHEN o_orderkey % 5 <> 4 THEN o_orderkey - o_orderkey % 3 END AS master_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Notes on ' || CAST(o_orderkey AS STRING) END AS notes, 'Correct' AS data_quality,
  split('Rock,Pop', ',') AS genres, split('Indie', ',') AS styles FROM b_base""")
_view("b_label", """
SELECT 2 * id AS id, CASE WHEN id % 3 = 0 THEN upper(name) ELSE name END AS name FROM a_label""")
_view("b_releases_labels", f"""
SELECT b.id AS release_id, l.name AS label, 'cat' || {_CAT_NO} AS catno, l.id AS label_id
FROM b_base AS b JOIN b_label AS l ON l.id = 2 * ({_LABEL_OF} + 1)""")
_view("b_master", f"""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'GROUP ' ELSE 'Other group ' END || {_GROUP_NO} AS title,
  CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE o_orderkey % 3 = 0""")
_view("b_masters_artists", """
SELECT o.o_orderkey AS master_id, b.id AS artist_id, b.name AS artist_name
FROM orders AS o JOIN b_artist AS b ON b.id = 2 * o.o_custkey + 2 WHERE o.o_orderkey % 3 = 0""")
_view("b_releases_artists", """
SELECT r.id AS release_id, b.id AS artist_id, b.name AS artist_name, CASE WHEN r.id % 5 = 0 THEN 'Aka' ELSE '' END AS anv
FROM b_base AS r JOIN b_artist AS b ON b.id = 2 * r.o_custkey + 2""")
_view("b_track", """
SELECT 2 * t AS id, 2 * o AS release_id, CASE WHEN n = 7 THEN '' ELSE CAST(n AS STRING) END AS position,
  CASE WHEN p % 5 = 0 THEN 'TRACK ' ELSE 'Track ' END || CAST(p AS STRING) AS title,
  CAST(2 + p % 3 AS STRING) || ':' || lpad(CAST(p % 60 AS STRING), 2, '0') AS duration FROM line WHERE o % 3 <> 1
UNION ALL SELECT 2 * t + 1, 2 * o + 1, CASE WHEN n = 7 THEN '' ELSE CAST(n AS STRING) END,
  'Track ' || CAST(p AS STRING), NULL FROM line WHERE o % 16 = 0 OR o % 17 = 0""")
_view("b_tracks_artists", """
SELECT 2 * l.t AS track_id, b.id AS artist_id, b.name AS artist_name, '' AS anv
FROM line AS l JOIN b_artist AS b ON b.id = 2 * l.s + 2 WHERE l.o % 3 <> 1 AND l.n <= 4""")
_view("b_tracks_extraartists", """
SELECT 2 * l.t AS track_id, b.id AS artist_id, b.name AS artist_name, CASE WHEN l.p % 9 = 0 THEN 'Aka' ELSE '' END AS anv,
  CASE l.p % 3 WHEN 0 THEN 'Remix' WHEN 1 THEN 'Producer' ELSE 'Mixed By' END AS role_name,
  CASE WHEN l.p % 15 = 0 THEN 'radio version' END AS role_details
FROM line AS l JOIN b_artist AS b ON b.id = 2 * l.s + 2 WHERE l.o % 3 <> 1 AND l.n >= 4""")
_view("b_releases_extraartists", """
SELECT 2 * l.o AS release_id, b.id AS artist_id, b.name AS artist_name, CASE WHEN l.p % 9 = 0 THEN 'Aka' ELSE '' END AS anv,
  CASE l.p % 3 WHEN 0 THEN 'Producer' WHEN 1 THEN 'Alto Vocals' ELSE 'Mixed By' END AS role_name,
  CASE WHEN l.p % 15 = 0 THEN 'additional' END AS role_details,
  split(CASE l.p % 3 WHEN 0 THEN 'Producer,Engineer' WHEN 1 THEN 'Alto Vocals' ELSE 'Mixed By' END, ',') AS roles,
  CASE l.p % 4 WHEN 0 THEN '1 to 3' WHEN 1 THEN '2, 5' WHEN 2 THEN '' END AS tracks
FROM line AS l JOIN b_artist AS b ON b.id = 2 * l.s + 2 WHERE l.o % 3 <> 1 AND l.n <= 3""")
_view("b_releases_formats", """
SELECT id AS release_id, CASE WHEN o_orderkey % 4 < 2 THEN 'Vinyl' ELSE 'CD' END AS format_name, CAST(1 + o_orderkey % 2 AS INT) AS qty,
  split(CASE o_orderkey % 3 WHEN 0 THEN 'Album' WHEN 1 THEN 'Album,Promo' ELSE 'Unofficial Release' END
    || CASE WHEN o_orderkey % 4 = 0 THEN ',12\"' ELSE '' END, ',') AS descriptions,
  CASE WHEN o_orderkey % 6 = 0 THEN 'Red' ELSE '' END AS text FROM b_base""")
_view("b_format_mapping", """
SELECT * FROM (VALUES ('Vinyl', CAST(NULL AS STRING), 7, 'Vinyl'), ('Vinyl', '7\"', 29, '7\" Vinyl'), ('Vinyl', '12\"', 31, '12\" Vinyl'),
  ('CD', NULL, 1, 'CD')) AS v(format_name, description, format_id, a_name)""")
_view("b_release_identifier", f"""
SELECT id AS release_id, 'Barcode' AS type, {_BARCODE} AS value, CASE WHEN o_orderkey % 20 = 0 THEN 'text' ELSE '' END AS description FROM b_base WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 3
UNION ALL SELECT id, 'Barcode', 'none', CAST(NULL AS STRING) FROM b_base WHERE o_orderkey % 10 = 1
UNION ALL SELECT id, 'Matrix / Runout', 'M' || CAST(o_orderkey AS STRING), 'side A' FROM b_base WHERE o_orderkey % 2 = 0
UNION ALL SELECT id, 'Matrix / Runout', 'N' || CAST(o_orderkey AS STRING), CAST(NULL AS STRING) FROM b_base WHERE o_orderkey % 4 = 0""")
_view("b_raw_identifier", f"""
SELECT id AS release_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Barcode' ELSE 'Other' END AS type,
  CASE o_orderkey % 8 WHEN 0 THEN 'LC 0' || CAST(o_orderkey AS STRING) WHEN 1 THEN '0 12345-' || CAST(o_orderkey AS STRING) || '.5'
    WHEN 2 THEN 'No Barcode' WHEN 3 THEN 'none found' WHEN 4 THEN '4/00>' || {_BARCODE} ELSE 'X-' || CAST(o_orderkey AS STRING) END AS value,
  CASE o_orderkey % 5 WHEN 0 THEN 'Rights Society' WHEN 1 THEN 'Side A Runout' WHEN 2 THEN 'rights societies' WHEN 3 THEN 'other' END AS description
FROM b_base""")
_view("b_image", """
SELECT 2 * o_orderkey AS id, 'R-' || CAST(o_orderkey AS STRING) || '-1.jpg' AS uri, CASE WHEN o_orderkey % 3 = 0 THEN 'primary' ELSE 'secondary' END AS type,
  CAST(300 + o_orderkey % 400 AS INT) AS height, CAST(300 + o_orderkey % 450 AS INT) AS width FROM orders
UNION ALL SELECT 2 * o_orderkey + 1, 'R-' || CAST(o_orderkey AS STRING) || '-2.jpg', CASE WHEN o_orderkey % 24 = 0 THEN 'primary' ELSE 'secondary' END,
  CAST(450 + o_orderkey % 100 AS INT), 600 FROM orders WHERE o_orderkey % 2 = 0""")
_view("b_releases_images", "SELECT id - id % 2 AS release_id, id AS image_id FROM b_image")
_view("roles", """
SELECT * FROM (VALUES ('Producer', 30, 'producer', CAST(NULL AS STRING)), ('Alto Vocals', 60, 'vocal', 'alto vocals'),
  ('Mixed By', CAST(NULL AS INT), NULL, NULL), ('Remix', 153, 'remixer', NULL)) AS v(credit, release_link_type, release_link_type_name, link_attribute_name)""")

# Encyclopedia pages ------------------------------------------------------------------------------

_view("w_artist", """
SELECT doc_id + 3 AS id, 'x-' || CAST(doc_id AS STRING) AS gid,
  CASE WHEN doc_id % 5 = 0 THEN 'Persón Extraordinary ' ELSE 'Persón ' END || CAST(doc_id AS STRING) AS name,
  CASE doc_id % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'US' END AS country, lang FROM documents""")
_view("w_page", """
SELECT CASE WHEN d.doc_id % 9 = 8 THEN 'Other ' || CAST(d.doc_id AS STRING) ELSE a.name END
    || CASE d.doc_id % 4 WHEN 0 THEN ' (musician)' WHEN 2 THEN CASE WHEN d.doc_id % 20 = 2 THEN ' (song)' ELSE '' END ELSE '' END AS title,
  '{{Infobox musical artist <!-- x -->' || chr(10) || '| name = Persón' || chr(10)
    || CASE d.doc_id % 4 WHEN 0 THEN '| origin = [[Paris]], [[France]]' WHEN 1 THEN '| born = [[Lyon|Lyon]], [[France|fr]]' WHEN 2 THEN '| origin = [[Austin, Texas]]' ELSE '| other = 1' END || chr(10)
    || CASE d.doc_id % 5 WHEN 0 THEN '| background = solo_singer' WHEN 1 THEN '| background = group_or_band' ELSE '| background = x' END || chr(10)
    || CASE d.doc_id % 3 WHEN 0 THEN '| birth_date = {{Birth date|1950|' || CAST(1 + d.doc_id % 12 AS STRING) || '|7}}' ELSE '| label = none' END || chr(10)
    || '}}' || chr(10) || 'Persón is from [[' || CASE d.doc_id % 7 WHEN 0 THEN 'France' WHEN 1 THEN 'canada' ELSE 'Nowhere' END || ']].' || chr(10) || chr(10)
    || d.text || chr(10)
    || CASE WHEN d.doc_id % 11 = 0 THEN '{{disambig}}' ELSE '' END
    || CASE d.doc_id % 6 WHEN 0 THEN '[[Category:French male singers|X]]' WHEN 1 THEN '[[Category:Singers from Texas]]' WHEN 2 THEN '[[Category:Female musicians]]' ELSE '' END
    || CASE WHEN d.doc_id % 10 IN (1, 3) THEN '[[Category:Record labels]]' ELSE '' END
    || CASE d.doc_id % 8 WHEN 0 THEN '[[Category:1960 births]]' WHEN 1 THEN '[[Category:Musical groups established in 1970]]' WHEN 2 THEN '[[Category:Rock albums]]' ELSE '' END AS text,
  d.lang AS lang, d.doc_id AS doc_id
FROM documents AS d JOIN w_artist AS a ON a.id = d.doc_id + 3""")
# Titles of an artist: every line of its document, a benchmark text, works that no page mentions, and one with its own name.
_view("w_title", " UNION ALL ".join(
    ["SELECT DISTINCT doc_id + 3 AS id, trim(line) AS name FROM (SELECT doc_id, unnest(split(text, chr(10))) AS line FROM documents) AS l WHERE trim(line) <> ''",
     "SELECT 3 + item_id % (SELECT count(*) FROM documents) AS id, text AS name FROM benchmark"]
    + [f"SELECT doc_id + 3, 'Unknown work {j} ' || CAST(doc_id AS STRING) FROM documents WHERE doc_id % 4 >= {j} - 2" for j in (1, 2, 3, 4, 5)]
    + [f"SELECT doc_id + 3, 'Lost work {j} ' || CAST(doc_id AS STRING) FROM documents WHERE doc_id % 3 = 1" for j in range(1, 31)]
    + ["SELECT id, 'Best of ' || name FROM w_artist"]))
_view("w_group", """
SELECT id, 'g-' || CAST(id AS STRING) AS gid, name, CASE WHEN id % 6 = 1 THEN 'Nobody At All' ELSE 'Persón' END AS credit_name,
  CASE id % 5 WHEN 0 THEN 'Compilation' WHEN 1 THEN 'Soundtrack' WHEN 2 THEN NULL ELSE 'Album' END AS type_name FROM w_artist""")
_FRENCH_MONTH = "CASE doc_id % 12 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate("janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split())) + " END"
_view("w_page_fr", f"""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Jean Durand ' WHEN 1 THEN 'Marie-Claire Petit ' WHEN 2 THEN 'Anne Petit ' ELSE 'Zork Petit ' END || CAST(doc_id AS STRING) AS title,
  CASE WHEN doc_id % 2 = 0 THEN '{{{{Infobox Musique (artiste)' ELSE '{{{{Infobox Musique classique (personnalité)' END || ' <!-- x -->' || chr(10)
    || '| nom = Persón {{{{nobr|a {{{{b|c=' || CAST(doc_id AS STRING) || '}}}}' || chr(10) || '| label = faux}}}}' || chr(10) || '| label = un' || chr(10) || '| Label = deux {{{{x|y}}}}' || chr(10)
    || CASE doc_id % 5 WHEN 0 THEN '| charte = vocal' WHEN 1 THEN '| charte = groupe' ELSE '| charte = x' END || chr(10)
    || CASE WHEN doc_id % 3 = 0 THEN '| naissance = {{{{Date de naissance|7|' || {_FRENCH_MONTH} || '|1950}}}}' ELSE '| style = rock' END || chr(10)
    || CASE WHEN doc_id % 6 = 0 THEN '| décès = {{{{Date de décès|1|août|2001}}}}' ELSE '| site = rien' END || chr(10)
    || CASE doc_id % 4 WHEN 0 THEN '| pays origine = [[France]]' WHEN 1 THEN '| pays origine = [[Belgique|belge]]' ELSE '| autre = 1' END || chr(10)
    || '}}}}' || chr(10) || 'Persón de [[' || CASE WHEN doc_id % 7 = 0 THEN 'Canada' ELSE 'Nulle part' END || ']].' || chr(10) || chr(10) || text || chr(10)
    || CASE doc_id % 6 WHEN 0 THEN '[[Catégorie:Chanteur français]]' WHEN 1 THEN '[[Catégorie:Chanteuse belge]]' WHEN 2 THEN '[[Catégorie:Groupe de rock]]' ELSE '' END
    || CASE doc_id % 8 WHEN 0 THEN '[[Catégorie:Naissance en 1960]]' WHEN 1 THEN '[[Catégorie:Décès en 1999]]' WHEN 2 THEN '[[Catégorie:Groupe de musique formé en 1971]]' ELSE '' END
    || CASE WHEN doc_id % 9 = 0 THEN chr(10) || '{{{{Métadonnées personne' || chr(10) || '| NOM = N' || CAST(doc_id AS STRING) || chr(10) || '| DATE DE NAISSANCE = 1944' || chr(10) || '| DATE DE DÉCÈS = 12 March 1990' || chr(10) || '}}}}' ELSE '' END AS text
FROM documents""")
_view("w_name_lines", "SELECT name || chr(9) || gender AS value FROM (VALUES ('# names', 'x'), ('Jean', 'male'), ('Marie', 'female'), ('Anne ', ' female'), ('', 'male')) AS v(name, gender)")
_view("w_place_lines", "SELECT name || chr(9) || code AS value FROM (VALUES ('# titles', 'x'), ('France', 'FR'), ('Belgique', 'BE'), ('Canada', 'CA'), ('Allemagne', 'DE')) AS v(name, code)")
_view("w_place", "SELECT * FROM (VALUES ('France', 'FR'), ('Canada', 'CA'), ('Germany', 'DE')) AS v(name, code)")


def dependencies(sql: str, stop: Iterable[str] = ()) -> list[str]:
    """Views that the text needs, each after those it needs itself; ``stop`` views count as given."""
    done: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_]+", text):
            if word in VIEWS and word not in done:
                if word not in stop:
                    visit(VIEWS[word])
                if word not in done:
                    done.append(word)

    visit(sql)
    return done


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """The query with the views it uses (and ``extra`` ones, in their order) in front of it."""
    extra = extra or {}
    names = dependencies(" ".join([*extra.values(), sql]))
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({q.strip()})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()


def base_tables(names: Iterable[str], folder: str) -> dict[str, str]:
    return {n: f"SELECT * FROM parquet.`{folder}/{n}.parquet`" for n in names}


def view(spark: SparkSession, folder: str, name: str, stored: dict[str, str] | None = None) -> DataFrame:
    """One view over the parquet files of ``folder``; ``stored`` views are read from their own files."""
    stored = stored or {}
    views = dependencies(name, stored)
    bodies = {v: f"SELECT * FROM parquet.`{stored[v]}`" if v in stored else VIEWS[v] for v in views}
    text = " ".join([name, *bodies.values()])
    base = [b for b in BASE if re.search(rf"(?<![a-z_`/]){b}(?![a-z_./])", text)]
    # The one function that the two engines name differently.
    parts = [f"{n} AS ({q})" for n, q in {**base_tables(base, folder), **{v: q.replace("unnest(", "explode(") for v, q in bodies.items()}}.items()]
    return spark.sql("WITH " + ",\n".join(parts) + f"\nSELECT * FROM {name}")
