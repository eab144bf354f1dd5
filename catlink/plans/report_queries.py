"""Registered queries for the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.config import VINYL_FORMATS
from catlink.operators import links
from catlink.plans.oracle_views import enc
from catlink.plans.registry import SITES, Registry
from catlink.reports import artists, coverage, images, info, structure

Q = Registry()
A, B = "http://a.example/", "http://b.example/"
CRLF = "chr(13) || chr(10)"

for _side, _mode in (("a", "short"), ("a", "long"), ("b", "short"), ("b", "long")):
    Q.add(f"SELECT release_id, info FROM info_{_side}_{_mode}", f"{_side}_release_info_{_mode}")(
        lambda c, s=_side, m=_mode: (info.a_release_info if s == "a" else info.b_release_info)(getattr(c, s), m))


def _cover(entity: str, a: str, b: str, link: str, whole: str) -> str:
    return f"""SELECT '{entity}' AS entity, (SELECT count(id) FROM {a}) AS a_total, (SELECT count(id) FROM {b}) AS b_total, (SELECT count(id) FROM {link}) AS links,
        printf('%.0f', (SELECT count(id) FROM {link}) * 100.0 / (SELECT count(id) FROM {whole})) AS percent"""


@Q.add(" UNION ALL ".join([
    _cover("release", "a_release", "b_release", "al_release", "a_release"), _cover("release_group", "a_release_group", "b_master", "al_release_group", "b_master"),
    _cover("artist", "a_artist", "b_artist", "al_artist", "a_artist"), _cover("label", "a_label", "b_label", "al_label", "a_label")]))
def coverage_report(c):
    return coverage.coverage(c.a, c.b)


_MENTIONS = """SELECT t.release_id, x.artist_name, x.artist_id, x.anv, x.role_name, x.role_details, t.id AS track_id, t.position AS tracks FROM b_track t JOIN b_tracks_extraartists x ON x.track_id = t.id
    UNION SELECT t.release_id, x.artist_name, x.artist_id, x.anv, NULL, NULL, t.id, t.position FROM b_track t JOIN b_tracks_artists x ON x.track_id = t.id
    UNION SELECT release_id, artist_name, artist_id, anv, NULL, NULL, NULL, NULL FROM b_releases_artists
    UNION SELECT release_id, artist_name, artist_id, anv, role_name, role_details, NULL, tracks FROM b_releases_extraartists"""


@Q.add(f"""WITH rows_ AS ({_MENTIONS}),
    lines AS (SELECT release_id, artist_id, string_agg(line, chr(10) ORDER BY line) AS credits FROM (SELECT r.release_id, r.artist_id, chr(9) || coalesce(r.role_name, '')
      || CASE WHEN r.role_details IS NULL THEN '' ELSE ' [' || r.role_details || ']' END
      || CASE WHEN r.role_name IS NULL AND r.role_details IS NULL AND r.tracks IS NULL THEN 'Release - ' WHEN r.role_name IS NULL AND r.role_details IS NULL THEN 'Track - ' ELSE ' - ' END
      || CASE WHEN coalesce(r.anv, '') = '' THEN r.artist_name ELSE r.anv END || CASE WHEN coalesce(r.tracks, '') = '' THEN '' ELSE ' (tracks: ' || r.tracks || ')' END
      || CASE WHEN o.release_link_type_name IS NULL THEN '' ELSE ' --A--> ' || o.release_link_type_name END || CASE WHEN o.link_attribute_name IS NULL THEN '' ELSE ' [' || o.link_attribute_name || ']' END AS line
      FROM rows_ r LEFT JOIN roles o ON o.credit = r.role_name) GROUP BY ALL),
    art AS (SELECT p.release_id, p.artist_name || ' {B}artist/' || {enc('p.artist_name')} AS who, string_agg(l.line, chr(10) ORDER BY l.line) AS links, count(l.line) AS n,
      string_agg(x.credits, chr(10) ORDER BY x.credits) AS credits FROM (SELECT DISTINCT release_id, artist_name, artist_id FROM rows_) p
      LEFT JOIN (SELECT id, chr(9) || name || ' {A}artist/' || gid AS line FROM bl_artist) l ON l.id = p.artist_id LEFT JOIN lines x ON x.release_id = p.release_id AND x.artist_id = p.artist_id GROUP BY p.release_id, p.artist_name),
    blocks AS (SELECT release_id, CASE WHEN n = 0 THEN 0 WHEN n = 1 THEN 1 ELSE 2 END AS g, who || chr(10) || CASE WHEN n > 0 THEN links || chr(10) ELSE '' END || credits AS block FROM art)
    SELECT r.id AS release_id, 'Linked artists:' || chr(10) || coalesce(string_agg(block, chr(10) ORDER BY block) FILTER (g = 1), '') || chr(10) || chr(10)
      || 'Multi-linked artists:' || chr(10) || coalesce(string_agg(block, chr(10) ORDER BY block) FILTER (g = 2), '') || chr(10) || chr(10)
      || 'Unlinked artists:' || chr(10) || coalesce(string_agg(block, chr(10) ORDER BY block) FILTER (g = 0), '') AS note
    FROM b_release r LEFT JOIN blocks b ON b.release_id = r.id GROUP BY r.id""")
def release_artists_report(c):
    return artists.release_artists(c.b, c.view("roles"), SITES)


_CHECKS = f"""SELECT r.id AS release_id,
      (SELECT count(*) FROM bl_release l WHERE l.id = r.id) <= 1 AS release_ok,
      r.master_id IS NULL OR r.master_id NOT IN (SELECT id FROM b_master) OR r.master_id IN (SELECT id FROM bl_release_group) AS master_ok,
      coalesce((SELECT bool_and(n = 1) FROM (SELECT x.release_id, x.label_id, (SELECT count(*) FROM bl_label l WHERE l.id = x.label_id) AS n FROM b_releases_labels x) z WHERE z.release_id = r.id), false) AS label_ok,
      (SELECT bool_and(n = 1) FROM (SELECT q.release_id, q.id, count(l.gid) AS n FROM (
          SELECT t.release_id, x.artist_name, x.artist_id AS id FROM b_track t JOIN b_tracks_extraartists x ON x.track_id = t.id WHERE t.position <> ''
          UNION SELECT t.release_id, x.artist_name, x.artist_id FROM b_track t JOIN b_tracks_artists x ON x.track_id = t.id WHERE t.position <> ''
          UNION SELECT release_id, artist_name, artist_id FROM b_releases_artists UNION SELECT release_id, artist_name, artist_id FROM b_releases_extraartists) q
        LEFT JOIN bl_artist l ON l.id = q.id GROUP BY q.release_id, q.id) z WHERE z.release_id = r.id) AS artist_ok FROM b_release r"""


@Q.add(f"SELECT *, release_ok AND master_ok AND label_ok AND artist_ok AS status FROM ({_CHECKS})")
def release_checks(c):
    return structure.release_checks(c.b, SITES).drop("note")


@Q.add(f"""SELECT r.id AS release_id, 'Release: ' || {CRLF} || '  ' || r.title || ' - {B}release/' || r.id || {CRLF}
    || coalesce((SELECT string_agg('  ' || l.name || ' - {A}release/' || l.gid || {CRLF}, '' ORDER BY '  ' || l.name || ' - {A}release/' || l.gid) FROM bl_release l WHERE l.id = r.id), '')
    || CASE (SELECT count(*) FROM bl_release l WHERE l.id = r.id) WHEN 0 THEN '  Warning: A release not found!' WHEN 1 THEN '' ELSE '  Error: More than one A release links to this release!' END || {CRLF} || {CRLF} AS note FROM b_release r""")
def release_check_note(c):
    return structure.release_check(c.b, SITES).select("release_id", "note")


_BT = "SELECT id AS track_id, release_id, position, title, duration, row_number() OVER (PARTITION BY release_id ORDER BY id) AS rn FROM b_track WHERE position <> ''"
_AT = """SELECT r.gid AS release_gid, rec.id AS recording, rec.gid AS recording_gid, row_number() OVER (PARTITION BY r.gid ORDER BY m.position, t.position, rec.id) AS rn
    FROM a_medium m JOIN a_track t ON t.tracklist = m.tracklist JOIN a_recording rec ON rec.id = t.recording JOIN a_release r ON r.id = m.release"""


@Q.add(f"""SELECT t.release_id, l.gid AS release_gid, t.rn AS row_number, t.track_id, x.recording_gid, w.gid AS work_gid FROM ({_BT}) t
    LEFT JOIN (SELECT DISTINCT id, gid FROM bl_release) l ON l.id = t.release_id LEFT JOIN ({_AT}) x ON x.release_gid = l.gid AND x.rn = t.rn
    LEFT JOIN a_l_recording_work e ON e.entity0 = x.recording LEFT JOIN a_work w ON w.id = e.entity1""")
def track_alignment(c):
    return structure.track_alignment(c.a, c.b, SITES).drop("note")


_POS = f"SELECT release_id, position, rn FROM ({_BT})"


_CREDIT_TRACKS = f"""WITH pos AS ({_POS}), first AS (SELECT release_id, position, min(rn) AS lo, max(rn) AS hi FROM pos GROUP BY ALL),
    cr AS (SELECT DISTINCT x.release_id, l.gid, x.artist_name || CASE WHEN x.anv = '' THEN '' ELSE ' credited as ' || x.anv END AS artist, x.role_name || CASE WHEN x.role_details IS NULL THEN '' ELSE ' [' || x.role_details || ']' END AS role, x.tracks
      FROM b_releases_extraartists x LEFT JOIN bl_artist l ON l.id = x.artist_id)
    SELECT DISTINCT release_id, gid, artist, role, '' AS position FROM cr WHERE coalesce(tracks, '') = ''
    UNION SELECT c.release_id, gid, artist, role, p.position FROM cr c JOIN pos p ON p.release_id = c.release_id AND c.tracks = '2, 5' AND p.position IN ('2', '5')
    UNION SELECT c.release_id, gid, artist, role, p.position FROM cr c JOIN first f ON f.release_id = c.release_id AND f.position = '1' JOIN first t ON t.release_id = c.release_id AND t.position = '3'
      JOIN pos p ON p.release_id = c.release_id AND p.rn BETWEEN f.lo AND t.hi WHERE c.tracks = '1 to 3'"""


@Q.add(_CREDIT_TRACKS)
def release_credit_tracks(c):
    return structure.release_credit_rows(c.b)


_TRACK_CREDITS = f"""WITH own AS (SELECT t.release_id, t.id AS track_id, l.gid, x.artist_name || CASE WHEN x.anv = '' THEN '' ELSE ' credited as ' || x.anv END AS artist,
      x.role_name || CASE WHEN x.role_details IS NULL THEN '' ELSE ' [' || x.role_details || ']' END AS role, t.position
      FROM b_track t JOIN b_tracks_extraartists x ON x.track_id = t.id LEFT JOIN bl_artist l ON l.id = x.artist_id WHERE t.position <> ''),
    cov AS (SELECT t.release_id, t.id AS track_id, c.gid, c.artist, c.role, t.position FROM ({_CREDIT_TRACKS}) c JOIN b_track t ON t.release_id = c.release_id AND t.position = c.position WHERE c.position <> '')
    SELECT *, count(*) AS n FROM (SELECT * FROM own WHERE track_id IN (SELECT track_id FROM own WHERE gid IS NOT NULL)
      UNION ALL SELECT * FROM cov WHERE track_id IN (SELECT track_id FROM cov WHERE gid IS NOT NULL)) GROUP BY ALL"""


@Q.add(_TRACK_CREDITS)
def track_credits(c):
    rows = structure.track_credits(c.b)
    return rows.groupBy("release_id", "track_id", "gid", "artist", "role", "position").agg(F.count(F.lit(1)).alias("n"))


_LINKED = "(SELECT r.id AS release_id, r.title, l.gid AS release_gid FROM b_release r LEFT JOIN (SELECT DISTINCT id, gid FROM bl_release) l ON l.id = r.id)"
_PEOPLE = "(SELECT e.entity1 AS entity, p.gid, p.name, k.phrase FROM a_l_artist_%s e JOIN a_artist p ON p.id = e.entity0 LEFT JOIN phrase k ON k.link = e.link)"
_A_CREDIT = f"'    ' || coalesce(x.phrase, '') || ': ' || x.name || ' - {A}artist/' || x.gid || {CRLF}"
_B_CREDIT = f"'    ' || coalesce(x.role, '') || ': ' || x.artist || coalesce(' - {A}artist/' || x.gid, '') || {CRLF}"
_TIME = "CASE WHEN x.%s IS NULL THEN '' ELSE ' (' || CAST(x.%s // 60000 AS VARCHAR) || ':' || lpad(CAST(x.%s // 1000 %% 60 AS VARCHAR), 2, '0') || ')' END"


def _time(c: str) -> str:
    return _TIME % (c, c, c)


_SIDES = f"""(SELECT r.release_id, r.release_gid, t.rn, x.recording, x.recording_gid, rec.name AS recording_name, rec.length AS recording_length, tr.name AS track_name, tr.length AS track_length, tr.number
    FROM {_LINKED} r JOIN ({_BT}) t ON t.release_id = r.release_id JOIN ({_AT}) x ON x.release_gid = r.release_gid AND x.rn = t.rn JOIN a_recording rec ON rec.id = x.recording
    JOIN a_release ar ON ar.gid = r.release_gid JOIN a_medium m ON m.release = ar.id JOIN a_track tr ON tr.tracklist = m.tracklist AND tr.recording = x.recording)"""
_WORKS = f"(SELECT DISTINCT s.release_id, s.release_gid, s.rn, w.id AS work, w.gid AS work_gid, w.name AS work_name FROM {_SIDES} s JOIN a_l_recording_work e ON e.entity0 = s.recording JOIN a_work w ON w.id = e.entity1)"
_LINES = f"""SELECT release_id, release_gid, 1 AS section, 0 AS row_number, 0 AS part, '' AS place, 'Tracks / Recordings and works:' || {CRLF} || title || ' - {B}release/' || release_id || {CRLF} AS line FROM {_LINKED} r
    UNION ALL SELECT r.release_id, r.release_gid, 1, 0, 1, '', {_B_CREDIT} FROM {_LINKED} r JOIN ({_CREDIT_TRACKS}) x ON x.release_id = r.release_id WHERE x.position = ''
    UNION ALL SELECT r.release_id, r.release_gid, 1, 0, 2, '', a.name || ' - {A}release/' || a.gid || {CRLF} FROM {_LINKED} r JOIN a_release a ON a.gid = r.release_gid
    UNION ALL SELECT DISTINCT r.release_id, r.release_gid, 1, 0, 3, '', {_A_CREDIT} FROM {_LINKED} r JOIN a_release a ON a.gid = r.release_gid JOIN {_PEOPLE % 'release'} x ON x.entity = a.id
    UNION ALL SELECT r.release_id, r.release_gid, 2, x.rn, 0, '', coalesce(x.position, '') || '. ' || coalesce(x.title, '') || CASE WHEN coalesce(x.duration, '') = '' THEN '' ELSE ' (' || x.duration || ')' END || ' - B track' || {CRLF}
      FROM {_LINKED} r JOIN ({_BT}) x ON x.release_id = r.release_id
    UNION ALL SELECT r.release_id, r.release_gid, 2, t.rn, 1, '', {_B_CREDIT} FROM {_LINKED} r JOIN ({_BT}) t ON t.release_id = r.release_id JOIN (SELECT *, unnest(range(n)) FROM ({_TRACK_CREDITS})) x ON x.track_id = t.track_id
    UNION ALL SELECT release_id, release_gid, 2, rn, 2, '', CASE WHEN track_name <> recording_name OR track_length <> recording_length THEN number || '. ' || track_name || {_time('track_length')} || ' - A track' || {CRLF} ELSE '' END
      || number || '. ' || recording_name || {_time('recording_length')} || ' - {A}recording/' || recording_gid || {CRLF} FROM {_SIDES} x
    UNION ALL SELECT DISTINCT s.release_id, s.release_gid, 2, s.rn, 3, '', {_A_CREDIT} FROM {_SIDES} s JOIN {_PEOPLE % 'recording'} x ON x.entity = s.recording
    UNION ALL SELECT release_id, release_gid, 2, rn, 4, work_gid || '/0', '    Work: ' || work_name || ' - {A}work/' || work_gid || {CRLF} FROM {_WORKS}
    UNION ALL SELECT DISTINCT s.release_id, s.release_gid, 2, s.rn, 4, s.work_gid || '/1', {_A_CREDIT} FROM {_WORKS} s JOIN {_PEOPLE % 'work'} x ON x.entity = s.work"""


@Q.add(_LINES)
def structure_lines(c):
    """Releases, tracks, recordings and works with their credits, line by line."""
    return structure.structure_lines(c.a, c.b, SITES, links.link_phrases(c.a)).filter("section > 0")


@Q.add(f"""SELECT r.release_id, r.release_gid, md5(string_agg(line, '' ORDER BY section, row_number, part, place, line)) AS note FROM ({_LINES}) r GROUP BY ALL""")
def structure_text(c):
    """The part of each report that is not checks or information, as one text."""
    report = structure.structure_report(c.a, c.b, SITES, links.link_phrases(c.a))
    at = F.instr("note", "Tracks / Recordings and works:")
    return report.select("release_id", "release_gid", F.md5(F.substr("note", at)).alias("note"))


@Q.add(None)
def structure_report(c):
    """The whole text report; its parts are checked one by one and the texts in the tests."""
    r = structure.structure_report(c.a, c.b, SITES, links.link_phrases(c.a))
    return r.select("release_id", "release_gid", "status", F.md5("note").alias("note"))


@Q.add(f"""WITH u AS (SELECT * FROM al_release WHERE edits_pending = 0 AND gid IN (SELECT gid FROM al_release GROUP BY gid HAVING count(url) = 1) AND url IN (SELECT url FROM al_release GROUP BY url HAVING count(gid) = 1)),
    img AS (SELECT l.gid, l.id, i.height, i.width, i.type, 'http://img.example/' || i.uri AS url FROM u JOIN a_release_meta m ON m.id = u.id AND m.amazon_asin IS NULL AND m.cover_art_presence = 'absent'
      JOIN bl_release l ON l.gid = u.gid JOIN b_releases_images x ON x.release_id = l.id JOIN b_image i ON i.id = x.image_id AND (i.type = 'primary' OR (i.height >= 500 AND i.width >= 500)))
    SELECT img.*, s.score FROM img JOIN (SELECT gid, max(height * width) AS score FROM img WHERE type = 'primary' GROUP BY gid) s ON s.gid = img.gid""")
def missing_images(c):
    return images.missing_images(c.a, c.b, SITES)


@Q.add("SELECT 'report_images' AS updated, 'Report contains: ' || count(*) || ' images for ' || count(DISTINCT release_id) || ' releases' AS event FROM b_releases_images")
def image_event(c):
    return images.image_event(c.b.releases_images.select(F.col("release_id").alias("gid")))


@Q.add(f"SELECT release, count(*) AS n, count(DISTINCT CASE WHEN format IN {VINYL_FORMATS} THEN 7 ELSE format END) AS families FROM a_medium GROUP BY release")
def media_per_release(c):
    from catlink.operators.keys import format_family

    return c.a.medium.groupBy("release").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(format_family("format", VINYL_FORMATS)).alias("families"))
