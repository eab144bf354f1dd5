"""Registered queries for links, catalog preparation, evidence and proposals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.config import Catalog
from catlink.operators import catalog as prep, evidence as ev, links, proposals as pr
from catlink.operators.keys import numbered, only_single, repeated
from catlink.plans.oracle_views import catno, enc, key, ratio, strip
from catlink.plans.registry import SITES, Registry
from catlink.sources import dictionaries

Q = Registry()
A, B = "http://a.example/", "http://b.example/"

# Links ------------------------------------------------------------------------------------------

for _kind in links.KINDS:
    Q.add(f"SELECT id, name, gid, url, edits_pending FROM al_{_kind}", f"{_kind}_link_view")(lambda c, k=_kind: getattr(c.a, f"{k}_link"))
    Q.add(f"SELECT gid, name, url, id, edits_pending FROM bl_{_kind}", f"{_kind}_links_resolved")(lambda c, k=_kind: getattr(c.b, f"{k}_link"))


@Q.add("SELECT gid FROM bl_release GROUP BY gid HAVING count(url) > 1")
def multi_link_releases(c):
    return repeated(c.b.release_link, ["gid"], "url")


@Q.add("SELECT gid, url FROM bl_release WHERE gid IN (SELECT gid FROM bl_release GROUP BY gid HAVING count(*) = 1)")
def single_link_releases(c):
    return only_single(c.b.release_link.select("gid", "url"), ["gid"])


def _stored(c, kind: str):
    """A past state of the stored links: a part is missing, a part has an old pending count, and some are gone from the catalog."""
    now = getattr(c.b, f"{kind}_link")
    i = F.col("id")
    old = now.filter(i % 5 != 1).withColumn("edits_pending", F.when(i % 7 == 2, 9).otherwise(F.col("edits_pending")))
    gone = now.filter(i % 11 == 3).withColumn("url", F.concat("url", F.lit("-gone")))
    return old.unionByName(gone)


def _stored_sql(kind: str) -> str:
    return f"""(SELECT gid, name, url, id, CASE WHEN id % 7 = 2 THEN 9 ELSE edits_pending END AS edits_pending FROM bl_{kind} WHERE id % 5 <> 1
        UNION ALL SELECT gid, name, url || '-gone', id, edits_pending FROM bl_{kind} WHERE id % 11 = 3)"""


def _named_sql(kind: str) -> str:
    return f"""(SELECT l.gid, l.name, l.url, min(b.id) AS id, l.edits_pending FROM al_{kind} l JOIN b_{kind} b
        ON lower(b.name) = lower(substr(url_decode(replace(l.url, '+', ' ')), {len(B + kind + '/') + 1})) GROUP BY ALL)"""


def _current_sql(kind: str, path: str) -> str:
    if kind == "artist":
        return _named_sql("artist")
    if kind == "label":
        return _named_sql("label")
    number = f"try_cast(regexp_extract(url, '^http://b\\.example/{path}/([0-9]+)', 1) AS BIGINT)"
    return f"(SELECT gid, name, url, {number} AS id, edits_pending FROM al_{kind} WHERE {number} IS NOT NULL)"


def _sync(c, kind: str):
    return links.sync_changes(_stored(c, kind), links.sync_candidates(kind, getattr(c.a, f"{kind}_link"), c.b, SITES), _known_ids(c, kind))


def _known_ids(c, kind: str):
    return {"release": lambda: c.b.release, "release_group": lambda: c.b.master}.get(kind, lambda: None)()


def _unchanged(c, kind: str):
    """What a sync of the current state would add: nothing."""
    return links.sync_changes(getattr(c.b, f"{kind}_link"), links.sync_candidates(kind, getattr(c.a, f"{kind}_link"), c.b, SITES), _known_ids(c, kind))[0]


for _kind, _path, _table in (("release", "release", "b_release"), ("release_group", "master", "b_master"), ("artist", "", None), ("label", "", None)):
    _cur, _old = _current_sql(_kind, _path), _stored_sql(_kind)
    _known = f" WHERE id IN (SELECT id FROM {_table})" if _table else ""
    Q.add(f"SELECT * FROM {_cur}{_known} EXCEPT SELECT gid, name, url, id, edits_pending FROM bl_{_kind}", f"{_kind}_sync_noop")(lambda c, k=_kind: _unchanged(c, k))
    _added = f"SELECT * FROM (SELECT * FROM {_cur} EXCEPT SELECT * FROM {_old}){_known}"
    _removed = f"SELECT * FROM {_old} EXCEPT SELECT * FROM {_cur}"
    Q.add(_added, f"{_kind}_sync_added")(lambda c, k=_kind: _sync(c, k)[0])
    Q.add(_removed, f"{_kind}_sync_removed")(lambda c, k=_kind: _sync(c, k)[1])
    Q.add(f"SELECT * FROM (SELECT * FROM {_old} EXCEPT ({_removed})) UNION ALL ({_added})", f"{_kind}_sync_applied")(
        lambda c, k=_kind: links.apply_changes(_stored(c, k), *_sync(c, k)))
    Q.add(f"""SELECT '{_kind}_link' AS updated, 'removed: ' || (SELECT count(*) FROM ({_removed})) || ', added: ' || (SELECT count(*) FROM ({_added})) AS event""",
          f"{_kind}_sync_event")(lambda c, k=_kind: links.sync_event(f"{k}_link", *_sync(c, k)))


@Q.add(f"""SELECT gid, url, id FROM {_stored_sql('artist')} WHERE gid NOT IN (SELECT gid FROM ({_current_sql('artist', '')} EXCEPT SELECT * FROM {_stored_sql('artist')}))""")
def stale_evidence_dropped(c):
    """Rows that stay after an artist sync; the stored links stand in for the evidence table."""
    return links.drop_stale_evidence(_stored(c, "artist").select("gid", "url", "id"), _sync(c, "artist")[0])


@Q.add("SELECT e.id, p.phrase, e.entity0, e.entity1 FROM a_l_artist_release e JOIN phrase p ON p.link = e.link")
def link_phrases(c):
    return c.a.l_artist_release.join(links.link_phrases(c.a), "link").select("id", "phrase", "entity0", "entity1")


# Catalog preparation ---------------------------------------------------------------------------------


@Q.add("SELECT release_id, status FROM m_status")
def release_status(c):
    return c.b.release_status


@Q.add("SELECT release_id, count FROM m_tracks")
def track_count(c):
    return c.b.release_track_count


@Q.add("SELECT release_id, format_id, format_name FROM m_format")
def release_format(c):
    return c.b.release_format


@Q.add("SELECT r.id, m.id AS country_id, m.iso_code FROM b_release r JOIN m_country m ON m.name = r.country")
def country_mapping(c):
    m = c.countries.select(F.col("id").alias("country_id"), "iso_code", F.col("name").alias("country"))
    return c.b.release.select("id", "country").join(m, "country").select("id", "country_id", "iso_code")


@Q.add("SELECT * FROM m_release")
def release_mapping(c):
    return c.b.release_mapping


@Q.add("""WITH s1 AS (SELECT *, coalesce(type IN ('Other', 'Barcode') AND regexp_matches(value, '(?i)^LC *[0-9]+$'), false) AS h FROM b_raw_identifier),
    s2 AS (SELECT release_id, value, CASE WHEN h THEN 'Label Code' ELSE type END AS type, CASE WHEN NOT h THEN description END AS description FROM s1),
    s3 AS (SELECT *, coalesce(type = 'Other' AND regexp_matches(description, '(?i)rights society|rights societies'), false) AS h FROM s2),
    s4 AS (SELECT release_id, value, CASE WHEN h THEN 'Rights Society' ELSE type END AS type, CASE WHEN NOT h THEN description END AS description FROM s3),
    s5 AS (SELECT release_id, value, description, CASE WHEN type = 'Other' AND regexp_matches(description, '(?i)runout') THEN 'Matrix / Runout' ELSE type END AS type FROM s4)
    SELECT release_id, type, description, CASE WHEN type <> 'Barcode' THEN value WHEN regexp_matches(value, '(?i)none|no barcode') THEN 'none'
      WHEN regexp_matches(regexp_replace(value, '[ ./>-]', '', 'g'), '^[0-9]+$') THEN regexp_replace(value, '[ ./>-]', '', 'g') ELSE value END AS value FROM s5""")
def clean_identifiers(c):
    return prep.clean_identifiers(c.b.raw_identifier)


@Q.add("SELECT release_id, label, catno, (SELECT min(id) FROM b_label b WHERE b.name = l.label) AS label_id FROM b_releases_labels l")
def release_label_ids(c):
    return prep.add_label_id(c.b.releases_labels.drop("label_id"), c.b.label)


@Q.add("SELECT id, name FROM b_artist WHERE id IN (SELECT min(id) FROM b_artist GROUP BY name)")
def deduped_artists(c):
    return prep.dedupe_artists(c.b.artist.select("id", "name"))


@Q.add("""SELECT track_id, CASE WHEN artist_id IN (SELECT min(id) FROM b_artist GROUP BY name) THEN artist_id ELSE 0 END AS artist_id, role_name FROM b_tracks_extraartists""")
def repaired_artist_ids(c):
    """Credits of artists that the removal of duplicate names left dangling."""
    kept = prep.dedupe_artists(c.b.artist.select("id", "name"))
    return prep.repair_artist_ids(c.b.tracks_extraartists.select("track_id", "artist_id", "role_name"), kept)


# Evidence -------------------------------------------------------------------------------------------------

_TRACK = f"""SELECT DISTINCT c.artist_gid AS gid, {enc('ta.artist_name')} AS url,
    'Track "' || r.name || '" artist on linked B release {A}release/' || rel.gid || ' pointing to same artist.' AS note, 1 AS score
    FROM a_recording r JOIN credited c ON c.artist_credit = r.artist_credit JOIN a_track t ON t.recording = r.id JOIN a_medium m ON m.tracklist = t.tracklist
    JOIN a_release rel ON rel.id = m.release JOIN bl_release l ON l.gid = rel.gid JOIN b_track bt ON bt.release_id = l.id AND lower(bt.title) = lower(r.name)
    JOIN b_tracks_artists ta ON ta.track_id = bt.id AND {key('ta.artist_name')} = lower(c.artist_name)
    WHERE c.artist NOT IN (SELECT id FROM al_artist) AND rel.id IN (SELECT id FROM al_release)"""

_CREDIT = f"""SELECT a.gid, {enc('x.artist_name')} AS url, 'Artist credited (' || p.phrase || ') in {A}release/' || rel.gid || ' and (' || ro.credit || ') in linked B release ' || l.url AS note
    FROM a_l_artist_release e JOIN a_artist a ON a.id = e.entity0 JOIN a_release rel ON rel.id = e.entity1 JOIN phrase p ON p.link = e.link
    JOIN bl_release l ON l.gid = rel.gid JOIN b_releases_extraartists x ON x.release_id = l.id AND {key('x.artist_name')} = lower(a.name)
    JOIN roles ro ON ro.credit = x.role_name AND ro.release_link_type = p.link_type
    WHERE a.gid NOT IN (SELECT gid FROM al_artist) AND rel.gid IN (SELECT gid FROM al_release)"""


def _summary(rows: str, closing: str) -> str:
    return f"""SELECT gid, url, array_to_string(t[1:3], chr(10)) || CASE WHEN n > 3 THEN chr(10) || 'and ' || CAST(n - 3 AS VARCHAR) || ' more {closing}' ELSE '' END AS note, n AS score
        FROM (SELECT gid, url, list_sort(list(note)) AS t, count(note) AS n FROM ({rows}) GROUP BY gid, url)"""


_TRACK_SUM = _summary(f"SELECT DISTINCT gid, url, note FROM ({_TRACK})", "similary linked tracks pointing to same artist")
_CREDIT_SUM = _summary(_CREDIT, "similar releases with credits pointing to same artist")

_BRANCH = {
    "linked_release": f"""SELECT DISTINCT c.artist_gid AS gid, {enc('x.artist_name')} AS url, 'Release with B link points to same artist: ' || v.name || ': {A}release/' || v.gid AS note, 12 AS score
        FROM al_release v JOIN a_release r ON r.id = v.id JOIN credited c ON c.artist_credit = r.artist_credit JOIN bl_release l ON l.gid = v.gid
        JOIN b_releases_artists x ON x.release_id = l.id AND {key('x.artist_name')} = lower(c.artist_name)
        WHERE c.artist <> 1 AND v.edits_pending = 0 AND c.artist NOT IN (SELECT id FROM al_artist)
        AND c.artist NOT IN (SELECT artist FROM a_artist_tag JOIN a_tag ON a_tag.id = tag WHERE name = 'improper b link')""",
    "linked_release_group": f"""SELECT DISTINCT c.artist_gid AS gid, {enc('x.artist_name')} AS url, 'Linked Release Group "' || v.name || '" {A}release-group/' || v.gid || ' points to same artist' AS note, 12 AS score
        FROM al_release_group v JOIN a_release_group r ON r.id = v.id JOIN a_artist_credit k ON k.id = r.artist_credit JOIN credited c ON c.artist_credit = k.id
        JOIN bl_release_group l ON l.gid = v.gid JOIN b_masters_artists x ON x.master_id = l.id AND {key('x.artist_name')} = lower(c.artist_name)
        WHERE k.artist_count = 1 AND k.id <> 1 AND v.edits_pending = 0 AND c.artist NOT IN (SELECT id FROM al_artist)""",
    "band_member": f"""SELECT DISTINCT m.gid0 AS gid, {enc('u.x')} AS url, m.name0 || ' is member of band ' || m.name1 || ' {A}artist/' || m.gid1
        || ' that is linked to B, linked band has member with name match.' AS note, 3 AS score
        FROM member m JOIN bl_artist l ON l.gid = m.gid1 JOIN b_artist b ON b.id = l.id, unnest(b.members) AS u(x)
        WHERE lower(m.name0) = {key('u.x')} AND m.id0 NOT IN (SELECT id FROM al_artist) AND m.id1 IN (SELECT id FROM al_artist)""",
    "shared_urls": f"""SELECT gid, {enc('b_name')} AS url, 'Both profiles point to following url(s): ' || string_agg(url, ', ' ORDER BY url) AS note, 3 * count(url) AS score
        FROM (SELECT a.gid, a.name, b.name AS b_name, u.url FROM a_artist a JOIN a_l_artist_url e ON e.entity0 = a.id JOIN a_url u ON u.id = e.entity1
          JOIN b_artist b ON {key('b.name')} = lower(a.name) AND list_contains(b.urls, u.url) WHERE a.id NOT IN (SELECT id FROM al_artist)) GROUP BY gid, name, b_name""",
    "member_band": f"""SELECT DISTINCT m.gid1 AS gid, {enc('u.x')} AS url, m.name1 || ' member ' || m.name0 || ' is linked to B, linked B artist ' || l.url || ' is member of band with name match.' AS note, 3 AS score
        FROM member m JOIN bl_artist l ON l.gid = m.gid0 JOIN b_artist b ON b.id = l.id, unnest(b.groups) AS u(x)
        WHERE lower(m.name1) = {key('u.x')} AND m.id0 IN (SELECT id FROM al_artist) AND m.id1 NOT IN (SELECT id FROM al_artist)""",
    "real_name": f"""SELECT DISTINCT m.gid0 AS gid, {enc('m.name0')} AS url, m.name0 || ' perform as ' || m.name1 || ' {A}artist/' || m.gid1
        || ' that is linked to B. B artist points to artist with same realname' AS note, 3 AS score
        FROM person m JOIN bl_artist l ON l.gid = m.gid1 JOIN b_artist b ON b.id = l.id AND list_contains(b.aliases, m.name0) AND b.realname = m.name0
        WHERE m.id0 NOT IN (SELECT id FROM al_artist) AND m.id1 IN (SELECT id FROM al_artist)""",
    "performer_name": f"""SELECT DISTINCT m.gid1 AS gid, {enc('m.name1')} AS url, m.name1 || ' is performer name of ' || m.name0 || ' {A}artist/' || m.gid0
        || ' that is linked to B. B artist points to artist with same performer name' AS note, 3 AS score
        FROM person m JOIN bl_artist l ON l.gid = m.gid0 JOIN b_artist b ON b.id = l.id AND list_contains(b.aliases, m.name1)
        WHERE m.id0 IN (SELECT id FROM al_artist) AND m.id1 NOT IN (SELECT id FROM al_artist)""",
    "shared_titles": f"""SELECT gid, url, 'Both profiles have following releases: ' || string_agg(title, ', ' ORDER BY title) AS note, 4 * count(title) AS score FROM
        (SELECT DISTINCT p.gid, {enc('x.artist_name')} AS url, r.title FROM
          (SELECT a.gid, a.name, list(lower(r.name)) AS titles FROM a_release r JOIN a_artist_credit_name n ON n.artist_credit = r.artist_credit JOIN a_artist a ON a.id = n.artist
           WHERE a.id <> 1 AND r.id NOT IN (SELECT q.id FROM a_release q JOIN a_artist_credit_name z ON z.artist_credit = q.artist_credit WHERE z.artist <> 1 AND z.artist IN (SELECT id FROM al_artist))
           GROUP BY a.gid, a.name HAVING count(*) >= 2) p
         JOIN b_releases_artists x ON {key('x.artist_name')} = lower(p.name) JOIN b_release r ON r.id = x.release_id AND list_contains(p.titles, lower(r.title)))
        GROUP BY gid, url HAVING count(title) >= 2""",
}


@Q.add(_TRACK)
def artist_evidence_track(c):
    return ev.track_evidence(c.a, c.b, SITES)


@Q.add(_TRACK_SUM)
def artist_evidence_track_summary(c):
    return ev.track_summary(c.track_evidence)


def _credits(c):
    return ev.release_credit_evidence(c.a, c.b, c.view("roles"), links.link_phrases(c.a), SITES)


@Q.add(_CREDIT)
def artist_evidence_credits(c):
    return _credits(c)


@Q.add(_CREDIT_SUM)
def artist_evidence_credit_summary(c):
    return ev.release_credit_summary(c.credit_evidence)


for _name, _sql in _BRANCH.items():
    Q.add(_sql, f"artist_evidence_{_name}")(lambda c, n=_name: ev.BRANCHES[n](c.a, c.b, SITES))


@Q.add("SELECT gid, url, 'Found B Artist with name match.' || chr(10) || string_agg(note, chr(10) ORDER BY note) AS note, CAST(sum(score) AS BIGINT) AS score FROM (\n"
       + "\nUNION ".join(f"SELECT gid, url, note, score FROM ({q})" for q in [*_BRANCH.values(), _TRACK_SUM, _CREDIT_SUM]) + ") GROUP BY gid, url")
def artist_evidence_all(c):
    return ev.artist_evidence(c.a, c.b, SITES, c.track_evidence, c.credit_evidence)


# Proposals ------------------------------------------------------------------------------------------------


@Q.add(f"""SELECT DISTINCT p.gid0, p.gid1, 'Both artists are linked to B where "' || x.name || '" is member of "' || y.name || '".' AS note FROM
    (SELECT l.gid AS gid0, k.gid AS gid1 FROM bl_artist l JOIN b_artist b ON b.id = l.id, unnest(b.groups) AS u(g) JOIN b_artist o ON o.name = g JOIN bl_artist k ON k.id = o.id
     EXCEPT SELECT gid0, gid1 FROM member WHERE id0 IN (SELECT id FROM al_artist)) p JOIN bl_artist x ON x.gid = p.gid0 JOIN bl_artist y ON y.gid = p.gid1""")
def member_of_band(c):
    return pr.member_of_band(c.a, c.b, SITES)


@Q.add(f"""SELECT DISTINCT p.gid0, p.gid1, 'Both artists are linked to B where "' || x.name || '" ' || x.url || ' performs as "' || y.name || '" ' || y.url AS note FROM
    (SELECT l.gid AS gid0, k.gid AS gid1 FROM bl_artist l JOIN (SELECT * FROM b_artist WHERE {strip('name')} = realname) b ON b.id = l.id, unnest(b.aliases) AS u(g)
       JOIN b_artist o ON o.name = g JOIN bl_artist k ON k.id = o.id
     EXCEPT SELECT gid0, gid1 FROM person WHERE id0 IN (SELECT id FROM al_artist)) p JOIN bl_artist x ON x.gid = p.gid0 JOIN bl_artist y ON y.gid = p.gid1""")
def performs_as(c):
    return pr.performs_as(c.a, c.b, SITES)


@Q.add(f"""WITH open_label AS (SELECT l.gid, lower(l.name) AS name, r.release, r.catalog_number FROM a_release_label r JOIN a_label l ON l.id = r.label WHERE l.id NOT IN (SELECT id FROM al_label)),
    cats AS (SELECT gid, name, list({catno('catalog_number')}) AS cats, count(DISTINCT {catno('catalog_number')}) AS n FROM open_label WHERE catalog_number IS NOT NULL GROUP BY ALL),
    rels AS (SELECT o.gid, o.name, list(lower(r.name)) AS titles, count(DISTINCT lower(r.name)) AS n FROM open_label o JOIN a_release r ON r.id = o.release GROUP BY ALL),
    hits AS (SELECT gid, {enc('b.label')} AS url, count(DISTINCT {catno('b.catno')}) AS k, n, 'catalog numbers' AS what FROM cats c JOIN b_releases_labels b ON lower(b.label) = c.name AND list_contains(c.cats, {catno('b.catno')}) GROUP BY ALL
      UNION SELECT gid, {enc('b.label')}, count(DISTINCT r.title), n, 'release titles' FROM rels c JOIN b_releases_labels b ON lower(b.label) = c.name JOIN b_release r ON r.id = b.release_id AND list_contains(c.titles, lower(r.title)) GROUP BY ALL)
    SELECT gid, url, 'Name match and ' || string_agg(note, ' and ' ORDER BY note) AS note, CAST(sum(k) AS BIGINT) AS score
    FROM (SELECT *, CAST(k AS VARCHAR) || ' shared ' || what || ' from total ' || CAST(n AS VARCHAR) AS note FROM hits) GROUP BY gid, url""")
def label_evidence(c):
    return pr.label_links(c.a, c.b)


def _candidates(multi: bool) -> str:
    which = "IN (SELECT id FROM al_release GROUP BY id HAVING count(url) > 1)" if multi else "NOT IN (SELECT id FROM al_release)"
    return f"""SELECT r.label_name, r.label_gid, r.catalog_number, a.gid, a.name, CAST(sum(t.track_count) AS BIGINT) AS track_count, max(m.format) AS format, a.country, a.date_year AS year, a.status, a.barcode
        FROM (SELECT l.release AS id, min(v.name) AS label_name, min(v.gid) AS label_gid, min(l.catalog_number) AS catalog_number FROM al_label v
            JOIN a_release_label l ON l.label = v.id AND l.catalog_number IS NOT NULL WHERE l.release {which} GROUP BY l.release HAVING count(v.gid) = 1) r
        JOIN a_medium m ON m.release = r.id JOIN a_tracklist t ON t.id = m.tracklist JOIN a_release a ON a.id = r.id
        GROUP BY a.id, a.gid, a.name, a.country, a.date_year, a.status, a.barcode, r.label_name, r.label_gid, r.catalog_number HAVING count(m.format) = 1"""


def _matched(multi: bool) -> str:
    """All agreeing releases of each candidate, ambiguous ones included."""
    return f"""SELECT DISTINCT l.id AS label_id, c.label_gid, c.label_name, c.catalog_number, c.gid, c.name, c.barcode, m.*, i.value AS b_barcode
        FROM ({_candidates(multi)}) c JOIN bl_label l ON l.gid = c.label_gid JOIN b_label bl ON bl.id = l.id JOIN b_releases_labels rl ON rl.label = bl.name AND {catno('rl.catno')} = {catno('c.catalog_number')}
        LEFT JOIN b_release_identifier i ON i.release_id = rl.release_id AND i.type = 'Barcode' AND i.value = c.barcode AND i.value <> ''
        JOIN m_release m ON m.release_id = rl.release_id AND m.year = c.year AND m.status = c.status AND m.country_id = c.country AND m.track_count = c.track_count
          AND (m.format_id = c.format OR (m.format_id IN (7, 29, 30, 31) AND c.format IN (7, 29, 30, 31)))"""


@Q.add(_candidates(False))
def release_candidates(c):
    return pr.release_candidates(c.a)


@Q.add(f"""WITH found AS ({_matched(False)})
    SELECT gid, '{B}release/' || release_id AS url, 'Release from label "' || label_name || '" found on linked B label with same normalized catalog number "' || catalog_number || '", '
      || CASE WHEN barcode IS NULL THEN 'A barcode missing' WHEN b_barcode IS NULL THEN 'B barcode missing' ELSE 'with same barcode "' || barcode || '"' END
      || ', same number of tracks, same format, same release country, same release year, same status, and ' || CASE WHEN lower(title) = lower(name) THEN 'exactly same' ELSE 'similar' END
      || ' release name A: "' || name || '" B: "' || title || '"' AS note,
      1 + CASE WHEN barcode IS NOT NULL AND b_barcode IS NOT NULL THEN 3 WHEN barcode IS NULL AND b_barcode IS NULL THEN 1 ELSE 0 END + CASE WHEN lower(title) = lower(name) THEN 5 ELSE 0 END AS score
    FROM found WHERE gid IN (SELECT gid FROM found GROUP BY gid HAVING count(*) = 1)""")
def release_link_proposals(c):
    return pr.release_links(pr.release_candidates(c.a), c.b, SITES)



@Q.add(f"""WITH found AS ({_matched(True)}), multi AS (SELECT * FROM bl_release WHERE gid IN (SELECT gid FROM bl_release GROUP BY gid HAVING count(url) > 1)),
    best AS (SELECT gid, min(release_id) AS release_id FROM found GROUP BY gid HAVING count(*) = 1),
    good AS (SELECT gid, url FROM multi INTERSECT SELECT gid, '{B}release/' || release_id FROM best),
    bad AS (SELECT gid, url FROM multi WHERE gid IN (SELECT gid FROM good) EXCEPT SELECT gid, url FROM good)
    SELECT DISTINCT e.id, 'Release has multiple B urls.' || chr(13) || chr(10) || ia.info || chr(13) || chr(10) || '{B}release/' || best.release_id || ' is best match' || chr(13) || chr(10)
      || ib.info || chr(13) || chr(10) || chr(13) || chr(10) || 'Removing {B}release/' || l.id || chr(13) || chr(10) || ir.info AS note
    FROM bad JOIN al_release v ON v.gid = bad.gid AND v.url = bad.url JOIN a_l_release_url e ON e.entity0 = v.id JOIN a_url u ON u.id = e.entity1 AND u.url = v.url
    JOIN bl_release l ON l.gid = bad.gid AND l.url = bad.url JOIN best ON best.gid = bad.gid
    LEFT JOIN info_a_short ia ON ia.release_id = v.id LEFT JOIN info_b_short ib ON ib.release_id = best.release_id LEFT JOIN info_b_short ir ON ir.release_id = l.id""")
def link_cleanup(c):
    return pr.release_cleanup(c.a, c.b, SITES)


@Q.add("""WITH g AS (SELECT rg.gid, rg.name, v.gid AS artist_gid, m.first_release_date_year AS year FROM al_artist v JOIN a_artist_credit_name n ON n.artist = v.id
      JOIN a_artist_credit k ON k.id = n.artist_credit AND k.artist_count = 1 JOIN a_release_group rg ON rg.artist_credit = k.id JOIN a_release_group_meta m ON m.id = rg.id
      WHERE v.edits_pending = 0 AND v.url NOT IN (SELECT url FROM al_artist GROUP BY url HAVING count(gid) > 1) AND rg.gid NOT IN (SELECT gid FROM al_release_group)),
    hits AS (SELECT g.gid, m.id AS master_id, 'A release group: ' || g.name || ' by ' || l.name || chr(10) || 'B master: ' || m.title || ' by ' || b.name || ' ' || l.url || chr(10)
      || 'Linked artists, release group and master have unique name (in artist context), names match, and both have earliest release on ' || g.year AS note
      FROM g JOIN bl_artist l ON l.gid = g.artist_gid JOIN b_artist b ON b.id = l.id JOIN b_masters_artists x ON x.artist_id = b.id
      JOIN b_master m ON m.id = x.master_id AND lower(m.title) = lower(g.name) AND m.year = g.year
      WHERE g.artist_gid NOT IN (SELECT artist_gid FROM g GROUP BY artist_gid, name HAVING count(gid) > 1))
    SELECT * FROM hits WHERE gid IN (SELECT gid FROM hits GROUP BY gid HAVING count(*) = 1)""")
def release_group_link_proposals(c):
    return pr.release_group_links(c.a, c.b, SITES)


@Q.add("""WITH one AS (SELECT r.gid, r.date_year AS year, r.country FROM al_release v JOIN a_release r ON r.id = v.id JOIN a_medium m ON m.release = r.id
      WHERE m.format IS NULL AND v.edits_pending = 0 GROUP BY r.gid, r.date_year, r.country HAVING count(v.url) = 1),
    hits AS (SELECT DISTINCT one.gid, m.format_id, l.url FROM one JOIN bl_release l ON l.gid = one.gid JOIN m_release m ON m.release_id = l.id AND m.country_id = one.country
      WHERE one.year IS NULL OR one.year = m.year)
    SELECT * FROM hits WHERE gid IN (SELECT gid FROM hits GROUP BY gid HAVING count(format_id) = 1)""")
def format_proposals(c):
    return pr.release_formats(c.a, c.b)


@Q.add(f"""SELECT DISTINCT l.gid, l.url, i.value FROM a_release r JOIN a_medium m ON m.release = r.id JOIN a_release_label rl ON rl.release = r.id JOIN bl_release l ON l.gid = r.gid
    JOIN m_release x ON x.release_id = l.id AND x.country_id = r.country AND x.year = r.date_year AND x.format_id = m.format JOIN b_release_identifier i ON i.release_id = l.id AND i.type = 'Barcode'
    JOIN b_releases_labels bl ON bl.release_id = l.id AND {catno('bl.catno')} = {catno('rl.catalog_number')}
    WHERE r.barcode IS NULL AND r.quality = -1 AND r.gid IN (SELECT gid FROM al_release GROUP BY gid HAVING count(url) = 1) AND regexp_matches(i.value, '^[0-9]{{12,13}}$')""")
def barcode_proposals(c):
    return pr.release_barcodes(c.a, c.b)


_RC = """SELECT r.gid AS release_gid, r.url AS release_url, a.gid AS artist_gid, a.url AS artist_url, x.roles FROM bl_release r JOIN b_releases_extraartists x ON x.release_id = r.id
    JOIN bl_artist a ON a.id = x.artist_id WHERE r.gid IN (SELECT gid FROM bl_release GROUP BY gid HAVING count(*) = 1) AND a.gid IN (SELECT gid FROM bl_artist GROUP BY gid HAVING count(*) = 1)"""


@Q.add(f"SELECT release_gid, release_url, artist_gid, artist_url, array_to_string(roles, ',') AS roles FROM ({_RC})")
def release_credits(c):
    return pr.release_credits(c.b).withColumn("roles", F.array_join("roles", ","))


@Q.add(f"""SELECT release_gid, release_url, artist_gid, artist_url FROM ({_RC}) c WHERE list_contains(roles, 'Producer') AND NOT EXISTS (SELECT 1 FROM a_l_artist_release e
    JOIN a_artist a ON a.id = e.entity0 JOIN a_release r ON r.id = e.entity1 WHERE e.link = 300 AND a.gid = c.artist_gid AND r.gid = c.release_gid)""")
def credit_proposals(c):
    return pr.credit_proposals(c.a, c.b).drop("roles")


_REMIX = f"""SELECT l.gid, r.id, r.title, t.position, t.title AS track_title, b.name, k.gid AS artist_gid FROM bl_release l JOIN b_release r ON r.id = l.id JOIN b_track t ON t.release_id = r.id
    JOIN b_tracks_extraartists x ON x.track_id = t.id JOIN b_artist b ON b.id = x.artist_id JOIN bl_artist k ON k.id = b.id
    WHERE x.role_name = 'Remix' AND x.role_details IS NULL AND x.anv = '' AND x.artist_id <> 0 AND lower(k.name) = {key('b.name')}"""


@Q.add(_REMIX)
def remix_credits(c):
    return pr.remix_credits(c.b)


@Q.add(f"""SELECT artist_gid, gid, min(note) AS note FROM (SELECT x.artist_gid, rec.gid, 'Release "' || x.title || '" {A}release/' || r.gid || ' has B link {B}release/' || x.id || chr(10)
      || 'There is track "' || rec.name || '" that is same as recording {A}recording/' || rec.gid || chr(10) || 'It is remixed by ' || x.name || ' linked artist found on A {A}artist/' || x.artist_gid AS note
      FROM ({_REMIX}) x JOIN a_release r ON r.gid = x.gid JOIN a_medium m ON m.release = r.id JOIN a_track t ON t.tracklist = m.tracklist JOIN a_recording rec ON rec.id = t.recording
      WHERE lower(rec.name) = lower(x.track_title) AND NOT EXISTS (SELECT 1 FROM a_l_artist_recording e JOIN a_artist a ON a.id = e.entity0 JOIN a_link k ON k.id = e.link
        WHERE k.link_type = 153 AND a.gid = x.artist_gid AND e.entity1 = rec.id)) GROUP BY artist_gid, gid""")
def remix_proposals(c):
    return pr.remix_proposals(c.a, c.b, SITES)


@Q.add(f"""WITH urls AS (SELECT DISTINCT r.release_group, u.url FROM a_l_release_url e JOIN a_link k ON k.id = e.link AND k.link_type = 76 JOIN a_release r ON r.id = e.entity0 JOIN a_url u ON u.id = e.entity1
      WHERE r.release_group NOT IN (SELECT entity0 FROM a_l_release_group_url x JOIN a_link y ON y.id = x.link WHERE y.link_type = 90)),
    m AS (SELECT u.release_group, count(u.url) AS n, count(b.master_id) AS k, min(b.master_id) AS lo, max(b.master_id) AS hi FROM urls u
      LEFT JOIN b_release b ON b.id = try_cast(regexp_extract(u.url, '^http://b\\.example/release/([0-9]+)', 1) AS BIGINT) GROUP BY u.release_group)
    SELECT g.gid, '{B}master/' || m.lo AS url, 'There are ' || m.n || ' distinct B links in this release group, and all point to this master URL.' || chr(10)
      || 'The name of the B master is “' || x.title || '” (similarity: 100%) by ' || (SELECT string_agg(artist_name, ' and ') FROM b_masters_artists p WHERE p.master_id = m.lo) || '.' AS note
    FROM m JOIN a_release_group g ON g.id = m.release_group JOIN b_master x ON x.id = m.lo WHERE m.n >= 2 AND m.k = m.n AND m.lo = m.hi AND lower(x.title) = lower(g.name)""")
def common_masters(c):
    """In this data a title is either equal when case is ignored or far from the threshold."""
    return pr.common_masters(c.a, c.b, SITES)


_NEARLY = "x.title || CASE m.lo // 48 % 4 WHEN 0 THEN '' WHEN 1 THEN ' II' WHEN 2 THEN '!' ELSE ' in a much longer form than before' END"
_COMMON = Q["common_masters"].oracle


@Q.add(_COMMON.replace("similarity: 100%", "similarity: ' || printf('%.0f', r * 100) || '%").replace("|| x.title ||", "|| t ||")
       .replace("WHERE m.n >= 2", "WHERE r >= 0.8 AND m.n >= 2").replace(" AND lower(x.title) = lower(g.name)", "")
       .replace("FROM m JOIN a_release_group g ON g.id = m.release_group JOIN b_master x ON x.id = m.lo", f"""FROM (SELECT m.*, {_NEARLY} AS t, g.gid, {ratio(f'lower({_NEARLY})', 'lower(g.name)')} AS r
      FROM m JOIN a_release_group g ON g.id = m.release_group JOIN b_master x ON x.id = m.lo WHERE m.n >= 2 AND m.k = m.n AND m.lo = m.hi) m""").replace("SELECT g.gid, '", "SELECT m.gid, '"))
def similar_masters(c):
    """Common masters whose titles differ a little, or too much, from the group's name."""
    i = F.floor(F.col("id") / 48) % 4
    more = F.when(i == 0, "").when(i == 1, " II").when(i == 2, "!").otherwise(" in a much longer form than before")
    b = Catalog({"release": c.b.release, "masters_artists": c.b.masters_artists, "master": c.b.master.withColumn("title", F.concat("title", more))})
    return pr.common_masters(c.a, b, SITES)


@Q.add("""SELECT id, artist_credit FROM a_release_group""")
def shuffled_groups(c):
    return pr.shuffled_groups(c.a.release_group.select("id", "artist_credit"), "artist_credit", "id", seed=7)


def _like(words) -> str:
    return " OR ".join(f"lower(comment) LIKE '{p}'" for w in words for p in (f"% {w}", f"% {w} %", f"{w} %"))


def _not_like(patterns) -> str:
    return " OR ".join(f"lower(comment) LIKE '{p}'" for p in patterns)


@Q.add(f"""SELECT DISTINCT gid, 1 AS type, '{pr.PERSON_NOTE}' AS note FROM a_artist WHERE type IS NULL AND ({_like(pr.PERSON_WORDS)}) AND NOT ({_not_like(pr.PERSON_NOT)})
    UNION ALL SELECT DISTINCT gid, 2, '{pr.GROUP_NOTE}' FROM a_artist WHERE type IS NULL AND ({_like(pr.GROUP_WORDS)}) AND NOT ({_not_like(pr.GROUP_NOT)})""")
def artist_type(c):
    return pr.artist_types(c.a.artist, 1).unionByName(pr.artist_types(c.a.artist, 2))


def _patterns(c):
    return pr.country_patterns(c.a.country, dictionaries.country_search(c.spark))


@Q.add("""SELECT DISTINCT p.country_id, a.gid, a.name, a.comment FROM a_artist a JOIN pat_country p ON lower(a.comment) LIKE p.pattern
    WHERE a.country IS NULL AND a.comment NOT LIKE '%?%' AND NOT regexp_matches(a.comment, '(?i)^[a-z]+[-/]')""")
def artist_country_from_comment(c):
    return pr.country_from_comment(c.a.artist, _patterns(c))


@Q.add("""SELECT DISTINCT p.country_id, l.gid, l.name, nullif(regexp_extract(b.profile, '^([^.]+\\.?)', 1), '') AS comment FROM bl_artist l JOIN b_artist b ON b.id = l.id
    JOIN pat_country p ON lower(b.profile) LIKE p.pattern WHERE l.gid IN (SELECT v.gid FROM al_artist v JOIN a_artist a ON a.id = v.id WHERE a.country IS NULL)
    AND b.profile NOT LIKE '%?%' AND NOT regexp_matches(b.profile, '(?i)^[a-z]+[-/]')""")
def artist_country_from_profile(c):
    return pr.country_from_profile(c.a, c.b, _patterns(c))


@Q.add("""SELECT e.id, a.gid, u.url FROM a_l_artist_url e JOIN a_url u ON u.id = e.entity1 JOIN a_artist a ON a.id = e.entity0 WHERE e.link = 26038 AND e.edits_pending = 0
    AND a.gid NOT IN (SELECT gid FROM bl_artist) AND a.id % 4 = 0
    UNION ALL SELECT e.id, a.gid, u.url FROM a_l_label_url e JOIN a_url u ON u.id = e.entity1 JOIN a_label a ON a.id = e.entity0 WHERE e.link = 27037 AND e.edits_pending = 0
    AND a.gid NOT IN (SELECT gid FROM bl_label) AND a.id % 4 = 0""")
def dead_links(c):
    """The crawl found every fourth address gone."""
    crawl = c.a.url.select("url", F.when(F.floor(F.col("id") / 16) % 4 == 0, 404).otherwise(200).alias("status"))
    both = pr.dead_link_candidates(c.a, c.b, "artist").unionByName(pr.dead_link_candidates(c.a, c.b, "label"))
    return pr.dead_links(both, crawl)


@Q.add("""SELECT e.id, k.link_type, 188 AS new_link_type FROM a_l_artist_url e JOIN a_url u ON u.id = e.entity1 JOIN a_link k ON k.id = e.link
    WHERE u.url LIKE 'http://rateyourmusic.com/%' AND e.link IN (26043, 26045, 26049, 26051, 26069)""")
def database_relations(c):
    return pr.database_relations(c.a)


@Q.add("""SELECT r.id, r.gid, r.name, u.url, m.format, k.name AS credit_name, 29 AS new_format FROM a_release r JOIN a_medium m ON m.release = r.id JOIN a_l_release_url e ON e.entity0 = r.id
    JOIN a_link l ON l.id = e.link AND l.link_type = 78 JOIN a_url u ON u.id = e.entity1 JOIN a_artist_credit k ON k.id = r.artist_credit
    WHERE u.url LIKE 'http://www.encyclopedisque.fr/images/%' AND (m.format IS NULL OR m.format = 7)
    AND NOT EXISTS (SELECT 1 FROM a_l_release_url x WHERE x.entity1 = u.id AND x.entity0 <> r.id) AND r.id % 3 <> 0""")
def seven_inch_formats(c):
    processed = c.a.release.filter("id % 3 = 0").select("gid")
    return pr.seven_inch_formats(c.a, processed).drop("note")


@Q.add("""SELECT o, n, p, row_number() OVER (PARTITION BY o ORDER BY n, p) AS row_number FROM line""")
def numbered_rows(c):
    return numbered(c.view("line").select("o", "n", "p"), ["o"], ["n", "p"], F.floor(F.col("n") / 4))


@Q.add("""SELECT w.gid, w.workid, w.iswc, 'http://www.ascap.com/ace/search.cfm?requesttimeout=300&mode=results&searchstr=' || w.workid || '&search_in=i&search_type=exact&search_det=t,s,w,p,b,v&results_pp=25&start=1' AS url
    FROM (SELECT a.gid, min(CASE WHEN s.p_partkey % 2 = 0 THEN s.p_partkey END) AS workid, 'T' || min(CASE WHEN s.p_partkey % 2 = 0 THEN s.p_type END) AS iswc,
      min(CASE WHEN s.p_partkey % 2 = 0 THEN s.p_type END) AS lo, max(CASE WHEN s.p_partkey % 2 = 0 THEN s.p_type END) AS hi
      FROM a_work a JOIN part x ON x.p_partkey = CAST(substr(a.gid, 3) AS BIGINT) JOIN part s ON s.p_brand = x.p_brand AND upper(s.p_name) = upper(x.p_name) AND s.p_partkey % 2 = 0 GROUP BY a.gid) w
    WHERE w.lo = w.hi""")
def iswc_push(c):
    """Works of the society are the even parts (code by part type, writer by brand)."""
    part = c.view("part")
    works = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.upper("p_name").alias("name"), F.concat(F.lit("T"), "p_type").alias("iswc"))
    writers = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("artist"), F.col("p_partkey").alias("work"))
    artists = part.select(F.col("p_partkey").alias("artist"), F.col("p_brand").alias("name"))
    own = c.a.work.withColumn("p_partkey", F.substr("gid", F.lit(3)).cast("bigint")).select("gid", "p_partkey").join(part, "p_partkey")
    own = own.select("gid", F.col("p_name").alias("name"), F.lit(None).cast("string").alias("iswc"), F.col("p_brand").alias("writer"))
    return prep.iswc_push(works, own, writers, artists).select("gid", "workid", "iswc", F.replace("note", F.lit("Data taken from "), F.lit("")).alias("url"))
