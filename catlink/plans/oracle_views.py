"""Derived tables in the SQL of the checking engine: links, resolved links, mappings."""

from __future__ import annotations

import re

from catlink.functions.text import LIGATURES, accent_table
from catlink.plans import shapes
from catlink.sources.dictionaries import COUNTRY_NAMES, COUNTRY_SEARCH, code_first


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"nullif(regexp_extract({c}, '^(.+?)(?: \\(\\d+\\))?$', 1), '')"


def key(c: str) -> str:
    return f"lower({strip(c)})"


def catno(c: str) -> str:
    return f"lower(replace({c}, ' ', ''))"


def enc(c: str) -> str:
    """Encoded name of the plain names in the shapes."""
    return f"replace(replace(replace(url_encode({c}), '%20', '+'), '%28', '('), '%29', ')')"


def mangle(c: str) -> str:
    old, new = accent_table()
    out = f"lower({c})"
    for letter, expansion in LIGATURES.items():
        out = f"replace({out}, {quote(letter)}, {quote(expansion)})"
    out = f"translate({out}, {quote(old)}, {quote(new)})"
    return f"regexp_replace(regexp_replace({out}, '\\(feat\\. [^)]+\\)$', ''), '[^\\p{{L}}\\p{{N}}_]', '', 'g')"


def rows(pairs: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(quote(x) for x in p) + ")" for p in pairs)


def _link(kind: str, link: int) -> str:
    return f"""SELECT x.id, x.name, x.gid, u.url, e.edits_pending FROM a_l_{kind}_url e
        JOIN a_url u ON u.id = e.entity1 JOIN a_{kind} x ON x.id = e.entity0 WHERE e.link = {link}"""


def _by_id(kind: str, path: str, target: str) -> str:
    number = f"try_cast(regexp_extract(url, '^http://b\\.example/{path}/([0-9]+)', 1) AS BIGINT)"
    return f"SELECT gid, name, url, {number} AS id, edits_pending FROM al_{kind} WHERE {number} IN (SELECT id FROM {target})"


def _by_name(kind: str) -> str:
    n = len(f"http://b.example/{kind}/") + 1
    return f"""SELECT l.gid, l.name, l.url, min(b.id) AS id, l.edits_pending FROM al_{kind} l
        JOIN b_{kind} b ON lower(b.name) = lower(substr(url_decode(replace(l.url, '+', ' ')), {n})) GROUP BY ALL"""


VIEWS: dict[str, str] = {
    "al_release": _link("release", 6301),
    "al_release_group": _link("release_group", 6309),
    "al_artist": _link("artist", 26038),
    "al_label": _link("label", 27037),
    "bl_release": _by_id("release", "release", "b_release"),
    "bl_release_group": _by_id("release_group", "master", "b_master"),
    "bl_artist": _by_name("artist"),
    "bl_label": _by_name("label"),
    "m_country": f"""SELECT c.id, n.iso_code, n.name FROM (VALUES {rows(code_first(COUNTRY_NAMES))}) n(iso_code, name)
        LEFT JOIN a_country c ON c.iso_code = n.iso_code UNION ALL SELECT id, iso_code, name FROM a_country""",
    "m_format": """SELECT DISTINCT f.release_id, m.format_id, m.a_name AS format_name FROM b_releases_formats f JOIN b_format_mapping m
        ON m.format_name = f.format_name AND (list_contains(f.descriptions, m.description) OR (m.description IS NULL AND NOT EXISTS (
          SELECT 1 FROM b_format_mapping s WHERE s.format_name = f.format_name AND list_contains(f.descriptions, s.description))))""",
    "m_status": """SELECT DISTINCT release_id, CASE WHEN list_has_any(descriptions, ['Promo', 'White Label', 'Test Pressing']) THEN 2
        WHEN list_has_any(descriptions, ['Unofficial Release', 'Partially Unofficial']) THEN 3 ELSE 1 END AS status FROM b_releases_formats""",
    "m_tracks": "SELECT release_id, count(id) AS count FROM b_track WHERE position <> '' GROUP BY release_id",
    "m_release": """SELECT DISTINCT r.id AS release_id, r.title, try_cast(CASE WHEN regexp_matches(r.released, '^[0-9]{4}') THEN left(r.released, 4) END AS INT) AS year,
        f.format_name, f.format_id, t.count AS track_count, s.status, c.id AS country_id, r.country
        FROM b_release r LEFT JOIN m_format f ON f.release_id = r.id LEFT JOIN m_tracks t ON t.release_id = r.id
        LEFT JOIN m_status s ON s.release_id = r.id LEFT JOIN m_country c ON c.name = r.country""",
    "pat_country": f"""SELECT DISTINCT c.id AS country_id, p AS pattern FROM a_country c
        LEFT JOIN (VALUES {rows(code_first(COUNTRY_SEARCH))}) s(iso_code, search) ON s.iso_code = c.iso_code,
        unnest(list_concat([lower(c.name) || '%'], coalesce(string_split(s.search, '|'), []))) AS u(p)""",
    "phrase": """SELECT * FROM (VALUES (300, 30, 'additional produced'), (301, 31, 'engineered'), (601, 60, 'alto vocals, lead vocals'), (1530, 153, 'remixed'),
        (1030, 103, 'member of'), (1080, 108, 'performs as')) v(link, link_type, phrase)""",
    "member": """SELECT a0.id AS id0, a0.gid AS gid0, a0.name AS name0, a1.id AS id1, a1.gid AS gid1, a1.name AS name1 FROM a_l_artist_artist l
        JOIN a_artist a0 ON a0.id = l.entity0 JOIN a_artist a1 ON a1.id = l.entity1 WHERE l.link = 1030""",
    "person": """SELECT a0.id AS id0, a0.gid AS gid0, a0.name AS name0, a1.id AS id1, a1.gid AS gid1, a1.name AS name1 FROM a_l_artist_artist l
        JOIN a_artist a0 ON a0.id = l.entity0 JOIN a_artist a1 ON a1.id = l.entity1 WHERE l.link = 1080""",
    "credited": """SELECT c.artist_credit, a.id AS artist, a.gid AS artist_gid, a.name AS artist_name
        FROM a_artist_credit_name c JOIN a_artist a ON a.id = c.artist""",
    "info_b_short": """SELECT r.id AS release_id, 'Format: ' || coalesce(f.v, '') || ', Country: ' || coalesce(r.country, '') || ', Date: ' || coalesce(r.released, '') || ', Tracks: ' || t.n
        || ', Barcode: ' || coalesce(b.v, '') || ', Label: ' || coalesce(l.v, '') AS info FROM b_release r
        LEFT JOIN (SELECT release_id, string_agg(CASE WHEN qty = 1 THEN '' ELSE qty || ' × ' END || format_name || ', ' || array_to_string(descriptions, ', ') || CASE WHEN text = '' THEN '' ELSE ', ' || text END, ', '
            ORDER BY CASE WHEN qty = 1 THEN '' ELSE qty || ' × ' END || format_name) AS v FROM b_releases_formats GROUP BY 1) f ON f.release_id = r.id
        LEFT JOIN (SELECT release_id, count(*) AS n FROM b_track WHERE position <> '' GROUP BY 1) t ON t.release_id = r.id
        LEFT JOIN (SELECT release_id, string_agg(DISTINCT value, ', ' ORDER BY value) AS v FROM b_release_identifier WHERE type = 'Barcode' GROUP BY 1) b ON b.release_id = r.id
        LEFT JOIN (SELECT release_id, string_agg(label || ' - ' || catno, ', ' ORDER BY label || ' - ' || catno) AS v FROM b_releases_labels GROUP BY 1) l ON l.release_id = r.id""",
    "info_b_long": """SELECT r.id AS release_id, replace('Release information|  Released: ' || coalesce(r.released, '') || '|  Country: ' || coalesce(r.country, '') || '|  Barcode: ' || coalesce(b.v, '') || '|  Format: '
        || coalesce(f.v, '') || '||Additional details|  Genre: ' || array_to_string(r.genres, ', ') || '|  Style: ' || array_to_string(r.styles, ', ') || '|  Data Quality: ' || r.data_quality || '||Labels|  ' || coalesce(l.v, '') || '|'
        || CASE WHEN r.notes IS NULL THEN '' ELSE '|Notes|' || r.notes || '|' END || CASE WHEN i.v IS NULL THEN '' ELSE '|Other identifiers|  ' || i.v || '|' END, '|', chr(13) || chr(10)) AS info FROM b_release r
        LEFT JOIN (SELECT release_id, string_agg(CASE WHEN qty = 1 THEN '' ELSE qty || ' × ' END || format_name || ', ' || array_to_string(descriptions, ', ') || CASE WHEN text = '' THEN '' ELSE ', ' || text END, '|    '
            ORDER BY format_name) AS v FROM b_releases_formats GROUP BY 1) f ON f.release_id = r.id
        LEFT JOIN (SELECT release_id, CASE WHEN count(*) > 2 THEN string_agg(v, '|    ' ORDER BY v) ELSE string_agg(v, ', ' ORDER BY v) END AS v FROM
            (SELECT DISTINCT release_id, value || CASE WHEN coalesce(description, '') = '' THEN '' ELSE ' (' || description || ')' END AS v FROM b_release_identifier WHERE type = 'Barcode') GROUP BY 1) b ON b.release_id = r.id
        LEFT JOIN (SELECT release_id, string_agg(label || ' - ' || catno, '|  ' ORDER BY label || ' - ' || catno) AS v FROM b_releases_labels GROUP BY 1) l ON l.release_id = r.id
        LEFT JOIN (SELECT release_id, string_agg(v, '|  ' ORDER BY v) AS v FROM (SELECT release_id, type || ': ' || string_agg(v, '|    ' ORDER BY v) AS v FROM
            (SELECT release_id, type, value || CASE WHEN coalesce(description, '') = '' THEN '' ELSE ' (' || description || ')' END AS v FROM b_release_identifier WHERE type <> 'Barcode') GROUP BY release_id, type) GROUP BY 1) i ON i.release_id = r.id""",
    "info_a_parts": """SELECT r.id, r.barcode, c.iso_code, p.name AS packaging, s.name AS status, g.name AS language, w.name AS script, r.quality,
        coalesce(CAST(r.date_year AS VARCHAR), '') || CASE WHEN r.date_month IS NULL THEN '' ELSE '-' || lpad(CAST(r.date_month AS VARCHAR), 2, '0') || CASE WHEN r.date_day IS NULL THEN '' ELSE '-' || lpad(CAST(r.date_day AS VARCHAR), 2, '0') END END AS date,
        (SELECT string_agg(CASE WHEN n = 1 THEN name ELSE n || ' × ' || name END, ', ' ORDER BY CASE WHEN n = 1 THEN name ELSE n || ' × ' || name END) FROM (SELECT m.release, f.name, count(*) AS n FROM a_medium m JOIN a_medium_format f ON f.id = m.format GROUP BY ALL) z WHERE z.release = r.id) AS format,
        (SELECT CAST(sum(t.track_count) AS BIGINT) FROM a_medium m JOIN a_tracklist t ON t.id = m.tracklist WHERE m.release = r.id) AS tracks,
        (SELECT string_agg(l.name || ' - ' || x.catalog_number, '@' ORDER BY l.name || ' - ' || x.catalog_number) FROM a_release_label x JOIN a_label l ON l.id = x.label WHERE x.release = r.id) AS label,
        y.name || CASE WHEN q.v IS NULL THEN '' ELSE ' + ' || q.v END AS type
        FROM a_release r LEFT JOIN a_country c ON c.id = r.country LEFT JOIN a_release_packaging p ON p.id = r.packaging LEFT JOIN a_release_status s ON s.id = r.status
        LEFT JOIN a_language g ON g.id = r.language LEFT JOIN a_script w ON w.id = r.script LEFT JOIN a_release_group rg ON rg.id = r.release_group LEFT JOIN a_release_group_primary_type y ON y.id = rg.type
        LEFT JOIN (SELECT j.release_group, string_agg(t.name, ', ' ORDER BY t.name) AS v FROM a_release_group_secondary_type_join j JOIN a_release_group_secondary_type t ON t.id = j.secondary_type GROUP BY 1) q ON q.release_group = rg.id""",
    "info_a_short": """SELECT id AS release_id, array_to_string(list_filter(['Format: ' || format, 'Country: ' || iso_code, 'Date: ' || date, 'Tracks: ' || tracks, 'Barcode: ' || barcode, 'Label: ' || replace(label, '@', ', '),
        'Type: ' || type, 'Packaging: ' || packaging, 'Status: ' || status], lambda x: x IS NOT NULL), ', ') AS info FROM info_a_parts""",
    "info_a_long": """SELECT id AS release_id, array_to_string(list_filter(['Release information', '  Date: ' || date, '  Country: ' || iso_code, '  Barcode: ' || barcode, '  Format: ' || format, '', 'Additional details',
        '  Type: ' || type, '  Packaging: ' || packaging, '  Status: ' || status, '  Language: ' || language, '  Script: ' || script,
        '  Data Quality: ' || CASE WHEN quality IN (-1, 1) THEN 'Normal' WHEN quality = 0 THEN 'Low' ELSE 'High' END, '', 'Labels', coalesce(replace(label, '@', chr(13) || chr(10) || '  '), '')], lambda x: x IS NOT NULL), chr(13) || chr(10)) AS info FROM info_a_parts""",
}


def oracle(sql: str) -> str:
    """Complete query text: the view definitions it needs, then the query."""
    known = {**shapes.VIEWS, **VIEWS}
    order: list[str] = []
    open_views: set[str] = set()

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_]+", text):
            if word in known and word not in order and word not in open_views:
                open_views.add(word)
                visit(known[word])
                open_views.discard(word)
                order.append(word)

    visit(sql)
    own = sql.strip()
    if not order:
        return own
    head = "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order)
    return f"{head},\n{own[5:]}" if own.startswith("WITH ") else f"{head}\n{own}"


def ratio(a: str, b: str) -> str:
    """Twice the longest common subsequence over both lengths, by the plain dynamic programme: one row of cells for each letter of ``b``."""
    cell = "greatest(row_[i_], CASE WHEN same_[i_] = 1 THEN coalesce(row_[i_ - 1], 0) + 1 ELSE 0 END)"
    same = f"list_transform(string_split({b}, ''), lambda y_: list_transform(string_split({a}, ''), lambda x_: CASE WHEN x_ = y_ THEN 1 ELSE 0 END))"
    step = f"list_transform(range(1, len(same_) + 1), lambda j_: CAST(list_max(list_transform(range(1, j_ + 1), lambda i_: {cell})) AS INTEGER))"
    start = f"list_transform(string_split({a}, ''), lambda x_: 0)"
    return f"(2.0 * list_last(list_reduce({same}, lambda row_, same_: {step}, {start})) / (length({a}) + length({b})))"
