"""Registered queries for encyclopedia pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.config import LINK_TYPE
from catlink.operators.wiki import facts, matching, search, worklists
from catlink.plans.oracle_views import mangle
from catlink.plans.registry import Registry
from catlink.sources import dictionaries
from catlink.sources.dictionaries import demonyms

Q = Registry()

# Work lists ------------------------------------------------------------------------------------


def _done(kind: str, link: int, prefix: str = "") -> str:
    return f"SELECT e.entity0 FROM a_l_{kind}_url e JOIN a_url u ON u.id = e.entity1 WHERE e.link = {link} AND u.url LIKE '{prefix}%'"


def _ledger(c, kind: str):
    rows = getattr(c.a, kind)
    return rows.filter("id % 6 = 0").select("gid", F.when(F.col("id") % 12 == 0, "en").otherwise("fr").alias("lang"))


@Q.add(f"""SELECT a.id, a.gid, a.name, c.iso_code AS country FROM a_artist a LEFT JOIN a_country c ON c.id = a.country WHERE a.id > 2
    AND a.id NOT IN ({_done('artist', 17900, 'http://en.wikipedia.org/wiki/')}) AND a.id % 12 <> 0""")
def artists_without_page(c):
    return worklists.artists(c.a, "en", _ledger(c, "artist"))


@Q.add(f"""SELECT a.id, a.gid, a.name, c.iso_code AS country FROM a_artist a LEFT JOIN a_country c ON c.id = a.country WHERE a.id > 2 AND (c.iso_code IS NULL OR c.iso_code IN ('FR', 'MC'))
    AND a.id NOT IN ({_done('artist', 17900, 'http://fr.wikipedia.org/wiki/')}) AND NOT (a.id % 6 = 0 AND a.id % 12 <> 0)""")
def artists_without_french_page(c):
    return worklists.artists(c.a, "fr", _ledger(c, "artist"))


@Q.add(f"""SELECT g.id, g.gid, g.name, k.name AS credit_name, t.name AS type_name FROM a_release_group g JOIN a_artist_credit k ON k.id = g.artist_credit LEFT JOIN a_release_group_type t ON t.id = g.type
    WHERE g.artist_credit > 2 AND g.id NOT IN ({_done('release_group', 8900, 'http://fr.wikipedia.org/wiki/')}) AND (g.type IS NULL OR t.name IN ('Album', 'EP', 'Soundtrack'))
    AND (SELECT count(c.iso_code) FROM a_artist_credit_name n JOIN a_artist a ON a.id = n.artist LEFT JOIN a_country c ON c.id = a.country AND c.iso_code IN ('FR', 'MC') WHERE n.artist_credit = g.artist_credit) = 1
    AND NOT (g.id % 6 = 0 AND g.id % 12 <> 0)""")
def release_groups_without_page(c):
    return worklists.release_groups(c.a, "fr", _ledger(c, "release_group"))


@Q.add(f"SELECT id, gid, name FROM a_label WHERE id > 2 AND id NOT IN ({_done('label', 21600)}) AND id % 6 <> 0")
def labels_without_page(c):
    return worklists.labels(c.a, _ledger(c, "label"))


@Q.add(f"""SELECT id, gid, name, false AS in_script FROM a_artist WHERE id > 2 AND id NOT IN ({_done('artist', 17900)}) AND id % 6 <> 0
    AND id IN (SELECT n.artist FROM a_artist_credit_name n JOIN a_release r ON r.artist_credit = n.artist_credit WHERE r.country = 3)""")
def artists_with_korean_releases(c):
    return worklists.artists_in_script(c.a, "ko", _ledger(c, "artist"))


@Q.add(f"""SELECT a.id, a.gid, min(u.url) AS url FROM a_artist a JOIN a_l_artist_url e ON e.entity0 = a.id AND e.link = 17900 AND e.edits_pending = 0 JOIN a_url u ON u.id = e.entity1
    WHERE (a.country IS NULL OR a.type IS NULL OR (coalesce(a.type, 1) = 1 AND (a.begin_date_year IS NULL OR a.gender IS NULL)) OR (coalesce(a.type, 2) = 2 AND a.begin_date_year IS NULL))
    AND u.url LIKE 'http://en.wikipedia.org/wiki/%' AND a.id % 6 <> 0 GROUP BY a.id, a.gid""")
def artists_lacking_data(c):
    return worklists.artists_lacking_data(c.a, "en", _ledger(c, "artist")).select("id", "gid", "url")


# Titles ---------------------------------------------------------------------------------------------

_TOKENS = "list_distinct(regexp_extract_all(lower(%s), '[\\p{L}\\p{N}_]+'))"
_SCORES = f"""WITH q AS (SELECT DISTINCT list_sort({_TOKENS % 'name'}) AS query FROM w_artist), t AS (SELECT DISTINCT title, {_TOKENS % 'title'} AS words FROM w_page),
    p AS (SELECT title, unnest(words) AS word FROM t), df AS (SELECT word, CAST(round(1000 * ln(1 + (SELECT count(*) FROM t WHERE len(words) > 0) / count(*))) AS BIGINT) AS weight FROM p GROUP BY word),
    tw AS (SELECT title, sum(weight) AS title_weight FROM p JOIN df USING (word) GROUP BY title), qp AS (SELECT query, unnest(query) AS word FROM q),
    qw AS (SELECT query, sum(coalesce(weight, 20000)) AS weight FROM qp LEFT JOIN df USING (word) GROUP BY query),
    c AS (SELECT query, title, sum(df.weight) AS common, count(*) AS n FROM qp JOIN p USING (word) JOIN df USING (word) GROUP BY query, title),
    s AS (SELECT query, title, n, common / (qw.weight + title_weight - common) AS score FROM c JOIN qw USING (query) JOIN tw USING (title)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, title) AS rank FROM s WHERE %s)
    SELECT a.id, r.title, r.score, r.rank FROM w_artist a JOIN r ON r.query = list_sort({_TOKENS % 'a.name'})"""


@Q.add(_SCORES % "true" + " WHERE rank <= 50")
def title_search(c):
    """The 50 best titles for each name, any word sufficing."""
    return search.search_titles(c.view("w_artist"), c.title_index)


@Q.add(_SCORES % "n >= 2")
def title_search_two_words(c):
    """All titles that share two or more words with a name, ranked."""
    return search.search_titles(c.view("w_artist"), c.title_index, None, 2)


def _match_sql(skip: bool) -> str:
    rule = "AND NOT (t.title LIKE '%album)' OR t.title LIKE '%song)')" if skip else ""
    return f"""SELECT a.id, t.title, t.whole = a.k AS exact FROM (SELECT id, {mangle('name')} AS k FROM w_artist) a
        JOIN (SELECT DISTINCT title, {mangle('title')} AS whole, {mangle("regexp_replace(title, ' \\(.+\\)$', '')")} AS cut FROM w_page) t ON (t.whole = a.k OR t.cut = a.k) AND a.k <> '' {rule}"""


@Q.add(_match_sql(True))
def title_matches(c):
    return matching.match_titles(c.view("w_artist"), c.view("w_page"))


_USABLE = f"""SELECT title, doc_id, lang, text, page FROM (SELECT *, {mangle('text')} AS page FROM w_page WHERE title NOT LIKE '%disambiguation%' AND NOT contains(lower(text), '{{{{disamb'))
    WHERE NOT contains(page, 'redirect') AND NOT contains(page, 'disambiguationpages') AND NOT contains(page, 'homonymie') AND NOT contains(page, 'infoboxalbum')"""


@Q.add(f"SELECT title, md5(page) AS page FROM ({_USABLE})")
def usable_pages(c):
    return matching.usable_pages(c.view("w_page"), "artist").select("title", F.md5("page").alias("page"))


@Q.add("SELECT doc_id, regexp_matches(text, '\\[\\[Category:[^\\]]* (albums|soundtracks)\\]\\]') AS album FROM w_page")
def album_pages(c):
    return c.view("w_page").select("doc_id", matching.is_album_page("text", "en").alias("album"))


# Mentions --------------------------------------------------------------------------------------------

_MENTIONS = f"""WITH cand AS ({_match_sql(True)}), pg AS ({_USABLE}), names AS (SELECT id, name, {mangle('name')} AS k FROM w_artist),
    item AS (SELECT DISTINCT t.id, t.name, {mangle('t.name')} AS m, n.name AS own FROM w_title t JOIN names n ON n.id = t.id WHERE NOT contains({mangle('t.name')}, n.k)),
    total AS (SELECT id, own, count(*) AS n_titles FROM item GROUP BY id, own),
    r AS (SELECT c.id, c.title, c.exact, t.n_titles, t.own, (SELECT count(*) FROM item i WHERE i.id = c.id AND length(i.m) > 6 AND contains(p.page, i.m)) AS n_found,
        (SELECT list_sort(list(i.name)) FROM item i WHERE i.id = c.id AND length(i.m) > 6 AND contains(p.page, i.m)) AS found
      FROM cand c JOIN pg p ON p.title = c.title JOIN total t ON t.id = c.id)"""


def _artist_mentions(c, lang=None):
    people, pages = c.view("w_artist"), c.view("w_page")
    pages = matching.in_language(pages, lang) if lang else pages
    candidates = matching.match_titles(people, pages)
    good = matching.usable_pages(matching.candidate_pages(pages, candidates), "artist")
    return matching.mentions(people, candidates, good, c.view("w_title"), matching.RULES["artist"]), candidates


@Q.add(_MENTIONS + """ SELECT id, title, n_titles, n_found, n_found / n_titles AS ratio, array_to_string(found[1:3], '|') AS first_found,
    n_found / n_titles >= CASE WHEN length(own) > 15 THEN 0.15 ELSE 0.3 END AS accepted FROM r""")
def mention_ratio(c):
    return _artist_mentions(c)[0].withColumn("first_found", F.array_join("first_found", "|"))


@Q.add(_MENTIONS + """ SELECT id, title FROM (SELECT id, title, row_number() OVER (PARTITION BY id ORDER BY NOT exact, title) AS rn FROM r
    WHERE n_found / n_titles >= CASE WHEN length(own) > 15 THEN 0.15 ELSE 0.3 END) WHERE rn = 1""")
def best_candidate(c):
    rows, candidates = _artist_mentions(c)
    return matching.first_accepted(rows, candidates).select("id", "title")


_JA = f"""WITH names AS (SELECT id, name, {mangle('name')} AS k FROM w_artist), cand AS ({_match_sql(True)}),
    item AS (SELECT DISTINCT t.id, t.name, {mangle('t.name')} AS m FROM w_title t JOIN names n ON n.id = t.id WHERE NOT contains({mangle('t.name')}, n.k)),
    r AS (SELECT c.id, c.title, (SELECT count(*) FROM item i WHERE i.id = c.id) AS n, (SELECT count(*) FROM item i WHERE i.id = c.id AND length(i.m) > 4 AND contains(p.page, i.m)) AS k
      FROM cand c JOIN (SELECT title, {mangle('text')} AS page FROM w_page) p ON p.title = c.title)
    SELECT id, title, n AS n_titles, k AS n_found, k >= 2 AND k / n >= 0.2 AS accepted FROM r WHERE n > 0"""


@Q.add(_JA)
def mention_ratio_japanese(c):
    people, pages = c.view("w_artist"), c.view("w_page")
    rows = matching.mentions(people, matching.match_titles(people, pages), matching.usable_pages(pages, "ja"), c.view("w_title"), matching.RULES["ja"])
    return rows.select("id", "title", "n_titles", "n_found", "accepted")


def _plain_mentions(entities: str, pages: str, drop: str, item_filter: str, counts: str) -> str:
    """Candidates with the number of their titles, and of those on the page, by plain containment."""
    return f"""WITH names AS (SELECT id, name, {mangle('name')} AS k FROM {entities}), cand AS ({_match_sql(False).replace('w_artist', entities)}), pg AS ({pages}),
    item AS (SELECT DISTINCT t.id, t.name, {mangle('t.name')} AS m FROM w_title t JOIN names n ON n.id = t.id WHERE {drop} AND {item_filter}),
    r AS (SELECT c.id, c.title, c.exact, (SELECT count(*) FROM item i WHERE i.id = c.id) AS n, (SELECT count(*) FROM item i WHERE i.id = c.id AND {counts} AND contains(p.page, i.m)) AS k,
        (SELECT list_sort(list(i.name)) FROM item i WHERE i.id = c.id AND {counts} AND contains(p.page, i.m)) AS found, p.page FROM cand c JOIN pg p ON p.title = c.title)"""


def _note(kind: str, lead: str, n: str = "k") -> str:
    """The note of a proposal: up to three names, then how many more."""
    names = [f"found[{i}]" for i in (1, 2, 3)]
    quoted = ["'\"' || " + x + " || '\"'" for x in names]
    return (f"'Matched based on the name. The page mentions ' || {lead}CASE {n} WHEN 1 THEN '{kind} ' || {quoted[0]} WHEN 2 THEN '{kind}s ' || {quoted[0]} || ' and ' || {quoted[1]} "
            f"WHEN 3 THEN '{kind}s ' || {quoted[0]} || ', ' || {quoted[1]} || ' and ' || {quoted[2]} "
            f"ELSE '{kind}s ' || {quoted[0]} || ', ' || {quoted[1]} || ', ' || {quoted[2]} || ' and ' || CAST({n} - 3 AS VARCHAR) || ' more' END || '.'")


_URL = "'http://en.wikipedia.org/wiki/' || replace(url_encode(replace(b.title, ' ', '_')), '%2F', '/') AS url"
_BEST = "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY NOT exact, title) AS rn FROM r WHERE %s) WHERE rn = 1)"
_LABEL_PAGES = f"SELECT title, {mangle('text')} AS page FROM w_page WHERE contains({mangle('text')}, 'recordlabels') AND NOT contains({mangle('text')}, 'disambiguationpages') AND %s"
_LABELS = _plain_mentions("w_artist", _LABEL_PAGES, "t.name <> n.name", "true", "length(i.m) > 5")


@Q.add(_LABELS % "true" + " SELECT id, title, n AS n_titles, k AS n_found, k >= 2 AS accepted FROM r WHERE n > 0")
def mention_count_label(c):
    rows = matching.label_mentions(c.view("w_artist"), c.view("w_page"), c.view("w_title"))[0]
    return rows.select("id", "title", "n_titles", "n_found", "accepted")


@Q.add(_LABELS % "lang = 'en'" + ", " + _BEST % "n > 0 AND k >= 2" + f" SELECT a.gid, {_URL}, md5({_note('artist', '')}) AS note FROM best b JOIN w_artist a ON a.id = b.id")
def label_page_proposals(c):
    found = matching.match_labels(c.view("w_artist"), c.view("w_page"), c.view("w_title"))
    return found.withColumn("note", F.md5("note"))


_ALBUM_PAGES = f"""SELECT title, {mangle('text')} AS page FROM w_page WHERE NOT contains(title, 'disambiguation') AND NOT contains(lower(text), '{{{{disambig')
    AND regexp_matches(text, '\\[\\[Category:[^\\]]* (albums|soundtracks)\\]\\]') AND NOT contains({mangle('text')}, 'redirect') AND NOT contains({mangle('text')}, 'disambiguationpages')
    AND NOT contains({mangle('text')}, 'homonymie') AND %s"""
_GROUPS = _plain_mentions("w_group", _ALBUM_PAGES, f"NOT contains({mangle('t.name')}, n.k)", f"length({mangle('t.name')}) > 4", "true")
_GROUP_RULE = f"n >= 5 AND contains(page, (SELECT {mangle('g.credit_name')} FROM w_group g WHERE g.id = r.id))"
_AUTO = "k / n > 0.75 AND coalesce(g.type_name NOT IN ('Compilation', 'Soundtrack'), true) AS auto"


@Q.add(_GROUPS % "lang = 'en'" + f" SELECT r.id, title, n AS n_titles, k AS n_found, k / n >= 0.7 AS accepted, {_AUTO} FROM r JOIN w_group g ON g.id = r.id WHERE {_GROUP_RULE}")
def mention_ratio_release_group(c):
    rows = matching.release_group_mentions(c.view("w_group"), matching.in_language(c.view("w_page"), "en"), c.view("w_title"), "en")[0]
    return rows.select("id", "title", "n_titles", "n_found", "accepted", "auto")


@Q.add(_GROUPS % "lang = 'en'" + ", " + _BEST % f"{_GROUP_RULE} AND k / n >= 0.7" + f""" SELECT g.gid, {_URL}, md5({_note('track', "'artist \"' || g.credit_name || '\" and ' || ")}) AS note, {_AUTO}
    FROM best b JOIN w_group g ON g.id = b.id""")
def release_group_page_proposals(c):
    found = matching.match_release_groups(c.view("w_group"), c.view("w_page"), c.view("w_title"), "en")
    return found.select("gid", "url", F.md5("note").alias("note"), "auto")


@Q.add(_MENTIONS.replace("w_page", "(SELECT * FROM w_page WHERE lang = 'en')") + """, best AS (SELECT id, title, n_found, found FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY NOT exact, title) AS rn FROM r
      WHERE n_found / n_titles >= CASE WHEN length(own) > 15 THEN 0.15 ELSE 0.3 END) WHERE rn = 1)
    SELECT w.gid, 'http://en.wikipedia.org/wiki/' || replace(url_encode(replace(b.title, ' ', '_')), '%2F', '/') AS url, n_found,
      md5('Matched based on the name. The page mentions ' || CASE n_found WHEN 1 THEN 'album "' || found[1] || '"' WHEN 2 THEN 'albums "' || found[1] || '" and "' || found[2] || '"'
      WHEN 3 THEN 'albums "' || found[1] || '", "' || found[2] || '" and "' || found[3] || '"' ELSE 'albums "' || found[1] || '", "' || found[2] || '", "' || found[3] || '" and ' || CAST(n_found - 3 AS VARCHAR) || ' more' END || '.') AS note
    FROM best b JOIN w_artist w ON w.id = b.id""")
def artist_page_proposals(c):
    people, pages = c.view("w_artist"), c.view("w_page")
    found = matching.match_artists(people, pages, c.view("w_title"), "en")
    rows, candidates = _artist_mentions(c, "en")
    n = matching.first_accepted(rows, candidates).select("id", "n_found").join(people.select("id", "gid"), "id").select("gid", "n_found")
    return found.join(n, "gid").select("gid", "url", "n_found", F.md5("note").alias("note"))


@Q.add("""SELECT id, name FROM (SELECT n.artist AS id, g.name FROM a_release_group g JOIN a_artist_credit_name n ON n.artist_credit = g.artist_credit
    UNION SELECT n.artist, r.name FROM a_release r JOIN a_artist_credit_name n ON n.artist_credit = r.artist_credit)""")
def artist_titles(c):
    return matching.artist_titles(c.a)


@Q.add("""SELECT DISTINCT r.release_group AS id, t.name FROM a_track t JOIN a_medium m ON m.tracklist = t.tracklist JOIN a_release r ON r.id = m.release""")
def release_group_tracks(c):
    return matching.release_group_tracks(c.a)


@Q.add("""SELECT DISTINCT l.label AS id, a.name FROM a_release_label l JOIN a_release r ON r.id = l.release JOIN a_artist_credit_name n ON n.artist_credit = r.artist_credit JOIN a_artist a ON a.id = n.artist""")
def label_artists(c):
    return matching.label_artists(c.a)


# Facts ---------------------------------------------------------------------------------------------------


def _pages(c):
    return c.parsed_pages


_IN_TEXT = """SELECT doc_id, 'FR' AS code FROM w_page WHERE doc_id % 7 = 0 UNION ALL SELECT doc_id, 'CA' FROM w_page WHERE doc_id % 7 = 1
    UNION ALL SELECT doc_id, 'FR' FROM w_page WHERE doc_id % 4 IN (0, 1) UNION ALL SELECT doc_id, 'US' FROM w_page WHERE doc_id % 4 = 2"""


@Q.add(f"""WITH cat AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\[\\[Category:(.+?)(?:\\|.*?)?\\]\\]', 1)) AS c FROM w_page),
    by_cat AS (SELECT cat.doc_id, d.code FROM cat JOIN (VALUES {", ".join(f"('{n}', '{k}')" for n, k in demonyms("en"))}) d(name, code) ON contains(cat.c, d.name)
      UNION ALL SELECT doc_id, 'US' FROM cat WHERE c LIKE '%from Texas')
    SELECT CAST(doc_id AS VARCHAR) AS title, min(code) AS country FROM (SELECT * FROM by_cat UNION ALL SELECT * FROM ({_IN_TEXT}) WHERE doc_id IN (SELECT doc_id FROM by_cat)) GROUP BY doc_id HAVING count(DISTINCT code) = 1""")
def page_country(c):
    return facts.country(_pages(c), facts.place_dictionary(c.view("w_place")), "en").select("title", "country")


_COUNTRY_SQL = Q["page_country"].oracle
_COUNTRY_OF = f"SELECT p.title, min(k.country) AS page_country FROM ({_COUNTRY_SQL}) k JOIN w_page p ON CAST(p.doc_id AS VARCHAR) = k.title GROUP BY p.title"


@Q.add(_MENTIONS + f""" SELECT w.gid, r.n_found, k.page_country FROM r JOIN w_artist w ON w.id = r.id LEFT JOIN ({_COUNTRY_OF}) k ON k.title = r.title
    WHERE n_found / n_titles >= CASE WHEN length(own) > 15 THEN 0.15 ELSE 0.3 END AND (w.country IN ('FR', 'MC') OR k.page_country IN ('FR', 'MC'))""")
def country_gate(c):
    """Accepted pages whose text or artist is of a country of the French encyclopedia."""
    rows = _artist_mentions(c)[0].filter("accepted").join(c.view("w_artist").select("id", "gid", "country"), "id")
    places = facts.country(_pages(c), facts.place_dictionary(c.view("w_place")), "en").select(F.col("title").alias("k"), "country")
    titled = c.view("w_page").select("title", F.col("doc_id").cast("string").alias("k")).join(places, "k").groupBy("title").agg(F.min("country").alias("page_country"))
    return matching.country_gate(rows.join(titled, "title", "left"), "fr").select("gid", "n_found", "page_country")


_PRONOUN = "len(regexp_extract_all(text, '(?i)\\b(?:%s)\\b'))"


@Q.add(f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_PRONOUN % 'he|his'} AS male, {_PRONOUN % 'she|her'} AS female, {_PRONOUN % 'il'} AS male_fr, {_PRONOUN % 'elle'} AS female_fr FROM documents""")
def pronoun_vote(c):
    n = {k: facts.pronoun_count("text", facts.PRONOUNS[lang][g]) for k, lang, g in (
        ("male", "en", "male"), ("female", "en", "female"), ("male_fr", "fr", "male"), ("female_fr", "fr", "female"))}
    return c.view("documents").select(F.col("doc_id").cast("string").alias("doc_id"), *[v.alias(k) for k, v in n.items()])


@Q.add(f"""WITH v AS (SELECT doc_id, {_PRONOUN % 'he|his'} AS m, {_PRONOUN % 'she|her'} AS f FROM w_page),
    g AS (SELECT doc_id, 'male' AS g FROM w_page WHERE doc_id % 6 = 0 UNION ALL SELECT doc_id, 'female' FROM w_page WHERE doc_id % 6 = 2
      UNION ALL SELECT doc_id, 'male' FROM v WHERE m > 2 AND f = 0 UNION ALL SELECT doc_id, 'female' FROM v WHERE f > 2 AND m = 0)
    SELECT CAST(doc_id AS VARCHAR) AS title, min(g) AS gender FROM g GROUP BY doc_id HAVING count(DISTINCT g) = 1""")
def page_gender(c):
    return facts.gender(_pages(c), "en").select("title", "gender")


@Q.add("""WITH t AS (SELECT doc_id, 'person' AS t FROM w_page WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, 'group' FROM w_page WHERE doc_id % 5 = 1 UNION ALL SELECT doc_id, 'group' FROM w_page WHERE doc_id % 8 = 1)
    SELECT CAST(doc_id AS VARCHAR) AS title, min(t) AS type FROM t GROUP BY doc_id HAVING count(DISTINCT t) = 1""")
def page_type(c):
    return facts.artist_type(_pages(c), "en").select("title", "type")


@Q.add("""SELECT CAST(doc_id AS VARCHAR) AS title, CASE WHEN doc_id % 3 = 0 THEN 1950 WHEN doc_id % 8 = 0 THEN 1960 END AS year, CASE WHEN doc_id % 3 = 0 THEN 1 + doc_id % 12 END AS month,
    CASE WHEN doc_id % 3 = 0 THEN 7 END AS day, CASE WHEN doc_id % 8 = 1 THEN 1970 END AS group_year FROM w_page""")
def page_dates(c):
    d = facts.dates(_pages(c), "en")
    return d.select("title", "person_begin.year", "person_begin.month", "person_begin.day", F.col("group_begin.year").alias("group_year"))


@Q.add(f"SELECT entity1 AS id FROM a_l_artist_artist e JOIN a_link l ON l.id = e.link WHERE l.link_type = {LINK_TYPE['performs_as']} GROUP BY 1")
def performance_names(c):
    return facts.performance_names(c.a)


@Q.add(f"""WITH ctry AS ({Q["page_country"].oracle}), gen AS ({Q["page_gender"].oracle}),
    f AS (SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 5 END AS country, CASE WHEN doc_id % 3 = 0 THEN 1 END AS type, CASE WHEN doc_id % 2 = 1 THEN 1 END AS gender, k.id AS new_country,
      CASE g.gender WHEN 'male' THEN 1 WHEN 'female' THEN 2 END AS new_gender, CASE WHEN doc_id % 3 = 0 OR doc_id % 5 = 0 THEN 1 WHEN doc_id % 5 = 1 OR doc_id % 8 = 1 THEN 2 END AS new_type
      FROM documents LEFT JOIN ctry c ON c.title = CAST(doc_id AS VARCHAR) LEFT JOIN gen g ON g.title = CAST(doc_id AS VARCHAR) LEFT JOIN a_country k ON k.iso_code = c.country),
    t AS (SELECT *, CASE WHEN type IS NULL AND id % 5 = 0 AND id % 8 = 1 THEN NULL ELSE new_type END AS nt FROM f),
    u AS (SELECT *, country IS NULL AND new_country IS NOT NULL AS sc, type IS NULL AND nt IS NOT NULL AS st, gender IS NULL AND coalesce(nt, 0) = 1 AND new_gender IS NOT NULL AS sg,
      (coalesce(nt, 0) = 1 AND (id % 3 = 0 OR id % 8 = 0)) OR (coalesce(nt, 0) = 2 AND id % 8 = 1) AS sb FROM t)
    SELECT id, coalesce(country, new_country) AS country, nt AS type, CASE WHEN sg THEN new_gender ELSE gender END AS gender,
      CASE WHEN nt = 1 THEN CASE WHEN id % 3 = 0 THEN 1950 WHEN id % 8 = 0 THEN 1960 END WHEN nt = 2 AND id % 8 = 1 THEN 1970 END AS begin_date_year,
      array_to_string(list_filter([CASE WHEN sc THEN 'country' END, CASE WHEN st THEN 'type' END, CASE WHEN sg THEN 'gender' END, CASE WHEN sb THEN 'begin_date' END], lambda x: x IS NOT NULL), ',') AS updated
    FROM u WHERE sc OR st OR sg OR sb""")
def filled_artist_data(c):
    """Gaps of one artist per page, filled with what its page says of country, type, gender and dates."""
    i = F.col("doc_id")
    none = F.lit(None).cast("int")
    people = c.view("documents").select(
        i.alias("id"), F.concat(F.lit("d-"), i.cast("string")).alias("gid"), F.lit("u").alias("url"), i.cast("string").alias("title"),
        F.when(i % 4 == 0, 5).alias("country"), F.when(i % 3 == 0, 1).alias("type"), F.when(i % 2 == 1, 1).alias("gender"),
        *[none.alias(f"{w}_date_{p}") for w in ("begin", "end") for p in ("year", "month", "day")])
    pages = _pages(c)
    places = facts.country(pages, facts.place_dictionary(c.view("w_place")), "en")
    ids = c.a.country.select(F.lower("iso_code").alias("key"), F.col("id").alias("value"))
    genders = c.spark.createDataFrame([("male", 1), ("female", 2)], "key string, value int")
    rows = facts.fill_artist_data(people, places, facts.gender(pages, "en"), facts.artist_type(pages, "en"), facts.dates(pages, "en"), ids, genders)
    return rows.select("id", "country", "type", "gender", "begin_date_year", F.array_join("updated", ",").alias("updated"))


# French pages ----------------------------------------------------------------------------------------------

_FR_NOM = "'Persón {{nobr|a {{b|c=' || doc_id || '}}' || chr(10) || '| label = faux}}'"


@Q.add(f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Musique (artiste)' ELSE 'Musique classique (personnalité)' END AS kind, {_FR_NOM} AS nom, 'deux {{{{x|y}}}}' AS label,
    CASE doc_id % 5 WHEN 0 THEN 'vocal' WHEN 1 THEN 'groupe' ELSE 'x' END AS charte, CASE WHEN doc_id % 9 = 0 THEN 'N' || doc_id END AS name, CASE WHEN doc_id % 9 = 0 THEN '1944' END AS born,
    CASE WHEN doc_id % 9 = 0 THEN '12 March 1990' END AS died, 'Persón de [[' || CASE WHEN doc_id % 7 = 0 THEN 'Canada' ELSE 'Nulle part' END || ']].' AS abstract FROM documents""")
def french_page_parts(c):
    """Infobox with templates two deep, person data with its field names in English, and the first paragraph."""
    def f(source, n):
        return F.try_element_at(source, F.lit(n))

    return c.parsed_french_pages.select(
        "doc_id", f("infobox", "_type").alias("kind"), f("infobox", "nom").alias("nom"), f("infobox", "label").alias("label"), f("infobox", "charte").alias("charte"),
        f("persondata", "name").alias("name"), f("persondata", "date of birth").alias("born"), f("persondata", "date of death").alias("died"), "abstract")


_FR_CATEGORY = """SELECT doc_id, 'FR' AS code FROM documents WHERE doc_id % 6 = 0 UNION ALL SELECT doc_id, 'BE' FROM documents WHERE doc_id % 6 = 1"""
_FR_TITLE = "CASE doc_id % 4 WHEN 0 THEN 'Jean Durand ' WHEN 1 THEN 'Marie-Claire Petit ' WHEN 2 THEN 'Anne Petit ' ELSE 'Zork Petit ' END || doc_id AS title"


@Q.add(f"""WITH k AS ({_FR_CATEGORY}), every AS (SELECT * FROM k UNION ALL SELECT doc_id, 'FR' FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id, 'BE' FROM documents WHERE doc_id % 4 = 1
      UNION ALL SELECT doc_id, 'CA' FROM documents WHERE doc_id % 7 = 0)
    SELECT {_FR_TITLE}, min(code) AS country FROM every WHERE doc_id IN (SELECT doc_id FROM k) GROUP BY doc_id HAVING count(DISTINCT code) = 1""")
def page_country_french(c):
    places = facts.place_dictionary(dictionaries.named_codes(c.view("w_place_lines")))
    return facts.country(c.parsed_french_pages, places, "fr").select("title", "country")


@Q.add(f"""WITH v AS (SELECT doc_id, {_PRONOUN % 'il'} AS m, {_PRONOUN % 'elle'} AS f FROM w_page_fr),
    g AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'male' ELSE 'female' END AS g FROM documents WHERE doc_id % 4 < 3
      UNION ALL SELECT doc_id, 'male' FROM documents WHERE doc_id % 6 = 0 UNION ALL SELECT doc_id, 'female' FROM documents WHERE doc_id % 6 = 1
      UNION ALL SELECT doc_id, 'male' FROM v WHERE m > 2 AND f = 0 UNION ALL SELECT doc_id, 'female' FROM v WHERE f > 2 AND m = 0)
    SELECT {_FR_TITLE}, min(g) AS gender FROM g GROUP BY doc_id HAVING count(DISTINCT g) = 1""")
def page_gender_french(c):
    """Given names come from lines of a names file; of a compound name the first part counts."""
    names = dictionaries.named_codes(c.view("w_name_lines")).withColumnRenamed("code", "gender")
    return facts.gender(c.parsed_french_pages, "fr", names).select("title", "gender")


@Q.add(f"""WITH t AS (SELECT doc_id, 'person' AS t FROM documents WHERE doc_id % 5 = 0 OR doc_id % 9 = 0 UNION ALL SELECT doc_id, 'group' FROM documents WHERE doc_id % 5 = 1 OR doc_id % 6 = 2 OR doc_id % 8 = 2)
    SELECT {_FR_TITLE}, min(t) AS type FROM t GROUP BY doc_id HAVING count(DISTINCT t) = 1""")
def page_type_french(c):
    return facts.artist_type(c.parsed_french_pages, "fr").select("title", "type")


@Q.add(f"""SELECT {_FR_TITLE}, CASE WHEN doc_id % 9 = 0 THEN 1944 WHEN doc_id % 3 = 0 THEN 1950 WHEN doc_id % 8 = 0 THEN 1960 END AS begin_year, CASE WHEN doc_id % 9 <> 0 AND doc_id % 3 = 0 THEN 1 + doc_id % 12 END AS begin_month,
    CASE WHEN doc_id % 9 <> 0 AND doc_id % 3 = 0 THEN 7 END AS begin_day, CASE WHEN doc_id % 9 = 0 THEN 1990 WHEN doc_id % 6 = 0 THEN 2001 WHEN doc_id % 8 = 1 THEN 1999 END AS end_year,
    CASE WHEN doc_id % 9 = 0 THEN 3 WHEN doc_id % 6 = 0 THEN 8 END AS end_month, CASE WHEN doc_id % 9 = 0 THEN 12 WHEN doc_id % 6 = 0 THEN 1 END AS end_day, CASE WHEN doc_id % 8 = 2 THEN 1971 END AS group_year FROM documents""")
def page_dates_french(c):
    """Dates of birth and death from person data, then from the infobox, then from categories."""
    d = facts.dates(c.parsed_french_pages, "fr")
    return d.select("title", *[F.col(f"person_{w}.{p}").alias(f"{w}_{p}") for w in ("begin", "end") for p in ("year", "month", "day")], F.col("group_begin.year").alias("group_year"))
