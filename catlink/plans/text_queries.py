"""Registered queries for the scalar functions and the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink import schemas, session
from catlink.functions import similarity, titlecase, urls, wikitext
from catlink.functions import text as X
from catlink.functions.titlecase import EXTRA_TITLE_INFO, SMALL_WORDS
from catlink.operators import catalog as prep, state
from catlink.operators.keys import joined_text, note_list, partners
from catlink.plans.oracle_views import catno, enc, key, mangle, quote, ratio, strip
from catlink.plans.registry import Registry
from catlink.sources import dictionaries, feeds, tables

Q = Registry()

# Names and numbers ---------------------------------------------------------------------------


@Q.add(f"""SELECT a.gid, count(DISTINCT b.id) AS n_partners, min(b.id) AS first_partner FROM a_artist a JOIN b_artist b ON lower(a.name) = {key('b.name')} GROUP BY a.gid""")
def strip_suffix_join(c):
    left = c.a.artist.select("gid", X.name_key("name").alias("k"))
    return partners(left, c.b.artist.select("id", X.numbered_name_key("name").alias("k")), ["k"], "id").drop("k")


@Q.add(f"""SELECT l.release, l.label, count(DISTINCT b.release_id) AS n_partners, min(b.release_id) AS first_partner FROM a_release_label l
    JOIN b_releases_labels b ON {catno('b.catno')} = {catno('l.catalog_number')} GROUP BY ALL""")
def catalog_number_join(c):
    left = c.a.release_label.select("release", "label", X.catno_key("catalog_number").alias("k"))
    return partners(left, c.b.releases_labels.select("release_id", X.catno_key("catno").alias("k")), ["k"], "release_id").drop("k")


@Q.add(f"SELECT id, {enc('name')} AS url, {strip('name')} AS plain FROM b_artist")
def encode_name(c):
    return c.b.artist.select("id", urls.encode_name("name").alias("url"), X.strip_suffix("name").alias("plain"))


@Q.add("SELECT page_id, url_decode(replace(url, '+', ' ')) AS decoded, substr(url_decode(replace(url, '+', ' ')), 8) AS tail FROM pages")
def decode_url(c):
    return c.view("pages").select("page_id", urls.decode("url").alias("decoded"), urls.decode_name("url", "http://").alias("tail"))


_WITH_ID = "'http://a.example/' || CASE WHEN id %% 4 = 1 THEN 'label/' ELSE 'artist/' END || regexp_replace(md5(url), '^(.{8})(.{4})(.{4})(.{4})', '%s')"


@Q.add(f"""SELECT id, CASE WHEN starts_with(url, 'http://en.wikipedia.org/wiki/') THEN url_decode(substr(url, 30)) END AS title, nullif(regexp_extract(own, '/artist/([0-9a-f-]{{36}})$', 1), '') AS mbid
    FROM (SELECT *, CASE WHEN id % 3 = 0 THEN url ELSE {_WITH_ID % '\\1-\\2-\\3-\\4-'} END AS own FROM a_url)""")
def page_title_from_url(c):
    """Page titles, and the identifiers in addresses of catalog A's entities that are made of the given ones."""
    own = F.when(F.col("id") % 3 == 0, F.col("url")).otherwise(F.expr(_WITH_ID % "$1-$2-$3-$4-"))
    return c.a.url.select("id", urls.wiki_title("url", "en").alias("title"), urls.mbid(own, "artist").alias("mbid"))


@Q.add("""SELECT doc_id, md5(replace(replace(replace(replace(replace(replace(replace(url_encode(replace(text, ' ', '_')), '%2F', '/'), '%24', '$'), '%2C', ','),
    '%3A', ':'), '%3B', ';'), '%40', '@'), '~', '%7E')) AS quoted,
    md5(replace(regexp_replace(regexp_replace(regexp_replace(text, '\\bOR\\b', 'or', 'g'), '\\bAND\\b', 'and', 'g'), '\\bNOT\\b', 'not', 'g'), '+', '\\+')) AS query
    FROM documents""")
def quote_and_escape(c):
    return c.view("documents").select("doc_id", F.md5(urls.quote_title("text")).alias("quoted"), F.md5(urls.escape_query("text")).alias("query"))


_BARE = "regexp_replace(value, '[ ./>-]', '', 'g')"
_CLEAN = f"CASE WHEN regexp_matches(value, '(?i)none|no barcode') THEN 'none' WHEN regexp_matches({_BARE}, '^[0-9]+$') THEN {_BARE} ELSE value END"


@Q.add(f"""SELECT release_id, v AS cleaned, regexp_matches(v, '^[0-9]{{12,13}}$') AS valid, nullif(regexp_extract(value, '([0-9]{{12,13}})', 1), '') AS found
    FROM (SELECT *, {_CLEAN} AS v FROM b_raw_identifier)""")
def barcode_clean(c):
    v = X.barcode_clean("value")
    return c.b.raw_identifier.select("release_id", v.alias("cleaned"), X.is_barcode(v).alias("valid"), X.find_barcode("value").alias("found"))


@Q.add("""SELECT coalesce(r.id, 2 * a.id) AS id, try_cast(CASE WHEN regexp_matches(r.released, '^[0-9]{4}') THEN left(r.released, 4) END AS INT) AS year,
    CASE WHEN a.id IS NOT NULL THEN coalesce(CAST(a.date_year AS VARCHAR), '') || CASE WHEN a.date_month IS NULL THEN '' ELSE '-' || lpad(CAST(a.date_month AS VARCHAR), 2, '0')
      || CASE WHEN a.date_day IS NULL THEN '' ELSE '-' || lpad(CAST(a.date_day AS VARCHAR), 2, '0') END END END AS date
    FROM b_release r FULL JOIN a_release a ON 2 * a.id = r.id""")
def release_dates(c):
    left = c.b.release.select("id", X.release_year("released").alias("year"))
    right = c.a.release.select((F.col("id") * 2).alias("id"), X.partial_date("date_year", "date_month", "date_day").alias("date"))
    return left.join(right, "id", "full")


@Q.add("""SELECT id, nullif(regexp_extract(profile, '^([^.]+\\.?)', 1), '') AS sentence, array_to_string(aliases, ', ') AS joined,
    array_to_string(list_concat(aliases, CASE WHEN id % 4 = 0 THEN groups END), '|') AS both, aliases[1] AS first, len(members) AS n
    FROM b_artist""")
def array_functions(c):
    return c.b.artist.select(
        "id", X.first_sentence("profile").alias("sentence"), F.array_join("aliases", ", ").alias("joined"),
        F.array_join(X.array_concat("aliases", F.when(F.col("id") % 4 == 0, F.col("groups"))), "|").alias("both"),
        F.try_element_at("aliases", F.lit(1)).alias("first"), F.size("members").alias("n"))


@Q.add("SELECT o.o_orderkey AS id, u.item FROM orders o, unnest(CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE string_split(o.o_orderpriority, '-') END) AS u(item)")
def explode_array(c):
    parts = F.when(F.col("o_orderkey") % 3 != 0, F.split("o_orderpriority", "-"))
    return c.view("orders").select(F.col("o_orderkey").alias("id"), F.explode(parts).alias("item"))


@Q.add(f"SELECT doc_id, md5({mangle('text')}) AS mangled, length({mangle('text')}) AS n FROM documents")
def mangle_documents(c):
    d = c.view("documents").select("doc_id", X.mangle_name("text").alias("m"))
    return d.select("doc_id", F.md5("m").alias("mangled"), F.length("m").alias("n"))


@Q.add("""SELECT artist, CASE WHEN n = 1 THEN 'release "' || t[1] || '"' WHEN n = 2 THEN 'releases "' || t[1] || '" and "' || t[2] || '"'
    WHEN n = 3 THEN 'releases "' || t[1] || '", "' || t[2] || '" and "' || t[3] || '"'
    ELSE 'releases "' || t[1] || '", "' || t[2] || '", "' || t[3] || '" and ' || CAST(n - 3 AS VARCHAR) || ' more' END AS names
    FROM (SELECT artist_credit AS artist, list_sort(list(DISTINCT name)) AS t, count(DISTINCT name) AS n FROM a_release GROUP BY artist_credit)""")
def quoted_names(c):
    rows = c.a.release.select(F.col("artist_credit").alias("artist"), "name").distinct()
    n = rows.groupBy("artist").agg(F.count("name").alias("n"))
    first = note_list(rows, ["artist"], "name", 3)
    return n.join(first, "artist").select("artist", X.quoted_first("release", "notes", "n").alias("names"))


@Q.add("""SELECT id, CASE WHEN len(aliases) > 1 THEN array_to_string(aliases[1:len(aliases) - 1], ', ') || ' and ' || aliases[len(aliases)] ELSE aliases[1] END AS names FROM b_artist""")
def comma_and(c):
    return c.b.artist.select("id", X.comma_and("aliases").alias("names"))


@Q.add("""SELECT doc_id, regexp_matches(text, '[\\p{Latin}]') AS latin, regexp_matches(text, '[\\p{Katakana}\\p{Hiragana}\\p{Han}]') AS japanese,
    regexp_matches(text, '[\\p{Hangul}]') AS korean, regexp_full_match(text, '[\\p{Latin}]+') AS all_latin FROM documents""")
def script_filter(c):
    return c.view("documents").select(
        "doc_id", X.has_script("text", "Latin").alias("latin"), X.has_script("text", "Katakana", "Hiragana", "Han").alias("japanese"),
        X.has_script("text", "Hangul").alias("korean"), X.in_script("text", "Latin").alias("all_latin"))


@Q.add("""SELECT id, duration, CAST(split_part(duration, ':', 1) AS INT) * 60 + CAST(split_part(duration, ':', 2) AS INT) AS seconds,
    CAST(length / 1000 AS INT) // 60 || ':' || lpad(CAST(CAST(length / 1000 AS INT) % 60 AS VARCHAR), 2, '0') AS shown
    FROM (SELECT coalesce(b.id, 2 * a.id) AS id, b.duration, a.length FROM b_track b FULL JOIN a_track a ON 2 * a.id = b.id)""")
def track_durations(c):
    a = c.a.track.select((F.col("id") * 2).alias("id"), X.format_seconds(F.col("length") / 1000).alias("shown"))
    return c.b.track.select("id", "duration", X.duration_seconds("duration").alias("seconds")).join(a, "id", "full")


@Q.add("""SELECT id, try_cast(position AS INT) AS number, CASE WHEN position <> '' THEN title END AS title FROM b_track""")
def track_lines(c):
    line = F.concat("position", F.lit(". "), "title")
    return c.b.track.select("id", X.track_number(line).alias("number"), X.track_title(line).alias("title"))


_WORDS = "regexp_extract_all(s, '\\w+(?:''\\w+)*|\\W+')"
_SMALL = ", ".join(quote(w) for w in sorted(set(SMALL_WORDS)))
_CASED = f"""array_to_string(list_transform({_WORDS}, lambda w, i: CASE WHEN NOT regexp_matches(w, '^\\w') THEN w
    WHEN lower(w) IN ({_SMALL}) AND i > 1 AND i < len({_WORDS}) THEN lower(w) ELSE upper(w[1]) || w[2:] END), '')"""


@Q.add(f"SELECT doc_id, md5({_CASED}) AS cased FROM (SELECT doc_id, text AS s FROM documents)")
def guess_case(c):
    return c.view("documents").select("doc_id", F.md5(titlecase.guess_case("text")).alias("cased"))


_INFO = "regexp_extract(t, '(?s)^.* \\(([^)]+)\\)$', 1)"
_LOWERED = _INFO
for _p in EXTRA_TITLE_INFO:
    _LOWERED = f"regexp_replace({_LOWERED}, '(?i)(^| )({_p.replace('.', chr(92) + '.')})($| )', '\\1{_p}\\3', 'g')"


@Q.add(f"""SELECT k, CASE WHEN {_INFO} <> '' THEN regexp_extract(t, '(?s)^(.*) \\([^)]+\\)$', 1) || ' (' || {_LOWERED} || ')' ELSE t END AS title
    FROM (SELECT k, {_CASED} AS t FROM (SELECT p_partkey AS k, p_name || CASE p_partkey % 4 WHEN 0 THEN ' (RADIO EDIT)' WHEN 1 THEN ' (Live Version)'
      WHEN 2 THEN ' of the ' || lower(p_type) || ' (remix of x)' ELSE '' END AS s FROM part))""")
def guess_case_title(c):
    k = F.col("p_partkey") % 4
    tail = F.when(k == 0, " (RADIO EDIT)").when(k == 1, " (Live Version)").when(k == 2, F.concat(F.lit(" of the "), F.lower("p_type"), F.lit(" (remix of x)"))).otherwise("")
    return c.view("part").select(F.col("p_partkey").alias("k"), titlecase.guess_case_title(F.concat("p_name", tail)).alias("title"))


@Q.add("""SELECT k, CASE WHEN w1 IN (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) FROM part WHERE p_partkey % 2 = 0) AND NOT the
      THEN upper(w2[1]) || w2[2:] || ', ' || upper(w1[1]) || w1[2:]
    WHEN the THEN upper(w1[1]) || w1[2:] || ' ' || upper(w2[1]) || w2[2:] || ', The' ELSE upper(w1[1]) || w1[2:] || ' ' || upper(w2[1]) || w2[2:] END AS sort_name
    FROM (SELECT p_partkey AS k, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2, p_partkey % 3 = 0 AS the FROM part)""")
def artist_sort_name(c):
    part = c.view("part")
    given = dictionaries.given_names(part.filter("p_partkey % 2 = 0").select(F.col("p_name").alias("value")))
    name = F.concat(F.when(F.col("p_partkey") % 3 == 0, "the ").otherwise(""), "p_name")
    rows = titlecase.add_sort_name(part.select(F.col("p_partkey").alias("k"), name.alias("name")), given)
    return rows.select("k", "sort_name")


@Q.add("""SELECT k, 'T-' || substr(d, 1, 3) || '.' || substr(d, 4, 3) || '.' || substr(d, 7, 3) || '-' || substr(d, 10, 1) AS iswc,
    'http://rights.example/ace/search.cfm?requesttimeout=300&mode=results&searchstr=' || CAST(k AS VARCHAR)
    || '&search_in=i&search_type=exact&search_det=t,s,w,p,b,v&results_pp=25&start=1' AS url
    FROM (SELECT p_partkey AS k, lpad(CAST(p_partkey * 7 AS VARCHAR), 10, '0') AS d FROM part)""")
def iswc_format(c):
    raw = F.concat(F.lit("T"), F.lpad((F.col("p_partkey") * 7).cast("string"), 10, "0"))
    return c.view("part").select(
        F.col("p_partkey").alias("k"), X.format_iswc(raw).alias("iswc"), urls.rights_search_url("p_partkey", "i", "http://rights.example").alias("url"))


@Q.add(f"SELECT k, round({ratio('a', 'b')}, 9) AS ratio FROM (SELECT p_partkey AS k, p_name AS a, lower(concat_ws(' ', p_type, p_brand)) AS b FROM part)")
def similarity_ratio(c):
    """Similarity of each part's name to its type and size text."""
    other = F.lower(F.concat_ws(" ", "p_type", "p_brand"))
    return c.view("part").select(F.col("p_partkey").alias("k"), F.round(similarity.ratio("p_name", other), 9).alias("ratio"))


# Page markup -------------------------------------------------------------------------------------

_BALANCED = "regexp_replace(%s, '\\{\\{[^{}]*\\}\\}', '', 'g')"
_NO_MARKUP = _BALANCED % (_BALANCED % "regexp_replace(text, '<!--.*?-->', '', 'gs')")


@Q.add(f"SELECT doc_id, md5({_NO_MARKUP}) AS plain, md5(split_part(trim({_NO_MARKUP}, chr(10) || ' ' || chr(9)), chr(10) || chr(10), 1)) AS first FROM w_page")
def page_text(c):
    return c.view("w_page").select("doc_id", F.md5(wikitext.remove_markup("text")).alias("plain"), F.md5(wikitext.first_paragraph("text")).alias("first"))


@Q.add("SELECT doc_id, array_to_string(regexp_extract_all(text, '\\[\\[Category:(.+?)(?:\\|.*?)?\\]\\]', 1), ';') AS categories FROM w_page")
def page_categories(c):
    return c.view("w_page").select("doc_id", F.array_join(wikitext.categories("text", "en"), ";").alias("categories"))


def _field(name: str) -> str:
    return f"nullif(regexp_extract(text, '(?m)^\\| {name} = (.*)$', 1), '')"


@Q.add(f"""SELECT doc_id, 'musical artist' AS kind, {_field('origin')} AS origin, {_field('background')} AS background, {_field('birth_date')} AS birth_date FROM w_page""")
def page_infobox(c):
    box = c.view("w_page").select("doc_id", wikitext.infobox("text", "en").alias("i"))

    def f(n):
        return F.try_element_at("i", F.lit(n))

    return box.select("doc_id", f("_type").alias("kind"), f("origin").alias("origin"), f("background").alias("background"), f("birth_date").alias("birth_date"))


@Q.add("""SELECT doc_id, 'N' || CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 2 = 0 THEN '1950-01-0' || CAST(doc_id % 9 + 1 AS VARCHAR) END AS born FROM documents""")
def page_persondata(c):
    lines = F.concat(
        F.lit("{{Persondata <!-- {{x}} -->\n|NAME = N"), F.col("doc_id").cast("string"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\n| DATE OF BIRTH= 1950-01-0"), (F.col("doc_id") % 9 + 1).cast("string"))).otherwise(""),
        F.lit("\n}}\n"), "text")
    p = c.view("documents").select("doc_id", wikitext.persondata(lines, "en").alias("p"))
    return p.select("doc_id", F.try_element_at("p", F.lit("name")).alias("name"), F.try_element_at("p", F.lit("date of birth")).alias("born"))


# Sources ------------------------------------------------------------------------------------------


@Q.add("SELECT CAST(o_orderkey AS INT) AS id, o_orderpriority AS name, CAST(round(o_totalprice) AS INT) AS price FROM orders")
def declared_query(c):
    q = c.view("orders").select("o_orderkey", "o_orderpriority", F.round("o_totalprice"))
    return tables.declared(q, "id int, name string, price int")


@Q.add("SELECT url AS id, replace(url, '_', ' ') AS name, 'en' AS lang FROM pages")
def import_titles(c):
    return dictionaries.titles(c.view("pages").select(F.concat("url", F.lit("\r")).alias("value")), "en")


@Q.add("""SELECT 'store:' || CAST(o_orderkey AS VARCHAR) AS _id, o_orderpriority AS title, n_tracks FROM
    (SELECT o.o_orderkey, o.o_orderpriority, count(l.o) AS n_tracks FROM orders o LEFT JOIN line l ON l.o = o.o_orderkey WHERE o.o_orderkey % 3 <> 0 GROUP BY ALL)""")
def pending_albums(c):
    """Album documents built from orders and their line items, read back, imported ones left out."""
    return feeds.pending_albums(_albums(c)).select("_id", "title", F.size(F.flatten(F.transform("mediums", lambda m: m["tracks"]))).alias("n_tracks"))


def _albums(c):
    track = F.struct(F.col("n").alias("position"), F.concat(F.lit("Track "), F.col("p").cast("string")).alias("title"), (F.col("p") % 300).cast("int").alias("length"))
    tracks = c.view("line").groupBy(F.col("o").alias("o_orderkey")).agg(F.sort_array(F.collect_list(track)).alias("tracks"))
    medium = F.struct(F.lit(1).alias("position"), F.lit("CD").alias("format"), F.coalesce("tracks", F.array().cast("array<struct<position:int,title:string,length:int>>")).alias("tracks"))
    key_ = F.col("o_orderkey").cast("string")
    doc = F.struct(
        F.concat(F.lit("store:"), key_).alias("_id"), key_.alias("cdbaby_id"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("Artist "), F.col("o_custkey").cast("string")).alias("artist"), F.col("o_custkey").cast("string").alias("artist_cdbaby_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(F.col("o_orderkey") % 2 == 0, "Label").alias("label"),
        F.array(medium).alias("mediums"), F.struct((F.col("o_orderkey") % 3 == 0).alias("imported")).alias("status"))
    return feeds.parse_albums(c.view("orders").join(tracks, "o_orderkey", "left").select(F.to_json(doc).alias("doc")))


_NUMBERED = "(SELECT o, p, n, row_number() OVER (PARTITION BY o ORDER BY n, 'Track ' || CAST(p AS VARCHAR), p % 300) - 1 AS j FROM line)"


def _form_row(key: str, value: str, source: str = "orders", order: str = "o_orderkey", where: str = "true") -> str:
    return f"SELECT 'store:' || CAST({order} AS VARCHAR) AS _id, {key} AS key, CAST({value} AS VARCHAR) AS value FROM {source} WHERE {where}"


@Q.add(" UNION ALL ".join([
    *[_form_row(f"'mediums.0.track.' || CAST(j AS VARCHAR) || '.{k}'", v, _NUMBERED, "o") for k, v in (
        ("position", "n"), ("name", "'Track ' || CAST(p AS VARCHAR)"), ("length", "CAST((p % 300) // 60 AS VARCHAR) || ':' || lpad(CAST((p % 300) % 60 AS VARCHAR), 2, '0')"))],
    *[_form_row(f"'{k}'", v) for k, v in (
        ("artist_credit.names.0.artist.name", "'Artist ' || CAST(o_custkey AS VARCHAR)"), ("artist_credit.names.0.name", "'Artist ' || CAST(o_custkey AS VARCHAR)"), ("name", "o_orderpriority"),
        ("date.year", "strftime(o_orderdate, '%Y')"), ("date.month", "strftime(o_orderdate, '%m')"), ("date.day", "strftime(o_orderdate, '%d')"),
        ("edit_note", "'http://store.example/cd/' || CAST(o_orderkey AS VARCHAR)"), ("mediums.0.format", "'CD'"), ("mediums.0.position", "1"))],
    _form_row("'labels.0.name'", "'Label'", where="o_orderkey % 2 = 0")]))
def album_form(c):
    return prep.album_form(_albums(c), "http://store.example/cd/")


_ARTIST_MBID = "CASE WHEN o_custkey % 3 = 0 THEN 'm-' || CAST(o_custkey AS VARCHAR) END"


def _store_artists(c):
    known = c.view("orders").filter("o_custkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("k")).distinct()
    return known.select(F.concat(F.lit("store:"), "k").alias("_id"), F.concat(F.lit("m-"), "k").alias("mbid"))


@Q.add(f"SELECT 'store:' || CAST(o_orderkey AS VARCHAR) AS _id, {_ARTIST_MBID} AS artist_mbid, 'album' AS type FROM orders")
def reused_artist_ids(c):
    return prep.reuse_artist_ids(_albums(c), _store_artists(c), "store:").select("_id", "artist_mbid", "type")


@Q.add("SELECT DISTINCT 'store:' || CAST(o_custkey AS VARCHAR) AS _id, 'Artist ' || CAST(o_custkey AS VARCHAR) AS name FROM orders WHERE o_custkey % 3 <> 0")
def new_store_artists(c):
    artists = _store_artists(c)
    return prep.new_artists(prep.reuse_artist_ids(_albums(c), artists, "store:"), artists, "store:")


@Q.add("""SELECT 'store:' || CAST(o_orderkey AS VARCHAR) AS _id, CASE WHEN o_orderkey % 5 = 0 THEN 'r-' || CAST(o_orderkey AS VARCHAR) END AS mbid, (o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0) OR o_orderkey % 5 = 0 AS imported FROM orders""")
def imported_albums(c):
    """Every seventh album has no status at all and counts as not imported."""
    ran = c.view("orders").filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").cast("string").alias("k"))
    albums = _albums(c).withColumn("status", F.when(F.col("cdbaby_id").cast("long") % 7 != 0, F.col("status")))
    rows = prep.mark_imported(albums, ran.select(F.concat(F.lit("store:"), "k").alias("_id"), F.concat(F.lit("r-"), "k").alias("mbid")))
    return rows.select("_id", "mbid", "status.imported")


@Q.add("SELECT 'store:' || CAST(o_orderkey AS VARCHAR) AS _id, o_orderpriority AS title, false AS imported FROM orders WHERE o_orderkey % 2 <> 0")
def stored_new_albums(c):
    """Each album comes on two pages of different titles; albums of even numbers are stored already."""
    pages = _albums(c).drop("_id", "status")
    twice = pages.unionByName(pages.withColumn("title", F.concat("title", F.lit(" 2"))))
    stored = c.view("orders").filter("o_orderkey % 2 = 0").select(F.concat(F.lit("store:"), F.col("o_orderkey").cast("string")).alias("_id"))
    return prep.store_new(twice, stored, "store:").select("_id", "title", "status.imported")


@Q.add("""SELECT x.release_id, x.role_name, r.release_link_type, r.release_link_type_name, r.link_attribute_name FROM (SELECT DISTINCT release_id, role_name FROM b_releases_extraartists) x
    JOIN roles r ON r.credit = x.role_name""")
def roles_from_file(c):
    """Credits by the role dictionary as it is read from its file, which is written here first."""
    roles = c.view("roles")
    path = session.stored_path(c.spark, "role-file")
    every = [F.col(f).cast("string") if f in roles.columns else F.lit(None).cast("string") for f in schemas_of_roles()]
    roles.select(*[F.coalesce(x, F.lit("\\N")) for x in every]).write.option("sep", "\t").option("quote", "").csv(path)
    read = dictionaries.read_roles(c.spark, path)
    credits = c.b.releases_extraartists.select("release_id", F.col("role_name")).distinct()
    joined = credits.join(read, credits.role_name == read.credit)
    return joined.select("release_id", "role_name", "release_link_type", "release_link_type_name", "link_attribute_name")


def schemas_of_roles() -> list[str]:
    """Column names of a role file, in order."""
    return [part.split()[0] for part in schemas.ROLES.split(",")]


@Q.add("""SELECT k, artist, k + 10 AS artist_id, p_name || CASE WHEN k % 3 = 2 THEN ' (feat. Guest)' ELSE '' END AS album, CASE WHEN k % 5 <> 0 THEN k END AS album_id,
    CASE k % 3 WHEN 0 THEN 'EP' WHEN 1 THEN 'Single' END AS album_type, CASE WHEN k % 4 <> 0 THEN DATE '2011-01-05' END AS release_date,
    CASE WHEN k % 5 <> 0 THEN 'http://itunes.apple.com/us/album/id' || CAST(k AS VARCHAR) END AS album_url
    FROM (SELECT p_partkey AS k, p_brand AS artist, p_name FROM part)""")
def store_feed(c):
    k = F.col("p_partkey")
    ks = k.cast("string")
    suffix = F.when(k % 3 == 0, " - EP").when(k % 3 == 1, " - Single").otherwise(" [feat. Guest]")
    date = F.when(k % 4 == 0, "soon").otherwise("January 5, 2011")
    item = F.concat(
        F.lit('<item xmlns:itms="http://phobos.apple.com/rss/1.0/modules/itms/"><itms:artist>'), "p_brand", F.lit("</itms:artist><itms:artistLink>http://s.example/artist/id"),
        (k + 10).cast("string"), F.lit("?x=1</itms:artistLink><itms:album>"), "p_name", suffix, F.lit("</itms:album><itms:albumLink>http://s.example/"),
        F.when(k % 5 == 0, "song").otherwise("album"), F.lit("/id"), ks, F.lit("</itms:albumLink><itms:releasedate>"), date, F.lit("</itms:releasedate></item>"))
    rows = feeds.parse_feed(c.view("part").select(item.alias("item")))
    return rows.select((F.col("artist_id") - 10).alias("k"), "artist", "artist_id", "album", "album_id", "album_type", "release_date", "album_url")


def _store_pages(c):
    """Store album pages around the driver's pages: their HTML stands where a shop's layout would."""
    i = F.col("page_id").cast("string")
    rows = F.concat(
        F.lit('<table class="x" id="tracks-display"><tr><th>n</th></tr><tr><td>1</td><td>1. first of the song</td><td><span>3:05</span></td><td>$</td></tr>'),
        F.lit("<tr><td>2</td><td><a>2. second LIVE (LIVE)</a></td><td><span>10:00</span></td><td>$</td></tr></table>"))
    html = F.concat(
        F.lit('<a href="/Artist/band'), i, F.lit('/x" id="ctl00_breadCrumb_lnkArtist">b</a><span class="t" id="ctl00_rightColumn_lblAlbumName"><b>album number '), i,
        F.lit('</b></span><div id="ctl00_rightColumn_pnlArtists"><span>the band '), i, F.lit('</span></div><span id="ctl00_rightColumn_lblBarcode">UPC: 8'),
        F.lpad(i, 11, "0"), F.lit('</span><span id="ctl00_leftColumn_lblAlbumRelease">2010</span><span id="ctl00_rightColumn_lblRecordLabel">Record Label: '),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("The Band "), i)).otherwise(F.concat(F.lit("Label "), i)), F.lit("</span>"), rows, "html",
        F.when(F.col("page_id") % 3 == 0, '<input class="cd-buynow-button">').otherwise(""))
    return c.view("pages").select(F.concat(F.lit("http://www.cdbaby.com/cd/"), i).alias("url"), html.alias("html"))


@Q.add("""SELECT CAST(page_id AS VARCHAR) AS cdbaby_id, 'Album Number ' || CAST(page_id AS VARCHAR) AS title, 'The Band ' || CAST(page_id AS VARCHAR) AS artist,
    'band' || CAST(page_id AS VARCHAR) AS artist_cdbaby_id, '8' || lpad(CAST(page_id AS VARCHAR), 11, '0') AS barcode, '2010' AS date,
    CASE WHEN page_id % 2 = 1 THEN 'Label ' || CAST(page_id AS VARCHAR) END AS label, CASE WHEN page_id % 3 = 0 THEN 'CD' ELSE 'Digital Media' END AS format,
    '1/First of the Song/185;2/Second LIVE (live)/600' AS tracks FROM pages""")
def store_albums(c):
    medium = F.col("mediums")[0]
    shown = F.array_join(F.transform(medium["tracks"], lambda t: F.concat_ws("/", t["position"].cast("string"), t["title"], t["length"].cast("string"))), ";")
    return feeds.store_albums(_store_pages(c)).select(
        "cdbaby_id", "title", "artist", "artist_cdbaby_id", "barcode", "date", "label", medium["format"].alias("format"), shown.alias("tracks"))


@Q.add("""SELECT CAST(page_id AS VARCHAR) AS cdbaby_id, 'store:' || CAST(page_id AS VARCHAR) AS _id FROM pages WHERE page_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)""")
def new_store_albums(c):
    link = F.concat(F.lit('<a class="overlay-link" href="/cd/'), F.col("page_id").cast("string"), F.lit('">x</a>'), "html")
    listed = feeds.listing_ids(c.view("pages").select(link.alias("html")))
    stored = c.view("orders").filter("o_orderkey % 2 = 0").select(F.concat(F.lit("store:"), F.col("o_orderkey").cast("string")).alias("_id"))
    return prep.new_albums(listed, stored, "store:")


@Q.add("""SELECT CAST(p_partkey AS VARCHAR) AS artist, p_name AS name, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ipicode FROM part WHERE p_partkey % 3 <> 0""")
def rights_writers(c):
    """Search pages with one writer per part; every third page lacks its code and is rejected."""
    prefix = "x" * feeds.WRITER_LINK_OFFSET
    i = F.col("p_partkey").cast("string")
    html = F.concat(F.lit(f'<table width="490"><tr><td><a href="{prefix}'), i, F.lit('&y=1"> '), "p_name", F.lit(" </a></td><td>"),
                    F.when(F.col("p_partkey") % 3 != 0, F.lpad(i, 9, "0")).otherwise("none"), F.lit("</td></tr></table>"))
    return feeds.writer_search(c.view("part").select(html.alias("html")))


@Q.add("""SELECT p_partkey AS artist, p_partkey * 10 + j AS id, p_name || ' ' || CAST(j AS VARCHAR) AS name FROM part, (VALUES (1), (2)) v(j)""")
def rights_work_list(c):
    i = F.col("p_partkey")
    rows = F.concat(*[F.concat(F.lit("<tr><td><b><i><a href='w'>"), "p_name", F.lit(f" {j}</a></i></b></td><td>Work ID: "), (i * 10 + j).cast("string"), F.lit("</td></tr>")) for j in (1, 2)])
    return feeds.work_list(c.view("part").select(i.alias("artist"), F.concat(F.lit("<table>"), rows, F.lit("</table>")).alias("html")))


@Q.add("""SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 'T-' || substr(d, 1, 3) || '.' || substr(d, 4, 3) || '.' || substr(d, 7, 3) || '-' || substr(d, 10, 1) END AS iswc,
    CAST(p_partkey AS VARCHAR) || ':' || p_brand AS writers FROM (SELECT *, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS d FROM part)""")
def rights_work_detail(c):
    i = F.col("p_partkey").cast("string")
    prefix = "x" * feeds.WRITER_LINK_OFFSET
    html = F.concat(
        F.lit("<table><tr><td><b>Title</b> <b> "), "p_name", F.lit("</b> Work ID: "), i, F.lit("</td></tr>"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<tr><td>ISWC: T"), F.lpad(i, 10, "0"), F.lit("</td></tr>"))).otherwise(""),
        F.lit(f'<tr><td>Writers:</td><td><a href="{prefix}'), i, F.lit('&z=2">'), "p_brand", F.lit("</a></td></tr></table>"))
    rows = feeds.work_detail(c.view("part").select(F.col("p_partkey").alias("id"), html.alias("html")))
    return rows.withColumn("writers", F.array_join(F.transform("writers", lambda w: F.concat_ws(":", w["id"], w["name"])), ","))


@Q.add("""SELECT CASE WHEN p_partkey % 2 = 0 THEN 'Han' ELSE 'Latin' END AS script, p_partkey + 256 AS lo, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 260 ELSE p_partkey + 256 END AS hi
    FROM part WHERE p_partkey % 7 <> 0""")
def script_ranges(c):
    k = F.col("p_partkey")
    line = F.concat(
        F.when(k % 7 == 0, "# ").otherwise(""), F.format_string("%04X", k + 256), F.when(k % 3 == 0, F.format_string("..%04X", k + 260)).otherwise(""), F.lit("  ; "),
        F.when(k % 2 == 0, "Han").otherwise("Latin"), F.lit(" # comment ; x"))
    return dictionaries.script_ranges(c.view("part").select(line.alias("value")))


@Q.add("SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS name FROM part")
def given_names(c):
    return dictionaries.given_names(c.view("part").select(F.concat("p_name", F.lit("   0.1 0.2")).alias("value")))


@Q.add("""SELECT a.id, md5(d.text) AS page FROM w_artist a JOIN documents d ON d.doc_id = 2 * (a.id - 3) AND d.lang = a.lang""")
def page_lookup(c):
    pages = c.view("documents").select("lang", F.concat(F.lit("T_"), F.col("doc_id").cast("string")).alias("title"), "text")
    wanted = c.view("w_artist").select("id", "lang", F.concat(F.lit("T/"), ((F.col("id") - 3) * 2).cast("string")).alias("title"))
    return feeds.lookup_pages(wanted, pages).select("id", F.md5("text").alias("page"))


@Q.add("SELECT event_id AS id, event_type AS updated, props AS event FROM events ORDER BY event_id DESC LIMIT 4")
def latest_events(c):
    log = c.view("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("updated"), F.col("props").alias("event"))
    return tables.latest_events(log, 4)


@Q.add("SELECT lower(n_name) AS key, max(n_nationkey) AS value FROM nation GROUP BY 1")
def lookup_map(c):
    return tables.lookup_map(c.view("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))



@Q.add("""SELECT user_id, coalesce((SELECT max_by(value, event_id) FROM events e WHERE e.user_id = u.user_id AND e.event_id % 2 = 1 AND e.event_id % 3 <> 0), u.first_value) AS value,
    coalesce(u.last_type, u.first_type) AS event_type FROM
    (SELECT user_id, max_by(CASE WHEN event_id % 2 = 0 THEN value END, event_id) AS first_value, max_by(event_type, event_id) FILTER (event_id % 2 = 0) AS first_type,
      max_by(event_type, event_id) FILTER (event_id % 2 = 1) AS last_type FROM events GROUP BY user_id) u""")
def upsert_latest(c):
    """Even events are the state (last one per user), odd ones are applied to it; a NULL keeps the old value."""
    ev = c.view("events").select("user_id", "event_type", "value", "event_id")
    empty = ev.limit(0).select("user_id", "event_type", "value")
    state0 = tables.upsert(empty, ev.filter("event_id % 2 = 0"), ["user_id"], ["event_id"])
    new = ev.filter("event_id % 2 = 1").withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return tables.upsert(state0, new, ["user_id"], ["event_id"], keep_old=["value"])


@Q.add("""SELECT user_id, event_type, min(event_id) AS event_id FROM events e WHERE event_id % 20 <> 0
    AND NOT EXISTS (SELECT 1 FROM events o WHERE o.event_id % 20 = 0 AND o.user_id = e.user_id AND o.event_type = e.event_type) GROUP BY ALL""")
def insert_ignore(c):
    ev = c.view("events").select("user_id", "event_type", "event_id")
    return tables.insert_ignore(ev.filter("event_id % 20 = 0"), ev.filter("event_id % 20 <> 0"), ["user_id", "event_type"], ["event_id"])


@Q.add("""SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def pending_works(c):
    works = c.view("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").alias("done"))
    finished = c.view("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return tables.pending(tables.mark_done(works, finished, "id")).select("id")


# Work lists and guards -------------------------------------------------------------------------------


@Q.add("""SELECT o_orderkey AS gid, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def queue_drain_batch(c):
    return _drain(c)[0]


@Q.add("""SELECT o_orderkey AS gid, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM (SELECT o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100))""")
def queue_drain_rest(c):
    return _drain(c)[1]


def _drain(c):
    queue = c.view("orders").select(F.col("o_orderkey").alias("gid"), "o_custkey", "o_totalprice")
    return state.drain(queue, 100, [F.desc("o_totalprice"), "gid"], ["o_custkey"])


@Q.add("""SELECT o_orderkey AS gid FROM orders WHERE o_orderkey NOT IN (SELECT user_id FROM events WHERE event_type = 'view')""")
def ledger_pending(c):
    ledger = c.view("events").select(F.col("user_id").alias("gid"), F.when(F.col("event_type") == "view", "en").otherwise("fr").alias("lang"))
    return state.not_processed(c.view("orders").select(F.col("o_orderkey").alias("gid")), ledger, "en")


@Q.add("""SELECT o_orderkey AS gid, CASE WHEN bool_or(coalesce(cur, '') <> coalesce(old, '')) THEN 'changed, abort' WHEN bool_or(coalesce(cur, '') <> coalesce(new, '')) THEN 'set' ELSE 'already set' END AS outcome
    FROM (SELECT o_orderkey, o_orderstatus AS old, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'X' END AS new, CASE WHEN o_orderkey % 5 = 0 THEN 'Q' ELSE o_orderstatus END AS cur FROM orders
      UNION ALL SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '9' END, o_orderpriority FROM orders) GROUP BY o_orderkey""")
def edit_guard(c):
    o = c.view("orders")
    gid = F.col("o_orderkey").alias("gid")
    proposals = o.select(gid, F.lit("status").alias("field"), F.col("o_orderstatus").alias("old"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise("X").alias("new")).unionByName(
        o.select(gid, F.lit("priority").alias("field"), F.col("o_orderpriority").alias("old"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("9").alias("new")))
    current = o.select(gid, F.lit("status").alias("field"), F.when(F.col("o_orderkey") % 5 == 0, "Q").otherwise(F.col("o_orderstatus")).alias("value")).unionByName(
        o.select(gid, F.lit("priority").alias("field"), F.col("o_orderpriority").alias("value")))
    return state.edit_guard(proposals, current, ["gid"])


@Q.add("""SELECT id, CASE WHEN comment IS NOT NULL THEN 'already set' ELSE 'set' END AS outcome FROM a_artist""")
def edit_guard_empty(c):
    return c.a.artist.select("id", state.guard_empty(F.col("comment")).alias("outcome"))


# Set operations on arrays, grouped lists -----------------------------------------------------------------


@Q.add("""SELECT artist_credit, string_agg(name, ';' ORDER BY name) AS names, count(*) AS n FROM a_release_group GROUP BY artist_credit""")
def groups_by_credit(c):
    rg = c.a.release_group
    return rg.groupBy("artist_credit").agg(joined_text("name", ";").alias("names"), F.count(F.lit(1)).alias("n"))


@Q.add("""SELECT id, array_to_string(list_sort(list_filter(aliases, lambda x: NOT list_contains(groups, x))), ';') AS only_alias, len(list_distinct(list_concat(aliases, groups))) AS n FROM b_artist""")
def array_difference(c):
    return c.b.artist.select("id", F.array_join(F.sort_array(F.array_except("aliases", "groups")), ";").alias("only_alias"),
                             F.size(F.array_distinct(F.concat("aliases", "groups"))).alias("n"))
