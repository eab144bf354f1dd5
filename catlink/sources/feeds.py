"""Semi-structured sources: album documents, store feed, store pages, rights-society pages, page store.

The pages have a fixed layout, so every field is one pattern over the HTML column: no
parser runs in Python and the work stays in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catlink import schemas
from catlink.functions import text as X, titlecase, urls
from catlink.functions.text import col, extract


# Album documents ---------------------------------------------------------------------------


def read_albums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALBUM).json(path)


def parse_albums(docs: DataFrame, column: str = "doc") -> DataFrame:
    """JSON text column -> album columns."""
    return docs.select(F.from_json(column, schemas.ALBUM).alias("a")).select("a.*")


def pending_albums(albums: DataFrame, limit: int | None = None) -> DataFrame:
    """Albums not imported yet; the limit takes the lowest ids so that runs repeat."""
    todo = albums.filter(F.col("status.imported") == F.lit(False))
    return todo if limit is None else todo.orderBy("_id").limit(limit)


# Store feed --------------------------------------------------------------------------------


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return feed_items(spark.read.format("xml").option("rowTag", "item").schema(schemas.FEED_ITEM).load(path))


def parse_feed(items: DataFrame, column: str = "item") -> DataFrame:
    """XML text column with one item per row -> feed rows."""
    return feed_items(items.select(F.from_xml(column, schemas.FEED_ITEM).alias("i")).select("i.*"))


def album_type(title: Column | str) -> Column:
    t = col(title)
    return F.when(t.endswith(" - EP"), "EP").when(t.endswith(" - Single"), "Single")


def album_title(title: Column | str) -> Column:
    """Title without its type suffix, ``[feat. X]`` at its end in parentheses."""
    t = col(title)
    cut = F.when(t.endswith(" - EP"), F.left(t, F.length(t) - 5)).when(t.endswith(" - Single"), F.left(t, F.length(t) - 9)).otherwise(t)
    return F.regexp_replace(cut, r"^(.+?) \[(feat\. .+?)\](?=\n?\z)", "$1 ($2)")


def feed_date(c: Column | str) -> Column:
    """``January 5, 2011`` -> date, NULL for any other text."""
    return F.try_to_timestamp(col(c), F.lit("MMMM d, yyyy")).cast("date")


def feed_items(raw: DataFrame) -> DataFrame:
    """Feed fields -> (artist, artist_id, album, album_id, release_date, album_type, artist_url, album_url)."""
    f = {n: F.col(f"`itms:{n}`") for n in ("artist", "artistLink", "album", "albumLink", "releasedate")}
    rows = raw.select(
        f["artist"].alias("artist"),
        urls.store_id(f["artistLink"]).alias("artist_id"),
        album_title(f["album"]).alias("album"),
        F.when(f["albumLink"].contains("/album/"), urls.store_id(f["albumLink"])).alias("album_id"),
        feed_date(f["releasedate"]).alias("release_date"),
        album_type(f["album"]).alias("album_type"),
    )
    return rows.withColumns({
        "artist_url": urls.store_url("artist_id", urls.STORE_ARTIST_URL),
        "album_url": urls.store_url("album_id", urls.STORE_ALBUM_URL),
    })


# Store album pages -------------------------------------------------------------------------

# Element ids of the store's album page.
_RIGHT, _LEFT = "ctl00_rightColumn_", "ctl00_leftColumn_"


def _plain(c: Column) -> Column:
    """Text of an HTML fragment: tags dropped, entities as they are."""
    return F.trim(F.regexp_replace(c, r"<[^>]*>", ""))


def _element(html: Column, tag: str, attribute: str) -> Column:
    return extract(html, rf'(?s)<{tag}\b[^>]*\b{attribute}[^>]*>(.*?)</{tag}>')


def store_albums(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Album page -> nested album record; pages without an album title are skipped."""
    h = F.col(html)
    title = _plain(_element(h, "span", f'id="{_RIGHT}lblAlbumName"'))
    artist_block = extract(h, rf'(?s)<div\b[^>]*\bid="{_RIGHT}pnlArtists"[^>]*>(.*?)</div>')
    artist = _plain(extract(artist_block, r"(?s)<span[^>]*>(.*?)</span>"))
    artist_link = extract(h, r'<a\b(?=[^>]*\bid="ctl00_breadCrumb_lnkArtist")[^>]*\bhref="([^"]*)"')
    barcode = X.find_barcode(_plain(_element(h, "span", f'id="{_RIGHT}lblBarcode"')))
    date = _plain(_element(h, "span", f'id="{_LEFT}lblAlbumRelease"')).try_cast("int").cast("string")
    label = F.regexp_replace(_plain(_element(h, "span", f'id="{_RIGHT}lblRecordLabel"')), r"^Record Label: ", "")
    table = extract(h, r'(?s)<table\b[^>]*\bid="tracks-display"[^>]*>(.*?)</table>')
    rows = F.regexp_extract_all(F.coalesce(table, F.lit("")), F.lit(r"(?s)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.filter(
        F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?s)<td\b[^>]*>(.*?)</td>"), F.lit(1))), lambda c: F.size(c) == 4
    )

    def track(c: Column) -> Column:
        line, length = _plain(c[1]), _plain(F.regexp_extract(c[2], r"(?s)<span[^>]*>(.*?)</span>", 1))
        return F.struct(
            X.track_number(line).alias("position"),
            titlecase.guess_case_title(X.track_title(line)).alias("title"),
            X.duration_seconds(length).alias("length"),
        )

    buy_button = h.rlike(r'<input\b[^>]*\bclass="cd-buynow-button"')
    medium = F.struct(
        F.lit(1).alias("position"),
        F.when(buy_button, "CD").otherwise("Digital Media").alias("format"),
        F.transform(cells, track).alias("tracks"),
    )
    cased_artist = titlecase.guess_case(artist)
    return pages.filter(title.isNotNull()).select(
        urls.album_slug(url).alias("cdbaby_id"),
        titlecase.guess_case_title(title).alias("title"),
        cased_artist.alias("artist"),
        urls.artist_slug(artist_link).alias("artist_cdbaby_id"),
        barcode.alias("barcode"),
        date.alias("date"),
        F.when(F.lower(label) != F.lower(cased_artist), label).alias("label"),
        F.array(medium).alias("mediums"),
    )


def listing_ids(pages: DataFrame, html: str = "html") -> DataFrame:
    """Album ids linked from listing pages, each once."""
    links = F.regexp_extract_all(F.col(html), F.lit(r'<a\b((?=[^>]*\bclass="overlay-link")[^>]*)>'), F.lit(1))
    href = F.explode(F.transform(links, lambda a: F.regexp_extract(a, r'\bhref="([^"]*)"', 1)))
    return pages.select(href.alias("_href")).select(urls.album_slug("_href").alias("cdbaby_id")).filter("cdbaby_id IS NOT NULL").distinct()


# Rights-society pages ----------------------------------------------------------------------

# Fixed value: length of the address prefix before a writer's id in the society's links.
WRITER_LINK_OFFSET = 53


def _links(fragment: Column) -> Column:
    """Writer links of a fragment as (id, name) structs."""
    anchors = F.regexp_extract_all(fragment, F.lit(r"""(?s)(<a\b[^>]*>.*?</a>)"""), F.lit(1))

    def one(a: Column) -> Column:
        part = F.substr(F.regexp_extract(a, r'\bhref="([^"]*)"', 1), F.lit(WRITER_LINK_OFFSET + 1))
        return F.struct(F.substring_index(part, "&", 1).alias("id"), _plain(a).alias("name"))

    return F.transform(anchors, one)


def writer_search(pages: DataFrame, html: str = "html") -> DataFrame:
    """Search result page -> (artist, name, ipicode).

    A page counts only if it shows as many codes as writers.
    """
    table = F.coalesce(extract(F.col(html), r'(?s)<table\b[^>]*\bwidth="490"[^>]*>(.*?)</table>'), F.lit(""))
    texts = F.transform(F.split(table, r"<[^>]*>"), lambda t: F.trim(t))
    codes = F.filter(texts, lambda t: t.rlike(r"\d{5,11}"))
    found = pages.select(_links(table).alias("writers"), codes.alias("codes"))
    same = found.filter(F.size("writers") == F.size("codes"))
    pair = F.explode(F.arrays_zip("writers", "codes"))
    return same.select(pair.alias("p")).select(
        F.col("p.writers.id").alias("artist"), F.col("p.writers.name").alias("name"), F.col("p.codes").alias("ipicode"))


def work_list(pages: DataFrame, artist: str = "artist", html: str = "html") -> DataFrame:
    """Work list page of a writer -> (artist, id, name): the title link that precedes each work id."""
    pattern = r"(?s)<a\b[^>]*>([^<]*)</a>(?:(?!<a\b).)*?Work ID\D*(\d+)"
    h = F.col(html)
    names, ids = (F.regexp_extract_all(h, F.lit(pattern), F.lit(g)) for g in (1, 2))
    return pages.select(artist, F.explode(F.arrays_zip(names.alias("name"), ids.alias("id"))).alias("w")).select(
        artist, F.col("w.id").try_cast("bigint").alias("id"), F.trim("w.name").alias("name"))


def work_detail(pages: DataFrame, work: str = "id", html: str = "html") -> DataFrame:
    """Work page -> (id, name, iswc, writers): the name is the second bold text, the ISWC may be absent."""
    h = F.col(html)
    bold = F.regexp_extract_all(h, F.lit(r"(?s)<b\b[^>]*>(.*?)</b>"), F.lit(1))
    iswc = extract(h, r"ISWC:\D*?(T\d+)")
    writers = F.coalesce(extract(h, r"(?s)Writers:(.*?)(?:</table>|\z)"), F.lit(""))
    return pages.select(
        work,
        F.trim(F.try_element_at(F.transform(bold, _plain), F.lit(2))).alias("name"),
        X.format_iswc(iswc).alias("iswc"),
        _links(writers).alias("writers"),
    )


# Page store --------------------------------------------------------------------------------


def page_key(title: Column | str) -> Column:
    return F.replace(col(title), F.lit("/"), F.lit("_"))


def lookup_pages(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Text of each wanted ``(lang, title)``; titles without a stored page are dropped."""
    store = pages.filter(F.length("text") > 0).select(F.col("lang"), page_key("title").alias("_key"), "text")
    return wanted.withColumn("_key", page_key("title")).join(store, ["lang", "_key"]).drop("_key")
