"""Preparation of catalog B: status, counts, mappings, identifier cleaning, repairs; store albums; works."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catlink.config import MISSING_ARTIST
from catlink.functions import text as X, urls
from catlink.operators.keys import first_by

# Format descriptions that decide the release status.
UNOFFICIAL = ("Unofficial Release", "Partially Unofficial")
PROMO = ("Promo", "White Label", "Test Pressing")
STATUS_OFFICIAL, STATUS_PROMO, STATUS_UNOFFICIAL = 1, 2, 3


def release_status(formats: DataFrame) -> DataFrame:
    """(release_id, status), one row per distinct status over the formats of a release.

    Promotional words win over unofficial ones. Formats without descriptions (NULL) give no status.
    """
    def any_of(words):
        cond = F.array_contains("descriptions", words[0])
        for w in words[1:]:
            cond = cond | F.array_contains("descriptions", w)
        return cond

    promo, unofficial = any_of(PROMO), any_of(UNOFFICIAL)
    status = F.when(promo, STATUS_PROMO).when(unofficial & ~promo, STATUS_UNOFFICIAL).when(~promo & ~unofficial, STATUS_OFFICIAL)
    return formats.select("release_id", status.alias("status")).filter("status IS NOT NULL").distinct()


def track_count(tracks: DataFrame) -> DataFrame:
    return tracks.filter(F.col("position") != "").groupBy("release_id").agg(F.count("id").alias("count"))


def country_mapping(names: DataFrame, countries: DataFrame) -> DataFrame:
    """(id, iso_code, name): catalog B's own country names by ISO code, and all of catalog A's names."""
    ids = countries.groupBy("iso_code").agg(F.min("id").alias("id"))
    manual = names.join(ids, "iso_code", "left").select("id", "iso_code", "name")
    return manual.unionByName(countries.select("id", "iso_code", "name"))


def release_format(formats: DataFrame, mapping: DataFrame) -> DataFrame:
    """(release_id, format_id, format_name) by a mapping ``(format_name, description, format_id, a_name)``.

    A mapping row with a description applies to formats carrying it and is preferred to the row of
    the same format with no description. Unmapped formats (books, for one) give no row.
    """
    f = formats.select("release_id", "format_name", F.coalesce("descriptions", F.array().cast("array<string>")).alias("descriptions"))
    specific = mapping.filter("description IS NOT NULL")
    general = mapping.filter("description IS NULL")
    f = f.withColumn("_row", F.xxhash64("release_id", "format_name", F.array_join("descriptions", "\x1f")))
    by_word = (
        f.select("release_id", "format_name", "_row", F.explode("descriptions").alias("description"))
        .join(specific, ["format_name", "description"])
        .select("release_id", "_row", "format_id", F.col("a_name").alias("format_name"))
        .distinct()
    )
    done = by_word.select("release_id", "_row").distinct()
    by_name = (
        f.join(done, ["release_id", "_row"], "left_anti")
        .join(general.drop("description"), "format_name")
        .select("release_id", "_row", "format_id", F.col("a_name").alias("format_name"))
    )
    return by_word.unionByName(by_name).select("release_id", "format_id", "format_name").distinct()


def release_mapping(release: DataFrame, formats: DataFrame, counts: DataFrame, status: DataFrame, countries: DataFrame) -> DataFrame:
    """Releases of catalog B in catalog A's terms.

    A release with several formats, statuses or country ids has several rows.
    """
    base = release.select(F.col("id").alias("release_id"), "title", X.release_year("released").alias("year"), "country")
    return (
        base.join(formats.select("release_id", "format_name", "format_id"), "release_id", "left")
        .join(counts.select("release_id", F.col("count").alias("track_count")), "release_id", "left")
        .join(status, "release_id", "left")
        .join(countries.select(F.col("id").alias("country_id"), F.col("name").alias("country")), "country", "left")
        .select("release_id", "title", "year", "format_name", "format_id", "track_count", "status", "country_id", "country")
        .distinct()
    )


# Cleaning ------------------------------------------------------------------------------------


def clean_identifiers(identifiers: DataFrame) -> DataFrame:
    """Reclassify and normalise release identifiers. Each rule sees the outcome of the one before."""
    df = identifiers
    label_code = F.col("type").isin("Other", "Barcode") & F.col("value").rlike(r"(?i)^LC *[0-9]+\z")
    df = _set(df, label_code, "Label Code", forget=True)
    rights = (F.col("type") == "Other") & F.col("description").rlike("(?i)Rights Society|Rights societies")
    df = _set(df, rights, "Rights Society", forget=True)
    runout = (F.col("type") == "Other") & F.col("description").rlike("(?i)runout")
    df = _set(df, runout, "Matrix / Runout", forget=False)
    return df.withColumn("value", F.when(F.col("type") == "Barcode", X.barcode_clean("value")).otherwise(F.col("value")))


def _set(df: DataFrame, condition, new_type: str, forget: bool) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    df = df.withColumn("_hit", hit).withColumn("type", F.when(F.col("_hit"), new_type).otherwise(F.col("type")))
    if forget:
        df = df.withColumn("description", F.when(~F.col("_hit"), F.col("description")))
    return df.drop("_hit")


def add_label_id(releases_labels: DataFrame, labels: DataFrame) -> DataFrame:
    """Release labels with the id of the label of that name (the lowest id if names repeat)."""
    ids = labels.groupBy(F.col("name").alias("label")).agg(F.min("id").alias("label_id"))
    return releases_labels.join(ids, "label", "left").select(*releases_labels.columns, "label_id")


def dedupe_artists(artists: DataFrame) -> DataFrame:
    """One artist per name, the one with the lowest id."""
    keep = artists.groupBy("name").agg(F.min("id").alias("id"))
    return artists.join(keep.select("id"), "id", "left_semi").select(*artists.columns)


def add_missing_artist(artists: DataFrame, name: str = "Missing") -> DataFrame:
    """Artists plus the placeholder that dangling references point to."""
    row = artists.sparkSession.createDataFrame([(MISSING_ARTIST, name)], "id bigint, name string")
    return artists.unionByName(row, allowMissingColumns=True)


def repair_artist_ids(rows: DataFrame, artists: DataFrame, column: str = "artist_id") -> DataFrame:
    """References to unknown artists point to the placeholder; a NULL reference stays."""
    known = artists.select(F.col("id").alias(column)).distinct().withColumn("_known", F.lit(True))
    fixed = F.when(F.col("_known") | F.col(column).isNull(), F.col(column)).otherwise(F.lit(MISSING_ARTIST).cast("bigint"))
    return rows.join(known, column, "left").withColumn(column, fixed).select(*rows.columns)


# Store albums -----------------------------------------------------------------------------------


def new_albums(listed: DataFrame, stored: DataFrame, prefix: str = "cdbaby:") -> DataFrame:
    """Listed album ids that are not stored yet, with the key they will be stored under."""
    keyed = listed.select("cdbaby_id", F.concat(F.lit(prefix), "cdbaby_id").alias("_id")).filter("cdbaby_id IS NOT NULL").distinct()
    return keyed.join(stored.select("_id").distinct(), "_id", "left_anti").select("_id", "cdbaby_id")


def store_new(pages: DataFrame, stored: DataFrame, prefix: str = "cdbaby:") -> DataFrame:
    """Parsed albums that are not stored yet, marked as not imported. Of several pages of one album the least in all columns counts, title first."""
    fresh = pages.withColumn("_id", F.concat(F.lit(prefix), "cdbaby_id")).filter("_id IS NOT NULL")
    fresh = first_by(fresh, ["_id"], ["title"])
    status = F.struct(F.lit(False).alias("imported"), F.current_timestamp().alias("added"))
    return fresh.join(stored.select("_id").distinct(), "_id", "left_anti").withColumn("status", status)


def reuse_artist_ids(albums: DataFrame, artists: DataFrame, prefix: str = "cdbaby:") -> DataFrame:
    """Albums with the identifier of an artist created before; type defaults to ``album``.

    ``artists`` is ``(_id, mbid)``.
    """
    known = artists.groupBy(F.col("_id").alias("_artist")).agg(F.min("mbid").alias("_mbid"))
    return (
        albums.withColumn("_artist", F.concat(F.lit(prefix), "artist_cdbaby_id"))
        .join(known, "_artist", "left")
        .withColumn("artist_mbid", F.coalesce("artist_mbid", "_mbid"))
        .withColumn("type", F.coalesce("type", F.lit("album")))
        .select(*albums.columns)
    )


def new_artists(albums: DataFrame, artists: DataFrame, prefix: str = "cdbaby:") -> DataFrame:
    """Store artists that have to be created: (_id, name), one row each."""
    wanted = albums.filter("artist_mbid IS NULL").groupBy(F.concat(F.lit(prefix), "artist_cdbaby_id").alias("_id")).agg(F.min("artist").alias("name"))
    return wanted.join(artists.select("_id"), "_id", "left_anti")


def mark_imported(albums: DataFrame, imported: DataFrame) -> DataFrame:
    """Albums after an import run ``(_id, mbid)``: identifier set and status flipped."""
    done = imported.select("_id", F.col("mbid").alias("_mbid"))
    flag = F.coalesce(F.col("status.imported"), F.lit(False)) | F.col("_mbid").isNotNull()
    status = F.when(F.col("status").isNotNull(), F.col("status")).otherwise(F.from_json(F.lit("{}"), albums.schema["status"].dataType))
    return (
        albums.join(done, "_id", "left")
        .withColumn("mbid", F.coalesce("_mbid", "mbid"))
        .withColumn("status", status.withField("imported", flag))
        .select(*albums.columns)
    )


def album_form(albums: DataFrame, note_base: str = "http://www.cdbaby.com/cd/") -> DataFrame:
    """Nested album -> flat (``_id``, key, value) rows; absent values give no row."""
    date = F.split("date", "-")
    simple = {
        "artist_credit.names.0.artist.name": F.col("artist"),
        "artist_credit.names.0.name": F.col("artist"),
        "artist_credit.names.0.mbid": X.blank_to_null("artist_mbid"),
        "name": F.col("title"),
        "date.year": F.when(F.col("date") != "", F.try_element_at(date, F.lit(1))),
        "date.month": F.try_element_at(date, F.lit(2)),
        "date.day": F.try_element_at(date, F.lit(3)),
        "labels.0.name": X.blank_to_null("label"),
        "barcode": X.blank_to_null("barcode"),
        "edit_note": F.concat(F.lit(note_base), F.try_element_at(F.split("_id", ":"), F.lit(2))),
    }

    def entry(key, value):
        return F.struct(F.lit(key).alias("key") if isinstance(key, str) else key.alias("key"), value.cast("string").alias("value"))

    def of_medium(m, i):
        root = F.concat(F.lit("mediums."), i.cast("string"))

        def of_track(t, j):
            base = F.concat(root, F.lit(".track."), j.cast("string"))
            return F.array(
                entry(F.concat(base, F.lit(".position")), t["position"]),
                entry(F.concat(base, F.lit(".name")), t["title"]),
                entry(F.concat(base, F.lit(".length")), X.format_seconds(t["length"])),
            )

        head = F.array(entry(F.concat(root, F.lit(".format")), m["format"]), entry(F.concat(root, F.lit(".position")), m["position"]))
        return F.concat(head, F.flatten(F.transform(m["tracks"], of_track)))

    pairs = F.concat(F.array(*[entry(k, v) for k, v in simple.items()]), F.flatten(F.transform("mediums", of_medium)))
    return albums.select("_id", F.explode(pairs).alias("p")).select("_id", "p.key", "p.value").filter("value IS NOT NULL")


# Rights-society works --------------------------------------------------------------------------


def iswc_push(works: DataFrame, a_works: DataFrame, writers: DataFrame, artists: DataFrame, server: str = "http://www.ascap.com") -> DataFrame:
    """Works of catalog A that lack an ISWC known to the rights society.

    (gid, workid, iswc, artist, work, note): title equal ignoring case and one writer shared by
    name. A work of catalog A that matches works with different codes is left out.
    ``a_works`` is ``(gid, name, iswc, writer)``, one row per writer.
    """
    rights = works.filter("iswc IS NOT NULL").select(F.col("id").alias("workid"), F.col("name").alias("work"), "iswc")
    names = artists.select(F.col("artist").alias("_artist"), F.col("name").alias("artist")).distinct()
    society = (
        rights.join(writers.select(F.col("artist").alias("_artist"), F.col("work").alias("workid")), "workid")
        .join(names, "_artist")
        .select("workid", "iswc", "work", "artist", X.name_key("work").alias("_work"), X.name_key("artist").alias("_writer"))
    )
    lacking = a_works.filter("iswc IS NULL").select("gid", X.name_key("name").alias("_work"), X.name_key("writer").alias("_writer")).distinct()
    # codes per (title, writer) first, so that a common title does not multiply
    per_key = society.groupBy("_work", "_writer").agg(
        F.min("iswc").alias("lo"), F.max("iswc").alias("hi"), F.min(F.struct("workid", "iswc", "artist", "work")).alias("first"))
    per_work = lacking.join(per_key, ["_work", "_writer"]).groupBy("gid").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"))
    note = F.concat(F.lit("Data taken from "), urls.rights_search_url("workid", "i", server))
    return per_work.filter("lo = hi").select("gid", "first.*").withColumn("note", note)
