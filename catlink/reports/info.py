"""Release information texts for both catalogs, for all releases at once.

``short`` is one comma-separated line, ``long`` a block of lines. Each part (labels, formats,
identifiers, …) is aggregated per release on its own and joined to the release.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catlink.config import Catalog
from catlink.functions.text import partial_date
from catlink.operators.evidence import text
from catlink.operators.keys import joined_text

CRLF = "\r\n"
TIMES = " × "


def _or_blank(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _in_parentheses(c: str) -> Column:
    return F.when(F.col(c).isNull() | (F.col(c) == ""), "").otherwise(text(" (", F.col(c), ")"))


def _per_release(df: DataFrame, value: Column, separator: str, out: str, key: str = "release_id") -> DataFrame:
    return df.select(key, value.alias("_v")).groupBy(key).agg(joined_text("_v", separator).alias(out))


def _check_mode(mode: str) -> bool:
    if mode not in ("short", "long"):
        raise ValueError(f"mode is 'short' or 'long', not {mode!r}")
    return mode == "short"


def _restrict(only: DataFrame | None):
    """Filter for tables of a release part: all rows, or those of the releases in ``only`` (release_id)."""
    def keep(df: DataFrame, key: str = "release_id") -> DataFrame:
        return df if only is None else df.join(only.select(F.col("release_id").alias(key)).distinct(), key, "left_semi")

    return keep


def b_release_info(b: Catalog, mode: str, only: DataFrame | None = None) -> DataFrame:
    """(release_id, info) for catalog B, of all releases or of those in ``only``.

    A short text is NULL when the release has no counted track.
    """
    short = _check_mode(mode)
    keep = _restrict(only)
    labels = _per_release(keep(b.releases_labels), text(F.col("label"), " - ", F.col("catno")), ", " if short else CRLF + "  ", "labels")
    words = F.col("descriptions")
    one_format = text(
        F.when(F.col("qty") == 1, "").otherwise(text(F.col("qty"), TIMES)),
        F.col("format_name"),
        F.when(F.size(words) == 0, ", ").otherwise(text(", ", F.array_join(words, ", "))),
        F.when(F.col("text").isNull() | (F.col("text") == ""), "").otherwise(text(", ", F.col("text"))),
    )
    formats = _per_release(keep(b.releases_formats), one_format, ", " if short else CRLF + "    ", "formats")
    ident = keep(b.release_identifier)
    code = F.col("value") if short else text(F.col("value"), _in_parentheses("description"))
    codes = ident.filter("type = 'Barcode'").select("release_id", code.alias("barcode")).distinct()
    barcodes = codes.groupBy("release_id").agg(joined_text("barcode", ", ").alias("line"), joined_text("barcode", CRLF + "    ").alias("block"), F.count("barcode").alias("n"))
    barcodes = barcodes.select("release_id", (F.col("line") if short else F.when(F.col("n") > 2, F.col("block")).otherwise(F.col("line"))).alias("barcodes"))
    base = keep(b.release, "id").withColumnRenamed("id", "release_id").join(labels, "release_id", "left").join(formats, "release_id", "left").join(barcodes, "release_id", "left")
    if short:
        counts = keep(b.track).filter("position <> ''").groupBy("release_id").agg(F.count(F.lit(1)).alias("n_tracks"))
        info = text("Format: ", _or_blank("formats"), ", Country: ", _or_blank("country"), ", Date: ", _or_blank("released"), ", Tracks: ",
                    F.col("n_tracks"), ", Barcode: ", _or_blank("barcodes"), ", Label: ", _or_blank("labels"))
        return base.join(counts, "release_id", "left").select("release_id", info.alias("info"))
    by_type = (
        ident.filter("type <> 'Barcode'").select("release_id", "type", text(F.col("value"), _in_parentheses("description")).alias("v"))
        .groupBy("release_id", "type").agg(joined_text("v", CRLF + "    ").alias("v"))
    )
    others = _per_release(by_type, text(F.col("type"), ": ", F.col("v")), CRLF + "  ", "others")
    info = text(
        "Release information", CRLF,
        "  Released: ", _or_blank("released"), CRLF,
        "  Country: ", _or_blank("country"), CRLF,
        "  Barcode: ", _or_blank("barcodes"), CRLF,
        "  Format: ", _or_blank("formats"), CRLF,
        CRLF, "Additional details", CRLF,
        "  Genre: ", F.array_join("genres", ", "), CRLF,
        "  Style: ", F.array_join("styles", ", "), CRLF,
        "  Data Quality: ", F.col("data_quality"), CRLF,
        CRLF, "Labels", CRLF, "  ", _or_blank("labels"), CRLF,
        F.when(F.col("notes").isNull(), "").otherwise(text(CRLF, "Notes", CRLF, F.col("notes"), CRLF)),
        F.when(F.col("others").isNull(), "").otherwise(text(CRLF, "Other identifiers", CRLF, "  ", F.col("others"), CRLF)),
    )
    return base.join(others, "release_id", "left").select("release_id", info.alias("info"))


def medium_formats(a: Catalog, only: DataFrame | None = None) -> DataFrame:
    """(id, formats): ``2 × CD, DVD`` over the media of a release."""
    named = _restrict(only)(a.medium, "release").select(F.col("release").alias("id"), "format").join(
        a.medium_format.select(F.col("id").alias("format"), F.col("name").alias("format_name")), "format")
    counts = named.groupBy("id", "format").agg(F.count(F.lit(1)).alias("n"), F.min("format_name").alias("format_name"))
    part = F.when(F.col("n") == 1, F.col("format_name")).otherwise(text(F.col("n"), TIMES, F.col("format_name")))
    return _per_release(counts, part, ", ", "formats", key="id")


def release_group_types(a: Catalog) -> DataFrame:
    """(release_group, type_text): primary type and its secondary types."""
    rg = a.release_group.select(F.col("id").alias("release_group"), F.col("type").alias("primary"))
    primary = a.release_group_primary_type.select(F.col("id").alias("primary"), F.col("name").alias("primary_name"))
    second = a.release_group_secondary_type_join.select("release_group", "secondary_type").join(
        a.release_group_secondary_type.select(F.col("id").alias("secondary_type"), F.col("name").alias("second_name")), "secondary_type")
    names = _per_release(second, F.col("second_name"), ", ", "second_names", key="release_group")
    joined = rg.join(primary, "primary").join(names, "release_group", "left")
    value = text(_or_blank("primary_name"), F.when(F.col("second_names").isNull(), "").otherwise(text(" + ", F.col("second_names"))))
    return joined.select("release_group", value.alias("type_text"))


def a_release_info(a: Catalog, mode: str, only: DataFrame | None = None) -> DataFrame:
    """(release_id, info) for catalog A, of all releases or of those in ``only``; unknown parts are left out."""
    short = _check_mode(mode)
    keep = _restrict(only)
    indent = "" if short else "  "
    pairs = keep(a.release_label, "release").join(a.label.select(F.col("id").alias("label"), "name"), "label").withColumnRenamed("release", "id")
    labels = _per_release(pairs, text(F.col("name"), " - ", F.col("catalog_number")), ", " if short else CRLF + "  ", "labels", key="id")

    def named(table: str, key: str, out: str, column: str = "name") -> DataFrame:
        return getattr(a, table).select(F.col("id").alias(key), F.col(column).alias(out))

    rel = (
        keep(a.release, "id").withColumn("release_date", partial_date("date_year", "date_month", "date_day"))
        .join(labels, "id", "left")
        .join(medium_formats(a, only), "id", "left")
        .join(release_group_types(a), "release_group", "left")
        .join(named("country", "country", "country_code", "iso_code"), "country", "left")
        .join(named("release_packaging", "packaging", "packaging_name"), "packaging", "left")
        .join(named("release_status", "status", "status_name"), "status", "left")
    )

    def line(label: str, column: str) -> Column:
        return text(label + ": ", F.col(column))

    details = [line(indent + label, column) for label, column in (("Type", "type_text"), ("Packaging", "packaging_name"), ("Status", "status_name"))]
    if short:
        counts = keep(a.medium, "release").select(F.col("release").alias("id"), "tracklist").join(
            a.tracklist.select(F.col("id").alias("tracklist"), "track_count"), "tracklist").groupBy("id").agg(F.sum("track_count").alias("n_tracks"))
        lines = [line("Format", "formats"), line("Country", "country_code"), line("Date", "release_date"), line("Tracks", "n_tracks"),
                 line("Barcode", "barcode"), line("Label", "labels"), *details]
        return rel.join(counts, "id", "left").select(F.col("id").alias("release_id"), F.array_join(F.array(*lines), ", ").alias("info"))
    quality = F.when(F.col("quality").isin(-1, 1), "Normal").when(F.col("quality") == 0, "Low").otherwise("High")
    lines = [
        F.lit("Release information"), line("  Date", "release_date"), line("  Country", "country_code"), line("  Barcode", "barcode"),
        line("  Format", "formats"), F.lit(""), F.lit("Additional details"), *details,
        line("  Language", "language_name"), line("  Script", "script_name"), text("  Data Quality: ", quality),
        F.lit(""), F.lit("Labels"), _or_blank("labels"),
    ]
    rel = rel.join(named("language", "language", "language_name"), "language", "left").join(named("script", "script", "script_name"), "script", "left")
    return rel.select(F.col("id").alias("release_id"), F.array_join(F.array(*lines), CRLF).alias("info"))
