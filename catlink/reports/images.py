"""Cover images that catalog A lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catlink.config import Catalog, Sites
from catlink.operators.keys import repeated

MIN_SIDE = 500


def missing_images(a: Catalog, b: Catalog, sites: Sites) -> DataFrame:
    """(gid, id, height, width, type, url, score): images of uniquely linked releases without cover art.

    The image is primary or large. ``score`` is the area of the largest primary image of the
    release, by which the report is sorted; releases without a primary image are left out.
    """
    link = a.release_link
    unique = (
        link.filter("edits_pending = 0")
        .join(repeated(link, ["gid"], "url"), "gid", "left_anti")
        .join(repeated(link, ["url"], "gid"), "url", "left_anti")
    )
    bare = a.release_meta.filter("amazon_asin IS NULL AND cover_art_presence = 'absent'").select("id")
    wanted = unique.join(bare, "id", "left_semi").select("gid").distinct()
    pictures = b.image.filter(f"type = 'primary' OR (height >= {MIN_SIDE} AND width >= {MIN_SIDE})").withColumnRenamed("id", "image_id")
    rows = (
        b.release_link.select("gid", "id").join(wanted, "gid", "left_semi")
        .join(b.releases_images.select(F.col("release_id").alias("id"), "image_id"), "id")
        .join(pictures, "image_id")
        .select("gid", "id", "height", "width", "type", F.concat(F.lit(sites.image_base), "uri").alias("url"))
    )
    score = rows.filter("type = 'primary'").groupBy("gid").agg(F.max(F.col("height").cast("bigint") * F.col("width")).alias("score"))
    return rows.join(score, "gid").orderBy(F.desc("score"), "gid", "url")


def image_event(images: DataFrame) -> DataFrame:
    """Log row ``(updated, event)`` with the number of images and releases."""
    n = images.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("gid").alias("g"))
    event = F.concat(F.lit("Report contains: "), F.col("n").cast("string"), F.lit(" images for "), F.col("g").cast("string"), F.lit(" releases"))
    return n.select(F.lit("report_images").alias("updated"), event.alias("event"))
