"""Entities of catalog A that lack an encyclopedia link, or data an article could supply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from catlink.config import LINK_TYPE, Catalog
from catlink.functions.text import LANGUAGE_SCRIPTS, has_script
from catlink.functions.urls import wiki_base
from catlink.operators.state import not_processed

# Countries whose artists an encyclopedia language accepts (English accepts all).
LANGUAGE_COUNTRIES = {"fr": ("FR", "MC")}
SCRIPT_COUNTRIES = {"ja": "JP", "ko": "KR"}
GROUP_TYPES = ("Album", "EP", "Live", "Remix", "Compilation", "Soundtrack")
FIRST_ORDINARY_ID = 3


def wiki_edges(a: Catalog, kind: str, lang: str | None) -> DataFrame:
    """Encyclopedia link edges of an entity kind, of one language or any: (entity, url, edits_pending)."""
    links = a.link.filter(F.col("link_type") == LINK_TYPE[f"{kind}_wiki"]).select(F.col("id").alias("link"))
    edges = getattr(a, f"l_{kind}_url").join(links, "link", "left_semi").select(F.col("entity0").alias("entity"), F.col("entity1").alias("url_id"), "edits_pending")
    if lang is None:
        return edges
    urls = a.url.filter(F.col("url").startswith(wiki_base(lang))).select(F.col("id").alias("url_id"), "url")
    return edges.join(urls, "url_id").select("entity", "url", "edits_pending")


def _without_page(a: Catalog, kind: str, lang: str | None) -> DataFrame:
    done = wiki_edges(a, kind, lang).select(F.col("entity").alias("id")).distinct()
    return getattr(a, kind).join(done, "id", "left_anti")


def _cut(df: DataFrame, order: Sequence, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy(*order).limit(limit)


def artists(a: Catalog, lang: str, ledger: DataFrame, limit: int | None = None, countries: Sequence[str] | None = None) -> DataFrame:
    """(id, gid, name, country): artists without a page in the language.

    The artist's country is unknown or accepted by the language. Artists of a known country come first.
    """
    accepted = LANGUAGE_COUNTRIES.get(lang) if countries is None else countries
    codes = a.country.select(F.col("id").alias("country"), F.col("iso_code"))
    rows = _without_page(a, "artist", lang).filter(F.col("id") >= FIRST_ORDINARY_ID).select("id", "gid", "name", "country").join(codes, "country", "left")
    if accepted:
        rows = rows.filter(F.col("iso_code").isNull() | F.col("iso_code").isin(*accepted))
    elif lang != "en":
        rows = rows.filter(F.col("iso_code").isNull())
    rows = not_processed(rows.select("id", "gid", "name", F.col("iso_code").alias("country")), ledger, lang)
    return _cut(rows, [F.asc_nulls_last("country"), "id"], limit)


def release_groups(a: Catalog, lang: str, ledger: DataFrame, limit: int | None = None,
                   countries: Sequence[str] | None = None) -> DataFrame:
    """(id, gid, name, credit_name, type_name): albums without a page in the language.

    Unless the language accepts all countries, the credit has exactly one artist of an accepted one.
    """
    accepted = LANGUAGE_COUNTRIES.get(lang) if countries is None else countries
    types = a.release_group_type.select(F.col("id").alias("type"), F.col("name").alias("type_name"))
    rows = _without_page(a, "release_group", lang).filter(F.col("artist_credit") >= FIRST_ORDINARY_ID)
    rows = rows.join(types, "type", "left").filter(F.col("type").isNull() | F.col("type_name").isin(*GROUP_TYPES))
    if accepted or lang != "en":
        codes = a.country.filter(F.col("iso_code").isin(*(accepted or ()))).select(F.col("id").alias("country"))
        people = a.artist.select(F.col("id").alias("artist"), "country").join(codes, "country", "left_semi").select("artist")
        one = a.artist_credit_name.join(people, "artist", "left_semi").groupBy("artist_credit").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("artist_credit")
        rows = rows.join(one, "artist_credit", "left_semi")
    rows = rows.select("id", "gid", "name", "artist_credit", "type_name")
    credits = a.artist_credit.select(F.col("id").alias("artist_credit"), F.col("name").alias("credit_name"))
    rows = not_processed(rows.join(credits, "artist_credit"), ledger, lang)
    return _cut(rows, ["artist_credit", "id"], limit).select("id", "gid", "name", "credit_name", "type_name")


def labels(a: Catalog, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, gid, name): labels without an encyclopedia page in any language."""
    rows = _without_page(a, "label", None).filter(F.col("id") >= FIRST_ORDINARY_ID).select("id", "gid", "name")
    return _cut(not_processed(rows, ledger), ["id"], limit)


def artists_in_script(a: Catalog, lang: str, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, gid, name, in_script): artists without any page who have releases in the language's country.

    Names not written in the language's script are flagged, so that they can go straight to the ledger.
    """
    code = a.country.filter(F.col("iso_code") == SCRIPT_COUNTRIES[lang]).select(F.col("id").alias("country"))
    credits = a.release.join(code, "country", "left_semi").select("artist_credit").distinct()
    there = a.artist_credit_name.join(credits, "artist_credit", "left_semi").select(F.col("artist").alias("id")).distinct()
    rows = _without_page(a, "artist", None).filter(F.col("id") >= FIRST_ORDINARY_ID).join(there, "id", "left_semi").select("id", "gid", "name")
    rows = _cut(not_processed(rows, ledger), ["id"], limit)
    return rows.withColumn("in_script", has_script("name", *LANGUAGE_SCRIPTS[lang]))


def artists_lacking_data(a: Catalog, lang: str, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """Artists with a settled page link who lack country, type, gender or dates, with their first address."""
    t = F.col("type")
    born, gender = F.col("begin_date_year").isNull(), F.col("gender").isNull()
    lacking = (
        F.col("country").isNull() | t.isNull()
        | ((t.isNull() | (t == 1)) & (born | gender))
        | ((t.isNull() | (t == 2)) & born)
    )
    edges = wiki_edges(a, "artist", lang).filter("edits_pending = 0").groupBy(F.col("entity").alias("id")).agg(F.min("url").alias("url"))
    rows = a.artist.filter(lacking).join(edges, "id")
    return _cut(not_processed(rows, ledger), ["id"], limit)
