"""Encyclopedia page markup: removal, categories, infoboxes, first paragraph."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F

from catlink.functions import markup
from catlink.functions.text import col

# Per-language page patterns.
CATEGORY = {
    "en": r"\[\[Category:(.+?)(?:\|.*?)?\]\]",
    "fr": r"\[\[Catégorie:(.+?)\]\]",
}
INFOBOX_TYPES = {
    "en": r"musical artist|person",
    "fr": r"Musique \(artiste\)|Musique classique \(personnalité\)",
}
PERSONDATA_NAMES = {"en": "Persondata", "fr": "Métadonnées personne"}
PERSONDATA_FIELDS_FR = {
    "nom": "name",
    "noms alternatifs": "alternatives names",
    "courte description": "short description",
    "date de naissance": "date of birth",
    "lieu de naissance": "place of birth",
    "date de décès": "date of death",
    "lieu de décès": "place of death",
}


def _scanned(scan: Callable[[pa.Array], list], kind: str, arrow: pa.DataType, text: Column | str) -> Column:
    """A column scanned in Arrow batches by one of the functions of ``markup``."""
    return F.arrow_udf(lambda x: pa.array(scan(x), arrow), kind)(col(text))


def _plain(x: pa.Array) -> list:
    return [v if v is None else v.decode() for v in markup.without_markup(x)]


def _first(x: pa.Array) -> list:
    return [v if v is None else v.decode() for v in markup.first_paragraphs(x)]


def remove_markup(text: Column | str) -> Column:
    """Drop templates (nested) and comments.

    The depths of both are prefix sums over the marks. Text is kept only while both are exactly zero, so
    a stray closing mark, which makes its depth negative, also hides what follows. Texts without marks stay in the JVM.
    """
    t = col(text)
    return F.when(t.rlike(r"\{\{|\}\}|<!--|-->"), _scanned(_plain, "string", pa.string(), F.when(t.rlike(r"\{\{|\}\}|<!--|-->"), t))).otherwise(t)


def first_paragraph(text: Column | str) -> Column:
    """What comes before the first empty line once markup is gone."""
    return _scanned(_first, "string", pa.string(), text)


def categories(text: Column | str, lang: str) -> Column:
    return F.regexp_extract_all(col(text), F.lit(CATEGORY[lang]), F.lit(1))


_MAP = pa.map_(pa.string(), pa.string())


def infobox(text: Column | str, lang: str) -> Column:
    """Map of the first artist infobox; the infobox type is under ``_type``. Empty if there is none."""
    head = re.compile(r"\{\{Infobox (" + INFOBOX_TYPES[lang] + ")")

    def scan(x: pa.Array) -> list:
        found = (markup.template(t, head) for t in x.to_pylist())
        return [[] if f is None else [("_type", f[0]), *((k, v) for k, v in f[1].items() if k != "_type")] for f in found]

    return _scanned(scan, "map<string,string>", _MAP, text)


def persondata(text: Column | str, lang: str) -> Column:
    """Map of the person-data template, field names in English."""
    head, known = re.compile(r"\{\{" + PERSONDATA_NAMES[lang]), PERSONDATA_FIELDS_FR if lang == "fr" else {}

    def scan(x: pa.Array) -> list:
        found = (markup.template(t, head) for t in x.to_pylist())
        return [[] if f is None else list({known.get(k, k): v for k, v in f[1].items()}.items()) for f in found]

    return _scanned(scan, "map<string,string>", _MAP, text)


def page_struct(title: Column | str, text: Column | str, lang: str) -> list[Column]:
    """All derived columns of a page."""
    return [
        col(title).alias("title"),
        col(text).alias("text"),
        F.lit(lang).alias("lang"),
        categories(text, lang).alias("categories"),
        infobox(text, lang).alias("infobox"),
        persondata(text, lang).alias("persondata"),
        first_paragraph(text).alias("abstract"),
    ]

