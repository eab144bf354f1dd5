"""Parameters shared by the operators: how the two catalogs are named and addressed.

Catalog A is the entity/edge-shaped catalog that receives proposals, catalog B the
dump-shaped catalog that supplies the evidence.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Sites:
    """Names and base addresses that appear in notes and link URLs."""

    a_name: str = "Catalog A"
    b_name: str = "Catalog B"
    a_base: str = "http://a.example/"
    b_base: str = "http://b.example/"
    image_base: str = "http://images.b.example/image/"

    def a(self, kind: str) -> str:
        return f"{self.a_base}{kind}/"

    def b(self, kind: str) -> str:
        return f"{self.b_base}{kind}/"


# Ids of the link rows that attach a catalog-B address to an entity.
B_LINK = {"release": 6301, "release_group": 6309, "label": 27037, "artist": 26038}

# Link types used when a proposal is submitted.
LINK_TYPE = {
    "release_b": 76,
    "release_group_b": 90,
    "artist_b": 180,
    "label_b": 217,
    "release_image": 78,
    "artist_wiki": 179,
    "release_group_wiki": 89,
    "label_wiki": 216,
    "member_of_band": 103,
    "performs_as": 108,
    "producer": 30,
    "remixer": 153,
    "database_page": 188,
}

# Medium formats of the vinyl family, interchangeable when comparing.
VINYL_FORMATS = (7, 29, 30, 31)
SEVEN_INCH = 29
SPECIAL_ARTIST = 1
MISSING_ARTIST = 0
PERSON, GROUP = 1, 2


class Catalog:
    """A named set of DataFrames; ``cat.release`` is the table ``release``."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self._tables[name]
        except KeyError:
            raise AttributeError(f"catalog has no table {name!r}; it has {sorted(self._tables)}") from None

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def with_tables(self, **tables: DataFrame) -> "Catalog":
        return Catalog({**self._tables, **tables})

    def names(self) -> list[str]:
        return sorted(self._tables)
