"""How a registered query is built and checked."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from catlink import session
from catlink.config import Catalog, Sites
from catlink.functions import wikitext
from catlink.operators import catalog as prep, evidence, links
from catlink.operators.wiki import search
from catlink.plans import shapes
from catlink.sources import dictionaries

SITES = Sites("A", "B", "http://a.example/", "http://b.example/", "http://img.example/")


class _Views(Catalog):
    """Catalog tables taken from the shapes on first use."""

    def __init__(self, ctx: "Ctx", prefix: str, derived: dict[str, Callable[[], DataFrame]]):
        super().__init__({})
        self._ctx, self._prefix, self._derived = ctx, prefix, derived

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = self._derived[name]() if name in self._derived else self._ctx.view(self._prefix + name)
        return self._tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self._tables or name in self._derived


# Views with joins or aggregations of their own, kept as tables like a catalog's real ones.
STORED = {
    "line", "a_url", "a_l_artist_artist", "b_releases_labels", "b_masters_artists", "b_releases_artists", "b_tracks_artists", "b_tracks_extraartists",
    "b_releases_extraartists", "w_page", "w_page_fr", "w_artist", "w_title",
}


class Ctx:
    """Catalogs and views over one data folder.

    Link tables, mappings and the views in ``STORED`` are materialised on first use and shared by
    all queries of the session.
    """

    _open: dict[tuple[str, str], "Ctx"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.sites = spark, folder, SITES
        session.bound_batches(spark)
        self._paths: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Ctx":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    def view(self, name: str) -> DataFrame:
        if name not in self._frames:
            for needed in shapes.dependencies(name, self._paths):
                if needed in STORED and needed not in self._paths:
                    df = shapes.view(self.spark, self.folder, needed, self._paths)
                    path = session.stored_path(self.spark, needed)
                    with session.dropping_shuffles(self.spark):
                        df.write.option("compression", "zstd").parquet(path)
                    self._paths[needed] = path
            df = shapes.view(self.spark, self.folder, name, self._paths)
            self._frames[name] = df
        return self._frames[name]

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        return session.materialise(df, name)

    @cached_property
    def a(self) -> Catalog:
        derived = {f"{k}_link": (lambda k=k: self.keep(f"a_{k}_link", links.link_view(self.a, k))) for k in links.KINDS}
        derived |= {
            "credited": lambda: self.keep("a_credited", evidence.credits_with_links(self.a)),
            "artist_relations": lambda: self.keep("a_artist_relations", evidence.relations_with_links(self.a)),
        }
        return _Views(self, "a_", derived)

    @cached_property
    def b(self) -> Catalog:
        def resolved(kind: str) -> DataFrame:
            return self.keep(f"b_{kind}_link", links.resolve_links(kind, getattr(self.a, f"{kind}_link"), self.b, SITES))

        derived = {f"{k}_link": (lambda k=k: resolved(k)) for k in links.KINDS}
        derived |= {
            "release_format": lambda: prep.release_format(self.b.releases_formats, self.view("b_format_mapping")),
            "linked_releases": lambda: self.keep("b_linked_releases", evidence.releases_with_links(self.a, self.b)),
            "release_status": lambda: prep.release_status(self.b.releases_formats),
            "release_track_count": lambda: prep.track_count(self.b.track),
            "release_mapping": lambda: self.keep("release_mapping", prep.release_mapping(
                self.b.release, self.b.release_format, self.b.release_track_count, self.b.release_status, self.countries)),
        }
        return _Views(self, "b_", derived)

    @cached_property
    def track_evidence(self) -> DataFrame:
        """Stored, as the total over all evidence reads it."""
        return self.keep("track_evidence", evidence.track_evidence(self.a, self.b, SITES))

    @cached_property
    def credit_evidence(self) -> DataFrame:
        phrases = links.link_phrases(self.a)
        return self.keep("credit_evidence", evidence.release_credit_evidence(self.a, self.b, self.view("roles"), phrases, SITES))

    @cached_property
    def parsed_pages(self) -> DataFrame:
        """Pages with their parsed columns, stored as every fact is read from them.

        The page number is the key, as titles may repeat in this data.
        """
        pages = self.view("w_page").select(F.col("doc_id").cast("string").alias("_id"), "text")
        return self.keep("parsed_pages", pages.select(*wikitext.page_struct("_id", "text", "en")))

    @cached_property
    def parsed_french_pages(self) -> DataFrame:
        return self.keep("parsed_french_pages", self.view("w_page_fr").select(*wikitext.page_struct("title", "text", "fr"), "doc_id"))

    @cached_property
    def title_index(self) -> search.TitleIndex:
        return search.build_index(self.view("w_page"))

    @cached_property
    def countries(self) -> DataFrame:
        return prep.country_mapping(dictionaries.country_names(self.spark), self.a.country)


@dataclass(frozen=True)
class Query:
    build: Callable[[Ctx], DataFrame]
    oracle: str | None = None


class Registry(dict):
    """Queries by name; ``add`` is the decorator that fills it."""

    def add(self, oracle: str | None = None, name: str | None = None):
        def wrap(build: Callable[[Ctx], DataFrame]):
            self[name or build.__name__] = Query(build, oracle)
            return build

        return wrap
