"""Links between the catalogs: views over the edge tables, resolution to ids, incremental sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catlink.config import B_LINK, Catalog, Sites
from catlink.functions import urls
from catlink.functions.text import name_key
from catlink.operators.keys import except_rows

LINK_COLUMNS = ["gid", "name", "url", "id", "edits_pending"]
KINDS = ("release", "release_group", "artist", "label")
# Path of an entity kind in addresses of catalog B.
B_PATH = {"release": "release", "release_group": "master", "artist": "artist", "label": "label"}


def link_view(a: Catalog, kind: str, link: int | None = None) -> DataFrame:
    """Entities of catalog A with their address in catalog B: (id, name, gid, url, edits_pending)."""
    edges = getattr(a, f"l_{kind}_url").filter(F.col("link") == (B_LINK[kind] if link is None else link))
    e = edges.select("entity0", "entity1", "edits_pending")
    entity = getattr(a, kind).select("id", "name", "gid")
    return (
        e.join(a.url.select(F.col("id").alias("entity1"), "url"), "entity1")
        .join(entity, F.col("entity0") == F.col("id"))
        .select("id", "name", "gid", "url", "edits_pending")
    )


def add_link_views(a: Catalog) -> Catalog:
    """Catalog A with ``release_link``, ``release_group_link``, ``artist_link`` and ``label_link``."""
    return a.with_tables(**{f"{k}_link": link_view(a, k) for k in KINDS})


def _by_id(view: DataFrame, known: DataFrame, prefix: str) -> DataFrame:
    with_id = view.select("gid", "name", "url", urls.id_from_url("url", prefix).alias("id"), "edits_pending").filter("id IS NOT NULL")
    return with_id.join(known.select("id"), "id", "left_semi").select(*LINK_COLUMNS)


def _by_name(view: DataFrame, known: DataFrame, prefix: str) -> DataFrame:
    decoded = view.select("gid", "name", "url", "edits_pending", name_key(urls.decode_name("url", prefix)).alias("_key"))
    names = known.select(name_key("name").alias("_key"), "id")
    found = decoded.join(names, "_key").groupBy("gid", "name", "url", "edits_pending").agg(F.min("id").alias("id"))
    return found.select(*LINK_COLUMNS)


def resolve_links(kind: str, view: DataFrame, b: Catalog, sites: Sites) -> DataFrame:
    """Attach catalog B ids to a link view; links to unknown entities are dropped.

    Releases and release groups carry the id in the address, artists and labels their encoded
    name. One row per (gid, url): where several names agree when case is ignored, the lowest id.
    """
    prefix = sites.b(B_PATH[kind])
    if kind in ("release", "release_group"):
        found = _by_id(view, b.release if kind == "release" else b.master, prefix)
    else:
        found = _by_name(view, getattr(b, kind), prefix)
    return found.groupBy("gid", "name", "url", "edits_pending").agg(F.min("id").alias("id")).select(*LINK_COLUMNS)


def add_resolved_links(b: Catalog, a: Catalog, sites: Sites) -> Catalog:
    """Catalog B with the resolved link tables of catalog A."""
    return b.with_tables(**{f"{k}_link": resolve_links(k, getattr(a, f"{k}_link"), b, sites) for k in KINDS})


# Incremental sync ----------------------------------------------------------------------------


def sync_candidates(kind: str, view: DataFrame, b: Catalog, sites: Sites) -> DataFrame:
    """Current links in the shape of the stored table.

    Releases and release groups keep ids that catalog B does not have yet (the check comes when
    they are added); artists and labels need the entity to get an id at all.
    """
    prefix = sites.b(B_PATH[kind])
    if kind in ("release", "release_group"):
        return view.select("gid", "name", "url", urls.id_from_url("url", prefix).alias("id"), "edits_pending").filter("id IS NOT NULL")
    return _by_name(view, getattr(b, kind), prefix)


def sync_changes(stored: DataFrame, current: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(added, removed): set differences both ways; additions only where the id is ``known``."""
    stored, current = stored.select(*LINK_COLUMNS), current.select(*LINK_COLUMNS)
    added = except_rows(current, stored)
    if known is not None:
        added = added.join(known.select("id").distinct(), "id", "left_semi").select(*LINK_COLUMNS)
    return added, except_rows(stored, current)


def apply_changes(stored: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The next version of the stored table. Removal is null-safe."""
    return except_rows(stored.select(*LINK_COLUMNS), removed).unionByName(added.select(*LINK_COLUMNS))


def sync_event(table: str, added: DataFrame, removed: DataFrame) -> DataFrame:
    """One log row ``(updated, event)`` with both counts."""
    sides = added.select(F.lit(1).alias("plus"), F.lit(0).alias("minus")).unionByName(
        removed.select(F.lit(0).alias("plus"), F.lit(1).alias("minus")))
    n = sides.agg(F.coalesce(F.sum("plus"), F.lit(0)).alias("plus"), F.coalesce(F.sum("minus"), F.lit(0)).alias("minus"))
    event = F.concat(F.lit("removed: "), F.col("minus").cast("string"), F.lit(", added: "), F.col("plus").cast("string"))
    return n.select(F.lit(table).alias("updated"), event.alias("event"))


def drop_stale_evidence(evidence: DataFrame, added_artists: DataFrame, everything: bool = False) -> DataFrame:
    """Evidence to keep after an artist sync: rows of newly linked artists go.

    Release-credit evidence is dropped whole (``everything``), as it is rebuilt after each sync.
    """
    if everything:
        return evidence.limit(0)
    return evidence.join(added_artists.select("gid").distinct(), "gid", "left_anti")


# Link phrases ------------------------------------------------------------------------------------


def link_phrases(a: Catalog) -> DataFrame:
    """(link, link_type, phrase): the type's phrase with its ``{attribute…}`` holes filled.

    A hole takes the names of the link's attributes below that root, or nothing.
    """
    link = a.link.select(F.col("id").alias("link"), "link_type")
    types = a.link_type.select(F.col("id").alias("link_type"), "link_phrase")
    attr = a.link_attribute_type
    roots = a.link_type_attribute_type.select("link_type", F.col("attribute_type").alias("root")).join(
        attr.select(F.col("id").alias("root"), F.col("name").alias("root_name")), "root")
    values = a.link_attribute.select("link", F.col("attribute_type").alias("value")).join(
        attr.select(F.col("id").alias("value"), "root", F.col("name").alias("value_name")), "value").select("link", "root", "value_name")
    holes = (
        link.join(roots, "link_type")
        .join(values, ["link", "root"], "left")
        .groupBy("link", "root_name")
        .agg(F.array_join(F.sort_array(F.collect_list("value_name")), ", ").alias("text"))
        .groupBy("link")
        .agg(F.sort_array(F.collect_list(F.struct("root_name", "text"))).alias("holes"))
    )
    none = F.array().cast("array<struct<root_name:string,text:string>>")

    def quoted(c: Column) -> Column:
        return F.regexp_replace(c, r"([\\$])", r"\\$1")

    def fill(acc: Column, hole: Column) -> Column:
        name = F.regexp_replace(hole["root_name"], r"([\\.\[\]{}()*+?^$|])", r"\\$1")
        pattern = F.concat(F.lit(r"(?s)^(.*?)\{"), name, F.lit(r"(?::.+?)?\}"))
        return F.regexp_replace(acc, pattern, F.concat(F.lit("$1"), quoted(hole["text"])))

    filled = F.reduce(F.coalesce("holes", none), F.col("link_phrase"), fill)
    return (
        link.join(types, "link_type")
        .join(holes, "link", "left")
        .select("link", "link_type", F.trim(F.replace(filled, F.lit("  "), F.lit(" "))).alias("phrase"))
    )


