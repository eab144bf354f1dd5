"""catlink: link and enrich two music catalogs with Spark DataFrames."""

from catlink.config import Catalog, Sites

__all__ = ["Catalog", "Sites"]
