"""All registered queries."""

from __future__ import annotations

from catlink.plans import link_queries, report_queries, text_queries, wiki_queries
from catlink.plans.oracle_views import oracle
from catlink.plans.registry import Ctx, Query

ALL: dict[str, Query] = {}
for _module in (text_queries, link_queries, report_queries, wiki_queries):
    for _name, _query in _module.Q.items():
        if _name in ALL:
            raise ValueError(f"query {_name!r} is registered twice")
        ALL[_name] = _query

__all__ = ["ALL", "Ctx", "Query", "oracle"]
