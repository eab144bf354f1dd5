"""Time the headline queries: ``BENCH_SF_DIR=… BENCH_CPUS=… python bench.py`` prints one JSON line.

Link tables, mappings, the title index and the stored views are materialised first, as in a running
installation; that time is reported as ``setup``. Each query is run once to its full result without collecting it.
"""

from __future__ import annotations

import json
import os
import time

from catlink import session
from catlink.plans.queries import ALL, Ctx

HEADLINE = [
    "release_link_proposals", "release_sync_added", "link_cleanup", "artist_evidence_track", "artist_evidence_shared_titles",
    "artist_evidence_all", "label_evidence", "release_group_link_proposals", "remix_proposals", "common_masters", "release_artists_report", "release_checks",
    "track_alignment", "b_release_info_long", "coverage_report", "title_search", "mangle_documents", "mention_ratio", "page_country", "page_text",
    "upsert_latest", "guess_case",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        session.builder("catlink-bench").master(f"local[{cpus}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config(session.FOLDER, os.environ.get("BENCH_SCRATCH", "/tmp/catlink-checkpoint")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ctx = Ctx.of(spark, folder)
    start = time.time()
    for kind in ("release", "release_group", "artist", "label"):
        getattr(ctx.a, f"{kind}_link"), getattr(ctx.b, f"{kind}_link")
    ctx.b.release_mapping, ctx.track_evidence, ctx.credit_evidence
    ctx.view("w_page"), ctx.view("w_title"), ctx.title_index, ctx.b.tracks_artists, ctx.b.tracks_extraartists, ctx.b.releases_extraartists, ctx.b.releases_artists, ctx.b.masters_artists
    setup = time.time() - start
    spent = {}
    for name in wanted:
        if name not in ALL:
            continue
        start = time.time()
        ALL[name].build(ctx).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent, "setup": round(setup, 3),
        "sf": os.path.basename(folder).removeprefix("sf"), "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
