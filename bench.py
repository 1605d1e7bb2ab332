"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES
from checks.searching import index
from placeweave.session import local_session

HEADLINE = [
    "tokens_filtered", "dict_backfill", "link_v1", "link_v2", "link_v3", "best_match", "nested_matches", "link_stats",
    "null_profile", "search_doc", "bm25_and", "bm25_or", "synonyms", "phrase", "fuzzy1", "fuzzy2", "fallback", "rerank",
    "ndcg", "wiki_records", "infobox_stats", "wiki_stream", "strip_tags", "listing_cards", "overlay", "jsonl_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if name == "bm25_and":
            start = time.perf_counter()
            index(spark, sf_dir)  # built once, shared by the searches that follow
            seconds["index_build"] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
