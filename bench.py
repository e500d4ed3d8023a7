"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from lodegate import build_session
from lodegate.plans import load_queries

HEADLINES = (
    "canonical_url", "raw_document_identity", "content_dedupe_first", "two_key_claim", "freshness_gate",
    "freshness_summary", "parsed_dates", "date_priority", "page_article", "feed_items", "archive_candidates",
    "organization_candidates", "product_candidates", "keyword_rules", "chunk_documents", "extraction_merge",
    "fallback_chain", "entity_resolution", "bibliography_join", "repository_stars", "insert_flags",
    "record_problems", "export_cells", "token_grants", "breaker_replay", "article_records",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cores}]",
        shuffle_partitions=int(cores),
        extra={"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps(
        {"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
    ))
    spark.stop()


if __name__ == "__main__":
    main()
