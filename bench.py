"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Queries given as arguments
replace the default list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from mnemospark.plans import QUERIES
from mnemospark.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))

HEADLINE = [
    "v1_vector_topk", "p3_filtered_vector_search", "v3_ann_topk", "v5_mmr", "v6_embed",
    "t1_build_text_index", "t2_bm25_topk", "h2_hybrid_topk", "h4_rerank", "h5_parent_documents",
    "c1_chunk_tokens", "c4_sync_report", "c5_ls", "c6_glob", "c7_grep_literal", "c8_grep_hybrid",
    "g1_upsert_attributes", "g2_related_entities", "s9_upsert", "m2_store_apply", "m3_store_search",
    "k2_put_writes", "k4_get_checkpoint", "k6_lineage", "w3_last_messages", "x2_semantic_cache_lookup",
    "c9_ledger_update", "j1_lookup_unwind",
]


def main() -> None:
    spark = local_session(CPUS, "bench", memory="16g", shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executors and their Python workers.
    spark.range(0, 10_000, 1, int(CPUS)).mapInArrow(lambda batches: batches, "id bigint").count()
    spark.read.parquet(f"{FOLDER}/region.parquet").count()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
