"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "extract",
    "extract_counts",
    "page_stats",
    "book_kind",
    "conv_pos_codes",
    "typo_and_low_flags",
    "dup_headword_flags",
    "corpus_conflict_flags",
    "reconcile_flags",
    "gloss_conflicts",
    "homonym_exact",
    "similar_headwords",
    "morph_findings",
    "merge_corpus",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lexispark.plans.queries import QUERIES

    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
