"""Times the headline queries and prints one JSON line.

Every query is run to its end into the no-op sink: once to warm up, then
``BENCH_RUNS`` times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.queries import QUERIES  # noqa: E402

HEADLINE = [
    # candles
    "kline_resample", "sma20", "rsi10", "ema", "macd_line", "bollinger", "volume_profile",
    "indicator_series", "indicator_snapshot", "sentiment_labels", "market_regime",
    "price_change_24h", "max_24h_cache", "rolling_max_24h", "latest_350_per_symbol",
    # quality
    "dq_check", "dq_unique_combination", "dq_referential", "distinct_profile",
    "dedup_keep_first", "duplicate_report", "schema_contract_check",
    # news and comments
    "json_articles_flatten", "page_article_extract", "news_quality", "comments_quality",
    # gold
    "surrogate_key", "news_to_gold", "comments_to_gold", "statistic_to_gold", "max_cache_upsert",
    # streams
    "drain_available", "stream_bars", "stream_max_24h",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
