"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores, BENCH_RUNS (default 3) the timed runs after one warm-up; the median counts.
All queries are timed equally often.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from harness.queries import QUERIES  # noqa: E402

HEADLINE = [
    "read_parquet",
    "row_key_compat",
    "row_key_all_columns",
    "bronze_itens_vendas",
    "silver_itens_vendas",
    "silver_vendas",
    "silver_pedidos",
    "silver_clientes",
    "dedupe_single_key",
    "dedupe_composite_key",
    "join_composite_key",
    "join_concat_compat",
    "gold_vendas_items",
    "gold_vendas_concat",
    "gold_vendas",
    "gold_clientes",
    "merge_upsert_all",
    "merge_upsert_delete",
    "merge_schema_evolution",
    "merge_set_from_frame",
    "create_or_upsert_twice",
    "compact_table",
    "full_run_vendas",
    "full_run_clientes",
    "rerun_incremental",
    "landing_stream_ingest",
    "user_sql_groupby",
    "user_sql_window",
]

def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_through(df: DataFrame) -> None:
    """Compute every row and column, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    run_through(QUERIES[name](spark, sf_dir))
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of warm medians over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
