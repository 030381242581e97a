"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. Each query is computed in full
(every column of every row, into a sink that drops them); the fastest of ``BENCH_RUNS`` runs after one warm-up counts.
With ``BENCH_SQL=1`` the SQL oracles are timed the same way in DuckDB, under ``sql_queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from flowtide.session import build_session
from flowtide.workload import all_queries

HEADLINE = [
    "token_distribution_sum",
    "aggregated_positions",
    "latest_dates",
    "protocol_activity_counts",
    "compare_periods",
    "compare_periods_fan_out",
    "historical_changes",
    "period_snapshots",
    "rule_token_map",
    "updated_mapping",
    "network_nodes",
    "network_links",
    "historical_edges",
    "sector_flows",
    "top_shares",
    "weekly_pool_tvl",
    "token_moving_averages",
    "incremental_rows",
    "similarity_matches",
    "similarity_matches_documents",
]


def best_of(action: Callable[[], object], runs: int) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def sql_times(names: list[str], folder: str, runs: int) -> dict[str, float]:
    import duckdb

    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    statements = {name: all_queries()[name].sql for name in names}
    return {
        name: best_of(lambda sql=sql: connection.execute(sql).to_arrow_table(), runs)
        for name, sql in statements.items()
        if sql
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run = all_queries()[name].run
        times[name] = best_of(lambda: run(spark, folder).write.format("noop").mode("overwrite").save(), runs)
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_SQL") == "1":
        report["sql_queries"] = sql_times(names, folder, runs)
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
