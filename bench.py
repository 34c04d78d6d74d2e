"""Time the headline queries and print one JSON line.

The warehouse is loaded once (timed as ``warehouse_load``); each query then runs
several times to completion and its median counts. The last times are not in the total: the
plain windows beside ``anomaly_features``, ``ntile_rows`` and ``dense_rank_global``, and
the reports from partial aggregates beside those from the fact.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalog import fixture as fx  # noqa: E402
from catalog.queries import all_queries  # noqa: E402
from gaugeworks.operators.quality import run_suite  # noqa: E402
from gaugeworks.plans import analytics  # noqa: E402
from gaugeworks.plans.partials import Partials, refresh_partials  # noqa: E402
from gaugeworks.plans.quality import standard_checks, tables_of  # noqa: E402
from gaugeworks.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(build) -> float:
    started = time.perf_counter()
    frame: DataFrame = build()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS)
    started = time.perf_counter()
    warehouse = fx.warehouse(spark, SF_DIR)
    times = {"warehouse_load": time.perf_counter() - started}

    star = analytics.Star.of(warehouse)
    registered = all_queries()
    headline = {
        "anomaly_features": lambda: analytics.anomaly_features(star),
        "anomaly_feed": lambda: analytics.anomaly_feed(analytics.anomaly_features(star)),
        "root_cause": lambda: analytics.root_cause(star),
        "tier_failures": lambda: analytics.tier_failures(star),
        "leaderboard": lambda: analytics.leaderboard(star),
        "speed_quintiles": lambda: analytics.speed_quintiles(star),
        "dq_suite": lambda: run_suite(tables_of(warehouse), standard_checks()),
        "star_sample": lambda: analytics.star_sample(star),
        "orphans": lambda: registered["orphans"](spark, SF_DIR),
        "dense_rank_global": lambda: registered["dense_rank_global"](spark, SF_DIR),
        "ntile_rows": lambda: registered["ntile_rows"](spark, SF_DIR),
        "upsert_partial": lambda: registered["upsert_partial"](spark, SF_DIR),
        "fact_reload": lambda: registered["fact_reload"](spark, SF_DIR),
        "staging_features": lambda: registered["staging_features"](spark, SF_DIR),
    }
    tiles = Window.orderBy("rotational_speed_rpm", "udi")
    ranks = Window.orderBy(F.desc("overstrain_metric"))
    forms = {
        "plain_features": lambda: analytics.anomaly_features(star, plain=True),
        "plain_ntile": lambda: star.fact.select("udi", F.ntile(5).over(tiles)),
        "plain_dense_rank": lambda: star.fact.select("udi", F.dense_rank().over(ranks)),
    }
    refresh_partials(warehouse)
    partials = Partials.of(warehouse)
    forms |= {
        "root_cause_partials": partials.root_cause,
        "speed_quintiles_partials": partials.speed_quintiles,
        "leaderboard_partials": partials.leaderboard,
        "counts_partials": partials.counts_row,
    }
    for name, build in {**headline, **forms}.items():
        run(build)
        times[name] = statistics.median(run(build) for _ in range(REPEATS))

    total = sum(times[name] for name in headline)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
                "readings": star.fact.count(),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
