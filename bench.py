"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8).

``queries`` holds the better of two runs, each writing its whole result to
Spark's no-op sink. Names without a prefix read the given tables and
derive the transit tables on the way. ``build_*`` time the daily batch into
stored Parquet tables (once), ``stored_*`` the marts and reports on top of
these tables, which is how they are used.
"""

from __future__ import annotations

import json
import os
import time

from headway import catalogue
from headway.operators import marts
from headway.plans import build, reports
from headway.session import local_session, work_path
from headway.sources import samples, tables

HEADLINE = (
    "stops_ranked trips_per_route peak_hours service_hours service_frequency transfer_hubs"
    " weekday_vs_weekend longest_routes early_night_routes trip_trajectories network_kpis"
    " hourly_by_type frequency_heatmap underserved_counts zone_coverage"
    " rail_mean_fares light_rail_points schedule_flatten eta_flatten"
    " stream_kpis events_per_line events_per_minute top_destinations"
    " stream_ingest_counts live_per_minute"
).split()
RUNS = 2


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_queries(spark, root):
    """Marts over the stored staging tables and rollups; reports over the
    stored marts."""
    net = build.stored_network(spark, root)

    def mart(name):
        return tables.load(spark, root, name)

    ranked, hours = mart("mart_stops_ranked"), mart("mart_route_service_hours")
    named = {f"stored_{name}": lambda f=f: f(net) for name, f in marts.MARTS.items()}
    return named | {
        "stored_network_kpis": lambda: reports.network_kpis(
            spark, ranked, mart("mart_trips_per_route"), mart("mart_peak_hour_analysis"), net.routes
        ),
        "stored_service_hours_top": lambda: reports.service_hours(hours),
        "stored_frequency_heatmap": lambda: reports.frequency_heatmap(
            reports.hourly_frequency(mart("mart_service_frequency"), hours)
        ),
        "stored_underserved_stops": lambda: reports.underserved_stops(ranked),
        "stored_hourly_by_type": lambda: reports.departures_by_hour_of_mode(net, catalogue.BUS),
        "stored_zone_coverage": lambda: reports.zone_coverage(ranked),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cores=cpus, memory=os.environ.get("BENCH_MEMORY", "12g"),
        **{"spark.sql.shuffle.partitions": cpus},
    )
    seconds: dict[str, float] = {}

    raw, root = samples.raw_feed(spark, sf_dir), work_path(spark, "bench")
    seconds["build_staging"] = timed(lambda: build.build_staging(spark, raw, root))
    seconds["build_rollups"] = timed(lambda: build.build_rollups(spark, root))
    seconds["build_marts"] = timed(lambda: build.build_marts(spark, root))

    runs = {name: lambda n=name: catalogue.QUERIES[n](spark, sf_dir) for name in HEADLINE}
    for name, query in (runs | stored_queries(spark, root)).items():
        seconds[name] = min(timed(lambda: drain(query())) for _ in range(RUNS))

    rounded = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
