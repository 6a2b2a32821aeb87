"""Times the four reports along their axes: file format, DataFrame or SQL, join strategy, route.

Prints one JSON line. The raw files are written once, before the clock starts; each query
then reads them, runs to its end and is timed as the median of its runs after a warm-up.

BENCH_SF_DIR  tables to use (default /root/testdata/sf0.1)
BENCH_CPUS    threads (default 8)
BENCH_RUNS    timed runs per query (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from incident_analytics.operators import STRATEGIES
from incident_analytics.plans import (
    daypart_counts,
    daypart_counts_sql,
    station_distance,
    top_months,
    top_months_sql,
    victims_by_income,
)
from incident_analytics.plans.station_distance import ROUTES
from incident_analytics.sources import Conversion, convert, read_table, write_csv
from incident_analytics.sources.schemas import stored_columns
from incident_analytics.sources.scratch import scratch_path
from incident_analytics.twins import domain


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("incident-analytics-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        # One machine: its threads share any folder.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="incident-analytics-bench-"))
    return spark


class Files:
    """The benchmark tables as CSV files and as their Parquet conversion."""

    def __init__(self, spark: SparkSession, name: str, *eras: DataFrame):
        self.spark, self.name = spark, name
        raw = domain.columns_in(name, eras[0])
        self.columns = {"csv": raw, "parquet": stored_columns(name, raw)}
        self.paths: dict[str, list[str]] = {"csv": [], "parquet": []}
        for era in eras:
            csv, parquet = scratch_path(spark, "bench-csv"), scratch_path(spark, "bench-parquet")
            write_csv(era, csv)
            convert(spark, [Conversion(csv, parquet, name, columns=tuple(raw))])
            self.paths["csv"].append(csv)
            self.paths["parquet"].append(parquet)

    def read(self, fmt: str) -> DataFrame:
        return read_table(
            self.spark, self.name, *self.paths[fmt], fmt=fmt, columns=self.columns[fmt]
        )


def headline(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    orders = Files(spark, "incidents", *domain.order_eras(spark, sf_dir))
    events = Files(spark, "incidents", domain.event_file(spark, sf_dir))
    lineitems = Files(spark, "incidents", *domain.lineitem_eras(spark, sf_dir))
    revgeo = Files(spark, "revgeo", domain.revgeo_file(spark, sf_dir))
    income = Files(spark, "income", domain.income_file(spark, sf_dir))
    stations = Files(spark, "stations", domain.station_file(spark, sf_dir))

    def victims(fmt: str, side: str, strategy: str) -> DataFrame:
        return victims_by_income(
            orders.read(fmt),
            revgeo.read(fmt),
            income.read(fmt),
            year=1995,
            side=side,
            strategy=strategy,
            labels=domain.LABELS,
        )

    def distance(fmt: str, route: str) -> DataFrame:
        return station_distance(lineitems.read(fmt), stations.read(fmt), route)

    found: dict[str, Callable[[], DataFrame]] = {}
    for fmt in ("csv", "parquet"):
        found[f"q1_{fmt}_dataframe"] = lambda fmt=fmt: top_months(orders.read(fmt))
        found[f"q1_{fmt}_sql"] = lambda fmt=fmt: top_months_sql(spark, orders.read(fmt))
        found[f"q2_{fmt}_dataframe"] = lambda fmt=fmt: daypart_counts(events.read(fmt), "click")
        found[f"q2_{fmt}_sql"] = lambda fmt=fmt: daypart_counts_sql(
            spark, events.read(fmt), "click"
        )
    for side in ("top", "bottom"):
        found[f"q3_csv_{side}_auto"] = partial(victims, "csv", side, "auto")
        for strategy in STRATEGIES:
            found[f"q3_parquet_{side}_{strategy}"] = partial(victims, "parquet", side, strategy)
    for route in ROUTES:
        found[f"q4_csv_{route}"] = partial(distance, "csv", route)
        found[f"q4_parquet_{route}"] = partial(distance, "parquet", route)
    return found


def seconds(query: Callable[[], DataFrame], runs: int) -> float:
    """Median time to build the query and write all of its rows to nowhere."""
    taken = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return statistics.median(taken[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    times = {name: round(seconds(q, runs), 4) for name, q in headline(spark, sf_dir).items()}
    spark.stop()
    result = {
        "metric": "total_report_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
