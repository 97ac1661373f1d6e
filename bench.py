"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The inputs (bronze documents, users, requests) are packed once, before the clock
starts; every query then runs to a sink that takes all rows and keeps none. The
best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from aerolake.operators import changes, contracts, lookups, numbering, reshape, silver, stats  # noqa: E402
from aerolake.plans import bindings as b  # noqa: E402
from aerolake.plans import q_users  # noqa: E402
from aerolake.session import build_session  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    work = tempfile.mkdtemp(prefix="run-bench-")

    def staged(name, df):
        df.repartition(int(cpus)).write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    readings = b.readings(spark, sf)
    weather = staged("weather", b.weather_bronze(readings))
    weather_raw = staged("weather_raw", b.weather_responses(readings))
    air = staged("air", b.air_bronze(b.measures(spark, sf)))
    air_raw = staged("air_raw", b.air_responses(b.measures(spark, sf)))
    users = staged("users", b.users(spark, sf))
    updates = staged("updates", b.requests(spark, sf))
    inserts = staged("inserts", b.insert_requests(spark, sf))
    mixed = staged("mixed", q_users.mixed_requests(spark, sf))
    events = b.table(spark, sf, "events")
    now, keys = b.now(), b.MEASURE_KEYS

    def checked_air():
        rows = silver.silver_air_quality(air, keys, mode="checked")
        return silver.split_checked(rows, keys)[0]

    def hot_places():
        rows = weather_raw.withColumn(
            "nome", F.when(F.col("ordinal") % 3 == 0, "hot").otherwise(F.col("nome")))
        return reshape.latest_per_place(rows, "nome", "ordinal")

    queries = {
        "silver_weather": lambda: silver.silver_weather(weather, ("id",)),
        "silver_air_quality": lambda: silver.silver_air_quality(air, keys),
        "silver_air_quality_checked": checked_air,
        "weather_flatten": lambda: reshape.weather_flatten(weather_raw),
        "air_quality_reshape": lambda: reshape.air_quality_reshape(air_raw),
        "latest_per_place": hot_places,
        "surrogate_id": lambda: numbering.surrogate_id(events, ("event_id",)),
        "user_stats": lambda: stats.user_stats(users),
        "lookup_by_email": lambda: lookups.lookup_by_email(users, updates),
        "page_rows": lambda: lookups.page_rows(users, "email", 4000, 100),
        "insert_if_absent": lambda: changes.insert_if_absent(users, inserts, now)[0],
        "partial_update": lambda: changes.partial_update(users, updates, now)[0],
        "delete_by_email": lambda: changes.delete_by_email(users, updates)[0],
        "apply_changes": lambda: changes.apply_changes(users, mixed, now)[0],
        "check_unique": lambda: contracts.check_unique(updates, "email", "ordinal"),
        "validate_contract": lambda: contracts.check_contract(users, "user_create"),
    }
    only = sys.argv[1:]
    times = {}
    for name, build in queries.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(2):
            start = time.time()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
