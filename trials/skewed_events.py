"""Time the event operators on made-up, heavily skewed events (no registered query reads these).

    python trials/skewed_events.py [million events, default 20]

One user, one session and one transaction id hold a third of all rows. The events are written to
a folder of their own first, so that the figures include a scan.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def events(spark, rows: int):
    from pyspark.sql import functions as F

    i, h = F.col("id"), F.pmod(F.xxhash64("id"), F.lit(10**9))
    hot = h % 3 == 0
    return spark.range(rows).select(
        F.date_add(F.lit(date(2024, 1, 1)), (h % 28).cast("int")).alias("event_date"),
        (F.lit(1_704_067_200_000_000) + h * 2400 + i % 2400).alias("event_timestamp"),
        F.element_at(F.array(*map(F.lit, ("view_item", "add_to_cart", "purchase", "page_view"))), (h % 4 + 1).cast("int")).alias("event_name"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("u"), h % (rows // 8))).alias("user_pseudo_id"),
        F.when(hot, 1).otherwise(h % 3 + 2).cast("bigint").alias("ga_session_id"),
        F.when(h % 5 == 0, "google").alias("source"),
        F.when(h % 5 == 0, F.when(h % 10 == 0, "cpc").otherwise("organic")).alias("medium"),
        F.when(hot, "placeholder").otherwise(F.concat(F.lit("t"), h % (rows // 3))).alias("transaction_id"),
        F.when(h % 13 != 0, (h % 1700) / 100.0).alias("purchase_revenue"),
    )


def main() -> None:
    from pyspark.sql import SparkSession

    from tidemark.operators import sessions

    rows = int(float(sys.argv[1] if len(sys.argv) > 1 else 20) * 1e6)
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    with tempfile.TemporaryDirectory(prefix="trial-") as folder:
        events(spark, rows).write.parquet(f"{folder}/events")
        log = spark.read.parquet(f"{folder}/events")
        for operator in (sessions.sessionize, sessions.first_touch, sessions.purchase_firings, sessions.purchases_by_session, sessions.daily_rollup):
            start = time.perf_counter()
            operator(log).write.format("noop").mode("overwrite").save()
            print(f"{operator.__name__:24s} {time.perf_counter() - start:6.1f} s", flush=True)


if __name__ == "__main__":
    main()
