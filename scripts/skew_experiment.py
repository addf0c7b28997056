"""Skew experiment: the flagship with one city holding a third of all rows.

Derives ~10M hourly rows from the events table (100 time-shifted copies; every
third user re-keyed onto city 0), then runs the daily aggregate with the plain
per-city window and with the hot-key split, and compares the results.

usage: python scripts/skew_experiment.py OUT_DIR [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from airshed.operators.daily import AQ_SPEC, daily_aggregate  # noqa: E402
from airshed.plans import catalog as C  # noqa: E402
from airshed.session import build_session  # noqa: E402


def main() -> None:
    out = sys.argv[1].rstrip("/")
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=64, extra={"spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = C.table(spark, sf_dir, "events")
    copies = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("c"))
    big = copies.select(
        (F.col("ts") + F.make_dt_interval(F.col("c") * 31)).alias("ts"),
        F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") + F.col("c") * 1000).alias("user_id"),
        "event_type",
        "value",
    )
    big.write.mode("overwrite").parquet(f"{out}/hourly")
    src = spark.read.parquet(f"{out}/hourly")
    print("rows", src.count(), "hot city rows", src.filter("user_id = 0").count(), flush=True)
    hourly = C.events_as_hourly(src)
    for label, bucket_rows in (("plain", None), ("split", 1 << 20)):
        t = time.time()
        daily_aggregate(hourly, AQ_SPEC, bucket_rows=bucket_rows).write.mode("overwrite").parquet(f"{out}/{label}")
        print(label, "sec", round(time.time() - t, 1), flush=True)
    a, b = spark.read.parquet(f"{out}/plain"), spark.read.parquet(f"{out}/split")
    r9 = lambda df: df.select("city_id", "date", *[F.round(c, 9).alias(c) for c in df.columns[2:]])
    print("daily rows", a.count(), b.count(), "differing rows (9 places)", r9(a).exceptAll(r9(b)).count())


if __name__ == "__main__":
    main()
