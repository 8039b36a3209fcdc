"""Show how the LAG operator spreads a hot key.

Usage: python tools/skew_demo.py [sf_dir] [rows_per_slice]

Re-keys a third of the events to one station, builds silver twice (plain
window vs. hot-key slicing) and reports, per plan, the largest number of rows
one window group holds, plus whether both results are identical.  The skewed
input is for this demonstration only; it is not a registered query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from snapflow.config import PipelineConfig  # noqa: E402
from snapflow.operators.lag import hot_keys, sliced  # noqa: E402
from snapflow.plans.feeds import events_as_bronze  # noqa: E402
from snapflow.plans.silver import build_silver, clean  # noqa: E402
from snapflow.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rows_per_slice = int(sys.argv[2]) if len(sys.argv) > 2 else 2000
    spark = build_session("local[8]", shuffle_partitions=8)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # every third event goes to user 0: that station holds a third of all rows
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    bronze = events_as_bronze(skewed)
    cleaned = clean(bronze)
    total = cleaned.count()
    hot = cleaned.groupBy("station_code").count().orderBy(F.desc("count")).first()

    t0 = time.perf_counter()
    plain = build_silver(bronze)
    plain_rows = sorted(map(tuple, plain.collect()), key=repr)
    t1 = time.perf_counter()
    sliced = build_silver(bronze, PipelineConfig(root="", rows_per_slice=rows_per_slice))
    sliced_rows = sorted(map(tuple, sliced.collect()), key=repr)
    t2 = time.perf_counter()

    hk = hot_keys(cleaned, ["station_code"], rows_per_slice).collect()
    hot_rows = cleaned.where(F.col("station_code") == hot["station_code"])
    parts = sliced(hot_rows, ["station_code"], ["last_reported", "ingested_at"], hot["count"], rows_per_slice)
    per_slice = [r["count"] for r in parts.groupBy("__s").count().collect()]
    largest_sliced, n_slices = max(per_slice), len(per_slice)
    print(f"rows={total} hot_station={hot['station_code']} hot_rows={hot['count']} ({hot['count'] / total:.0%})")
    print(f"plain window : largest group = {hot['count']} rows in one task, {t1 - t0:.1f}s")
    print(
        f"sliced (rows_per_slice={rows_per_slice}): {len(hk)} hot key(s), {n_slices} slices, "
        f"largest group = {largest_sliced} rows, {t2 - t1:.1f}s"
    )
    print(f"identical results: {plain_rows == sliced_rows}")
    spark.stop()


if __name__ == "__main__":
    main()
