"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from gridweave.plans.queries import QUERIES
from gridweave.session import configure

HEADLINE = (
    "interp3d_v2",
    "interp3d_v2_humidity",
    "interp3d_v2_sigma",
    "interp3d_v1",
    "surface_job",
    "regrid_bilinear",
    "regrid_conservative",
    "vertical_interp",
    "hypsometric_height",
    "resample_6h_mean",
    "climatology",
    "subdaily_quantiles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        # nothing kept from the query before: every time includes making the weights
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        run(name)  # starts the JVM's compiler; not counted
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
