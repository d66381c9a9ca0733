"""Time some operators on a larger log.

Prints one JSON line with the median seconds of each form at ``BENCH_SF_DIR``.
The activity log is written as Parquet once, ``BENCH_COPIES`` times (default 10,
each copy with users of its own), so that the work outweighs planning.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions import device_name, epoch_millis_text, state_code  # noqa: E402
from tidemark.operators import activity  # noqa: E402
from tidemark.plans.churn import user_features  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import driver_tables as views  # noqa: E402
from tidemark.sources import stored  # noqa: E402


def native_texts(log: DataFrame) -> DataFrame:
    return log.select(epoch_millis_text("ts"), state_code("location"), device_name("userAgent"))


FORMS = {
    "user_features: three aggregations": lambda log: user_features(log, views.PAGES),
    "three texts: native": native_texts,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    spark = build_session(
        app="bench-forms",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    log = activity.clean_log(views.activity_log(spark, sf_dir))
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    log = log.withColumn("copy", copy).withColumn("userId", F.concat_ws("_", "userId", "copy"))
    log = stored(log.drop("copy").repartition(2 * cpus), "bench-log")
    seconds = {}
    for name, form in FORMS.items():
        taken = []
        for _ in range(4):
            start = time.perf_counter()
            form(log).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 2)
    rows = log.count()
    spark.stop()
    print(json.dumps({"rows": rows, "cpus": cpus, "seconds": seconds}))


if __name__ == "__main__":
    main()
