"""Headline timings as one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Loading steps
run once, in order, each from and to tables; questions over the loaded star run three
times and report the median. Nothing is cached in memory between runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.models.order_lines import LINES, ORDER_LINES, raw_lines
from starloom.operators.clean import clean
from starloom.operators.fact import fact_rows
from starloom.operators.star import Mart, ranking, star_view
from starloom.plans import Layout, build_fact, clean_step, full_load, ingest, open_mart, upsert_dimensions
from starloom.plans.queries import scd1_update
from starloom.sources.delimited import write_shards
from starloom.sources.workspace import new_folder

CITY = ["city_cd", "city_name", "region"]


def run(frame: DataFrame) -> None:
    """Compute every row and column of a frame and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object], times: int = 1) -> float:
    taken = []
    for _ in range(times):
        started = time.perf_counter()
        action()
        taken.append(time.perf_counter() - started)
    return round(statistics.median(taken), 3)


def city_totals_by_row(mart: Mart) -> DataFrame:
    """The city ranking without summing before the join, for comparison."""
    totals = star_view(mart, [*CITY, "qty_active"]).groupBy(*CITY).agg(F.sum("qty_active").alias("total"))
    return totals.orderBy(F.desc_nulls_last("total"), *[F.asc_nulls_last(c) for c in CITY])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starloom bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    layout, shards = Layout(new_folder(spark, "bench"), ORDER_LINES), new_folder(spark, "bench-shards")
    write_shards(raw_lines(spark, folder), LINES, shards)  # preparation, not timed; also starts the JVM up
    seconds = {
        "ingest_shards": timed(lambda: ingest(spark, layout, shards)),
        "clean_table": timed(lambda: clean_step(spark, layout)),
        "dimensions_first": timed(lambda: upsert_dimensions(spark, layout)),
        "dimensions_again": timed(lambda: upsert_dimensions(spark, layout)),
        "fact_table": timed(lambda: build_fact(spark, layout)),
    }
    seconds["pipeline_end_to_end"] = timed(
        lambda: full_load(spark, Layout(new_folder(spark, "bench-full"), ORDER_LINES), shards)
    )

    def question(name: str, frame: Callable[[Mart], DataFrame]) -> None:
        seconds[name] = timed(lambda: run(frame(open_mart(spark, layout))), times=3)

    seconds["clean_typed"] = timed(lambda: run(clean(layout.read_raw(spark), LINES)), times=3)
    question("fact_rows", lambda m: fact_rows(layout.read_clean(spark), ORDER_LINES, m.members))
    question("fact_rows_large_dims", lambda m: fact_rows(layout.read_clean(spark), ORDER_LINES, m.members, limit=0))
    question("star_view", star_view)
    question(
        "top_suppliers", lambda m: ranking(m, ["supp_cd", "supp_name", "supp_class"], "qty_active", limit=5)
    )
    question("top_band", lambda m: ranking(m, ["band"], "qty_active", limit=1))
    question("city_ranking", lambda m: ranking(m, CITY, "qty_active"))
    question("city_ranking_by_row", city_totals_by_row)
    seconds["city_ranking_large_dims"] = timed(
        lambda: run(ranking(open_mart(spark, layout, limit=0), CITY, "qty_active")), times=3
    )
    seconds["scd1_update"] = timed(lambda: run(scd1_update(spark, folder)))

    counted = {k: v for k, v in seconds.items() if k != "pipeline_end_to_end"}
    print(
        json.dumps(
            {
                "metric": "star_load_and_questions_total",
                "value": round(sum(counted.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
