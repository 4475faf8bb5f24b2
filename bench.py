"""Headline timings. Prints one JSON line; every query writes all its columns to a sink that
discards them, best of three. Environment: BENCH_SF_DIR, BENCH_CPUS."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from contextlib import contextmanager

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemart.catalog import QUERIES  # noqa: E402
from tidemart.operators import versioned  # noqa: E402
from tidemart.operators.joins import spread_join  # noqa: E402
from tidemart.plans import analytics as ask  # noqa: E402
from tidemart.plans import warehouse as plan  # noqa: E402
from tidemart.session import build_session, stream_session  # noqa: E402
from tidemart.sources import formats, views  # noqa: E402
from tidemart.streaming import sinks, sources, windows  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action, runs: int = RUNS) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def main() -> None:
    work = tempfile.mkdtemp(prefix="tidemart-bench-")
    spark = build_session(
        "tidemart-bench", f"local[{CPUS}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            # Default pages are a sixteenth of a core's memory; zeroing them dwarfs tasks this small.
            "spark.buffer.pageSize": "2m",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": work,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    extra: dict[str, float] = {}

    # Stored layers and dimension tables, as an analyst finds them.
    raw = views.raw_events(spark, SF_DIR)
    folders, built = iter(f"{work}/dw{i}" for i in range(RUNS)), []
    timings["store_all_layers"] = best_of(lambda: built.append(plan.run_layers(
        spark, raw, views.dim_user(spark, SF_DIR), views.dim_item(spark, SF_DIR), next(folders))))
    layers = built[-1]
    dims = []
    for name in ("dim_user", "dim_item"):
        getattr(views, name)(spark, SF_DIR).write.parquet(f"{work}/dw/{name}")
        dims.append(spark.read.parquet(f"{work}/dw/{name}"))
    dwd, dws, ods = (layers[k] for k in ("dwd_user_action", "dws_user_daily", "ods_events"))

    def star(joiner=None):
        return lambda: discard(ask.star_join(dwd, *dims, *([joiner] if joiner else [])))

    adaptive, partitions = "spark__sql__adaptive__enabled", "spark__sql__shuffle__partitions"

    def plain(fact, dim, key, how):
        return fact.join(dim.hint("merge"), key, how)

    with settings(spark, **{adaptive: "false", partitions: "200"}):
        timings["star_shuffle_200_aqe_off"] = best_of(star(plain), 2)
    with settings(spark, **{adaptive: "true", partitions: "200"}):
        timings["star_shuffle_200_aqe_on"] = best_of(star(spread_join))
    with settings(spark, **{adaptive: "false", partitions: "16"}):
        timings["star_shuffle_16_aqe_off"] = best_of(star(plain))
    with settings(spark, **{partitions: "16"}):
        timings["star_shuffle_16_aqe_on"] = best_of(star(spread_join))
        timings["star_broadcast_16_aqe_on"] = best_of(star())

    some_id = ods.selectExpr("max(event_id) AS m").first().m // 2
    timings["point_lookup"] = best_of(lambda: discard(ods.where(F.col("event_id") == some_id)))
    timings["small_aggregation"] = best_of(
        lambda: discard(dws.groupBy("country").agg(F.sum("pay_amount"), F.sum("pay_cnt")))
    )
    timings["funnel_two_step"] = best_of(lambda: discard(plan.build_ads(dwd)))
    timings["funnel_distinct_counts"] = best_of(lambda: discard(plan.build_ads(dwd, two_step=False)))
    timings["user_days"] = best_of(lambda: discard(plan.build_dws(dwd)))

    for name in formats.FORMATS:
        start = time.perf_counter()
        formats.write_as(raw, name, f"{work}/{name}")
        timings[f"write_{name}"] = round(time.perf_counter() - start, 4)
        extra[f"mb_{name}"] = round(sum(
            os.path.getsize(f"{work}/{name}/{f}") for f in os.listdir(f"{work}/{name}") if f.startswith("part-")
        ) / 1e6, 2)
        rows = formats.read_as(spark, name, f"{work}/{name}", raw.schema)
        timings[f"scan_{name}"] = best_of(lambda rows=rows: discard(rows))
        timings[f"sum_{name}"] = best_of(lambda rows=rows: discard(rows.agg(F.sum("amount"))))
        timings[f"filter_{name}"] = best_of(
            lambda rows=rows: discard(rows.where("country = 'NATION_3'").agg(F.count(F.lit(1))))
        )

    for mode, delete in (("merge_on_read", versioned.delete_where), ("copy_on_write", versioned.delete_by_rewrite)):
        history = versioned.begin(raw, f"{work}/{mode}")
        start = time.perf_counter()
        history = delete(history, "country = 'NATION_3'")
        timings[f"delete_{mode}"] = round(time.perf_counter() - start, 4)
        timings[f"read_after_{mode}"] = best_of(lambda history=history: discard(versioned.read_as_of(history)))
        start = time.perf_counter()
        versioned.rollback_to(history, 1)
        timings[f"rollback_{mode}"] = round(time.perf_counter() - start, 4)

    start = time.perf_counter()
    stream = sources.event_stream(stream_session(spark), SF_DIR)
    sinks.drain(windows.pv_uv(stream, "ts", "1 minute", ["country"], "user_id", "5 seconds"), f"{work}/stream")
    timings["stream_pv_uv"] = round(time.perf_counter() - start, 4)
    extra["stream_rows_per_sec"] = round(ods.count() / timings["stream_pv_uv"])

    for name in ("sessionize", "lag_wow_drop", "arpu_by_age_group", "retention_daily", "keyword_topk_retrieval", "late_rows"):
        timings[name] = best_of(lambda name=name: discard(QUERIES[name](spark, SF_DIR)))

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": float(sf.group(1)) if sf else SF_DIR, **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
