"""Jobs for spark-submit: ``spark-submit tidemart/jobs.py <job> <warehouse> [options]``.

``ods``, ``dwd``, ``dws``, ``ads`` and ``sketches`` store one layer each from the one before, so a
scheduler can run them as separate tasks; ``layers`` runs the first four. ``uv`` counts the users of
the days from ``--from`` to ``--to`` from the sketches.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from tidemart.operators import checks, sketches  # noqa: E402
from tidemart.plans import warehouse as plan  # noqa: E402
from tidemart.session import build_session, stream_session  # noqa: E402
from tidemart.streaming import sinks, sources, windows  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument(
        "job", choices=["ods", "dwd", "dws", "ads", "sketches", "layers", "increment", "backfill", "report", "verify", "sql", "uv", "pv-uv",
                        "pv-event-time", "pv-arrival"]
    )
    parser.add_argument("warehouse", help="folder of the layer tables, dim_user and dim_item")
    parser.add_argument("--events", help="Parquet folder of raw events, or folder of JSON lines for pv-uv")
    parser.add_argument("--from", dest="first", type=dt.date.fromisoformat)
    parser.add_argument("--to", dest="last", type=dt.date.fromisoformat)
    parser.add_argument("--query", help="SQL over the stored tables, for the job sql")
    parser.add_argument("--out", help="folder for the answer, as Parquet; without it, rows are printed")
    parser.add_argument("--limit", type=int, default=100, help="most rows to print; a line says so if there are more")
    parser.add_argument("--trigger", help="processing-time trigger of a streaming job, such as '10 seconds', to keep it running; "
                        "without it the job takes what is there and ends")
    parser.add_argument("--files-per-trigger", type=int, help="bound of a micro-batch; files must then arrive in order of event time")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run one job; jobs that answer a question return the answer."""
    out = args.warehouse.rstrip("/")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")

    def dims() -> tuple[DataFrame, DataFrame]:
        return table("dim_user"), table("dim_item")

    match args.job:
        case "ods":
            plan.store(spark, plan.build_ods(spark.read.parquet(args.events)), out, "ods_events")
        case "dwd":
            plan.store(spark, plan.build_dwd(table("ods_events"), *dims()), out, "dwd_user_action")
        case "dws":
            plan.store(spark, plan.build_dws(table("dwd_user_action")), out, "dws_user_daily")
        case "ads":
            plan.store(spark, plan.build_ads(table("dwd_user_action")), out, "ads_funnel_daily")
        case "sketches":
            plan.store(spark, plan.build_uv_sketches(table("dwd_user_action")), out, "dws_uv_sketches")
        case "uv":
            return sketches.users_between(table("dws_uv_sketches"), args.first, args.last, ["country", "action_type"])
        case "layers":
            return checks.row_counts(plan.run_layers(spark, spark.read.parquet(args.events), *dims(), out))
        case "increment":
            plan.increment(spark, spark.read.parquet(args.events), *dims(), out)
        case "backfill":
            plan.backfill(spark, *dims(), out, args.first, args.last)
        case "report":
            return plan.funnel_report(table("ads_funnel_daily"))
        case "verify":
            return checks.require_rows(table("ads_funnel_daily"), "ads_funnel_daily")
        case "sql":
            for name in ("ods_events", "dwd_user_action", "dws_user_daily", "ads_funnel_daily", "dim_user", "dim_item"):
                table(name).createOrReplaceTempView(name)
            return spark.sql(args.query)
        case "pv-uv" | "pv-event-time" | "pv-arrival":
            stream_job(spark, args, out).awaitTermination()
    return None


def stream_job(spark: SparkSession, args: argparse.Namespace, out: str) -> StreamingQuery:
    """Start a windowed count per minute and country over JSON lines: ``pv-uv`` with users, and
    the two that differ in their clock, by event time and by arrival in the running stream."""
    session = stream_session(spark)
    schema = "event_id string, user_id string, item_id string, action_type string, event_ts long, country string, device string, amount double"
    events = sources.with_event_time(
        sources.json_stream(session, args.events, session.createDataFrame([], schema).schema, args.files_per_trigger))
    match args.job:
        case "pv-uv":
            name, counts = "rt_pv_1min", windows.pv_uv(events, "ts", "1 minute", ["country"], "user_id", "5 seconds")
        case "pv-event-time":
            name, counts = "pv_event_time", windows.pv(events, "ts", "1 minute", ["country"], "30 seconds")
        case _:
            name, counts = "pv_arrival", windows.pv(sources.stamp_arrival(events), "arrival_ts", "1 minute", ["country"], "0 seconds")
    return sinks.to_table(
        counts.withColumn("dt", F.to_date("window_start")), f"{out}/{name}", f"{out}/_checkpoints/{name}", ["dt"],
        {"processingTime": args.trigger} if args.trigger else None, name,
    )


def deliver(answer: DataFrame, args: argparse.Namespace) -> None:
    """Write an answer to ``--out``, or print up to ``--limit`` rows and say when there are more."""
    if args.out:
        answer.write.mode("overwrite").parquet(args.out)
        return
    rows = answer.limit(args.limit + 1)
    rows.limit(args.limit).show(args.limit, truncate=False)
    if rows.count() > args.limit:
        print(f"more than {args.limit} rows: give --out or a higher --limit")


if __name__ == "__main__":
    arguments_ = arguments()
    answer_ = run(build_session("tidemart"), arguments_)
    if answer_ is not None:
        deliver(answer_, arguments_)
