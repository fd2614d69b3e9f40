"""The jobs for ``spark-submit``: landing, refreshes, and the figures read from the layers."""

from __future__ import annotations

import argparse
import os

from tierflow.contracts import FEEDS
from tierflow.operators import live
from tierflow.operators.marts import MARTS
from tierflow.plans.cycle import run_cycle
from tierflow.plans.figures import refresh_figures, running_figures
from tierflow.plans.gold import gold_catalog, load_marts, refresh_mart
from tierflow.plans.lake import Lake
from tierflow.plans.silver import rebuild_silver, refresh_silver
from tierflow.plans.stats import stored_layers
from tierflow.plans.upkeep import Packing, pack
from tierflow.session import build_session, require_utc
from tierflow.streaming.ingest import TRIGGER_SECONDS, newest_summaries, run_streams


def main() -> None:
    parser = argparse.ArgumentParser(prog="tierflow", description=__doc__)
    jobs = ["ingest", "silver", "rebuild", "gold", "cycle", "pack", "layers", "marts", "live"]
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--available-now", action="store_true", help="ingest: catch up, then end")
    parser.add_argument(
        "--mode", choices=["newest", "replace"], default="newest", help="silver, cycle: what a merge keeps"
    )
    parser.add_argument("--from", dest="start", choices=["earliest", "latest"], help="ingest: first start")
    parser.add_argument(
        "--fail-on-data-loss", action="store_true", help="ingest: stop where offsets were lost"
    )
    args = parser.parse_args()

    lake = Lake.from_env()
    spark = build_session(f"tierflow-{args.job}")
    require_utc(spark)
    if args.job == "ingest":
        broker = {
            "kafka.bootstrap.servers": os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092")
        }
        if args.start:
            broker["startingOffsets"] = args.start
        if args.fail_on_data_loss:
            broker["failOnDataLoss"] = "true"
        run_streams(
            spark,
            lake,
            options={f.name: broker for f in FEEDS},
            available_now=args.available_now,
            trigger_seconds=int(os.environ.get("STREAM_TRIGGER_SECONDS", TRIGGER_SECONDS)),
        )
    elif args.job == "silver":
        for feed in FEEDS:
            print(feed.name, refresh_silver(spark, lake, feed, args.mode))
    elif args.job == "rebuild":
        for feed in FEEDS:
            print(feed.name, rebuild_silver(spark, lake, feed))
    elif args.job == "gold":
        for feed in FEEDS:
            for mart in MARTS[feed.name]:
                print(mart, refresh_mart(spark, lake, feed, mart))
    elif args.job == "cycle":
        run_cycle(spark, lake, mode=args.mode, packing=Packing()).show(truncate=False)
    elif args.job == "pack":
        for feed in FEEDS:
            print(feed.name, pack(spark, lake, feed))
    elif args.job == "layers":
        stored_layers(spark, lake).show()
        gold_catalog(spark, lake).show(truncate=False)
    elif args.job == "marts":
        for feed in FEEDS:
            for mart, df in load_marts(spark, lake, feed).items():
                print(mart)
                df.show(truncate=False)
    else:
        refresh_figures(spark, lake)
        live.header_from(running_figures(spark, lake)).show()
        live.live_feed(newest_summaries(spark, lake, live.FEED_ROWS)).show(truncate=60)
    spark.stop()


if __name__ == "__main__":
    main()
