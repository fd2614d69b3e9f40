"""Running figures, the newest part of the log, and counts from footers."""

import random
import shutil
import uuid

import pytest

from tests.helpers import bronze_clicks, bronze_orders, click, order, plan
from tierflow.contracts import CLICKS, ORDERS, SUMMARY
from tierflow.operators import live
from tierflow.plans import figures, silver, stats
from tierflow.plans.lake import Lake
from tierflow.sources import bronze
from tierflow.streaming import ingest

RUN = "r"


def made(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        second = draw.randrange(200)
        time = f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.{draw.randrange(10)}00000+00:00"
        rows.append(
            (
                draw.choice(["batch"] * 9 + ["hello"]), i, draw.choice(["raw.orders", "raw.clicks", "else", None, ""]),
                draw.choice([None, 0, 3, 50]), draw.choice([time] * 9 + ["nonsense"]), [],
            )
        )
    return rows


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("seed", "n"), [(1, 0), (2, 1), (3, 80)])
def test_added_parts_give_what_the_whole_log_gives(spark, seed, n):
    log = made(seed, n)
    whole = spark.createDataFrame(log, SUMMARY)
    kept = None
    for k in range(0, max(n, 1), 25):
        new = live.figures_of(spark.createDataFrame(log[k : k + 25], SUMMARY))
        kept = live.added_figures(new if kept is None else kept.unionByName(new))
        kept = spark.createDataFrame(kept.collect(), live.FIGURES)
    assert rows(live.totals_from(kept)) == rows(live.topic_totals(whole))
    assert rows(live.stats_from(kept)) == rows(live.stream_stats(whole))
    assert rows(live.header_from(kept)) == rows(live.header(whole))
    assert live.throughput_from(kept).collect() == live.throughput_per_second(whole).collect()
    assert kept.where("part = 'second'").count() <= 62


def land(spark, lake, feed, batch_id, records, minute=None):
    minute = batch_id if minute is None else minute
    row = ("batch", batch_id, feed.topic, records, f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000000+00:00", [])
    df = spark.createDataFrame([row], SUMMARY)
    bronze.land_batch(df.drop("batch_id").coalesce(1), lake.summaries(feed), RUN, batch_id)


def test_work_grows_with_new_summaries_only(spark, root):
    lake = Lake.under(root)
    empty = live.header_from(figures.running_figures(spark, lake)).first()
    assert (empty["total_events"], empty["records_per_second"]) == (0, 0)
    for n in range(4):
        land(spark, lake, ORDERS, n, 10)
    land(spark, lake, CLICKS, 0, 7)
    assert figures.refresh_figures(spark, lake).status == "ok"
    assert figures.refresh_figures(spark, lake).status == "skipped"
    for n in range(4):  # what the kept figures hold is not opened again
        shutil.rmtree(f"{lake.summaries(ORDERS)}/live/run={RUN}/batch_id={n}")
    land(spark, lake, ORDERS, 3, 10)  # a replay of a batch that counted
    land(spark, lake, ORDERS, 4, 5)
    for _ in range(2):
        got = live.header_from(figures.running_figures(spark, lake)).first()
        assert (got["total_events"], got["orders"], got["clicks"], got["records_per_second"]) == (52, 45, 7, 5)
        figures.refresh_figures(spark, lake)
    assert len(bronze.extents(spark, lake.summaries(ORDERS), {RUN: 4})) == 0


def test_the_newest_part_is_read_whatever_the_length_of_the_log(spark, root):
    lake = Lake.under(root)
    opened = []
    for upto in (12, 30):
        for n in range(upto - 12 if upto == 12 else 12, upto):
            land(spark, lake, ORDERS, n, n)
            land(spark, lake, CLICKS, n, n)
        newest = ingest.newest_summaries(spark, lake, 5)
        opened.append(len(newest.inputFiles()))
        assert rows(live.live_feed(newest, 5)) == rows(live.live_feed(ingest.read_summaries(spark, lake), 5))
        assert rows(live.replay_buffer(newest, 5)) == rows(live.replay_buffer(ingest.read_summaries(spark, lake), 5))
    assert opened == [10, 10]
    bronze.compact(spark, lake.summaries(ORDERS), RUN, 20, None)
    bronze.drop_packed_batches(spark, lake.summaries(ORDERS), RUN)
    for n in (3, 20):  # live ones are enough; packed ones are needed too
        newest = ingest.newest_summaries(spark, lake, n)
        assert rows(live.live_feed(newest, n)) == rows(live.live_feed(ingest.read_summaries(spark, lake), n))
    assert len(ingest.newest_summaries(spark, lake, 3).inputFiles()) == 6
    assert ingest.newest_summaries(spark, Lake.under(f"{root}/none"), 3).count() == 0


def test_an_unfinished_batch_is_passed_over(spark, root):
    import os

    lake = Lake.under(root)
    for n in range(6):
        land(spark, lake, ORDERS, n, n)
    os.remove(f"{lake.summaries(ORDERS)}/live/run={RUN}/batch_id=5/_SUCCESS")
    got = bronze.newest_extents(spark, lake.summaries(ORDERS), 2)
    assert got == [bronze.Extent(RUN, (), (3, 4))]


@pytest.mark.parametrize("in_parts", [False, True])
def test_layer_counts_come_from_footers_and_notes(spark, root, in_parts):
    lake = Lake.under(root, silver_database=f"d{uuid.uuid4().hex}" if in_parts else None)
    assert [tuple(r) for r in stats.stored_layers(spark, lake).collect()] == [("bronze", 0, 0, 0), ("silver", 0, 0, 0)]
    bronze.land_batch(bronze_orders(spark, [order("a"), order("a"), order("b")]), lake.bronze(ORDERS), RUN, 0)
    bronze.land_batch(bronze_orders(spark, [order("c")]), lake.bronze(ORDERS), RUN, 1)
    bronze.compact(spark, lake.bronze(ORDERS), RUN, 0, ORDERS.bronze_stored)
    bronze.land_batch(bronze_clicks(spark, [click("s")]), lake.bronze(CLICKS), RUN, 0)
    for feed in (ORDERS, CLICKS):
        silver.refresh_silver(spark, lake, feed)
    assert [tuple(r) for r in stats.stored_layers(spark, lake).collect()] == [("bronze", 4, 1, 5), ("silver", 3, 1, 4)]
    found = bronze.extents(spark, lake.bronze(ORDERS))
    with stats.footer_counts(spark):
        text = plan(stats.count_of(spark, bronze.folders(lake.bronze(ORDERS), found)))
    assert "PushedAggregation: [COUNT(*)]" in text
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
