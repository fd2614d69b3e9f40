"""One refresh of Silver and Gold (T7); an external scheduler calls it as often as wanted."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tierflow.contracts import FEEDS, Feed
from tierflow.operators.marts import MARTS
from tierflow.plans.gold import refresh_mart
from tierflow.plans.lake import Lake
from tierflow.plans.silver import Outcome, refresh_silver
from tierflow.plans.upkeep import Packing, pack

LOG_SCHEMA = (
    "cycle int, step string, status string, rows bigint, rows_in bigint, dropped_null bigint, "
    "dropped_dup bigint, passed bigint, seconds double, error string"
)


Step = tuple[str, Callable[[], Outcome]]


def _tiers(
    spark: SparkSession, lake: Lake, feeds: Sequence[Feed], mode: str, packing: Packing | None
) -> list[list[Step]]:
    silver = [(f"silver_{f.name}", partial(refresh_silver, spark, lake, f, mode)) for f in feeds]
    gold = [
        (f"gold_{m}", partial(refresh_mart, spark, lake, f, m))
        for f in feeds
        for m in MARTS[f.name]
    ]
    tiers = [silver, gold]
    if packing:
        tiers.append([(f"pack_{f.name}", partial(pack, spark, lake, f, packing)) for f in feeds])
    return tiers


def _report(cycle: int, step: Step) -> tuple:
    name, run = step
    start = time.monotonic()
    try:
        out = run()
    except Exception as exc:  # noqa: BLE001 - one step must not stop the others
        out = Outcome("failed", note=f"{type(exc).__name__}: {exc}")
    account = (out.rows_in, out.dropped_null, out.dropped_dup, out.passed)
    return (cycle, name, out.status, out.rows, *account, time.monotonic() - start, out.note)


def run_cycle(
    spark: SparkSession,
    lake: Lake,
    cycle: int = 1,
    feeds: Sequence[Feed] = FEEDS,
    side_by_side: int = 3,
    mode: str = "newest",
    packing: Packing | None = None,
) -> DataFrame:
    """Runs every step and reports each; a step that fails is reported and the rest go on.

    ``mode`` is that of the Silver merge. With ``packing`` closed batches of Bronze and of the
    summary log are packed at the end, which a lake with streams in service needs.

    Steps of one tier write different tables and are submitted together, so that the
    tail of one job does not leave the cluster idle. Gold starts when Silver is done.
    """
    log = []
    with ThreadPoolExecutor(side_by_side) as pool:
        for tier in _tiers(spark, lake, feeds, mode, packing):
            log += pool.map(partial(_report, cycle), tier)
    return spark.createDataFrame(log, LOG_SCHEMA)
