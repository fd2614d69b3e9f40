"""Reading and writing keyed topics.

The connector is a parameter: ``kafka`` where its package is on the class path,
or a folder of Parquet files with the same columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierflow.contracts import ENVELOPE

# Where a stream starts the first time, and that lost offsets do not stop it.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_settings(topic: str, options: Mapping[str, str], from_start: bool = False) -> dict[str, str]:
    """The connector's options; a catch-up run starts at the earliest offset."""
    start = {"startingOffsets": "earliest"} if from_start else {}
    return {**KAFKA_DEFAULTS, **start, "subscribe": topic, **options}


def topic_stream(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    from_start: bool = False,
) -> DataFrame:
    """The topic as a stream of keyed records.

    The first start is at the latest offset, or at the earliest with ``from_start``; ``options``
    go before both. Later starts resume from the checkpoint whatever the start options say. For a
    file format ``options["path"]`` is the folder of the topic.
    """
    options = dict(options or {})
    if fmt == "kafka":
        settings = kafka_settings(topic, options, from_start)
        return spark.readStream.format(fmt).options(**settings).load()
    path = options.pop("path")
    return spark.readStream.format(fmt).schema(ENVELOPE).options(**options).load(path)


def publish(
    records: DataFrame,
    topic: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> None:
    """Appends keyed records to the topic."""
    options = dict(options or {})
    if fmt == "kafka":
        writer = records.select("key", "value").write.format(fmt)
        writer.options(topic=topic, **options).save()
        return
    path = options.pop("path")
    records.write.format(fmt).mode("append").options(**options).save(path)
