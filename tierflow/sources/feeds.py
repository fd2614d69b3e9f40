"""The star-schema test tables seen as order and click events.

``order_lines``  one order event per line item: natural duplicate keys, null status
``purchases``    one order event per purchase event: a time series
``clicks``       every other event as a click: many clicks per session
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.contracts import Feed
from tierflow.functions.records import with_bronze_columns
from tierflow.functions.times import iso_of_utc_wall
from tierflow.session import require_utc
from tierflow.sources import files

NO_IP = "0.0.0.0"
# Ingest time of repeatable runs.
AS_OF = "2024-02-01 00:00:00"
# At most about so many rows of a table that is dealt out anew go to one task.
TASK_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str, as_it_lies: bool = False) -> DataFrame:
    """A given table, its rows dealt out anew where few tasks would read most of them."""
    require_utc(spark)
    path = f"{sf_dir}/{name}.parquet"
    rows = spark.read.parquet(path)
    small = files.size_in_bytes(spark, path) <= _open_cost(spark)
    return rows if as_it_lies or small else spread(rows)


def _open_cost(spark: SparkSession) -> int:
    """No split of a scan is made smaller than this."""
    return spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()


def spread(rows: DataFrame) -> DataFrame:
    """Rows of stored files, dealt out by their place if a task would read over twice its share.

    Spark splits files by bytes but reads a row group in one task, so a large file of few row
    groups keeps one task busy and the others idle, with all that is done up to the next
    shuffle. Only footers are read to count the rows of each split. Filters and column choices
    still reach the reader.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    split = rows.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    read = split.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    if not read["all"] or read["most"] * tasks <= 2 * read["all"]:
        return rows
    place = rows.metadataColumn("_metadata")["row_index"]
    return rows.repartition(max(tasks, -(-read["all"] // TASK_ROWS)), place)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def order_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("l_returnflag") == "A", "delivered")
        .when(F.col("l_returnflag") == "R", "cancelled")
        .alias("status"),
        F.lit(NO_IP).alias("ip"),
        iso_of_utc_wall(F.col("l_shipdate")).alias("timestamp"),
    )


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("k"), _k(F.col("props"))).alias("product"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("paid").alias("status"),
        F.lit(NO_IP).alias("ip"),
        iso_of_utc_wall(F.col("ts")).alias("timestamp"),
    )


def clicks(events: DataFrame) -> DataFrame:
    rest = F.col("user_id") % 3
    return events.filter(F.col("event_type") != "purchase").select(
        F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("/p/"), _k(F.col("props"))).alias("page"),
        F.col("event_type").alias("action"),
        F.when(rest == 0, "desktop").when(rest == 1, "mobile").otherwise("tablet").alias("device"),
        F.lit(NO_IP).alias("ip"),
        iso_of_utc_wall(F.col("ts")).alias("timestamp"),
    )


def landed(events: DataFrame, feed: Feed) -> DataFrame:
    """Events with the columns that landing them as records would have added."""
    keyed = events.withColumn("kafka_key", F.col(feed.key))
    return with_bronze_columns(keyed, F.lit(feed.topic), as_of()).select(*feed.bronze.fieldNames())
