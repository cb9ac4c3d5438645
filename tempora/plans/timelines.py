"""Time-line queries over the local test tables: as-of joins of event tables,
alignment of every series without a list of them, and frames by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators.ordered import asof_join
from tempora.operators.sliding import time_frame_moments
from tempora.plans.series_catalogue import REFERENCE_CODE
from tempora.plans.study import round_doubles, silver
from tempora.sources.fixtures import read_table

#: the orders' days laid over the events' month: minutes for each day since the first
ORDER_START, EVENT_START, MINUTES = "1995-01-01", "2024-01-01 00:00:00", 18


def client(id_column: str) -> Column:
    """Who an event or order belongs to: unknown for some, one client for a third of all."""
    n = F.col(id_column) % 150
    return F.when(n % 11 == 0, None).when(n % 3 == 0, F.lit(0).cast("long")).otherwise(n)


def asof_events_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its client's last order at or before it, within three days."""
    events = read_table(spark, sf_dir, "events").select("event_id", client("user_id").alias("cliente"), "ts")
    days = F.datediff(F.to_date("o_orderdate"), F.lit(ORDER_START).cast("date"))
    orders = read_table(spark, sf_dir, "orders").select(
        client("o_custkey").alias("cliente"), F.timestamp_add("MINUTE", days * MINUTES, F.lit(EVENT_START).cast("timestamp_ntz")).alias("pedido_em"),
        "o_orderkey", "o_totalprice")
    return asof_join(events, orders, ["cliente"], "ts", "pedido_em",
                     {"o_orderkey": "o_orderkey", "pedido_em": "pedido_em", "o_totalprice": "o_totalprice"},
                     tolerance=F.expr("INTERVAL 3 DAYS"), ties=["o_orderkey"])


def align_every_series(silver_df: DataFrame, reference: str = REFERENCE_CODE, key: str = "indicador",
                       tolerance: Column | None = None) -> DataFrame:
    """C7 in long form for any number of series: for every day of the
    reference series and every other series, the last value published on or
    before that day and its date (NULL before the first). The series are found
    in the data; the result has days x series rows, which is its size."""
    days = silver_df.filter(F.col(key) == reference).select("data")
    others = silver_df.filter(F.col(key) != reference)
    # one value per series: the list is as long as the dimension, and every day gets all of it
    listed = others.agg(F.array_sort(F.collect_set(key)).alias("c")).scalar()
    wanted = days.withColumn(key, F.explode(listed))
    return asof_join(wanted, others, [key], "data", "data", {"data": "data_obs", "valor": "valor"}, tolerance=tolerance)


def align_all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_every_series(silver(spark, sf_dir)[0])


def user_time_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sum, mean and deviation of every user's values over the two days up to each time."""
    ev = read_table(spark, sf_dir, "events")
    return round_doubles(time_frame_moments(ev, ["user_id"], "ts", "value", "2 DAYS", 2))


QUERIES = {
    "asof_events_orders": asof_events_orders,
    "align_all_series": align_all_series,
    "user_time_frames": user_time_frames,
}
