"""Gold aggregates, rebuilt in full after every merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_daily(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date", "status").agg(F.count(F.lit(1)).alias("order_count"))


def payments_daily(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_date", "status").agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum("amount").alias("payment_total")
    )


def transactions_summary(active: DataFrame) -> DataFrame:
    return active.agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount"))
