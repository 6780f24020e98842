"""Gold marts over current-state tables.

``top_users``: the "top user" mart the gold spec declares (customer, order and order-line current
tables as inputs).  The reference leaves its body empty; our definition is revenue and distinct
order count per customer, top N by revenue.

Plan shape (built so that no join sees a skewed key):
  order lines --partial agg--> one row per order  (a hot order key is combined map-side)
  ⋈ orders on order key                          (both sides ~one row per order)
  --agg per (customer, order)-->                 (same partitioning as the join: no shuffle)
  --partial agg per customer-->                  (a hot customer is combined map-side)
  ⋈ customers on customer key                    (one row per key on both sides)
  --top N-->                                     (per-partition top N, then a merge of N rows/partition)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_users(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, n: int = 10) -> DataFrame:
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("__rev")))
    orders_rev = (orders.select("o_orderkey", "o_custkey")
                  .join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "inner")
                  .groupBy("o_custkey", "o_orderkey").agg(F.sum("__rev").alias("__rev")))
    per_customer = (orders_rev.groupBy("o_custkey")
                    .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("__rev").alias("__rev")))
    ranked = (customer.select("c_custkey", "c_name")
              .join(per_customer, customer["c_custkey"] == per_customer["o_custkey"], "inner")
              .select("c_custkey", "c_name", "n_orders", F.round(F.col("__rev"), 2).alias("revenue")))
    return ranked.orderBy(F.col("revenue").desc(), F.col("c_custkey")).limit(n)
