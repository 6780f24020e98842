"""The top-user mart kept up to date by loads of changed orders, with retractions.

Under ``root``, in key buckets (``sinks.state``):

    orders/     what every live order contributes: its customer and revenue
    customers/  orders and revenue of every customer that has any
    begun/<n>, committed/<n>  the newest load that was begun and committed

A load holds changed orders (INSERT, UPDATE, DELETE) and all order lines of those that live on.  What a changed order contributed
before is subtracted and what it contributes now is added, so orders that are replaced, move to another customer or are
deleted come out as in a recompute; revenue is decimal, so sums do not drift.  Only the buckets of the load's orders and of
customers whose sums change are read and written.

Both states become visible with one mark.  A load that was begun must be committed before another one; its repeat
starts from the committed states, and repeating a committed load does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.vocab import LIVE_ACTIONS
from tidemark.operators.sequence import latest_per_key
from tidemark.operators.touched import same_keys
from tidemark.sinks import state

LINE, SUM = "decimal(18,4)", "decimal(38,4)"
ORDER, CUSTOMER = ["o_orderkey"], ["o_custkey"]


def _side(spark: SparkSession, root: str, name: str, keys: list[str], done: int | None, changed: DataFrame, columns: str):
    """The path and committed layout of a state, the buckets of the changed keys, and the rows in them."""
    path = f"{root}/{name}"
    layout = None if done is None else state._layout(spark, path, done)
    if layout is None:
        return path, None, [], spark.createDataFrame([], columns)
    touched = state.touched_buckets(changed, layout)
    return path, layout, touched, state.read_buckets(spark, path, layout, touched)


def commit_orders(spark: SparkSession, root: str, orders: DataFrame, lineitem: DataFrame, load: int, order_by: str | None = None) -> None:
    """Fold one load: ``orders`` (o_orderkey, o_custkey, action), of several rows of an order the last by ``order_by``;
    ``lineitem`` has the lines of the load's live orders (others are ignored).  An order without lines contributes nothing, as
    in ``top_users``."""
    root = root.rstrip("/")
    begun, done = state._mark(spark, root, "begun"), state.committed_batch(spark, root)
    if done is not None and load <= done:
        return
    if begun is not None and begun != load and (done is None or begun > done):
        raise RuntimeError(f"load {begun} was begun but not committed: repeat it before load {load}")
    state._set_mark(spark, root, "begun", load)
    order = [F.col(order_by).desc()] if order_by else [F.col("o_custkey"), F.col("action")]
    changed = latest_per_key(orders.select(*ORDER, *CUSTOMER, "action", *([order_by] if order_by else [])), ORDER, order)
    live = changed.where(F.upper("action").isin(*LIVE_ACTIONS)).select(*ORDER, *CUSTOMER)
    line = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(LINE)
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(line).cast(SUM).alias("revenue"))
    kinds = ", ".join(f"{c} {orders.schema[c].dataType.simpleString()}" for c in (*ORDER, *CUSTOMER))
    # read twice: for the sums and for the state of the orders
    now = state.scratch_copy(spark, live.join(per_order, ORDER).select(*ORDER, *CUSTOMER, "revenue"), "mart-load")
    keys = state.scratch_copy(spark, changed.select(*ORDER), "mart-keys")

    path, layout, touched, known = _side(spark, root, "orders", ORDER, done, keys, f"{kinds}, revenue {SUM}")
    renamed = keys.select(F.col("o_orderkey").alias("__k_o_orderkey"))
    before, stay = (known.join(renamed, same_keys(ORDER, "__k_"), how) for how in ("left_semi", "left_anti"))
    deltas = (now.select(*CUSTOMER, F.lit(1).cast("long").alias("n"), "revenue")
              .unionByName(before.select(*CUSTOMER, F.lit(-1).cast("long").alias("n"), (-F.col("revenue")).cast(SUM).alias("revenue")))
              .groupBy(*CUSTOMER).agg(F.sum("n").alias("n"), F.sum("revenue").cast(SUM).alias("revenue"))
              .where("n <> 0 OR revenue <> 0"))
    deltas = state.scratch_copy(spark, deltas, "mart-deltas")
    state.set_layout(spark, path, state.write_buckets(spark, stay.unionByName(now), path, ORDER, load, layout, touched))

    kind = orders.schema["o_custkey"].dataType.simpleString()
    path, layout, touched, known = _side(spark, root, "customers", CUSTOMER, done, deltas, f"o_custkey {kind}, n long, revenue {SUM}")
    summed = (known.unionByName(deltas).groupBy(*CUSTOMER).agg(F.sum("n").alias("n"), F.sum("revenue").cast(SUM).alias("revenue")).where("n <> 0"))
    state.set_layout(spark, path, state.write_buckets(spark, summed, path, CUSTOMER, load, layout, touched))
    state._set_mark(spark, root, "committed", load)


def read_top_users(spark: SparkSession, root: str, customer: DataFrame, n: int | None = None) -> DataFrame:
    """c_custkey, c_name, n_orders, revenue of the ``n`` customers (None: of all) with the highest revenue."""
    root = root.rstrip("/")
    path, done = f"{root}/customers", state.committed_batch(spark, root)
    if done is None:
        raise ValueError(f"no committed load under {root}")
    sums = state.read_buckets(spark, path, state._layout(spark, path, done))
    found = (customer.select("c_custkey", "c_name").join(sums, F.col("c_custkey") == F.col("o_custkey"))
             .select("c_custkey", "c_name", F.col("n").alias("n_orders"), F.round("revenue", 2).cast("double").alias("revenue")))
    return found if n is None else found.orderBy(F.col("revenue").desc(), "c_custkey").limit(n)
