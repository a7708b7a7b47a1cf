"""Orders and lines laid out by order month, so that questions about recent days read recent months.

``lineitem`` has no order date; the layout gives each line the month of its order as a partition column.
A filter on that column with a scalar subquery (the latest date less the window) is evaluated when the
scan starts and leaves out whole folders: :func:`since` adds it where the layout is there, and the same
question runs unchanged, without pruning, on tables without it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import as_date, month_start
from tillwise.session import ensure_checkpoint_dir
from tillwise.sources.tables import Tables, schema_of

ORDER_MONTH = "o_order_month"
LINE_MONTH = "l_order_month"


def write_by_month(t: Tables, folder: str) -> None:
    """Write orders and lines below ``folder``, partitioned by order month.

    Rows are range-partitioned on (month, order key), so a month becomes as many files as its rows
    need and a task writes few months.  Lines of unknown orders, and orders without a date, go to the
    null month; every line and order is written."""
    orders = t.orders.withColumn(ORDER_MONTH, month_start(as_date("o_orderdate")))
    months = orders.select("o_orderkey", F.col(ORDER_MONTH).alias(LINE_MONTH))
    lines = t.lineitem.join(months, t.lineitem.l_orderkey == months.o_orderkey, "left").select(*t.lineitem.columns, LINE_MONTH)
    root = folder.rstrip("/")
    for name, df, month, key in (("orders", orders, ORDER_MONTH, "o_orderkey"), ("lineitem", lines, LINE_MONTH, "l_orderkey")):
        df.repartitionByRange(month, key).write.partitionBy(month).parquet(f"{root}/{name}.parquet")


def read_by_month(spark: SparkSession, folder: str, t: Tables) -> Tables:
    """``t`` with orders and lines from a layout of :func:`write_by_month`."""
    root = folder.rstrip("/")

    def read(name: str, month: str) -> DataFrame:
        fields = schema_of(name).add(month, "date")
        return spark.read.schema(fields).parquet(f"{root}/{name}.parquet")

    return t.replace(orders=read("orders", ORDER_MONTH), lineitem=read("lineitem", LINE_MONTH))


def by_month(t: Tables) -> Tables:
    """``t`` written by month to a new folder under ``spark.checkpoint.dir``, and read from it."""
    folder = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/by-month-{uuid.uuid4().hex}"
    write_by_month(t, folder)
    return read_by_month(t.spark, folder, t)


def since(rows: DataFrame, first_day: Column) -> DataFrame:
    """Rows of orders from ``first_day``'s month on, by folder; all rows where there is no layout."""
    for month in (ORDER_MONTH, LINE_MONTH):
        if month in rows.columns:
            return rows.where(F.col(month) >= F.trunc(first_day, "month"))
    return rows


def last_month(orders: DataFrame) -> DataFrame:
    """The orders that can hold the latest date: those of the last month where there is a layout (its
    months are read off the folders' names), all orders without."""
    if ORDER_MONTH not in orders.columns:
        return orders
    return orders.where(F.col(ORDER_MONTH) == orders.select(F.max(ORDER_MONTH)).scalar())
