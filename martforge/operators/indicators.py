"""The five business indicators of the sales mart.

All are aggregates that combine map-side before they shuffle; the order
lines are reduced to one row per join key before any join, so the joins see
the small side of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DUE_MIN_TOTAL, DUE_MONTH, MIN_PRODUCTS_PER_ORDER, TOP_PRODUCTS
from ..functions.dates import month_range
from .marts import StarSpec


def orders_over_n_products(detail: DataFrame, star: StarSpec, n: int = MIN_PRODUCTS_PER_ORDER) -> DataFrame:
    """Indicator 1: number of orders with more than ``n`` distinct products (one row, ``n_orders``).

    Distinct (order, product) pairs first, then a count per order: both steps
    are map-side combined, so an order with a huge number of lines does not
    land whole in one task.
    """
    pairs = detail.select(star.detail_order_key, star.detail_product_key).distinct()
    per_order = pairs.groupBy(star.detail_order_key).agg(F.count(F.lit(1)).alias("n_products"))
    return per_order.filter(F.col("n_products") > n).agg(F.count(F.lit(1)).alias("n_orders"))


def top_products_by_lead_time(
    detail: DataFrame, product: DataFrame, star: StarSpec, k: int = TOP_PRODUCTS
) -> DataFrame:
    """Indicator 2: the ``k`` best-selling products for each production lead time.

    Quantity is summed per product before the join with the product table.
    The rank is ``row_number`` over (quantity desc, product key asc), a total
    order; Catalyst plans ``rank <= k`` as a window group limit that keeps
    only the top rows per lead time in each task before the shuffle.
    """
    sold = detail.groupBy(star.detail_product_key).agg(F.sum(star.quantity).alias("total_qty"))
    prod = product.select(star.product_key, star.lead_time)
    if star.detail_product_key == star.product_key:
        joined = sold.join(prod, star.product_key, "inner")
    else:
        joined = sold.join(prod, sold[star.detail_product_key] == prod[star.product_key], "inner").drop(
            sold[star.detail_product_key]
        )
    w = Window.partitionBy(star.lead_time).orderBy(F.col("total_qty").desc(), F.col(star.product_key).asc())
    ranked = joined.withColumn("sales_rank", F.row_number().over(w))
    return ranked.filter(F.col("sales_rank") <= k).select(star.lead_time, star.product_key, "total_qty", "sales_rank")


def orders_per_customer(header: DataFrame, star: StarSpec) -> DataFrame:
    """Indicator 3: number of orders per customer (``n_orders``)."""
    return header.groupBy(star.header_customer_key).agg(F.count(F.lit(1)).alias("n_orders"))


def qty_by_order_date(detail: DataFrame, header: DataFrame, star: StarSpec) -> DataFrame:
    """Indicator 4: quantity sold per order date (``total_qty``).

    Lines are summed per order first; that aggregate is already partitioned
    on the order key, so the join with the header reuses its partitioning.
    """
    per_order = detail.groupBy(star.detail_order_key).agg(F.sum(star.quantity).alias("order_qty_sum"))
    h = header.select(star.header_order_key, star.order_date)
    if star.detail_order_key == star.header_order_key:
        joined = per_order.join(h, star.header_order_key, "inner")
    else:
        joined = per_order.join(h, per_order[star.detail_order_key] == h[star.header_order_key], "inner")
    return joined.groupBy(star.order_date).agg(F.sum("order_qty_sum").alias("total_qty"))


def due_orders(
    header: DataFrame,
    star: StarSpec,
    month: str = DUE_MONTH,
    min_total: float = DUE_MIN_TOTAL,
    extra_filter: Column | None = None,
) -> DataFrame:
    """Indicator 5: orders falling due in ``month`` with a value above ``min_total``.

    The month is a half-open date range on the due date, so the predicate
    reaches the parquet scan. ``extra_filter`` may add an equivalent
    predicate on a stored column when the due date is derived.
    """
    start, end = month_range(month)
    due = F.col(star.due_date)
    cond = (due >= F.lit(start)) & (due < F.lit(end)) & (F.col(star.total_due) > F.lit(min_total))
    if extra_filter is not None:
        cond = extra_filter & cond
    return header.filter(cond).select(star.header_order_key, star.header_customer_key, star.total_due, star.due_date)
