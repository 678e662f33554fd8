"""The sales star: one fact and four dimensions over the trusted tables.

Each mart is a function of DataFrames; a ``StarSpec`` names the columns, so
the same code runs on the delivered files' schema (``REFERENCE_STAR``) and on
any other table set with the same roles.

Join strategy is left to Catalyst and AQE: every side here grows with the
data (products and persons as well as orders), so nothing is broadcast by
hint. AQE turns a join into a broadcast at run time only when the measured
side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits a
skewed sort-merge partition when one key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_parts


@dataclass(frozen=True)
class StarSpec:
    """Column roles of the star's source tables."""

    detail_order_key: str
    header_order_key: str
    detail_product_key: str
    product_key: str
    header_customer_key: str
    person_ref: str  # salesperson id on the order side
    person_ref_on: str  # "header" or "detail": which order table holds ``person_ref``
    person_key: str
    quantity: str  # quantity ordered, on the detail
    lead_time: str  # production lead time in days, on the product
    order_date: str  # on the header
    due_date: str  # on the header
    total_due: str  # order value, on the header
    customer_columns: tuple[str, ...]
    product_columns: tuple[str, ...]
    person_columns: tuple[str, ...]  # attributes kept in the salesperson dimension
    product_dates: tuple[tuple[str, str], ...] = ()  # (prefix, column) pairs
    header_dates: tuple[tuple[str, str], ...] = ()
    detail_dates: tuple[tuple[str, str], ...] = ()


# Lake names of the delivered files (see config.REFERENCE_SPECS).
REFERENCE_STAR = StarSpec(
    detail_order_key="sales_order_id",
    header_order_key="sales_order_id",
    detail_product_key="product_id",
    product_key="product_id",
    header_customer_key="customer_id",
    person_ref="sales_person_id",
    person_ref_on="header",
    person_key="business_entity_id",
    quantity="order_qty",
    lead_time="days_to_manufacture",
    order_date="order_date",
    due_date="due_date",
    total_due="total_due",
    customer_columns=("customer_id", "person_id", "store_id", "territory_id", "account_number"),
    product_columns=(
        "product_id", "name", "product_number", "make_flag", "finished_goods_flag", "color",
        "safety_stock_level", "reorder_point", "standard_cost", "list_price", "size",
        "size_unit_measure_code", "weight", "days_to_manufacture", "product_line", "class", "style",
        "product_subcategory_id", "product_model_id",
    ),
    person_columns=(
        "name_style", "title", "first_name", "middle_name", "last_name", "suffix", "email_promotion",
        "additional_contact_info", "demographics",
    ),
    product_dates=(("sell_start", "sell_start_date"), ("sell_end", "sell_end_date")),
    header_dates=(("order", "order_date"), ("due", "due_date"), ("ship", "ship_date")),
)


def _join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join; the right key is dropped (it equals the left one)."""
    if left_key == right_key:
        return left.join(right, left_key, "inner")
    return left.join(right, left[left_key] == right[right_key], "inner").drop(right[right_key])


def fact_orders(detail: DataFrame, header: DataFrame, star: StarSpec) -> DataFrame:
    """``pedidos``: every order line with its order's columns (inner join on the order key)."""
    return _join_on(detail, header, star.detail_order_key, star.header_order_key)


def customer_dim(customer: DataFrame, star: StarSpec) -> DataFrame:
    """``cliente``: the customer columns."""
    return customer.select(*star.customer_columns)


def product_dim(product: DataFrame, star: StarSpec) -> DataFrame:
    """``produto``: the product columns."""
    return product.select(*star.product_columns)


def time_dim(product: DataFrame, detail: DataFrame, header: DataFrame, star: StarSpec) -> DataFrame:
    """``tempo``: product ⋈ detail ⋈ header, each date with its year, month and day.

    One row per order line, no de-duplication (as the reference). Only the
    key and date columns are selected before the joins, so the scans read
    nothing else.
    """
    p_cols = [star.product_key] + [c for _, c in star.product_dates]
    d_cols = [star.detail_order_key, star.detail_product_key] + [c for _, c in star.detail_dates]
    h_cols = [star.header_order_key] + [c for _, c in star.header_dates]
    p = product.select(*dict.fromkeys(p_cols))
    d = detail.select(*dict.fromkeys(d_cols))
    h = header.select(*dict.fromkeys(h_cols))
    joined = _join_on(_join_on(d, p, star.detail_product_key, star.product_key), h,
                      star.detail_order_key, star.header_order_key)
    parts = []
    for prefix, c in (*star.product_dates, *star.header_dates, *star.detail_dates):
        parts.extend(date_parts(F.col(c), prefix))
    return joined.select(*parts)


def salesperson_dim(header: DataFrame, detail: DataFrame, person: DataFrame, star: StarSpec) -> DataFrame:
    """``vendedor``: distinct salespersons that appear on orders, with their attributes.

    The order side is reduced to its distinct salesperson ids first (a
    map-side combined aggregate), so the join sees one row per id instead
    of one per order.
    """
    orders = header if star.person_ref_on == "header" else detail
    ids = orders.select(star.person_ref).distinct()
    joined = ids.join(person, ids[star.person_ref] == person[star.person_key], "inner")
    return joined.select(star.person_ref, *star.person_columns).distinct()


def calendar_dim(header: DataFrame, star: StarSpec) -> DataFrame:
    """Distinct order dates with year, month and day (an extra, D15)."""
    return header.select(star.order_date).distinct().select(*date_parts(F.col(star.order_date), "order"))
