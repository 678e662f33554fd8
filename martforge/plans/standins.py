"""The test tables in the roles of the delivered files.

The delivered sales files are not public, so the engine is exercised on the
TPC-H-like test tables: orders as the order header, lineitem as the order
detail, customer, part as the product (``p_size`` as the production lead
time), supplier as the salesperson (reached through ``l_suppkey``) and events
as a change feed. The header has no due date; it is derived the same way on
the Spark side and in the oracle SQL: order date + 12 days.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LOAD_FULL, LOAD_MERGE, MERGE_UPSERT, ColumnSpec, TableSpec
from ..functions.dates import ntz_lit
from ..operators.marts import StarSpec

DUE_LAG_DAYS = 12

TEST_STAR = StarSpec(
    detail_order_key="l_orderkey",
    header_order_key="o_orderkey",
    detail_product_key="l_partkey",
    product_key="p_partkey",
    header_customer_key="o_custkey",
    person_ref="l_suppkey",
    person_ref_on="detail",
    person_key="s_suppkey",
    quantity="l_quantity",
    lead_time="p_size",
    order_date="o_orderdate",
    due_date="o_duedate",
    total_due="o_totalprice",
    customer_columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    product_columns=("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    person_columns=("s_name", "s_nationkey", "s_acctbal"),
    header_dates=(("order", "o_orderdate"), ("due", "o_duedate")),
    detail_dates=(("ship", "l_shipdate"),),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the derived due date."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("o_duedate", F.date_add(F.col("o_orderdate").cast("date"), DUE_LAG_DAYS))


def due_month_on_order_date(month_start: dt.date, month_end: dt.date):
    """The due-month range restated on the stored order date, so it can be pushed to the scan."""
    lo = month_start - dt.timedelta(days=DUE_LAG_DAYS)
    hi = month_end - dt.timedelta(days=DUE_LAG_DAYS)
    c = F.col("o_orderdate")
    return (c >= ntz_lit(lo)) & (c < ntz_lit(hi))


# SQL for the same derived header, used by the oracle queries.
HEADER_SQL = f"(SELECT *, CAST(o_orderdate AS DATE) + {DUE_LAG_DAYS} AS o_duedate FROM orders)"


# --- the test tables as delivered files ---------------------------------------

def _cols(*items):
    return tuple(ColumnSpec(source, kind) for source, kind in items)


ORDERS_SPEC = TableSpec(
    "orders.csv",
    _cols(("O_ORDERKEY", "int"), ("O_CUSTKEY", "int"), ("O_ORDERSTATUS", "string"), ("O_TOTALPRICE", "float"),
          ("O_ORDERDATE", "date"), ("O_ORDERPRIORITY", "string")),
    keys=("O_ORDERKEY",),
    load_mode=LOAD_MERGE,
)
LINEITEM_SPEC = TableSpec(
    "lineitem.csv",
    _cols(("L_ORDERKEY", "int"), ("L_PARTKEY", "int"), ("L_SUPPKEY", "int"), ("L_LINENUMBER", "int"),
          ("L_QUANTITY", "float"), ("L_EXTENDEDPRICE", "float"), ("L_DISCOUNT", "float"), ("L_TAX", "float"),
          ("L_RETURNFLAG", "string"), ("L_LINESTATUS", "string"), ("L_SHIPDATE", "date")),
    keys=("L_ORDERKEY", "L_LINENUMBER"),
    load_mode=LOAD_MERGE,
)
CUSTOMER_SPEC = TableSpec(
    "customer.csv",
    _cols(("C_CUSTKEY", "int"), ("C_NAME", "string"), ("C_NATIONKEY", "int"), ("C_ACCTBAL", "float"),
          ("C_MKTSEGMENT", "string")),
    keys=("C_CUSTKEY",),
    load_mode=LOAD_FULL,
)
PART_SPEC = TableSpec(
    "part.csv",
    _cols(("P_PARTKEY", "int"), ("P_NAME", "string"), ("P_BRAND", "string"), ("P_TYPE", "string"),
          ("P_SIZE", "int"), ("P_RETAILPRICE", "float")),
    keys=("P_PARTKEY",),
    load_mode=LOAD_FULL,
)
SUPPLIER_SPEC = TableSpec(
    "supplier.csv",
    _cols(("S_SUPPKEY", "int"), ("S_NAME", "string"), ("S_NATIONKEY", "int"), ("S_ACCTBAL", "float")),
    keys=("S_SUPPKEY",),
    load_mode=LOAD_FULL,
)
EVENTS_SPEC = TableSpec(
    "events.csv",
    _cols(("EVENT_ID", "int"), ("TS", "datetime"), ("USER_ID", "int"), ("EVENT_TYPE", "string"),
          ("VALUE", "float"), ("PROPS", "string")),
    keys=("EVENT_ID",),
    load_mode=LOAD_MERGE,
    merge_mode=MERGE_UPSERT,
)

# texts of many lines, with quotes and separators inside
DOCUMENTS_SPEC = TableSpec(
    "documents.csv",
    _cols(("DOC_ID", "int"), ("TEXT", "string"), ("LANG", "string"), ("SOURCE", "string"), ("N_CHARS", "int")),
    keys=("DOC_ID",),
    load_mode=LOAD_FULL,
    multi_line=True,
)

# Dirty-text variants, chosen per row by ``selector % 4``:
#   0 clean text; 1 ints get ".0", floats a decimal comma, dates a time of day;
#   2 a single blank and 3 a single dash in non-key int/float/date columns.
_CLEAN, _ALT, _BLANK, _DASH = 0, 1, 2, 3


def _clean_text(c, kind: str):
    if kind == "int":
        return c.cast("string")
    if kind == "float":
        return c.cast("decimal(18,2)").cast("string")
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind == "datetime":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast("string")


def _clean_text_sql(c: str, kind: str) -> str:
    if kind == "int":
        return f"CAST({c} AS VARCHAR)"
    if kind == "float":
        return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"
    if kind == "date":
        return f"strftime({c}, '%Y-%m-%d')"
    if kind == "datetime":
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({c} AS VARCHAR)"


def render_text(df: DataFrame, spec: TableSpec, selector=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed test rows -> the text a delivered file would hold (optionally dirty)."""
    out = []
    for col in spec.columns:
        c, kind = F.col(col.lake), col.source_type
        text = _clean_text(c, kind)
        if selector is not None and kind in ("int", "float", "date"):
            v = selector % 4
            alt = {"int": F.concat(text, F.lit(".0")), "float": F.replace(text, F.lit("."), F.lit(",")),
                   "date": F.concat(text, F.lit(" 00:00:00"))}[kind]
            text = F.when(v == _ALT, alt).otherwise(text)
            if col.lake not in spec.keys:
                text = F.when(v == _BLANK, F.lit(" ")).when(v == _DASH, F.lit("-")).otherwise(text)
        out.append(text.alias(col.lake))
    return df.select(*out, *keep)


def render_text_sql(source: str, spec: TableSpec, selector: str | None = None) -> str:
    cols = []
    for col in spec.columns:
        kind = col.source_type
        text = _clean_text_sql(col.lake, kind)
        if selector is not None and kind in ("int", "float", "date"):
            alt = {"int": f"{text} || '.0'", "float": f"replace({text}, '.', ',')",
                   "date": f"{text} || ' 00:00:00'"}[kind]
            nulls = "" if col.lake in spec.keys else f"WHEN ({selector}) % 4 = {_BLANK} THEN ' ' WHEN ({selector}) % 4 = {_DASH} THEN '-' "
            text = f"CASE WHEN ({selector}) % 4 = {_ALT} THEN {alt} {nulls}ELSE {text} END"
        cols.append(f"{text} AS {col.lake}")
    return f"SELECT {', '.join(cols)} FROM {source}"


_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def expected_typed_sql(source: str, spec: TableSpec, selector: str | None = None, extra: str = "") -> str:
    """What the typed projection of ``render_text_sql`` must give, computed from the typed source."""
    cols = []
    for col in spec.columns:
        kind, target = col.source_type, _SQL_TYPES[col.target]
        if kind == "float":
            value = f"CAST(CAST({col.lake} AS DECIMAL(18,2)) AS DOUBLE)"
        elif kind == "date":
            value = f"CAST({col.lake} AS DATE)"
        else:
            value = f"CAST({col.lake} AS {target})"
        if selector is not None and kind in ("int", "float", "date") and col.lake not in spec.keys:
            value = f"CASE WHEN ({selector}) % 4 IN ({_BLANK}, {_DASH}) THEN NULL ELSE {value} END"
        cols.append(f"{value} AS {col.lake}")
    return f"SELECT {', '.join(cols)}{extra} FROM {source}"


# --- the two-batch orders scenario -----------------------------------------------
# Two daily snapshot files of a rolling window over the whole orders table: batch 1
# holds the orders dated before WINDOW_END, batch 2 those dated from WINDOW_START
# on, each with its price raised by 1. Against batch 1, batch 2 inserts the newest
# orders, updates the overlap and (snapshot merge) deletes the oldest ones.

BATCH1_TIME = dt.datetime(2024, 8, 31, 21, 0, 0)
BATCH2_TIME = dt.datetime(2024, 9, 5, 9, 0, 0)
WINDOW_START = dt.date(1995, 7, 1)
WINDOW_END = dt.date(2001, 1, 1)
ORDERS_SELECTOR = "o_orderkey"


def orders_batch_typed(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    if which == 1:
        return o.filter(F.col("o_orderdate") < F.lit(WINDOW_END))
    return o.filter(F.col("o_orderdate") >= F.lit(WINDOW_START)).withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0)
    )


def orders_batch_sql(which: int) -> str:
    if which == 1:
        return f"(SELECT * FROM orders WHERE o_orderdate < DATE '{WINDOW_END}')"
    return (f"(SELECT * REPLACE (o_totalprice + 1.0 AS o_totalprice) FROM orders "
            f"WHERE o_orderdate >= DATE '{WINDOW_START}')")


def orders_batch_text(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    df = orders_batch_typed(spark, sf_dir, which)
    return render_text(df, ORDERS_SPEC, F.col(ORDERS_SELECTOR))


def orders_expected_sql(which: int, stamp: dt.datetime | None = None) -> str:
    extra = f", TIMESTAMP '{stamp.isoformat(sep=' ')}' AS partition_time" if stamp else ""
    return expected_typed_sql(orders_batch_sql(which), ORDERS_SPEC, ORDERS_SELECTOR, extra)


# --- pipeline runs over the test tables ------------------------------------------

BATCH_IDS = ("000001", "000002")
_RUNS: dict[tuple, str] = {}


def write_batch_file(spark: SparkSession, text: DataFrame, spec: TableSpec, name: str) -> str:
    """Write a text batch as a delivered ``;`` file set in a fresh shared folder."""
    from ..session import work_dir
    from ..sources.flatfile import write_flat_file

    path = f"{work_dir(spark, 'landing')}/{name}"
    write_flat_file(text, path, spec)
    return path


def orders_pipeline(spark: SparkSession, sf_dir: str, load_mode: str = LOAD_MERGE, cached: bool = True):
    """Both orders batches as files through land -> raw -> trusted, plus one customer load.

    Returns the lake layout. Runs once per session, table folder and mode
    unless ``cached`` is false.
    """
    from dataclasses import replace

    from ..session import work_dir
    from ..sources.flatfile import read_flat_file
    from ..sources.layers import LakeLayout
    from .load import load_batch

    key = (spark.sparkContext.applicationId, sf_dir, load_mode)
    if cached and key in _RUNS:
        return LakeLayout(_RUNS[key])
    spec = replace(ORDERS_SPEC, load_mode=load_mode)
    layout = LakeLayout(work_dir(spark, "lake"))
    for which, batch_id, stamp in ((1, BATCH_IDS[0], BATCH1_TIME), (2, BATCH_IDS[1], BATCH2_TIME)):
        path = write_batch_file(spark, orders_batch_text(spark, sf_dir, which), spec, f"orders_{batch_id}.csv")
        load_batch(spark, spec, read_flat_file(spark, path, spec), layout, batch_id, stamp)
    cust = render_text(table(spark, sf_dir, "customer"), CUSTOMER_SPEC, F.col("c_custkey"))
    path = write_batch_file(spark, cust, CUSTOMER_SPEC, "customer.csv")
    load_batch(spark, CUSTOMER_SPEC, read_flat_file(spark, path, CUSTOMER_SPEC), layout, BATCH_IDS[0], BATCH1_TIME)
    _RUNS[key] = layout.root
    return layout


STAR_TABLES = (
    ("detail", "lineitem", "LINEITEM_SPEC"),
    ("header", "orders", "ORDERS_SPEC"),
    ("customer", "customer", "CUSTOMER_SPEC"),
    ("product", "part", "PART_SPEC"),
    ("person", "supplier", "SUPPLIER_SPEC"),
)


def star_specs() -> dict[str, TableSpec]:
    from dataclasses import replace

    # order lines repeat their key in the test data: load every table in full
    return {role: replace(globals()[spec], load_mode=LOAD_FULL) for role, _, spec in STAR_TABLES}


def add_due_date(header_df: DataFrame) -> DataFrame:
    return header_df.withColumn("o_duedate", F.date_add(F.col("o_orderdate"), DUE_LAG_DAYS))


def star_pipeline(spark: SparkSession, sf_dir: str, cached: bool = True):
    """All five tables as files -> trusted (full loads) -> the five refined marts."""
    from ..session import work_dir
    from ..sources.flatfile import read_flat_file
    from ..sources.layers import LakeLayout
    from .load import load_batch
    from .refresh import refresh_marts

    key = (spark.sparkContext.applicationId, sf_dir, "star")
    if cached and key in _RUNS:
        return LakeLayout(_RUNS[key])
    layout = LakeLayout(work_dir(spark, "lake"))
    specs = star_specs()

    def load(role: str, name: str) -> None:
        spec = specs[role]
        path = write_batch_file(spark, render_text(table(spark, sf_dir, name), spec), spec, f"{name}.csv")
        load_batch(spark, spec, read_flat_file(spark, path, spec), layout, BATCH_IDS[0], BATCH1_TIME)

    # the tables are independent: their small jobs run beside the large table's
    with ThreadPoolExecutor(max_workers=len(STAR_TABLES)) as pool:
        for job in [pool.submit(load, role, name) for role, name, _ in STAR_TABLES]:
            job.result()
    refresh_marts(spark, layout, TEST_STAR, specs, prepare={"header": add_due_date})
    _RUNS[key] = layout.root
    return layout


def typed_sql(table_name: str, spec: TableSpec) -> str:
    """The clean typed table as a load of its rendered file gives it (oracle side)."""
    return f"({expected_typed_sql(table_name, spec)})"
